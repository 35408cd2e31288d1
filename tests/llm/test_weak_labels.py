import numpy as np
import pytest

from millrace.llm import weak_labels
from millrace.llm.weak_labels import Fit, expectation_maximisation, fitted


def test_em_finds_accuracies():
    generator = np.random.default_rng(1)
    bad = generator.random(20_000) < 0.3
    truth = [(0.9, 0.8), (0.95, 0.5), (0.75, 1.0), (0.8, 0.6)]
    votes = np.full((len(bad), len(truth)), -1)
    for j, (right, cast) in enumerate(truth):
        says = np.where(generator.random(len(bad)) < right, bad, ~bad)
        votes[:, j] = np.where(generator.random(len(bad)) < cast, says, -1)
    patterns, n = np.unique(votes, axis=0, return_counts=True)
    found = expectation_maximisation(patterns, n.astype(float), [("", 0.7, 0.0)] * len(truth))
    assert found.bad == pytest.approx(0.3, abs=0.03)
    assert found.accuracy == pytest.approx([t[0] for t in truth], abs=0.02)
    assert ((found.posterior(votes) > 0.5) == bad).mean() > 0.9


def test_scorer_learns_rare_features():
    generator = np.random.default_rng(2)
    rows, target = [], []
    for i in range(1_200):
        row = generator.choice(3_000, 80, replace=False)
        if i % 2:
            row = np.append(row, 4_000 + generator.integers(0, 20))
        rows.append(np.unique(row))
        target.append(float(i % 2))
    scorer = fitted(rows[:800], np.array(target[:800]), Fit(bits=13))
    scores = scorer.scores(np.repeat(np.arange(400), [len(r) for r in rows[800:]]), np.concatenate(rows[800:]), 400)
    assert ((scores > 0.5) == np.array(target[800:])).mean() > 0.97


def test_one_class_stays_at_prior():
    scorer = fitted([np.array([1, 2])], np.array([0.0]), Fit(bits=4))
    assert scorer.scores(np.array([0]), np.array([1]), 1)[0] == pytest.approx(Fit().prior)


def test_only_used_features_change_nothing():
    import pyarrow as pa

    texts = pa.array(["the words of a text, the words", None, "", "OTHER words! " * 30])
    generator = np.random.default_rng(1)
    weights = np.where(generator.random(1 << 12) < 0.3, generator.normal(size=1 << 12), 0)
    scorer = weak_labels.Scorer(np.append(weights, 0.5))
    whole = scorer.scores(*weak_labels.features(texts, 12), 4)
    assert scorer.scores(*weak_labels.features(texts, 12, weights != 0), 4) == pytest.approx(whole)


def test_held_out_labels(spark, data):
    """Half of the human labels are hidden and must be found again."""
    folder = data.replace("sf0.01", "sf0.1")
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    hidden = labels.where("doc_id % 2 = 0")
    rows = weak_labels.scored(spark, docs, labels.where("doc_id % 2 = 1")).join(hidden, "doc_id").collect()
    low = [r for r in rows if r.quality == 0]
    toxic = [r for r in rows if r.quality == 1 and r.toxic == 1]
    clean = [r for r in rows if r.quality == 1 and r.toxic == 0]
    assert np.mean([r.kept for r in clean]) > 0.98
    assert np.mean([r.kept for r in low]) < 0.1
    assert np.mean([r.kept for r in toxic]) < 0.45  # the rest are in languages with few labelled texts


def test_an_acronym_is_no_fault(spark, corpus):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = [(1, "слово и дело " * 10 + "NATO"), (2, "СЛОВО И ДЕЛО " * 10), (3, "WORD AND DEED " * 10)]
    at = list(weak_labels.QUESTIONS["low_quality"]).index("capitals")
    got = {r.doc_id: r.low_quality[at] for r in weak_labels.votes(corpus(rows), labels).collect()}
    assert got == {1: "-", 2: "1", 3: "1"}


def test_odd_rows(spark, corpus, odd_rows):
    labels = spark.createDataFrame([(1, 0, 0), (1, 1, None), (None, 0, 1), (5, None, 1), (4, 1, 0)], "doc_id long, quality int, toxic int")
    out = weak_labels.scored(spark, corpus(odd_rows, extra=["quality", "toxic", "kept"]), labels).collect()
    assert len(out) == len(odd_rows)
    assert all(0 <= r.score <= 1 and r.kept == (r.low_quality < 0.5 and r.abusive < 0.5) for r in out)
    assert weak_labels.scored(spark, corpus([]), labels).count() == 0
    nothing = spark.createDataFrame([], labels.schema)
    assert weak_labels.scored(spark, corpus(odd_rows), nothing).count() == len(odd_rows)


def test_an_id_on_many_rows(spark, corpus):
    """Rows are known by id and text: one id on all of them changes nothing but the votes of its labels."""
    draw = np.random.default_rng(4)
    words = ["the", "of", "river", "garden", "stone", "light", "house", "paper"]
    texts = [" ".join(draw.choice(words, 80)) if i % 3 else "### !!! " * 30 + str(i) for i in range(300)]
    labels = spark.createDataFrame([(-1, 1, 0)], "doc_id long, quality int, toxic int")
    one = weak_labels.scored(spark, corpus([(7, t) for t in texts]), labels)
    many = weak_labels.scored(spark, corpus([(100 + i, t) for i, t in enumerate(texts)]), labels)
    assert one.count() == many.count() == 300
    scorers, _, cast = weak_labels.train(spark, corpus([(7, t) for t in texts]), labels)
    assert cast.select("key").distinct().count() == len(set(texts))
    assert sorted(r.kept for r in one.collect()) == sorted(r.kept for r in many.collect())


def test_repeated_rows_are_one_text_of_the_sample(spark, corpus):
    rows = [(1, "good words stand here in a row " * 9)] * 60 + [(i, f"### !!! {i} " * 40) for i in range(2, 40)]
    out = weak_labels.scored(spark, corpus(rows), spark.createDataFrame([], "doc_id long, quality int, toxic int")).collect()
    assert len(out) == len(rows) and len({r.score for r in out if r.doc_id == 1}) == 1
