import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import langid


def test_held_out_accuracy(spark, documents):
    langs = {r.doc_id: r.lang for r in documents.select("doc_id", "lang").collect()}
    rows = langid.held_out_predictions(spark, documents).collect()
    assert len(rows) == len(langs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)
    assert np.mean([r.accepted for r in rows]) > 0.97


def test_nothing_but_text_counts(spark, documents):
    """A prediction stays when language, source and id of a held-out row change."""
    model = langid.train(spark, documents)
    few = documents.limit(30)
    first = {(r.lang_pred, r.score, r.doc_id) for r in langid.predict(spark, few, model).collect()}
    other = few.selectExpr("doc_id + 7 AS doc_id", "text", "'zz' AS lang", "'s' AS source")
    assert {(r.lang_pred, r.score, r.doc_id - 7) for r in langid.predict(spark, other, model).collect()} == first


def test_odd_rows(spark, corpus, odd_rows):
    rows = [(*r, "xx") for r in odd_rows] + [(40 + i, t, x) for i, (t, x) in enumerate([("123 !", "xx"), ("wo wo", None)])]
    frame = corpus(rows, extra=["score", "bits"])
    out = langid.held_out_predictions(spark, frame).collect()
    assert len(out) == len(rows)
    for r in out:
        text = next(t for d, t, *_ in rows if d == r.doc_id)
        blank = not any(c.isalpha() for c in text or "")
        if r.doc_id is not None:
            assert r.lang_pred == ("und" if blank else "xx") and (r.score == 0) == blank
    assert langid.held_out_predictions(spark, corpus([])).count() == 0
    nothing = langid.held_out_predictions(spark, corpus([(1, "some words"), (2, None)])).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}


TEXTS = {"a": ["the cat sat on the mat", "the dog ate the hat", "that is that"], "b": ["el gato y el perro", "la casa de la loma", "eso es todo"]}


def brute_probability(texts, context, char, alphabet):
    """Interpolated Kneser-Ney, written out with dictionaries of strings."""
    pad = " " * (langid.ORDER - 1)
    top = Counter()
    for t in texts:
        t = pad + t
        top.update(t[i : i + langid.ORDER] for i in range(len(t) - langid.ORDER + 1))
    tables = {langid.ORDER: top}
    for k in range(langid.ORDER - 1, 0, -1):
        tables[k] = Counter(g[1:] for g in tables[k + 1])

    def p(context, k):
        if k == 0:
            return 1 / alphabet
        table, context = tables[k], context[len(context) - k + 1 :] if k > 1 else ""
        once, twice = sum(n == 1 for n in table.values()), sum(n == 2 for n in table.values())
        d = once / (once + 2 * twice) if once and twice else 0.5
        here = {g: n for g, n in table.items() if g[:-1] == context}
        total = sum(here.values())
        if not total:
            return p(context, k - 1)
        return max(table[context + char] - d, 0) / total + d * len(here) / total * p(context, k - 1)

    return p(context, langid.ORDER)


def rows_of(spark, texts):
    return spark.createDataFrame([(t, lang) for lang, some in texts.items() for t in some], "text string, lang string")


def coded(grams):
    return np.array([[ord(c) for c in g] for g in grams], np.uint32)


ASKED = ["the ", "  th", "hat ", "xxxa", "el g", "that", "zzzz", "de l", "   t", "o   "]


@pytest.mark.parametrize("part", [10_000, 60])
def test_probabilities_follow_the_formula(spark, part):
    """Also where the model is cut into parts: each n-gram by the part that has it."""
    model = langid.fitted(spark, langid.counted(rows_of(spark, TEXTS)), part)
    assert (len(model.cuts) > 2) == (part == 60)
    alphabet = len({c for v in TEXTS.values() for t in v for c in t}) + 1
    codes = coded(ASKED)
    got = np.zeros((len(ASKED), 2))
    times = np.zeros(len(ASKED), int)
    for number in range(len(model.cuts) + 1):
        made = model.part(spark, number).value
        mine = np.flatnonzero(made.mine(codes))
        got[mine] = made.logs(codes[mine])
        times[mine] += 1
    assert (times == 1).all()
    for i, gram in enumerate(ASKED):
        for j, name in enumerate(model.langs):
            assert 2.0 ** got[i, j] == pytest.approx(brute_probability(TEXTS[name], gram[:-1], gram[-1], alphabet), rel=1e-4)


def test_parts_change_no_prediction(spark, documents):
    rows = documents.where("doc_id % 5 = 0")
    found = []
    for part in (langid.PART_ENTRIES, 8_000):
        model = langid.train(spark, rows, part)
        out = langid.predict(spark, rows, model).collect()
        found.append(sorted((r.doc_id, r.lang_pred, r.accepted) for r in out))
        scores = sorted(r.score for r in out)
    assert len(model.cuts) > 2 and found[0] == found[1] and 0 <= scores[0] <= scores[-1] <= 1


def test_no_n_gram_is_left_out(spark):
    """Many n-grams that occur once, in languages of many: all of them are in the model."""
    draw = np.random.default_rng(2)
    letters = [chr(c) for c in range(0x4E00, 0x4E00 + 400)]
    texts = {f"l{i}": ["".join(draw.choice(letters, 300)) for _ in range(40)] for i in range(3)}
    model = langid.fitted(spark, langid.counted(rows_of(spark, texts)), part=9_000)
    want = {(lang, ("   " + t)[i : i + 4]) for lang, some in texts.items() for t in some for i in range(len(t))}
    assert model.rows.where("NOT back AND size = 4").count() == len(want) > 30_000
    held = [model.part(spark, n).value for n in range(len(model.cuts) + 1)]
    assert sum(len(p.seen[3].values) for p in held) == len(want)
    assert max(len(p.seen[3].values) for p in held) < 20_000


def test_scripts_beyond_the_first_plane(spark, corpus):
    """Two languages whose letters all lie above U+FFFF."""
    draw = np.random.default_rng(3)
    rows = []
    for i in range(200):
        low = 0x10330 if i % 2 else 0x10428
        words = ["".join(chr(low + int(c)) for c in draw.integers(0, 20, 5)) for _ in range(12)]
        rows.append((i, " ".join(words), "got" if i % 2 else "en-deseret"))
    out = langid.held_out_predictions(spark, corpus(rows)).where("held_out").collect()
    assert len(out) > 20 and all(r.lang_pred == ("got" if r.doc_id % 2 else "en-deseret") for r in out)


def brute_prediction(texts, asked):
    """The language of the least cross-entropy, by the formula over strings."""
    alphabet = len({c for v in texts.values() for t in v for c in t}) + 1
    bits = {}
    for name in sorted(texts):
        padded = "   " + asked
        logs = [np.log2(brute_probability(texts[name], padded[i : i + 3], padded[i + 3], alphabet)) for i in range(len(asked))]
        bits[name] = -sum(logs) / len(asked)
    return min(bits, key=bits.get), min(bits.values())


def test_documents_against_the_formula(spark):
    model = langid.train(spark, rows_of(spark, TEXTS).withColumn("doc_id", F.lit(1)))
    asked = ["the gato", "casa", "that", "eso es the", "un perro sat"]
    rows = spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string")
    for r in langid.predict(spark, rows, model).collect():
        name, bits = brute_prediction(TEXTS, asked[r.doc_id])
        assert r.lang_pred == name and r.bits_per_char == pytest.approx(bits, rel=1e-4)


def test_hash_array():
    generator = np.random.default_rng(1)
    keys = np.unique(generator.integers(0, 2**63, 5_000).astype(np.uint64))
    table = langid.HashArray(keys)
    ask = np.concatenate((keys[::7], generator.integers(0, 2**63, 999).astype(np.uint64)))
    known = {int(k): i for i, k in enumerate(keys)}
    assert table.find(ask).tolist() == [known.get(int(k), -1) for k in ask]


def test_temperature_and_limits_come_from_all_training_texts(spark, corpus):
    """More texts than any sample would take, some of them far from the others."""
    draw = np.random.default_rng(5)
    words = {"a": ["the", "cat", "sat", "on", "mat", "casa"], "b": ["el", "gato", "casa", "loma", "the", "todo"]}
    rows = [(i, " ".join(draw.choice(words["ab"[i % 2]], 1 + i % 7)), "ab"[i % 2]) for i in range(9_000)]
    frame = corpus(rows)
    model = langid.train(spark, frame)
    found = langid.entropies(spark, frame.select("lang", "text"), model).collect()
    bits, own = np.array([r.bits for r in found]), np.array([model.langs.index(r.lang) for r in found])
    for i, limit in enumerate(model.limits):
        mine = bits[own == i, i]
        assert limit == pytest.approx(mine.mean() + 6 * mine.std() + 0.5, rel=1e-9)
    gap = bits - bits[np.arange(len(bits)), own][:, None]
    assert model.temperature == min(langid.TEMPERATURES, key=lambda t: np.logaddexp2.reduce(-t * gap, axis=1).mean())
    whole = langid.held_out_predictions(spark, frame).where("NOT held_out").orderBy("doc_id").collect()
    same = frame.where(langid.fold(F.col("doc_id")) != 2)
    again = langid.predict(spark, same, langid.train(spark, same)).orderBy("doc_id").collect()
    assert [(r.doc_id, r.lang_pred, r.accepted) for r in whole] == [(r.doc_id, r.lang_pred, r.accepted) for r in again]
    assert [r.score for r in whole] == pytest.approx([r.score for r in again], rel=1e-12)
