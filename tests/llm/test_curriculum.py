import pytest

from millrace.llm import curriculum
from millrace.llm.curriculum import Mix


def brute_targets(sizes, weights=(3, 1, 2)):
    """{source: target} by sharing again until none is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    rest, held, target = 1.5 * sum(sizes.values()), set(), {}
    while True:
        left = rest - sum(2 * sizes[s] for s in held)
        total = sum(weight[s] for s in order if s not in held)
        target = {s: 2.0 * sizes[s] if s in held else left * weight[s] / total for s in order}
        over = {s for s in order if s not in held and target[s] > 2 * sizes[s]}
        if not over:
            return target
        held |= over


def check(rows):
    sizes = {}
    for r in rows:
        sizes.setdefault(r.source_size, 0)
    by_source = {}
    for r in rows:
        by_source.setdefault((r.source_size, r.target), []).append(r)
    for (size, target), group in by_source.items():
        assert all(0 <= r.taken <= 2 * r.size for r in group)
        if size == sum(r.size for r in group):  # sources of one size and target may share a group
            assert abs(sum(r.taken for r in group) - target) <= 1


def test_targets(spark, documents):
    rows = curriculum.mixed(spark, documents).collect()
    check(rows)
    sizes = {}
    for r in curriculum.sized(documents).collect():
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    goals = {r.source: r.target for r in curriculum.targets(spark, curriculum.sized(documents)).collect()}
    expected = brute_targets(sizes)
    assert goals.keys() == expected.keys()
    assert all(abs(goals[s] - expected[s]) < 1e-6 for s in goals)


def test_odd_rows(spark, corpus, odd_rows):
    rows = [(*r, None, s) for r, s in zip(odd_rows, [None, "b", "é", "a", None, "b", "b", "b", "a", "Z", "a"])]
    frame = corpus(rows, extra=["size", "taken", "place"])
    out = curriculum.mixed(spark, frame).collect()
    assert len(out) == len(rows)
    check(out)
    goals = {r.source: r.target for r in curriculum.targets(spark, curriculum.sized(frame)).collect()}
    sizes = {}
    for _, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + len([w for w in __import__("brute").words(text)])
    expected = brute_targets(sizes)
    assert all(abs(goals[s] - expected[s]) < 1e-6 for s in goals)


def test_empty_and_wordless(spark, corpus):
    assert curriculum.mixed(spark, corpus([])).count() == 0
    assert curriculum.training_order(spark, corpus([])).count() == 0
    rows = curriculum.mixed(spark, corpus([(1, None), (2, " ")])).collect()
    assert [(r.size, r.target, r.taken) for r in rows] == [(0, 0.0, 0)] * 2


def test_reruns_and_cuts_agree(spark, documents, monkeypatch):
    first = sorted(map(tuple, curriculum.mixed(spark, documents).collect()))
    monkeypatch.setattr(curriculum, "BUCKET_DOCS", 5)
    again = sorted(map(tuple, curriculum.mixed(spark, documents.repartition(7)).collect()))
    assert first == again


def test_training_order(spark, documents):
    out = curriculum.training_order(spark, documents)
    assert out.columns == [*documents.columns, "words_taken", "position"]
    rows = out.collect()
    taken = {r.doc_id: r.taken for r in curriculum.mixed(spark, documents).collect()}
    got = {}
    for r in rows:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.words_taken
        assert len(__import__("brute").words(r.text)) == r.words_taken
    assert got == {d: t for d, t in taken.items() if t}
    positions = [r.position for r in rows]
    assert positions == sorted(positions) and 0 <= positions[0] and positions[-1] <= 1


@pytest.mark.parametrize(("start", "end"), [(1.0, 1.5), (1.0, 0.5), (2.0, 2.0), (0.5, 3.0)])
def test_position_inverts_demand(spark, start, end):
    mix = Mix(weights=(1,), start=(start,), end=(end,))
    rows = spark.range(0, 101, 10).selectExpr("id AS words", "0 AS place", "100.0D AS target")
    for r in rows.withColumn("t", curriculum.position(mix, rows["words"])).collect():
        demand = (start * r.t + (end - start) * r.t**2 / 2) / ((start + end) / 2)
        assert abs(demand - r.words / 100) < 1e-9


def test_columns_of_the_same_names_stay(spark, documents):
    frame = documents.limit(50).selectExpr("*", "doc_id AS position", "'x' AS words_taken", "'y' AS words_taken_")
    out = curriculum.training_order(spark, frame)
    assert out.columns == [*frame.columns, "words_taken__", "position_"]
    assert all(r.position == r.doc_id and r.words_taken == "x" and 0 <= r.position_ <= 1 and r.words_taken__ > 0 for r in out.collect())


def test_the_query_is_sorted_over_all_partitions(spark, documents):
    rows = curriculum.mixed(spark, documents).collect()
    keys = [(r.first_position is not None, r.first_position or 0, r.doc_id) for r in rows]
    assert keys == sorted(keys)
