import numpy as np
import pytest

from millrace.llm.negatives import Heaps, Mining, hard_negatives, strassen

SHAPE = "vec_id long, embedding array<float>, label int, anchor string, part string"


def brute(rows, mining):
    """Every anchor against every row, in plain Python."""
    known = []
    for vec_id, vector, label in rows:
        if vec_id is None or vector is None or label is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        label = (label + 1) % mining.labels if vec_id % mining.changed == 0 else label
        known.append((vec_id, label, tuple(int(np.floor(256 * float(np.float32(x)))) for x in vector)))
    out = []
    for anchor, mine, a in dict.fromkeys(r for r in known if r[0] % mining.every == 0):
        scored = [(-sum(x * y for x, y in zip(a, b)), i, lab) for i, lab, b in known if i != anchor]
        best = sorted((s, i) for s, i, lab in scored if lab == mine)[: mining.positives]
        for s, i in best:
            fit = sorted((n, j) for n, j, lab in scored if lab != mine and 50 * -s <= 100 * -n <= 95 * -s)
            out += [(anchor, i, rank + 1, j, -s, -n) for rank, (n, j) in enumerate(fit[: mining.negatives])]
    return sorted(out)


def mined(spark, rows, mining=Mining()):
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], SHAPE)
    found = hard_negatives(spark, frame, mining)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, found.collect()))


@pytest.mark.parametrize("shape", [(1, 1, 1), (5, 3, 7), (64, 64, 64), (100, 65, 130), (33, 0, 4), (0, 3, 2)])
@pytest.mark.parametrize("leaf", [2, 16, 500])
def test_strassen_is_exact(shape, leaf):
    draw = np.random.default_rng(sum(shape))
    a = draw.integers(-(2**29), 2**29, shape[:2])
    b = draw.integers(-(2**29), 2**29, shape[1:])
    assert (strassen(a, b, leaf) == a @ b).all()


def test_sums_in_between_may_leave_64_bits():
    a = np.full((4, 4), 1 << 31)
    b = np.array([[1 << 31, 0, 0, 0], [-(1 << 31), 0, 0, 0], [5, 0, 0, 0], [-5, 1, 0, 0]])
    assert (strassen(a, b, 1) == a @ b).all()


def test_heaps_merge_in_any_order():
    draw = np.random.default_rng(3)
    scores, ids = draw.integers(-5, 5, (2, 40)), np.stack([draw.permutation(40) for _ in range(2)])
    one, two = Heaps(2, 4), Heaps(2, 4)
    one.merge(np.arange(2), scores, ids)
    for low in range(35, -1, -5):
        two.merge(np.arange(2), scores[:, low : low + 5], ids[:, low : low + 5])
    assert (one.scores == two.scores).all() and (one.ids == two.ids).all()
    for row in range(2):
        want = sorted(zip(-scores[row], ids[row]))[:4]
        assert list(zip(-one.scores[row], one.ids[row])) == want


@pytest.mark.parametrize("mining", [Mining(), Mining(every=5, anchors=7, tile=9, leaf=2)])
def test_against_brute_force(spark, mining):
    draw = np.random.default_rng(5)
    centres = draw.normal(size=(10, 12))
    labels = [0 if i % 3 == 0 else int(draw.integers(0, 10)) for i in range(400)]  # a label with a third of the rows
    rows = [(i, [float(np.float32(x)) for x in centres[lab] + 0.8 * draw.normal(size=12)], lab) for i, lab in enumerate(labels)]
    rows += [(401 + i, rows[i % 3][1], i % 10) for i in range(120)]  # many equal vectors: ties
    want = brute(rows, mining)
    assert want and mined(spark, rows, mining) == want


def test_rows_that_take_no_part_and_odd_rows(spark):
    v = [1.0, 0.5]
    rows = [
        (0, v, 1), (0, v, 1), (50, [0.9, 0.6], 1), (1, [1.0, 0.4], 1), (2, [0.8, 0.3], 2), (2, [0.8, 0.3], 2), (3, [0.7], 3),
        (4, [], 3), (5, [1.0, None], 1), (6, [float("nan"), 1.0], 1), (8, [float("inf"), 1.0], 2), (None, v, 1), (100, None, 1),
        (150, v, None), (9, None, None), (10, [0.7, 0.3, 9.0], 3),
    ]
    mining = Mining(every=50, positives=2)
    assert mined(spark, rows, mining) == brute(rows, mining)


def test_small_and_empty_tables(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 1)]) == []
    assert mined(spark, [(0, [1.0], 1), (50, [1.0], 1)]) == []
    assert mined(spark, [(0, None, 1), (1, [1.0], None)]) == []


def test_components_that_would_overflow_are_refused(spark):
    with pytest.raises(ValueError, match="63 bits"):
        mined(spark, [(0, [1e9, 1e9], 1), (1, [1e9, 1e9], 1)])
