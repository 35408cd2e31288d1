import random
import re

import numpy as np
import pytest

from millrace.llm import decontaminate
from millrace.llm.decontaminate import BlockIndex, Items, Leak


def plain(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def similarity(item, run, weights):
    a = {tuple(item[i : i + 5]) for i in range(max(1, len(item) - 4))}
    b = {tuple(run[i : i + 5]) for i in range(max(1, len(run) - 4))}
    weight = lambda s: sum(1 / max(1, weights.get(x, 1)) for x in s)
    return weight(a & b) / weight(a | b)


def brute(rows, items):
    """{(doc, item): best similarity} over all windows of the item's size."""
    weights = {}
    for _, text in items:
        w = plain(text)
        for s in {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else ():
            weights[s] = weights.get(s, 0) + 1
    out = {}
    for doc, text in rows:
        w = plain(text)
        for item, other in items:
            m = plain(other)
            if not m or not w:
                continue
            size = min(len(m), len(w))
            best = max(similarity(m, w[i : i + size], weights) for i in range(len(w) - size + 1))
            if best >= 0.8 - 1e-12:
                out[doc, item] = best
    return out


def frame_of(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def found(spark, docs, items):
    rows = decontaminate.leaks(spark, docs, items).collect()
    return {(r.doc_id, r.item_id): r.similarity for r in rows}


def test_planted_passages(spark, corpus):
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(400)}"
    items = [(i, " ".join(word() for _ in range(rng.randint(12, 60)))) for i in range(25)]
    items += [(90, items[0][1]), (91, "Short Item here"), (92, ""), (93, None)]
    rows = []
    for doc in range(60):
        text = [word() for _ in range(rng.randint(0, 80))]
        if doc % 3:
            leak = plain(items[doc % 25][1])
            for _ in range(doc % 4):  # some words changed, added or left out
                at = rng.randrange(len(leak))
                leak[at : at + rng.randint(0, 1)] = [word()] * rng.randint(0, 1)
            at = rng.randint(0, len(text))
            text[at:at] = leak
        rows.append((doc, ", ".join(text).upper() if doc % 2 else " ".join(text)))
    rows.append((70, "a short item, here it is"))
    got, expected = found(spark, corpus(rows), frame_of(spark, items)), brute(rows, items)
    assert got.keys() == expected.keys() and len(got) > 15
    assert all(abs(got[k] - expected[k]) < 1e-9 for k in got)


def test_given_tables(spark, documents, data):
    items = spark.read.parquet(f"{data}/benchmark.parquet")
    rows = [(r.doc_id, " ".join(plain(r.text))) for r in documents.select("doc_id", "text").collect()]
    texts = [(r.item_id, " ".join(plain(r.text))) for r in items.collect()]
    whole = {(d, i) for d, t in rows for i, x in texts if f" {x} " in f" {t} "}
    got = found(spark, documents, items)
    assert whole and whole <= got.keys()
    kept = decontaminate.decontaminated(spark, documents, items)
    assert kept.columns == documents.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in rows} - {d for d, _ in got}


def test_odd_rows(spark, corpus, odd_rows):
    frame = corpus(odd_rows, extra=["item_id", "row"])
    items = frame_of(spark, [(1, "one"), (None, "words without an id stand here for the test of nulls")])
    rows = decontaminate.leaks(spark, frame, items).collect()
    assert sorted(((r.doc_id, r.item_id) for r in rows), key=str) == sorted([(4, 1), (5, 1), (5, 1), (None, None)], key=str)
    out = decontaminate.decontaminated(spark, frame, items)
    assert out.columns == frame.columns and out.count() == len(odd_rows) - 4
    nothing = frame_of(spark, [])
    assert decontaminate.leaks(spark, frame, nothing).count() == 0
    assert decontaminate.decontaminated(spark, frame, nothing).count() == len(odd_rows)
    assert decontaminate.leaks(spark, corpus([]), items).count() == 0


def test_items_in_blocks(spark, documents, data, monkeypatch):
    items = spark.read.parquet(f"{data}/benchmark.parquet")
    whole = found(spark, documents, items)
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 2_000)
    parts = found(spark, documents, items)
    assert parts.keys() == whole.keys()


def test_repeated_rows_change_nothing(spark, corpus):
    words = [f"q{i}" for i in range(40)]
    edited = corpus([(1, "so " + " ".join([*words[:-1], "other"]) + " it is")])
    once = found(spark, edited, frame_of(spark, [(0, " ".join(words))]))
    often = [(i, (", " if i % 2 else " ").join(words)) for i in range(10)]
    assert once == {(1, 0): pytest.approx(35 / 37)}
    assert found(spark, edited, frame_of(spark, often)) == {(1, i): pytest.approx(35 / 37) for i in range(10)}
    assert decontaminate.decontaminated(spark, edited, frame_of(spark, often)).count() == 0


def test_scores_do_not_depend_on_blocks(spark, corpus, monkeypatch):
    """Items that share half of their words: the weights are those of the whole benchmark."""
    head = [f"h{i}" for i in range(20)]
    items = [(i, " ".join(head + [f"t{i}x{k}" for k in range(20)])) for i in range(12)]
    rows = [(i, text.rsplit(" ", 1 + i % 4)[0] + " some end") for i, text in items]
    rows += [(100 + i, text.replace("h3", "g3")) for i, text in items]
    whole = found(spark, corpus(rows), frame_of(spark, items))
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 300)
    parts = found(spark, corpus(rows), frame_of(spark, items))
    assert parts == whole and len(set(whole.values())) > 2
    assert whole == {k: pytest.approx(v) for k, v in brute(rows, items).items()}


@pytest.mark.parametrize("radius", [0, 3, 22])
def test_index_finds_all_within_radius(radius):
    generator = np.random.default_rng(radius)
    prints = generator.integers(0, 2**63, 300).astype(np.uint64)
    index = BlockIndex(prints, radius)
    for k in range(60):
        flips = generator.choice(64, generator.integers(0, 30), replace=False)
        query = prints[k] ^ np.bitwise_or.reduce(np.array([1], np.uint64) << np.append(flips, 0).astype(np.uint64)) if len(flips) else prints[k]
        expected = np.flatnonzero(np.bitwise_count(prints ^ query) <= radius)
        assert index.near(query).tolist() == expected.tolist()


def test_fingerprints_of_similar_texts_are_near():
    rng = random.Random(1)
    far = []
    for _ in range(300):
        words = [f"v{rng.randrange(9_999)}" for _ in range(45)]
        other = list(words)
        other[rng.randrange(5, 40)] = "other"  # similarity 0.78 to 0.8
        items = Items([0, 1], [" ".join(words), " ".join(other)], Leak())
        a, b = (decontaminate.fingerprints(r, np.ones(len(r)), len(r))[0] for r in items.runs)
        far.append(int(np.bitwise_count(a ^ b)))
    assert max(far) <= Leak().radius and np.mean(far) > 5
