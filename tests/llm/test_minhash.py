import random

import pytest
from brute import components, shingles

from millrace.llm import minhash


def result(spark, frame):
    rows = minhash.components(spark, frame).collect()
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows), key=str)


def expected(rows):
    named, _ = components(rows)
    return sorted(((d, len(shingles(t)), c, d == c) for (d, t), c in zip(rows, named)), key=str)


def test_given_table(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert result(spark, documents) == expected(rows)


def test_odd_rows(spark, corpus, odd_rows):
    assert result(spark, corpus(odd_rows, extra=["node", "kept", "bands"])) == expected(odd_rows)


def near_copies(n, seed=1):
    """A group of copies with few and many changes, which the test of classes must tell apart."""
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for doc in range(n):
        text = list(base)
        for _ in range(rng.randint(0, 5)):
            text[rng.randrange(len(text))] = f"x{rng.randrange(10**6)}"
        rows.append((doc, " ".join(text[rng.randint(0, 6) : len(text) - rng.randint(0, 6)])))
    rng.shuffle(rows)
    return rows


def test_group_of_near_copies(spark, corpus):
    rows = near_copies(150)
    assert components(rows)[1] > 500
    assert result(spark, corpus(rows)) == expected(rows)


def test_chain_of_links(spark, corpus):
    """Each text is like the next, the ends are not alike."""
    rows = [(100 - k, " ".join(f"c{i}" for i in range(4 * k, 4 * k + 100))) for k in range(12)]
    assert result(spark, corpus(rows)) == expected(rows)
    assert {r[2] for r in result(spark, corpus(rows))} == {89}


def test_empty_table(spark, corpus):
    assert minhash.components(spark, corpus([])).count() == 0


@pytest.mark.parametrize("extra", [[], ["kept", "node"]])
def test_stage_keeps_one(spark, corpus, odd_rows, extra):
    text = " ".join(f"t{i}" for i in range(60))
    rows = [*odd_rows, (20, text), (21, text), (22, text + " more"), (20, text)]
    frame = corpus(rows, extra)
    out = minhash.deduplicated(spark, frame)
    assert out.columns == frame.columns
    ids = sorted((r.doc_id for r in out.select("doc_id").collect()), key=str)
    assert ids == sorted([1, 2, 3, 4, 6, 7, 8, 20, None, None], key=str)


def test_circulant_estimates_similarity():
    import numpy as np

    near = minhash.Near(bands=128, rows=1)
    generator = np.random.default_rng(3)
    common, a, b = (np.unique(generator.integers(0, 2**63, n).astype(np.uint64)) for n in (800, 100, 100))
    keys = minhash.Circulant(near).bands([np.concatenate((common, a)), np.concatenate((common, b))])
    assert abs((keys[0] == keys[1]).mean() - 0.8) < 0.1
