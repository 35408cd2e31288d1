import hashlib
import random

import numpy as np
from brute import without_repeats

from millrace.llm import fm_index
from millrace.llm.fm_index import FMIndex, Repeat, first_documents


def result(spark, frame, spec=Repeat()):
    rows = fm_index.without_repeats(spark, frame, spec).collect()
    digest = [(r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in rows]
    return sorted(digest, key=str)


def test_given_table(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert result(spark, documents) == sorted(without_repeats(rows), key=str)


def test_odd_rows(spark, corpus, odd_rows):
    shared = " ".join(f"s{i}" for i in range(30))
    rows = [*odd_rows, (30, f"a b {shared} c"), (31, f"{shared} d"), (None, shared), (31, f"e {shared}"), (30, f"a b {shared} c"), (29, "s1 s2 s3 s4 s5 s6 s7 s8 s9 s10 s11 s12 s13 s14")]
    assert result(spark, corpus(rows, extra=["part", "windows"])) == sorted(without_repeats(rows), key=str)


def crowded(n):
    """One line in all texts, with other words around it, and runs of a single word."""
    rng = random.Random(5)
    line = "this very line stands in each and every one of all these many texts here"
    rows = [(i, " ".join([*(f"w{rng.randrange(9)}" for _ in range(rng.randint(0, 30))), line, *(["z"] * rng.randint(0, 40))])) for i in range(n)]
    rng.shuffle(rows)
    return rows


def test_common_line(spark, corpus):
    rows = crowded(80)
    assert result(spark, corpus(rows)) == sorted(without_repeats(rows), key=str)


def test_crowded_anchors_by_single_windows(spark, corpus):
    rows = crowded(60)
    assert result(spark, corpus(rows), Repeat(most=3)) == sorted(without_repeats(rows), key=str)


def test_small_shards(spark, corpus, monkeypatch):
    monkeypatch.setattr(fm_index, "SHARD_SYMBOLS", 40)
    monkeypatch.setattr(fm_index, "BUCKET_BYTES", 500)
    rows = crowded(50)
    assert result(spark, corpus(rows)) == sorted(without_repeats(rows), key=str)


def test_empty_table(spark, corpus):
    assert fm_index.without_repeats(spark, corpus([])).count() == 0


def test_backward_search_counts():
    generator = np.random.default_rng(2)
    text = np.concatenate((generator.integers(1, 4, 400), [0]))
    index = FMIndex(text, 4, 8)
    for start in range(0, 390, 7):
        pattern = text[start : start + 5]
        low, high = np.array([0]), np.array([len(text)])
        for symbol in pattern[::-1]:
            low, high = index.step(np.array([symbol]), low, high)
        places = [i for i in range(len(text)) if list(text[i : i + 5]) == list(pattern)]
        assert sorted(index.suffixes[low[0] : high[0]].tolist()) == places


def test_first_documents():
    generator = np.random.default_rng(1)
    texts = [" ".join(f"w{x}" for x in generator.integers(0, 3, generator.integers(4, 25))) for _ in range(60)]
    docs = generator.integers(0, 40, 60)
    least = {}
    for text, doc in zip(texts, docs):
        w = text.split()
        for i in range(len(w) - 3):
            least[tuple(w[i : i + 4])] = min(least.get(tuple(w[i : i + 4]), 99), doc)
    for text, firsts in zip(texts, first_documents(texts, docs, 4)):
        w = text.split()
        assert firsts.tolist() == [least[tuple(w[i : i + 4])] for i in range(len(w) - 3)]
