import random

import pytest

from millrace.llm import bpe_counts
from millrace.llm.queries import vocabulary

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(vocabulary())


@pytest.fixture(scope="module")
def counter():
    return bpe_counts.Counter(vocabulary())


def exact(library, texts):
    return [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_given_table(spark, documents, library):
    rows = bpe_counts.token_counts(documents, vocabulary()).collect()
    texts = {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}
    expected = dict(zip(texts, exact(library, list(texts.values()))))
    assert {r.doc_id: r.n_tokens for r in rows} == expected
    assert all(r.n_bytes == len(texts[r.doc_id].encode()) and r.over_limit == (r.n_tokens > 2048) for r in rows)


def test_odd_rows(spark, corpus, odd_rows, library):
    rows = bpe_counts.token_counts(corpus(odd_rows, extra=["n_tokens"]), vocabulary()).collect()
    texts = [t or "" for _, t in odd_rows]
    assert sorted(r.n_tokens for r in rows) == sorted(exact(library, texts))
    assert bpe_counts.token_counts(corpus([]), vocabulary()).count() == 0


def test_random_strings(counter, library):
    pool = [*"aaabbcdeé'stvmrel ll \t\n\x0b\x1c\x1f\x85　 İẞΣςǅ①½一二三ññé😀👍🏽!!..,,--__##0123٣​\x00\x7f﻿KKﬁ"]
    pool += ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "'S", "'LL", "ΑΣ", "aaaa", "ΑΣ Σ."]
    generator = random.Random(1)
    texts = ["".join(generator.choices(pool, k=generator.randint(0, 60))) for _ in range(4_000)]
    assert counter.counts(texts) == exact(library, texts)


def test_long_runs(counter, library):
    texts = ["a" * 5_000, "é" * 3_000, "ab" * 4_000, "the" * 2_000, "!" * 999, "<|endoftext|>" * 3, ""]
    assert counter.counts(texts) == exact(library, texts)


def test_pairs_that_must_go_one_by_one(tmp_path):
    """A table in which a merged pair makes a pair of lower rank."""
    import json

    symbols = bpe_counts.byte_symbols()
    vocab = {s: i for i, s in enumerate(symbols)}
    merges = [["ab", "c"], ["a", "b"], ["c", "a"]]
    for token in ("ab", "abc", "ca"):
        vocab[token] = len(vocab)
    spec = {
        "added_tokens": [],
        "normalizer": {"type": "Sequence", "normalizers": []},
        "pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "Split", "pattern": {"Regex": "[a-z]+"}, "behavior": "Removed", "invert": True}]},
        "model": {"type": "BPE", "vocab": vocab, "merges": merges},
    }
    path = tmp_path / "small.json"
    path.write_text(json.dumps(spec))
    counter = bpe_counts.Counter(str(path))
    library = tokenizers.Tokenizer.from_file(str(path))
    generator = random.Random(2)
    texts = ["".join(generator.choices("abc", k=generator.randint(1, 12))) for _ in range(500)]
    assert counter.table.one_by_one.any()
    assert counter.counts(texts) == exact(library, texts)
