import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from millrace.llm import divergence
from millrace.llm.divergence import Audit, accumulate, audit

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, spec):
    """Every group against every other over all kept terms."""
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        terms = TERM.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))
        counts[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    kept = {lang: sorted(t for t, n in c.items() if n >= spec.least) for lang, c in docs.items()}
    whole = defaultdict(Counter)
    for (lang, _), c in counts.items():
        whole[lang].update(c)

    def shares(lang, c):
        total = sum(c[t] for t in kept[lang]) + spec.smooth * len(kept[lang])
        return [1 + spec.unit * (c[t] + spec.smooth) // total for t in kept[lang]]

    out = []
    p = {g: shares(g[0], c) for g, c in counts.items()}
    for (lang, source), mine in p.items():
        pairs = [(-sum(abs(a - b) for a, b in zip(mine, p[g])), g[1].encode()) for g in p if g[0] == lang and g[1] != source]
        q = shares(lang, whole[lang])
        terms = [(b - a, t.encode()) for a, b, t in zip(mine, q, kept[lang]) if a > b and counts[lang, source][t]]
        for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[: spec.top])):
            out += [(lang, source, part, item.decode(), -value, rank + 1) for rank, (value, item) in enumerate(found)]
    return sorted(out)


def audited(spark, corpus, rows, spec):
    found = audit(spark, corpus(rows, extra=("term", "place", "cell", "p")), spec)
    assert dict(found.dtypes) == {"lang": "string", "source": "string", "part": "string", "item": "string", "value": "bigint", "rank": "int"}
    return sorted(map(tuple, found.collect()))


def made(count, draw):
    words = [f"{c}{d}" for c in "abcdefgh" for d in ("", "é", "Xy", "你")]
    rows = []
    for i in range(count):
        lang = ("en", "de", None)[int(draw.integers(0, 3))]
        source = "hot" if i % 3 == 0 else f"s{int(draw.integers(0, 7))}"
        low = int(draw.integers(0, 20))
        text = " ".join(str(w) for w in draw.choice(words[low:], int(draw.integers(0, 30))))
        rows.append((i, text, lang, source))
    return rows


@pytest.mark.parametrize("cell", [10_000, 40])
def test_against_brute_force(spark, corpus, cell):
    rows = made(150, np.random.default_rng(2))
    rows += [(500, "solo", "fr", "one"), (501, None, "en", "silent"), (502, "rare", "en", "odd"), (503, "3 - 4", "en", None), (0, "ab", "de", "hot")]
    spec = Audit(least=4, top=6, cell=cell)
    want = brute(rows, spec)
    assert len(want) > 100
    assert audited(spark, corpus, rows, spec) == want


def test_no_kept_terms_small_and_empty_tables(spark, corpus):
    rows = [(1, "a b", "en", "x"), (2, "a", "en", "y"), (3, None, None, None)]
    spec = Audit()
    assert audited(spark, corpus, rows, spec) == brute(rows, spec) == [("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]
    assert audited(spark, corpus, [], spec) == []


def test_odd_and_long_texts(spark, corpus, odd_rows, monkeypatch):
    monkeypatch.setattr(divergence, "PIECE_BYTES", 100)
    rows = [(i, t, "en", f"s{n % 3}") for n, (i, t) in enumerate(odd_rows)]
    spec = Audit(least=1)
    assert audited(spark, corpus, rows, spec) == brute(rows, spec)


def test_pieces_and_instalments_change_nothing(monkeypatch):
    text = ("ab Cd é " * 500).encode()
    monkeypatch.setattr(divergence, "PIECE_BYTES", 64)
    pieces = list(divergence._pieces(text))
    assert len(pieces) > 20
    assert [t for p in pieces for t in divergence._TERM.findall(p)] == divergence._TERM.findall(text)
    assert list(divergence._pieces(b"x" * 1000)) == [b"x" * 1000]


def test_accumulated_rows_are_the_sums_over_all_terms():
    draw = np.random.default_rng(4)
    sources, terms = 9, 60
    has = draw.random((terms, sources)) < 0.3
    has[0] = True
    z = draw.integers(1, 50, sources)
    full = np.where(has, draw.integers(1, 900, (terms, sources)), z)
    kept = has.any(axis=1)
    full, has = full[kept], has[kept]
    term, place = np.nonzero(has)
    first = np.concatenate(([0], np.cumsum(has.sum(axis=1))))
    got = np.zeros((sources, sources), np.int64)
    for a, row in accumulate(place, full[term, place], first, z):
        got[a] = row
    for a in range(sources):
        for b in range(sources):
            if a != b:
                want = np.abs(full[:, a] - full[:, b]).sum()
                assert got[a, b] + got[b, a] + len(full) * abs(z[a] - z[b]) == want
