"""Plain versions of the operators, for small inputs."""

import hashlib
import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def shingles(text):
    found = words((text or "").translate({i: i + 32 for i in range(65, 91)}))
    return frozenset(tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))) if found else frozenset()


def components(rows):
    """{row number: smallest id of its class} over rows (doc_id, text), and the number of links."""
    sets = [shingles(t) for _, t in rows]
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    pairs = {(i, j) for group in holders.values() for i in group for j in group if i < j}
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = 0
    for i, j in pairs:
        both = len(sets[i] & sets[j])
        if 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
            links += 1
            parent[root(i)] = root(j)
    names = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            names[root(i)].append(doc)
    return [min(names[root(i)], default=None) if s else rows[i][0] for i, s in enumerate(sets)], links


def without_repeats(rows, window=13):
    """(doc_id, n_words, n_removed, digest) of every row."""
    first = {}
    for doc, text in rows:
        found = words(text)
        for i in range(len(found) - window + 1 if doc is not None else 0):
            key = tuple(found[i : i + window])
            first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, text in rows:
        found = words(text)
        keep = [True] * len(found)
        for i in range(len(found) - window + 1 if doc is not None else 0):
            if first[tuple(found[i : i + window])] < doc:
                keep[i : i + window] = [False] * window
        kept = " ".join(w for w, k in zip(found, keep) if k)
        out.append((doc, len(found), keep.count(False), hashlib.sha256(kept.encode()).hexdigest()))
    return out
