"""Token counts of a byte-pair encoding with word ends, merged for many words at once.

The pre-tokens of a block are laid end to end in one ragged array of symbols. In every step each
pre-token finds its lowest-ranked pair, all its places are merged at the same time, and pre-tokens
without a pair leave; what is left are the tokens. Only distinct pre-tokens of a block are merged.

Defined cases: a null or empty text has 0 tokens and 0 bytes; a null id is carried as it is;
repeated rows give repeated rows; an empty table gives an empty result; only the id and the text
are read. The special strings of the vocabulary stand for one token each, as the library has it.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The white space of the library's patterns (Python's own has U+001C to U+001F too).
WHITE = "\\t\\n\\x0b\\x0c\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_RARE = re.compile("[\\x1c-\\x1f]")
_WHITE = re.compile(f"[{WHITE}]+")

#: Texts are counted in blocks of about so many characters.
BLOCK_CHARS = 2 << 20


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    names = {b: chr(b) for b in plain}
    for b in range(256):
        names.setdefault(b, chr(256 + len(names) - len(plain)))
    return [names[b] for b in range(256)]


class MergeTable:
    """The ranks of a vocabulary file, as sorted arrays."""

    def __init__(self, file: str):
        with open(file, encoding="utf-8") as lines:
            spec = json.load(lines)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("byte_fallback") or model.get("ignore_merges"):
            raise ValueError("only plain BPE files are counted")
        self.ids, self.end = model["vocab"], model.get("end_of_word_suffix") or ""
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([self.ids[a] for a, _ in pairs], np.int64)
        right = np.array([self.ids[b] for _, b in pairs], np.int64)
        self.size = max(self.ids.values()) + 1
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order
        self.made = np.array([self.ids[a + b] for a, b in pairs], np.int64)
        made_at = {int(made): rank for rank, made in enumerate(self.made)}
        late = [made_at.get(int(a), -1) > r or made_at.get(int(b), -1) > r for r, (a, b) in enumerate(zip(left, right, strict=True))]
        self.one_by_one = np.array(late, bool)
        names = byte_symbols()
        self.inner = np.array([self.ids[n] for n in names], np.int64)
        self.last = np.array([self.ids[n + self.end] for n in names], np.int64)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        steps = spec["normalizer"]["normalizers"]
        self.normal = [(s["type"], s.get("pattern", {}).get("Regex"), s.get("content")) for s in steps]
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        self.pattern = regex.compile(split["pattern"]["Regex"].replace(r"\s", WHITE))

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of every pair; the number of merges where there is none."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], len(self.keys))


def merged_counts(table: MergeTable, words: list[bytes]) -> np.ndarray:
    """Tokens of each pre-token."""
    sizes = np.array([len(w) for w in words], np.int64)
    out = np.minimum(sizes, 1)
    raw = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum(sizes)
    symbols = table.inner[raw]
    symbols[ends[sizes > 0] - 1] = table.last[raw[ends[sizes > 0] - 1]]
    of = np.repeat(np.arange(len(words)), sizes)
    live = sizes[of] > 1
    symbols, of = symbols[live], of[live]
    none = len(table.keys)
    ranks = np.full(len(symbols), none, np.int64)
    if len(symbols) > 1:
        ranks[:-1] = np.where(of[:-1] == of[1:], table.rank(symbols[:-1], symbols[1:]), none)
    while len(symbols):
        first = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
        length = np.diff(np.concatenate((first, [len(of)])))
        low = np.minimum.reduceat(ranks, first)
        done = low == none
        if done.any():
            out[of[first[done]]] = length[done]
            keep = np.repeat(~done, length)
            symbols, of, ranks = symbols[keep], of[keep], ranks[keep]
            length, low = length[~done], low[~done]
            if not len(symbols):
                break
        best = np.repeat(low, length)
        at = np.flatnonzero(ranks == best)
        # Of places that overlap ("aaa") every second one counts, from the left.
        run = np.concatenate(([True], (np.diff(at) > 1) | (of[at[1:]] != of[at[:-1]])))
        begin = np.maximum.accumulate(np.where(run, at, 0))
        at = at[(at - begin) % 2 == 0]
        alone = table.one_by_one[best[at]]
        if alone.any():
            at = at[~alone | np.concatenate(([True], of[at[1:]] != of[at[:-1]]))]
        symbols[at] = table.made[best[at]]
        gone = np.zeros(len(symbols), bool)
        gone[at + 1] = True
        changed = np.zeros(len(symbols), bool)
        changed[at] = True
        changed[np.maximum(at - 1, 0)] = True
        symbols, of, ranks, changed = symbols[~gone], of[~gone], ranks[~gone], changed[~gone]
        new = np.flatnonzero(changed)
        inside = new[new + 1 < len(of)]
        ranks[new] = none
        inside = inside[of[inside] == of[inside + 1]]
        ranks[inside] = table.rank(symbols[inside], symbols[inside + 1])
    return out


class Counter:
    """Counts the tokens of texts; keeps the counts of the words it has met, up to a bound."""

    KEPT = 300_000

    def __init__(self, file: str):
        self.table = MergeTable(file)
        self.special = regex.compile("|".join(map(regex.escape, self.table.special))) if self.table.special else None
        self.known: dict[str, int] = {}

    def normal(self, text: str) -> str:
        for kind, pattern, content in self.table.normal:
            if kind == "NFC":
                text = text if text.isascii() else unicodedata.normalize("NFC", text)
            elif kind == "Lowercase":
                text = text.lower() if "Σ" not in text else "".join(map(str.lower, text))
            elif pattern != r"\s+":
                text = regex.sub(pattern, content, text)
        return text

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of every text. White space only parts words, so each text is split at it once
        and every distinct word is cut into pre-tokens and merged a single time."""
        split, extra = [], []
        for text in texts:
            n = 0
            if self.special and "<|" in text:
                parts = self.special.split(text)
                n, text = len(parts) - 1, " ".join(parts)
            text = self.normal(text)
            split.append(_WHITE.sub(" ", text).split(" ") if _RARE.search(text) else text.split())
            extra.append(n)
        new = list(set().union(*split) - self.known.keys()) if split else []
        if len(self.known) + len(new) > self.KEPT:
            self.known.clear()
            new = list(set().union(*split))
        cut = [word if word.isalpha() else self.table.pattern.findall(word) for word in new]
        whole = {c for c in cut if type(c) is str}
        parts = whole.union(*(c for c in cut if type(c) is list))
        tokens = dict(zip(parts, merged_counts(self.table, [p.encode() for p in parts]).tolist(), strict=True))
        for word, c in zip(new, cut, strict=True):
            self.known[word] = tokens[c] if type(c) is str else sum(map(tokens.__getitem__, c))
        known = self.known
        return [n + sum(map(known.__getitem__, words)) for n, words in zip(extra, split, strict=True)]


def token_counts(docs: DataFrame, file: str, limit: int = 2048, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id`, `n_bytes`, `n_tokens` and `over_limit` of every document.

    `file` is a path that the executors can open (a file of an installed package, or one shipped
    by the job).
    """

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(file)
        for batch in batches:
            texts = batch.column(1).fill_null("").to_pylist()
            tokens: list[int] = []
            low = 0
            while low < len(texts):
                high, chars = low, 0
                while high < len(texts) and (high == low or chars + len(texts[high]) <= BLOCK_CHARS):
                    chars += len(texts[high])
                    high += 1
                tokens += counter.counts(texts[low:high])
                low = high
            columns = [batch.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(tokens, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    out = rows.mapInArrow(counted, "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
