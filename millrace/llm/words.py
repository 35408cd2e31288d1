"""Words, word hashes and shingles of whole texts as ragged numpy arrays, inside Spark tasks.

A word is a run of bytes that are neither space nor U+0009 to U+000D. Hashes have 64 bits: a
polynomial of the word's bytes, then mixed; equal words always have equal hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts are worked on in blocks of about so many bytes; one longer text is a block of its own.
BLOCK_BYTES = 2 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def text_blocks(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch with the bytes of their texts and each text's first byte (null: empty)."""
    texts = batch.column(batch.schema.get_field_index(column)).cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    raw, first = flat_bytes(texts)
    cuts, at = [0], 0
    while at < len(texts):
        at = max(at + 1, int(np.searchsorted(first, first[at] + BLOCK_BYTES, "right")) - 1)
        cuts.append(min(at, len(texts)))
    for low, high in zip(cuts, cuts[1:], strict=False):
        yield batch.slice(low, high - low), raw[first[low] : first[high]], first[low : high + 1] - first[low]


def flat_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a large_string array without nulls, and the first byte of each text, end included."""
    _, ends, data = texts.buffers()
    first = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(first), np.int64)
    return np.frombuffer(data, np.uint8)[first[0] : first[-1]], first - first[0]


def separators(extra: bytes = b"") -> np.ndarray:
    """Table of the bytes that end a word."""
    table = np.zeros(256, bool)
    table[[0x20, *range(0x09, 0x0E), *extra]] = True
    return table


SPACE = separators()
#: Every byte of ASCII that is no letter and no digit.
NOT_WORD = separators(bytes(b for b in range(128) if not chr(b).isalnum()))


def word_spans(raw: np.ndarray, first: np.ndarray, apart: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of every word, and the number of the first word of each text, end included."""
    inside = ~apart[raw]
    cut = np.zeros(len(raw) + 1, bool)
    cut[first] = True
    before = np.concatenate(([False], inside[:-1])) if len(raw) else inside
    after = np.concatenate((inside[1:], [False])) if len(raw) else inside
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, first)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    if n:
        steps[0] = 1
    return np.multiply.accumulate(steps)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of every span."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    power = _powers(_BASE, len(raw))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power, out=sums[1:])
    back = _powers(_BASE_INVERSE, len(raw))
    return mixed((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def word_hashes(raw: np.ndarray, first: np.ndarray, apart: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the number of the first word of each text, end included."""
    starts, ends, words = word_spans(raw, first, apart)
    return span_hashes(raw, starts, ends), words


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of `size` hashes (also of runs that cross texts)."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    factor = 0xD6E8FEB86659FD93
    for i in range(size):
        total += hashes[i : i + n] * np.uint64(factor)
        factor = factor * 0xD6E8FEB86659FD93 % (1 << 64)
    return mixed(total + np.uint64(size))


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    """The bytes with A to Z in lower case."""
    upper = (raw >= 65) & (raw <= 90)
    return raw + upper.astype(np.uint8) * np.uint8(32)


def shingle_sets(hashes: np.ndarray, words: np.ndarray, size: int = 5) -> list[np.ndarray]:
    """Sorted distinct shingles of each text; fewer words than `size` make one shingle, none makes none."""
    whole = windows(hashes, size)
    sets = []
    for low, high in zip(words[:-1].tolist(), words[1:].tolist(), strict=True):
        if high - low >= size:
            sets.append(np.unique(whole[low : high - size + 1]))
        elif high > low:
            sets.append(windows(hashes[low:high], high - low))
        else:
            sets.append(hashes[:0])
    return sets
