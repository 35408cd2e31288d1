"""Benchmark decontamination: item-sized windows, SimHash within a Hamming radius, exact similarity.

Words are lowered runs of letters and digits. An item of m words is held against windows of m words.
A window that is similar enough must share a shingle with the item, so only windows around shared
shingles are fingerprinted; this drops nothing that the last step would accept. The fingerprints of
the items stand in a multi-index: with one block of bits more than the radius, two fingerprints
within the radius agree in some block. What is within the radius is decided by the exact weighted
similarity: common shingle weight over total shingle weight, where a shingle that stands in k
different items of the whole benchmark weighs 1 / k and any other 1. Items of the same words count
once, so repeated rows change no score. At similarity 0.8 a pair differs in 10 of 64 bits on average, with
a standard deviation of 3; the radius of 22 leaves out 1 in 100,000 of them.

The items are sent to the tasks in blocks of bounded size; a benchmark larger than one block
takes one reading of the documents per block. Weights are counted over all blocks: the shingles of two
items or more are sent along, 16 bytes each, so scores do not depend on how blocks are cut.

Defined cases: an item without words matches nothing; an item of fewer words than a shingle is one
shingle; a null or empty text is clean; null and repeated ids are carried as they are; items with
equal texts all match; empty tables give clean documents. Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.words import NOT_WORD, flat_bytes, mixed, text_blocks, windows, word_hashes

#: Bytes of item texts that go to the tasks at once.
BLOCK_BYTES = 16 << 20


@dataclass(frozen=True)
class Leak:
    """Words of a shingle, least similarity, radius in bits of 64."""

    shingle: int = 5
    similarity: float = 0.8
    radius: int = 22


def lowered(texts: pa.Array) -> pa.Array:
    return pc.utf8_lower(texts.cast(pa.large_string()).fill_null(""))


def fingerprints(features: np.ndarray, weights: np.ndarray, size: int) -> np.ndarray:
    """SimHash of every run of `size` weighted features."""
    bits = np.unpackbits(mixed(features).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    sums = np.cumsum(np.where(bits, weights[:, None], -weights[:, None]), axis=0)
    totals = sums[size - 1 :].copy()
    totals[1:] -= sums[:-size]
    return np.packbits(totals > 1e-9, axis=1, bitorder="little").view(np.uint64).ravel()


class BlockIndex:
    """All fingerprints within a radius, found by agreement in one of radius + 1 blocks of bits."""

    def __init__(self, prints: np.ndarray, radius: int):
        self.prints, self.radius = prints, radius
        edges = np.linspace(0, 64, radius + 2).astype(int)
        self.blocks = [(np.uint64(a), np.uint64((1 << int(b - a)) - 1)) for a, b in zip(edges, edges[1:], strict=False)]
        self.places = []
        for shift, mask in self.blocks:
            values = (prints >> shift) & mask
            self.places.append({int(v): np.flatnonzero(values == v) for v in np.unique(values)})

    def near(self, fingerprint: np.uint64) -> np.ndarray:
        """Numbers of the fingerprints within the radius."""
        none = np.zeros(0, np.int64)
        found = [places.get(int((fingerprint >> shift) & mask), none) for (shift, mask), places in zip(self.blocks, self.places, strict=True)]
        some = np.unique(np.concatenate(found))
        return some[np.bitwise_count(self.prints[some] ^ fingerprint) <= self.radius]


Common = tuple[np.ndarray, np.ndarray]


class Items:
    """A block of benchmark items, ready to be held against texts.

    `common` has the sorted shingles that stand in several items of the benchmark, and in how many.
    """

    def __init__(self, ids: list, texts: list[str], spec: Leak, common: Common | None = None):
        self.spec = spec
        self.common = common or (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        raw, first = flat_bytes(lowered(pa.array(texts, pa.string())))
        hashes, words = word_hashes(raw, first, NOT_WORD)
        spans = [(i, a, b) for i, a, b in zip(ids, words[:-1].tolist(), words[1:].tolist(), strict=True) if b > a]
        self.ids = [i for i, _, _ in spans]
        self.size = np.array([b - a for _, a, b in spans], np.int64)
        self.runs = [windows(hashes[a:b], min(spec.shingle, b - a)) for _, a, b in spans]
        self.sets = [np.unique(r) for r in self.runs]
        every, n = np.unique(np.concatenate(self.sets), return_counts=True) if spans else (hashes[:0], np.zeros(0))
        self.shingles = every
        holders = np.concatenate([np.full(len(s), k) for k, s in enumerate(self.sets)]) if spans else np.zeros(0, np.int64)
        order = np.argsort(np.concatenate(self.sets), kind="stable") if spans else np.zeros(0, np.int64)
        self.holders, self.begin = holders[order], np.concatenate(([0], np.cumsum(n))).astype(np.int64)
        prints = [fingerprints(r, self.weigh(r), len(r))[0] for r in self.runs]
        self.index = {}
        for size in np.unique(self.size).tolist():
            here = np.flatnonzero(self.size == size)
            self.index[size] = (here, BlockIndex(np.array([prints[k] for k in here], np.uint64), spec.radius))

    def weigh(self, shingles: np.ndarray) -> np.ndarray:
        keys, n = self.common
        if not len(keys):
            return np.ones(len(shingles))
        at = np.minimum(np.searchsorted(keys, shingles), len(keys) - 1)
        return np.where(keys[at] == shingles, 1 / n[at], 1.0)

    def similarity(self, item: int, run: np.ndarray) -> float:
        mine, other = self.sets[item], np.unique(run)
        common = self.weigh(np.intersect1d(mine, other, assume_unique=True)).sum()
        return float(common / (self.weigh(mine).sum() + self.weigh(other).sum() - common))

    def matches(self, hashes: np.ndarray, words: np.ndarray) -> Iterator[tuple[int, int, float, int]]:
        """Text, item, similarity and first word of the best window of every match."""
        if not len(self.shingles):
            return
        near: dict[tuple[int, int], list[int]] = {}
        for length in np.unique(np.minimum(self.size, self.spec.shingle)).tolist():
            runs = windows(hashes, length)
            if not len(runs):
                continue
            at = np.minimum(np.searchsorted(self.shingles, runs), len(self.shingles) - 1)
            hit = np.flatnonzero(self.shingles[at] == runs)
            text = np.searchsorted(words, hit, "right") - 1
            inside = hit + length <= words[text + 1]
            for place, of, shingle in zip(hit[inside].tolist(), text[inside].tolist(), at[hit[inside]].tolist(), strict=True):
                for item in self.holders[self.begin[shingle] : self.begin[shingle + 1]].tolist():
                    if min(int(self.size[item]), self.spec.shingle) == length:
                        near.setdefault((of, int(self.size[item])), []).append(place)
        found: dict[tuple[int, int], tuple[float, int]] = {}
        for (of, size), places in near.items():
            low, high = int(words[of]), int(words[of + 1])
            length = min(size, self.spec.shingle)
            here, index = self.index[size]
            reach = min(size, high - low)  # a shorter text is one window
            edge = np.zeros(high - low + 2, np.int64)
            for p in places:  # every window of this size that holds the shingle
                edge[max(0, p + length - reach - low)] += 1
                edge[min(p, high - reach) + 1 - low] -= 1
            starts = np.flatnonzero(np.cumsum(edge) > 0)
            for group in np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1):
                a, b = low + int(group[0]), low + int(group[-1])
                runs = windows(hashes[a : b + reach], length)
                count = reach - length + 1
                prints = fingerprints(runs, self.weigh(runs), count)
                for k, value in enumerate(prints):
                    for item in here[index.near(value)].tolist():
                        score = self.similarity(item, runs[k : k + count])
                        if score >= self.spec.similarity - 1e-12 and score > found.get((of, item), (0.0, 0))[0]:
                            found[of, item] = (score, a + k - low)
        for (of, item), (score, start) in sorted(found.items()):
            yield of, item, score, start


def common_shingles(rows: DataFrame, spec: Leak) -> Common:
    """The sorted shingles that stand in two or more different items, and in how many."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low = pa.RecordBatch.from_arrays([lowered(batch.column(0))], names=["text"])
            for _, raw, first in text_blocks(low):
                hashes, words = word_hashes(raw, first, NOT_WORD)
                spans = [hashes[a:b] for a, b in zip(words[:-1].tolist(), words[1:].tolist(), strict=True) if b > a]
                sets = [np.unique(windows(h, min(spec.shingle, len(h)))).view(np.int64).tolist() for h in spans]
                names = pa.array([xxhash.xxh3_128_digest(h.tobytes()) for h in spans], pa.binary())
                yield pa.RecordBatch.from_arrays([names, pa.array(sets, pa.list_(pa.int64()))], names=["item", "shingles"])

    each = rows.select("text").mapInArrow(run, "item binary, shingles array<long>")
    each = each.groupBy("item").agg(F.first("shingles").alias("shingles")).select(F.explode("shingles").alias("shingle"))
    found = each.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1").toArrow()
    keys, n = found.column("shingle").to_numpy().view(np.uint64), found.column("n").to_numpy()
    order = np.argsort(keys)
    return keys[order], n[order]


def item_blocks(spark: SparkSession, items: DataFrame, spec: Leak) -> Iterator:
    """Broadcasts of the items, each of about BLOCK_BYTES of text, and the one of their common shingles."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    rows = rows.where("text IS NOT NULL")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-size // BLOCK_BYTES)
    if not count:
        return
    common = common_shingles(rows, spec)
    shared = spark.sparkContext.broadcast(common)
    for k in range(count):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k).orderBy("item_id", "text").collect()
        block = Items([r["item_id"] for r in part], [r["text"] for r in part], spec, common)
        block.common = None  # sent once for all blocks
        yield spark.sparkContext.broadcast(block), shared


def _loaded(block) -> Items:
    items, common = (shared.value for shared in block)
    items.common = common
    return items


def _scan(batch: pa.RecordBatch, items: Items) -> Iterator[tuple[pa.RecordBatch, list[tuple[int, int, float, int]]]]:
    at = batch.schema.get_field_index("text")
    low = batch.set_column(at, "text", lowered(batch.column(at)))
    done = 0
    for part, raw, first in text_blocks(low):
        yield batch.slice(done, len(part)), list(items.matches(*word_hashes(raw, first, NOT_WORD)))
        done += len(part)


def _pairs(block) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = _loaded(block)
        for batch in batches:
            for part, found in _scan(batch, items):
                ids = part.column(0).take(pa.array([m[0] for m in found], pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array([items.ids[m[1]] for m in found], pa.int64()),
                        pa.array([m[2] for m in found], pa.float64()),
                        pa.array([m[3] for m in found], pa.int64()),
                        pa.array([int(items.size[m[1]]) for m in found], pa.int64()),
                    ],
                    names=["doc_id", "item_id", "similarity", "first_word", "n_words"],
                )

    return run


def _clean(block) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = _loaded(block)
        for batch in batches:
            for part, found in _scan(batch, items):
                keep = np.ones(len(part), bool)
                keep[[m[0] for m in found]] = False
                yield part.filter(pa.array(keep))

    return run


def leaks(spark: SparkSession, docs: DataFrame, items: DataFrame, spec: Leak = Leak()) -> DataFrame:
    """`doc_id`, `item_id`, `similarity`, `first_word`, `n_words`: the best window of every match."""
    shape = "doc_id long, item_id long, similarity double, first_word long, n_words long"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = spark.createDataFrame([], shape)
    for block in item_blocks(spark, items, spec):
        out = out.unionByName(rows.mapInArrow(_pairs(block), shape))
    return out


def decontaminated(spark: SparkSession, docs: DataFrame, items: DataFrame, spec: Leak = Leak()) -> DataFrame:
    """The documents without a match, with their columns."""
    names = docs.columns
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), F.col("text").cast("string").alias("text"))
    shape = packed.schema
    for block in item_blocks(spark, items, spec):
        packed = packed.mapInArrow(_clean(block), shape)
    return packed.select(*(F.col("row").getField(c).alias(c) for c in names))
