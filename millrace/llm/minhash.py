"""Near-duplicate documents: circulant MinHash, banding, exact Jaccard on whole shingle sets.

Two permutations of SLOTS places make all signature coordinates: the first scatters a shingle's slot,
the second, shifted circularly by k, gives coordinate k. Documents are first brought together by
equal shingle sets ("nodes", named by a 128-bit hash), so copies cost nothing further. Nodes that
share a band are candidates. Links are not listed; what is asked for is the classes, so:

1. Every node is compared with one centre, the best connected node of its bands. A group of
   thousands of near copies takes one comparison each.
2. What is still apart in a band is compared exactly, except pairs that cannot be linked: by size,
   by the shingles that a node shares with no other open node, and by what each shares with their
   common centre. These bounds are exact, so no link is lost. Copies with many changes of their
   own drop out here without being compared.

A link of Jaccard 0.85 is missed by all 24 bands of 5 coordinates with probability 8e-7.

Defined cases: a text without words is alone in its class; a null id is alone and kept where its
text has no words, else it belongs to its class, which is named by the smallest non-null id; a row
is kept if its id names its class (rows of a class without any non-null id are all kept). Repeated rows
are one document. An empty table gives an empty result. Only the id and the text are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.tables import written
from millrace.llm.words import lower_ascii, mixed, shingle_sets, text_blocks, word_hashes

SLOTS = 1 << 20


@dataclass(frozen=True)
class Near:
    """Shingle length, least similarity in percent, bands and coordinates per band, seed."""

    shingle: int = 5
    percent: int = 85
    bands: int = 24
    rows: int = 5
    seed: int = 6


class Circulant:
    """All signature coordinates from two permutations."""

    def __init__(self, near: Near):
        generator = np.random.default_rng(near.seed)
        self.near = near
        self.scatter = generator.permutation(SLOTS).astype(np.int64)
        once = generator.permutation(SLOTS).astype(np.int32)
        self.ring = np.concatenate((once, once))

    def bands(self, sets: list[np.ndarray]) -> np.ndarray:
        """One key per band and non-empty set."""
        sizes = np.array([len(s) for s in sets], np.int64)
        first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        slots = self.scatter[(np.concatenate(sets) % np.uint64(SLOTS)).astype(np.int64)]
        keys = np.empty((len(sets), self.near.bands), np.uint64)
        for band in range(self.near.bands):
            key = np.full(len(sets), band + 1, np.uint64)
            for k in range(band * self.near.rows, (band + 1) * self.near.rows):
                shifted = self.ring[SLOTS - k :]  # place i of this view is permuted place i - k
                low = np.minimum.reduceat(shifted[slots], first)
                key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + low.astype(np.uint64))
            keys[:, band] = key
        return keys


def node_name(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def _sets(batch: pa.RecordBatch, shingle: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for part, raw, first in text_blocks(batch):
        hashes, words = word_hashes(lower_ascii(raw), first)
        yield part, shingle_sets(hashes, words, shingle)


def _signed(near: Near) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        circulant = Circulant(near)
        for batch in batches:
            for part, sets in _sets(batch, near.shingle):
                full = [s for s in sets if len(s)]
                names = iter([node_name(s) for s in full])
                keys = circulant.bands(full).view(np.int64) if full else np.zeros((0, near.bands), np.int64)
                rows = iter(keys.tolist())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([next(names) if len(s) else None for s in sets], pa.binary()),
                        pa.array([next(rows) if len(s) else None for s in sets], pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "n_shingles", "node", "bands"],
                )

    return run


def signatures(docs: DataFrame, near: Near = Near()) -> DataFrame:
    """`doc_id`, `n_shingles`, `node` (name of the shingle set, null if it is empty) and `bands`."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_signed(near), "doc_id long, n_shingles long, node binary, bands array<long>")


COMPARED = "a binary, b binary, both long, size_a long, size_b long"


def _compared(near: Near) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of rows (a, b, text_a, text_b): the common shingles and the sizes of the two sets."""

    def sets_of(texts: pa.Array) -> list[np.ndarray]:
        batch = pa.RecordBatch.from_arrays([texts], names=["text"])
        return [s for _, sets in _sets(batch, near.shingle) for s in sets]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), 256):
                part = batch.slice(low, 256)
                sides = list(zip(sets_of(part.column(2)), sets_of(part.column(3)), strict=True))
                both = [len(np.intersect1d(a, b, assume_unique=True)) for a, b in sides]
                numbers = (both, [len(a) for a, _ in sides], [len(b) for _, b in sides])
                columns = [part.column(0), part.column(1), *(pa.array(n, pa.int64()) for n in numbers)]
                yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "both", "size_a", "size_b"])

    return run


class Grouping:
    """Classes of nodes, refined by rounds of verified links; every table is written once."""

    def __init__(self, spark: SparkSession, docs: DataFrame, near: Near):
        self.spark, self.docs, self.near = spark, docs, near
        self.signed = written(spark, signatures(docs, near), "signatures")
        named = self.signed.where("node IS NOT NULL")
        nodes = named.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("size"))
        self.nodes = written(spark, nodes, "nodes")
        bands = named.groupBy("node").agg(F.first("bands").alias("bands"))
        keys = bands.select("node", F.explode("bands").alias("band"))
        shared = keys.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
        self.members = written(spark, keys.join(shared, "band"), "members")
        self.texts = written(spark, self.named_texts(), "texts")
        self.links = spark.createDataFrame([], "a binary, b binary")

    def named_texts(self) -> DataFrame:
        """`node` and the text of one of its documents, for all nodes that share a band.

        Texts are found by id. Where ids repeat or are null, a text is named anew instead.
        """
        near = self.near
        keyed = self.nodes.join(self.members.select("node").distinct(), "node", "left_semi").select("doc_id", "node")
        rows = self.docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        if self.signed.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").isEmpty():
            return rows.join(keyed, "doc_id").select("node", "text")

        def name(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part, sets in _sets(batch, near.shingle):
                    names = pa.array([node_name(s) if len(s) else None for s in sets], pa.binary())
                    yield pa.RecordBatch.from_arrays([names, part.column(0)], names=["node", "text"])

        found = rows.select("text").mapInArrow(name, "node binary, text string")
        return found.join(keyed.select("node"), "node", "left_semi").groupBy("node").agg(F.min("text").alias("text"))

    def compared(self, pairs: DataFrame, name: str) -> DataFrame:
        """Pairs (a, b) with their exact numbers; adds the links among them. Texts travel and are
        shingled again: they compress well, hashes do not."""
        sides = pairs.join(self.texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
        sides = sides.join(self.texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
        found = sides.select("a", "b", "text_a", "text_b").mapInArrow(_compared(self.near), COMPARED)
        found = written(self.spark, found, name)
        linked = F.col("both") * 100 >= (F.col("size_a") + F.col("size_b") - F.col("both")) * self.near.percent
        self.links = self.links.union(found.where(linked).select("a", "b"))
        return found

    def classes(self) -> DataFrame:
        """`node`, `root` for every node with a link; the root is the smallest name of the class.

        Smallest neighbours are passed on until nothing changes, with every node also taking the
        root of its root, so rounds grow with the logarithm of a chain's length. Each round is a
        table; the driver sees counts only.
        """
        edges = written(
            self.spark,
            self.links.union(self.links.select("b", "a")).distinct().where("a <> b").toDF("node", "other"),
            "edges",
        )
        roots = edges.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("root"))
        roots = written(self.spark, roots, "roots")
        while True:
            other = roots.select(F.col("node").alias("other"), F.col("root").alias("other_root"))
            offered = edges.join(other, "other").groupBy("node").agg(F.min("other_root").alias("offer"))
            # A root that hears of a smaller one takes its whole class along.
            moved = roots.join(offered, "node").groupBy("root").agg(F.min("offer").alias("best"))
            moved = moved.select("root", F.least("root", "best").alias("next"))
            near = written(self.spark, roots.join(moved, "root").select("node", "root", "next"), "roots")
            beyond = near.select(F.col("node").alias("next"), F.col("next").alias("after"))
            step = near.join(beyond, "next").select("node", "after", (F.col("after") < F.col("root")).alias("new"))
            step = written(self.spark, step, "roots")
            roots = step.select("node", F.col("after").alias("root"))
            if step.where("new").isEmpty():
                return roots

    def open_members(self) -> DataFrame:
        """Members of the bands whose nodes are not all in one class yet, with their class."""
        roots = self.classes()
        named = self.members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        named = written(self.spark, named, "open")
        spans = named.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high"))
        return named.join(spans.where("low <> high").select("band"), "band")

    def star(self) -> None:
        """Compare every node with the best connected node of its bands."""
        scores = self.members.groupBy("node").agg(F.sum("n").alias("score"))
        scored = self.members.join(scores, "node")
        best = scored.groupBy("band").agg(F.max(F.struct("score", "node")).alias("best"))
        pairs = scored.join(best, "band").where("best.node <> node")
        chosen = pairs.groupBy("node").agg(F.max("best").alias("best"))
        self.centres = self.compared(chosen.select(F.col("node").alias("a"), F.col("best.node").alias("b")), "star")

    def rest(self, members: DataFrame) -> None:
        """Compare the nodes that share an open band and could be linked by the exact bounds.

        What a node shares with no other node cannot be common. Where two nodes were compared with the
        same centre, they have at most the lesser of what each shares with it in common, and of
        what lies outside of it the lesser of what each shares with anyone.
        """
        near = self.near
        members = written(self.spark, members, "rest")
        if members.isEmpty():
            return
        centres = self.centres.select(F.col("a").alias("node"), F.col("b").alias("centre"), F.col("both").alias("inner"))
        nodes = members.select("node").distinct().join(centres, "node", "left")
        nodes = written(self.spark, nodes, "open-nodes")
        wanted = nodes.select("node").union(nodes.where("centre IS NOT NULL").select("centre")).distinct()

        def shingles(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part, sets in _sets(batch, near.shingle):
                    of = pa.array(np.repeat(np.arange(len(sets)), [len(s) for s in sets]))
                    values = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
                    yield pa.RecordBatch.from_arrays([part.column(0).take(of), pa.array(values)], names=["node", "shingle"])

        held = self.texts.join(wanted, "node", "left_semi").mapInArrow(shingles, "node binary, shingle long")
        alone = held.groupBy("shingle").agg(F.count("*").alias("n"), F.min("node").alias("node")).where("n = 1")
        alone = alone.groupBy("node").agg(F.count("*").alias("alone"))
        sizes = nodes.join(self.nodes.select("node", "size"), "node").join(alone, "node", "left").select(
            "node",
            "size",
            (F.col("size") - F.coalesce("alone", F.lit(0))).alias("common"),
            F.coalesce("centre", "node").alias("centre"),
            F.coalesce("inner", "size").alias("inner"),
        )
        sizes = written(self.spark, sizes.where(F.col("common") * 100 >= F.col("size") * near.percent), "sizes")
        columns = ["node", "root", "size", "common", "centre", "inner"]
        rows = written(self.spark, members.join(sizes, "node").select("band", *columns), "candidates")
        left, right = (rows.toDF("band", *(side if c == "node" else f"{c}_{side}" for c in columns)) for side in "ab")
        outer = F.least(F.col("common_a") - F.col("inner_a"), F.col("common_b") - F.col("inner_b"))
        most = F.when(F.col("centre_a") == F.col("centre_b"), F.least("inner_a", "inner_b") + outer)
        most = most.otherwise(F.least("common_a", "common_b"))
        fits = most * 100 >= (F.col("size_a") + F.col("size_b") - most) * near.percent
        pairs = left.join(right, "band").where((F.col("a") < F.col("b")) & (F.col("root_a") != F.col("root_b")) & fits)
        self.compared(pairs.select("a", "b").distinct(), "rest-pairs")


def classified(spark: SparkSession, docs: DataFrame, near: Near = Near()) -> DataFrame:
    """`doc_id`, `node`, `n_shingles`, `component_id`, `kept` for every document."""
    group = Grouping(spark, docs, near)
    group.star()
    group.rest(group.open_members())
    roots = group.classes()
    nodes = group.nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    nodes = written(spark, nodes, "classes")
    named = nodes.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    ids = nodes.join(named, "root").select("node", "component_id")
    out = group.signed.select("doc_id", "n_shingles", "node").join(ids, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return out.select("doc_id", "node", "n_shingles", component.alias("component_id")).withColumn("kept", kept)


def components(spark: SparkSession, docs: DataFrame, near: Near = Near()) -> DataFrame:
    """`doc_id`, `n_shingles`, `component_id`, `kept` for every document."""
    return classified(spark, docs, near).drop("node")


def _with_nodes(docs: DataFrame, near: Near) -> DataFrame:
    """`row` (the document as a struct), `_id`, `_text` and `_node`."""
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("text").cast("string").alias("text"))

    def name(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, sets in _sets(batch, near.shingle):
                names = pa.array([node_name(s) if len(s) else None for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), names], names=["row", "_node"])

    named = rows.mapInArrow(name, T.StructType([rows.schema["row"], T.StructField("_node", T.BinaryType())]))
    return named.select("row", F.col("row.doc_id").cast("long").alias("_id"), F.col("row.text").cast("string").alias("_text"), "_node")


def deduplicated(spark: SparkSession, docs: DataFrame, near: Near = Near()) -> DataFrame:
    """The documents with one of each class, the one that names it, with their columns.

    Where an id stands on several rows, one of those that name their class stays. Of rows without
    an id those stay whose class has no id at all, one of each text.
    """
    found = written(spark, classified(spark, docs, near).select("doc_id", "node", "kept"), "kept")
    ids = found.groupBy("doc_id").agg(F.count("*").alias("n"), F.max("kept").alias("kept"))
    plain = ids.where("n = 1 AND kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias("_kept_id"))
    # Documents travel in one struct, so that no column of theirs can clash.
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("doc_id").cast("long").alias("_id"))
    own = [F.col("row").getField(c).alias(c) for c in docs.columns]
    once = packed.join(plain, F.col("_id") == F.col("_kept_id"), "left_semi").select(*own)
    odd = written(spark, ids.where("n > 1 OR doc_id IS NULL").select("doc_id"), "odd")
    if odd.isEmpty():
        return once
    some = packed.join(odd.withColumnRenamed("doc_id", "_odd"), F.col("_id").eqNullSafe(F.col("_odd")), "left_semi").select(*own)
    right = found.where("kept").select(F.col("doc_id").alias("_kept_id"), F.col("node").alias("_kept_node")).distinct()
    same = F.col("_id").eqNullSafe(F.col("_kept_id")) & F.col("_node").eqNullSafe(F.col("_kept_node"))
    kept = _with_nodes(some, near).join(right, same, "left_semi")
    one = Window.partitionBy("_id", F.when(F.col("_id").isNull(), F.col("_text"))).orderBy("_text")
    kept = kept.withColumn("_place", F.row_number().over(one)).where("_place = 1")
    return once.unionByName(kept.select(*own))
