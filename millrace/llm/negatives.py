"""Hard negatives: exact integer scores of every anchor against every row, by Strassen products of tiles.

1. `integer_rows`: components become floor(256 * x); rows that take no part go.
2. `cells`: the anchors are dealt into blocks of at most `anchors` rows, and every block meets all rows in
   `slices` parts. A cell is one block with one part; its anchors come first, so a task streams through
   the part tile by tile and never holds more than a block, a tile and their scores.
3. A first pass multiplies each label's anchors with that label's rows and keeps a heap of the best
   positives per anchor. A heap is a row of an array, sorted; heaps merge by taking the best of both.
4. A second pass multiplies whole tiles. Each positive sets a window of scores; the best rows of another
   label inside it make its heap. Heaps of all parts are merged by Spark.

A tile's product is Strassen's: seven half-size products for eight, after padding with zero rows and
columns to whole halves, down to `leaf`. All additions are of int64, which is arithmetic modulo 2^64, so
a score is exact whenever it fits in 63 bits itself, whatever the sums in between do. Rows whose scores
could be larger are refused by name.

The scores of all anchors with all rows are the task itself (each anchor is a query against the table),
so work grows with their product; what is sent grows with rows times blocks.

Defined cases: rows without id, label, vector, or with a null or non-finite component take no part; a
vector of fewer components is padded with zeros, so one without any scores 0 everywhere; equal anchor
rows (id, label, vector) count once; a row of the anchor's own id is never its positive or negative;
repeated rows of one id otherwise count as often as they stand there, and between rows of equal id and
score any order is the same; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.tables import spread, written


@dataclass(frozen=True)
class Mining:
    """Ids of anchors are divisible by `every`, ids of changed labels by `changed`; how many positives and
    negatives; a negative scores between `low` and `high` percent of its positive; components are
    multiplied by `scale`. Anchors of a block, rows of a tile, and the side from which halves are not halved again."""

    every: int = 50
    changed: int = 7
    labels: int = 10
    positives: int = 5
    negatives: int = 3
    low: int = 50
    high: int = 95
    scale: int = 256
    anchors: int = 2_048
    tile: int = 1_024
    leaf: int = 16


#: Bytes of one block of anchors; long vectors make smaller blocks.
BLOCK_BYTES = 16 << 20
#: The score of nothing, below every score a row can have.
NONE = np.iinfo(np.int64).min


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = 16) -> np.ndarray:
    """The product of two int64 matrices, exact modulo 2^64.

    Sides are padded with zeros to a whole number of halves, as often as the shortest side can be halved
    without falling below `leaf`.
    """
    rows, inner, columns = a.shape[0], a.shape[1], b.shape[1]
    if not rows or not inner or not columns:
        return np.zeros((rows, columns), np.int64)
    halvings = max(0, int(min(rows, inner, columns) / leaf).bit_length() - 1)
    unit = 1 << halvings

    def padded(m: np.ndarray) -> np.ndarray:
        extra = [(0, -side % unit) for side in m.shape]
        return np.pad(m, extra) if any(e for _, e in extra) else m

    def product(x: np.ndarray, y: np.ndarray, depth: int) -> np.ndarray:
        if not depth:
            return x @ y
        n, k, m = x.shape[0] // 2, x.shape[1] // 2, y.shape[1] // 2
        x11, x12, x21, x22 = x[:n, :k], x[:n, k:], x[n:, :k], x[n:, k:]
        y11, y12, y21, y22 = y[:k, :m], y[:k, m:], y[k:, :m], y[k:, m:]
        p1 = product(x11 + x22, y11 + y22, depth - 1)
        p2 = product(x21 + x22, y11, depth - 1)
        p3 = product(x11, y12 - y22, depth - 1)
        p4 = product(x22, y21 - y11, depth - 1)
        p5 = product(x11 + x12, y22, depth - 1)
        p6 = product(x21 - x11, y11 + y12, depth - 1)
        p7 = product(x12 - x22, y21 + y22, depth - 1)
        out = np.empty((2 * n, 2 * m), np.int64)
        out[:n, :m], out[:n, m:] = p1 + p4 - p5 + p7, p3 + p5
        out[n:, :m], out[n:, m:] = p2 + p4, p1 - p2 + p3 + p6
        return out

    return product(padded(a), padded(b), halvings)[:rows, :columns]


def integer_rows(rows: DataFrame, mining: Mining = Mining()) -> DataFrame:
    """(vec_id, label, vector) of the rows that take part, labels changed and components as integers."""
    x = F.col("embedding")
    fit = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    label = F.when(F.col("vec_id") % mining.changed == 0, (F.col("label").cast("long") + 1) % mining.labels).otherwise(F.col("label"))
    whole = F.transform(x, lambda c: F.floor(c.cast("double") * mining.scale).cast("long"))
    some = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(fit, F.lit(False)))
    return some.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), whole.alias("vector"))


@dataclass(frozen=True)
class Grid:
    """Blocks of anchors, parts of the rows, and components of the longest vector."""

    blocks: int
    slices: int
    width: int


def grid_of(spark: SparkSession, rows: DataFrame, mining: Mining = Mining()) -> Grid:
    """How the work is cut. Refuses components so large that a score could leave 63 bits."""
    anchor = F.col("vec_id") % mining.every == 0
    largest = F.array_max(F.transform("vector", lambda c: F.greatest(c, -c - 1)))
    n, width, top = rows.agg(F.count_if(anchor), F.max(F.size("vector")), F.max(largest)).first()
    if n and width * (top + 1) ** 2 >= 1 << 63:
        raise ValueError(f"components up to {top} in {width} places: their products leave 63 bits")
    most = max(1, min(mining.anchors, BLOCK_BYTES // (8 * (width or 1))))
    blocks = max(1, -(-n // most))
    return Grid(blocks, max(1, -(-spread(spark) // blocks)), width or 0)


def cells(rows: DataFrame, anchors: DataFrame, grid: Grid, by: list[str]) -> DataFrame:
    """Anchors and rows in cells of a block and a part each, one cell to a partition; in it the anchors (with
    an `anchor` number) come before the rows, which are sorted by `by`."""
    block = F.pmod(F.xxhash64("anchor"), F.lit(grid.blocks))
    part = F.pmod(F.monotonically_increasing_id(), F.lit(grid.slices))  # rows are dealt in turn: no key decides
    slices, blocks = (F.explode(F.sequence(F.lit(0), F.lit(n - 1))) for n in (grid.slices, grid.blocks))
    left = anchors.withColumn("part", slices).withColumn("cell", block * grid.slices + F.col("part"))
    right = rows.withColumn("part", part).withColumn("block", blocks).withColumn("cell", F.col("block") * grid.slices + F.col("part"))
    dealt = left.drop("part").unionByName(right.drop("part", "block"), allowMissingColumns=True)
    placed = dealt.repartitionById(grid.blocks * grid.slices, F.col("cell").cast("int"))
    return placed.sortWithinPartitions(F.col("anchor").isNull(), "anchor", *by).drop("cell")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of whole numbers as a matrix, short ones padded with zeros."""
    size = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy()
    out = np.zeros((len(size), width), np.int64)
    out[np.arange(width) < size[:, None]] = values
    return out


@dataclass
class Tile:
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray

    def __getitem__(self, which) -> Tile:
        return Tile(self.ids[which], self.labels[which], self.vectors[which])


class Heaps:
    """The best (score, id) of each of n heaps as sorted rows: higher scores first, then smaller ids."""

    def __init__(self, n: int, size: int):
        self.scores = np.full((n, size), NONE)
        self.ids = np.full((n, size), np.iinfo(np.int64).max)

    def merge(self, which: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Put some more under the heaps named by `which`, each of them named once."""
        size = self.scores.shape[1]
        scores = np.concatenate((self.scores[which], scores), axis=1)
        ids = np.concatenate((self.ids[which], ids), axis=1)
        best = np.lexsort((ids, -1 - scores), axis=1)[:, :size]  # -1 - x, as -x of the least number is itself
        self.scores[which] = np.take_along_axis(scores, best, 1)
        self.ids[which] = np.take_along_axis(ids, best, 1)


def _tiles(batches: Iterator[pa.RecordBatch], width: int, tile: int) -> Iterator[tuple[Tile, list[pa.RecordBatch]] | Tile]:
    """First all anchors of a cell with their Arrow rows, then its other rows tile by tile."""
    anchors: list[pa.RecordBatch] = []
    met = False
    for batch in batches:
        mine = int(batch.num_rows - batch.column("anchor").null_count)
        if mine:
            anchors.append(batch.slice(0, mine))
        if mine == batch.num_rows:
            continue
        if not met:
            yield _as_tile(pa.Table.from_batches(anchors or [batch.slice(0, 0)]).combine_chunks(), width), anchors
            met = True
        for low in range(mine, batch.num_rows, tile):
            yield _as_tile(pa.Table.from_batches([batch.slice(low, tile)]), width)


def _as_tile(rows: pa.Table, width: int) -> Tile:
    vectors = rows.column("vector").combine_chunks() if rows.num_rows else pa.array([], pa.list_(pa.int64()))
    return Tile(rows.column("vec_id").to_numpy(), rows.column("label").to_numpy(), _matrix(vectors, width))


def _positives(mining: Mining, width: int) -> Callable:
    """The best rows of an anchor's own label in this part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = heaps = numbers = None
        for found in _tiles(batches, width, mining.tile):
            if heaps is None:
                anchors, held = found
                numbers = np.concatenate([b.column("anchor").to_numpy() for b in held]) if held else anchors.ids
                heaps = Heaps(len(anchors.ids), mining.positives)
                continue
            for label in np.unique(found.labels):
                rows, which = found[found.labels == label], np.flatnonzero(anchors.labels == label)
                if not len(which):
                    continue
                scores = strassen(anchors.vectors[which], rows.vectors.T, mining.leaf)
                scores[anchors.ids[which][:, None] == rows.ids] = NONE
                best = np.argsort(-1 - scores, axis=1, kind="stable")[:, : mining.positives]
                heaps.merge(which, np.take_along_axis(scores, best, 1), rows.ids[best])
        if heaps is not None:
            anchor, place = np.nonzero(heaps.scores != NONE)
            columns = [numbers[anchor], heaps.ids[anchor, place], heaps.scores[anchor, place]]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["anchor", "positive_id", "positive_score"])

    return run


def _negatives(mining: Mining, width: int) -> Callable:
    """The best rows of another label inside the window of each positive in this part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = heaps = None
        for found in _tiles(batches, width, mining.tile):
            if heaps is None:
                anchors, held = found
                lists = pa.chunked_array([b.column("positive_scores") for b in held] or [pa.array([], pa.list_(pa.int64()))]).combine_chunks()
                sizes = np.diff(lists.offsets.to_numpy())
                owner = np.repeat(np.arange(len(sizes)), sizes)
                place = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                score = lists.flatten().to_numpy()
                top = _percent(score, mining.high, up=False)
                bottom = _percent(score, mining.low, up=True)
                numbers = np.concatenate([b.column("anchor").to_numpy() for b in held]) if held else anchors.ids
                heaps = Heaps(len(owner), mining.negatives)
                continue
            scores = strassen(anchors.vectors, found.vectors.T, mining.leaf)
            scores[(anchors.labels[:, None] == found.labels) | (anchors.ids[:, None] == found.ids)] = NONE
            order = np.argsort(-1 - scores, axis=1, kind="stable")
            scores = np.concatenate((np.take_along_axis(scores, order, 1), np.full((len(scores), mining.negatives), NONE)), axis=1)
            for slot in range(int(place.max(initial=-1)) + 1):
                which = np.flatnonzero(place == slot)
                mine = owner[which]
                above = (scores[mine] > top[which][:, None]).sum(axis=1)
                at = above[:, None] + np.arange(mining.negatives)
                value = scores[mine[:, None], at]
                ids = found.ids[order[mine[:, None], np.minimum(at, order.shape[1] - 1)]]
                outside = value < bottom[which][:, None]
                some = np.flatnonzero(~outside[:, 0])
                value[outside] = NONE
                heaps.merge(which[some], value[some], ids[some])
        if heaps is not None:
            which, slot = np.nonzero(heaps.scores != NONE)
            columns = [numbers[owner[which]], place[which], heaps.ids[which, slot], heaps.scores[which, slot]]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["anchor", "place", "negative_id", "negative_score"])

    return run


def _percent(score: np.ndarray, share: int, up: bool) -> np.ndarray:
    """`share` percent of each score, rounded down or up without leaving 63 bits."""
    whole, rest = np.divmod(score, 100)
    return whole * share + (-(-rest * share // 100) if up else rest * share // 100)


def _best(rows: DataFrame, keys: list[str], score: str, name: str, count: int) -> DataFrame:
    """The heaps of all parts merged: the first `count` of each key, with their `rank`."""
    first = Window.partitionBy(*keys).orderBy(F.col(score).desc(), name)
    return rows.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= count)


def hard_negatives(spark: SparkSession, embeddings: DataFrame, mining: Mining = Mining()) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each anchor and each of
    its best positives the first negatives whose score lies in the positive's window."""
    rows = written(spark, integer_rows(embeddings, mining), "integer-rows")
    grid = grid_of(spark, rows, mining)
    some = rows.where(F.col("vec_id") % mining.every == 0).distinct()
    anchors = written(spark, some.withColumn("anchor", F.monotonically_increasing_id()), "anchors")

    parts = cells(rows, anchors, grid, ["label", "vec_id"]).mapInArrow(
        _positives(mining, grid.width), "anchor long, positive_id long, positive_score long"
    )
    pairs = _best(parts, ["anchor"], "positive_score", "positive_id", mining.positives)
    pairs = written(spark, pairs.withColumn("place", F.col("rank").cast("long") - 1).drop("rank"), "positives")
    lists = F.transform(F.array_sort(F.collect_list(F.struct("place", "positive_score"))), lambda p: p["positive_score"])
    wanted = anchors.join(pairs.groupBy("anchor").agg(lists.alias("positive_scores")), "anchor")

    parts = cells(rows, wanted, grid, ["vec_id"]).mapInArrow(
        _negatives(mining, grid.width), "anchor long, place long, negative_id long, negative_score long"
    )
    best = _best(parts, ["anchor", "place"], "negative_score", "negative_id", mining.negatives)
    named = pairs.join(anchors.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor")
    found = best.join(named, ["anchor", "place"])
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")

