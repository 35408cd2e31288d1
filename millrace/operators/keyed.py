"""Grouping by key, and work that carries state from item to item of a key.

A key is kept whole in one partition. Only where state is given as an aggregate that merges (`Carry`)
may a key with more rows than one task should hold be cut into segments along its order; every
segment is then worked on its own, starting from state carried over from the segments before it.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import rows_within
from millrace.operators.hot import COUNTERS, hot_keys
from millrace.operators.ranges import (
    NUMBER,
    Cuts,
    Scale,
    cuts_at,
    number_of,
    pick_points,
    scale_for,
    small_table,
    with_ranges,
)

SEGMENT = "_segment"
_CALL = "_call"
_MAX_SHARDS = 1 << 24
_MAX_HOT = 1 << 18
ROWS_PER_SEGMENT = 1_000_000
ROWS_PER_CALL = 100_000
BYTES_PER_SEGMENT = 512 << 20
BYTES_PER_CALL = 64 << 20
MAX_SEGMENTS = 1 << 17
SAMPLES_PER_SEGMENT = 24


@dataclass(frozen=True)
class Carry:
    """State at the start of a segment: `partial` aggregates one segment of a key, `merge` combines
    the partials of the segments before. On a stream `fold(old, rows)` gives the new state from the old
    (None at first) and a key's next rows."""

    partial: Column
    merge: Callable[[Column], Column]
    fold: Callable[[object, pd.DataFrame], object] | None = None


@dataclass(frozen=True)
class KeyCuts:
    """The keys too big for one task, and where their rows are cut. None for a small input."""

    key: str
    order: tuple[str, ...]
    rows: int
    hot: tuple = ()
    scale: Scale | None = None
    cuts: Cuts | None = None


def key_cuts(items: DataFrame, key: str, order: Sequence[str], rows_per_segment: int = ROWS_PER_SEGMENT) -> KeyCuts:
    """Cuts inside the keys that are too big for one task; none for all others.

    Reads the key and order columns of a sample of about MAX_SEGMENTS * SAMPLES_PER_SEGMENT rows at
    most, and nothing but the number of rows while the whole input fits one segment. Only the cuts
    come to the driver.
    """
    columns = [key, *order]
    keys = items.select(*columns)
    rows = keys.count()
    limit = max(rows_per_segment, -(-rows // MAX_SEGMENTS))
    if rows <= limit:
        return KeyCuts(key, tuple(order), rows)
    fraction = min(1.0, SAMPLES_PER_SEGMENT / limit)
    step = max(1, round(limit * fraction))
    picked = pick_points(keys, columns, fraction, step, within=[key])
    if not picked:
        return KeyCuts(key, tuple(order), rows)
    keys_of = [math.nan if row[key] != row[key] else row[key] for row in picked]  # one NaN object for all
    hot = list(dict.fromkeys(keys_of))
    ranks = {value: rank for rank, value in enumerate(hot)}
    leads = [row[f"{NUMBER}1"] for row in picked]
    scale = scale_for(leads) or Scale(0.0, 0.0)
    numbers = [scale.place(ranks[value], lead) for value, lead in zip(keys_of, leads)]
    kind = keys.schema[1].dataType
    cuts = cuts_at(picked, numbers, keys.schema, 1, lambda number: scale.is_exact(number, kind, len(hot)))
    return KeyCuts(key, tuple(order), rows, tuple(hot), scale, cuts)


def with_segments(items: DataFrame, found: KeyCuts) -> DataFrame:
    """Items with the segment of their key: -1 for all keys that were not cut, else a number that
    grows along the order and belongs to that key alone."""
    if found.cuts is None:
        return items.withColumn(SEGMENT, F.lit(-1).cast("long"))
    key, kind = F.col(found.key), items.schema[found.key].dataType
    ranks = {value: rank for rank, value in enumerate(found.hot)}
    schema = T.StructType([T.StructField("_key", kind), T.StructField("_hot", T.LongType())])
    # At most about MAX_SEGMENTS rows: a hot key holds at least one segment's worth of the sample.
    known = small_table(items.sparkSession, [pair for pair in ranks.items() if pair[0] is not None], schema)
    marked = items.join(F.broadcast(known), key == F.col("_key"), "left").drop("_key")
    if None in ranks:
        marked = marked.withColumn("_hot", F.when(key.isNull(), ranks[None]).otherwise(F.col("_hot")))
    number = found.scale.column(F.col("_hot").cast("double"), number_of(items, found.order[0]))
    ranged = with_ranges(marked.withColumn(NUMBER, number), found.cuts, SEGMENT)
    segment = F.when(F.col("_hot").isNull(), -1).otherwise(F.col(SEGMENT) * _MAX_HOT + F.col("_hot"))
    return ranged.withColumn(SEGMENT, segment).drop("_hot")


def group_by_key(items: DataFrame, key: str, order: Sequence[str], copies: int | None = None) -> DataFrame:
    """All items of a key in one partition, in their order; NULL is a key of its own.

    A key is never spread, however many items it has, as what follows may rely on meeting all of
    them. The sort spills, so a hot key costs time and disk, not memory; work that can carry state
    over (`keyed_apply`, `running_count`) cuts it instead. On a stream the order holds within a
    micro-batch only and is not made.
    """
    placed = items.repartition(copies, key) if copies else items.repartition(key)
    return placed if items.isStreaming else placed.sortWithinPartitions(key, *order)


def with_carry(
    items: DataFrame,
    key: str,
    order: Sequence[str],
    carries: Mapping[str, Carry],
    rows_per_segment: int = ROWS_PER_SEGMENT,
) -> DataFrame:
    """Items with their segment and the state carried into it, NULL in a key's first segment."""
    return _with_carry(items, key_cuts(items, key, order, rows_per_segment), carries)


def _with_carry(items: DataFrame, found: KeyCuts, carries: Mapping[str, Carry]) -> DataFrame:
    parted = with_segments(items, found)
    partials = [carry.partial.alias(name) for name, carry in carries.items()]
    if not partials:
        return parted
    if found.cuts is None:
        kinds = items.limit(0).agg(*partials).schema
        return parted.withColumns({name: F.lit(None).cast(kinds[name].dataType) for name in carries})
    ended = parted.where(F.col(SEGMENT) >= 0).groupBy(found.key, SEGMENT).agg(*partials)
    before = Window.partitionBy(found.key).orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    merged = ended.select(
        F.col(SEGMENT).alias("_at"),
        *[carry.merge(F.col(name)).over(before).alias(name) for name, carry in carries.items()],
    )
    # One row per segment of a cut key: at most twice the number of cuts, so broadcasting is safe.
    return parted.join(F.broadcast(merged), F.col(SEGMENT) == F.col("_at"), "left").drop("_at")


def running_count(
    items: DataFrame, key: str, order: Sequence[str], name: str = "n", rows_per_segment: int = ROWS_PER_SEGMENT
) -> DataFrame:
    """How many items of its key came up to and with each item."""
    count = Carry(F.count(F.lit(1)), F.sum)
    carried = with_carry(items, key, order, {"_before": count}, rows_per_segment)
    here = F.row_number().over(Window.partitionBy(key, SEGMENT).orderBy(*order))
    total = here.cast("long") + F.coalesce(F.col("_before"), F.lit(0))
    return carried.withColumn(name, total).drop(SEGMENT, "_before")


def each_key(
    key: str, process: Callable[[pd.DataFrame, dict], pd.DataFrame], carried: Sequence[str] = ()
) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """A process for `keyed_apply` from one that takes a single key's rows and its carried state as
    a dict. Simple to write, but every key costs a Python call."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        done = []
        for _, part in rows.groupby(key, sort=False, dropna=False):
            empty = part[list(carried)].isna().iloc[0]
            state = {name: None if empty[name] else part[name].iloc[0] for name in carried}
            done.append(process(part.drop(columns=list(carried)).reset_index(drop=True), state))
        return pd.concat(done, ignore_index=True)

    return run


def keyed_apply(
    items: DataFrame,
    key: str,
    order: Sequence[str],
    process: Callable[[pd.DataFrame], pd.DataFrame],
    schema: str,
    carries: Mapping[str, Carry] | None = None,
    rows_per_segment: int = ROWS_PER_SEGMENT,
    rows_per_call: int = ROWS_PER_CALL,
) -> DataFrame:
    """Run Python code over the items of each key, in order.

    `process(rows)` gets many keys at a time, sorted by key and order, so that it can work on whole
    columns; see `each_key` for one key at a time. All of a key is in one call, unless it is cut:
    then a call has one segment of it. Carried state comes as further columns, NULL in a key's first
    segment. Columns have Arrow types, so integers stay exact beside NULL. Select only the columns
    it needs beforehand.

    A key with more than `rows_per_segment` rows (fewer if rows are wide) is cut if `carries` say how
    its state goes on. Without them it is an error that names the key: a process that saw pieces as
    whole keys would give wrong results.
    """
    rows_per_segment = rows_within(items, rows_per_segment, BYTES_PER_SEGMENT)
    rows_per_call = rows_within(items, rows_per_call, BYTES_PER_CALL)
    if carries:
        found = key_cuts(items, key, order, rows_per_segment)
    else:
        rows, nameless = items.agg(F.count(F.lit(1)), F.count_if(F.col(f"`{key}`").isNull())).first()
        largest = [(None, nameless)] if nameless > rows_per_segment else []
        if rows > rows_per_segment:
            # So many counters that no key beyond the limit can escape the summary.
            counters = max(COUNTERS, 2 * -(-rows // rows_per_segment))
            largest += hot_keys(items, key, rows_per_segment, 1, counters)
        if largest:
            name, count = max(largest, key=lambda found: found[1])
            raise ValueError(
                f"key {name!r} has {count} rows, a call may have {rows_per_segment}: "
                "give carries, or a larger rows_per_segment"
            )
        found = KeyCuts(key, tuple(order), rows)

    def run(group: pa.Table) -> pa.Table:
        rows = group.drop_columns([_CALL, SEGMENT]).to_pandas(types_mapper=pd.ArrowDtype)
        return pa.Table.from_pandas(process(rows), preserve_index=False)

    copies = int(items.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    shards = min(max(copies, -(-found.rows // rows_per_call)), _MAX_SHARDS)
    # One number for a shard of keys or a segment, so that a single column is grouped and sorted by.
    shard = F.pmod(F.xxhash64(key), F.lit(shards))
    call = F.when(F.col(SEGMENT) < 0, shard).otherwise(F.col(SEGMENT) + _MAX_SHARDS)
    carried = _with_carry(items, found, carries or {}).withColumn(_CALL, call)
    # With the number given, adaptive execution does not merge small partitions: Python time, not
    # bytes, is what one of them costs. The grouping needs no further shuffle and no further sort.
    placed = carried.repartition(copies, _CALL).sortWithinPartitions(_CALL, key, *order)
    return placed.groupBy(_CALL).applyInArrow(run, schema)


def process_partitions(
    items: DataFrame,
    setup: Callable[[], object],
    process: Callable[[object, pd.DataFrame], pd.DataFrame | None],
    schema: str,
    finish: Callable[[object], pd.DataFrame] | None = None,
) -> DataFrame:
    """A process instance per partition: `setup()` before its first item, `process` on each batch,
    `finish` after the last. Instances share nothing; merge what `finish` yields with an aggregate,
    whose result must not depend on how items fell into partitions."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        instance = setup()
        for batch in batches:
            out = process(instance, batch)
            if out is not None:
                yield out
        if finish is not None:
            yield finish(instance)

    return items.mapInPandas(run, schema)


def emit_batches(
    items: DataFrame, emit: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """Any number of items for each, from Python code that takes a batch of items at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from emit(batch)

    return items.mapInArrow(run, schema)
