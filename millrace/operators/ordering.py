"""Numbering items in an order, without ever sorting them all in one task.

The order is cut into buckets; counting them gives each its offset, and inside a bucket
`row_number` does the rest. The numbers are exact for any cuts.
"""

from __future__ import annotations

import os.path
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import rows_within
from millrace.operators.ranges import (
    NUMBER,
    Cuts,
    cuts_at,
    is_exact,
    number_of,
    pick_points,
    small_table,
    text_number,
    with_ranges,
)

BUCKET = "_bucket"
ROWS_PER_BUCKET = 1_000_000
BYTES_PER_BUCKET = 512 << 20
MAX_BUCKETS = 16_384
SAMPLES_PER_BUCKET = 48
MAX_TOP_K = 100_000


def bucket_count(items: DataFrame, rows: int, rows_per_bucket: int | None = None) -> int:
    """A few buckets per shuffle partition, more where that would overfill them."""
    size = rows_per_bucket or ROWS_PER_BUCKET
    shuffle = int(items.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    spread = min(4 * shuffle, rows // 1_000)  # several per partition even out their hashing
    return max(1, min(max(spread, -(-rows // size)), MAX_BUCKETS))


def _numbered(items: DataFrame, order: Sequence[str], prefix: str = "") -> DataFrame:
    return items.withColumn(NUMBER, number_of(items, order[0], prefix))


def cut_points(items: DataFrame, order: Sequence[str], rows_per_bucket: int | None = None) -> Cuts:
    """Choose cuts that split the items into buckets of about equal size.

    The sample holds about MAX_BUCKETS * SAMPLES_PER_BUCKET rows of the order columns at most,
    whatever the size of the input. A first value with a third of all rows is cut along the other
    columns.
    """
    keys = items.select(*order)
    rows = keys.count()
    buckets = bucket_count(items, rows, rows_per_bucket)
    schema, kind = keys.schema, keys.schema[0].dataType
    if buckets == 1:
        return cuts_at([], [], schema, 0, bool)
    fraction = min(1.0, buckets * SAMPLES_PER_BUCKET / rows)
    step = max(1, round(rows * fraction / buckets))
    picked = pick_points(keys, order, fraction, step)
    prefix, numbers = "", [row[f"{NUMBER}0"] for row in picked]
    if kind == T.StringType():
        texts = [row[order[0]] for row in picked]
        prefix = os.path.commonprefix([text for text in texts if text is not None])
        numbers = [text_number(text, prefix) for text in texts]
    return cuts_at(picked, numbers, schema, 0, lambda number: is_exact(number, kind), prefix)


def with_buckets(items: DataFrame, cuts: Cuts) -> DataFrame:
    """Items with their bucket; buckets grow along the order."""
    return with_ranges(_numbered(items, cuts.schema.names, cuts.prefix), cuts, BUCKET)


def number_rows(
    items: DataFrame,
    order: str | Sequence[str],
    name: str = "id",
    start: int = 0,
    rows_per_bucket: int | None = None,
) -> DataFrame:
    """Dense running numbers from `start` along the order columns, which must be unique together.

    Three looks at the input: the order columns twice (sample, bucket sizes) and one full pass with
    a single shuffle by bucket; where rows are of no fixed width, the first rows are looked at too, and
    wide rows make smaller buckets. The input must give the same rows each time; write it to a table
    first if it does not.
    """
    order = [order] if isinstance(order, str) else list(order)
    rows_per_bucket = rows_per_bucket or rows_within(items, ROWS_PER_BUCKET, BYTES_PER_BUCKET)
    cuts = cut_points(items, order, rows_per_bucket)
    bucketed = with_buckets(items, cuts)
    sizes = sorted(with_buckets(items.select(*order), cuts).groupBy(BUCKET).count().collect())
    offsets = accumulate((size for _, size in sizes), initial=start)
    starts = [(bucket, offset) for (bucket, _), offset in zip(sizes, offsets)]
    inside = F.row_number().over(Window.partitionBy(BUCKET).orderBy(*order))
    if len(starts) <= 1:
        return bucketed.withColumn(name, inside.cast("long") + (start - 1)).drop(BUCKET)
    # At most one row per bucket, so the broadcast is bounded by the number of buckets.
    known = small_table(items.sparkSession, starts, f"{BUCKET} long, _start long")
    return (
        bucketed.withColumn("_inside", inside.cast("long"))
        .join(F.broadcast(known), BUCKET, "left")
        .withColumn(name, F.coalesce(F.col("_start"), _unseen()) + F.col("_inside") - 1)
        .drop(BUCKET, "_inside", "_start")
    )


def _unseen() -> Column:
    """An error in place of a row's number: dropping the row would hide that the input changed."""
    return F.raise_error(F.lit("the items changed while they were numbered; write them to a table first")).cast("long")


def running_total(items: DataFrame, order: str | Sequence[str], value: str, name: str) -> DataFrame:
    """The sum of `value` over all items before each one along the order columns, which must be unique
    together; cut into buckets as in `number_rows`."""
    order = [order] if isinstance(order, str) else list(order)
    cuts = cut_points(items, order)
    bucketed = with_buckets(items, cuts)
    sums = sorted(with_buckets(items.select(*order, value), cuts).groupBy(BUCKET).agg(F.sum(value)).collect())
    starts = [(bucket, total) for (bucket, _), total in zip(sums, accumulate((s or 0 for _, s in sums), initial=0))]
    known = small_table(items.sparkSession, starts, f"{BUCKET} long, _offset long")  # a row per bucket
    before = Window.partitionBy(BUCKET).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        bucketed.withColumn("_inside", F.coalesce(F.sum(value).over(before), F.lit(0)))
        .join(F.broadcast(known), BUCKET, "left")
        .withColumn(name, F.coalesce(F.col("_offset"), _unseen()) + F.col("_inside"))
        .drop(BUCKET, "_inside", "_offset")
    )


def create_id(items: DataFrame, order: str | Sequence[str], name: str = "id", **options: int) -> DataFrame:
    """Put a running number, from 0, on each item."""
    return number_rows(items, order, name, **options)


def unique_id(items: DataFrame, name: str = "id") -> DataFrame:
    """Put a unique number with gaps on each item: no shuffle, but other numbers on another run.
    Filter first, since the number stops filters from moving below it."""
    return items.withColumn(name, F.monotonically_increasing_id())


def alternate_ab(items: DataFrame, order: str | Sequence[str], key: str = "flag", **options: int) -> DataFrame:
    """Put `A`, `B`, `A`, ... under `key` along the order."""
    numbered = number_rows(items, order, "_turn", **options)
    return numbered.withColumn(key, F.when(F.col("_turn") % 2 == 0, "A").otherwise("B")).drop("_turn")


def data_rate(items: DataFrame, order: str | Sequence[str], micros: Column, every: int, **options: int) -> DataFrame:
    """Per block of `every` items along the order: how many items, over how many microseconds.

    Time is the items' own, so a rerun gives the same rates."""
    timed = number_rows(items.withColumn("_micros", micros), order, "_turn", **options)
    return timed.groupBy(F.expr(f"_turn div {int(every)}").alias("block")).agg(
        F.count(F.lit(1)).alias("n"), (F.max("_micros") - F.min("_micros")).alias("span_us")
    )


def source_limit(items: DataFrame, limit: int, order: str | Sequence[str] | None = None) -> DataFrame:
    """Only the first `limit` items; with `order` the same ones on each run: a top-k plan, or, where
    so many would be too much for one task, the items with the first numbers."""
    if order is None:
        return items.limit(limit)
    if limit > MAX_TOP_K:
        return number_rows(items, order, "_number").where(F.col("_number") < limit).drop("_number")
    return items.orderBy(*([order] if isinstance(order, str) else order)).limit(limit)
