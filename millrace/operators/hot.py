"""Keys with very many items, found by a summary that merges instead of a count of every key."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.ranges import small_table

#: Counters of one partition's summary.
COUNTERS = 8_192


def _summaries(counters: int):
    """A space-saving summary of each partition: counts that fall short by at most `lost`, of all keys that could
    have more than that."""

    def cut(held: Counter) -> int:
        """Take the count of the first key beyond the counters off all, and drop what is left without any."""
        floor = sorted(held.values(), reverse=True)[counters]
        for key in [k for k, n in held.items() if n <= floor]:
            del held[key]
        for key in held:
            held[key] -= floor
        return floor

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        lost, rows = 0, 0
        for batch in batches:
            counts = batch.column(0).value_counts()
            held.update(dict(zip(counts.field("values").to_pylist(), counts.field("counts").to_pylist(), strict=True)))
            rows += batch.num_rows
            if len(held) > 4 * counters:
                lost += cut(held)
        if len(held) > counters:
            lost += cut(held)
        # The first row tells of the partition as a whole.
        keys = pa.array([None, *held], pa.string())
        columns = [keys, pa.array([rows, *held.values()], pa.int64()), pa.array([lost] + [0] * len(held), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["name", "n", "lost"])

    return run


def hot_keys(items: DataFrame, key: str, least: int, most: int, counters: int = COUNTERS) -> list[tuple[object, int]]:
    """The keys (not NULL) with more than `least` items and their exact counts, the largest `most` of them.

    Two looks at the key column, neither of which shuffles items or all keys. The first makes a summary per
    partition of at most `counters` keys, whatever number of keys there are. Added up, a key's count falls short by
    at most the sum of what the partitions lost, and a partition loses less than its items divided by `counters`.
    So every key that can have more than `least` items is among the named ones if items / counters < least. The
    second counts just those exactly.
    """
    kind = items.schema[key].dataType
    named = items.where(F.col(f"`{key}`").isNotNull()).select(F.col(f"`{key}`").alias("key"))
    # Equal keys have equal texts, and the text of a key says its value.
    if isinstance(kind, (T.StringType, T.IntegralType, T.DecimalType, T.BooleanType, T.DateType, T.TimestampNTZType)):
        name = F.col("key").cast("string")
    else:
        name = F.to_json(F.struct("key"))
    parts = named.select(name.alias("name")).mapInArrow(_summaries(counters), "name string, n long, lost long")
    sums = parts.groupBy("name").agg(F.sum("n").alias("n"), F.sum("lost").alias("lost")).persist()
    try:
        whole = sums.where("name IS NULL").first()
        if whole is None or whole["n"] <= least:
            return []
        # At most n / (least - lost) keys can reach this, of those that the summaries hold.
        found = sums.where(F.col("name").isNotNull() & (F.col("n") + F.lit(whole["lost"]) > least))
        found = found.orderBy(F.desc("n"), "name").limit(2 * most).select("name").collect()
    finally:
        sums.unpersist()
    if not found:
        return []
    known = small_table(items.sparkSession, [tuple(r) for r in found], "_name string")
    hot = named.withColumn("_name", name).join(F.broadcast(known), "_name", "left_semi")
    counts = hot.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > least)
    return [tuple(r) for r in counts.orderBy(F.desc("n")).limit(most).collect()]
