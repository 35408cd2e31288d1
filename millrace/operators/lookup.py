"""Looking items up in a side table (a service)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.hot import hot_keys
from millrace.operators.ranges import small_table

MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 << 20
HOT_ROWS = 1_000_000
MAX_HOT_KEYS = 4_096


@dataclass(frozen=True)
class Measured:
    """Rows and bytes of a service, and a key that stands on several of its rows."""

    rows: int
    bytes: int
    doubled: tuple[object, int] | None = None

    def fits(self, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
        """Whether the service is small enough to copy to every executor."""
        return self.rows <= max_rows and self.bytes <= max_bytes


def measured(side: DataFrame, key: str | None = None) -> Measured:
    """Rows, bytes and doubled keys of a table in one reading; without `key` no row counts as doubled."""
    size = F.length(F.to_json(F.struct("*")))
    if key is None:
        rows, total = side.agg(F.count(F.lit(1)), F.sum(size)).first()
        return Measured(rows, total or 0)
    keys = side.withColumn("_bytes", size).groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"), F.sum("_bytes").alias("_bytes"))
    several = F.col("_key").isNotNull() & (F.col("_n") > 1)
    rows, total, doubled = keys.agg(F.sum("_n"), F.sum("_bytes"), F.max_by(F.struct("_key", "_n"), F.when(several, F.col("_n")))).first()
    return Measured(rows or 0, total or 0, None if doubled is None or doubled["_key"] is None or doubled["_n"] < 2 else tuple(doubled))


def fits_broadcast(side: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Measure whether a table is small enough to copy to every executor."""
    return measured(side).fits(max_rows, max_bytes)


def service_side(service: DataFrame, service_key: str, take: Sequence[str]) -> DataFrame:
    """What a lookup needs of a service: its key and the columns to take."""
    missing = [name for name in (service_key, *take) if name not in service.columns]
    if missing:
        raise KeyError(f"service has no column {missing}")
    return service.select(F.col(service_key).alias("_service_key"), *take)


def lookup(
    items: DataFrame,
    service: DataFrame,
    key: str,
    service_key: str,
    take: Sequence[str],
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
    size: Measured | None = None,
) -> DataFrame:
    """Every item, with the `take` columns of the service row of its key or NULL.

    The service must hold one row per key, or it is refused; rows under a NULL key are never found. A
    service measured as small is broadcast. For a larger one both sides are shuffled by key, except
    the items of keys with more than `hot_rows` items and of NULL keys: they stay where they are
    and meet a broadcast of just their service rows, if that is measured as small too. Hot keys, at most
    MAX_HOT_KEYS, are found by a summary of the key column (`hot_keys`). On a stream, where keys cannot be
    counted ahead, a large service is simply joined by key; `lookup_reset` works on counted batches. `size` is
    what `measured` said of the service's side before, if it has not changed since.
    """
    side = service_side(service, service_key, take)
    same = F.col(key) == F.col("_service_key")
    size = size or measured(side, "_service_key")
    if size.doubled:
        raise ValueError(f"the service has {size.doubled[1]} rows under key {size.doubled[0]!r}; it must have one")
    if size.fits(max_rows, max_bytes):
        return items.join(F.broadcast(side), same, "left").drop("_service_key")
    if items.isStreaming:
        return items.join(side, same, "left").drop("_service_key")
    hot = [(value,) for value, _ in hot_keys(items, key, hot_rows, MAX_HOT_KEYS)]
    kind = T.StructType([T.StructField("_hot_key", items.schema[key].dataType)])
    known = F.broadcast(small_table(items.sparkSession, hot, kind))
    hot_side = side.join(known, F.col("_service_key") == F.col("_hot_key"), "left_semi")
    if not fits_broadcast(hot_side, max_rows=MAX_HOT_KEYS, max_bytes=max(max_bytes, MAX_BROADCAST_BYTES)):
        return items.join(side, same, "left").drop("_service_key")
    marked = items.join(known, F.col(key) == F.col("_hot_key"), "left")
    stays = F.col("_hot_key").isNotNull() | F.col(key).isNull()
    in_place = marked.where(stays).join(F.broadcast(hot_side), same, "left")
    shuffled = marked.where(~stays).join(side, same, "left")
    return in_place.unionByName(shuffled).drop("_service_key", "_hot_key")
