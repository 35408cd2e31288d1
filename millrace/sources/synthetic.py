"""Generated items, for trying a job without data.

An item's values come from its place alone, so they are the same on any cluster and after a retry.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_KEYS = ("att1",)


def _uniform(place: Column, seed: int) -> Column:
    """A number above 0 and up to 1 for each place."""
    bits = F.shiftrightunsigned(F.xxhash64(place, F.lit(seed)), 11)
    return (bits + F.lit(0.5)) / float(1 << 53)


def _gaussian(place: Column, seed: int) -> Column:
    """A standard-normal number for each place (Box-Muller)."""
    radius = F.sqrt(-2 * F.ln(_uniform(place, seed)))
    return radius * F.cos(2 * math.pi * _uniform(place, seed + 1))


def _gaussian_columns(place: Column, keys: Sequence[str]) -> list[Column]:
    # The seed of each key.
    return [_gaussian(place, 1_000 * number).alias(key) for number, key in enumerate(keys)]


def _constant_columns() -> list[Column]:
    # Fixed values
    return [
        F.lit(1).cast("long").alias("id"),
        F.lit("streams Framework").alias("name"),
        F.array(F.lit("v1"), F.lit("v2"), F.lit("v3")).alias("data"),
    ]


def gaussian_items(spark: SparkSession, items: int, keys: Sequence[str] = DEFAULT_KEYS) -> DataFrame:
    """Items with one standard-normal number per key, each key from its own seed."""
    return spark.range(items).select(*_gaussian_columns(F.col("id"), keys))


def constant_items(spark: SparkSession, items: int) -> DataFrame:
    """Copies of one fixed item."""
    return spark.range(items).select(*_constant_columns())


def with_gaussian(items: DataFrame, place: str, keys: Sequence[str] = DEFAULT_KEYS) -> DataFrame:
    """Items with one standard-normal number per key, drawn from the number under `place`."""
    return items.select("*", *_gaussian_columns(F.col(place), keys))


def with_constants(items: DataFrame) -> DataFrame:
    """Items with the attributes of the fixed item."""
    return items.select("*", *_constant_columns())


def _ticks(spark: SparkSession, per_second: int) -> DataFrame:
    return spark.readStream.format("rate").option("rowsPerSecond", per_second).load()


def gaussian_stream(spark: SparkSession, per_second: int, keys: Sequence[str] = DEFAULT_KEYS) -> DataFrame:
    """The items of `gaussian_items` without end."""
    return _ticks(spark, per_second).select(*_gaussian_columns(F.col("value"), keys))


def constant_stream(spark: SparkSession, per_second: int) -> DataFrame:
    """The items of `constant_items` without end."""
    return _ticks(spark, per_second).select(*_constant_columns())
