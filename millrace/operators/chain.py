"""Steps of a process chain. Each is a function from DataFrame to DataFrame, so a chain of them
stays one projection over the scan."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from millrace.functions import condition, merge_streams

Step = Callable[[DataFrame], DataFrame]


def chain(items: DataFrame, *steps: Step) -> DataFrame:
    """Apply the steps in order."""
    for step in steps:
        items = items.transform(step)
    return items


def set_value(key: str, value: object, when: Column | str | None = None) -> Step:
    """Put a constant or Column under `key`; with `when`, only on items that pass the test."""

    def step(items: DataFrame) -> DataFrame:
        new = value if isinstance(value, Column) else F.lit(value)
        if when is None:
            return items.withColumn(key, new)
        old = F.col(key) if key in items.columns else F.lit(None)
        return items.withColumn(key, F.when(condition(when, items), new).otherwise(old))

    step.keeps_rows = True
    return step


def only_if(when: Column | str, step: Step) -> Step:
    """Run a step only on the items that pass the test, made on the item as it was before.

    A step that says it keeps its rows (`keeps_rows`, as `set_value` does) stays one projection. Any
    other step gets the passing items alone, and the rest are merged with what it gives; attributes
    that one side lacks are NULL. The input is then read once for each side.
    """

    def split(items: DataFrame) -> DataFrame:
        test = F.coalesce(condition(when, items), F.lit(False))
        return merge_streams(step(items.where(test)), items.where(~test))

    if not getattr(step, "keeps_rows", False):
        return split

    def run(items: DataFrame) -> DataFrame:
        old = {name: f"_old_{name}" for name in items.columns}
        kept = items.withColumns({"_passes": condition(when, items), **{copy: F.col(name) for name, copy in old.items()}})
        done = step(kept)
        new = [name for name in done.columns if name != "_passes" and name not in old.values()]
        chosen = [
            F.when(F.col("_passes"), F.col(name)).otherwise(F.col(old[name]) if name in old else None).alias(name)
            for name in new
        ]
        return done.select(*chosen)

    run.keeps_rows = True
    return run


def skip(when: Column | str | None = None) -> Step:
    """Drop items that pass the test, or every item without one. An unknown (NULL) test keeps."""

    def step(items: DataFrame) -> DataFrame:
        if when is None:
            return items.where(F.lit(False))
        return items.where(~F.coalesce(condition(when, items), F.lit(False)))

    return step


def null_unless(when: Column | str) -> Step:
    """Turn an item into a null item (every attribute NULL) unless it passes the test."""

    def step(items: DataFrame) -> DataFrame:
        test = condition(when, items)
        return items.select(*[F.when(test, F.col(name)).alias(name) for name in items.columns])

    return step


def drop_null_items(items: DataFrame) -> DataFrame:
    """Drop items without any value."""
    return items.dropna("all")


def instance_tag(process: str, key: str = "copy_id") -> Step:
    """Put `process@instance` under `key`; the instance is the task's partition.

    The tag says where a row was handled in this run. It is no stable id: filter before, since the
    partition id is not deterministic and stops filters from moving below it.
    """
    tag = F.concat(F.lit(f"{process}@"), F.spark_partition_id())
    return lambda items: items.withColumn(key, tag)


def log_tap(items: DataFrame, prefix: str) -> tuple[DataFrame, Observation]:
    """Pass items through and count them under `prefix`, without another pass.

    The counts are in `observation.get` once an action ran on the returned items.
    """
    tap = Observation(prefix)
    return items.observe(tap, F.count(F.lit(1)).alias("items")), tap


def item_count(items: DataFrame, name: str = "n") -> DataFrame:
    """One row with the number of items."""
    return items.agg(F.count(F.lit(1)).alias(name))
