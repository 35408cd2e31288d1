"""Labelling items with a queue name and branching on the label.

Branch tests are written on source columns, so each branch pushes its own filter into the scan;
whatever needs all branches at once (`emit`, `first_match`) reads the input a single time.
"""

from __future__ import annotations

import operator
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import condition

QUEUE = "queue"

Rules = Mapping[str, "Column | str | None"]


def _any_of(tests: Sequence[Column]) -> Column:
    return reduce(operator.or_, tests)


def enqueue(items: DataFrame, queue: str, when: Column | str | None = None) -> DataFrame:
    """Items that pass the test, labelled with one queue name."""
    chosen = items if when is None else items.where(condition(when, items))
    return chosen.withColumn(QUEUE, F.lit(queue))


def first_match(items: DataFrame, rules: Rules) -> DataFrame:
    """Label each item with the first queue whose test it passes, and with no other; drop items that
    pass none. To write an item to every queue it passes, use `emit`."""
    label, tests = None, []
    for queue, when in rules.items():
        test = F.lit(True) if when is None else condition(when, items)
        tests.append(test)
        label = F.when(test, queue) if label is None else label.when(test, queue)
    return items.where(_any_of(tests)).withColumn(QUEUE, label)


def emit(
    items: DataFrame,
    rules: Rules,
    output: bool = False,
    output_label: str | None = None,
    label: str = QUEUE,
    ordinal: str | None = None,
) -> DataFrame:
    """One row per item and queue it is written to, in a single pass over the input.

    With `output`, the item itself comes first under `output_label`. `ordinal` names a column for
    the position of the row among those of its item, since Spark keeps no row order.
    """
    tests = [F.lit(True) if when is None else F.coalesce(condition(when, items), F.lit(False)) for when in rules.values()]
    targets: list[tuple[str | None, Column]] = list(zip(rules, tests))
    if output:
        targets.insert(0, (output_label, F.lit(True)))
    elif all(when is not None for when in rules.values()):
        items = items.where(_any_of([condition(when, items) for when in rules.values()]))
    copies, place = [], F.lit(0)
    for queue, test in targets:
        copy = F.struct(F.lit(queue).cast("string").alias(label), place.alias("_place"))
        copies.append(F.when(test, copy))
        place = place + test.cast("int")
    kept = [name for name in items.columns if name != label]
    # Unwanted copies are dropped after the explode: that keeps the whole step in generated code,
    # which an array filter would leave.
    exploded = items.select(*kept, F.explode(F.array(*copies)).alias("_to")).where(F.col("_to").isNotNull())
    ends = [F.col(f"_to.{label}").alias(label)]
    if ordinal:
        ends.append(F.col("_to._place").alias(ordinal))
    return exploded.select(*kept, *ends)


def enqueue_bulk(items: DataFrame, batch: Column, queue: str, name: str = "item") -> DataFrame:
    """Write every element of an array column to a queue: one row per element, with its `pos`."""
    kept = [c for c in items.columns if c != QUEUE]
    return items.select(*kept, F.posexplode(batch).alias("pos", name)).withColumn(QUEUE, F.lit(queue))


def split(items: DataFrame, rules: Rules) -> dict[str, DataFrame]:
    """One labelled branch per queue, each with its own pushed-down filter."""
    return {queue: enqueue(items, queue, when) for queue, when in rules.items()}


def select_queues(labelled: DataFrame, queues: Sequence[str]) -> DataFrame:
    """Items labelled with one of the queues (exact match); unlabelled items go nowhere."""
    return labelled.where(F.col(QUEUE).isin([name.strip() for name in queues]))


def empty_queue(like: DataFrame, queue: str) -> DataFrame:
    """What a consumer of an undeclared queue reads: no items, the columns of the input."""
    return like.where(F.lit(False)).withColumn(QUEUE, F.lit(queue))
