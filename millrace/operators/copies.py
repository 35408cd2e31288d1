"""How many parallel instances work on a stream. Results never depend on it."""

from __future__ import annotations

from pyspark.sql import DataFrame


def parse_copies(value: object) -> int:
    """A `copies` setting as a number from 1. Anything else is an error: a slip of the pen must not
    send a whole stream through one task."""
    try:
        copies = int(str(value))
    except ValueError:
        copies = 0
    if copies < 1:
        raise ValueError(f"copies must be a number from 1, not {value!r}")
    return copies


def with_copies(items: DataFrame, copies: object) -> DataFrame:
    """Spread the items over `copies` instances, each item once. This shuffles: use it before heavy
    work on an input of too few splits, and select the needed columns first."""
    return items.repartition(parse_copies(copies))


def rescale(items: DataFrame, copies: object) -> DataFrame:
    """Lower the number of instances at the end of a chain without a shuffle."""
    return items.coalesce(parse_copies(copies))
