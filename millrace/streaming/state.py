"""State per key on a live stream, kept in the checkpointed state store."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

SALT = "salt"
GROUP = "group"


class Context:
    """Values a process keeps for a key between micro-batches. They must be JSON values."""

    def __init__(self, values: dict | None = None):
        self.values = dict(values or {})

    def get(self, key: str, default: object = None) -> object:
        return self.values.get(key, default)

    def set(self, key: str, value: object) -> None:
        self.values[key] = value

    def contains(self, key: str) -> bool:
        return key in self.values


Process = Callable[[tuple, pd.DataFrame, Context], "pd.DataFrame | None"]


def salted(items: DataFrame, unique: str, salts: int) -> DataFrame:
    """Items with a `salt`, so that one key's items are shared by `salts` groups.

    The salt comes from the item and not from chance, so a repeated batch meets the same state.
    """
    return items.withColumn(SALT, F.pmod(F.xxhash64(unique), F.lit(salts)).cast("int"))


def grouped(items: DataFrame, key: str, groups: int) -> DataFrame:
    """Items with a `group`, which holds many whole keys.

    With state per group, its process keeps the values of each key in the context by itself; one
    Python call then serves many keys. The number of groups is part of the stored state: keep it
    for the life of a job.
    """
    return items.withColumn(GROUP, F.pmod(F.xxhash64(key), F.lit(groups)).cast("int"))


def combined(items: DataFrame, combine: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """Items shrunk where they are, piece by piece, before any shuffle.

    `combine` gives partial results of a piece, such as a count per key. However many items a key
    has, only one row per piece is left of them.
    """

    def run(pieces: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces:
            yield from combine(pa.Table.from_batches([piece])).to_batches()

    return items.mapInArrow(run, schema)


def keyed_state(
    items: DataFrame,
    keys: list[str],
    process: Process,
    output: str,
    start: Callable[[Context], None] | None = None,
) -> DataFrame:
    """Run `process(key, rows, context)` on the items of each key, batch by batch.

    `start` fills the context before the first item of a key. Rows of a key come in Arrow-sized
    pieces, never all at once. Where a key may be hot, feed it `combined` items; if the process
    needs the items themselves, group by key and `SALT` and merge the results of the salts. Plain
    counting needs no Python at all, see `live_counts`.
    """

    def run(key: tuple, pieces: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        context = Context(json.loads(state.get[0]) if state.exists else None)
        if not state.exists and start is not None:
            start(context)
        for piece in pieces:
            out = process(key, piece, context)
            if out is not None:
                yield out
        state.update((json.dumps(context.values),))

    return items.groupBy(*keys).applyInPandasWithState(
        run, output, "context string", "append", GroupStateTimeout.NoTimeout
    )
