"""Keyed processes on a live stream: the same Python as on a batch, with its carried state in the state store."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle, TimerValues

from millrace.operators.keyed import Carry
from millrace.streaming.state import GROUP, grouped
from millrace.streaming.typed import ROCKS

_PLAIN = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _as_text(items: DataFrame) -> DataFrame:
    """Items with their columns as text, since pandas would make nullable whole numbers floats on the way."""
    odd = [f.name for f in items.schema if not isinstance(f.dataType, _PLAIN)]
    if odd:
        raise TypeError(f"a keyed step on a stream takes plain columns only, not {odd}; select what it needs")
    return items.select(*(F.col(f"`{name}`").cast("string").alias(name) for name in items.columns if name != GROUP), GROUP)


def _typed(pieces: list[pd.DataFrame], shape: pa.Schema) -> pd.DataFrame:
    """The text columns with their own types again."""
    columns = []
    for field in shape:
        texts = pa.array(pd.concat([p[field.name] for p in pieces]), pa.string(), from_pandas=True)
        if pa.types.is_timestamp(field.type):
            columns.append(texts.cast(pa.timestamp("us")).cast(field.type))
        else:
            columns.append(texts.cast(field.type))
    return pa.table(columns, schema=shape).to_pandas(types_mapper=pd.ArrowDtype)


class _Process(StatefulProcessor):
    """State: for each key of a group, the carried values up to the last micro-batch."""

    def __init__(self, process: Callable, key: str, order: Sequence[str], carries: Mapping[str, Carry], kinds: T.StructType, shape: pa.Schema):
        self._process, self._key, self._order = process, key, list(order)
        self._folds = {name: carry.fold for name, carry in carries.items()}
        self._kinds, self._shape = kinds, shape

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._state = handle.getMapState("carried", "known boolean, key string", self._kinds) if self._folds else None

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        items = _typed(list(rows), self._shape).sort_values([self._key, *self._order], ignore_index=True, na_position="first")
        codes = items.groupby(self._key, dropna=False, sort=False).ngroup()
        starts = (~codes.duplicated()).to_numpy().nonzero()[0]
        names = [(False, "") if pd.isna(v) else (True, str(v)) for v in items[self._key].iloc[starts]]
        if not self._folds:
            yield self._process(items)
            return
        nothing = (None,) * len(self._folds)
        held = [tuple(self._state.getValue(n)) if self._state.containsKey(n) else nothing for n in names]
        for name, before, start, end in zip(names, held, starts, [*starts[1:], len(items)]):
            piece = items.iloc[start:end]
            after = tuple(_plain(fold(old, piece)) for fold, old in zip(self._folds.values(), before))
            self._state.updateValue(name, after)
        for place, field in enumerate(to_arrow_schema(self._kinds)):
            values = pa.array([h[place] for h in held], field.type).take(pa.array(codes.to_numpy()))
            items[field.name] = pd.arrays.ArrowExtensionArray(values)
        yield self._process(items)


def _plain(value: object) -> object:
    """A value of Python from what pandas gives."""
    return None if value is pd.NA else value.item() if hasattr(value, "item") else value


def keyed_live(
    items: DataFrame,
    key: str,
    order: Sequence[str],
    process: Callable[[pd.DataFrame], pd.DataFrame],
    schema: str,
    carries: Mapping[str, Carry] | None = None,
    groups: int = 64,
) -> DataFrame:
    """`keyed_apply` on a stream: `process(rows)` gets the rows of many whole keys, sorted by key and order,
    with the state carried from earlier micro-batches as further columns.

    Each `Carry` needs its `fold`: the new value from the old one (None at a key's start) and the key's rows
    of this micro-batch in order. `order` holds inside a micro-batch, and batches follow one another as the
    source delivers them. Keys are dealt into `groups`, whose rows of one micro-batch are in memory together:
    bound the intake of the source. The number of groups is part of the stored state and stays for a job's life.
    """
    carries = dict(carries or {})
    lacking = [name for name, carry in carries.items() if carry.fold is None]
    if lacking:
        raise ValueError(f"on a stream the carries {lacking} need a fold")
    kinds = items.groupBy(key).agg(*(c.partial.alias(n) for n, c in carries.items())).drop(key).schema if carries else T.StructType()
    shape = to_arrow_schema(items.schema)
    items.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    dealt = _as_text(grouped(items, key, groups))
    processor = _Process(process, key, order, carries, kinds, shape)
    return dealt.groupBy(GROUP).transformWithStateInPandas(processor, schema, "append", "None")
