"""Typed state per key on a live stream: single values and maps whose entries are read and written one by one.

State lies in the checkpointed state store (RocksDB). Nothing is parsed or written as a whole: a key with a
million map entries costs what its batch touches. Every call from Python to the store is a message there and
back, so keys with their values, and the entries of a map, lie in pages of about PAGE, each read and written by one
call. For the same reason one call of the processor serves the many keys of a group.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from decimal import Decimal
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import MapState, StatefulProcessor, StatefulProcessorHandle, TimerValues

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Rows of a page on average: what one touched row costs at most, and the share of calls that are left.
PAGE = 64
#: Pages of one table that a task holds before it writes the changed ones and lets go of all.
HELD_PAGES = 4_096
#: Keys in one list of those that close at the same time.
DUE_KEYS = 4_096
GROUP = "group_of_keys"
_NAN = float("nan")


def shape_of(shape: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(shape) if isinstance(shape, str) else shape


def _tuples(value: object) -> object:
    """Rows inside a value as tuples, which the store takes."""
    if isinstance(value, (list, tuple)):
        return [_tuples(v) for v in value] if isinstance(value, list) else tuple(_tuples(v) for v in value)
    return value


def _same(kind: T.DataType) -> Callable[[object], object]:
    """Gives equal names the one form in which the store gives them back."""
    if isinstance(kind, T.IntegralType):
        return int
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        size = np.float32 if isinstance(kind, T.FloatType) else np.float64
        return lambda v: _NAN if v != v else float(size(v)) + 0.0
    if isinstance(kind, T.DecimalType):
        return lambda v: Decimal(v).quantize(Decimal(1).scaleb(-kind.scale))
    if isinstance(kind, T.BinaryType):
        return bytes
    return lambda v: v.item() if isinstance(v, np.generic) else v.to_pydatetime() if hasattr(v, "to_pydatetime") else _tuples(v)


def _page(name: tuple, pages: int) -> int:
    """Linear hashing: one page more splits one page and leaves the others as they are."""
    code, bits = zlib.crc32(repr(name).encode("utf-8", "surrogatepass")), pages.bit_length()
    at = code & ((1 << bits) - 1)
    return at if at < pages else code & ((1 << (bits - 1)) - 1)


class Pages:
    """Rows by name in pages of a map state; the number of pages grows with the rows, one split at a time.

    A page is stored by columns: one list for each field of the names, then of the rows.
    """

    def __init__(self, state: MapState, names: T.StructType, width: int):
        self._state, self._same, self._width = state, [_same(f.dataType) for f in names], len(names) + width
        self._held: dict[int, dict[tuple, tuple]] = {}
        self._changed: set[int] = set()
        self.pages = self.count = 0

    @staticmethod
    def stored(names: T.StructType, rows: T.StructType) -> T.StructType:
        """Schema of a page."""
        return T.StructType([T.StructField(f"c{i}", T.ArrayType(f.dataType)) for i, f in enumerate([*names, *rows])])

    def open(self, prefix: tuple, pages: int, count: int) -> None:
        """Go on with the table under `prefix`, of so many pages and rows; nothing is held yet."""
        self._prefix, self._held, self._changed = prefix, {}, set()
        self.pages, self.count = pages, count

    @property
    def held(self) -> int:
        return len(self._held)

    def name(self, values: tuple) -> tuple:
        return tuple(None if v is None else same(v) for same, v in zip(self._same, values, strict=True))

    def _read(self, page: int) -> dict[tuple, tuple]:
        names = len(self._same)
        rows = zip(*self._state.getValue((*self._prefix, page)))
        return {self.name(row[:names]): tuple(map(_tuples, row[names:])) for row in rows}

    def _at(self, page: int) -> dict[tuple, tuple]:
        if page not in self._held:
            if len(self._held) >= HELD_PAGES:
                self.flush()
                self._held = {}
            self._held[page] = self._read(page)
        return self._held[page]

    def get(self, name: tuple) -> tuple | None:
        return self._at(_page(name, self.pages)).get(name) if self.pages else None

    def put(self, name: tuple, row: tuple) -> None:
        if not self.pages:
            self.pages, self._held[0] = 1, {}
        page = _page(name, self.pages)
        rows = self._at(page)
        self.count += name not in rows
        rows[name] = row
        self._changed.add(page)
        while self.count > self.pages * PAGE:
            self._split()

    def _split(self) -> None:
        new, old = self.pages, self.pages - (1 << (self.pages.bit_length() - 1))
        rows = self._at(old)
        self.pages += 1
        self._held[new] = {name: rows.pop(name) for name in [n for n in rows if _page(n, self.pages) == new]}
        self._changed |= {old, new}

    def pop(self, name: tuple) -> None:
        if self.get(name) is not None:
            page = _page(name, self.pages)
            del self._at(page)[name]
            self._changed.add(page)
            self.count -= 1

    def items(self) -> Iterator[tuple[tuple, tuple]]:
        """All rows, page by page; not to be changed meanwhile."""
        for page in range(self.pages):
            yield from (self._held[page] if page in self._held else self._read(page)).items()

    def flush(self) -> None:
        for page in sorted(self._changed):
            rows = [name + row for name, row in self._held[page].items()]
            self._state.updateValue((*self._prefix, page), tuple(map(list, zip(*rows))) if rows else ([],) * self._width)
        self._changed = set()

    def clear(self) -> None:
        for page in range(self.pages):
            self._state.removeKey((*self._prefix, page))
        self.open(self._prefix, 0, 0)


class Value:
    """One value of a key: a mark whether it is set and its parts, from place `at` of the key's row."""

    def __init__(self, at: int, width: int):
        self._at, self._width = at, width
        self.row: list = []

    def get(self, default: object = None) -> object:
        found = tuple(self.row[self._at + 1 : self._at + 1 + self._width])
        return default if not self.row[self._at] else found[0] if len(found) == 1 else found

    def set(self, value: object) -> None:
        parts = value if isinstance(value, tuple) else (value,)
        if len(parts) != self._width:
            raise ValueError(f"{len(parts)} parts for a value of {self._width}")
        self.row[self._at : self._at + 1 + self._width] = [True, *parts]

    def clear(self) -> None:
        self.row[self._at : self._at + 1 + self._width] = [False] + [None] * self._width


class Entries:
    """A map of a key. Only the pages of the entries that are asked for are read."""

    def __init__(self, make: Callable[[], Pages], at: int):
        self._make, self._at = make, at
        self._tables: dict[tuple, Pages] = {}
        self._held = 0

    @staticmethod
    def _tuple(value: object) -> tuple:
        return value if isinstance(value, tuple) else (value,)

    def start(self, key: tuple, row: list) -> None:
        """Go on with the map of a key, whose size is at two places of the key's row."""
        self._key, self._row, self._rows = key, row, self._tables.get(key)
        self._before = self._rows.held if self._rows is not None else 0

    def _open(self) -> Pages:
        if self._rows is None:
            self._rows = self._tables[self._key] = self._make()
            self._rows.open(self._key, *self._row[self._at : self._at + 2])
        return self._rows

    def get(self, entry: object, default: object = None) -> object:
        rows = self._open()
        found = rows.get(rows.name(self._tuple(entry)))
        return default if found is None else found[0] if len(found) == 1 else found

    def set(self, entry: object, value: object) -> None:
        rows = self._open()
        rows.put(rows.name(self._tuple(entry)), self._tuple(value))

    def remove(self, entry: object) -> None:
        rows = self._open()
        rows.pop(rows.name(self._tuple(entry)))

    def __contains__(self, entry: object) -> bool:
        rows = self._open()
        return rows.get(rows.name(self._tuple(entry))) is not None

    def items(self) -> Iterator[tuple[tuple, tuple]]:
        """All entries, which must not change meanwhile: for results at the end of a key, not for every batch."""
        return self._open().items()

    def clear(self) -> None:
        self._open().clear()

    def close(self) -> None:
        """The size goes to the key's row; changes wait for `flush`, unless many pages are held."""
        if self._rows is not None:
            self._row[self._at : self._at + 2] = self._rows.pages, self._rows.count
            self._held += self._rows.held - self._before
            if self._held > HELD_PAGES:
                self.flush()

    def flush(self) -> None:
        """Write what changed for all keys and let go of it."""
        for rows in self._tables.values():
            rows.flush()
        self.drop()

    def drop(self) -> None:
        self._tables, self._held = {}, 0


@dataclass
class State:
    """The values and maps of one key, by name; `now` is the batch's processing time in milliseconds."""

    values: dict[str, Value]
    maps: dict[str, Entries]
    now: int = -1


Process = Callable[[tuple, pd.DataFrame, State], "pd.DataFrame | None"]
Finish = Callable[[tuple, State], "pd.DataFrame | None"]


class _Keyed(StatefulProcessor):
    """One instance per task, called for each group of keys.

    The row of a key has the time it is due to close, two places with the size of each map, and its values.
    """

    def __init__(self, process: Process, columns: list[str], keys: T.StructType, values: Mapping[str, T.StructType], maps: Mapping[str, tuple[T.StructType, T.StructType]], finish: Finish | None, idle_ms: int):
        self._process, self._columns, self._keys = process, list(columns), keys
        self._values, self._maps = dict(values), dict(maps)
        self._finish, self._idle = finish, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        page = T.StructField("page", T.IntegerType())
        names = T.StructType([T.StructField(f"k{i}", f.dataType) for i, f in enumerate(self._keys)])
        row, self._fresh = [T.LongType()], [None]
        maps, values = {}, {}
        for name, (entries, parts) in self._maps.items():
            state = handle.getMapState(f"map_{name}", T.StructType([*names, page]), Pages.stored(entries, parts))
            maps[name] = Entries(partial(Pages, state, entries, len(parts)), len(row))
            row += [T.IntegerType(), T.LongType()]
            self._fresh += [0, 0]
        for name, parts in self._values.items():
            values[name] = Value(len(row), len(parts))
            row += [T.BooleanType(), *(f.dataType for f in parts)]
            self._fresh += [False] + [None] * len(parts)
        rows = T.StructType([T.StructField("", kind) for kind in row])
        self._rows = Pages(handle.getMapState("keys", T.StructType([page]), Pages.stored(names, rows)), names, len(row))
        self._size = handle.getValueState("size", "pages int, count long")
        self._due = handle.getMapState("due", "at long, part int", Pages.stored(names, T.StructType()))
        self._state = State(values, maps)

    def _open(self, timers: TimerValues) -> None:
        self._state.now = timers.getCurrentProcessingTimeInMs()
        self._before = tuple(self._size.get()) if self._size.exists() else (0, 0)
        self._rows.open((), *self._before)
        for held in self._state.maps.values():
            held.drop()

    def _close(self) -> None:
        for held in (*self._state.maps.values(), self._rows):
            held.flush()
        if (size := (self._rows.pages, self._rows.count)) != self._before:
            self._size.update(size)

    def _start(self, key: tuple, found: tuple | None) -> list:
        row = list(self._fresh if found is None else found)
        for held in self._state.values.values():
            held.row = row
        for held in self._state.maps.values():
            held.start(key, row)
        return row

    def _each(self, piece: pd.DataFrame) -> Iterator[tuple[tuple, pd.DataFrame]]:
        """The keys of a piece and their rows, in the order they came."""
        piece = piece.iloc[:, : len(self._columns)]
        piece.columns = self._columns
        keys = [f.name for f in self._keys]
        codes = piece.groupby(keys, sort=False, dropna=False).ngroup().to_numpy()
        order = np.argsort(codes, kind="stable")
        sorted_rows, codes = piece.iloc[order], codes[order]
        cuts = [0, *(np.flatnonzero(np.diff(codes)) + 1).tolist(), len(codes)]
        names = sorted_rows[keys].iloc[cuts[:-1]].itertuples(index=False, name=None)
        for name, low, high in zip(names, cuts, cuts[1:]):
            rows = sorted_rows.iloc[low:high]
            rows.index = pd.RangeIndex(high - low)
            yield self._rows.name(tuple(None if v is None or v != v else v for v in name)), rows

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        self._open(timerValues)
        touched: dict[tuple, None] = {}
        due = self._state.now + self._idle

        def results() -> Iterator[pd.DataFrame | None]:
            for piece in rows:
                for name, own in self._each(piece):
                    found = self._rows.get(name)
                    row = self._start(name, found)
                    yield self._process(name, own, self._state)
                    for held in self._state.maps.values():
                        held.close()
                    if self._finish is not None:
                        row[0] = due
                        touched[name] = None
                    if row != self._fresh:
                        self._rows.put(name, tuple(row))
                    elif found is not None:
                        self._rows.pop(name)

        yield from joined(results())
        self._close()
        if self._finish is not None:
            names, part = list(touched), 0
            while self._due.containsKey((due, part)):
                part += 1
            for low in range(0, len(names), DUE_KEYS):
                self._due.updateValue((due, part), tuple(map(list, zip(*names[low : low + DUE_KEYS]))))
                part += 1
            self._handle.registerTimer(due)

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Close the keys that were to close at this time, but for those that got items since."""
        self._open(timerValues)
        due = expiredTimerInfo.getExpiryTimeInMs()

        def results() -> Iterator[pd.DataFrame | None]:
            part = 0
            while self._due.containsKey((due, part)):
                for name in map(self._rows.name, zip(*self._due.getValue((due, part)))):
                    found = self._rows.get(name)
                    if found is not None and found[0] == due:
                        self._start(name, found)
                        yield self._finish(name, self._state)
                        for held in self._state.maps.values():
                            held.clear()
                        self._rows.pop(name)
                self._due.removeKey((due, part))
                part += 1

        yield from joined(results())
        self._close()


def joined(results: Iterator[pd.DataFrame | None]) -> Iterator[pd.DataFrame]:
    """Results of the same columns and types one below the other, some thousand rows at once."""
    held: list[pd.DataFrame] = []
    shape, size = None, 0
    for out in results:
        if out is None or not len(out):
            continue
        now = [*zip(out.columns, out.dtypes)]
        if held and (now != shape or size + len(out) > 10_000):
            yield pd.concat(held, ignore_index=True)
            held, size = [], 0
        held.append(out)
        shape, size = now, size + len(out)
    if held:
        yield pd.concat(held, ignore_index=True)


def typed_state(
    items: DataFrame,
    keys: list[str],
    process: Process,
    output: T.StructType | str,
    values: Mapping[str, str] | None = None,
    maps: Mapping[str, tuple[str, str]] | None = None,
    finish: Finish | None = None,
    idle_seconds: float = 600,
    groups: int = 128,
) -> DataFrame:
    """Run `process(key, rows, state)` on the items of each key, batch by batch.

    `values` names the single values with their schemas, `maps` the maps with the schemas of their entries'
    names and values; they cannot change while a checkpoint lives. With `finish`, a key without items for
    `idle_seconds` of processing time is closed: `finish(key, state)` gives its last result, once, and its
    state is gone; an item that comes later starts the key anew. Rows of a key come in Arrow-sized pieces.

    Keys are dealt into `groups`, each worked on by one task at a time. Their number is part of the stored state and
    stays for a job's life. A null or NaN in a key is None.

    The state needs the RocksDB store, which is set for the session here.
    """
    items.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    values = {name: shape_of(shape) for name, shape in (values or {}).items()}
    maps = {name: (shape_of(names), shape_of(rows)) for name, (names, rows) in (maps or {}).items()}
    if GROUP in items.columns:
        raise ValueError(f"a column must not be named {GROUP}")
    shape = T.StructType([items.schema[k] for k in keys])
    processor = _Keyed(process, items.columns, shape, values, maps, finish, int(idle_seconds * 1000))
    time = "ProcessingTime" if finish is not None else "None"
    dealt = items.withColumn(GROUP, F.pmod(F.xxhash64(*(F.col(f"`{k}`") for k in keys)), F.lit(groups)).cast("int"))
    return dealt.groupBy(GROUP).transformWithStateInPandas(processor, output, "append", time)
