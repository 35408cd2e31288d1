"""Cutting items into ranges of an order, where a range is a value computed from the row alone.

A sample only decides how even the ranges are. Since no task number is involved, a lost executor or
another partition count puts no row into another range.
"""

from __future__ import annotations

import json
import math
from bisect import bisect_right
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from millrace.functions import epoch_micros

NUMBER = "_number"
POINT = "_point"
_TEXT_BYTES = 6  # what a double holds exactly
_JSON = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
_EXACT = 1 << 53  # whole numbers below are doubles of their own


@dataclass(frozen=True)
class Scale:
    """Puts the numbers of a column behind an index: all of index 1 come after all of index 0.

    Numbers beyond the bounds go to the nearest place outside them.
    """

    low: float
    high: float

    @property
    def width(self) -> float:
        return float(1 << math.ceil(math.log2(self.high - self.low + 5)))

    def place(self, index: int, number: float | None) -> float:
        if number is None:
            return index * self.width
        if math.isnan(number):
            return index * self.width + (self.high - self.low + 4)
        return index * self.width + (min(max(number, self.low - 1), self.high + 1) - self.low + 2)

    def column(self, index: Column, number: Column) -> Column:
        inside = F.least(F.greatest(number, F.lit(self.low - 1)), F.lit(self.high + 1)) - self.low + 2
        place = F.when(number.isNull(), 0.0).when(F.isnan(number), self.high - self.low + 4).otherwise(inside)
        return index * self.width + place

    def is_exact(self, number: float | None, kind: T.DataType, indexes: int) -> bool:
        """Whether all rows at a place have the same index and value."""
        whole = (T.IntegralType, T.DateType, T.TimestampType, T.TimestampNTZType)
        fits = indexes * self.width < _EXACT and max(abs(self.low), abs(self.high)) < _EXACT
        if number is None or not isinstance(kind, whole) or not fits:
            return False
        offset = number % self.width
        return offset == 0 or 2 <= offset <= self.high - self.low + 2


def scale_for(numbers: Sequence[float | None]) -> Scale | None:
    """Bounds around sampled numbers; None if they lie too far apart."""
    finite = [number for number in numbers if number is not None and math.isfinite(number)]
    low, high = (min(finite), max(finite)) if finite else (0.0, 0.0)
    return Scale(low, high) if high - low < float(1 << 60) else None


def is_exact(number: float | None, kind: T.DataType) -> bool:
    """Whether all rows with a `number_of` have the same value, and a range to themselves."""
    if number is not None and math.isinf(math.nextafter(number, math.inf)):
        return False
    if isinstance(kind, T.DecimalType):
        return number is None or kind.precision <= 15
    if isinstance(kind, (T.LongType, T.TimestampType, T.TimestampNTZType)):
        return number is None or abs(number) < _EXACT
    if kind == T.StringType():
        return number is None
    return isinstance(kind, (T.NumericType, T.DateType))


@dataclass(frozen=True)
class Cuts:
    """Cut values over the columns of `schema`, beginning with a number for `level`, one of them.

    `lead` cuts the numbers into ranges; they count from 0, then comes one for NaN and one for rows
    without a number. Ranges that hold too many rows of one number are cut further: those in
    `entered` by the next column (`deeper`, with numbers by `scale`), those in `searched` along all
    columns at the `points`, kept as JSON. `starts` and `widths` number all the pieces in order.
    """

    schema: T.StructType
    level: int
    lead: tuple[float, ...]
    starts: tuple[int, ...]
    widths: tuple[int, ...]
    bases: tuple[int, ...]
    searched: tuple[bool, ...]
    points: tuple[str, ...]
    entered: tuple[bool, ...]
    deeper: Cuts | None
    scale: Scale | None
    prefix: str = ""

    def range_of(self, number: float | None) -> int:
        return _range_of(self.lead, number)


def _range_of(lead: Sequence[float], number: float | None) -> int:
    if number is None:
        return len(lead) + 2
    return len(lead) + 1 if math.isnan(number) else bisect_right(lead, number)


def text_number(text: str | None, prefix: str) -> float | None:
    """The place of a text among those that begin with `prefix`, by the bytes after it."""
    if text is None:
        return None
    if not text.startswith(prefix):
        return -1.0 if text < prefix else float(1 << 8 * _TEXT_BYTES)
    return float(int.from_bytes(text.removeprefix(prefix).encode()[:_TEXT_BYTES].ljust(_TEXT_BYTES, b"\0"), "big"))


def _text_number_column(value: Column, prefix: str) -> Column:
    rest = F.substring(value.cast("binary"), len(prefix.encode()) + 1, _TEXT_BYTES)
    place = F.conv(F.rpad(F.hex(rest), 2 * _TEXT_BYTES, "0"), 16, 10).cast("double")
    if not prefix:
        return place
    outside = F.when(value < prefix, -1.0).otherwise(float(1 << 8 * _TEXT_BYTES))
    return F.when(value.startswith(prefix), place).when(value.isNotNull(), outside)


def number_of(items: DataFrame, name: str, prefix: str = "") -> Column:
    """A double that never decreases while the column grows, NULL for kinds of columns without one.

    Several values may share a double. Texts go by the bytes after the `prefix` they have in common.
    """
    kind, value = items.schema[name].dataType, F.col(name)
    if kind == T.StringType():
        return _text_number_column(value, prefix)
    if isinstance(kind, T.DateType):
        return F.datediff(value, F.lit("1970-01-01").cast("date")).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        return epoch_micros(items, name).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value).cast("double")
    if isinstance(kind, T.NumericType):
        return value.cast("double") + 0.0  # makes one zero of the two
    return F.lit(None).cast("double")


def number_columns(items: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Items with the number of each column."""
    return items.withColumns({f"{NUMBER}{place}": number_of(items, name) for place, name in enumerate(columns)})


def pick_points(
    keys: DataFrame, order: Sequence[str], fraction: float, step: int, within: Sequence[str] = ()
) -> list[Row]:
    """Every `step`-th row of a sample along the order, in that order, with its POINT and the number
    of each column.

    Choose the fraction so that the sample is fit for one task: it is sorted as a whole, or per
    `within`. Only the picked rows reach the driver.
    """
    rank = F.row_number().over(Window.partitionBy(*within).orderBy(*order))
    ranked = keys.sample(fraction=fraction, seed=17).withColumn("_rank", rank)
    picked = ranked.where((F.col("_rank") > 1) & ((F.col("_rank") - 1) % step == 0))
    points = number_columns(picked.withColumn(POINT, F.to_json(F.struct(*order), _JSON)), order)
    if within:
        points = points.repartition(1).sortWithinPartitions(*order)
    return points.collect()  # without `within`, the window has sorted them in one task


def cuts_at(
    points: Sequence[Row],
    numbers: Sequence[float | None],
    schema: T.StructType,
    level: int,
    exact: Callable[[float | None], bool],
    prefix: str = "",
) -> Cuts:
    """Cuts at picked rows, in order, with their numbers at `level`. `exact` tells of a number
    whether all its rows are alike up to that column, so that the next column can cut them."""
    lead, crowded = set(), []
    for _, same in groupby(zip(points, numbers), key=lambda pair: str(pair[1])):
        same = list(same)
        number = same[0][1]
        ends = [] if number is None else [number]
        if len(same) > 1:
            crowded.append((number, [point for point, _ in same]))
            ends += [math.nextafter(end, math.inf) for end in ends]
        lead.update(end for end in ends if math.isfinite(end))
    lead = sorted(lead)
    count = len(lead) + 3
    in_turn = [count - 1, *range(count - 1)]  # rows without a number come first
    turns = {place: turn for turn, place in enumerate(in_turn)}
    placed = [(_range_of(lead, number), number, rows) for number, rows in crowded]
    next_number = f"{NUMBER}{level + 1}"
    enter, scale, deeper = [], None, None
    if level + 1 < len(schema):
        enter = [(place, rows) for place, number, rows in placed if exact(number)]
        scale = scale_for([row[next_number] for _, rows in enter for row in rows])
    if enter and scale:
        inner = [(row, scale.place(turns[place], row[next_number])) for place, rows in enter for row in rows]
        inner.sort(key=lambda pair: pair[1])
        kind = schema[level + 1].dataType
        deeper = cuts_at(*zip(*inner), schema, level + 1, lambda number: scale.is_exact(number, kind, count))
    entered = {place for place, _ in enter} if deeper else set()
    search = {}
    for place, _, rows in placed:
        if place not in entered:
            search.setdefault(place, []).extend(row[POINT] for row in rows)

    starts, widths, bases = [0] * count, [1] * count, [0] * count
    start, passed = 0, 0
    for place in in_turn:
        starts[place] = start
        bases[place] = start
        if place in search:
            widths[place] = len(search[place]) + 1
            bases[place] -= passed
            passed += len(search[place])
        elif place in entered:
            first = deeper.range_of(scale.place(turns[place], None))
            last = deeper.range_of((turns[place] + 1) * scale.width - 1)
            widths[place] = deeper.starts[last] + deeper.widths[last] - deeper.starts[first]
            bases[place] -= deeper.starts[first]
        start += widths[place]
    in_order = [point for place in in_turn for point in search.get(place, ())]
    return Cuts(
        schema,
        level,
        tuple(lead),
        tuple(starts),
        tuple(widths),
        tuple(bases),
        tuple(place in search for place in range(count)),
        tuple(in_order),
        tuple(place in entered for place in range(count)),
        deeper,
        scale,
        prefix,
    )


def _list_literal(values: str, kind: T.DataType) -> Column:
    # One literal, folded from JSON: thousands of single literals would take the planner minutes.
    return F.from_json(F.lit(f"[{values}]"), T.ArrayType(kind), _JSON)


def _cuts_passed(cuts: Cuts) -> Column:
    """How many of the points lie at or before a row: a binary search in the list of points.

    Struct comparison is the sort order of the columns, NULL first.
    """
    names, total = cuts.schema.names, len(cuts.points)
    # Sorted once more, should a kind of value come back from JSON in another order.
    points = F.sort_array(_list_literal(",".join(cuts.points), cuts.schema))
    jumps = [1 << i for i in reversed(range(total.bit_length()))]

    def passed(row: Column) -> Column:
        def search(found: Column, jump: Column) -> Column:
            ahead = found + jump
            return F.when((ahead <= total) & (F.get(points, ahead - 1) <= row), ahead).otherwise(found)

        return F.aggregate(F.array(*map(F.lit, jumps)), F.lit(0), search)

    # The array of one makes the struct of a row once, not at each step of the search.
    return F.get(F.transform(F.array(F.struct(*names)), passed), 0)


def with_ranges(items: DataFrame, cuts: Cuts, name: str) -> DataFrame:
    """Items, which have their NUMBER, with the range they fall in. Ranges grow along the order.

    Numbers alone decide, in generated code; only where they cannot tell rows apart are these
    searched for in the list of points.
    """
    place, inner = f"_range{cuts.level}", f"_inner{cuts.level}"
    if cuts.lead:
        splits = [-math.inf, *cuts.lead, math.inf]
        finder = Bucketizer(splits=splits, inputCol=NUMBER, outputCol=place, handleInvalid="keep")
        found = F.col(place).cast("int")
        items = finder.transform(items)
    else:
        found = F.when(F.isnan(NUMBER), 1).when(F.col(NUMBER).isNotNull(), 0)
    items = items.withColumn(place, F.coalesce(found, F.lit(len(cuts.lead) + 2)))

    def listed(values: Sequence, kind: T.DataType) -> Column:
        return F.get(_list_literal(json.dumps(values)[1:-1], kind), F.col(place))

    number = listed(cuts.bases, T.IntegerType())
    if cuts.points:
        number = number + F.when(listed(cuts.searched, T.BooleanType()), _cuts_passed(cuts)).otherwise(0)
    if cuts.deeper:
        next_number = number_of(items, cuts.schema.names[cuts.level + 1])
        turn = (F.col(place) + 1) % (len(cuts.lead) + 3)
        behind = cuts.scale.column(turn.cast("double"), next_number)
        entered = listed(cuts.entered, T.BooleanType())
        items = with_ranges(items.withColumn(NUMBER, F.when(entered, behind)), cuts.deeper, inner)
        number = number + F.when(entered, F.col(inner)).otherwise(0)
    return items.withColumn(name, number).drop(NUMBER, place, inner)


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """A table of a few rows held in the plan itself; no task has to make it."""
    kinds = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    columns = list(zip(*rows)) if rows else [()] * len(kinds)
    return spark.createDataFrame(pa.table(list(map(pa.array, columns, to_arrow_schema(kinds).types)), kinds.names))
