"""Columns for reading, testing and setting the attributes of an item."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: how a condition string names an attribute of the item.
_ATTRIBUTE = re.compile(r"%\{data\.([^}]+)\}")
#: The JSON column that holds an item's further attributes.
OPEN_PART = "props"
SAMPLED_WIDTHS = 1_000


def _path(key: str) -> str:
    """The JSON path of one key, whatever characters it has: `a.b` is a key, not a way."""
    if "'" in key:
        raise ValueError(f"a key cannot hold a quote: {key!r}")
    return f"$['{key}']"


def condition(test: Column | str, items: DataFrame | None = None, open_part: str = OPEN_PART) -> Column:
    """A test over one item: a Column, or a SQL string that may say `%{data.key}` for an attribute.

    With `items` given, a key that is no column is looked up in the JSON column `open_part`, and is
    NULL where that lacks it.
    """
    if not isinstance(test, str):
        return test
    columns = None if items is None else items.columns

    def named(match: re.Match) -> str:
        key = match[1]
        if columns is None or key in columns:
            return f"`{key}`"
        if open_part in columns:
            return f'get_json_object(`{open_part}`, "{_path(key)}")'
        return "NULL"

    return F.expr(_ATTRIBUTE.sub(named, test))


def attribute(open_part: Column | str, key: str, kind: str = "string") -> Column:
    """The value under `key` of a JSON column, NULL where the key is missing."""
    return F.get_json_object(open_part, _path(key)).cast(kind)


def has_attribute(open_part: Column | str, key: str) -> Column:
    """Whether a JSON column has a value under `key`; a null value counts as missing."""
    return F.get_json_object(open_part, _path(key)).isNotNull()


def with_attributes(items: DataFrame, open_part: str, *keys: str) -> DataFrame:
    """Items with the values of several keys of a JSON column as text, from one look at the JSON."""
    named = [f"_attribute{place}" for place in range(len(keys))]
    found = items.select("*", F.json_tuple(open_part, *keys).alias(*named))
    return found.withColumns({key: F.col(name) for key, name in zip(keys, named)}).drop(*named)


def put(items: DataFrame, key: str, value: object, open_part: str | None = None) -> DataFrame:
    """Items with `key` set; `value` is a Column or a constant.

    With `open_part`, the key is set inside that JSON column: other keys keep their values and types, a
    missing or broken JSON text becomes an object with this key alone.
    """
    new = value if isinstance(value, Column) else F.lit(value)
    if open_part is None:
        return items.withColumn(key, new)
    held = F.try_parse_json(F.col(open_part)).try_cast("map<string, variant>")
    others = F.map_filter(F.coalesce(held, F.create_map().cast("map<string, variant>")), lambda k, v: k != key)
    added = F.create_map(F.lit(key), new.cast("variant"))
    return items.withColumn(open_part, F.to_json(F.map_concat(others, added)))


class OpenPart:
    """The JSON column of some items, parsed once, changed by any number of puts, and written once.

    The keys of the column are held as one map of variants from `OpenPart` to `items`; other keys keep their
    values and types, a missing or broken JSON text is an object without keys.
    """

    _HELD = "_open_part"

    def __init__(self, items: DataFrame, open_part: str = OPEN_PART):
        self._name, self._names = open_part, items.columns
        held = F.try_parse_json(F.col(open_part)).try_cast("map<string, variant>")
        empty = F.create_map().cast("map<string, variant>")
        # Spark does not repeat a costly value that several others are made of: the text is parsed here only.
        self._items = items.withColumn(self._HELD, F.coalesce(held, empty))
        self._puts: dict[str, Column] = {}

    def get(self, key: str, kind: str = "string") -> Column:
        """The value under `key` as it is now, NULL where it is missing or of another type."""
        found = self._puts.get(key)
        return (F.try_element_at(F.col(self._HELD), F.lit(key)) if found is None else found).try_cast(kind)

    def put(self, key: str, value: object, when: Column | None = None) -> OpenPart:
        """Set a key; with `when`, only on items that pass the test."""
        new = (value if isinstance(value, Column) else F.lit(value)).cast("variant")
        if when is not None:
            old = self._puts.get(key)
            new = F.when(when, new).otherwise(F.try_element_at(F.col(self._HELD), F.lit(key)) if old is None else old)
        self._puts[key] = new
        return self

    def items(self, **columns: Column) -> DataFrame:
        """The items with the JSON column written; `columns` adds values that `get` gave."""
        kept = F.map_filter(F.col(self._HELD), lambda k, v: ~k.isin(*self._puts))
        added = [F.struct(F.lit(key).alias("key"), value.alias("value")) for key, value in self._puts.items()]
        new = F.col(self._HELD)
        if added:
            # A key put only on some items stays missing on those that never had it.
            new = F.map_concat(kept, F.map_from_entries(F.filter(F.array(*added), lambda e: e["value"].isNotNull())))
        text = F.to_json(new).alias(self._name)
        return self._items.select(*(text if name == self._name else F.col(f"`{name}`") for name in self._names), *(c.alias(n) for n, c in columns.items()))


def epoch_micros(items: DataFrame, name: str) -> Column:
    """Microseconds since 1970 of a time column.

    A timestamp without zone is taken apart field by field, so the session's time zone (and its
    daylight-saving gaps) cannot change a difference of two values.
    """
    value = F.col(name)
    if not isinstance(items.schema[name].dataType, T.TimestampNTZType):
        return F.unix_micros(value)
    days = F.datediff(value.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    seconds = days * 86_400 + F.hour(value) * 3_600 + F.minute(value) * 60
    micros = F.extract(F.lit("SECOND"), value) * 1_000_000
    return seconds * 1_000_000 + micros.cast("long")


def rows_within(items: DataFrame, rows: int, most_bytes: int) -> int:
    """`rows`, or fewer where so many would exceed `most_bytes`, by the mean width of a sample that every
    part of the input gives its share of, so that the order of rows decides nothing.

    Items of fixed width are taken as they come, without looking."""
    wide = (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType, T.VariantType)
    if items.isStreaming or not any(isinstance(field.dataType, wide) for field in items.schema):
        return rows
    count = items.count()
    share = 1.0 if count <= SAMPLED_WIDTHS else SAMPLED_WIDTHS / count
    some = items if share == 1 else items.where(F.rand(7) < share)
    width = some.agg(F.avg(F.length(F.to_json(F.struct("*"))))).first()[0]
    return max(1, min(rows, int(most_bytes / max(width or 1, 1))))


def merge_streams(*streams: DataFrame) -> DataFrame:
    """All items of several streams; an attribute a stream lacks is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), streams)
