"""Reading named streams from files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.lookup import lookup
from millrace.operators.ordering import MAX_TOP_K, running_total, source_limit
from millrace.operators.ranges import small_table

_BROKEN = "_broken_line"
#: Files whose sizes are added up on the driver; more are added up in buckets.
FEW_FILES = 10_000


def read_items(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A bounded source. A broken source is an error, not an empty stream."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_streams(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """Every source under its name; at least one is needed."""
    if not paths:
        raise ValueError("at least one source is needed")
    return {name: read_items(spark, path) for name, path in paths.items()}


def _parsed(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, T.StructType]:
    """The lines of a JSON source (`value`), each parsed once as one value (`item`), and the items' schema."""
    lines = spark.read.option("ignoreCorruptFiles", "true").text(path)
    shape = T._parse_datatype_string(schema)
    marked = T.StructType([*shape.fields, T.StructField(_BROKEN, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}
    return lines.withColumn("item", F.from_json("value", marked, options)), shape


_WHOLE = f"item IS NOT NULL AND item.{_BROKEN} IS NULL"


def read_tolerant(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON items; broken ones are left out and reading goes on, also past unreadable files.

    A line counts as broken by the whole schema, whichever columns are asked for afterwards: it is
    parsed once, as one value, which no projection narrows. `read_split` also gives the broken lines.
    """
    parsed, shape = _parsed(spark, path, schema)
    return parsed.where(_WHOLE).select(*(F.col("item").getField(name).alias(name) for name in shape.names))


def read_split(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Every line of a JSON source, parsed once: `item` (NULL where it is broken), and of a broken line its text
    (`broken`), its `file` and its `line` number in the file, from 1. Blank lines are neither.

    `good_items` and `broken_lines` take the two apart; write the whole first, or persist it, where both are
    wanted from one reading. Line numbers come from the order of lines inside a split and the lines of the splits
    before it, one row per split, so nothing is sorted or shuffled.
    """
    parsed, shape = _parsed(spark, path, schema)
    split = {"file": F.col("_metadata.file_path"), "_block": F.col("_metadata.file_block_start")}
    placed = parsed.select("value", "item", *(c.alias(n) for n, c in split.items()), F.monotonically_increasing_id().alias("_at"))
    sizes = placed.groupBy("file", "_block").agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("_first"))
    starts = running_total(sizes, ["file", "_block"], "n", "_all")
    of_file = Window.partitionBy("file")
    starts = starts.select("file", "_block", (F.col("_all") - F.min("_all").over(of_file)).alias("_before"), "_first")
    starts = starts.withColumnsRenamed({"file": "_file", "_block": "_start"})
    found = placed.join(starts, (F.col("file") == F.col("_file")) & (F.col("_block") == F.col("_start")))
    whole, filled = F.expr(_WHOLE), F.length(F.trim("value")) > 0
    item = F.when(whole, F.struct(*(F.col("item").getField(name).alias(name) for name in shape.names)))
    line = F.col("_before") + F.col("_at") - F.col("_first") + 1
    unless = lambda c: F.when(~whole, c)
    return found.where(filled).select(item.alias("item"), unless(F.col("value")).alias("broken"), unless(F.col("file")).alias("file"), unless(line).alias("line"))


def good_items(split: DataFrame) -> DataFrame:
    """The items of `read_split`."""
    return split.where("item IS NOT NULL").select("item.*")


def broken_lines(split: DataFrame) -> DataFrame:
    """The broken lines of `read_split`, to be looked at or repaired."""
    return split.where("item IS NULL").select("file", "line", "broken")


def read_live(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    max_files: int = 1_000,
    max_bytes: int | None = None,
) -> DataFrame:
    """An unbounded source over a growing folder of parquet files. One micro-batch takes in at most
    `max_files` files, or about `max_bytes` if given, so a backlog cannot swamp the
    cluster."""
    reader = spark.readStream.schema(schema)
    bound = {"maxBytesPerTrigger": max_bytes} if max_bytes else {"maxFilesPerTrigger": max_files}
    return reader.options(**bound).parquet(path)


def number_arrivals(items: DataFrame, name: str = "id") -> DataFrame:
    """Dense running numbers, from 0, in the order of the source: file by file, row by row.

    For a parquet scan the row's place in its file is known, so only the rows per file are counted
    (from file footers) and nothing is sorted or shuffled. `items` must come straight from
    `read_items`. A filter belongs after this step, or the numbers have gaps.
    """
    placed = items.withColumns({"_file": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")})
    few = _few_starts(items)
    if few is not None:
        known = small_table(items.sparkSession, [(path, start) for path, start, _ in few], "path string, _start long")
        found = placed.join(F.broadcast(known), F.col("_file") == F.col("path"))
        return found.withColumn(name, F.col("_start") + F.col("_row")).drop("_file", "_row", "_start", "path")
    # One row per file, added up in buckets of files: no task and not the driver sees them all.
    offsets = running_total(_file_counts(items), "path", "count", "_start")
    found = lookup(placed, offsets, "_file", "path", ["_start"])
    return found.withColumn(name, F.col("_start") + F.col("_row")).drop("_file", "_row", "_start")


def _file_counts(items: DataFrame) -> DataFrame:
    """Rows of every file, from the footers."""
    return items.select(F.col("_metadata.file_path").alias("path")).groupBy("path").count()


def _few_starts(items: DataFrame) -> list[tuple[str, int, int]] | None:
    """(file, rows before it, rows of it) in the order of the source; None for more than FEW_FILES files."""
    counts = _file_counts(items).limit(FEW_FILES + 1).collect()
    if len(counts) > FEW_FILES:
        return None
    out, before = [], 0
    for row in sorted(counts, key=lambda r: r["path"]):
        out.append((row["path"], before, row["count"]))
        before += row["count"]
    return out


def limit_items(items: DataFrame, limit: int, small: int = MAX_TOP_K) -> DataFrame:
    """The first `limit` items in the order of the source, for any limit and with no task that holds them all.

    `items` must come straight from `read_items`. Rows per file (from footers) say which files are taken whole,
    and in which one the limit falls: a row's place in its file decides there. Nothing is shuffled. Limits up to
    `small` are left to Spark's own plan, which stops reading early and takes any items.
    """
    if limit <= small:
        return source_limit(items, limit)
    few = _few_starts(items)
    if few is None:
        return number_arrivals(items, "_number").where(F.col("_number") < limit).drop("_number")
    takes = [(path, min(rows, limit - before)) for path, before, rows in few if before < limit]
    known = small_table(items.sparkSession, takes, "_path string, _rows long")
    placed = items.withColumns({"_file": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")})
    found = placed.join(F.broadcast(known), (F.col("_file") == F.col("_path")) & (F.col("_row") < F.col("_rows")))
    return found.drop("_file", "_row", "_path", "_rows")
