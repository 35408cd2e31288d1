"""Tables that are written once in the shared folder and read again, and ids that may be null."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import table, work_dir

#: Words of a text, as a pattern of Spark SQL and of Python.
WORD = r"[^\x20\x09-\x0D]+"

#: Paths of the tables that are written inside a `scratch`, of this thread.
_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)

_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    """`rows` as a table below `spark.checkpoint.dir`: computed once, safe when executors are lost.

    The shuffles behind it are of no use afterwards and are removed as soon as it is written.
    """
    path = work_dir(spark, name)
    if (made := _MADE.get()) is not None:
        made.append(path)
    before = spark.conf.get(_CLEAN, "false")
    spark.conf.set(_CLEAN, "true")
    try:
        rows.select("*").write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEAN, before)
    return spark.read.schema(rows.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Tables that are written inside are removed at the end, but for those taken off the list: results of the
    work inside that are still lazy need theirs, so write them before it ends."""
    made: list[str] = []
    token = _MADE.set(made)
    try:
        yield made
    finally:
        _MADE.reset(token)
        for path in made:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of a folder of tables."""
    return table(spark, folder, "documents")


def spread(spark: SparkSession) -> int:
    """Tasks to deal work to that is heavier than its bytes."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def hashed_sample(rows: DataFrame, key: Column, wanted: int, count: int, salt: str) -> DataFrame:
    """About `wanted` of `count` rows and at most twice as many: those whose hashed key is small.

    Rows are chosen where they are, so nothing but the sample is ever moved.
    """
    share = min(1.0, wanted / max(count, 1))
    chosen = F.pmod(F.xxhash64(F.lit(salt), key), F.lit(1 << 30)) < F.lit(round(share * (1 << 30)))
    return rows.where(chosen).limit(2 * wanted)


def fold(doc_id):
    """crc32 of the id as text, modulo 4: the folds of the language query."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4
