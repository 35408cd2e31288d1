"""Dense running numbers on a live stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from millrace.operators.ordering import number_rows
from millrace.streaming.routing import batch_folder
from millrace.streaming.run import writer


def _next_number(spark: SparkSession, path: str, batch: int) -> int:
    """Where the numbers of a batch start: what the batch before it left behind."""
    if batch == 0:
        return 0
    return spark.read.schema("next long").json(batch_folder(path, batch - 1)).first()["next"]


def number_live(
    items: DataFrame,
    order: str | Sequence[str],
    path: str,
    name: str = "id",
    checkpoint: str | None = None,
) -> DataStreamWriter:
    """Number the items, batch after batch and along `order` inside a batch, into parquet files below
    `path`/items.

    The number a batch ends with is stored beside the items under the batch's own name. A batch that
    is delivered again starts from the same number and replaces its files, and a restarted job goes
    on from the files, not from driver memory.
    """

    def deliver(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        start = _next_number(spark, f"{path}/next", number)
        target = batch_folder(f"{path}/items", number)
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            counted = Observation()
            numbered = number_rows(kept, order, name, start=start).observe(counted, F.count(F.lit(1)).alias("items"))
            numbered.write.mode("overwrite").parquet(target)
            count = counted.get["items"]
        finally:
            kept.unpersist()
        ended = spark.createDataFrame([(start + count,)], "next long").coalesce(1)
        ended.write.mode("overwrite").json(batch_folder(f"{path}/next", number))

    return writer(items, "numbering", checkpoint=checkpoint).foreachBatch(deliver)


def numbered_stage(
    items: DataFrame, order: str | Sequence[str], path: str, name: str, checkpoint: str
) -> DataStreamWriter:
    """`number_live` for a stage that a later query follows while it runs.

    A batch is written aside and then gets its place below `path`/items by one rename, so readers see all of
    it or nothing. A batch that is delivered again and has its place already is left alone: what followed it
    has read those files.
    """

    def deliver(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        hadoop = spark._jvm.org.apache.hadoop.fs.Path
        place = hadoop(batch_folder(f"{path}/items", number))
        files = place.getFileSystem(spark._jsc.hadoopConfiguration())
        if files.exists(place):
            return
        start = _next_number(spark, f"{path}/next", number)
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            counted = Observation()
            numbered = number_rows(kept, order, name, start=start).observe(counted, F.count(F.lit(1)).alias("items"))
            aside = batch_folder(f"{path}/aside", number)
            numbered.write.mode("overwrite").parquet(aside)
            count = counted.get["items"]
        finally:
            kept.unpersist()
        ended = spark.createDataFrame([(start + count,)], "next long").coalesce(1)
        ended.write.mode("overwrite").json(batch_folder(f"{path}/next", number))
        files.mkdirs(place.getParent())
        if not files.rename(hadoop(aside), place):
            raise OSError(f"cannot publish batch {number} of {path}")

    return writer(items, "numbering", checkpoint=checkpoint).foreachBatch(deliver)


def stage_items(items: DataFrame, path: str, name: str) -> DataFrame:
    """The published batches of a `numbered_stage` as a stream. It takes in whole batches, all that wait."""
    shape = T.StructType([*items.schema.fields, T.StructField(name, T.LongType())])
    spark = items.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/items")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    return spark.readStream.schema(shape).parquet(f"{path}/items/batch=*")


_RATE = "block long, n long, first long, last long"


def rate_live(
    items: DataFrame, order: str | Sequence[str], micros: Column, every: int, path: str, checkpoint: str | None = None
) -> DataStreamWriter:
    """`data_rate` of a stream: per block of `every` items how many there are and over how many microseconds.

    Blocks that are full go to `path`/rates. The block a batch leaves open, one row of its count and times, and
    the number of items so far lie under the batch's number, and the next batch goes on from them, so a
    batch that is delivered again starts from the same and replaces itself.
    """

    def deliver(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = spark.read.schema(_RATE).json(batch_folder(f"{path}/open", number - 1)).first() if number else None
        start = before["block"] * every + before["n"] if before else 0
        kept = batch.select(*([order] if isinstance(order, str) else order), micros.alias("_micros")).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            turns = number_rows(kept, order, "_turn", start=start)
            sums = turns.groupBy(F.expr(f"_turn div {int(every)}").alias("block")).agg(
                F.count(F.lit(1)).alias("n"), F.min("_micros").alias("first"), F.max("_micros").alias("last")
            )
            if before and before["n"]:
                held = spark.createDataFrame([before], _RATE)
                sums = sums.unionByName(held).groupBy("block").agg(F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last"))
            sums.write.mode("overwrite").parquet(batch_folder(f"{path}/sums", number))
        finally:
            kept.unpersist()
        done = spark.read.schema(_RATE).parquet(batch_folder(f"{path}/sums", number))
        done.where(F.col("n") == every).write.mode("overwrite").parquet(batch_folder(f"{path}/rates", number))
        left = done.where(F.col("n") < every).first()  # the last block of a batch at most
        if left is None:  # nothing came, or the last block is full
            last = done.agg(F.max("block")).first()[0]
            left = before or (0, 0, None, None) if last is None else (last + 1, 0, None, None)
        spark.createDataFrame([tuple(left)], _RATE).coalesce(1).write.mode("overwrite").json(batch_folder(f"{path}/open", number))

    return writer(items, "rates", checkpoint=checkpoint).foreachBatch(deliver)


def rates_so_far(spark: SparkSession, path: str) -> DataFrame:
    """Full blocks, and the one that is open, as `data_rate` gives them."""
    full = spark.read.schema(_RATE).parquet(f"{path}/rates/batch=*")
    open_blocks = spark.read.schema(_RATE).json(f"{path}/open/batch=*").select("*", F.col("_metadata.file_path").alias("path"))
    number = F.regexp_extract("path", r"batch=(\d+)", 1).cast("long")
    last = open_blocks.groupBy().agg(F.max_by(F.struct("block", "n", "first", "last"), number).alias("last")).select("last.*")
    rates = full.unionByName(last.where("n > 0"))
    return rates.select("block", "n", (F.col("last") - F.col("first")).alias("span_us"))
