"""Sources with code of one's own, on top of Spark's file splits.

Spark lists the files and cuts them by bytes (`spark.sql.files.maxPartitionBytes`); columns and filters
reach the scan. An instance runs on each split, is told which shard it is, and gives items of its own
from what the split holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


class ItemSource:
    """Reads the items of one shard. Subclass it and override `items`, and `init` for set-up."""

    def init(self, shard: int) -> None:
        """Called once per instance, before the first batch."""

    def items(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        """The items that a batch of the split gives: drop, change or add some."""
        return batch


def read_sharded(spark: SparkSession, path: str, schema: StructType | str, where: str | None = None) -> DataFrame:
    """The given columns of a parquet source, shard by shard as Spark splits it."""
    items = spark.read.schema(schema).parquet(path)
    return items if where is None else items.where(where)


def read_custom(
    spark: SparkSession, source: type[ItemSource], path: str, schema: StructType | str, where: str | None = None, **options: object
) -> DataFrame:
    """Items of a Python source class, one instance on each shard.

    `options` go to the class. The number of shards follows the bytes of the source. `where` is tested
    in the scan, before the class sees an item.
    """
    split = read_sharded(spark, path, schema, where)
    shape = split.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = to_arrow_schema(shape)
        instance = source(**options)
        instance.init(TaskContext.get().partitionId())
        for batch in batches:
            found = instance.items(batch)
            yield pa.RecordBatch.from_arrays([found.column(f.name).cast(f.type) for f in target], schema=target)

    return split.mapInArrow(run, shape)
