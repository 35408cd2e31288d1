"""Routing on a live stream, where all branches must come from one pass."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from millrace.operators.routing import QUEUE, Rules, emit, select_queues
from millrace.streaming.run import writer

BatchSink = Callable[[DataFrame, int], None]


def write_queues_live(
    items: DataFrame, rules: Rules, path: str, checkpoint: str | None = None
) -> DataStreamWriter:
    """Each queue to its own folder below `path`, exactly once (the file sink's own log). An item goes
    to every queue whose test it passes."""
    sink = writer(emit(items, rules), "queues", checkpoint=checkpoint)
    return sink.format("parquet").partitionBy(QUEUE).option("path", path)


def fan_out(
    items: DataFrame, rules: Rules, sinks: Mapping[str, BatchSink], checkpoint: str | None = None
) -> DataStreamWriter:
    """Each queue to its own sink. A micro-batch is labelled and kept once, then every sink gets its
    queue with the batch number. A batch may be delivered again after a failure, so a sink must
    write to a place named by that number."""
    unknown = set(sinks) - set(rules)
    if unknown:
        raise KeyError(f"no rule fills {sorted(unknown)}")

    def deliver(batch: DataFrame, number: int) -> None:
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for queue, sink in sinks.items():
                sink(select_queues(kept, [queue]), number)
        finally:
            kept.unpersist()

    return writer(emit(items, rules), "fan-out", checkpoint=checkpoint).foreachBatch(deliver)


def batch_folder(path: str, number: int) -> str:
    """Where a batch goes, so that a repeated one replaces itself."""
    return f"{path}/batch={number}"


def parquet_batches(path: str) -> BatchSink:
    def sink(items: DataFrame, number: int) -> None:
        items.write.mode("overwrite").parquet(batch_folder(path, number))

    return sink


def json_batches(path: str) -> BatchSink:
    def sink(items: DataFrame, number: int) -> None:
        items.write.mode("overwrite").json(batch_folder(path, number))

    return sink


def live_counts(items: DataFrame, *keys: str) -> DataFrame:
    """Running number of items, per key if any are given; pre-aggregated before the shuffle."""
    return items.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
