"""Three small jobs over a stream of items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.chain import item_count, set_value, skip
from millrace.operators.ordering import create_id
from millrace.operators.routing import QUEUE
from millrace.plans.flow import Enqueue, Flow


def routing_sample(data: DataFrame, order: str) -> Flow:
    """Number the items, flag them A and B in turn, send A to `gamma` and B to `hadron`."""
    flow = Flow({"data": data}, queues="gamma, hadron")
    flow.process(
        "separation",
        lambda items: create_id(items, order),
        lambda items: items.withColumn("flag", F.when(F.col("id") % 2 == 0, "A").otherwise("B")),
        Enqueue("gamma", when="%{data.flag} == 'A'"),
        Enqueue("hadron", when="%{data.flag} == 'B'"),
        skip(),
        input="data",
    )
    return flow


def queue_sample(data: DataFrame) -> DataFrame:
    """Send everything through queue `q1` to a process that marks where it came from."""
    flow = Flow({"data": data}, queues="q1")
    flow.process("reader", Enqueue("q1"), input="data")
    return flow.process("test", set_value("fromQueue", "true"), input="q1")


def count_sample(data: DataFrame) -> DataFrame:
    """Count the items."""
    return Flow({"data": data}).process("count", item_count, input="data")


def queue_counts(written: DataFrame) -> DataFrame:
    """How many items each queue got."""
    return written.groupBy(QUEUE).agg(F.count(F.lit(1)).alias("n"))
