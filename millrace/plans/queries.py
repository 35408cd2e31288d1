"""The registered queries: each takes (spark, folder of the tables) and returns a DataFrame."""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import OpenPart, attribute, epoch_micros, merge_streams, with_attributes
from millrace.operators import chain as c
from millrace.operators import keyed as k
from millrace.operators import ordering as o
from millrace.operators import routing as r
from millrace.operators.copies import rescale, with_copies
from millrace.operators.lookup import lookup
from millrace.plans import samples
from millrace.plans.flow import Enqueue, Flow, Keyed
from millrace.session import table, work_dir
from millrace.sinks import files as sinks
from millrace.sources import sharded, synthetic, tables

ERROR = "event_type = 'error'"
CLICK = "event_type = 'click'"
HIGH = "value > 10"
OVERLAPPING = {"gamma": ERROR, "hadron": HIGH}


def _events(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    events = table(spark, folder, "events")
    return events.select(*columns) if columns else events


# Sources


def source_scan(spark: SparkSession, folder: str) -> DataFrame:
    return _events(spark, folder, "event_id", "user_id", "event_type", "value")


def multi_source(spark: SparkSession, folder: str) -> DataFrame:
    streams = tables.read_streams(spark, {name: f"{folder}/{name}.parquet" for name in ("events", "orders")})
    counts = [
        c.item_count(items).select(F.lit(name).alias("source"), "n") for name, items in streams.items()
    ]
    return merge_streams(*counts)


def sharded_source(spark: SparkSession, folder: str) -> DataFrame:
    schema = "event_id long, event_type string, value double"
    return sharded.read_sharded(spark, f"{folder}/events.parquet", schema)


class BigOrders(sharded.ItemSource):
    """A source of one's own: leaves out orders of small total while it reads."""

    def __init__(self, least: float):
        self.least = least

    def items(self, batch):
        return batch.filter(pc.greater(batch.column("o_totalprice"), self.least))


def custom_source(spark: SparkSession, folder: str) -> DataFrame:
    schema = "o_orderkey long, o_custkey long, o_totalprice double"
    return sharded.read_custom(spark, BigOrders, f"{folder}/orders.parquet", schema, least=100_000.0)


def random_source(spark: SparkSession, folder: str) -> DataFrame:
    """Two drawn attributes on every event; per attribute, whether it looks standard normal."""
    items = synthetic.with_gaussian(_events(spark, folder, "event_id"), "event_id", ["att1", "att2"])
    each = [F.struct(F.lit(name).alias("att"), F.col(name).alias("x")) for name in ("att1", "att2")]
    pairs = items.select(F.inline(F.array(*each)))
    slack = 6 / F.sqrt(F.count("x"))  # six standard errors
    return pairs.groupBy("att").agg(
        F.count("x").alias("n"),
        (F.abs(F.avg("x")) < slack).alias("mean_is_0"),
        (F.abs(F.stddev("x") - 1) < slack).alias("sd_is_1"),
    )


def constant_source(spark: SparkSession, folder: str) -> DataFrame:
    return synthetic.with_constants(_events(spark, folder, "event_id"))


def source_limit(spark: SparkSession, folder: str) -> DataFrame:
    return o.source_limit(_events(spark, folder, "event_id"), 1_000, "event_id")


def _broken_lines(spark: SparkSession, folder: str) -> str:
    """Events as JSON lines, those of type error cut short and those of clicks with a wrong type."""
    wrong = F.to_json(F.struct("event_id", "event_type", F.lit("none").alias("value")))
    line = F.to_json(F.struct("event_id", "event_type", "value"))
    cut = F.when(F.expr(ERROR), F.substring(line, 1, 14)).when(F.expr(CLICK), wrong).otherwise(line)
    path = work_dir(spark, "broken-lines")
    _events(spark, folder).select(cut.alias("line")).write.text(path)
    return path


ITEM = "event_id long, event_type string, value double"


def tolerant_read(spark: SparkSession, folder: str) -> DataFrame:
    return tables.read_tolerant(spark, _broken_lines(spark, folder), ITEM)


def tolerant_split(spark: SparkSession, folder: str) -> DataFrame:
    """Good items and broken lines from one reading, written once and taken apart."""
    split = tables.read_split(spark, _broken_lines(spark, folder), ITEM)
    path = work_dir(spark, "split-lines")
    split.write.parquet(path)
    both = spark.read.schema(split.schema).parquet(path)
    good = tables.good_items(both).select(F.lit("item").alias("kind"), "event_id", F.lit(None).cast("string").alias("broken"))
    bad = tables.broken_lines(both).where("line > 0 AND file IS NOT NULL")
    return good.unionByName(bad.select(F.lit("broken").alias("kind"), F.lit(None).cast("long").alias("event_id"), "broken"))


def large_limit(spark: SparkSession, folder: str) -> DataFrame:
    """Two thirds of the line items, in the order of the source: how many, and whether they are the first ones."""
    path = work_dir(spark, "limited")
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber")
    lines.repartitionByRange(6, "l_orderkey", "l_linenumber").sortWithinPartitions("l_orderkey", "l_linenumber").write.parquet(path)
    wanted = 2 * lines.count() // 3
    taken = tables.limit_items(tables.read_items(spark, path), wanted, small=0)
    return taken.agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("l_orderkey", "l_linenumber")).alias("last")).select(
        "n", F.col("last.l_orderkey").alias("l_orderkey"), F.col("last.l_linenumber").alias("l_linenumber")
    )


def tolerant_projection(spark: SparkSession, folder: str) -> DataFrame:
    """The same rows count whichever columns are asked for."""
    items = tables.read_tolerant(spark, _broken_lines(spark, folder), ITEM)
    few = items.select("event_id")
    rows = F.lit(items.count()).alias("rows")
    return few.agg(F.count(F.lit(1)).alias("n"), F.count("event_id").alias("ids"), F.sum("event_id").alias("total"), rows)


def arrival_id(spark: SparkSession, folder: str) -> DataFrame:
    """Events as several files in the order of their id, numbered as they come."""
    path = work_dir(spark, "arrivals")
    sorted_items = _events(spark, folder, "event_id").repartitionByRange(6, "event_id").sortWithinPartitions("event_id")
    sorted_items.write.parquet(path)
    items = tables.read_items(spark, path)
    return tables.number_arrivals(items).select("event_id", "id")


# Sinks


def json_sink(spark: SparkSession, folder: str) -> DataFrame:
    path = work_dir(spark, "json")
    sinks.write_json(_events(spark, folder), path, ["event_id", "event_type", "value"])
    return spark.read.schema("event_id long, event_type string, value double").json(path)


def queue_sink(spark: SparkSession, folder: str) -> DataFrame:
    path = work_dir(spark, "queues")
    labelled = r.emit(_events(spark, folder, "event_id", "event_type", "value"), OVERLAPPING)
    sinks.write_queues(labelled.drop("event_type", "value"), path)
    return spark.read.schema("event_id long, queue string").parquet(path)


def custom_sink(spark: SparkSession, folder: str) -> DataFrame:
    """Items that two write jobs of a Python sink left behind."""
    path = work_dir(spark, "arrow")
    events = _events(spark, folder, "event_id", "event_type", "value")
    for part in (ERROR, f"NOT ({ERROR})"):
        sinks.write_custom(events.where(part).select("event_id", "value"), sinks.ItemSink, path=path)
    return sinks.read_written(spark, sinks.ItemSink, "event_id long, value double", path=path)


def log_tap(spark: SparkSession, folder: str) -> DataFrame:
    return c.log_tap(_events(spark, folder, "event_id"), "before")[0]


def terminal_process(spark: SparkSession, folder: str) -> DataFrame:
    """What a tap saw of a chain that keeps nothing."""
    tapped, tap = c.log_tap(_events(spark, folder, "event_id", "event_type").where(CLICK), "clicks")
    sinks.run_terminal(tapped)
    return spark.createDataFrame([(tap.get["items"],)], "n long")


# Chains


def process_chain(spark: SparkSession, folder: str) -> DataFrame:
    return c.chain(
        _events(spark, folder, "event_id", "event_type", "value"),
        lambda items: items.where(CLICK),
        c.set_value("v2", F.col("value") * 2),
        c.set_value("src", "data"),
    ).drop("event_type", "value")


def set_value(spark: SparkSession, folder: str) -> DataFrame:
    return _events(spark, folder, "event_id").transform(c.set_value("fromQueue", "true"))


def create_id(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").where(F.col("o_orderstatus") == "F").select("o_orderkey")
    return o.create_id(orders, "o_orderkey")


def alternate_ab(spark: SparkSession, folder: str) -> DataFrame:
    return o.alternate_ab(_events(spark, folder, "event_id"), "event_id")


RATE_BLOCK = 1_000


def data_rate(spark: SparkSession, folder: str) -> DataFrame:
    events = _events(spark, folder, "event_id", "ts")
    return o.data_rate(events, "event_id", epoch_micros(events, "ts"), every=RATE_BLOCK)


def instance_tag(spark: SparkSession, folder: str) -> DataFrame:
    """Which process handled an item, and whether its instance is named as it should be."""
    tagged = _events(spark, folder, "event_id").transform(c.instance_tag("reader"))
    return tagged.select(
        "event_id",
        F.split_part("copy_id", F.lit("@"), F.lit(1)).alias("process"),
        F.col("copy_id").rlike("^reader@[0-9]+$").alias("named"),
    )


def attr_access(spark: SparkSession, folder: str) -> DataFrame:
    events = with_attributes(_events(spark, folder, "event_id", "props"), "props", "k", "zz")
    return events.select("event_id", F.col("k").cast("bigint"), F.col("zz").isNotNull().alias("has_zz"))


def skip_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _events(spark, folder, "event_id", "event_type").transform(c.skip(ERROR)).drop("event_type")


def conditional_set(spark: SparkSession, folder: str) -> DataFrame:
    marked = _events(spark, folder, "event_id", "value").transform(
        c.set_value("level", "high", when="%{data.value} > 10")
    )
    return marked.drop("value")


def conditional_skip(spark: SparkSession, folder: str) -> DataFrame:
    """A step that drops items, under a condition; and a chain of steps under another."""
    events = _events(spark, folder, "event_id", "event_type", "value")
    both = lambda items: c.chain(items, c.skip(CLICK), c.set_value("level", "high"))
    done = c.chain(events, c.only_if(ERROR, c.skip()), c.only_if(HIGH, both))
    return done.select("event_id", "level")


def open_condition(spark: SparkSession, folder: str) -> DataFrame:
    """Tests on attributes of the open part, and on one that no item has."""
    events = _events(spark, folder, "event_id", "props")
    steps = (c.set_value("big", "yes", when="%{data.k} > 3"), c.skip("%{data.nowhere} = 'x' OR %{data.k} = 1"))
    return c.chain(events, *steps).drop("props")


def open_put(spark: SparkSession, folder: str) -> DataFrame:
    """A key set in the open part beside the others, one with a dot in its name, and one replaced."""
    held = OpenPart(_events(spark, folder, "event_id", "event_type", "props"))
    for key, value in (("a.b", F.col("event_type")), ("n", F.col("event_id") * 2), ("n", F.col("event_id"))):
        held.put(key, value)
    return with_attributes(held.items(), "props", "k", "a.b", "n").select(
        "event_id",
        F.col("k").cast("bigint"),
        F.col("`a.b`").alias("dotted"),
        attribute("props", "a.b").alias("same"),
        F.col("n").cast("bigint"),
    )


def drop_null_items(spark: SparkSession, folder: str) -> DataFrame:
    events = _events(spark, folder, "event_id", "event_type", "value")
    return c.chain(events, c.null_unless(HIGH), c.drop_null_items).drop("value")


# Routing


def unrouted_dropped(spark: SparkSession, folder: str) -> DataFrame:
    """Of the rules of several queues only those of the queues that exist are ever read."""
    branches = r.split(_events(spark, folder, "event_id", "event_type"), {"gamma": ERROR, "other": CLICK})
    return branches["gamma"].drop("event_type")


def enqueue_one(spark: SparkSession, folder: str) -> DataFrame:
    return r.enqueue(_events(spark, folder, "event_id"), "q1")


def enqueue_route(spark: SparkSession, folder: str) -> DataFrame:
    events = _events(spark, folder, "event_id", "event_type", "value")
    return r.emit(events, OVERLAPPING).drop("event_type", "value")


def enqueue_multi(spark: SparkSession, folder: str) -> DataFrame:
    events = _events(spark, folder, "event_id", "event_type", "value")
    return r.emit(events, {"hi": HIGH, "err": ERROR}).drop("event_type", "value")


def enqueue_bulk(spark: SparkSession, folder: str) -> DataFrame:
    both = F.array(F.col("value"), -F.col("value"))
    return r.enqueue_bulk(_events(spark, folder, "event_id", "value"), both, "q1", "v").drop("value")


def split_select(spark: SparkSession, folder: str) -> DataFrame:
    events = _events(spark, folder, "event_id", "event_type")
    labelled = r.emit(events, {"gamma": ERROR, "hadron": CLICK})
    return (
        r.select_queues(labelled, ["gamma", "hadron"])
        .groupBy("queue")
        .agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"))
    )


def flatmap_emit(spark: SparkSession, folder: str) -> DataFrame:
    events = _events(spark, folder, "event_id", "event_type", "value")
    emitted = r.emit(
        events, {"gamma": ERROR, "hi": HIGH}, output=True, output_label="out", label="target", ordinal="ord"
    )
    return emitted.select("event_id", "ord", "target")


@F.arrow_udtf(returnType="event_id: bigint, pos: int, v: double")
class BothSigns:
    """Emits two items for one, a batch of items at a time."""

    def eval(self, items: pa.RecordBatch):
        ids, values = items.column("event_id"), items.column("value")
        for pos, signed in enumerate((values, pc.negate(values))):
            places = pa.array([pos] * items.num_rows, pa.int32())
            yield pa.table({"event_id": ids, "pos": places, "v": signed})


def udtf_emit(spark: SparkSession, folder: str) -> DataFrame:
    events = _events(spark, folder, "event_id", "value")
    emitted = BothSigns(events.asTable())
    return emitted.transform(c.set_value(r.QUEUE, "q1"))


def custom_emit(spark: SparkSession, folder: str) -> DataFrame:
    """Two items for one, made a whole batch at a time."""

    def both_signs(batch: pa.RecordBatch):
        for pos, values in enumerate((batch["value"], pc.negate(batch["value"]))):
            places = pa.array([pos] * batch.num_rows, pa.int32())
            yield pa.RecordBatch.from_arrays([batch["event_id"], places, values], ["event_id", "pos", "v"])

    events = _events(spark, folder, "event_id", "value")
    emitted = k.emit_batches(events, both_signs, "event_id long, pos int, v double")
    return emitted.transform(c.set_value(r.QUEUE, "q1"))


def named_output(spark: SparkSession, folder: str) -> DataFrame:
    flow = Flow({"data": _events(spark, folder)})
    flow.process("count", lambda d: d.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")), input="data", output="x")
    return flow["x"]


def multi_output(spark: SparkSession, folder: str) -> DataFrame:
    flow = Flow({"data": _events(spark, folder)})
    flow.process("p", lambda d: d.where(HIGH).select("event_id"), input="data", output="a, b")
    return flow.gather("a", "b", tag="output")


def shared_input(spark: SparkSession, folder: str) -> DataFrame:
    """Two processes over the same input, as one pass over it."""
    events = _events(spark, folder, "event_id", "event_type", "value")
    return r.emit(events, {"p1": CLICK, "p2": HIGH}, label="process").select("process", "event_id")


def chain_by_id(spark: SparkSession, folder: str) -> DataFrame:
    flow = Flow({"data": _events(spark, folder)})
    flow.process("first", lambda d: d.where(CLICK), input="data", output="second")
    return flow.process("second", lambda d: d.select("event_id"), c.set_value("stage", "second"))


def rebind_name(spark: SparkSession, folder: str) -> DataFrame:
    flow = Flow({"data": _events(spark, folder)})
    flow.process("p1", lambda d: d.where(CLICK), input="data", output="x")
    flow.process("p2", lambda d: d.where(F.col("event_type") == "view"), input="data", output="x")
    return flow["x"].select("event_id")


def output_plus_queues(spark: SparkSession, folder: str) -> DataFrame:
    flow = Flow({"data": _events(spark, folder, "event_id", "event_type")}, queues="gamma")
    flow.process("p", Enqueue("gamma", when=ERROR), input="data", output="x")
    return flow["x"].select("event_id", "queue")


def output_named_as_queue(spark: SparkSession, folder: str) -> DataFrame:
    """An output of a queue's name replaces it, with what the process gives and what it queued."""
    flow = Flow({"data": _events(spark, folder, "event_id", "event_type")}, queues="gamma")
    flow.process("p", Enqueue("gamma", when=ERROR), input="data", output="gamma")
    return flow["gamma"].select("event_id", "queue")


def undeclared_queue(spark: SparkSession, folder: str) -> DataFrame:
    flow = Flow({"data": _events(spark, folder)}, queues="gamma")
    flow.process("p", Enqueue("gamma, ghost", when=ERROR), input="data")
    counts = [c.item_count(flow[name]).withColumn("queue", F.lit(name)) for name in ("gamma", "ghost")]
    return merge_streams(*counts)


def routing_sample(spark: SparkSession, folder: str) -> DataFrame:
    flow = samples.routing_sample(_events(spark, folder, "event_id"), "event_id")
    return samples.queue_counts(flow.written("separation"))


def queue_sample(spark: SparkSession, folder: str) -> DataFrame:
    return samples.queue_sample(_events(spark, folder, "event_id"))


def count_sample(spark: SparkSession, folder: str) -> DataFrame:
    return samples.count_sample(table(spark, folder, "lineitem"))


# Keys and state


def key_partition(spark: SparkSession, folder: str) -> DataFrame:
    return k.group_by_key(_events(spark, folder, "event_id", "user_id"), "user_id", ["event_id"])


def keyed_running_count(spark: SparkSession, folder: str) -> DataFrame:
    return k.running_count(_events(spark, folder, "event_id", "user_id"), "user_id", ["event_id"])


def keyed_apply(spark: SparkSession, folder: str) -> DataFrame:
    """How far each event id is from the one before it of the same user."""

    def gaps(rows: pd.DataFrame) -> pd.DataFrame:
        before = rows.groupby("user_id", dropna=False)["event_id"].shift(1)
        before = before.fillna(rows["last"]).fillna(rows["event_id"])
        return rows[["event_id", "user_id"]].assign(d=rows["event_id"] - before)

    return k.keyed_apply(
        _events(spark, folder, "event_id", "user_id"),
        "user_id",
        ["event_id"],
        gaps,
        "event_id long, user_id long, d long",
        {"last": k.Carry(F.max("event_id"), F.max)},
    )


def flow_keyed_process(spark: SparkSession, folder: str) -> DataFrame:
    """A process of a job that meets each user's events in order, with what it knows carried over."""

    def gaps(rows: pd.DataFrame) -> pd.DataFrame:
        before = rows.groupby("user_id", dropna=False)["event_id"].shift(1)
        gap = rows["event_id"] - before.fillna(rows["last"]).fillna(rows["event_id"])
        return rows[["event_id", "user_id"]].assign(gap=gap)

    flow = Flow({"data": _events(spark, folder, "event_id", "user_id")})
    carries = {"last": k.Carry(F.max("event_id"), F.max)}
    step = Keyed(gaps, "event_id long, user_id long, gap long", carries, rows_per_segment=100)
    flow.process("gaps", step, c.set_value("far", F.col("gap") > 200), input="data", output="x", group_by="user_id", order=["event_id"])
    return flow["x"]


def item_count(spark: SparkSession, folder: str) -> DataFrame:
    return c.item_count(_events(spark, folder))


def finish_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Each instance counts what it saw and tells at its end."""

    def see(seen: list, batch: pd.DataFrame) -> None:
        seen.append(len(batch))

    partials = k.process_partitions(
        _events(spark, folder, "event_id"), list, see, "n long", lambda seen: pd.DataFrame({"n": [sum(seen)]})
    )
    return partials.agg(F.sum("n").alias("n"))


def udf_processor(spark: SparkSession, folder: str) -> DataFrame:
    @F.pandas_udf("string")
    def upper(kind: pd.Series) -> pd.Series:
        return kind.str.upper()

    return _events(spark, folder).select("event_id", upper("event_type").alias("t"))


# Services


def service_lookup(spark: SparkSession, folder: str) -> DataFrame:
    events = _events(spark, folder, "event_id", "user_id")
    customers = table(spark, folder, "customer")
    return lookup(events, customers, "user_id", "c_custkey", ["c_mktsegment"]).drop("user_id")


def service_lookup_large(spark: SparkSession, folder: str) -> DataFrame:
    """The same lookup by the way of a large service, where some users count as hot."""
    events = _events(spark, folder, "event_id", "user_id")
    customers = table(spark, folder, "customer")
    found = lookup(events, customers, "user_id", "c_custkey", ["c_mktsegment"], max_rows=10, hot_rows=60)
    return found.drop("user_id")


def partition_setup(spark: SparkSession, folder: str) -> DataFrame:
    """A table of codes, made anew by each instance before its first item."""

    def code(codes: dict, batch: pd.DataFrame) -> pd.DataFrame:
        found = batch["event_type"].map(codes).fillna(0).astype("int64")
        return pd.DataFrame({"event_id": batch["event_id"], "code": found})

    return k.process_partitions(
        _events(spark, folder, "event_id", "event_type"),
        lambda: {"error": 1, "click": 2},
        code,
        "event_id long, code long",
    )


# Copies


def copies_invariant(spark: SparkSession, folder: str) -> DataFrame:
    events = _events(spark, folder, "event_type", "value")
    spread = with_copies(events, spark.sparkContext.defaultParallelism)
    exact = F.sum(F.col("value").cast("decimal(18,2)")).cast("double")
    return spread.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), exact.alias("v"))


def coalesce_leaf(spark: SparkSession, folder: str) -> DataFrame:
    return rescale(_events(spark, folder, "event_id"), spark.sparkContext.defaultParallelism)


BATCH = {
    query.__name__: query
    for query in (
        source_scan, multi_source, sharded_source, custom_source, random_source, constant_source, source_limit,
        tolerant_read, tolerant_split, tolerant_projection, large_limit, arrival_id, json_sink, queue_sink, custom_sink, log_tap, terminal_process, process_chain,
        set_value, create_id, alternate_ab, data_rate, instance_tag, attr_access, skip_rows, conditional_set,
        conditional_skip, open_condition, open_put,
        drop_null_items, unrouted_dropped, enqueue_one, enqueue_route, enqueue_multi, enqueue_bulk, split_select,
        flatmap_emit, udtf_emit, custom_emit, named_output, multi_output, shared_input, chain_by_id, rebind_name,
        output_plus_queues, output_named_as_queue, undeclared_queue, routing_sample, queue_sample, count_sample, key_partition,
        keyed_running_count, keyed_apply, flow_keyed_process, item_count, finish_totals, udf_processor, service_lookup, service_lookup_large,
        partition_setup, copies_invariant, coalesce_leaf,
    )
}
