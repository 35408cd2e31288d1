"""Registered queries that run a live job to the end of the tables and read back what it wrote."""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import epoch_micros
from millrace.operators.chain import set_value
from millrace.operators.keyed import Carry
from millrace.plans.flow import CreateId, Enqueue, Flow, Keyed
from millrace.plans.live_flow import LiveFlow, read_queues
from millrace.plans.queries import OVERLAPPING, RATE_BLOCK, BigOrders
from millrace.session import table, work_dir
from millrace.sinks.files import read_written
from millrace.sinks.live import LiveItemSink, write_custom_live
from millrace.sources.live import read_custom_live
from millrace.sources.tables import read_live
from millrace.streaming.lookup import lookup_reset
from millrace.streaming.numbering import number_live, rate_live, rates_so_far
from millrace.streaming.routing import fan_out, json_batches, parquet_batches, write_queues_live
from millrace.streaming.run import run_to_end, run_until_idle, writer
from millrace.streaming.state import SALT, Context, combined, keyed_state, salted
from millrace.streaming.typed import State, typed_state

BATCHES = 6


def live_events(spark: SparkSession, folder: str) -> DataFrame:
    """The events as a stream of several files, one of them in each micro-batch."""
    events = table(spark, folder, "events")
    path = work_dir(spark, "arriving")
    events.repartition(BATCHES).write.parquet(path)
    return read_live(spark, path, events.schema, max_files=1)


def stream_route(spark: SparkSession, folder: str, events: DataFrame | None = None) -> DataFrame:
    live = live_events(spark, folder) if events is None else events
    path = work_dir(spark, "routed")
    run_to_end(write_queues_live(live.select("event_id", "event_type", "value"), OVERLAPPING, path))
    return spark.read.schema("event_id long, queue string").parquet(path)


def stream_fan_out(spark: SparkSession, folder: str, events: DataFrame | None = None) -> DataFrame:
    """One queue to parquet, the other to JSON."""
    live = live_events(spark, folder) if events is None else events
    path = work_dir(spark, "fan-out")
    sinks = {"gamma": parquet_batches(f"{path}/gamma"), "hadron": json_batches(f"{path}/hadron")}
    run_to_end(fan_out(live.select("event_id", "event_type", "value"), OVERLAPPING, sinks))
    schema = "event_id long, queue string"
    gamma = spark.read.schema(schema).parquet(f"{path}/gamma/batch=*")
    return gamma.unionByName(spark.read.schema(schema).json(f"{path}/hadron/batch=*"))


def count_piece(rows: pa.Table) -> pa.Table:
    return rows.group_by("user_id").aggregate([([], "count_all")]).rename_columns(["user_id", "part"])


def add_counts(key: tuple, rows: pd.DataFrame, context: Context) -> pd.DataFrame:
    """Running number of items of a user, kept in the user's context."""
    context.set("n", context.get("n", 0) + int(rows["part"].sum()))
    return pd.DataFrame({"user": [key[0]], "n": [context.get("n")]})


def stream_counts(spark: SparkSession, live: DataFrame, checkpoint: str | None = None, path: str | None = None) -> DataFrame:
    """Every update of the running counts per user: one state for each user."""
    parts = combined(live.select("user_id"), count_piece, "user_id long, part long")
    # Users as text from here, since pandas would make a nullable number a float.
    users = parts.select(F.col("user_id").cast("string").alias("user"), "part")
    schema = "user string, n long"
    counts = keyed_state(users, ["user"], add_counts, schema)
    path = path or work_dir(spark, "counts")
    run_to_end(writer(counts, "counts", checkpoint=checkpoint).format("parquet").option("path", path))
    return spark.read.schema(schema).parquet(path).select(F.col("user").cast("long").alias("user_id"), "n")


def stateful_stream(spark: SparkSession, folder: str, events: DataFrame | None = None) -> DataFrame:
    """Items per user, counted by Python state that lasts from batch to batch: the largest count of
    a user is the last one."""
    live = live_events(spark, folder) if events is None else events
    return stream_counts(spark, live).groupBy("user_id").agg(F.max("n").alias("n"))


def stream_create_id(spark: SparkSession, folder: str, events: DataFrame | None = None) -> DataFrame:
    """Whether the numbers given to a live stream are dense: 0 to n-1, adding up."""
    live = live_events(spark, folder) if events is None else events
    path = work_dir(spark, "numbered")
    run_to_end(number_live(live.select("event_id"), "event_id", path))
    ids = spark.read.schema("event_id long, id long").parquet(f"{path}/items/batch=*")
    total = F.sum(F.col("id").cast("decimal(38,0)")).cast("string")
    return ids.agg(
        F.count("id").alias("n"), F.min("id").alias("first"), F.max("id").alias("last"), total.alias("total")
    )


def stream_service_lookup(spark: SparkSession, folder: str, events: DataFrame | None = None) -> DataFrame:
    live = live_events(spark, folder) if events is None else events
    path = work_dir(spark, "looked-up")
    job = lookup_reset(
        live.select("event_id", "user_id"),
        lambda: table(spark, folder, "customer"),
        "user_id",
        "c_custkey",
        ["c_mktsegment"],
        parquet_batches(path),
    )
    run_to_end(job)
    return spark.read.schema("event_id long, c_mktsegment string").parquet(f"{path}/batch=*")


def ordered_events(spark: SparkSession, folder: str) -> DataFrame:
    """The events as a stream whose files follow one another along `event_id`."""
    events = table(spark, folder, "events")
    path = work_dir(spark, "in-order")
    low, high = events.agg(F.min("event_id"), F.max("event_id")).first()
    batch = F.floor((F.col("event_id") - F.lit(low)) * BATCHES / F.lit(max(high - low, 0) + 1)) if low is not None else F.lit(0)
    for number in range(BATCHES):
        events.where(batch == number).coalesce(1).write.mode("append").parquet(path)
    return read_live(spark, path, events.schema, max_files=1)


def gaps(rows: pd.DataFrame) -> pd.DataFrame:
    """How many ids before it the last item of the same user was."""
    before = rows.groupby("user_id", dropna=False)["id"].shift(1)
    gap = rows["id"] - before.fillna(rows["last"]).fillna(rows["id"])
    return rows[["event_id", "user_id", "id"]].assign(gap=gap)


def gap_job(flow: Flow) -> None:
    """Number the items, meet each user's items in order, and send them to two queues."""
    last = Carry(F.max("id"), F.max, lambda old, rows: int(rows["id"].iloc[-1]))
    flow.process(
        "gaps",
        CreateId("event_id"),
        Keyed(gaps, "event_id long, user_id long, id long, gap long", {"last": last}),
        set_value("far", F.col("gap") > 200),
        Enqueue("far", when="far"),
        Enqueue("near", when="%{data.gap} <= 250"),
        input="data",
        group_by="user_id",
        order=["event_id"],
    )


def flow_live(spark: SparkSession, folder: str, events: DataFrame | None = None) -> DataFrame:
    """A whole job on a live stream: numbers, keyed state and two queues over several micro-batches."""
    live = ordered_events(spark, folder) if events is None else events
    flow = LiveFlow({"data": live.select("event_id", "user_id")}, work_dir(spark, "job"), queues="far, near", groups=8)
    gap_job(flow)
    flow.run_to_end(flow.sink("gaps"))
    return read_queues(spark, flow, "gaps")


def custom_stream_source(spark: SparkSession, folder: str) -> DataFrame:
    """A Python source class over files that arrive, two in each micro-batch."""
    path, plan = work_dir(spark, "orders-arriving"), work_dir(spark, "orders-plan")
    schema = "o_orderkey long, o_custkey long, o_totalprice double"
    table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice").repartition(BATCHES).write.parquet(path)
    orders = read_custom_live(spark, BigOrders, path, schema, plan, max_files=2, least=100_000.0)
    out = work_dir(spark, "orders")
    run_until_idle(writer(orders, "orders").format("parquet").option("path", out))
    return spark.read.schema(schema).parquet(out)


def custom_stream_sink(spark: SparkSession, folder: str, events: DataFrame | None = None) -> DataFrame:
    """A Python sink class that gets the micro-batches of a stream."""
    live = live_events(spark, folder) if events is None else events
    path = work_dir(spark, "live-sink")
    run_to_end(write_custom_live(live.select("event_id", "value"), LiveItemSink, path=path, job="events"))
    return read_written(spark, LiveItemSink, "event_id long, value double", path=path)


def count_users(key: tuple, rows: pd.DataFrame, state: State) -> pd.DataFrame:
    """Items of each user under an event type; only the users of this batch are touched."""
    counts, out = state.maps["users"], []
    for user, n in rows["user"].value_counts(dropna=False).items():
        name = user if isinstance(user, str) else ""
        total = counts.get(name, 0) + int(n)
        counts.set(name, total)
        out.append((key[0], name, total))
    return pd.DataFrame(out, columns=["event_type", "user", "n"])


SALTS = 32


def stateful_map(spark: SparkSession, folder: str, events: DataFrame | None = None) -> DataFrame:
    """Items per event type and user, counted in a map per type and salt of the users, as there are few types: the
    largest count is the last one."""
    live = live_events(spark, folder) if events is None else events
    items = salted(live.select("event_type", F.col("user_id").cast("string").alias("user")), "user", SALTS)
    counts = typed_state(items, ["event_type", SALT], count_users, "event_type string, user string, n long", maps={"users": ("user string", "n long")})
    path = work_dir(spark, "maps")
    run_to_end(writer(counts, "maps").format("parquet").option("path", path))
    found = spark.read.schema("event_type string, user string, n long").parquet(path)
    user = F.nullif(F.col("user"), F.lit("")).cast("long")
    return found.groupBy("event_type", user.alias("user_id")).agg(F.max("n").alias("n"))


IDLE_SECONDS = 2


def add_up(key: tuple, rows: pd.DataFrame, state: State) -> None:
    state.values["n"].set(state.values["n"].get(0) + len(rows))


def last_count(key: tuple, state: State) -> pd.DataFrame:
    return pd.DataFrame({"user": [key[0]], "n": [state.values["n"].get(0)]})


def live_finish(spark: SparkSession, folder: str, events: DataFrame | None = None) -> DataFrame:
    """Items of every user, told once when the user has been idle for a while."""
    live = live_events(spark, folder) if events is None else events
    users = live.select(F.col("user_id").cast("string").alias("user"))
    ends = typed_state(users, ["user"], add_up, "user string, n long", values={"n": "n long"}, finish=last_count, idle_seconds=IDLE_SECONDS)
    path = work_dir(spark, "ends")
    run_until_idle(writer(ends, "ends").format("parquet").option("path", path), IDLE_SECONDS)
    found = spark.read.schema("user string, n long").parquet(path)
    return found.groupBy(F.col("user").cast("long").alias("user_id")).agg(F.sum("n").alias("n"))


def stream_data_rate(spark: SparkSession, folder: str, events: DataFrame | None = None) -> DataFrame:
    """The rates of `data_rate`, over blocks that lie across micro-batches."""
    live = ordered_events(spark, folder) if events is None else events
    path = work_dir(spark, "rates")
    run_to_end(rate_live(live.select("event_id", "ts"), "event_id", epoch_micros(live, "ts"), RATE_BLOCK, path))
    return rates_so_far(spark, path)


LIVE = {
    query.__name__: query
    for query in (
        stream_route, stream_fan_out, stateful_stream, stream_create_id, stream_service_lookup, flow_live,
        custom_stream_source, custom_stream_sink, stateful_map, live_finish, stream_data_rate,
    )
}

