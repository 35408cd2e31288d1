import time
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.operators.lookup import lookup
from millrace.plans import live_queries as q
from millrace.plans.flow import Enqueue, Flow
from millrace.sources import synthetic
from millrace.sources.tables import read_live
from millrace.streaming.lookup import lookup_reset
from millrace.streaming.numbering import number_live
from millrace.streaming.routing import fan_out, live_counts, parquet_batches, write_queues_live
from millrace.streaming.run import TapCounts, live_tap, preview_live, print_live, run_live, run_to_end, writer
from millrace.streaming.state import SALT, Context, keyed_state, salted

FILES = 6


@pytest.fixture(scope="module")
def folder(spark, data, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("live") / "events")
    spark.read.parquet(f"{data}/events.parquet").repartition(FILES, "event_id").write.parquet(path)
    return path


@pytest.fixture()
def live(spark, events, folder):
    return read_live(spark, folder, events.schema, max_files=1)


def same(got, want):
    assert got.count() == want.count()
    assert got.exceptAll(want.select(*got.columns)).count() == 0


RULES = q.OVERLAPPING


def routed(events):
    gamma = events.where("event_type = 'error'").select("event_id", F.lit("gamma").alias("queue"))
    return gamma.unionAll(events.where("value > 10").select("event_id", F.lit("hadron").alias("queue")))


def test_stream_equals_batch_over_several_batches(spark, data, events, live):
    same(q.stream_route(spark, data, live), routed(events))
    same(q.stream_fan_out(spark, data, live), routed(events))
    same(q.stateful_stream(spark, data, live), events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")))
    wanted = lookup(events, spark.read.parquet(f"{data}/customer.parquet"), "user_id", "c_custkey", ["c_mktsegment"])
    same(q.stream_service_lookup(spark, data, live), wanted)


def test_state_lasts_from_batch_to_batch(spark, events, live):
    updates = q.stream_counts(spark, live)
    assert updates.select("user_id").distinct().count() == events.select("user_id").distinct().count()
    per_user = updates.groupBy("user_id").agg(F.countDistinct("n").alias("counts"))
    assert per_user.agg(F.min("counts")).first()[0] > 1
    assert updates.agg(F.sum("n")).first()[0] > events.count()  # a later count includes the earlier ones


def test_counts_with_null_and_huge_users(spark, events, live):
    """A third without a user, and ids that no double can hold."""
    user = F.when(F.col("event_id") % 3 > 0, F.lit((1 << 60) + 1) + F.col("event_id") % 2)
    got = q.stateful_stream(spark, "", live.withColumn("user_id", user))
    same(got, events.groupBy(user.alias("user_id")).agg(F.count(F.lit(1)).alias("n")))


def test_a_hot_key_that_needs_its_items_is_shared_by_salts(spark, events, live, tmp_path):
    hot = live.select("event_id", F.when(F.col("event_id") % 3 > 0, -1).otherwise(F.col("user_id")).alias("user_id"))

    def largest(key, rows, context):
        context.set("top", max(context.get("top"), int(rows["event_id"].max())))
        return pd.DataFrame({"user_id": [key[0]], SALT: [key[1]], "top": [context.get("top")]})

    tops = keyed_state(
        salted(hot, "event_id", 4), ["user_id", SALT], largest, f"user_id long, {SALT} int, top long",
        start=lambda context: context.set("top", -1),
    )
    path = str(tmp_path / "tops")
    run_to_end(writer(tops, "tops").format("parquet").option("path", path))
    got = spark.read.parquet(path)
    assert got.where("user_id = -1").select(SALT).distinct().count() == 4
    key = F.when(F.col("event_id") % 3 > 0, -1).otherwise(F.col("user_id"))
    want = events.groupBy(key.cast("long").alias("user_id")).agg(F.max("event_id").alias("top"))
    same(got.groupBy("user_id").agg(F.max("top").alias("top")), want)


def test_context_values():
    context = Context()
    assert not context.contains("a") and context.get("a", 7) == 7
    context.set("a", [1])
    assert context.contains("a") and context.get("a") == [1]


def test_context_lasts_for_any_process(spark, events, live, tmp_path):
    """Remembers the largest value of a type so far, set up before the first item."""

    def process(key, rows, context):
        context.set("top", max(context.get("top"), float(rows["value"].max())))
        return pd.DataFrame({"event_type": [key[0]], "top": [context.get("top")]})

    tops = keyed_state(
        live.select("event_type", "value"), ["event_type"], process, "event_type string, top double",
        start=lambda c: c.set("top", 0.0),
    )
    path = str(tmp_path / "tops")
    run_to_end(writer(tops, "tops").format("parquet").option("path", path))
    got = spark.read.parquet(path).groupBy("event_type").agg(F.max("top").alias("top"))
    same(got, events.groupBy("event_type").agg(F.max("value").alias("top")))


def test_numbers_are_dense_over_batches_and_a_restart(spark, events, folder, tmp_path):
    """Half the files first, then a stop, then the rest with the same progress folder."""
    source, out, progress = (str(tmp_path / name) for name in ("source", "out", "progress"))
    half = events.select("event_id", "user_id")
    half.where("event_id % 2 = 0").repartition(3).write.parquet(source)
    for part in (None, "event_id % 2 = 1"):
        if part:
            half.where(part).repartition(3).write.mode("append").parquet(source)
        live = read_live(spark, source, half.schema, max_files=1)
        run_to_end(number_live(live, "event_id", out, checkpoint=progress))
    got = spark.read.parquet(f"{out}/items/batch=*")
    n = events.count()
    row = got.agg(F.count("id"), F.min("id"), F.max("id"), F.countDistinct("id"), F.countDistinct("event_id")).first()
    assert tuple(row) == (n, 0, n - 1, n, n)
    assert got.where("event_id % 2 = 0").agg(F.max("id")).first()[0] == n // 2 - 1


def test_a_repeated_batch_replaces_itself(spark, events, folder, tmp_path):
    """The same files again under a new progress folder stand for a batch delivered twice."""
    out = str(tmp_path / "out")
    runs = []
    for name in ("one", "two"):
        live = read_live(spark, folder, events.schema, max_files=1).select("event_id")
        run_to_end(number_live(live, "event_id", out, checkpoint=str(tmp_path / name)))
        runs.append(sorted(map(tuple, spark.read.parquet(f"{out}/items/batch=*").collect())))
    assert runs[0] == runs[1]


def test_stream_create_id(spark, data, events, live):
    n = events.count()
    assert tuple(q.stream_create_id(spark, data, live).first()) == (n, 0, n - 1, str(n * (n - 1) // 2))


def test_restart_goes_on_and_repeats_nothing(spark, events, folder, tmp_path):
    progress, path = str(tmp_path / "progress"), str(tmp_path / "out")
    for _ in range(2):
        live = read_live(spark, folder, events.schema, max_files=2)
        run_to_end(write_queues_live(live.select("event_id", "event_type", "value"), RULES, path, checkpoint=progress))
    same(spark.read.schema("event_id long, queue string").parquet(path), routed(events))


def test_item_to_two_queues(spark, events, live, tmp_path):
    rules = {"all": None, "errors": "event_type = 'error'"}
    sinks = {name: parquet_batches(str(tmp_path / name)) for name in rules}
    run_to_end(fan_out(live.select("event_id", "event_type"), rules, sinks))
    counts = {name: spark.read.parquet(str(tmp_path / name / "batch=*")).count() for name in rules}
    assert counts == {"all": events.count(), "errors": events.where(rules["errors"]).count()}
    with pytest.raises(KeyError):
        fan_out(live, rules, {"ghost": sinks["all"]})


def test_service_is_read_anew_for_each_batch(spark, live, tmp_path):
    reads = []

    def service():
        reads.append(1)
        return spark.createDataFrame([(user, f"v{len(reads)}") for user in range(200)], "user long, version string")

    out = str(tmp_path / "out")
    run_to_end(lookup_reset(live, service, "user_id", "user", ["version"], parquet_batches(out)))
    assert len(reads) == FILES
    assert spark.read.parquet(f"{out}/batch=*").select("version").distinct().count() == FILES


def test_intake_is_bounded(spark, live):
    done = run_to_end(writer(live, "noop").format("noop"))
    batches = [p["numInputRows"] for p in done.recentProgress if p["numInputRows"]]
    assert len(batches) == FILES


def test_intake_is_bounded_by_bytes(spark, events, folder):
    live = read_live(spark, folder, events.schema, max_bytes=1)
    done = run_to_end(writer(live, "noop").format("noop"))
    assert len([p for p in done.recentProgress if p["numInputRows"]]) == FILES


def test_live_counts_into_memory(spark, events, live):
    sink = writer(live_counts(live, "event_type"), "counts", mode="complete")
    run_to_end(sink.format("memory").queryName("live_counts"))
    same(spark.table("live_counts"), events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")))


def test_run_until_stopped(spark, events, folder):
    live = read_live(spark, folder, events.schema)
    sink = writer(live.select("event_id"), "live").format("memory").queryName("live_items")
    query = run_live(sink, "100 milliseconds")
    query.processAllAvailable()
    assert query.isActive
    query.stop()
    deadline = time.time() + 20
    while query.isActive and time.time() < deadline:
        time.sleep(0.1)
    assert not query.isActive
    assert spark.table("live_items").count() == events.count()


def test_failure_is_raised(spark, live):
    def fail(items, number):
        raise RuntimeError("broken sink")

    with pytest.raises(Exception, match="broken sink"):
        run_to_end(fan_out(live, RULES, {"gamma": fail}))


def test_a_flow_over_a_live_stream(spark, events, live, tmp_path):
    flow = Flow({"data": live.select("event_id", "event_type", "user_id", "value")}, "gamma, hadron")
    flow.process(
        "split", Enqueue("gamma", RULES["gamma"]), Enqueue("hadron", RULES["hadron"]),
        input="data", group_by="user_id", order=["event_id"],
    )
    out = str(tmp_path / "out")
    run_to_end(writer(flow.written("split").select("event_id", "queue"), "flow").format("parquet").option("path", out))
    same(spark.read.parquet(out), routed(events))


def test_tap_on_a_live_stream(spark, events, live):
    """All items count, although the query keeps only the reports of its last two batches."""
    before = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    taps = TapCounts(spark)
    try:
        done = run_to_end(writer(live_tap(live, "before"), "noop").format("noop"))
        assert len(done.recentProgress) <= 2
        assert taps.total(done, "before") == events.count()
        assert taps.total(done, "other") == 0
    finally:
        taps.close()
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", before)


def test_print_on_a_live_stream(live, tmp_path):
    done = run_to_end(preview_live(live.select("event_id"), 2))
    assert "ConsoleTable" in done.lastProgress["sink"]["description"]
    assert done.lastProgress["batchId"] >= FILES - 1
    path = str(tmp_path / "printed")
    run_to_end(print_live(live.where("event_id < 50"), lambda row: print(row["event_id"], file=open(path, "a"))))
    assert sorted(map(int, Path(path).read_text().split())) == list(range(50))


def test_state_survives_another_shuffle_setting(spark, events, folder, tmp_path):
    """Half the files, a stop, another number of shuffle partitions, then the rest."""
    source, out, progress = (str(tmp_path / name) for name in ("source", "out", "progress"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    users = events.select("event_id", "user_id")
    users.where("event_id % 2 = 0").repartition(3).write.parquet(source)
    try:
        for part, partitions in ((None, before), ("event_id % 2 = 1", "3")):
            if part:
                users.where(part).repartition(3).write.mode("append").parquet(source)
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            live = read_live(spark, source, users.schema, max_files=1)
            got = q.stream_counts(spark, live, progress, out)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    same(got.groupBy("user_id").agg(F.max("n").alias("n")), events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")))


def test_endless_sources(spark):
    for items, columns in (
        (synthetic.gaussian_stream(spark, 500, ["a", "b"]), ["a", "b"]),
        (synthetic.constant_stream(spark, 500), ["id", "name", "data"]),
    ):
        name = f"endless_{columns[0]}"
        query = run_live(writer(items, name).format("memory").queryName(name), "200 milliseconds")
        deadline = time.time() + 30
        while spark.table(name).count() < 500 and time.time() < deadline:
            time.sleep(0.2)
        query.stop()
        assert spark.table(name).columns == columns
        assert spark.table(name).count() >= 500
    assert spark.table("endless_a").distinct().count() == spark.table("endless_a").count()
