"""Whole jobs, sources, sinks and state on live streams: restarts, repeated batches, equal results on a batch."""

import json
import time
from pathlib import Path

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.functions import epoch_micros
from millrace.operators.keyed import Carry
from millrace.operators.ordering import data_rate
from millrace.plans import live_queries as q
from millrace.plans.flow import CreateId, Enqueue, Flow, Keyed
from millrace.plans.live_flow import LiveFlow, read_queues
from millrace.sinks.files import Written, committed_counts, read_written
from millrace.sinks.live import LiveItemSink, LiveItemWriter, write_custom_live
from millrace.sources.live import Plan, arrived, read_custom_live
from millrace.sources.sharded import ItemSource
from millrace.sources.tables import read_live
from millrace.streaming.keyed import keyed_live
from millrace.streaming.numbering import rate_live, rates_so_far
from millrace.streaming.run import run_live, run_to_end, run_until_idle, writer
from millrace.streaming.typed import typed_state


def rows_of(frame):
    columns = sorted(frame.columns)
    return sorted(map(str, (tuple(r[c] for c in columns) for r in frame.collect())))


def files_in_order(frame, path, parts, key="event_id"):
    """One file after another along the key."""
    n = frame.agg(F.max(key)).first()[0] + 1
    for part in parts:
        frame.where(F.floor(F.col(key) * 6 / n) == part).coalesce(1).write.mode("append").parquet(path)


def forget_last_commit(progress):
    """As if the job had died after its last batch was written and before it was committed."""
    commits = [p for p in Path(progress, "commits").iterdir() if p.name.isdigit()]
    last = max(commits, key=lambda p: int(p.name))
    for path in (last, last.with_name(f".{last.name}.crc")):
        path.unlink(missing_ok=True)
    return int(last.name)


def batch_flow(events):
    flow = Flow({"data": events.select("event_id", "user_id")}, queues="far, near")
    q.gap_job(flow)
    return flow.written("gaps")


def test_a_job_on_a_batch_and_live_with_a_restart(spark, events, tmp_path):
    """Half the files, a stop, then the rest; a third of the items has one user and some have none."""
    user = F.when(F.col("event_id") % 3 == 0, (1 << 60) + 1).when(F.col("event_id") % 50 == 1, None).otherwise(F.col("user_id"))
    odd = events.withColumn("user_id", user)
    source, job = str(tmp_path / "source"), str(tmp_path / "job")
    batches = 0
    for parts in ((0, 1, 2), (3, 4, 5)):
        files_in_order(odd, source, parts)
        live = read_live(spark, source, odd.schema, max_files=1)
        flow = LiveFlow({"data": live.select("event_id", "user_id")}, job, queues="far, near", groups=4)
        q.gap_job(flow)
        flow.run_to_end(flow.sink("gaps"))
        batches = len(list(Path(job, "00-gaps", "items").glob("batch=*")))
    assert batches == 6
    assert rows_of(read_queues(spark, flow, "gaps")) == rows_of(batch_flow(odd))


def test_a_published_batch_is_left_alone(spark, events, tmp_path):
    source, job = str(tmp_path / "source"), str(tmp_path / "job")
    files_in_order(events, source, range(3))

    def run():
        flow = LiveFlow({"data": read_live(spark, source, events.schema, max_files=1).select("event_id", "user_id")}, job, queues="far, near", groups=4)
        q.gap_job(flow)
        flow.run_to_end(flow.sink("gaps"))
        return rows_of(read_queues(spark, flow, "gaps")), sorted(p.name for p in Path(job, "00-gaps", "items").glob("*/*.parquet"))

    first = run()
    assert forget_last_commit(f"{job}/00-gaps-progress") == 2
    assert run() == first


def test_live_flow_runs_until_it_is_stopped(spark, events, tmp_path):
    source = str(tmp_path / "source")
    files_in_order(events, source, range(2))
    flow = LiveFlow({"data": read_live(spark, source, events.schema, max_files=1).select("event_id", "user_id")}, str(tmp_path / "job"), queues="far, near", groups=4)
    q.gap_job(flow)
    queries = flow.run_live(flow.sink("gaps"), every="0 seconds")
    try:
        files_in_order(events, source, range(2, 6))
        for query in queries:
            query.processAllAvailable()
    finally:
        for query in queries:
            query.stop()
    assert rows_of(read_queues(spark, flow, "gaps")) == rows_of(batch_flow(events))


def test_what_a_live_flow_refuses(spark, events, tmp_path):
    with pytest.raises(ValueError, match="no streams"):
        LiveFlow({"data": events}, str(tmp_path))
    source = str(tmp_path / "source")
    files_in_order(events, source, (0,))
    live = read_live(spark, source, events.schema)
    with pytest.raises(ValueError, match="fold"):
        keyed_live(live, "user_id", ["event_id"], lambda rows: rows, "x long", {"last": Carry(F.max("event_id"), F.max)})
    with pytest.raises(TypeError, match="plain"):
        keyed_live(live.withColumn("a", F.array("value")), "user_id", ["event_id"], lambda rows: rows, "x long")


def test_types_stay_exact_in_a_live_keyed_step(spark, events, tmp_path):
    kinds = (
        "event_id", "ts", (F.lit((1 << 62) + 1) + F.col("event_id")).alias("big"), F.when(F.col("event_id") % 2 == 0, F.lit((1 << 60) + 1)).alias("some"),
        (F.col("value") / 3).alias("third"), F.col("value").cast("decimal(20,4)").alias("exact"), F.to_date("ts").alias("day"), F.when(F.col("event_id") > 5, "é").alias("text"),
        F.col("ts").cast("timestamp").alias("at"), (F.col("event_id") % 2 == 0).alias("even"),
    )
    frame = events.select(*kinds)
    source, out = str(tmp_path / "source"), str(tmp_path / "out")
    files_in_order(frame, source, range(6))
    live = read_live(spark, source, frame.schema, max_files=3)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in frame.schema)
    run_to_end(writer(keyed_live(live, "big", ["event_id"], lambda rows: rows, schema, groups=3), "x").format("parquet").option("path", out))
    assert rows_of(spark.read.schema(schema).parquet(out)) == rows_of(frame)


def test_create_id_in_a_batch_flow(spark, events):
    flow = Flow({"data": events.select("event_id", "event_type")}, queues="e")
    flow.process("p", CreateId("event_id", "n"), Enqueue("e", when="event_type = 'error'"), input="data")
    n = events.count()
    assert flow["e"].count() == events.where("event_type = 'error'").count()
    assert flow["e"].agg(F.max("n")).first()[0] < n
    with pytest.raises(ValueError, match="group_by"):
        flow.process("p", CreateId("event_id"), Keyed(lambda rows: rows, "x long"), input="data")


def test_custom_source_over_batches_restarts_and_repeats(spark, events, tmp_path):
    source, plan, progress, out = (str(tmp_path / name) for name in ("source", "plan", "progress", "out"))
    schema = "event_id long, value double"

    class Doubled(ItemSource):
        def items(self, batch: pa.RecordBatch) -> pa.RecordBatch:
            return pa.Table.from_batches([batch, batch]).combine_chunks().to_batches()[0]

    def run():
        live = read_custom_live(spark, Doubled, source, schema, plan, max_files=2)
        run_until_idle(writer(live, "custom", checkpoint=progress).format("parquet").option("path", out))
        return spark.read.schema(schema).parquet(out)

    files_in_order(events.select("event_id", "value"), source, (0, 1, 2))
    assert run().count() == 2 * events.where(F.floor(F.col("event_id") * 6 / 10_000) < 3).count()
    assert Plan(plan).batches() == [1, 2] and [len(Plan(plan).read(n)) for n in (1, 2)] == [2, 1]
    files_in_order(events.select("event_id", "value"), source, (3, 4, 5))
    Path(source, "_not_yet.parquet").write_bytes(b"half a file")
    twice = events.select("event_id", "value")
    want = rows_of(twice.unionAll(twice))
    assert rows_of(run()) == want
    assert Plan(plan).batches() == [1, 2, 3, 4]
    forget_last_commit(progress)  # the batch is read again from its planned files; the file sink knows it
    assert rows_of(run()) == want
    assert len(arrived(source)) == 6


def test_a_batch_that_was_planned_but_not_run_is_not_lost(spark, events, tmp_path):
    source, plan, out = (str(tmp_path / name) for name in ("source", "plan", "out"))
    files_in_order(events.select("event_id"), source, range(6))
    Plan(plan).write(1, arrived(source)[:2])
    live = read_custom_live(spark, ItemSource, source, "event_id long", plan, max_files=2)
    run_until_idle(writer(live, "custom").format("parquet").option("path", out))
    assert rows_of(spark.read.schema("event_id long").parquet(out)) == rows_of(events.select("event_id"))


def test_custom_sink_replaces_a_repeated_batch(spark, events, tmp_path):
    source, progress, out = (str(tmp_path / name) for name in ("source", "progress", "out"))
    files_in_order(events.select("event_id", "value"), source, range(6))

    def run():
        live = read_live(spark, source, "event_id long, value double", max_files=2)
        run_to_end(write_custom_live(live, LiveItemSink, checkpoint=progress, path=out, job="j"))
        return rows_of(read_written(spark, LiveItemSink, "event_id long, value double", path=out))

    want = rows_of(events.select("event_id", "value"))
    assert run() == want
    before = set(committed_counts(out))
    forget_last_commit(progress)
    assert run() == want
    after = set(committed_counts(out))
    assert len(after - before) == len(before - after) > 0  # the last batch was written again
    assert {p.name for p in Path(out).glob("part-*")} == after  # and what it wrote before is gone


def test_sink_commits_by_job_and_batch(tmp_path):
    out = str(tmp_path)
    one, two = LiveItemWriter(out, "one"), LiveItemWriter(out, "two")
    for name in "abcd":
        Path(out, name).write_bytes(b"")
    one.commit([Written("a", 1), None, Written("", 0)], 0)
    two.commit([Written("b", 2)], 0)
    one.commit([Written("c", 3)], 1)
    assert committed_counts(out) == {"a": 1, "b": 2, "c": 3}
    one.commit([Written("d", 4)], 1)
    assert committed_counts(out) == {"a": 1, "b": 2, "d": 4}
    assert not Path(out, "c").exists()
    one.commit([], 2)
    assert committed_counts(out) == {"a": 1, "b": 2, "d": 4}


def test_a_key_with_many_entries_and_several_values(spark, events, tmp_path):
    """All items under one key with an entry each; an entry can be removed, a value can have parts."""
    source, out = str(tmp_path / "source"), str(tmp_path / "out")
    files_in_order(events.select("event_id"), source, range(6))

    def process(key, rows, state):
        seen, last = state.maps["seen"], state.values["last"]
        before = last.get((0, ""))
        for event in rows["event_id"]:
            seen.set(int(event), (int(event) * 2, "x"))
        if 5 in seen:
            assert seen.get(5) == (10, "x") and seen.get(-1, 7) == 7
            seen.remove(5)
        last.set((before[0] + len(rows), "é"))
        return pd.DataFrame({"n": [before[0] + len(rows)], "held": [sum(1 for _ in seen.items())]})

    live = read_live(spark, source, "event_id long", max_files=1).withColumn("key", F.lit("all"))
    found = typed_state(live, ["key"], process, "n long, held long", values={"last": "n long, s string"}, maps={"seen": ("id long", "d long, s string")})
    run_to_end(writer(found, "x").format("parquet").option("path", out))
    rows = sorted(map(tuple, spark.read.parquet(out).select("n", "held").collect()))
    assert rows[-1] == (events.count(), events.count() - 1)


def test_an_idle_key_is_told_once_and_may_come_back(spark, tmp_path):
    source, out = str(tmp_path / "source"), str(tmp_path / "out")
    schema = "user string, n long"

    def put(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)

    put([("a", 1), ("a", 2), ("b", 3)])
    live = read_live(spark, source, schema, max_files=1).select("user")
    ends = typed_state(live, ["user"], q.add_up, schema, values={"n": "n long"}, finish=q.last_count, idle_seconds=3)
    query = run_live(writer(ends, "ends", checkpoint=str(tmp_path / "p")).format("parquet").option("path", out), "200 milliseconds")

    def wait(count):
        until = time.monotonic() + 60
        while time.monotonic() < until:
            assert query.exception() is None
            if Path(out).exists() and len(found := [tuple(r) for r in spark.read.schema(schema).parquet(out).collect()]) >= count:
                return sorted(found)
            time.sleep(0.2)
        raise TimeoutError

    try:
        assert wait(2) == [("a", 2), ("b", 1)]
        put([("b", 5)])
        assert wait(3) == [("a", 2), ("b", 1), ("b", 1)]
    finally:
        query.stop()


@pytest.mark.parametrize("every", [1_000, 7, 50_000])
def test_rates_over_batches_and_a_repeat(spark, events, tmp_path, every):
    frame = events.select("event_id", "ts").where("event_id < 300") if every == 7 else events.select("event_id", "ts")
    source, path, progress = (str(tmp_path / name) for name in ("source", "rates", "progress"))
    want = rows_of(data_rate(frame, "event_id", epoch_micros(frame, "ts"), every))

    def run():
        live = read_live(spark, source, frame.schema, max_files=1)
        run_to_end(rate_live(live, "event_id", epoch_micros(live, "ts"), every, path, checkpoint=progress))
        return rows_of(rates_so_far(spark, path))

    files_in_order(frame, source, (0, 1))
    run()
    files_in_order(frame, source, (2, 3, 4, 5))
    assert run() == want
    forget_last_commit(progress)
    assert run() == want


def test_progress_is_json(spark, tmp_path):
    plan = Plan(str(tmp_path / "plan"))
    plan.write(3, ["a", "é"])
    assert plan.read(3) == ["a", "é"] and plan.batches() == [3]
    assert json.loads(next(Path(tmp_path, "plan").glob("*3.json")).read_text()) == ["a", "é"]
