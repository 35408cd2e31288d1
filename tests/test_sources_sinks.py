import math
import tempfile
from pathlib import Path
from types import SimpleNamespace

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from millrace.operators.chain import instance_tag
from millrace.operators.copies import parse_copies, rescale, with_copies
from millrace.session import clear_work, set_copies, work_dir
from millrace.sinks import files as sinks
from millrace.sources import sharded, synthetic, tables


@pytest.fixture()
def many_files(spark, events, tmp_path):
    path = str(tmp_path / "many")
    events.repartitionByRange(6, "event_id").write.option("parquet.block.size", 1 << 14).parquet(path)
    return path


# Sources


def test_sources_are_named_and_needed(spark, data):
    streams = tables.read_streams(spark, {"e": f"{data}/events.parquet", "r": f"{data}/region.parquet"})
    assert {name: items.count() > 0 for name, items in streams.items()} == {"e": True, "r": True}
    with pytest.raises(ValueError):
        tables.read_streams(spark, {})
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.read_items(spark, f"{data}/missing.parquet")


def numbered_source():
    """A source class made here, so that it travels to the workers by value."""

    class Numbered(sharded.ItemSource):
        """Gives its shard's number with every item."""

        def init(self, shard):
            self.shard = shard

        def items(self, batch):
            shards = pa.array([self.shard] * batch.num_rows, pa.int64())
            return pa.RecordBatch.from_arrays([batch.column("event_id"), shards], names=["event_id", "user_id"])

    return Numbered


@pytest.mark.parametrize("split", [1 << 13, 1 << 16, 1 << 27])
def test_shards_follow_the_bytes_and_read_every_item_once(spark, events, many_files, split):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        got = sharded.read_custom(spark, numbered_source(), many_files, "event_id long, user_id long")
        shards = got.rdd.getNumPartitions()
        rows = [row["event_id"] for row in got.collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(rows) == sorted(row["event_id"] for row in events.select("event_id").collect())
    size = sum(f.stat().st_size for f in Path(many_files).glob("*.parquet"))
    assert shards >= size // split
    if split < 1 << 14:
        assert shards > 6  # a file is split too


def test_columns_and_filters_of_a_custom_source_reach_the_scan(spark, many_files):
    got = sharded.read_custom(spark, sharded.ItemSource, many_files, "event_id long, value double", "value > 400")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(value,400.0)" in plan and "ReadSchema: struct<event_id:bigint,value:double>" in plan
    assert got.count() == spark.read.parquet(many_files).where("value > 400").count()


def test_arrivals_of_many_files(spark, many_files):
    items = tables.read_items(spark, many_files).select("event_id")
    got = tables.number_arrivals(items).select("event_id", "id").collect()
    files = sorted(Path(many_files).glob("*.parquet"))
    arrived = [x for f in files for x in pq.read_table(f, columns=["event_id"]).column(0).to_pylist()]
    assert {row["id"]: row["event_id"] for row in got} == dict(enumerate(arrived))


def test_tolerant_rows_do_not_depend_on_the_columns(spark, tmp_path):
    lines = ['{"a": 1, "b": "x"}', '{"a": 2, "b": "y', '{"a": "no", "b": "z"}', '{"a": 3}', "", "[]", '{"b": "w"}']
    (tmp_path / "in").mkdir()
    (tmp_path / "in/lines.json").write_text("\n".join(lines))
    items = tables.read_tolerant(spark, str(tmp_path / "in"), "a long, b string")
    assert items.count() == len(items.collect()) == items.select("b").count() == len(items.select("a").collect()) == 3


def test_gaussian(spark):
    items = synthetic.gaussian_items(spark, 100_000, ["a", "b"])
    row = items.agg(
        F.avg("a").alias("ma"), F.avg("b").alias("mb"), F.stddev("a").alias("sa"), F.stddev("b").alias("sb"),
        F.corr("a", "b").alias("c"), F.count("a").alias("n"),
    ).first()
    slack = 5 / math.sqrt(100_000)
    assert row["n"] == 100_000
    assert max(abs(row["ma"]), abs(row["mb"]), abs(row["sa"] - 1), abs(row["sb"] - 1), abs(row["c"])) < slack
    again = spark.createDataFrame(synthetic.gaussian_items(spark, 1_000, ["a", "b"]).collect())
    assert again.exceptAll(items).count() == 0  # the same numbers, whatever the size or the partitions
    inside = items.agg(F.avg((F.abs("a") < 1).cast("int")), F.avg((F.abs("a") < 2).cast("int"))).first()
    assert abs(inside[0] - 0.6827) < 0.01 and abs(inside[1] - 0.9545) < 0.01
    assert synthetic.gaussian_items(spark, 10).columns == ["att1"]


def test_constant(spark):
    rows = synthetic.constant_items(spark, 7).collect()
    assert rows == [(1, "streams Framework", ["v1", "v2", "v3"])] * 7


def test_tolerant_read(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"a": 1, "b": "x"}\n{"a": 2, "b"\nrubbish\n{"a": 3}\n{"a": "no"}\n')
    got = tables.read_tolerant(spark, str(tmp_path), "a long, b string").collect()
    assert sorted((row["a"], row["b"]) for row in got) == [(1, "x"), (3, None)]


def test_arrival_numbers_over_many_files(spark, many_files):
    items = tables.read_items(spark, many_files)
    numbered = tables.number_arrivals(items).select("event_id", "id")
    rows = numbered.collect()
    assert sorted(row["id"] for row in rows) == list(range(len(rows)))
    # These files are in event order, so the order of arrival is too.
    assert all(row["id"] == row["event_id"] for row in rows)
    # Only the list of files is shuffled, by bucket; the items are not.
    exchanges = [x for x in numbered._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hash" in x]
    assert all("_bucket" in x or "path" in x for x in exchanges)
    odd = tables.number_arrivals(items).where("event_id % 2 = 1")
    assert odd.where("id <> event_id").count() == 0


# Sinks


def test_json_keys(spark, events, tmp_path):
    path = str(tmp_path / "json")
    sinks.write_json(events, path, ["event_id", "event_type"])
    assert sorted(spark.read.json(path).columns) == ["event_id", "event_type"]
    sinks.write_json(events.limit(5), path)
    assert spark.read.json(path).count() == 5


def test_queue_folders(spark, events, tmp_path):
    path = str(tmp_path / "queues")
    sinks.write_queues(events.select("event_id", F.col("event_type").alias("queue")), path)
    folders = {p.name for p in Path(path).glob("queue=*")}
    assert folders == {f"queue={row[0]}" for row in events.select("event_type").distinct().collect()}
    assert spark.read.parquet(path).count() == events.count()


def test_custom_sink_lists_what_counts(spark, events, tmp_path):
    path = str(tmp_path / "arrow")
    sinks.write_custom(events.select("event_id").repartition(3), sinks.ItemSink, path=path)
    counts = sinks.committed_counts(path)
    assert len(counts) == 3 and sum(counts.values()) == events.count()
    assert {p.name for p in Path(path).glob("part-*")} == set(counts)


def test_a_second_write_adds_and_an_overwrite_replaces(spark, tmp_path):
    path = str(tmp_path / "arrow")
    read = lambda: sorted(r["id"] for r in sinks.read_written(spark, sinks.ItemSink, "id long", path=path).collect())
    sinks.write_custom(spark.range(10), sinks.ItemSink, path=path)
    sinks.write_custom(spark.range(10, 15), sinks.ItemSink, path=path)
    assert read() == list(range(15))
    (tmp_path / "arrow/part-of-a-failed-task.arrow").write_bytes(b"broken")
    sinks.write_custom(spark.range(3), sinks.ItemSink, mode="overwrite", path=path)
    assert read() == [0, 1, 2]
    sinks.write_custom(spark.range(0), sinks.ItemSink, path=path)
    assert read() == [0, 1, 2]


def test_collect_is_bounded(spark):
    assert len(sinks.collect_items(spark.range(5), 5)) == 5
    with pytest.raises(ValueError):
        sinks.collect_items(spark.range(6), 5)


def test_print(spark, capfd, tmp_path):
    sinks.preview_items(spark.range(3), 2)
    assert "only showing top 2 rows" in capfd.readouterr().out
    path = str(tmp_path / "printed")
    sinks.print_items(spark.range(60, numPartitions=3), lambda row: print(row, file=open(path, "a")))
    assert len(Path(path).read_text().splitlines()) == 60


def test_terminal(events):
    assert sinks.run_terminal(events) is None


# Copies and instances


def test_copies(spark, events):
    assert [parse_copies(x) for x in (3, "4")] == [3, 4]
    for bad in ("x", None, "", "-2", 0):
        with pytest.raises(ValueError, match="copies"):
            with_copies(events, bad)
    assert with_copies(events, 5).rdd.getNumPartitions() == 5
    assert rescale(with_copies(events, 5), 2).rdd.getNumPartitions() == 2
    assert rescale(events, 2).count() == with_copies(events, 3).count() == events.count()


def test_job_copies(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        set_copies(spark, 3)
        parts = spark.range(1000).repartition("id")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        assert parts.rdd.getNumPartitions() == 3
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        set_copies(spark, int(before))


def test_instance_tags_differ_by_instance(spark):
    tags = spark.range(100, numPartitions=4).transform(instance_tag("p")).select("copy_id").distinct().collect()
    assert {row[0] for row in tags} == {"p@0", "p@1", "p@2", "p@3"}


def session_like(master, folder):
    """Stands for a session on another kind of cluster."""
    conf = SimpleNamespace(get=lambda key, default=None: folder)
    context = SimpleNamespace(master=master, applicationId=f"app-{master}", getConf=lambda: conf)
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_work_dir_is_in_the_shared_folder():
    cluster = session_like("yarn", "hdfs://shared/dir/")
    one, two = work_dir(cluster, "x"), work_dir(cluster, "x")
    assert one.startswith("hdfs://shared/dir/millrace/app-yarn/x-") and one != two


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_dir(session_like("yarn", None), "x")
    assert work_dir(session_like("local[2]", None), "x").startswith(f"{tempfile.gettempdir()}/millrace-")


def test_work_is_cleared(spark):
    path = work_dir(spark, "cleared")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    clear_work(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
