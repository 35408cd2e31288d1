"""Hot keys by summary, limits inside files, tolerant reads with a second output, one parse of the open part,
services read only when they change."""

import json
import re

import pytest
from pyspark.sql import functions as F

from millrace.functions import OpenPart, put, rows_within
from millrace.operators.hot import hot_keys
from millrace.operators.keyed import keyed_apply
from millrace.operators.lookup import lookup, measured
from millrace.sources import tables
from millrace.sources.tables import broken_lines, good_items, limit_items, number_arrivals, read_items, read_live, read_split
from millrace.streaming.lookup import Snapshot, lookup_reset
from millrace.streaming.routing import parquet_batches
from millrace.streaming.run import run_to_end


def exact(items, key, least):
    return {tuple(r) for r in items.where(F.col(key).isNotNull()).groupBy(key).count().where(F.col("count") > least).collect()}


@pytest.mark.parametrize("counters", [4, 50, 8_192])
@pytest.mark.parametrize("kind", ["long", "string", "decimal(30,2)", "date", "double", "struct"])
def test_hot_keys_are_those_of_a_full_count(spark, counters, kind):
    """A third of the items under one key, some hot ones, many keys with one item, some without a key."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, 8).when(F.col("id") % 10 == 4, None).otherwise(F.col("id") + 10)
    typed = F.struct(key.alias("a")) if kind == "struct" else F.date_add(F.lit("2020-01-01").cast("date"), key.cast("int")) if kind == "date" else key.cast(kind)
    items = spark.range(30_000, numPartitions=7).select("id", F.when(key.isNotNull(), typed).alias("k"))
    want = exact(items, "k", 1_500)
    assert len(want) == 2
    found = hot_keys(items, "k", 1_500, 10, counters)
    if counters * 1_500 > 30_000 or kind == "long":
        assert set(found) == want and found[0][1] >= found[1][1]
    else:
        assert set(found) <= want
    assert set(hot_keys(items, "k", 1_500, 1, counters)) <= {max(want, key=lambda r: r[1])}
    assert hot_keys(items, "k", 30_000, 10) == [] == hot_keys(items.limit(0), "k", 0, 10)


def test_no_shuffle_of_all_keys(spark):
    """What the summaries send on is bounded by partitions and counters, not by keys."""
    items = spark.range(100_000, numPartitions=4).select(F.col("id").alias("k"))
    assert hot_keys(items, "k", 50_000, 5, counters=10) == []


def test_keyed_apply_refuses_by_the_summary(spark):
    items = spark.range(40_000).select("id", F.when(F.col("id") % 4 == 0, 3).otherwise(F.col("id")).alias("k"))
    with pytest.raises(ValueError, match="key 3 has 10001 rows"):
        keyed_apply(items, "k", ["id"], lambda rows: rows[["id"]], "id long", rows_per_segment=5_000)
    nameless = items.withColumn("k", F.when(F.col("id") % 2 == 0, F.col("k")))
    with pytest.raises(ValueError, match="key None has 20000 rows"):
        keyed_apply(nameless, "k", ["id"], lambda rows: rows[["id"]], "id long", rows_per_segment=15_000)


def test_width_does_not_depend_on_the_order_of_rows(spark):
    wide = F.when(F.col("id") < 1_000, F.lit("x")).otherwise(F.repeat(F.lit("x"), 40_000))
    items = spark.range(2_000, numPartitions=2).select("id", wide.alias("t"))
    limits = [rows_within(items.orderBy(o), 1_000_000, 512 << 20) for o in (F.asc("id"), F.desc("id"))]
    assert all(20_000 < limit < 36_000 for limit in limits)


@pytest.mark.parametrize("few", [10_000, 2])
@pytest.mark.parametrize("limit", [0, 1, 2_500, 5_000, 7_777, 10_000, 20_000])
def test_a_limit_inside_the_files(spark, events, tmp_path_factory, monkeypatch, few, limit):
    monkeypatch.setattr(tables, "FEW_FILES", few)
    path = str(tmp_path_factory.mktemp("limit") / "events")
    events.select("event_id", "value").repartitionByRange(4, "event_id").sortWithinPartitions("event_id").write.parquet(path)
    taken = limit_items(read_items(spark, path), limit, small=0)
    assert taken.columns == ["event_id", "value"]
    assert sorted(r.event_id for r in taken.collect()) == list(range(min(limit, 10_000)))
    shown = taken._jdf.queryExecution().executedPlan().toString()
    assert "CollectLimit" not in shown and "GlobalLimit" not in shown and (few == 2 or "Exchange SinglePartition" not in shown)
    numbered = number_arrivals(read_items(spark, path)).where("id < 30").collect()
    assert all(r.id == r.event_id for r in numbered) and len(numbered) == 30


LINES = ['{"a":1,"b":"x"}', '{"a":"no","b":"y"}', "", '{"a":2', '{"a":3,"b":null}', "not json", '  ', '{"a":4,"b":"é","c":5}']


def test_broken_lines_have_file_and_line(spark, tmp_path):
    """Over several files, cut into splits of a few bytes."""
    want_good, want_bad = [], set()
    for name in ("one", "two"):
        lines = [LINES[(i + len(name)) % len(LINES)] for i in range(50)] + (["last"] if name == "two" else [])
        (tmp_path / f"{name}.json").write_text("\n".join(lines), encoding="utf-8")
        for number, line in enumerate(lines, 1):
            try:
                item = json.loads(line)
                assert isinstance(item["a"], int)
                want_good.append((item["a"], item["b"]))
            except (ValueError, AssertionError, KeyError):
                if line.strip():
                    want_bad.add((name, number, line))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    try:
        split = read_split(spark, str(tmp_path), "a long, b string")
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 4
        good = [tuple(r) for r in good_items(split).collect()]
        bad = {(re.search(r"(\w+)\.json", r.file)[1], r.line, r.broken) for r in broken_lines(split).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(good, key=str) == sorted(want_good, key=str)
    assert bad == want_bad
    assert len(re.findall("from_json|JsonToStructs", split._jdf.queryExecution().optimizedPlan().toString())) == 1


def test_no_lines_at_all(spark, tmp_path):
    (tmp_path / "empty.json").write_text("")
    split = read_split(spark, str(tmp_path), "a long")
    assert split.count() == good_items(split).count() == broken_lines(split).count() == 0


def test_open_part_is_parsed_once_and_equals_single_puts(spark):
    texts = ['{"k":1,"n":"old","deep":{"x":[1,2]}}', None, "broken", "{}", '{"n":null}', "[1]"]
    items = spark.createDataFrame(list(enumerate(texts)), "id long, props string")
    puts = [("n", F.col("id") * 2), ("a.b", F.lit("t")), ("n", F.col("id")), ("f", F.lit(1.5))]
    held, single = OpenPart(items), items
    for key, value in puts:
        held.put(key, value)
        single = put(single, key, value, open_part="props")
    got = held.items()
    assert got.columns == items.columns
    parsed = lambda frame: {r.id: json.loads(r.props) for r in frame.collect()}
    assert parsed(got) == parsed(single)
    shown = got._jdf.queryExecution().optimizedPlan().toString()
    assert shown.count("parseJson") == 1 and shown.count("StructsToJsonEvaluator") == 1


def test_conditional_puts_read_what_was_put_before(spark):
    items = spark.createDataFrame([(1, '{"k":1}'), (2, '{"k":2,"flag":"B"}'), (3, None)], "id long, props string")
    held = OpenPart(items)
    held.put("flag", "A", when=F.col("id") == 1)
    held.put("both", F.concat(held.get("flag"), F.lit("!")), when=held.get("flag").isNotNull())
    rows = {r.id: (json.loads(r.props), r.flag, r.k) for r in held.items(flag=held.get("flag"), k=held.get("k", "long")).collect()}
    assert rows == {1: ({"k": 1, "flag": "A", "both": "A!"}, "A", 1), 2: ({"k": 2, "flag": "B", "both": "B!"}, "B", 2), 3: ({}, None, None)}
    same = OpenPart(items).items()
    assert {r.id: json.loads(r.props) for r in same.collect()} == {1: {"k": 1}, 2: {"k": 2, "flag": "B"}, 3: {}}


def test_a_service_is_measured_in_one_reading(spark):
    side = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d"), (None, "e")], "k long, v string")
    size = measured(side, "k")
    assert (size.rows, size.doubled) == (5, (2, 2)) and size.bytes == measured(side).bytes > 0
    assert measured(side.where("v <> 'c'"), "k").doubled is None
    assert measured(side.limit(0), "k") == measured(side.limit(0)) and measured(side.limit(0)).fits()


def test_a_service_is_read_only_when_it_changes(spark, events, tmp_path):
    """Six micro-batches; the service changes once in between."""
    source, place, out, progress = (str(tmp_path / n) for n in ("source", "service", "out", "progress"))
    users = spark.range(1_000).select(F.col("id").alias("k"), F.lit("first").alias("name"))
    users.write.parquet(place)
    snapshot = Snapshot(lambda: spark.read.parquet(place), "k", ["name"])

    def batches(parts):
        for part in parts:
            events.where(F.col("event_id") % 6 == part).coalesce(1).write.mode("append").parquet(source)
        live = read_live(spark, source, events.schema, max_files=1).select("event_id", "user_id")
        run_to_end(lookup_reset(live, lambda: spark.read.parquet(place), "user_id", "k", ["name"], parquet_batches(out), progress, snapshot))

    batches((0, 1, 2))
    assert snapshot.readings == 1
    users.withColumn("name", F.lit("second")).write.mode("overwrite").parquet(place)
    batches((3, 4, 5))
    assert snapshot.readings == 2
    snapshot.forget()
    got = spark.read.parquet(f"{out}/batch=*").groupBy("name", (F.col("event_id") % 6 < 3).alias("early")).count().collect()
    assert {(r["name"], r.early) for r in got} == {("first", True), ("second", False)}
    assert sum(r["count"] for r in got) == events.count()


def test_a_service_without_files_is_read_every_time(spark):
    snapshot = Snapshot(lambda: spark.range(3).select(F.col("id").alias("k"), F.lit("x").alias("v")), "k", ["v"])
    for _ in range(2):
        side, size = snapshot.now()
        assert size.rows == 3
    assert snapshot.readings == 2
    items = spark.range(5)
    assert lookup(items, side, "id", "_service_key", ["v"], size=size).where("v = 'x'").count() == 3
