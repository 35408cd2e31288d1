import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.functions import attribute, condition, has_attribute, merge_streams, put, with_attributes
from millrace.operators import chain as c
from millrace.operators import routing as r
from millrace.operators.lookup import lookup
from millrace.plans import samples
from millrace.plans.flow import Enqueue, Flow

RULES = {"gamma": "event_type = 'error'", "hadron": "event_type = 'click'"}


def plan(items):
    return items._jdf.queryExecution().executedPlan().toString()


def ids(items):
    return sorted(row["event_id"] for row in items.select("event_id").collect())


def test_branches_and_rest_are_the_input(events):
    branches = r.split(events, RULES)
    routed = [i for items in branches.values() for i in ids(items)]
    rest = ids(events.where("event_type NOT IN ('error', 'click')"))
    assert sorted(routed + rest) == ids(events)
    for queue, items in branches.items():
        assert [row["queue"] for row in items.select("queue").distinct().collect()] == [queue]


def test_branch_filter_reaches_the_scan(events):
    assert "EqualTo(event_type,error)" in plan(r.split(events, RULES)["gamma"].select("event_id"))
    assert "Or(EqualTo(event_type,error),EqualTo(event_type,click))" in plan(r.emit(events, RULES))
    assert plan(r.emit(events, RULES)).count("FileScan") == 1


def test_unknown_test_routes_nowhere(spark):
    items = spark.createDataFrame([(1, None), (2, "A"), (3, "B")], "event_id long, flag string")
    assert ids(r.first_match(items, {"a": "%{data.flag} == 'A'"})) == [2]
    assert ids(r.emit(items, {"a": "%{data.flag} == 'A'"})) == [2]
    assert ids(items.transform(c.skip("%{data.flag} == 'A'"))) == [1, 3]
    assert ids(items.transform(c.skip())) == []


def test_label_is_exact_and_stays(spark):
    rows = [(1, "gamma"), (2, " gamma"), (3, None), (4, "gammas")]
    items = spark.createDataFrame(rows, "event_id long, queue string")
    assert ids(r.select_queues(items, [" gamma "])) == [1]
    assert r.select_queues(items, ["gamma"]).first()["queue"] == "gamma"


def test_first_rule_wins_in_first_match_and_all_rules_count_in_emit(spark):
    items = spark.createDataFrame([(1, 5), (2, 50)], "event_id long, v long")
    rules = {"any": None, "big": "v > 10"}
    assert Counter(row["queue"] for row in r.first_match(items, rules).collect()) == {"any": 2}
    assert Counter(row["queue"] for row in r.emit(items, rules).collect()) == {"any": 2, "big": 1}


def test_emit_order(spark):
    items = spark.createDataFrame([(1, 5), (2, 50), (3, None)], "event_id long, v long")
    got = r.emit(items, {"big": "v > 10", "small": "v <= 10", "all": None}, output=True, ordinal="ord")
    assert sorted((row["event_id"], row["ord"], row["queue"]) for row in got.collect()) == [
        (1, 0, None), (1, 1, "small"), (1, 2, "all"),
        (2, 0, None), (2, 1, "big"), (2, 2, "all"),
        (3, 0, None), (3, 1, "all"),
    ]


def test_relabelling_replaces_the_label(spark):
    items = spark.createDataFrame([(1, "old")], "event_id long, queue string")
    assert r.emit(items, {"new": None}).first()["queue"] == "new"
    assert r.enqueue(items, "new").first()["queue"] == "new"


def test_bulk(spark):
    items = spark.createDataFrame([(1, [10, 20]), (2, [])], "event_id long, batch array<long>")
    got = r.enqueue_bulk(items, F.col("batch"), "q1").select("event_id", "pos", "item", "queue").collect()
    assert sorted(map(tuple, got)) == [(1, 0, 10, "q1"), (1, 1, 20, "q1")]


def test_chain_is_one_projection(events):
    done = c.chain(
        events, c.set_value("a", 1), c.set_value("b", F.col("value") * 2), c.set_value("a", 2, when="value > 10")
    ).select("event_id", "a", "b")
    assert plan(done).count("Project") == 1
    wanted = events.where("value > 10").count()
    assert done.where("a = 2").count() == wanted


def test_set_value_keeps_the_old_one_where_the_test_fails(spark):
    items = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "event_id long, k string")
    done = items.transform(c.set_value("k", "z", when="k = 'x'")).orderBy("event_id")
    assert [row["k"] for row in done.collect()] == ["z", "y", None]


def test_a_whole_step_under_a_condition(spark):
    items = spark.createDataFrame([(1, 5), (2, 50), (3, None)], "event_id long, v long")

    def step(items):
        return items.withColumn("v", F.col("v") * 2).withColumn("big", F.lit(True))

    got = items.transform(c.only_if("%{data.v} > 10", step)).orderBy("event_id").collect()
    assert [tuple(row) for row in got] == [(1, 5, None), (2, 100, True), (3, None, None)]


def test_null_items(spark):
    items = spark.createDataFrame([(None, None), (1, None), (None, "a")], "event_id long, k string")
    assert c.drop_null_items(items).count() == 2


def test_open_attributes(spark):
    items = spark.createDataFrame([('{"k": 3, "n": null}',), ("{}",), (None,)], "props string")
    got = items.select(attribute("props", "k", "long").alias("k"), has_attribute("props", "n").alias("n")).collect()
    assert [(row["k"], row["n"]) for row in got] == [(3, False), (None, False), (None, False)]
    assert put(items, "x", 1).first()["x"] == 1
    rows = with_attributes(items, "props", "k", "n").collect()
    assert [(row["k"], row["n"]) for row in rows] == [("3", None), (None, None), (None, None)]
    odd = spark.createDataFrame([("rubbish",), ('{"k": {"a": 1}}',)], "props string")
    assert [row["k"] for row in with_attributes(odd, "props", "k").collect()] == [None, '{"a":1}']


def test_streams_with_other_columns_meet(spark):
    a = spark.createDataFrame([(1,)], "event_id long")
    b = spark.createDataFrame([("x",)], "k string")
    assert sorted(map(str, merge_streams(a, b).collect())) == ["Row(event_id=1, k=None)", "Row(event_id=None, k='x')"]


def test_condition_text(spark):
    items = spark.createDataFrame([("A",)], ["flag"])
    assert items.where(condition("%{data.flag} == 'A'")).count() == 1


def test_log_tap_counts(events):
    tapped, tap = c.log_tap(events.where("event_type = 'click'"), "before")
    assert tapped.count() == tap.get["items"] == events.where("event_type = 'click'").count()


# Flow


def test_unknown_names(events):
    flow = Flow({"data": events})
    with pytest.raises(KeyError, match="nowhere"):
        flow.process("p", input="nowhere")
    with pytest.raises(KeyError):
        flow.process("p")
    with pytest.raises(ValueError):
        Flow({})
    with pytest.raises(KeyError):
        flow.written("p")


def test_a_later_producer_replaces_the_name(events):
    flow = Flow({"data": events}, "q")
    flow.process("one", Enqueue("q", RULES["gamma"]), input="data")
    early = flow["q"]
    flow.process("two", Enqueue("q", RULES["hadron"]), input="data")
    assert ids(early) == ids(events.where(RULES["gamma"]))
    assert ids(flow["q"]) == ids(events.where(RULES["hadron"]))


def test_undeclared_queue_is_empty(events):
    flow = Flow({"data": events}, "q")
    flow.process("p", Enqueue("ghost, q"), input="data")
    assert flow["ghost"].count() == 0
    assert flow["ghost"].columns == flow["q"].columns
    assert flow["q"].count() == events.count()


def test_queue_holds_the_item_as_it_was(events):
    flow = Flow({"data": events.select("event_id")}, "q")
    out = flow.process("p", c.set_value("a", 1), Enqueue("q"), c.set_value("a", 2), input="data", output="x")
    assert flow["q"].select("a").distinct().collect()[0]["a"] == 1
    assert out.select("a").distinct().collect()[0]["a"] == 2
    both = Counter((row["a"], row["queue"]) for row in flow["x"].collect())
    assert both == {(2, None): events.count(), (1, "q"): events.count()}


def test_output_and_queues_in_one_pass(events):
    flow = Flow({"data": events.select("event_id", "event_type")}, "gamma, hadron")
    flow.process("p", Enqueue("gamma", RULES["gamma"]), Enqueue("hadron", RULES["hadron"]), input="data", output="x")
    assert plan(flow["x"]).count("FileScan") == 1
    errors, clicks = (events.where(RULES[q]).count() for q in ("gamma", "hadron"))
    got = Counter(row["queue"] for row in flow["x"].collect())
    assert got == {None: events.count(), "gamma": errors, "hadron": clicks}
    assert flow.written("p").count() == errors + clicks


def test_writing_twice_to_one_queue_gives_two_items(events):
    flow = Flow({"data": events.select("event_id")}, "q")
    flow.process("p", Enqueue("q"), Enqueue("q"), input="data", output="x")
    assert flow["q"].count() == flow.written("p").count() == 2 * events.count()
    assert flow["x"].count() == 3 * events.count()


def test_skip_at_the_end_leaves_only_queued_items(events):
    flow = Flow({"data": events.select("event_id")}, "q")
    flow.process("p", Enqueue("q"), c.skip(), input="data", output="x")
    assert {row["queue"] for row in flow["x"].collect()} == {"q"}


def test_empty_output_publishes_nothing(events):
    flow = Flow({"data": events})
    flow.process("p", input="data", output=" ")
    assert "" not in flow and " " not in flow


def test_shared_stream_is_gathered_in_one_scan(events):
    flow = Flow({"data": events.select("event_id")})
    flow.process("p", input="data", output="a, b")
    both = flow.gather("a", "b", tag="output")
    assert plan(both).count("FileScan") == 1
    assert Counter(row["output"] for row in both.collect()) == {"a": events.count(), "b": events.count()}


def test_group_by_in_a_process(events):
    flow = Flow({"data": events.select("event_id", "user_id")})
    out = flow.process("p", input="data", group_by="user_id", order=["event_id"])
    parts = out.withColumn("part", F.spark_partition_id()).groupBy("user_id").agg(F.countDistinct("part").alias("n"))
    assert parts.where("n > 1").count() == 0
    assert flow.process("p", input="data", group_by=" ").count() == events.count()
    with pytest.raises(ValueError):
        flow.process("p", input="data", group_by="user_id")


def test_copies_and_services_of_a_flow(spark, events):
    service = spark.createDataFrame([("error", 1), ("click", 2)], "kind string, code int")
    flow = Flow({"data": events.select("event_id", "event_type")}, services={"codes": service})
    found = flow.process(
        "p", lambda d: lookup(d, flow.service("codes"), "event_type", "kind", ["code"]), input="data", copies="3"
    )
    assert found.where("code = 1").count() == events.where("event_type = 'error'").count()
    assert flow.process("p", input="data", copies=3).rdd.getNumPartitions() == 3
    with pytest.raises(KeyError, match="nothing"):
        flow.service("nothing")


def test_samples(spark):
    data = spark.range(1000).withColumnRenamed("id", "seq")
    flow = samples.routing_sample(data, "seq")
    assert flow["gamma"].count() == flow["hadron"].count() == 500
    assert flow["gamma"].where("id % 2 = 1 OR flag <> 'A'").count() == 0
    done = samples.queue_sample(data)
    assert done.where("queue = 'q1' AND fromQueue = 'true'").count() == 1000
    assert samples.count_sample(spark.range(100_000)).first()["n"] == 100_000


def test_an_output_replaces_a_queue_of_its_name(events):
    flow = Flow({"data": events}, "gamma")
    flow.process("p", Enqueue("gamma", "event_type = 'error'"), input="data", output="gamma")
    errors = events.where("event_type = 'error'").count()
    assert flow["gamma"].count() == events.count() + errors


def test_conditions_read_the_open_part(spark):
    rows = [(1, '{"k": 5, "a.b": "x"}'), (2, '{"k": 1}'), (3, None), (4, "broken")]
    items = spark.createDataFrame(rows, "event_id long, props string")
    assert ids(r.enqueue(items, "q", "%{data.k} > 3")) == [1]
    assert ids(r.enqueue(items, "q", "%{data.a.b} = 'x'")) == [1]
    assert ids(r.enqueue(items, "q", "%{data.event_id} > 2")) == [3, 4]
    assert ids(r.emit(items, {"q": "%{data.nowhere} = 1"})) == []
    assert ids(items.drop("props").transform(c.skip("%{data.k} = 1"))) == [1, 2, 3, 4]


def test_only_if_with_any_step(spark):
    items = spark.createDataFrame([(1, 5), (2, 50), (3, None)], "event_id long, v long")
    assert ids(items.transform(c.only_if("v > 10", c.skip()))) == [1, 3]
    doubled = items.transform(c.only_if("v > 10", lambda d: d.union(d)))
    assert ids(doubled) == [1, 2, 2, 3]
    marked = items.transform(c.only_if("v > 10", c.set_value("m", 1)))
    assert marked._jdf.queryExecution().optimizedPlan().toString().count("Union") == 0
    assert {row["event_id"]: row["m"] for row in marked.collect()} == {1: None, 2: 1, 3: None}


def test_put_into_the_open_part(spark):
    rows = [(1, '{"k": 5, "s": "t", "o": {"x": [1, null]}}'), (2, None), (3, "broken"), (4, "[1]"), (5, '{"n": 1}')]
    items = spark.createDataFrame(rows, "event_id long, props string")
    got = {row["event_id"]: json.loads(row["props"]) for row in put(items, "n", F.col("event_id"), "props").collect()}
    assert got[1] == {"k": 5, "s": "t", "o": {"x": [1, None]}, "n": 1}
    assert [got[i] for i in (2, 3, 4, 5)] == [{"n": i} for i in (2, 3, 4, 5)]


def test_a_dot_in_a_key_is_part_of_it(spark):
    items = spark.createDataFrame([(1, '{"a.b": 1, "a": {"b": 2}}')], "event_id long, props string")
    row = with_attributes(items, "props", "a.b").select("`a.b`", attribute("props", "a.b").alias("x"), has_attribute("props", "b.a"))
    assert tuple(row.first()) == ("1", "1", False)
