import datetime as dt
import random
import sys
from collections import defaultdict

import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators import keyed as k
from millrace.plans.flow import Flow, Keyed


@pytest.fixture(scope="module")
def skewed_rows():
    rnd = random.Random(5)
    rows = []
    for n in range(3000):
        key = "hot" if n % 3 == 0 else None if n % 7 == 0 else f"u{rnd.randrange(60)}"
        rows.append((key, rnd.randrange(1000), n))
    return rows


@pytest.fixture()
def skewed(spark, skewed_rows):
    return spark.createDataFrame(skewed_rows, "key string, at int, seq long").repartition(4)


cloudpickle.register_pickle_by_value(sys.modules[__name__])  # for functions run by Python workers

ORDER = ["at", "seq"]


def by_key(rows):
    groups = defaultdict(list)
    for row in sorted(rows, key=lambda r: (r[1], r[2])):
        groups[row[0]].append(row)
    return groups


def test_hot_keys_are_cut_and_others_are_not(skewed, skewed_rows):
    parted = k.with_segments(skewed, k.key_cuts(skewed, "key", ORDER, 100))
    sizes = {(r["key"], r[k.SEGMENT]): r["count"] for r in parted.groupBy("key", k.SEGMENT).count().collect()}
    assert len([1 for key, _ in sizes if key == "hot"]) >= 8
    assert len([1 for key, _ in sizes if key is None]) >= 2
    assert max(sizes.values()) <= 300
    assert all(len([1 for other, _ in sizes if other == key]) == 1 for key, _ in sizes if key and key != "hot")
    assert sum(sizes.values()) == len(skewed_rows)


def test_small_input_is_not_sampled(skewed):
    assert k.key_cuts(skewed, "key", ORDER).cuts is None


@pytest.mark.parametrize("limit", [100, 10_000])
def test_running_count(skewed, skewed_rows, limit):
    got = {r["seq"]: r["n"] for r in k.running_count(skewed, "key", ORDER, rows_per_segment=limit).collect()}
    want = {row[2]: place for rows in by_key(skewed_rows).values() for place, row in enumerate(rows, 1)}
    assert got == want


def wanted_sums(skewed_rows):
    """Per item: running sum of its key, and distance to the item before."""
    want = {}
    for rows in by_key(skewed_rows).values():
        total, before = 0, rows[0][2]
        for _, at, seq in rows:
            total += at
            want[seq] = (total, seq - before)
            before = seq
    return want


def carries():
    return {"total": k.Carry(F.sum("at"), F.sum), "last": k.Carry(F.max(F.struct("at", "seq")), F.max)}


def one_key(rows: pd.DataFrame, state: dict) -> pd.DataFrame:
    total = (state["total"] or 0) + rows["at"].cumsum()
    first = rows["seq"].iloc[0] if state["last"] is None else state["last"]["seq"]
    before = rows["seq"].shift(1, fill_value=first)
    return pd.DataFrame({"seq": rows["seq"], "total": total, "d": rows["seq"] - before})


def many_keys(rows: pd.DataFrame) -> pd.DataFrame:
    groups = rows.groupby("key", dropna=False)
    total = groups["at"].cumsum() + rows["total"].fillna(0)
    last = rows["last"].map(lambda state: None if pd.isna(state) else state["seq"]).astype("int64[pyarrow]")
    before = groups["seq"].shift(1).fillna(last).fillna(rows["seq"])
    return pd.DataFrame({"seq": rows["seq"], "total": total, "d": rows["seq"] - before})


@pytest.mark.parametrize("limit", [100, 10_000])
@pytest.mark.parametrize("by_one", [True, False])
def test_keyed_apply_carries_state_over_cuts(skewed, skewed_rows, limit, by_one):
    process = k.each_key("key", one_key, ["total", "last"]) if by_one else many_keys
    schema = "seq long, total long, d long"
    done = k.keyed_apply(skewed, "key", ORDER, process, schema, carries(), limit, rows_per_call=200)
    got = {r["seq"]: (r["total"], r["d"]) for r in done.collect()}
    assert got == wanted_sums(skewed_rows)


def test_keyed_apply_shuffles_and_sorts_once(skewed):
    done = k.keyed_apply(skewed, "key", ORDER, lambda rows: rows[["seq"]], "seq long")
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1


def test_one_call_gets_many_keys(skewed):
    def call(rows):
        return pd.DataFrame({"keys": [rows["key"].nunique(dropna=False)], "rows": [len(rows)]})

    calls = k.keyed_apply(skewed, "key", ORDER, call, "keys long, rows long", rows_per_call=1_000).collect()
    assert sum(row["keys"] for row in calls) == 62 and sum(row["rows"] for row in calls) == 3000
    assert len(calls) <= 8


@pytest.mark.parametrize(
    "order, kind, make",
    [
        (["at", "seq"], "string", lambda n: f"t{n % 90:03}"),
        (["at", "seq"], "timestamp_ntz", lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=n % 500)),
        (["at", "seq"], "double", lambda n: [float("nan"), float("inf"), -1.0, None][n % 4]),
        (["at", "seq"], "int", lambda n: 5),
        (["at", "seq"], "int", lambda n: n % 3),
        (["at", "seq"], "date", lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n % 4) if n % 5 else None),
        (["seq"], "int", lambda n: 0),
    ],
)
def test_orders_of_all_kinds(spark, order, kind, make):
    """The order's first column may be no number, or too coarse to cut by."""
    rows = [(-1 if n % 3 == 0 else n % 40, make(n), n) for n in range(2000)]
    items = spark.createDataFrame(rows, f"key int, at {kind}, seq long").repartition(4)
    window = Window.partitionBy("key").orderBy(*order)
    want = {r["seq"]: r["n"] for r in items.withColumn("n", F.row_number().over(window)).collect()}
    done = k.running_count(items, "key", order, rows_per_segment=60)
    assert {r["seq"]: r["n"] for r in done.collect()} == want
    sizes = k.with_segments(items, k.key_cuts(items, "key", order, 60)).groupBy("key", k.SEGMENT).count()
    assert sizes.agg(F.max("count")).first()[0] <= 240


def test_keys_that_are_no_number(spark):
    """NaN is one key, although no NaN equals another."""
    rows = [(float("nan") if n % 3 == 0 else [0.0, -0.0, 1.5][n % 3], n) for n in range(900)]
    items = spark.createDataFrame(rows, "key double, seq long").repartition(4)
    got = {r["seq"]: r["n"] for r in k.running_count(items, "key", ["seq"], rows_per_segment=50).collect()}
    assert got == {n: n // 3 + 1 for n in range(900)}


def test_keys_stay_together(skewed):
    placed = k.group_by_key(skewed, "key", ORDER, copies=6).withColumn("part", F.spark_partition_id())
    assert placed.count() == 3000
    assert placed.groupBy("key").agg(F.countDistinct("part").alias("n")).where("n > 1").count() == 0


def test_items_of_a_key_come_in_order(skewed):
    placed = k.group_by_key(skewed.repartition(7), "key", ORDER, copies=3)

    def before(rows):
        for batch in rows:
            yield pd.DataFrame({"key": batch["key"], "at": batch["at"], "seq": batch["seq"]})

    rows = placed.mapInPandas(before, "key string, at long, seq long").collect()
    seen = {}
    for row in rows:
        assert seen.get(row["key"], (-1, -1)) < (row["at"], row["seq"])
        seen[row["key"]] = (row["at"], row["seq"])


def test_a_cut_without_carry_is_refused(skewed):
    with pytest.raises(ValueError, match="hot"):
        k.keyed_apply(skewed, "key", ORDER, lambda rows: rows[["seq"]], "seq long", rows_per_segment=100)


def test_wide_rows_make_smaller_calls(spark):
    wide = spark.range(100).select("id", F.repeat(F.lit("x"), 1_000).alias("x"))
    assert k.rows_within(wide, 1_000_000, 100_000) in range(90, 101)
    assert k.rows_within(wide.select("id"), 1_000_000, 100) == 1_000_000


def test_a_keyed_step_of_a_flow(skewed, skewed_rows):
    flow = Flow({"data": skewed})
    for limit in (100, 10_000):
        step = Keyed(many_keys, "seq long, total long, d long", carries(), rows_per_segment=limit)
        done = flow.process("sums", step, input="data", group_by="key", order=ORDER)
        assert {r["seq"]: (r["total"], r["d"]) for r in done.collect()} == wanted_sums(skewed_rows)
    with pytest.raises(ValueError, match="group_by"):
        flow.process("sums", step, input="data")


def test_instances_set_up_process_and_finish(spark):
    items = spark.range(100, numPartitions=4)
    done = k.process_partitions(
        items,
        lambda: {"n": 0},
        lambda seen, batch: seen.update(n=seen["n"] + len(batch)),
        "n long",
        lambda seen: pd.DataFrame({"n": [seen["n"]]}),
    ).collect()
    assert sorted(row["n"] for row in done) == [25, 25, 25, 25]


def test_instances_do_not_share(spark):
    """Each instance starts from its own object, so every one sees its first batch as the first."""

    def process(seen, batch):
        seen.append(1)
        return pd.DataFrame({"nth": [len(seen)]})

    done = k.process_partitions(spark.range(8, numPartitions=4), list, process, "nth long").collect()
    assert [row["nth"] for row in done] == [1, 1, 1, 1]
