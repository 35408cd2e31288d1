import datetime as dt
import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from millrace.functions import epoch_micros
from millrace.operators import ordering as o


def brute(rows, key):
    return {row[-1]: place for place, row in enumerate(sorted(rows, key=key))}


def nulls_first(value):
    return (value is not None, value if value is not None else 0)


def check(spark, rows, schema, order, key, rows_per_bucket=50, bound=6):
    items = spark.createDataFrame(rows, schema).repartition(5)
    got = {row["tie"]: row["id"] for row in o.number_rows(items, order, rows_per_bucket=rows_per_bucket).collect()}
    assert got == brute(rows, key)
    cuts = o.cut_points(items, order, rows_per_bucket)
    sizes = [row["count"] for row in o.with_buckets(items, cuts).groupBy(o.BUCKET).count().collect()]
    assert len(sizes) > 4
    assert max(sizes) <= bound * rows_per_bucket
    return got


def test_unique_numbers(spark):
    rows = [(n * 37 % 2003,) for n in range(2003)]
    check(spark, rows, "tie long", ["tie"], lambda r: r[0])


def test_a_value_with_a_third_of_the_rows_is_cut_along_the_other_columns(spark):
    rnd = random.Random(1)
    rows = [(7 if n % 3 == 0 else rnd.randrange(100), rnd.randrange(9), n) for n in range(3000)]
    check(spark, rows, "a long, b int, tie long", ["a", "b", "tie"], lambda r: r)


def test_a_third_null(spark):
    rows = [(None if n % 3 == 0 else n % 11, n) for n in range(2000)]
    check(spark, rows, "a long, tie long", ["a", "tie"], lambda r: (nulls_first(r[0]), r[1]))


def test_strings_with_a_hot_value(spark):
    rows = [("same" if n % 3 == 0 else f"k{n % 50}", n) for n in range(2000)]
    check(spark, rows, "a string, tie long", ["a", "tie"], lambda r: r)


def test_texts_around_a_common_beginning(spark):
    """Few texts lie before and after the beginning that the sampled ones share."""
    rnd = random.Random(9)
    made = [f"https://x.org/{'é' if n % 2 else 'z'}{rnd.randrange(10**6)}" for n in range(1995)]
    rows = list(zip([*made, "", "https", "https://y", "zzz", None], range(2000)))
    items = spark.createDataFrame(rows, "a string, tie long")
    assert o.cut_points(items, ["a", "tie"], 50).prefix.startswith("https://x.org/")
    check(spark, rows, "a string, tie long", ["a", "tie"], lambda r: (r[0] is not None, (r[0] or "").encode(), r[1]))


def test_long_values_that_share_a_double(spark):
    base = 1 << 60
    rows = [(base + n // 4, n) for n in range(2000)]
    check(spark, rows, "a long, tie long", ["a", "tie"], lambda r: r)


def test_odd_doubles(spark):
    rnd = random.Random(3)
    odd = [math.nan, math.inf, -math.inf, 0.0, -0.0, 1.5]
    rows = [(odd[n % 6] if n % 2 else rnd.uniform(-5, 5), n) for n in range(2400)]

    def key(row):
        value = row[0] + 0.0
        return (1, 0.0, row[1]) if math.isnan(value) else (0, value, row[1])

    check(spark, rows, "a double, tie long", ["a", "tie"], key, bound=9)


def test_three_columns_of_few_values(spark):
    """Crowded at the first column, again at the second, and cut by the third."""
    rnd = random.Random(11)
    day = dt.date(2024, 1, 1)
    rows = [(day + dt.timedelta(days=n % 2), rnd.choice([None, 1, 1, 2, 90]), n) for n in range(3000)]
    items = spark.createDataFrame(rows, "a date, b int, tie long")
    cuts = o.cut_points(items, ["a", "b", "tie"], 50)
    assert cuts.deeper and cuts.deeper.deeper and not cuts.points
    check(spark, rows, "a date, b int, tie long", ["a", "b", "tie"], lambda r: (r[0], nulls_first(r[1]), r[2]))


def test_values_beyond_the_sample(spark):
    """The second column has values far outside of what a sample is likely to show."""
    rows = [(n % 2, [-(1 << 62), 1 << 62][n % 4 // 2] if n % 500 < 4 else n % 7, n) for n in range(3000)]
    check(spark, rows, "a int, b long, tie long", ["a", "b", "tie"], lambda r: r)


def test_text_behind_a_crowded_number(spark):
    rows = [(n % 2, f"k{n % 3}" if n % 5 else None, n) for n in range(2000)]
    schema = "a int, `b c` string, tie long"
    check(spark, rows, schema, ["a", "b c", "tie"], lambda r: (r[0], r[1] is not None, r[1] or "", r[2]))


def test_random_tables_against_a_plain_sort(spark):
    rnd = random.Random(21)
    choices = {
        "int": lambda: rnd.choice([None, 0, 5, rnd.randrange(-50, 50)]),
        "double": lambda: rnd.choice([None, -0.0, 0.0, 2.5, math.inf, -math.inf, rnd.uniform(-9, 9)]),
        "string": lambda: rnd.choice([None, "", "ab", "abc", f"ab{rnd.randrange(99)}"]),
        "long": lambda: rnd.choice([1 << 60, (1 << 60) + 1, rnd.randrange(20), None]),
    }
    for kinds in (("int", "double"), ("string", "int"), ("double", "long"), ("long", "string"), ("int", "int")):
        rows = [(*(choices[kind]() for kind in kinds), n) for n in range(1500)]
        schema = f"a {kinds[0]}, b {kinds[1]}, tie long"

        def key(row):
            return tuple((x is not None, x if x is not None else 0) for x in row)

        check(spark, rows, schema, ["a", "b", "tie"], key, bound=9)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_crowded_microseconds(spark, kind):
    """Points must keep their microseconds, or they are out of order with the columns behind."""
    rnd = random.Random(5)
    start = dt.datetime(2024, 1, 1)
    rows = [(start + dt.timedelta(microseconds=rnd.randrange(20)), rnd.random() < 0.5, n) for n in range(1500)]
    check(spark, rows, f"a {kind}, b boolean, tie long", ["a", "b", "tie"], lambda r: r)


def test_timestamps_within_one_minute(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [(start + dt.timedelta(milliseconds=n * 7919 % 50_000), n) for n in range(1500)]
    check(spark, rows, "a timestamp_ntz, tie long", ["a", "tie"], lambda r: r)


@pytest.mark.parametrize(
    "kind, make",
    [
        ("date", lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n % 40)),
        ("decimal(12,2)", lambda n: Decimal(n % 300) / 4),
        ("timestamp", lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=n % 500)),
    ],
)
def test_other_kinds(spark, kind, make):
    rows = [(make(n), n) for n in range(1500)]
    check(spark, rows, f"a {kind}, tie long", ["a", "tie"], lambda r: r)


def test_numbers_do_not_depend_on_partitions_or_buckets(spark, events):
    want = None
    for parts, size in ((1, 100), (7, 333), (3, 10_000_000)):
        items = events.select("user_id", "event_id").repartition(parts)
        got = sorted(o.number_rows(items, ["user_id", "event_id"], rows_per_bucket=size).collect())
        want = want or got
        assert got == want


def test_empty_and_start(spark):
    empty = spark.createDataFrame([], "tie long")
    assert o.number_rows(empty, "tie").collect() == []
    three = spark.createDataFrame([(3,), (1,), (2,)], "tie long")
    got = {row["tie"]: row["id"] for row in o.number_rows(three, "tie", start=10).collect()}
    assert got == {1: 10, 2: 11, 3: 12}


def test_one_shuffle_of_the_items(spark, events):
    plan = o.number_rows(events, "event_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "SinglePartition" not in plan


def test_alternate(spark):
    items = spark.range(1000).repartition(4)
    flags = {row["id"]: row["flag"] for row in o.alternate_ab(items, "id", rows_per_bucket=90).collect()}
    assert flags == {n: "AB"[n % 2] for n in range(1000)}


def test_data_rate(spark):
    start = dt.datetime(2024, 3, 31, 0, 30)
    rows = [(n, start + dt.timedelta(microseconds=n * n)) for n in range(1050)]
    items = spark.createDataFrame(rows, "id long, at timestamp_ntz").repartition(3)
    got = o.data_rate(items, "id", epoch_micros(items, "at"), 100, rows_per_bucket=64).collect()
    want = [
        Row(block=b, n=len(part), span_us=part[-1] ** 2 - part[0] ** 2)
        for b, part in ((b, range(b * 100, min(b * 100 + 100, 1050))) for b in range(11))
    ]
    assert sorted(got) == want


def test_epoch_micros_ignores_the_time_zone(spark):
    items = spark.createDataFrame([(dt.datetime(2024, 3, 31, 2, 30, 1, 250),)], "at timestamp_ntz")
    want = int((dt.datetime(2024, 3, 31, 2, 30, 1, 250) - dt.datetime(1970, 1, 1)) / dt.timedelta(microseconds=1))
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        assert items.select(epoch_micros(items, "at").alias("us")).first()["us"] == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_unique_id(spark):
    ids = o.unique_id(spark.range(1000, numPartitions=4).select(F.lit(1).alias("x")))
    assert ids.select("id").distinct().count() == 1000


def test_source_limit_is_a_top_k(spark, events):
    first = o.source_limit(events.select("event_id").repartition(5), 10, "event_id")
    assert [row[0] for row in first.collect()] == list(range(10))
    assert "TakeOrderedAndProject" in first._jdf.queryExecution().executedPlan().toString()
    assert o.source_limit(events, 10).count() == 10
