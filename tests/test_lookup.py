import pytest
from pyspark.sql import functions as F

from millrace.operators.lookup import fits_broadcast, lookup


@pytest.fixture()
def items(spark):
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, None).otherwise(F.col("id") % 50)
    return spark.range(3000, numPartitions=4).select("id", key.cast("long").alias("key"))


@pytest.fixture()
def service(spark):
    return spark.range(40).select(F.col("id").cast("int").alias("code"), F.concat(F.lit("n"), "id").alias("name"))


def wanted(items):
    return {
        row["id"]: f"n{row['key']}" if row["key"] is not None and row["key"] < 40 else None for row in items.collect()
    }


def found(items):
    return {row["id"]: row["name"] for row in items.collect()}


def plan(items):
    return items._jdf.queryExecution().optimizedPlan().toString()


def test_small_service(items, service):
    got = lookup(items, service, "key", "code", ["name"])
    assert found(got) == wanted(items)
    assert got.count() == 3000
    assert plan(got).count("Join") == 1


@pytest.mark.parametrize("limits", [{"max_rows": 10}, {"max_bytes": 10}])
@pytest.mark.parametrize("hot_rows", [100, 10_000])
def test_large_service_with_hot_and_null_keys(items, service, limits, hot_rows):
    got = lookup(items, service, "key", "code", ["name"], hot_rows=hot_rows, **limits)
    assert found(got) == wanted(items)
    assert got.count() == 3000
    # Without hot keys only the join by key is left. With them there are two joins with the service,
    # and three with the list of hot keys, which mark the items and cut the service down.
    assert plan(got).count("Join") == (5 if hot_rows == 100 else 1)


def test_size_is_measured(spark):
    wide = spark.range(100).select(F.repeat(F.lit("x"), 1000).alias("x"))
    assert fits_broadcast(wide)
    assert not fits_broadcast(wide, max_bytes=50_000)
    assert not fits_broadcast(wide, max_rows=99)
    assert fits_broadcast(wide.limit(0))


def test_missing_column(items, service):
    with pytest.raises(KeyError):
        lookup(items, service, "key", "code", ["nothing"])


def test_a_service_with_two_rows_of_a_key_is_refused(items, service):
    for limits in ({}, {"max_rows": 10}):
        with pytest.raises(ValueError, match="rows under key"):
            lookup(items, service.union(service.limit(1)), "key", "code", ["name"], **limits)
