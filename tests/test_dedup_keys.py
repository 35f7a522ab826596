import random

import pytest
from helpers import silver_rows
from pyspark.sql import functions as F

from loanlens.operators import dedup, keys


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_ties_have_one_survivor_however_partitioned(spark, partitions):
    changes = [{"cancelled_amount": float(i), "guarantor": g} for i in range(5) for g in "ab"]
    random.Random(partitions).shuffle(changes)
    df = silver_rows(spark, *changes).repartition(partitions)
    (row,) = dedup.latest_loans(df).collect()
    assert (row.cancelled_amount, row.guarantor) == (4.0, "b")


def test_hot_loan_with_a_third_of_all_rows(spark):
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.col("id").cast("string")).alias("loan"),
        (F.col("id") % 1000).alias("period"),
        F.col("id").alias("value"),
    )
    latest = dedup.latest_per_key(rows, ["loan"], ["period"])
    assert latest.count() == 20_001
    hot = latest.where("loan = 'HOT'").first()
    best = max((i % 1000, i) for i in range(0, 30_000, 3))
    assert (hot.period, hot.value) == best


def test_latest_attributes_prefers_a_known_period(spark):
    df = spark.createDataFrame(
        [("k", "old", "2020-01-01"), ("k", "new", "2021-01-01"), ("k", "none", None)],
        "key string, name string, period string",
    )
    assert dedup.latest_attributes(df, ["key"], ["name"], "period").collect() == [("k", "new")]


def test_exact_duplicates(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a")], "a int, b string")
    assert dedup.drop_exact_duplicates(df).count() == 2
    assert dedup.exact_duplicate_count(df).first().exact_duplicates == 1
    assert dedup.exact_duplicate_count(df.limit(0)).first().exact_duplicates == 0


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_dense_key_is_the_position_in_order(spark, partitions):
    values = [f"v{i * 7919 % 10007}" for i in range(1500)]
    df = spark.createDataFrame([(v,) for v in values], "v string").repartition(partitions)
    keyed = keys.dense_key(df, ["v"], "k")
    expected = {v: i for i, v in enumerate(sorted(values))}
    assert {r.v: r.k for r in keyed.collect()} == expected
    # Later narrow steps must not move the keys.
    assert {r.v: r.k for r in keyed.coalesce(1).collect()} == expected
    assert {r.v: r.k for r in keyed.where("k >= 700").collect()} == {
        v: k for v, k in expected.items() if k >= 700
    }


def test_dense_key_of_nothing(spark):
    assert keys.dense_key(spark.range(0), ["id"], "k").count() == 0


def test_attached_key_covers_a_missing_value(spark):
    df = spark.createDataFrame([("b", 1), (None, 2), ("a", 3)], "v string, n int")
    keyed = keys.attach_dense_key(df, "v", "k")
    assert {(r.v, r.n, r.k) for r in keyed.collect()} == {(None, 2, 0), ("a", 3, 1), ("b", 1, 2)}


def test_copies_of_wide_rows_are_counted_from_hashes_first(spark):
    rows = [("a", None, 1.0), (None, "a", 1.0), ("a", None, 1.0), (None, None, None), (None, None, None), (None, None, None)]
    rows += [("z", "0", 0.0), ("z", "0", -0.0), ("n", "n", float("nan")), ("n", "n", float("nan")), ("b", "b", 2.0)]
    df = spark.createDataFrame(rows, "x string, y string, v double").repartition(3)
    wanted = dedup.exact_duplicate_count(df).first().exact_duplicates
    for most in (10, 0):
        found = dedup.exact_duplicates_of_wide_rows(df, most)
        assert found.first().exact_duplicates == wanted == 5 and found.columns == ["exact_duplicates"]
    alike = dedup.exact_duplicates_of_wide_rows(df.distinct())  # a, null and null, a share a hash
    assert alike.first().exact_duplicates == 0
    once = dedup.exact_duplicates_of_wide_rows(df.where("x in ('b', 'a')").distinct())
    assert once.first().exact_duplicates == 0
    text = once._jdf.queryExecution().optimizedPlan().toString()
    assert "Scan" not in text and "RDD" not in text  # no row was grouped by all columns
    assert dedup.exact_duplicates_of_wide_rows(df.limit(0)).first().exact_duplicates == 0
