from helpers import silver_rows
from pyspark.sql import functions as F

from loanlens import contract
from loanlens.operators import joins, quality, star
from loanlens.plans import medallion
from loanlens.scratch import new_folder
from loanlens.sources import lake


def build(spark, silver):
    folder = new_folder(spark, "gold")
    rows = medallion.store_star(spark, silver, folder, silver_is_stored=False)
    return lake.read_star(spark, folder), rows


def test_star_of_silver_with_unknown_members(spark):
    silver = silver_rows(
        spark,
        {},
        {"loan_number": "L2", "country_code": "Unknown", "country": "Unknown"},
        {"loan_number": "L3", "project_id": "Unknown", "borrower": "Unknown"},
        {"loan_number": "L4", "end_of_period": "2025-01-01", "guarantor": "Newer"},
    )
    gold, rows = build(spark, silver)
    assert rows == {
        "dim_country": 2,
        "dim_project": 2,
        "dim_loan_type": 1,
        "dim_borrower": 2,
        "fact_loans": 4,
    }
    for table, df in gold.items():
        assert df.columns == contract.names(table)
        assert df.count() == rows[table]
    checks = joins.orphan_counts(gold["fact_loans"], gold).collect()
    assert all(r.orphans == 0 and r.missing == 0 for r in checks) and len(checks) == 4
    assert all(r.duplicated_keys == 0 for r in quality.uniqueness(gold).collect())
    assert all(r.violations == 0 for r in quality.required_violations(gold).collect())
    newest = gold["dim_country"].where("country_code = '01'").first()
    assert newest.guarantor == "Newer"
    total = gold["fact_loans"].agg(F.sum("original_principal_amount")).first()[0]
    assert float(total) == 400.0


def test_silver_skipped_nulls_still_find_their_member(spark):
    silver = silver_rows(
        spark, {"currency_of_commitment": None, "borrower": None}, {"loan_number": "L2"}
    )
    gold, _ = build(spark, silver)
    assert gold["dim_loan_type"].count() == 1  # the default equals the literal
    checks = joins.orphan_counts(gold["fact_loans"], gold).collect()
    assert all(r.missing == 0 for r in checks)


def test_absent_fact_column_is_a_typed_null(spark):
    silver = silver_rows(spark, {}).drop("loans_held")
    gold, _ = build(spark, silver)
    assert dict(gold["fact_loans"].dtypes)["loans_held"] == "decimal(18,2)"
    assert gold["fact_loans"].first().loans_held is None


def test_lookup_gives_the_same_by_broadcast_and_by_salted_shuffle(spark):
    facts = spark.range(9000).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 100 == 1, None)
        .when(F.col("id") % 50 == 2, "absent")
        .otherwise(F.concat(F.lit("k"), F.col("id") % 2500))
        .alias("key"),
    )
    dim = spark.range(2500).select(
        F.concat(F.lit("k"), "id").alias("key"), F.col("id").alias("value")
    ).unionByName(spark.createDataFrame([("hot", -1)], "key string, value bigint"))
    small = joins.lookup(facts, dim, ["key"])
    large = joins.lookup(facts, dim, ["key"], broadcast_bytes=0)
    # The missing key and one without lookup row are hot as well.
    assert {"hot", "absent", None} <= {r.key for r in joins.hot_keys(facts, ["key"]).collect()}
    as_rows = lambda df: sorted(tuple(r) for r in df.select("id", F.coalesce("value", F.lit(-9))).collect())
    assert as_rows(small) == as_rows(large) and large.count() == 9000


def test_orphans(spark):
    fact = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    dim = spark.createDataFrame([(1,)], "k int")
    assert joins.orphans(fact, dim, "k").collect() == [(2,)]


def test_unmatched_key_is_an_empty_group(spark):
    fact = spark.createDataFrame([(1, 5), (9, 7)], "country_key long, v int")
    dims = {"dim_country": spark.createDataFrame([(1, "A")], "country_key long, region string")}
    joined = joins.star_join(fact, dims, {"dim_country": ["region"]})
    assert {(r.region, r.v) for r in joined.collect()} == {("A", 5), (None, 7)}


def test_stored_tables_keep_their_declared_order(spark, tmp_path):
    fact = spark.range(1000).select(
        (F.col("id") % 7).alias("country_key"), F.lit(None).cast("date").alias("board_approval_date")
    )
    ordered = [r.country_key for r in lake.cluster(fact.repartition(5), "fact_loans").collect()]
    assert ordered == sorted(ordered)
    rows = [(i, f"C{i}", f"Land {i}", f"R{9 - i}", None, None) for i in range(9)]
    schema = contract.table_schema("dim_country")
    assert lake.write_gold(spark.createDataFrame(rows, schema), str(tmp_path), "dim_country") == 9
    regions = [r.region for r in lake.read_gold(spark, str(tmp_path), "dim_country").collect()]
    assert regions == [f"R{i}" for i in range(1, 10)]


def test_one_country_without_dates_is_cut_into_even_pieces(spark):
    rows = spark.range(40_000).select(
        F.col("id").alias("loan_fact_key"),
        F.when(F.col("id") % 4 > 0, 1).otherwise(F.col("id") % 50).cast("long").alias("country_key"),
        F.lit(None).cast("date").alias("board_approval_date"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = lake.cluster(rows, "fact_loans")
        sizes = [r["count"] for r in placed.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) > 1 and max(sizes) <= 2 * sum(sizes) / len(sizes)


def test_values_outside_the_declared_types_are_counted_not_fatal(spark):
    silver = silver_rows(spark, {"loan_number": "A"}, {"loan_number": "B"}).withColumns(
        {
            "cancelled_amount": F.when(F.col("loan_number") == "A", 1e20).otherwise(5.0),
            "interest_rate": F.when(F.col("loan_number") == "B", 123456.0).otherwise(1.0),
        }
    )
    dims = {t: star.build_dimension(silver, t) for t in star.DIMENSIONS}
    fact = {r.loan_number: r for r in star.build_fact(silver, dims).collect()}
    assert fact["A"].cancelled_amount is None and float(fact["B"].cancelled_amount) == 5.0
    lost = {r.column_name: r.cast_losses for r in star.fact_cast_losses(silver).collect()}
    assert {c: n for c, n in lost.items() if n} == {"cancelled_amount": 1, "interest_rate": 1}


def test_hot_country_is_split_over_files_and_small_ones_are_not(spark, tmp_path):
    changes = [{"loan_number": f"L{i}", "country_code": "HOT"} for i in range(400)]
    changes += [{"loan_number": f"S{i}", "country_code": f"C{i % 4}"} for i in range(40)]
    silver = silver_rows(spark, *changes)
    big = silver.crossJoin(spark.range(60).select("id")).withColumn(
        "loan_number", F.concat("loan_number", F.lit("-"), "id")
    ).drop("id")
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "20k")
    try:
        lake.write_silver(big, str(tmp_path / "silver"))
    finally:
        spark.conf.set(size, before)
    files = {d.name: len(list(d.glob("*.parquet"))) for d in (tmp_path / "silver").glob("*=*")}
    assert files["country_code=HOT"] > 2
    assert all(n <= 2 for name, n in files.items() if name != "country_code=HOT")
    assert lake.read_silver(spark, str(tmp_path / "silver")).count() == 440 * 60


def test_dimension_outgrowing_the_broadcast_limit(spark):
    """A third of all loans has one borrower, and no dimension may be broadcast."""
    changes = [
        {"loan_number": f"L{i}", "borrower": "HOT" if i % 3 == 0 else f"B{i}"} for i in range(600)
    ]
    silver = silver_rows(spark, *changes)
    gold, _ = build(spark, silver)
    dims = {t: gold[t] for t in star.DIMENSIONS}
    small, large = (star.build_fact(silver, dims, limit) for limit in (joins.BROADCAST_BYTES, 0))
    rows = lambda df: sorted((r.loan_number, r.borrower_key, r.country_key) for r in df.collect())
    assert rows(small) == rows(large)
