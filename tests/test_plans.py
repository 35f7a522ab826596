"""What the physical plans must look like."""

import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from loanlens.catalog import tables
from loanlens.operators import cleanse, dedup, joins, quality, ranking
from loanlens.operators.star import build_fact
from loanlens.plans import dashboards, kpis
from loanlens.sources import lake
from loanlens.sources.statements import latest_statements, statements

SF = "/root/testdata/sf0.001"


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture(scope="module")
def star(spark):
    return tables.star(spark, SF)


def test_filters_and_columns_reach_the_fact_scan(star):
    chosen = star["fact_loans"].where("country_key = 3").agg(F.sum("loans_held"))
    text = plan(chosen)
    assert "EqualTo(country_key,3)" in text
    assert "ReadSchema: struct<country_key:bigint,loans_held:decimal(18,2)>" in text


def test_country_filter_prunes_silver_partitions(spark):
    tables.bronze_silver(spark, SF)
    silver = tables.bronze_silver(spark, SF).where("country_code = 'C07'")
    text = plan(silver.agg(F.count("loan_number")))
    assert "PartitionFilters" in text and "country_code" in text.split("PartitionFilters")[1][:120]


def test_star_joins_are_map_side_and_group_before_the_shuffle(star):
    text = plan(dashboards.loan_map(star))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert "partial_count" in text and text.count("hashpartitioning") == 1


def test_latest_snapshot_cuts_groups_before_the_shuffle(spark):
    text = plan(dedup.latest_loans(statements(spark, SF)))
    head = text.split("\n\n")[0]
    assert head.count("WindowGroupLimit") == 2
    first, last = head.rfind("WindowGroupLimit"), head.find("WindowGroupLimit")
    assert last < head.find("Exchange", last) < first


def test_rank_cuts_partitions_before_they_meet(star):
    totals = kpis.country_totals(star, "original_principal_amount")
    text = plan(ranking.top_n_with_ties(totals, 3, "total"))
    assert "TakeOrderedAndProject" in text and "BroadcastHashJoin" in text


def test_top_n_is_a_bounded_heap(star):
    assert "TakeOrderedAndProject" in plan(dashboards.top_countries_by_cancellation(star))


def test_loan_counts_on_the_fact_need_no_distinct(star):
    text = plan(kpis.measure_table(star["fact_loans"], ["loan_count", "high_risk_count"], (), True))
    assert "distinct" not in text.lower() and "Expand" not in text


def test_loan_counts_over_statements_copy_no_row(spark):
    rows = statements(spark, SF)
    text = plan(kpis.measure_table(rows, list(kpis.fact_measures()), ["loan_status"]))
    assert "Expand" not in text and "distinct" not in text.lower()
    assert text.split("\n\n")[0].count("HashAggregate") == 4


def test_key_checks_read_the_fact_once(star):
    checks = (joins.orphan_counts(star["fact_loans"], star), quality.uniqueness(star))
    for check in checks:
        assert plan(check).split("\n\n")[0].count("Scan parquet") <= len(star)
        assert plan(check).count("gold") and plan(check).count("/fact_loans]") == 1


def test_numbers_are_tested_by_one_cast(spark):
    text = plan(cleanse.cast_numbers(tables.messy_rows(spark, SF).select("interest_rate", "loans_held")))
    assert "RLIKE" not in text and text.count("decimal(8,4)") == text.count("decimal(18,2)") == 1


def test_large_lookups_shuffle(star):
    fact = star["fact_loans"].drop("country_key")
    fact = fact.withColumn("country_key", F.col("borrower_key") % 25)
    large = joins.lookup(fact, star["dim_country"].select("country_key", "region"), ["country_key"], 0)
    text = plan(large)
    assert "Union" in text and "_salt" not in text


def test_fact_lookups_run_once(spark, star):
    silver = tables.silver(spark, SF)
    text = plan(build_fact(silver, star))
    head = text.split("\n\n")[0]
    assert head.count("Join") == 6  # four lookups, the key and its offsets


def test_no_plan_has_a_cross_product(spark, star):
    for name, visual in dashboards.VISUALS.items():
        text = plan(visual(star))
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name
    assert "NestedLoop" not in plan(latest_statements(spark, SF))


def test_silver_write_is_rebalanced(spark):
    df = tables.silver(spark, SF).hint("rebalance", "country_code")
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(df)
