"""Named measures as tables: portfolio totals, by group, over time, ranked."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.functions import measures as m
from loanlens.operators.joins import star_join
from loanlens.operators.ranking import (
    dense_rank_by,
    joined_names,
    top_n_with_ties,
    year_over_year,
)
from loanlens.plans.dashboards import Star

TOP_NAMES = 3

# Size of a sketch of loan numbers: 2^12 buckets.
SKETCH_BITS = 12


def fact_measures(one_row_per_loan: bool = False, of: m.Rows = m.ROWS) -> dict[str, Column]:
    """All measures that aggregate the loan fact, by name."""
    return {
        "total_loan_amount": m.total_loan_amount(of),
        "total_cancelled_amount": m.total_cancelled_amount(of),
        "cancellation_rate": m.cancellation_rate(of),
        "total_disbursed_amount": m.total_disbursed_amount(of),
        "total_repaid": m.total_repaid(of),
        "total_due": m.total_due(of),
        "loan_count": m.loan_count(one_row_per_loan, of),
        "avg_cancellation_per_loan": m.avg_cancellation_per_loan(of),
        "high_risk_count": m.high_risk_count(one_row_per_loan, of),
        "regional_cancellation_rate": m.regional_cancellation_rate(of),
        "avg_processing_days": m.avg_processing_days(of),
        "avg_disbursement_period": m.avg_disbursement_period(of),
        "avg_repayment_years": m.avg_repayment_years(of),
        "disbursement_efficiency": m.disbursement_efficiency(of),
        "avg_interest_rate": m.avg_interest_rate(of),
        "weighted_avg_interest_rate": m.weighted_avg_interest_rate(of),
    }


def measure_table(
    df: DataFrame,
    measures: Sequence[str],
    by: Sequence[str] = (),
    one_row_per_loan: bool = False,
) -> DataFrame:
    """The named measures per group.

    Where loans repeat, their rows are summed per loan first, then per group: two
    aggregations of which the second sees a loan once, instead of one that carries a copy
    of every row for each count of distinct loans.
    """
    if one_row_per_loan:
        known, rows = fact_measures(True), df
    else:
        known, rows = fact_measures(of=m.PER_LOAN), m.per_loan(df, by)
    return rows.groupBy(*by).agg(*[known[name].alias(name) for name in measures])


def loan_sketches(df: DataFrame, by: Sequence[str] = (), bits: int = SKETCH_BITS) -> DataFrame:
    """Per group a sketch of its loan numbers, for approximate counts that can be merged.

    A sketch has at most 2^bits bytes.  Stored per partition of a table, the count over
    any set of partitions takes their sketches only, not the rows, where distinct
    counts cannot be added up.
    """
    sketch = F.hll_sketch_agg("loan_number", F.lit(bits))
    return df.groupBy(*by).agg(sketch.alias("loans_sketch"))


def estimated_loans(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Approximate loan count per group, from sketches of the group's parts."""
    merged = F.hll_union_agg("loans_sketch")
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(merged).alias("loans"))


def sketch_error(bits: int = SKETCH_BITS) -> float:
    """Relative error that an estimate exceeds in fewer than 3 of 1000 cases."""
    return 3 * 1.04 / 2 ** (bits / 2)


def measure_texts(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The printed form of every measure that has one."""
    printed = [name for name in fact_measures() if name in m.TEXT]
    table = measure_table(df, printed, by, one_row_per_loan=True)
    return table.select(*by, *[m.as_text(name) for name in printed])


def dimension_counts(star: Star) -> DataFrame:
    """Countries and projects, counted in their dimensions: one row each."""
    countries = star["dim_country"].agg(m.country_count().alias("members"))
    projects = star["dim_project"].agg(m.project_count().alias("members"))
    return countries.select(F.lit("country").alias("dimension"), "members").unionByName(
        projects.select(F.lit("project").alias("dimension"), "members")
    )


def yoy_cancellation(fact: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Cancelled amount by approval year, the year before, and the change."""
    return year_over_year(
        fact, "board_approval_date", F.sum("cancelled_amount"), "cancelled_amount", by
    ).withColumnRenamed("change", "yoy_cancellation_change")


def country_totals(star: Star, column: str) -> DataFrame:
    with_country = star_join(
        star["fact_loans"], star, {"dim_country": ["country"]}
    )
    return with_country.groupBy("country").agg(F.sum(column).alias("total"))


def top_countries(star: Star) -> DataFrame:
    """One row: the three largest borrowing countries, more if the third place ties."""
    ranked = top_n_with_ties(
        country_totals(star, "original_principal_amount"), TOP_NAMES, "total"
    )
    return ranked.agg(joined_names("country", "total").alias("top_countries"))


def cancellation_ranks(star: Star) -> DataFrame:
    """Dense rank of every country by cancelled amount, 1 the largest.

    The ranking sees one row per country, after the aggregation.
    """
    totals = country_totals(star, "cancelled_amount")
    return dense_rank_by(totals, "total", "cancellation_rank")
