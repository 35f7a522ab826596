"""Report visuals as result tables.

``star`` maps the five table names to stored DataFrames.  The loan fact has one row
per loan, so loan counts need no distinct.  Totals are in billions except where a
measure says otherwise.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loanlens.functions import measures as m
from loanlens.operators.joins import star_join
from loanlens.operators.ranking import top_n

Star = Mapping[str, DataFrame]

# Alert limit of the rate card, target of the gauge, lengths of lists.
RATE_ALERT = 0.15
EFFICIENCY_TARGET = 0.90
TOP_COUNTRIES = 10
TOP_BORROWERS = 20

# Most loan types the matrix takes by itself.
MATRIX_COLUMNS = 100


def slice_star(
    star: Star,
    region: Sequence[str] | None = None,
    country: Sequence[str] | None = None,
    loan_status: Sequence[str] | None = None,
    loan_type: Sequence[str] | None = None,
    date_from: date | None = None,
    date_to: date | None = None,
) -> Star:
    """The star restricted by the report's slicers; a missing slicer keeps all.

    Dimension filters reach the fact as semi joins on the small filtered dimensions,
    date limits reach its scan.
    """
    country_dim, type_dim = star["dim_country"], star["dim_loan_type"]
    fact = star["fact_loans"]
    for column, values in (("region", region), ("country", country)):
        if values is not None:
            country_dim = country_dim.where(F.col(column).isin(list(values)))
    for column, values in (("loan_status", loan_status), ("loan_type", loan_type)):
        if values is not None:
            type_dim = type_dim.where(F.col(column).isin(list(values)))
    if country_dim is not star["dim_country"]:
        fact = fact.join(country_dim.select("country_key"), "country_key", "left_semi")
    if type_dim is not star["dim_loan_type"]:
        fact = fact.join(type_dim.select("loan_type_key"), "loan_type_key", "left_semi")
    approved = F.col("board_approval_date")
    if date_from is not None:
        fact = fact.where(approved >= F.lit(date_from))
    if date_to is not None:
        fact = fact.where(approved <= F.lit(date_to))
    return {
        **star,
        "fact_loans": fact,
        "dim_country": country_dim,
        "dim_loan_type": type_dim,
    }


def _by(star: Star, attributes: Mapping[str, Sequence[str]], *aggs: Column) -> DataFrame:
    """Measures grouped by dimension attributes.

    The joins are map-side and the grouping combines before its only shuffle.
    """
    groups = [c for columns in attributes.values() for c in columns]
    return star_join(star["fact_loans"], star, attributes).groupBy(*groups).agg(*aggs)


def _loans() -> Column:
    return m.loan_count(one_row_per_loan=True).alias("loan_count")


def total_loan_amount_card(star: Star) -> DataFrame:
    return star["fact_loans"].agg(m.total_loan_amount().alias("total_loan_amount"))


def total_cancelled_card(star: Star) -> DataFrame:
    return star["fact_loans"].agg(
        m.total_cancelled_amount().alias("total_cancelled_amount")
    )


def cancellation_rate_card(star: Star) -> DataFrame:
    """The rate, and whether it is above the alert limit."""
    rate = star["fact_loans"].agg(m.cancellation_rate().alias("cancellation_rate"))
    alert = F.coalesce(F.col("cancellation_rate") > RATE_ALERT, F.lit(False))
    return rate.withColumn("is_alert", alert)


def loan_count_card(star: Star) -> DataFrame:
    return star["fact_loans"].agg(_loans())


def loan_map(star: Star) -> DataFrame:
    return _by(
        star,
        {"dim_country": ["country"]},
        m.total_loan_amount().alias("total_loan_amount"),
        m.cancellation_rate().alias("cancellation_rate"),
        _loans(),
    )


def yearly_trend(star: Star) -> DataFrame:
    year = F.year("board_approval_date").alias("approval_year")
    return (
        star["fact_loans"]
        .groupBy(year)
        .agg(
            m.total_loan_amount().alias("total_loan_amount"),
            m.total_cancelled_amount().alias("total_cancelled_amount"),
        )
    )


def _cancelled() -> Column:
    return F.sum("cancelled_amount").alias("cancelled_amount")


def cancellations_by_region(star: Star) -> DataFrame:
    return _by(star, {"dim_country": ["region"]}, _cancelled())


def top_countries_by_cancellation(star: Star) -> DataFrame:
    totals = _by(star, {"dim_country": ["country"]}, _cancelled())
    return top_n(totals, TOP_COUNTRIES, "cancelled_amount", ["country"])


def rate_scatter(star: Star) -> DataFrame:
    return _by(
        star,
        {"dim_country": ["region"]},
        m.avg_interest_rate().alias("avg_interest_rate"),
        _cancelled(),
        _loans(),
    )


def region_type_rates(star: Star) -> DataFrame:
    """Long form of the region by loan type matrix."""
    return _by(
        star,
        {"dim_country": ["region"], "dim_loan_type": ["loan_type"]},
        m.regional_cancellation_rate().alias("cancellation_rate"),
    )


def region_type_matrix(star: Star, loan_types: Sequence[str] | None = None) -> DataFrame:
    """One row per region, one rate column per loan type.

    Without given types they are read from the loan-type dimension; more than a report
    can show are an error, then ``region_type_rates`` has them as rows.
    """
    if loan_types is None:
        found = star["dim_loan_type"].select("loan_type").distinct().orderBy("loan_type")
        loan_types = [row["loan_type"] for row in found.limit(MATRIX_COLUMNS + 1).collect()]
        if len(loan_types) > MATRIX_COLUMNS:
            raise ValueError(f"more than {MATRIX_COLUMNS} loan types: name those to show")
    rates = region_type_rates(star)
    return (
        rates.groupBy("region")
        .pivot("loan_type", list(loan_types))
        .agg(F.first("cancellation_rate"))
    )


def efficiency_gauge(star: Star) -> DataFrame:
    value = star["fact_loans"].agg(
        m.disbursement_efficiency().alias("disbursement_efficiency")
    )
    met = F.coalesce(F.col("disbursement_efficiency") >= F.col("target"), F.lit(False))
    return value.withColumn("target", F.lit(EFFICIENCY_TARGET)).withColumn("met", met)


def processing_days_card(star: Star) -> DataFrame:
    return star["fact_loans"].agg(m.avg_processing_days().alias("avg_processing_days"))


def repayment_years_card(star: Star) -> DataFrame:
    return star["fact_loans"].agg(m.avg_repayment_years().alias("avg_repayment_years"))


def amount_funnel(star: Star) -> DataFrame:
    """Stages in order; the due amount is brought to billions like the others."""
    stages = [
        ("Total Loan Amount", m.total_loan_amount()),
        ("Total Disbursed Amount", m.total_disbursed_amount()),
        ("Total Repaid", m.total_repaid()),
        ("Total Due", m.total_due() * m.MILLION / m.BILLION),
    ]
    wide = star["fact_loans"].agg(
        F.array(
            *[
                F.struct(
                    F.lit(i).alias("stage_order"),
                    F.lit(name).alias("stage"),
                    value.alias("amount_billions"),
                )
                for i, (name, value) in enumerate(stages, 1)
            ]
        ).alias("stages")
    )
    return wide.select(F.inline("stages"))


def processing_days_by_region(star: Star) -> DataFrame:
    return _by(
        star,
        {"dim_country": ["region"]},
        m.avg_processing_days().alias("avg_processing_days"),
    )


def top_borrowers(star: Star) -> DataFrame:
    """Twenty largest borrowers per country with four measures.

    The fact is grouped by keys, and names of borrowers are fetched for the twenty
    survivors only.  Keys follow the order of names, so a tie on the amount is cut by
    name.
    """
    by_key = (
        star["fact_loans"]
        .groupBy("borrower_key", "country_key")
        .agg(
            F.sum("original_principal_amount").alias("principal"),
            F.sum("cancelled_amount").alias("cancelled"),
            _loans(),
        )
    )
    country = star["dim_country"].select("country_key", "country")
    totals = (
        by_key.join(country, "country_key", "left")
        .groupBy("borrower_key", "country")
        .agg(*[F.sum(c).alias(c) for c in ("principal", "cancelled", "loan_count")])
    )
    top = top_n(totals, TOP_BORROWERS, "principal", ["borrower_key", "country"])
    names = (
        star["dim_borrower"]
        .select("borrower_key", "borrower")
        .join(F.broadcast(top.select("borrower_key")), "borrower_key", "left_semi")
    )
    principal, cancelled = (F.col(c).cast("double") for c in ("principal", "cancelled"))
    return top.join(F.broadcast(names), "borrower_key", "left").select(
        "borrower",
        "country",
        (principal / m.BILLION).alias("total_loan_amount"),
        (cancelled / m.BILLION).alias("total_cancelled_amount"),
        F.when(F.col("principal") > 0, cancelled / principal).alias("cancellation_rate"),
        "loan_count",
    )


def loans_by_region(star: Star) -> DataFrame:
    """Amount and share of the whole, over the few rows of the grouped result."""
    totals = _by(
        star,
        {"dim_country": ["region"]},
        F.sum("original_principal_amount").alias("principal"),
    )
    principal = F.col("principal").cast("double")
    whole = F.sum("principal").over(Window.partitionBy()).cast("double")
    return totals.select(
        "region",
        (principal / m.BILLION).alias("total_loan_amount"),
        F.when(whole > 0, principal / whole).alias("share"),
    )


def portfolio_composition(star: Star) -> DataFrame:
    """Ten largest countries by loan amount, one row per country and component."""
    totals = _by(
        star,
        {"dim_country": ["country"]},
        F.sum("original_principal_amount").alias("principal"),
        m.total_disbursed_amount().alias("Total Disbursed Amount"),
        m.total_cancelled_amount().alias("Total Cancelled Amount"),
        (m.total_due() * m.MILLION / m.BILLION).alias("Total Due"),
    )
    top = top_n(totals, TOP_COUNTRIES, "principal", ["country"])
    parts = ["Total Disbursed Amount", "Total Cancelled Amount", "Total Due"]
    return top.unpivot(["country"], parts, "component", "amount_billions")


VISUALS: dict[str, Callable[[Star], DataFrame]] = {
    "total_loan_amount_card": total_loan_amount_card,
    "total_cancelled_card": total_cancelled_card,
    "cancellation_rate_card": cancellation_rate_card,
    "loan_count_card": loan_count_card,
    "loan_map": loan_map,
    "yearly_trend": yearly_trend,
    "cancellations_by_region": cancellations_by_region,
    "top_countries_by_cancellation": top_countries_by_cancellation,
    "rate_scatter": rate_scatter,
    "region_type_matrix": region_type_matrix,
    "efficiency_gauge": efficiency_gauge,
    "processing_days_card": processing_days_card,
    "repayment_years_card": repayment_years_card,
    "amount_funnel": amount_funnel,
    "processing_days_by_region": processing_days_by_region,
    "top_borrowers": top_borrowers,
    "loans_by_region": loans_by_region,
    "portfolio_composition": portfolio_composition,
}
