"""Business questions that no single measure answers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.functions import measures as m
from loanlens.functions.scalars import ratio, year_boundaries
from loanlens.operators.joins import star_join
from loanlens.operators.ranking import year_over_year
from loanlens.plans.dashboards import Star


def _with_country(star: Star, *attributes: str) -> DataFrame:
    return star_join(star["fact_loans"], star, {"dim_country": list(attributes)})


def duration_correlations(star: Star) -> DataFrame:
    """Per region: do slow processing or long repayment go with cancellation?

    Missing where one of the two does not vary.
    """
    share = ratio("cancelled_amount", "original_principal_amount")
    days = F.date_diff("agreement_signing_date", "board_approval_date").cast("double")
    years = year_boundaries("last_repayment_date", "first_repayment_date").cast("double")
    return (
        _with_country(star, "region")
        .groupBy("region")
        .agg(
            F.corr(days, share).alias("processing_correlation"),
            F.corr(years, share).alias("repayment_correlation"),
        )
    )


def declining_borrowers(star: Star) -> DataFrame:
    """Country-years that borrowed less than the year before."""
    yearly = year_over_year(
        _with_country(star, "country"),
        "board_approval_date",
        F.sum("original_principal_amount"),
        "principal",
        ["country"],
    )
    return yearly.where(F.col("change") < 0)


def cancellation_rate_by_borrower(star: Star) -> DataFrame:
    """Cancellation rate by region, loan type and borrower.

    The fact is summed by its keys first, so the join with the borrowers, which may
    be many, moves sums and not loans, and a dominant borrower is a few rows.
    """
    amounts = ["cancelled_amount", "original_principal_amount"]
    sums = [F.sum(c).alias(c) for c in amounts]
    keys = ["country_key", "loan_type_key", "borrower_key"]
    by_key = star["fact_loans"].groupBy(*keys).agg(*sums)
    attributes = {
        "dim_country": ["region"],
        "dim_loan_type": ["loan_type"],
        "dim_borrower": ["borrower"],
    }
    rate = m.regional_cancellation_rate().alias("cancellation_rate")
    named = star_join(by_key, star, attributes)
    return named.groupBy("region", "loan_type", "borrower").agg(rate)


def repayment_years_by_country(star: Star) -> DataFrame:
    years = m.avg_repayment_years().alias("avg_repayment_years")
    return _with_country(star, "country").groupBy("country").agg(years)
