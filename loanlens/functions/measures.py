"""Portfolio measures: one aggregate column each, for use inside ``agg``.

The filter context of a measure is whatever the DataFrame was filtered and grouped
by.  Each measure returns a number; ``TEXT`` holds the printed form of those that
have one.  A measure is made of sums and counts, which come from the rows themselves, or
from ``per_loan`` sums of them: then each loan is one row, and counting loans needs no
distinct, which would copy every row per count.  On a table with one row per loan pass
``one_row_per_loan=True`` to the loan counts instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.functions import formats
from loanlens.functions.scalars import HIGH_RISK_AMOUNT, divide, year_boundaries

BILLION = 1_000_000_000
MILLION = 1_000_000

# What is summed or counted per row, where it is not a column of its own.
_VALUES = {
    "processing_days": lambda: F.date_diff("agreement_signing_date", "board_approval_date"),
    "disbursement_days": lambda: F.date_diff("last_disbursement_date", "effective_date_most_recent"),
    "repayment_years": lambda: year_boundaries("last_repayment_date", "first_repayment_date"),
    "weighted_rate": lambda: F.col("interest_rate") * F.col("original_principal_amount"),
}
_SUMMED = [
    "original_principal_amount",
    "cancelled_amount",
    "disbursed_amount",
    "repaid_to_ibrd",
    "due_to_ibrd",
    "interest_rate",
    *_VALUES,
]
_RISKY = "_risky"


def _value(name: str) -> Column:
    return _VALUES[name]() if name in _VALUES else F.col(name)


class Rows:
    """Sums and counts over the rows themselves."""

    def total(self, name: str) -> Column:
        return F.sum(_value(name))

    def count(self, name: str) -> Column:
        return F.count(_value(name))

    def mean(self, name: str) -> Column:
        return F.avg(_value(name))

    def loans(self, one_row_per_loan: bool) -> Column:
        return F.count("loan_number") if one_row_per_loan else F.count_distinct("loan_number")

    def risky_loans(self, one_row_per_loan: bool) -> Column:
        risky = F.when(F.col("cancelled_amount") > HIGH_RISK_AMOUNT, F.col("loan_number"))
        return F.count(risky) if one_row_per_loan else F.count_distinct(risky)


class PerLoan(Rows):
    """The same over the rows of ``per_loan``."""

    def total(self, name: str) -> Column:
        return F.sum(f"_{name}_total")

    def count(self, name: str) -> Column:
        return F.coalesce(F.sum(f"_{name}_count"), F.lit(0))

    def mean(self, name: str) -> Column:
        rows = self.count(name)
        return F.when(rows > 0, self.total(name).cast("double") / rows)

    def loans(self, one_row_per_loan: bool) -> Column:
        return F.count("loan_number")

    def risky_loans(self, one_row_per_loan: bool) -> Column:
        return F.count(F.when(F.col(_RISKY), F.col("loan_number")))


ROWS, PER_LOAN = Rows(), PerLoan()


def per_loan(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per group and loan with what any measure needs of the loan's rows.

    A loan with many rows is summed before the shuffle.  Sums no measure asks for are
    not computed.
    """
    known = [n for n in _SUMMED if n in _VALUES or n in df.columns]
    sums = [F.sum(_value(n)).alias(f"_{n}_total") for n in known]
    counts = [F.count(_value(n)).alias(f"_{n}_count") for n in known]
    risky = F.max(F.col("cancelled_amount") > HIGH_RISK_AMOUNT).alias(_RISKY)
    return df.groupBy(*by, "loan_number").agg(*sums, *counts, risky)


def _scaled(total: Column, unit: int) -> Column:
    return F.coalesce(total.cast("double") / unit, F.lit(0.0))


def _positive_ratio(part: Column, whole: Column) -> Column:
    """Share that is not available unless the whole is positive."""
    return F.when(whole > 0, part.cast("double") / whole.cast("double"))


def total_loan_amount(of: Rows = ROWS) -> Column:
    return _scaled(of.total("original_principal_amount"), BILLION)


def total_cancelled_amount(of: Rows = ROWS) -> Column:
    return _scaled(of.total("cancelled_amount"), BILLION)


def cancellation_rate(of: Rows = ROWS) -> Column:
    return _positive_ratio(
        of.total("cancelled_amount"), of.total("original_principal_amount")
    )


def total_disbursed_amount(of: Rows = ROWS) -> Column:
    return _scaled(of.total("disbursed_amount"), BILLION)


def total_repaid(of: Rows = ROWS) -> Column:
    return _scaled(of.total("repaid_to_ibrd"), BILLION)


def total_due(of: Rows = ROWS) -> Column:
    """In millions, unlike the other totals."""
    return _scaled(of.total("due_to_ibrd"), MILLION)


def loan_count(one_row_per_loan: bool = False, of: Rows = ROWS) -> Column:
    """Distinct loans of any status, although reports call them active."""
    return of.loans(one_row_per_loan)


def country_count() -> Column:
    """Over the country dimension."""
    return F.count_distinct("country_code")


def project_count() -> Column:
    """Over the project dimension."""
    return F.count_distinct("project_id")


def avg_cancellation_per_loan(of: Rows = ROWS) -> Column:
    """Loans without a cancellation count with 0."""
    return F.coalesce(
        divide(of.total("cancelled_amount"), of.count("cancelled_amount")), F.lit(0.0)
    )


def high_risk_count(one_row_per_loan: bool = False, of: Rows = ROWS) -> Column:
    return of.risky_loans(one_row_per_loan)


def regional_cancellation_rate(of: Rows = ROWS) -> Column:
    """Like ``cancellation_rate`` but 0, not missing, without a principal."""
    return divide(of.total("cancelled_amount"), of.total("original_principal_amount"), 0.0)


def avg_processing_days(of: Rows = ROWS) -> Column:
    """Board approval to signing, over loans that have both dates."""
    return of.mean("processing_days")


def avg_disbursement_period(of: Rows = ROWS) -> Column:
    return of.mean("disbursement_days")


def avg_repayment_years(of: Rows = ROWS) -> Column:
    return of.mean("repayment_years")


def disbursement_efficiency(of: Rows = ROWS) -> Column:
    return _positive_ratio(
        of.total("disbursed_amount"), of.total("original_principal_amount")
    )


def avg_interest_rate(of: Rows = ROWS) -> Column:
    """In percent units."""
    return divide(of.total("interest_rate"), of.count("interest_rate"))


def weighted_avg_interest_rate(of: Rows = ROWS) -> Column:
    """In percent units, weighted by principal."""
    return _positive_ratio(of.total("weighted_rate"), of.total("original_principal_amount"))


# Printed form of a measure, as a function of its number.
TEXT = {
    "total_loan_amount": formats.billions,
    "total_cancelled_amount": formats.billions,
    "cancellation_rate": formats.percent,
    "total_disbursed_amount": formats.billions,
    "total_repaid": formats.billions,
    "total_due": formats.millions,
    "avg_cancellation_per_loan": formats.dollars,
    "yoy_cancellation_change": formats.signed_percent,
    "disbursement_efficiency": lambda share: formats.percent(share, 1),
    "avg_interest_rate": formats.rate_percent,
    "weighted_avg_interest_rate": formats.rate_percent,
}


def as_text(name: str) -> Column:
    """Printed form of the measure column ``name``."""
    return TEXT[name](F.col(name)).alias(f"{name}_text")
