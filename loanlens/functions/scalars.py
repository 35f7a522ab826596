"""Scalar column expressions shared by batch, stream and model code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Amounts in USD above which a cancellation is reported and graded.
HIGH_RISK_AMOUNT = 1_000_000
HIGH_AMOUNT = 5_000_000
CRITICAL_AMOUNT = 10_000_000

# Fixed value: share of the principal above which a cancellation is significant.
SIGNIFICANT_SHARE = 0.10


def _as_column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def ratio(part: str | Column, whole: str | Column) -> Column:
    """``part / whole``; 0 unless ``whole`` is positive."""
    part, whole = (_as_column(c).cast("double") for c in (part, whole))
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def divide(part: Column, whole: Column, otherwise: float | None = None) -> Column:
    """``part / whole`` as double, or ``otherwise`` when ``whole`` is 0 or NULL."""
    part, whole = part.cast("double"), whole.cast("double")
    return F.when(whole.isNull() | (whole == 0), F.lit(otherwise)).otherwise(part / whole)


def cancellation_percent() -> Column:
    """Cancelled share of the principal in percent with two decimals."""
    share = F.col("cancelled_amount").cast("double") / F.col(
        "original_principal_amount"
    ).cast("double")
    return F.when(
        F.col("original_principal_amount") > 0, F.round(share * 100, 2)
    ).otherwise(F.lit(0.0))


def risk_level() -> Column:
    """Grade of a reported cancellation; an amount on a limit has the lower grade."""
    amount = F.col("cancelled_amount")
    return (
        F.when(amount > CRITICAL_AMOUNT, "CRITICAL")
        .when(amount > HIGH_AMOUNT, "HIGH")
        .otherwise("ELEVATED")
    )


def days_or_zero(later: str | Column, earlier: str | Column) -> Column:
    """Days between two dates as double; 0 when either is missing."""
    return F.coalesce(F.date_diff(later, earlier), F.lit(0)).cast("double")


def log_amount(amount: str) -> Column:
    """``log(1 + amount)``; 0 unless the amount is positive."""
    value = F.col(amount).cast("double")
    return F.when(value > 0, F.log1p(value)).otherwise(F.lit(0.0))


def flag(condition: Column) -> Column:
    """1.0 where the condition holds, else 0.0 (also for an unknown condition)."""
    return F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0))


def year_boundaries(later: str, earlier: str) -> Column:
    """New Year's days between two dates (not elapsed years)."""
    return F.year(later) - F.year(earlier)
