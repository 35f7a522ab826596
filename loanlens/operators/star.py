"""Star schema: four dimensions and the loan fact."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens import contract
from loanlens.operators.cleanse import DIMENSION_DEFAULTS, fill_dimension
from loanlens.operators.dedup import latest_attributes
from loanlens.operators.joins import BROADCAST_BYTES, lookup
from loanlens.operators.keys import attach_dense_key, dense_key

DIMENSIONS = ["dim_country", "dim_project", "dim_loan_type", "dim_borrower"]


def dimension_rows(silver: DataFrame, table: str) -> DataFrame:
    """Rows of a dimension without surrogate key, one per natural key.

    Defaults are filled before the grouping, so a missing and a literal default key
    are one member, and the lookup from Silver finds it.
    """
    natural = contract.KEYS[table][1]
    attributes = [c for c in contract.names(table)[1:] if c not in natural]
    filled = fill_dimension(silver, table)
    if not attributes:
        return filled.select(*natural).distinct()
    return latest_attributes(filled, natural, attributes, "end_of_period")


def fill_natural_key(df: DataFrame, table: str) -> DataFrame:
    """The defaults a dimension's key columns got, for rows that look it up."""
    natural = contract.KEYS[table][1]
    return df.fillna({c: v for c, v in DIMENSION_DEFAULTS[table].items() if c in natural})


def build_dimension(silver: DataFrame, table: str) -> DataFrame:
    key, natural = contract.KEYS[table]
    keyed = dense_key(dimension_rows(silver, table), natural, key)
    return keyed.select(*contract.names(table))


def build_fact(
    silver: DataFrame,
    dims: Mapping[str, DataFrame],
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Loan fact with four foreign keys; ``dims`` must be stored tables.

    Every declared column is present: one that Silver lacks is a typed NULL, and a
    value outside its declared type is one too (``fact_cast_losses`` counts those).
    Loans are keyed first, from their numbers alone, so no lookup runs twice.
    """
    fact = attach_dense_key(silver, "loan_number", "loan_fact_key")
    for table in DIMENSIONS:
        key, natural = contract.KEYS[table]
        dim = dims[table].select(key, *natural)
        fact = fill_natural_key(fact, table)
        fact = lookup(fact, dim, natural, broadcast_bytes, fill_natural_key(silver, table))
    return fact.select(
        *[
            (F.col(f.name) if f.name in fact.columns else F.lit(None))
            .try_cast(f.type)
            .alias(f.name)
            for f in contract.WAREHOUSE["fact_loans"]
        ]
    )


def fact_cast_losses(silver: DataFrame) -> DataFrame:
    """One row per typed fact column: values that do not fit the declared type."""
    typed = {
        f.name: f.type
        for f in contract.WAREHOUSE["fact_loans"]
        if f.type != "string" and f.name in silver.columns
    }
    lost = [
        F.count(F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), 1)).alias(c)
        for c, t in typed.items()
    ]
    return silver.agg(*lost).unpivot([], list(typed), "column_name", "cast_losses")
