"""Data-quality checks.  Each returns a small result table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens import contract
from loanlens.operators import cleanse

PROFILE_COLUMNS = ["region", "country", "loan_type", "loan_status"]


def _long(wide: DataFrame, columns: Sequence[str], name: str, value: str) -> DataFrame:
    return wide.unpivot([], list(columns), name, value)


def null_percentages(df: DataFrame) -> DataFrame:
    """One row per column: share of missing values in percent, two decimals."""
    rows = F.count(F.lit(1))

    def missing(column: str) -> Column:
        share = F.count(F.when(F.col(column).isNull(), 1)) * F.lit(100.0) / rows
        return F.when(rows > 0, F.round(share, 2)).otherwise(F.lit(0.0))

    wide = df.agg(*[missing(c).alias(c) for c in df.columns])
    return _long(wide, df.columns, "column_name", "null_percent")


def profile(df: DataFrame, columns: Sequence[str] = tuple(PROFILE_COLUMNS)) -> DataFrame:
    """One row: rows, columns, and distinct values of the profiled columns.

    The columns take few values together, so one hash aggregate over their
    combinations replaces a separate pass per distinct count.
    """
    present = [c for c in columns if c in df.columns]
    combinations = df.groupBy(*present).agg(F.count(F.lit(1)).alias("_rows"))
    return combinations.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("row_count"),
        F.lit(len(df.columns)).alias("column_count"),
        *[F.count_distinct(c).alias(f"distinct_{c}") for c in present],
    )


def validate_landing(df: DataFrame, expected_rows: int | None = None) -> DataFrame:
    """One row: rows, columns, and whether the landed data is usable."""
    rows = F.count(F.lit(1))
    passed = rows > 0 if expected_rows is None else rows == expected_rows
    return df.agg(
        rows.alias("row_count"),
        F.lit(len(df.columns)).alias("column_count"),
        passed.alias("passed"),
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    return counts.where(F.col("copies") > 1)


def uniqueness(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Two rows per table: how many values of either key occur more than once.

    Each table is read once: both keys of a row, as text, are counted in one grouping
    that all tables share.
    """
    parts, names = [], []
    for table, df in tables.items():
        surrogate, natural = contract.KEYS[table]
        both = {"surrogate": [surrogate], "natural": natural}
        names += [(table, kind) for kind in both]
        keys = [
            F.struct(
                F.lit(kind).alias("key_kind"),
                F.to_json(F.array(*[F.col(c).cast("string") for c in columns])).alias("value"),
            )
            for kind, columns in both.items()
        ]
        rows = df.select(F.lit(table).alias("table_name"), F.inline(F.array(*keys)))
        parts.append(rows)
    repeated = duplicate_keys(
        reduce(DataFrame.unionByName, parts), ["table_name", "key_kind", "value"]
    )
    counts = repeated.groupBy("table_name", "key_kind").agg(
        F.count(F.lit(1)).alias("duplicated_keys")
    )
    session = next(iter(tables.values())).sparkSession
    every = session.createDataFrame(names, "table_name string, key_kind string")
    joined = every.join(counts, ["table_name", "key_kind"], "left")
    return joined.fillna(0, ["duplicated_keys"])


def required_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per NOT NULL column: how many rows violate it."""
    results = []
    for table, df in tables.items():
        required = [f.name for f in contract.WAREHOUSE[table] if f.required]
        wide = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in required])
        long = _long(wide, required, "column_name", "violations")
        results.append(long.select(F.lit(table).alias("table_name"), "*"))
    return reduce(DataFrame.unionByName, results)


def length_violations(
    df: DataFrame, limits: Mapping[str, int] | None = None, table: str | None = None
) -> DataFrame:
    """One row per limited text column: rows over the limit and the longest value."""
    if limits is None:
        limits = {f.name: f.length for f in contract.WAREHOUSE[table] if f.length}
    stacked = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(n).alias("length_limit"),
                F.count(F.when(F.char_length(c) > n, 1)).alias("violations"),
                F.coalesce(F.max(F.char_length(c)), F.lit(0)).alias("longest"),
            )
            for c, n in limits.items()
        ]
    )
    return df.agg(stacked.alias("_checks")).select(F.inline("_checks"))


def cast_failures(named: DataFrame) -> DataFrame:
    """One row per number and date column: texts that could not be read.

    Without this check unreadable numbers are indistinguishable from zeros.
    """
    columns = [c for c in contract.NUMERIC + contract.DATES if c in named.columns]
    wide = named.agg(*[F.count_if(cleanse.is_unreadable(c)).alias(c) for c in columns])
    return _long(wide, columns, "column_name", "cast_failures")
