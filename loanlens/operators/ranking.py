"""Top-n, ranks and prior-period comparison over aggregated tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def top_n(df: DataFrame, n: int, by: str, tie_break: Sequence[str]) -> DataFrame:
    """The ``n`` rows with the largest ``by``; ties are cut by ``tie_break``.

    Runs as a bounded heap per partition, not as a global sort.
    """
    return df.orderBy(F.col(by).desc_nulls_last(), *tie_break).limit(n)


def top_n_with_ties(df: DataFrame, n: int, by: str) -> DataFrame:
    """Rows ranked ``n`` or better, with a ``rank`` column; ties are all kept.

    Only the ``n`` largest values meet in one task.  They give the rank of each value
    among them; the rows that have such a value are then found where they are, so ties
    are never gathered.  Missing values rank last, equal among themselves.
    """
    order = F.col("_by").desc_nulls_last()
    best = df.select(F.col(by).alias("_by")).orderBy(order).limit(n)
    ranks = best.withColumn("rank", F.rank().over(Window.orderBy(order))).distinct()
    return df.join(F.broadcast(ranks), F.col(by).eqNullSafe(F.col("_by"))).select(
        *df.columns, "rank"
    )


def joined_names(name: str, by: str) -> Column:
    """Aggregate: the names separated by ``, ``, largest ``by`` first, then by name."""
    return F.expr(f"listagg({name}, ', ') WITHIN GROUP (ORDER BY {by} DESC, {name})")


def dense_rank_by(df: DataFrame, by: str, name: str) -> DataFrame:
    """Adds the dense rank, largest first.  For one row per dimension member."""
    return df.withColumn(
        name, F.dense_rank().over(Window.orderBy(F.col(by).desc_nulls_last()))
    )


def prior_year(year: str, value: str, by: Sequence[str] = ()) -> Column:
    """``value`` of the year before, NULL when that year has no row.

    A value range, not a row offset: a missing year must not be bridged.
    """
    window = Window.partitionBy(*by).orderBy(year).rangeBetween(-1, -1)
    return F.first(value).over(window)


def year_over_year(
    df: DataFrame, date: str, value: Column, name: str, by: Sequence[str] = ()
) -> DataFrame:
    """Per year (and group): the value, the one before, and the relative change.

    The change is missing unless the year before is positive.
    """
    yearly = (
        df.where(F.col(date).isNotNull())
        .groupBy(*by, F.year(date).alias("year"))
        .agg(value.alias(name))
    )
    previous = f"previous_{name}"
    with_prior = yearly.withColumn(previous, prior_year("year", name, by))
    current, prior = (F.col(c).cast("double") for c in (name, previous))
    return with_prior.withColumn("change", F.when(prior > 0, (current - prior) / prior))
