"""Duplicate removal and the latest snapshot of each loan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loanlens.scratch import compiled, materialise

# Fixed value: so many repeated hashes, 8 bytes each, go to every executor.
BROADCAST_HASHES = 2_000_000


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """Keeps one of each set of rows that agree in every column."""
    return df.dropDuplicates()


def exact_duplicate_count(df: DataFrame) -> DataFrame:
    """One row: how many rows ``drop_exact_duplicates`` would remove."""
    copies = df.groupBy(*df.columns).count()
    return copies.agg(
        F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("exact_duplicates")
    )


def exact_duplicates_of_wide_rows(
    df: DataFrame, broadcast_hashes: int = BROADCAST_HASHES
) -> DataFrame:
    """``exact_duplicate_count`` of rows too wide to shuffle them all.

    Hashes of the rows are counted first.  Copies share theirs, so only rows whose hash
    repeats are grouped by all columns; those that share one by chance are told apart there.
    ``df`` is read a second time only if a hash repeats.
    """
    hashed = df.withColumn("_hash", F.xxhash64(*df.columns))
    counts = hashed.groupBy("_hash").count()
    with compiled(df.sparkSession):
        repeated = materialise(counts.where("count > 1").select("_hash"))
    number = repeated.count()
    if not number:
        return exact_duplicate_count(df.limit(0))
    small = F.broadcast(repeated) if number <= broadcast_hashes else repeated
    return exact_duplicate_count(hashed.join(small, "_hash", "left_semi").drop("_hash"))


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    newest: Sequence[str],
    tie_break: Sequence[str | Column] | None = None,
) -> DataFrame:
    """One row per key: the newest, whatever the partitioning of the input.

    ``newest`` columns are compared descending with NULL last; without an
    explicit ``tie_break`` all other columns follow in the same way, so only
    fully equal rows can tie.  The ``= 1`` filter lets Spark keep one row per key
    and input partition before the shuffle, so a hot key does not travel whole.
    """
    if tie_break is None:
        tie_break = [c for c in df.columns if c not in {*keys, *newest}]
    order = [F.col(c).desc_nulls_last() for c in newest] + [
        F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in tie_break
    ]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def latest_attributes(
    df: DataFrame, keys: Sequence[str], attributes: Sequence[str], newest: str
) -> DataFrame:
    """One row per key with the attributes of its newest row.

    The first grouping shrinks the input to its distinct attribute sets with a
    hash aggregate over a fixed-width buffer; the choice among them then runs on
    that much smaller result.
    """
    seen = df.groupBy(*keys, *attributes).agg(F.max(newest).alias("_newest"))
    best = F.max(F.struct("_newest", *attributes)).alias("_best")
    return (
        seen.groupBy(*keys)
        .agg(best)
        .select(*keys, *[F.col(f"_best.{a}").alias(a) for a in attributes])
    )


def latest_loans(df: DataFrame) -> DataFrame:
    """Silver deduplication.

    The latest snapshot per loan already collapses exact copies, so no separate
    all-column shuffle is spent on them.  Without the two business columns only
    exact copies can be removed.
    """
    if {"loan_number", "end_of_period"} <= set(df.columns):
        return latest_per_key(df, ["loan_number"], ["end_of_period"])
    return drop_exact_duplicates(df)
