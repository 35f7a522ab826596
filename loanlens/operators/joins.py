"""Lookups, star joins and orphan checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens.scratch import materialise

# Fixed value: largest lookup table, in bytes, that is sent to every executor.
BROADCAST_BYTES = 52_428_800

# A key is hot when it holds more than 1/HOT_SHARE of the rows, so there are at
# most HOT_SHARE of them and their lookup rows always fit a broadcast.
HOT_SHARE = 1000


def stored_bytes(df: DataFrame) -> int:
    """Bytes of values in ``df``, measured with one aggregate."""

    def width(field: T.StructField):
        if isinstance(field.dataType, T.StringType):
            return F.coalesce(F.octet_length(field.name), F.lit(0)) + 8
        return F.lit(16)

    widths = [width(f) for f in df.schema]
    total = df.agg(F.sum(sum(widths[1:], widths[0])).alias("bytes")).first()["bytes"]
    return total or 0


def hot_keys(df: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keys that hold more than 1/HOT_SHARE of the rows; never more than HOT_SHARE."""
    counts = df.groupBy(*on).count()
    return counts.where(F.col("count") * HOT_SHARE > F.lit(df.count())).select(*on)


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    broadcast_bytes: int = BROADCAST_BYTES,
    stored: DataFrame | None = None,
) -> DataFrame:
    """Left equi join of a lookup table with one row per key.

    ``dim`` should be stored, since its size is measured first.  A small one is
    broadcast.  A large one is joined by shuffle without the rows of hot keys: their
    few lookup rows are broadcast, so those rows never cross the shuffle.  Keys are
    counted in ``stored``, the table ``df`` was made from, if given.
    """
    if stored_bytes(dim) <= broadcast_bytes:
        return df.join(F.broadcast(dim), list(on), "left")

    hot = materialise(hot_keys(df if stored is None else stored, on))
    values = [c for c in dim.columns if c not in on]
    hot_values = dim.join(F.broadcast(hot), list(on), "left_semi")
    # A hot key without lookup row, or a missing one, is taken out like the others.
    hot_dim = hot.join(F.broadcast(hot_values), list(on), "left").select(
        *[F.col(c).alias(f"_hot_{c}") for c in (*on, *values)],
        F.lit(True).alias("_is_hot"),
    )
    same_key = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_hot_{c}")) for c in on])
    marked = df.join(F.broadcast(hot_dim), same_key, "left")
    hot_rows = marked.where("_is_hot").select(
        *df.columns, *[F.col(f"_hot_{c}").alias(c) for c in values]
    )
    cold_rows = marked.where("_is_hot IS NULL").select(*df.columns)
    cold = cold_rows.join(dim, list(on), "left").select(*df.columns, *values)
    return hot_rows.unionByName(cold)


# How the fact reaches each dimension.
_STAR_KEYS = {
    "dim_country": "country_key",
    "dim_project": "project_key",
    "dim_loan_type": "loan_type_key",
    "dim_borrower": "borrower_key",
}


def star_join(
    fact: DataFrame, dims: Mapping[str, DataFrame], attributes: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Adds dimension attributes to the fact, NULL where a key has no row.

    The tables are read from files, so Spark knows their size and broadcasts those
    below its threshold; no hint overrides that check.
    """
    for table, columns in attributes.items():
        key = _STAR_KEYS[table]
        fact = fact.join(dims[table].select(key, *columns), key, "left")
    return fact


def orphans(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Rows of ``fact`` whose non-missing ``key`` has no row in ``dim``."""
    return fact.where(F.col(key).isNotNull()).join(dim.select(key), key, "left_anti")


def orphan_counts(fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """One row per foreign key: orphans and missing keys.

    The fact is read once: its references to all dimensions are counted per key value
    together, before the shuffle and after, so what meets the dimensions' keys is each
    value once, however often the fact repeats it.
    """
    references = F.array(
        *[
            F.struct(F.lit(key).alias("foreign_key"), F.col(key).cast("long").alias("value"))
            for key in _STAR_KEYS.values()
        ]
    )
    uses = (
        fact.select(F.inline(references))
        .groupBy("foreign_key", "value")
        .agg(F.count(F.lit(1)).alias("uses"))
    )
    known = reduce(
        DataFrame.unionByName,
        [
            dims[table].select(
                F.lit(key).alias("foreign_key"),
                F.col(key).cast("long").alias("value"),
                F.lit(True).alias("known"),
            )
            for table, key in _STAR_KEYS.items()
        ],
    )
    missing = F.col("value").isNull()
    lost = ~missing & F.col("known").isNull()
    counts = (
        uses.join(known, ["foreign_key", "value"], "left")
        .groupBy("foreign_key")
        .agg(
            F.sum(F.when(lost, F.col("uses"))).alias("orphans"),
            F.sum(F.when(missing, F.col("uses"))).alias("missing"),
        )
    )
    names = [(key,) for key in _STAR_KEYS.values()]
    every = fact.sparkSession.createDataFrame(names, "foreign_key string")
    return every.join(counts, "foreign_key", "left").fillna(0, ["orphans", "missing"])
