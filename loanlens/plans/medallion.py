"""The whole flow: raw files to Silver, Silver to Gold, Gold to the warehouse.

Functions take the session they are given and never set a master.  Each step reads
what the one before stored, so nothing is computed twice and a lost executor costs
only its own step.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens import contract
from loanlens.operators import star as star_ops
from loanlens.operators.cleanse import cleanse
from loanlens.scratch import compiled, temporary
from loanlens.sources import bronze, lake
from loanlens.streaming.loader import load_star

_FATE = "_fate"
_QUARANTINE = {bronze.CORRUPT_LINE: "bad_records", bronze.WITHOUT_KEY: "rows_without_key"}


class StepCounts(NamedTuple):
    """Rows seen by the raw-to-Silver step."""

    loaded: int
    corrupt: int
    without_key: int
    written: int


def bronze_to_silver(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    day: str,
    merge: bool = False,
    multi_line: bool = False,
) -> StepCounts:
    """Cleanses raw files into Silver and stores unusable lines apart.

    Silver is rebuilt from these files alone; with ``merge`` they are a delivery that is
    taken into it, and only the countries it touches are rewritten.  ``multi_line``
    allows line breaks in quoted values.

    Unusable are lines that do not fit the header, and rows without a loan number:
    these have no identity, and the latest snapshot would make one loan of them all.
    The text is parsed twice: on its way to Silver, and into a stored table split by what
    becomes of a line, which holds unusable rows whole and of the others only that they
    were there, and is removed at the end.  All counts come from file footers, so they are
    exact even if a stage had to be repeated.
    """
    raw = bronze.read_bronze(spark, bronze_path, multi_line=multi_line)
    flagged = raw.withColumn(_FATE, bronze.fate(raw))
    unusable = F.col(_FATE) != bronze.GOOD
    kept = flagged.select(*[F.when(unusable, F.col(f"`{c}`")).alias(c) for c in raw.columns], _FATE)
    with temporary(spark, "raw") as staged, compiled(spark):
        kept.write.partitionBy(_FATE).parquet(staged)
        rows = spark.read.schema(flagged.schema).parquet(staged)
        part = lambda name: rows.where(F.col(_FATE) == name).drop(_FATE)
        cleansed = cleanse(flagged.where(~unusable).drop(_FATE, contract.CORRUPT))
        if merge:
            lake.merge_silver(spark, cleansed, silver_path)
        else:
            lake.write_silver(cleansed, silver_path)
        lost = {}
        for name, folder in _QUARANTINE.items():
            lost[name] = part(name).count()
            if lost[name]:
                bronze.write_quarantine(part(name), bronze_path, day, folder)
        written = lake.read_silver(spark, silver_path).count()
        return StepCounts(rows.count(), *[lost[name] for name in _QUARANTINE], written)


def store_star(
    spark: SparkSession, silver: DataFrame, gold_dir: str, silver_is_stored: bool = True
) -> dict[str, int]:
    """Builds and stores the five Gold tables; returns their row counts.

    Dimensions are written first and read back, so the fact's keys are those on disk.
    A Silver frame that is not backed by files is stored once before its five uses.
    """
    if not silver_is_stored:
        with temporary(spark, "silver") as path:
            silver.write.parquet(path)
            stored = spark.read.schema(silver.schema).parquet(path)
            return store_star(spark, stored, gold_dir)

    def store_dimension(table: str) -> int:
        return lake.write_gold(star_ops.build_dimension(silver, table), gold_dir, table)

    # Independent jobs with short stages: run together they fill the cluster better.
    with ThreadPoolExecutor(len(star_ops.DIMENSIONS)) as pool:
        rows = dict(
            zip(star_ops.DIMENSIONS, pool.map(store_dimension, star_ops.DIMENSIONS))
        )
    dims = {t: lake.read_gold(spark, gold_dir, t) for t in star_ops.DIMENSIONS}
    # One fact row per Silver row: counting the stored Silver reads footers only.
    rows["fact_loans"] = lake.write_gold(
        star_ops.build_fact(silver, dims), gold_dir, "fact_loans", silver.count()
    )
    return rows


def silver_to_gold(spark: SparkSession, silver_path: str, gold_dir: str) -> dict[str, int]:
    return store_star(spark, lake.read_silver(spark, silver_path), gold_dir)


def run_all(spark: SparkSession, root: str, day: str) -> dict[str, int]:
    """Raw files below ``root/bronze`` to warehouse tables below ``root/warehouse``."""
    counts = bronze_to_silver(spark, f"{root}/bronze", f"{root}/silver", day)
    rows = silver_to_gold(spark, f"{root}/silver", f"{root}/gold")
    load_star(spark, f"{root}/gold", f"{root}/warehouse")
    return {**counts._asdict(), **rows}
