"""Stored tables the named queries read: Silver, Gold, raw files, warehouse.

Each is derived from the given tables once per session and folder and kept below the
shared folder, as a warehouse would be.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import date, datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens import contract
from loanlens.operators.star import DIMENSIONS
from loanlens.plans import features, medallion, model
from loanlens.plans.dashboards import Star
from loanlens.scratch import compiled, new_folder, tidied
from loanlens.sources import bronze, lake, messy
from loanlens.sources.statements import joined_lines, latest_statements
from loanlens.streaming import alerts, loader

AS_OF = date(2002, 1, 1)

_stored: dict[tuple[str, str, str], str] = {}
_step_counts: dict[str, medallion.StepCounts] = {}


def stored(
    spark: SparkSession, sf_dir: str, name: str, build: Callable[[str], object]
) -> str:
    """Folder of a derived table; ``build`` fills it on first use."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        folder = new_folder(spark, name)
        with tidied(spark):
            build(folder)
        _stored[key] = folder
    return _stored[key]


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest statements, amounts decimal."""

    def build(folder: str) -> None:
        latest_statements(spark, sf_dir).write.parquet(folder)

    folder = stored(spark, sf_dir, "latest", build)
    return spark.read.parquet(folder)


def gold_dir(spark: SparkSession, sf_dir: str) -> str:
    return stored(
        spark,
        sf_dir,
        "gold",
        lambda folder: medallion.store_star(spark, silver(spark, sf_dir), folder),
    )


def star(spark: SparkSession, sf_dir: str) -> Star:
    return lake.read_star(spark, gold_dir(spark, sf_dir))


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statements as raw text, with the marker columns.

    Stored is what they are derived from, a fraction of the text; a query derives the
    columns it uses.
    """

    def build(folder: str) -> None:
        joined_lines(spark, sf_dir).write.option("compression", "zstd").parquet(folder)

    return messy.messy_statements(spark.read.parquet(stored(spark, sf_dir, "joined", build)))


def messy_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same stored as text, for queries over many of the columns."""

    def build(folder: str) -> None:
        raw_rows(spark, sf_dir).write.option("compression", "zstd").parquet(folder)

    return spark.read.parquet(stored(spark, sf_dir, "messy", build))


def bronze_dir(spark: SparkSession, sf_dir: str) -> str:
    return stored(
        spark,
        sf_dir,
        "bronze",
        lambda folder: messy.write_bronze(raw_rows(spark, sf_dir), folder),
    )


def bronze_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver made from the raw files."""
    bronze = bronze_dir(spark, sf_dir)

    def build(folder: str) -> None:
        counts = medallion.bronze_to_silver(spark, bronze, folder, "20020101")
        _step_counts[folder] = counts

    return lake.read_silver(spark, stored(spark, sf_dir, "silver", build))


def raw_step_counts(spark: SparkSession, sf_dir: str) -> medallion.StepCounts:
    """What the run that made this Silver counted."""
    bronze_silver(spark, sf_dir)
    key = (spark.sparkContext.applicationId, sf_dir, "silver")
    return _step_counts[_stored[key]]


def warehouse_dir(spark: SparkSession, sf_dir: str) -> str:
    """Warehouse tables loaded from Gold, the fact from two deliveries."""
    gold = gold_dir(spark, sf_dir)

    def build(folder: str) -> None:
        delivery = f"{folder}/delivery/fact_loans"
        fact = lake.read_gold(spark, gold, "fact_loans")
        fact.write.parquet(delivery)
        dims = {t: f"{gold}/{t}" for t in DIMENSIONS}
        loader.load_tables(spark, {**dims, "fact_loans": delivery}, folder)
        fact.write.mode("append").parquet(delivery)  # repeats every loan
        loader.load_new_files(spark, delivery, folder, "fact_loans")

    return stored(spark, sf_dir, "warehouse", build)


def rebuilt_warehouse_dir(spark: SparkSession, sf_dir: str) -> str:
    """A fact delivered twice as a whole, compacted in between; the second differs."""
    gold = gold_dir(spark, sf_dir)

    def build(folder: str) -> None:
        delivery = f"{folder}/delivery/fact_loans"
        fact = lake.read_gold(spark, gold, "fact_loans")
        fact.write.parquet(delivery)
        loader.load_new_files(spark, delivery, folder, "fact_loans")
        loader.compact(spark, folder, "fact_loans")
        order = F.substring("loan_number", 2, 20).cast("long")
        kept = fact.where(order % 7 != 0).withColumn(
            "cancelled_amount",
            (F.col("cancelled_amount") + F.when(order % 5 == 0, 1).otherwise(0)).cast("decimal(18,2)"),
        )
        new = fact.where(order % 11 == 0).withColumn(
            "loan_number", F.concat(F.lit("N"), "loan_number")
        )
        kept.unionByName(new).write.mode("overwrite").parquet(delivery)
        loader.load_new_files(spark, delivery, folder, "fact_loans")

    return stored(spark, sf_dir, "rebuilt", build)


def cleared_warehouse_dir(spark: SparkSession, sf_dir: str) -> str:
    """A fact from a source that is cleared after every load, compacted each time.

    Three deliveries hold a third of the loans each; the second brings a changed amount
    for every fifth loan of the first.
    """
    gold = gold_dir(spark, sf_dir)

    def build(folder: str) -> None:
        delivery = f"{folder}/delivery/fact_loans"
        fact = lake.read_gold(spark, gold, "fact_loans")
        order = F.substring("loan_number", 2, 20).cast("long")
        changed = fact.where(order % 15 == 0).withColumn(
            "cancelled_amount", (F.col("cancelled_amount") + 1).cast("decimal(18,2)")
        )
        thirds = [fact.where(order % 3 == k) for k in range(3)]
        for rows in (thirds[0], thirds[1].unionByName(changed), thirds[2]):
            rows.write.mode("overwrite").parquet(delivery)
            loader.load_new_files(spark, delivery, folder, "fact_loans")
            loader.compact(spark, folder, "fact_loans")
            loader.vacuum(spark, folder, "fact_loans")

    return stored(spark, sf_dir, "cleared", build)


def bad_file_warehouse_dir(spark: SparkSession, sf_dir: str) -> str:
    """Projects delivered in two files, one with a key that is no number."""
    gold = gold_dir(spark, sf_dir)

    def build(folder: str) -> None:
        delivery = f"{folder}/delivery/dim_project"
        projects = lake.read_gold(spark, gold, "dim_project")
        text = projects.withColumn("project_key", F.col("project_key").cast("string"))
        odd = F.col("project_key").cast("long") % 2 == 1
        bad = F.when(F.col("project_key") == "1", "one").otherwise(F.col("project_key"))
        text.where(~odd).coalesce(1).write.parquet(delivery)
        spoilt = text.where(odd).withColumn("project_key", bad)
        spoilt.coalesce(1).write.mode("append").parquet(delivery)
        loader.load_new_files(spark, delivery, folder, "dim_project", text.schema)

    return stored(spark, sf_dir, "bad-file", build)


def alerts_dir(spark: SparkSession, sf_dir: str) -> str:
    """What the recorded stream made of the raw files, by two runs of the job."""
    source = bronze_dir(spark, sf_dir)

    def build(folder: str) -> None:
        for _ in range(2):  # the second finds every file handled
            alerts.run_alerts(spark, source, None, f"{folder}/checkpoint", f"{folder}/alerts")

    return stored(spark, sf_dir, "alerts", build) + "/alerts"


def streamed_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.recorded_alerts(spark, alerts_dir(spark, sf_dir))


def restarted_alerts_dir(spark: SparkSession, sf_dir: str) -> str:
    """The same by a stream that is stopped after its first batch and then resumed."""
    source = bronze_dir(spark, sf_dir)

    def build(folder: str) -> None:
        where = (f"{folder}/checkpoint", f"{folder}/alerts")
        raw = alerts.read_raw_stream(spark, source)
        # The next batch would come in an hour; the first is taken at once.
        query = alerts.start_recording(raw, *where, interval="1 hour")
        while query.isActive and query.lastProgress is None:
            time.sleep(0.1)
        query.stop()
        alerts.start_recording(raw, *where, available_now=True).awaitTermination()

    return stored(spark, sf_dir, "restarted", build) + "/alerts"


def delivered_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver of the raw rows outside a delivery, and then the delivery merged into it.

    The delivery has a third of the rows of three countries; every tenth loan in it
    has moved to a country of its own.
    """
    rows = raw_rows(spark, sf_dir)
    given = (F.col("l_partkey") % 3 == 0) & F.col("country_code").isin("C01", "C02", "C03")
    number = F.substring("loan_number", 2, 20).cast("long")
    moved = F.when(number % 10 == 0, "C88").otherwise(F.col("country_code"))

    def build(folder: str) -> None:
        messy.write_bronze(rows.where(~given), f"{folder}/first")
        messy.write_bronze(rows.where(given).withColumn("country_code", moved), f"{folder}/second")
        silver_dir = f"{folder}/silver"
        medallion.bronze_to_silver(spark, f"{folder}/first", silver_dir, "20020101")
        medallion.bronze_to_silver(spark, f"{folder}/second", silver_dir, "20020102", merge=True)

    return lake.read_silver(spark, stored(spark, sf_dir, "delivered", build) + "/silver")


def copies_dir(spark: SparkSession, sf_dir: str) -> str:
    """Quoted copies of the raw files, and of a copy."""
    source = bronze_dir(spark, sf_dir)

    def build(folder: str) -> None:
        first = bronze.copy_csv(spark, source, folder, now=datetime(2002, 1, 1))
        bronze.copy_csv(spark, first.target, folder, now=datetime(2002, 1, 2))

    return stored(spark, sf_dir, "copy", build)


def multi_line_dir(spark: SparkSession, sf_dir: str) -> tuple[str, medallion.StepCounts]:
    """Silver of raw files in which every fifth part's borrower takes two lines."""
    rows = raw_rows(spark, sf_dir).where(~messy.is_malformed())
    two_lines = F.concat_ws("\n", "borrower", "country")
    borrower = F.when(F.col("l_partkey") % 5 == 0, two_lines).otherwise(F.col("borrower"))
    named = rows.withColumn("borrower", borrower).select(
        *[F.col(c).alias(h) for c, h in zip(contract.COLUMNS, contract.BRONZE_HEADER)]
    )

    def build(folder: str) -> None:
        with compiled(spark):
            messy.as_files(named).option("header", True).csv(f"{folder}/raw")
        counts = medallion.bronze_to_silver(
            spark, f"{folder}/raw", f"{folder}/silver", "20020101", multi_line=True
        )
        _step_counts[folder] = counts

    folder = stored(spark, sf_dir, "multi-line", build)
    return f"{folder}/silver", _step_counts[folder]


def feature_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.build_features(star(spark, sf_dir), AS_OF)


def model_dir(spark: SparkSession, sf_dir: str) -> str:
    """A model fitted on the training part of all loans, stored."""

    def build(folder: str) -> None:
        train, _ = model.split(feature_rows(spark, sf_dir))
        model.save_model(model.fit(train), folder)

    return stored(spark, sf_dir, "model", build)


def fitted(spark: SparkSession, sf_dir: str) -> PipelineModel:
    return PipelineModel.load(model_dir(spark, sf_dir))


def test_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, test = model.split(feature_rows(spark, sf_dir))
    return model.score(model_dir(spark, sf_dir), test)
