"""Command line for spark-submit: one step of the flow, or all of it.

    spark-submit jobs.py all --root /data/loans --day 20240131

Layers live below the root: pages, bronze, silver, gold, warehouse, model.
"""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession

from loanlens import contract, scratch
from loanlens.operators import quality
from loanlens.plans import features, medallion, model
from loanlens.sources import bronze, lake
from loanlens.streaming import alerts, loader


def land(spark: SparkSession, root: str, _: str) -> None:
    landed = bronze.land_pages(spark, f"{root}/pages")
    bronze.write_landed(landed, f"{root}/bronze")
    good, _ = bronze.split_quarantine(bronze.read_bronze(spark, f"{root}/bronze"))
    quality.validate_landing(good).show()


def silver(spark: SparkSession, root: str, day: str) -> None:
    print(medallion.bronze_to_silver(spark, f"{root}/bronze", f"{root}/silver", day))
    rows = lake.read_silver(spark, f"{root}/silver")
    quality.profile(rows).show(truncate=False)
    quality.null_percentages(rows).show(100, truncate=False)


def gold(spark: SparkSession, root: str, _: str) -> None:
    print(medallion.silver_to_gold(spark, f"{root}/silver", f"{root}/gold"))


def load(spark: SparkSession, root: str, _: str) -> None:
    loader.load_star(spark, f"{root}/gold", f"{root}/warehouse")


def everything(spark: SparkSession, root: str, day: str) -> None:
    print(medallion.run_all(spark, root, day))


def train(spark: SparkSession, root: str, day: str) -> None:
    as_of = date(int(day[:4]), int(day[4:6]), int(day[6:]))
    rows = features.build_features(lake.read_star(spark, f"{root}/gold"), as_of)
    features.class_balance(rows).show()
    rows = scratch.materialise(rows)
    training, held_out = model.split(rows)
    best = model.cross_validate(training).best_model
    model.save_model(best, f"{root}/model")
    scored = best.transform(held_out)
    model.metrics(scored).show(truncate=False)
    model.confusion_matrix(scored).show()
    model.feature_importances(best, rows).show(truncate=False)


def watch(spark: SparkSession, root: str, _: str) -> None:
    raw = alerts.read_raw_stream(spark, f"{root}/incoming", f"{root}/incoming_archive")
    query = alerts.start_recording(raw, f"{root}/alert_checkpoint", f"{root}/alerts")
    query.awaitTermination()


def deliver(spark: SparkSession, root: str, day: str) -> None:
    """Takes a day's raw files into Silver; only the countries they touch are rewritten."""
    counts = medallion.bronze_to_silver(
        spark, f"{root}/bronze_{day}", f"{root}/silver", day, merge=True
    )
    print(counts)


def compact(spark: SparkSession, root: str, _: str) -> None:
    for table in contract.WAREHOUSE:
        loader.compact(spark, f"{root}/warehouse", table)


STEPS = {
    "land": land,
    "silver": silver,
    "deliver": deliver,
    "gold": gold,
    "load": load,
    "compact": compact,
    "all": everything,
    "train": train,
    "watch": watch,
}


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("step", choices=STEPS)
    parser.add_argument("--root", required=True)
    parser.add_argument("--day", default=f"{date.today():%Y%m%d}", help="yyyymmdd")
    options = parser.parse_args()
    spark = SparkSession.builder.appName(f"loanlens-{options.step}").getOrCreate()
    try:
        STEPS[options.step](spark, options.root, options.day)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
