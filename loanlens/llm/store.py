"""Intermediate tables as Parquet in the shared folder, and their removal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loanlens import scratch


class Store:
    """Tables written once and read back, so that nothing is computed twice.

    A written table survives lost executors.  ``drop`` removes those that no later
    step reads; the ones behind a returned, still lazy DataFrame stay.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: dict[str, str] = {}

    def put(self, name: str, df: DataFrame) -> DataFrame:
        path = scratch.new_folder(self.spark, name)
        with scratch.tidied(self.spark):
            df.write.parquet(path)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            scratch.remove(self.spark, self.paths.pop(name))

    def keep(self, *prefixes: str) -> None:
        """Removes all tables but those whose names start so."""
        self.drop(*[n for n in list(self.paths) if not n.startswith(prefixes)])
