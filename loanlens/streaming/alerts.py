"""High-risk cancellation alerts, the same on a batch and on a stream.

The recorded stream has two outputs under the batch contract: alerts, and raw rows that
cannot be used (lines that do not fit the header, rows without a loan number).  Each
batch has a folder of its own in both, replaced if the batch is repeated after a failure,
so every alert and every unusable row is there once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from loanlens import contract
from loanlens.functions.scalars import HIGH_RISK_AMOUNT, cancellation_percent, risk_level
from loanlens.operators.cleanse import number_from_text, standard_name, typed_rows
from loanlens.scratch import compiled, complete_folders, temporary
from loanlens.sources import bronze

# Rate limit, trigger and query name of the alert job.
FILES_PER_TRIGGER = 5
TRIGGER_INTERVAL = "30 seconds"
QUERY_NAME = "high_risk_cancellations"

_FATE = "_fate"
_INGESTION = ["ingestion_timestamp", "source_file"]


def read_raw_stream(
    spark: SparkSession,
    source: str,
    archive: str | None = None,
    header: Sequence[str] = tuple(contract.BRONZE_HEADER),
    files_per_trigger: int = FILES_PER_TRIGGER,
) -> DataFrame:
    """File stream of raw statement files as text, malformed lines in the corrupt column.

    The raw folder itself can be streamed: its files, header and rules are the same.
    Headers are compared: columns in another order stop the job instead of filling the
    wrong fields.  Handled files move to ``archive``, if given, which must lie outside
    ``source``.
    """
    reader = (
        spark.readStream.format("csv")
        .schema(contract.bronze_schema(list(header)))
        .options(**bronze.READ_OPTIONS)
        .option("maxFilesPerTrigger", files_per_trigger)
    )
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(source)


def read_statement_stream(
    spark: SparkSession,
    source: str,
    archive: str | None = None,
    header: Sequence[str] = tuple(contract.BRONZE_HEADER),
    files_per_trigger: int = FILES_PER_TRIGGER,
) -> DataFrame:
    """The usable rows of the raw stream, typed and filled as the batch does it.

    For a look at the console: what is left out here is stored by ``start_recording``.
    """
    raw = read_raw_stream(spark, source, archive, header, files_per_trigger)
    good = raw.where(bronze.fate(raw) == bronze.GOOD)
    return typed_rows(good.drop(contract.CORRUPT))


def enrich(df: DataFrame) -> DataFrame:
    """Adds when and from which file a row was taken."""
    return df.withColumns(
        {
            "ingestion_timestamp": F.current_timestamp(),
            "source_file": F.col("_metadata.file_path"),
        }
    )


def high_risk(df: DataFrame, threshold: float = HIGH_RISK_AMOUNT) -> DataFrame:
    """Rows with a cancelled amount above the threshold, graded.

    The alert columns a frame lacks (a batch has no ingestion columns) are left out.
    """
    graded = df.where(F.col("cancelled_amount") > threshold).withColumns(
        {"risk_level": risk_level(), "cancellation_ratio": cancellation_percent()}
    )
    return graded.select(*[c for c in contract.ALERT_COLUMNS if c in graded.columns])


def start_alerts(
    alerts: DataFrame,
    checkpoint: str,
    sink: str = "console",
    options: Mapping[str, str] | None = None,
    available_now: bool = False,
    interval: str = TRIGGER_INTERVAL,
) -> StreamingQuery:
    """Starts the alert job; ``available_now`` handles what is there and stops.

    The console shows 50 untruncated rows per batch and repeats a batch that failed.
    Alerts that must be there once are recorded by ``start_recording``.
    """
    settings = {"truncate": "false", "numRows": "50"} if sink == "console" else {}
    writer = (
        alerts.writeStream.outputMode("append")
        .format(sink)
        .options(**{**settings, **(options or {})})
        .option("checkpointLocation", checkpoint)
        .queryName(QUERY_NAME)
    )
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def _may_alert(raw: DataFrame, threshold: float = HIGH_RISK_AMOUNT) -> Column:
    """Whether the cancelled amount of a raw row is above the threshold."""
    names = [c for c in raw.columns if standard_name(c) == "cancelled_amount"]
    if len(names) != 1:  # left to the typing, which fills or refuses it
        return F.lit(True)
    amount = number_from_text(f"`{names[0]}`", "cancelled_amount")
    return F.coalesce(amount > threshold, F.lit(False))


def _record(batch: DataFrame, batch_id: int, target: str, quarantine: str) -> None:
    """Stores a batch's alerts and its unusable rows, each in a folder of the batch.

    The raw text is parsed once, into a staged table split by what becomes of a row;
    usable rows that give no alert are left out of it.
    """
    spark, part = batch.sparkSession, f"batch_id={batch_id}"
    flagged = batch.withColumn(_FATE, bronze.fate(batch))
    with temporary(spark, "stream") as staged, compiled(spark):
        stored = flagged.where((F.col(_FATE) != bronze.GOOD) | _may_alert(batch))
        stored.write.partitionBy(_FATE).parquet(staged)
        rows = spark.read.schema(flagged.schema).parquet(staged)
        unusable = rows.where(F.col(_FATE) != bronze.GOOD).withColumnRenamed(_FATE, "reason")
        unusable.write.mode("overwrite").parquet(f"{quarantine}/{part}")
        good = rows.where(F.col(_FATE) == bronze.GOOD).drop(_FATE, contract.CORRUPT)
        graded = high_risk(typed_rows(good, _INGESTION))
        graded.write.mode("overwrite").parquet(f"{target}/{part}")


def _quarantine_dir(target: str) -> str:
    """Readers of the alerts skip a folder whose name starts with an underscore."""
    return f"{target}/_quarantine"


def start_recording(
    raw: DataFrame,
    checkpoint: str,
    target: str,
    quarantine: str | None = None,
    available_now: bool = False,
    interval: str = TRIGGER_INTERVAL,
) -> StreamingQuery:
    """Starts the recorded alert job over a raw stream.

    Alerts go below ``target``, unusable rows with their ``reason`` below ``quarantine``
    (by default a folder that readers of ``target`` skip).  Stopped at any point and
    started again with the same checkpoint, it neither loses nor repeats a row.
    """
    aside = quarantine or _quarantine_dir(target)
    writer = (
        enrich(raw)
        .writeStream.foreachBatch(lambda batch, number: _record(batch, number, target, aside))
        .option("checkpointLocation", checkpoint)
        .queryName(QUERY_NAME)
    )
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def recorded_alerts(spark: SparkSession, target: str) -> DataFrame:
    """Every alert of complete batches so far."""
    types = {f.name: f.dataType for f in contract.silver_schema()}
    types |= {"risk_level": T.StringType(), "cancellation_ratio": T.DoubleType()}
    types |= {"ingestion_timestamp": T.TimestampType(), "source_file": T.StringType()}
    schema = T.StructType([T.StructField(c, types[c]) for c in contract.ALERT_COLUMNS])
    return _recorded(spark, target, schema)


def recorded_quarantine(
    spark: SparkSession,
    target: str,
    quarantine: str | None = None,
    header: Sequence[str] = tuple(contract.BRONZE_HEADER),
) -> DataFrame:
    """Every unusable row of complete batches so far, as received, with its reason."""
    schema = T.StructType(list(contract.bronze_schema(list(header)).fields))
    schema = schema.add("ingestion_timestamp", "timestamp").add("source_file", "string")
    return _recorded(spark, quarantine or _quarantine_dir(target), schema.add("reason", "string"))


def _recorded(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    done = [f"{path}/{p.parent.name}" for p in complete_folders(spark, path)]
    if not done:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*done)


def run_alerts(
    spark: SparkSession,
    source: str,
    archive: str | None,
    checkpoint: str,
    target: str,
) -> DataFrame:
    """Handles all files present into ``target`` and returns every alert so far."""
    raw = read_raw_stream(spark, source, archive)
    start_recording(raw, checkpoint, target, available_now=True).awaitTermination()
    return recorded_alerts(spark, target)
