"""Incremental load of Gold files into warehouse tables.

The stream carries file names, not rows: each batch is a bounded list of files the
checkpoint has not seen.  Its rows go to a folder of their own, replaced if the batch
is repeated, so loading costs what the new files cost and never rewrites a table.
Readers see the newest row of each business key among the files of the last delivery.
Compaction rewrites the batches so far into one folder and then writes a new version of
the manifest, which names it; batches after those it covers are live as they are.  It
removes nothing: a reader opened before finishes on the folders it knows, and ``vacuum``
later removes what no kept version names.  Source files are left in place.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens import contract
from loanlens.operators.cleanse import trim_text, warehouse_types
from loanlens.operators.dedup import latest_per_key
from loanlens.operators.ranking import top_n
from loanlens.scratch import complete_folders, folders, remove

LOADED, SKIPPED = "LOADED", "SKIPPED"

# Files of one batch: their names, not their rows, pass through the driver.
FILES_PER_BATCH = 1000

# Window and length of the load history report.
HISTORY_HOURS = 24
HISTORY_ROWS = 20

_AUDIT = ["_loaded_at", "_source_file"]
_FILE_LISTING = "path string, modificationTime timestamp, length bigint, content binary"
_HISTORY = (
    "_source_file string, status string, rows bigint, lost_values bigint, "
    "_loaded_at timestamp_ntz"
)
# One row: the compacted folder a version names, and the last batch it covers.
_MANIFEST = "folder string, last_batch bigint"


def _rows_dir(warehouse: str, table: str) -> str:
    return f"{warehouse}/{table}/rows"


def _history_dir(warehouse: str, table: str) -> str:
    return f"{warehouse}/{table}/history"


def _delivery_dir(warehouse: str, table: str) -> str:
    """Per run the files that were in the source."""
    return f"{warehouse}/{table}/delivery"


def _compacted_dir(warehouse: str, table: str) -> str:
    return f"{warehouse}/{table}/compacted"


def _manifest_dir(warehouse: str, table: str) -> str:
    return f"{warehouse}/{table}/manifest"


class Version(NamedTuple):
    """One version of a table's manifest: the folder that replaces batches up to one."""

    number: int
    folder: str
    last_batch: int


def _numbers(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Sorted numbers of the complete folders ``prefix=number`` below a folder."""
    names = [p.parent.name for p in complete_folders(spark, path)]
    return sorted(int(n.removeprefix(prefix + "=")) for n in names)


def versions(spark: SparkSession, warehouse: str, table: str) -> list[Version]:
    """The complete versions of the manifest, oldest first; none before a compaction."""
    path = _manifest_dir(warehouse, table)
    return [
        Version(number, row["folder"], row["last_batch"])
        for number in _numbers(spark, path, "version")
        for row in spark.read.schema(_MANIFEST).parquet(f"{path}/version={number}").collect()
    ]


def _newest(spark: SparkSession, warehouse: str, table: str) -> Version:
    known = versions(spark, warehouse, table)
    return known[-1] if known else Version(0, "", -1)


def typed_rows(rows: DataFrame, table: str) -> DataFrame:
    """Trimmed rows in the declared types; ``_cast_failures`` counts lost values."""
    types = {f.name: f.type for f in contract.WAREHOUSE[table]}
    return warehouse_types(trim_text(rows), types)


def file_report(typed: DataFrame, promised: DataFrame, files: DataFrame) -> DataFrame:
    """One row per file: its rows, lost values, and whether it is loaded.

    A file counts only as a whole: it is skipped if a value does not fit its declared
    type, if its footer cannot be read, or if fewer rows than the footer promises can.
    """
    read = typed.groupBy("_source_file").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("_cast_failures").alias("lost_values")
    )
    reports = (
        files.join(promised, "_source_file", "left")
        .join(read, "_source_file", "left")
        .withColumns(
            {c: F.coalesce(c, F.lit(0)) for c in ("rows", "lost_values")}
        )
    )
    whole = (F.col("rows") == F.col("promised_rows")) & (F.col("lost_values") == 0)
    status = F.when(whole, LOADED).otherwise(SKIPPED)
    return reports.select("_source_file", status.alias("status"), "rows", "lost_values")


def load_files(
    spark: SparkSession,
    files: list[str],
    batch_id: int,
    warehouse: str,
    table: str,
    source_schema: T.StructType,
) -> None:
    """Stores the typed rows of a batch, and a report on every file.

    Rows are read and typed once; the report is taken from what was stored, and readers
    see the rows of files it calls loaded.
    """
    name = F.col("_metadata.file_path").alias("_source_file")
    reader = spark.read.schema(source_schema).option("ignoreCorruptFiles", True)
    rows = reader.parquet(*files)
    # Counting without columns reads footers only.
    promised = rows.groupBy(name).agg(F.count(F.lit(1)).alias("promised_rows"))
    typed = typed_rows(rows.select("*", name), table)
    listed = spark.read.format("binaryFile").load(files).select(name)
    loaded_at = F.convert_timezone(
        F.current_timezone(), F.lit("UTC"), F.localtimestamp()
    )
    part = f"batch_id={batch_id}"
    rows_dir = f"{_rows_dir(warehouse, table)}/{part}"
    stored = typed.withColumn("_loaded_at", loaded_at).select(
        *contract.names(table), *_AUDIT, "_cast_failures"
    )
    stored.write.mode("overwrite").parquet(rows_dir)
    read_back = spark.read.schema(stored.schema).parquet(rows_dir)
    report = file_report(read_back, promised, listed).withColumn("_loaded_at", loaded_at)
    report.write.mode("overwrite").parquet(f"{_history_dir(warehouse, table)}/{part}")


def load_new_files(
    spark: SparkSession,
    source: str,
    warehouse: str,
    table: str,
    source_schema: T.StructType | None = None,
    files_per_batch: int = FILES_PER_BATCH,
) -> None:
    """Loads every file below ``source`` that no earlier run has handled.

    Running it again is the refresh: a file that was missed is found then.
    """
    schema = source_schema or contract.table_schema(table)

    def handle(listing: DataFrame, batch_id: int) -> None:
        files = [row["path"] for row in listing.select("path").collect()]
        if files:
            load_files(spark, files, batch_id, warehouse, table, schema)

    query = (
        spark.readStream.format("binaryFile")
        .schema(_FILE_LISTING)
        .option("pathGlobFilter", "*.parquet")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(source)
        .select("path")
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", f"{warehouse}/{table}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    run = time.time_ns()
    _present_files(spark, source).write.parquet(
        f"{_delivery_dir(warehouse, table)}/run={run}"
    )


def load_tables(spark: SparkSession, sources: Mapping[str, str], warehouse: str) -> None:
    """Loads the new files of several tables, each by its own query, side by side."""
    with ThreadPoolExecutor(max(len(sources), 1)) as pool:
        runs = [
            pool.submit(load_new_files, spark, folder, warehouse, table)
            for table, folder in sources.items()
        ]
        for run in runs:
            run.result()


def load_star(spark: SparkSession, gold_dir: str, warehouse: str) -> None:
    """Loads the new files of all five tables."""
    load_tables(spark, {t: f"{gold_dir}/{t}" for t in contract.WAREHOUSE}, warehouse)


def all_rows(spark: SparkSession, warehouse: str, table: str) -> DataFrame:
    """Every loaded row of every batch that was not compacted, and the compacted rows.

    ``_vanished`` marks compacted rows whose file was no longer in the source then.
    """
    fields = ", ".join(f"{f.name} {f.type}" for f in contract.WAREHOUSE[table])
    schema = f"{fields}, _loaded_at timestamp_ntz, _source_file string, batch_id bigint"
    columns = [*contract.names(table), *_AUDIT, "batch_id", "_vanished"]
    newest = _newest(spark, warehouse, table)
    path = _rows_dir(warehouse, table)
    live = [n for n in _numbers(spark, path, "batch_id") if n > newest.last_batch]
    parts = []
    if live:
        stored = spark.read.schema(schema).option("basePath", path)
        history = load_history(spark, warehouse, table).where(F.col("status") == LOADED)
        rows = stored.parquet(*[f"{path}/batch_id={n}" for n in live]).join(
            history.select("batch_id", "_source_file"), ["batch_id", "_source_file"], "left_semi"
        )
        parts.append(rows.withColumn("_vanished", F.lit(False)).select(*columns))
    if newest.number:
        done = spark.read.schema(f"{schema}, _vanished boolean")
        folder = f"{_compacted_dir(warehouse, table)}/{newest.folder}"
        parts.append(done.parquet(folder).select(*columns))
    if not parts:
        return spark.createDataFrame([], f"{schema}, _vanished boolean").select(*columns)
    return reduce(DataFrame.unionByName, parts)


def compact(spark: SparkSession, warehouse: str, table: str) -> None:
    """Rewrites the batches so far into one folder, named by a new manifest version.

    No view loses a row: of files in the last delivery, the newest row of each key in
    each file stays, since a later delivery may hold only some of them; of files that
    had left the source, the newest row of each key, marked as vanished.  So
    ``current_rows`` is the same before and after, with ``keep_vanished`` and without.
    A marked row stays vanished, even if its file should come back under its old name.

    The folder is complete before the version names it, and the version is swapped in
    by one write.  Each version covers all batches up to its last, so whichever of two
    compactions at a time comes last, its version is whole.  Nothing is removed.
    """
    handled = load_history(spark, warehouse, table).agg(F.max("batch_id")).first()[0]
    before = _newest(spark, warehouse, table)
    if handled is None or handled <= before.last_batch:
        return
    natural, order = contract.KEYS[table][1], ["batch_id", "_loaded_at"]
    rows = all_rows(spark, warehouse, table).where(F.col("batch_id") <= handled)
    there = _last_delivery(spark, warehouse, table).withColumn("_there", F.lit(True))
    marked = rows.join(there, "_source_file", "left").withColumn(
        "_vanished", F.col("_vanished") | F.col("_there").isNull()
    )
    # Files count as one where they have vanished, each for itself where they have not.
    marked = marked.drop("_there").withColumn(
        "_scope", F.when(~F.col("_vanished"), F.col("_source_file"))
    )
    kept = latest_per_key(marked, [*natural, "_scope"], [*order, "_source_file"])
    folder = f"rows-{uuid.uuid4().hex[:12]}"
    kept.drop("_scope").write.parquet(f"{_compacted_dir(warehouse, table)}/{folder}")
    manifest = _manifest_dir(warehouse, table)
    # Numbers of unfinished versions are passed over.
    taken = [int(n.removeprefix("version=")) for n in folders(spark, manifest)]
    entry = spark.createDataFrame([(folder, handled)], _MANIFEST).coalesce(1)
    entry.write.mode("errorifexists").parquet(f"{manifest}/version={max(taken, default=0) + 1}")


def vacuum(spark: SparkSession, warehouse: str, table: str, keep: int = 1) -> list[str]:
    """Removes what none of the newest ``keep`` versions needs; returns those folders.

    These are batches an older compaction replaced, older compacted folders, and
    compacted folders no version names.  Readers of kept versions are not touched.
    Call it when no reader of an older one is left and no compaction runs.
    """
    known = versions(spark, warehouse, table)
    if keep < 1 or not known:
        return []
    kept, gone = known[-keep:], known[:-keep]
    rows, compacted = _rows_dir(warehouse, table), _compacted_dir(warehouse, table)
    named = {v.folder for v in kept}
    unused = [
        f"{rows}/batch_id={n}"
        for n in _numbers(spark, rows, "batch_id")
        if n <= kept[0].last_batch
    ]
    unused += [f"{compacted}/{name}" for name in folders(spark, compacted) if name not in named]
    # The old versions go first, so no reader starts from one that is half removed.
    unused = [f"{_manifest_dir(warehouse, table)}/version={v.number}" for v in gone] + unused
    for path in unused:
        remove(spark, path)
    return unused


def _present_files(spark: SparkSession, source: str) -> DataFrame:
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
    return listing.load(source).select(F.col("_metadata.file_path").alias("_source_file"))


def _last_delivery(spark: SparkSession, warehouse: str, table: str) -> DataFrame:
    """The files that were in the source at the last load."""
    path = _delivery_dir(warehouse, table)
    last = _numbers(spark, path, "run")[-1:]
    if not last:
        return spark.createDataFrame([], "_source_file string")
    return spark.read.schema("_source_file string").parquet(f"{path}/run={last[0]}")


def current_rows(
    spark: SparkSession, warehouse: str, table: str, keep_vanished: bool = False
) -> DataFrame:
    """The newest row of each business key; a key in two batches is not doubled.

    A delivery replaces the one before it: rows of files that were no longer in the
    source at the last load are left out, so members and surrogate keys of different
    rebuilds do not mix.  ``keep_vanished`` keeps them, for sources whose old files
    are cleared away after loading.
    """
    rows = all_rows(spark, warehouse, table)
    if not keep_vanished:
        there = _last_delivery(spark, warehouse, table)
        rows = rows.where(~F.col("_vanished")).join(there, "_source_file", "left_semi")
    natural = contract.KEYS[table][1]
    newest = latest_per_key(rows, natural, ["batch_id", "_loaded_at", "_source_file"])
    return newest.select(*contract.names(table), *_AUDIT)


def pending_files(
    spark: SparkSession, source: str, warehouse: str, table: str
) -> DataFrame:
    """Files below ``source`` that no run has handled yet."""
    handled = load_history(spark, warehouse, table).select("_source_file")
    return _present_files(spark, source).join(handled, "_source_file", "left_anti")


def load_history(spark: SparkSession, warehouse: str, table: str) -> DataFrame:
    """One row per file handled so far."""
    schema = f"{_HISTORY}, batch_id bigint"
    return spark.read.schema(schema).parquet(_history_dir(warehouse, table))


def recent_loads(
    spark: SparkSession,
    warehouse: str,
    table: str,
    now: datetime,
    hours: int = HISTORY_HOURS,
    rows: int = HISTORY_ROWS,
) -> DataFrame:
    """History report: files of the last hours before ``now`` (UTC), newest first."""
    since = F.lit(now - timedelta(hours=hours)).cast("timestamp_ntz")
    recent = load_history(spark, warehouse, table).where(F.col("_loaded_at") >= since)
    return top_n(recent, rows, "_loaded_at", ["_source_file"])
