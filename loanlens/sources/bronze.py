"""Raw layer: reading, quarantine, landing of sparse records, delimited copy."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from loanlens import contract
from loanlens.operators.cleanse import standard_name
from loanlens.scratch import folders

# What becomes of a raw row: cleansed, or set apart for one of two reasons.
GOOD, CORRUPT_LINE, WITHOUT_KEY = "good", "corrupt", "without_key"

# How raw files are read, as a batch and as a stream.
READ_OPTIONS = {
    "header": "true",
    "enforceSchema": "false",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": contract.CORRUPT,
    "columnPruning": "false",
}


def file_header(
    spark: SparkSession, path: str | list[str], multi_line: bool = False
) -> list[str]:
    """Column names of raw files; reads the first line of one of them."""
    reader = spark.read.option("header", True).option("multiLine", multi_line)
    return reader.csv(path).columns


def read_bronze(
    spark: SparkSession,
    path: str | list[str],
    header: Sequence[str] | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Raw files as text, malformed lines whole in the corrupt column.

    Columns go by the names in the files, in any order; a file whose header differs
    from the others (or from a given ``header``) stops the job, since its values would
    land in wrong columns.  Column pruning is off for this scan: with it, whether a
    line counts as malformed would depend on which columns a query happens to use.

    A quoted value may hold line breaks only with ``multi_line``; without it such a
    record is two malformed lines.  The price is that a file is then read by one task
    from end to end, since no one knows inside of it which line break ends a record:
    large deliveries should come in many files.  A quote that is never closed makes the
    rest of its file one record.
    """
    names = list(header) if header else file_header(spark, path, multi_line)
    reader = spark.read.schema(contract.bronze_schema(names)).options(**READ_OPTIONS)
    return reader.option("multiLine", multi_line).csv(path)


def is_malformed(df: DataFrame) -> Column:
    """Whether the line of a row did not fit the header.

    Spark refuses to scan raw files for the corrupt column alone, so the test takes
    in a data column: a malformed line makes the text of the two longer.
    """
    value = F.coalesce(F.col(f"`{df.columns[0]}`"), F.lit(""))
    return F.length(F.concat_ws("", value, contract.CORRUPT)) > F.length(value)


def split_quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Well-formed rows without the corrupt column, and malformed lines."""
    malformed = is_malformed(df)
    return df.where(~malformed).drop(contract.CORRUPT), df.where(malformed)


def lacks_key(df: DataFrame) -> Column:
    """Whether a row has no loan number, or a blank one; true if no column holds it."""
    names = [c for c in df.columns if standard_name(c) == "loan_number"]
    if not names:
        return F.lit(True)
    return F.trim(F.coalesce(F.col(f"`{names[0]}`"), F.lit(""))) == ""


def fate(df: DataFrame) -> Column:
    """What becomes of a raw row, the same for a batch and a stream."""
    unusable = F.when(is_malformed(df), CORRUPT_LINE).when(lacks_key(df), WITHOUT_KEY)
    return unusable.otherwise(GOOD)


def write_quarantine(
    bad: DataFrame, bronze_dir: str, day: str, kind: str = "bad_records"
) -> str:
    """Stores unusable rows below the raw folder, the line as received in the last column.

    The folder starts with an underscore, so readers of the raw folder skip it.
    """
    target = f"{bronze_dir}/_quarantine/{kind}_{day}"
    bad.write.mode("overwrite").option("header", True).csv(target)
    return target


def land_pages(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """JSON pages with differing fields as one wide text table.

    The columns are the union of all fields; a field a record lacks is an empty text.
    """
    return spark.read.option("primitivesAsString", True).json(paths).fillna("")


def write_landed(landed: DataFrame, path: str) -> None:
    """Stores landed records as raw files; an empty text is written as no value."""
    writer = landed.write.mode("errorifexists").option("header", True)
    writer.option("emptyValue", "").csv(path)


class CopyAudit(NamedTuple):
    """What a copy did."""

    target: str
    rows_read: int
    rows_copied: int
    bytes_written: int
    status: str


_AUDIT = (
    "source string, target string, rows_read bigint, rows_copied bigint, "
    "bytes_written bigint, status string, copied_at timestamp"
)


def _audit_dir(target: str) -> str:
    """Readers of the copies skip a folder whose name starts with an underscore."""
    return f"{target}/_audit"


def copy_audits(spark: SparkSession, target: str) -> DataFrame:
    """One row per copy into ``target`` so far, failed ones included."""
    if not folders(spark, _audit_dir(target)):
        return spark.createDataFrame([], _AUDIT)
    return spark.read.schema(_AUDIT).parquet(_audit_dir(target))


def copy_csv(
    spark: SparkSession,
    source: str,
    target: str,
    header: Sequence[str] | None = None,
    now: datetime | None = None,
) -> CopyAudit:
    """Copies delimited files, all values quoted, into a time-stamped batch folder.

    The copies are compressed, one file for each that is read as a piece.  Lines that do not fit the header are skipped; the two row counts, taken while
    the copy runs, differ by them.  What a copy did, or that it failed, is appended to
    the audit table of ``target``, one row a copy, which nothing rewrites.
    """
    now = now or datetime.now(timezone.utc)
    batch = f"{target}/batch={now:%Y%m%d_%H%M%S}"

    def record(audit: CopyAudit) -> CopyAudit:
        row = spark.createDataFrame([(source, *audit, now)], _AUDIT)
        row.coalesce(1).write.mode("append").parquet(_audit_dir(target))
        return audit

    try:
        return record(_copy(spark, source, batch, header))
    except Exception:
        record(CopyAudit(batch, 0, 0, 0, "FAILED"))
        raise


def _copy(
    spark: SparkSession, source: str, batch: str, header: Sequence[str] | None
) -> CopyAudit:
    # In a session of its own: one that holds an observation can't ship the models fitted
    # in it, whose training summaries carry their session into the tasks.
    raw = read_bronze(spark.newSession(), source, header)
    fits = ~is_malformed(raw)
    counted = Observation("copy")
    observed = raw.observe(
        counted,
        F.count(F.lit(1)).alias("rows_read"),
        F.count(F.when(fits, 1)).alias("rows_copied"),
    )
    (
        observed.where(fits)
        .drop(contract.CORRUPT)
        .write.mode("errorifexists")
        .option("header", True)
        .option("quoteAll", True)
        .option("escape", "\\")
        .option("compression", "gzip")
        .csv(batch)
    )
    rows_read, rows_copied = (counted.get[k] for k in ("rows_read", "rows_copied"))
    status = "SUCCESS" if rows_read == rows_copied else "PARTIAL"
    return CopyAudit(batch, rows_read, rows_copied, stored_size(spark, batch), status)


def stored_size(spark: SparkSession, path: str) -> int:
    """Bytes of the files below a folder; their content is not read."""
    files = spark.read.format("binaryFile").load(path)
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
