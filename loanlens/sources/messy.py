"""Statements as raw text files would carry them: mixed dates, junk, gaps.

Every defect depends on the row's own numbers, so SQL can tell which rows have it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from loanlens import contract
from loanlens.scratch import compiled
from loanlens.sources.statements import statements_of

# A compressed file is read by one task, so none may outgrow a task.
RECORDS_PER_FILE = 1_000_000

_MARKS = ("l_partkey", "l_suppkey", "l_linenumber")


def _date_text(plain: Column) -> Column:
    """One of the four known patterns, by line number, made from the plain one."""
    shape = F.col("l_linenumber") % 4
    month_day = F.translate(F.substring(plain, -5, 5), "-", "/")
    slashed = F.concat(month_day, F.lit("/"), F.left(plain, F.length(plain) - 6))
    return (
        F.when(shape == 0, F.concat(plain, F.lit("T00:00:00.000")))
        .when(shape == 1, F.concat(plain, F.lit("T00:00:00")))
        .when(shape == 2, slashed)
        .otherwise(plain)
    )


def messy_statements(joined: DataFrame) -> DataFrame:
    """All statements of joined line items as text, with three marker columns."""
    part, supplier = F.col("l_partkey"), F.col("l_suppkey")
    # Dates are printed once, in a step of their own: each pattern is cut from that text.
    printed = {f"_{c}": F.col(c).cast("string") for c in contract.DATES}
    rows = statements_of(joined, _MARKS).withColumns(printed)
    text = {c: F.col(c).cast("string") for c in contract.NUMERIC}
    text |= {c: _date_text(F.col(f"_{c}")) for c in contract.DATES}
    text["interest_rate"] = F.when(supplier % 17 == 0, "n/a").otherwise(
        text["interest_rate"]
    )
    text["original_principal_amount"] = F.when(part % 29 == 0, "1,000").otherwise(
        text["original_principal_amount"]
    )
    # Texts that a plain cast takes for numbers, or that no declared type can hold.
    odd = {
        "undisbursed_amount": (41, "NaN"),
        "disbursed_amount": (43, "Infinity"),
        "repaid_to_ibrd": (47, "1e20"),
        "sold_3rd_party": (53, "12d"),
        "service_charge_rate": (37, "123456.5"),
    }
    for column, (every, junk) in odd.items():
        text[column] = F.when(part % every == 0, junk).otherwise(text[column])
    text["cancelled_amount"] = F.when(
        F.col("cancelled_amount") > 0, text["cancelled_amount"]
    )
    text["closed_date_most_recent"] = F.when(part % 13 == 0, "not a date").otherwise(
        text["closed_date_most_recent"]
    )
    text["first_repayment_date"] = F.when(part % 19 == 0, "1/5/2024").otherwise(
        text["first_repayment_date"]
    )
    text["last_disbursement_date"] = F.when(
        supplier % 11 != 0, text["last_disbursement_date"]
    )
    text["loan_number"] = F.when(part % 59 != 0, F.col("loan_number"))
    text["region"] = F.when(part % 31 != 0, F.col("region"))
    text["guarantor"] = F.when(supplier % 23 != 0, F.col("guarantor"))
    return rows.select(
        *[text.get(c, F.col(c)).alias(c) for c in contract.COLUMNS], *_MARKS
    )


def is_malformed() -> Column:
    """Rows that the raw files carry with one value too many."""
    return F.col("l_partkey") % 97 == 0


def write_bronze(messy: DataFrame, path: str) -> None:
    """Raw files: good rows, and malformed rows in files of their own.

    A malformed row is one ready-made line under a ready-made header line, written as
    the only column of a file with another separator, so its commas stay as they are.
    The files are compressed: as plain text they outweigh the tables many times.
    """
    header = dict(zip(contract.COLUMNS, contract.BRONZE_HEADER))
    good, bad = messy.where(~is_malformed()), messy.where(is_malformed())
    named = good.select(*[F.col(c).alias(h) for c, h in header.items()])
    with compiled(messy.sparkSession):
        as_files(named).option("header", True).csv(path)
    values = [F.coalesce(c, F.lit("")) for c in header]
    line = F.concat_ws(",", *values, F.lit("surplus")).alias(",".join(header.values()))
    as_files(bad.select(line)).mode("append").option("header", True).csv(path, sep="\u0001")


def as_files(rows: DataFrame) -> DataFrameWriter:
    """Writer of compressed text files of bounded length."""
    writer = rows.write.option("compression", "gzip")
    return writer.option("maxRecordsPerFile", RECORDS_PER_FILE)
