"""Loan statements projected from the order tables.

One line item is one reporting-period statement of the loan named by its order.
Amounts are decimal from the first multiplication on, so sums are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens import contract
from loanlens.operators.dedup import latest_per_key


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _money(value: Column) -> Column:
    return value.cast(contract.MONEY_TYPE)


def _country_code(key: str) -> Column:
    return F.concat(F.lit("C"), F.lpad(F.col(key).cast("string"), 2, "0"))


# Order among statements of one loan and period.
TIE_BREAK = [
    "project_id",
    "l_linenumber",
    "interest_rate",
    "service_charge_rate",
    "cancelled_amount",
    "guarantor",
    "l_suppkey",
    "l_quantity",
    "l_linestatus",
]


# Source columns that statements are derived from, nation and region names apart.
_LOAN = ["o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority", "o_orderstatus"]
_CUSTOMER = ["c_name", "c_nationkey", "c_mktsegment"]
_LINE = [
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
]
_PART = ["p_name", "p_size"]


def latest_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest statement of every loan.

    The choice is made among source rows, before the other columns are derived from
    them.  It goes by the order key, which a loan number is one to one with and the
    joined rows are dealt by, so they are not dealt once more.

    The choice needs nothing of a part but that there is one.  Its name and size, the
    widest a line would carry, are joined to the chosen lines only; of a part with
    several rows the largest counts.
    """
    part = _table(spark, sf_dir, "part")
    named = F.col("l_partkey") == F.col("p_partkey")
    with_part = _table(spark, sf_dir, "lineitem").join(part, named, "left_semi")
    joined = _join_loans(spark, sf_dir, with_part.select(*_LINE))
    derived = [c for c in ("end_of_period", *TIE_BREAK) if c not in joined.columns]
    unnamed = joined.withColumns({c: F.lit(None).cast(part.schema[c].dataType) for c in _PART})
    rows = _derived(unnamed).select(*joined.columns, *derived)
    order = [F.col(c).asc() for c in TIE_BREAK]
    latest = latest_per_key(rows, ["l_orderkey"], ["end_of_period"], order)
    parts = part.groupBy("p_partkey").agg(F.max(F.struct(*_PART)).alias("_part"))
    return statements_of(
        latest.select(*joined.columns)
        .join(parts.select("p_partkey", "_part.*"), named)
        .drop("p_partkey")
    )


def joined_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item with the columns of its loan, borrower, project and lender.

    What a loan repeats is joined before the lines are, and names of nations and regions
    after them, so the wide rows are dealt once, by loan.  That join is a merge whatever
    the sizes: rows of a loan come out side by side, which keeps files and whatever
    groups by loan small.  The others go by the size Spark measures.
    """
    lines = (
        _table(spark, sf_dir, "lineitem")
        .join(_table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select(*_LINE, *_PART)
    )
    return _join_loans(spark, sf_dir, lines)


def _join_loans(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    """``lines`` with the columns of their loan, borrower and lender."""
    loans = (
        _table(spark, sf_dir, "orders")
        .join(
            _table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
        )
        .select(*_LOAN, *_CUSTOMER)
    )
    lent = lines.join(
        _table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")
    ).select(*lines.columns, "s_nationkey")
    nation = _table(spark, sf_dir, "nation")
    lender = nation.select(
        F.col("n_nationkey").alias("g_nationkey"), F.col("n_name").alias("g_name")
    )
    region = _table(spark, sf_dir, "region")
    home = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return (
        lent.join(loans.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(
            home.select("n_nationkey", "n_name", "r_name"),
            F.col("c_nationkey") == F.col("n_nationkey"),
        )
        .join(lender, F.col("s_nationkey") == F.col("g_nationkey"))
        .drop("o_orderkey", "c_nationkey", "s_nationkey")
    )


def statements(
    spark: SparkSession, sf_dir: str, extra: tuple[str, ...] = ()
) -> DataFrame:
    """All statements in contract order, followed by ``extra`` source columns."""
    return statements_of(joined_lines(spark, sf_dir), extra)


def statements_of(joined: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Statements of joined line items, followed by ``extra`` source columns."""
    return _derived(joined).select(*contract.COLUMNS, *extra)


def _derived(joined: DataFrame) -> DataFrame:
    """Joined line items with the columns of the contract."""
    col = F.col
    principal, cancelled = col("original_principal_amount"), col("cancelled_amount")
    disbursed, due = col("disbursed_amount"), col("due_to_ibrd")
    open_share = F.when(
        col("l_linestatus") == "O", col("l_quantity") * F.lit(0.02)
    ).otherwise(F.lit(1.0))
    sold_share = F.when(col("l_suppkey") % 10 == 0, F.lit(0.1)).otherwise(F.lit(0.0))
    cents = col("o_totalprice") * 100
    given_back = F.when(
        col("l_returnflag") == "R", cents * col("l_discount") * 4
    ).otherwise(F.lit(0.0))

    # Each step uses columns of the one before it.
    return (
        joined.withColumns(
            {
                "end_of_period": col("l_shipdate").cast("date"),
                "loan_number": F.concat(F.lit("L"), col("l_orderkey").cast("string")),
                "region": col("r_name"),
                "country_code": _country_code("n_nationkey"),
                "country": col("n_name"),
                "borrower": col("c_name"),
                "guarantor_country_code": _country_code("g_nationkey"),
                "guarantor": col("g_name"),
                "loan_type": col("o_orderpriority"),
                "loan_status": col("o_orderstatus"),
                "currency_of_commitment": col("c_mktsegment"),
                "project_id": F.concat(
                    F.lit("P"), F.lpad(col("l_partkey").cast("string"), 6, "0")
                ),
                "project_name": col("p_name"),
                "interest_rate": (col("l_tax") * 100).cast(contract.RATE_TYPE),
                "service_charge_rate": (col("l_discount") * 10).cast(contract.RATE_TYPE),
                "original_principal_amount": _money(cents),
                "cancelled_amount": _money(given_back),
                "repaid_3rd_party": F.lit(0).cast(contract.MONEY_TYPE),
                "board_approval_date": col("o_orderdate").cast("date"),
            }
        )
        .withColumns(
            {
                "disbursed_amount": _money(
                    (principal - cancelled) * open_share.cast("decimal(3,2)")
                ),
                "agreement_signing_date": F.date_add("board_approval_date", "p_size"),
            }
        )
        .withColumns(
            {
                "undisbursed_amount": _money(principal - cancelled - disbursed),
                "repaid_to_ibrd": _money(
                    disbursed * (col("l_tax") * 10).cast("decimal(3,1)")
                ),
                "effective_date_most_recent": F.date_add("agreement_signing_date", 30),
            }
        )
        .withColumns(
            {
                "due_to_ibrd": _money(disbursed - col("repaid_to_ibrd")),
                "first_repayment_date": F.add_months("effective_date_most_recent", 60),
                "last_disbursement_date": F.greatest(
                    "effective_date_most_recent", "end_of_period"
                ),
            }
        )
        .withColumns(
            {
                "borrowers_obligation": due,
                "sold_3rd_party": _money(due * sold_share.cast("decimal(2,1)")),
                "last_repayment_date": F.add_months(
                    "first_repayment_date", col("l_linenumber") * 12
                ),
                "closed_date_most_recent": F.date_add("last_disbursement_date", 90),
            }
        )
        .withColumns(
            {
                "loans_held": _money(due - col("sold_3rd_party")),
                "due_3rd_party": col("sold_3rd_party"),
            }
        )
    )
