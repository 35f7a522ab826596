"""Column contract of the loan data: names, order, types, defaults and lengths.

Every value in this module is a fixed value of the data format.  Changing one
changes what files can be read and what tables look like.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T

# Header of a raw statement file, in file order.
BRONZE_HEADER = [
    "End of Period",
    "Loan Number",
    "Region",
    "Country Code",
    "Country",
    "Borrower",
    "Guarantor Country Code",
    "Guarantor",
    "Loan Type",
    "Loan Status",
    "Interest Rate",
    "Service Charge Rate",
    "Currency of Commitment",
    "Project ID",
    "Project Name",
    "Original Principal Amount",
    "Cancelled Amount",
    "Undisbursed Amount",
    "Disbursed Amount",
    "Repaid to IBRD",
    "Due to IBRD",
    "Borrower's Obligation",
    "Sold 3rd Party",
    "Repaid 3rd Party",
    "Due 3rd Party",
    "Loans Held",
    "First Repayment Date",
    "Last Repayment Date",
    "Agreement Signing Date",
    "Board Approval Date",
    "Effective Date (Most Recent)",
    "Closed Date (Most Recent)",
    "Last Disbursement Date",
]

# The same columns after name standardisation.
COLUMNS = [
    "end_of_period",
    "loan_number",
    "region",
    "country_code",
    "country",
    "borrower",
    "guarantor_country_code",
    "guarantor",
    "loan_type",
    "loan_status",
    "interest_rate",
    "service_charge_rate",
    "currency_of_commitment",
    "project_id",
    "project_name",
    "original_principal_amount",
    "cancelled_amount",
    "undisbursed_amount",
    "disbursed_amount",
    "repaid_to_ibrd",
    "due_to_ibrd",
    "borrowers_obligation",
    "sold_3rd_party",
    "repaid_3rd_party",
    "due_3rd_party",
    "loans_held",
    "first_repayment_date",
    "last_repayment_date",
    "agreement_signing_date",
    "board_approval_date",
    "effective_date_most_recent",
    "closed_date_most_recent",
    "last_disbursement_date",
]

MONEY = [
    "original_principal_amount",
    "cancelled_amount",
    "undisbursed_amount",
    "disbursed_amount",
    "repaid_to_ibrd",
    "due_to_ibrd",
    "borrowers_obligation",
    "sold_3rd_party",
    "repaid_3rd_party",
    "due_3rd_party",
    "loans_held",
]
RATES = ["interest_rate", "service_charge_rate"]
NUMERIC = MONEY + RATES
DATES = [
    "end_of_period",
    "first_repayment_date",
    "last_repayment_date",
    "agreement_signing_date",
    "board_approval_date",
    "effective_date_most_recent",
    "closed_date_most_recent",
    "last_disbursement_date",
]
CATEGORICAL = [
    c for c in COLUMNS if c not in NUMERIC and c not in DATES and c != "loan_number"
]

# Date patterns of raw files, in order of preference.
DATE_FORMATS = [
    "yyyy-MM-dd'T'HH:mm:ss.SSS",
    "yyyy-MM-dd'T'HH:mm:ss",
    "MM/dd/yyyy",
    "yyyy-MM-dd",
]

CORRUPT = "_corrupt_record"
PARTITION_COLUMN = "country_code"

MONEY_TYPE = T.DecimalType(18, 2)
RATE_TYPE = T.DecimalType(8, 4)

# Columns of a high-risk alert, in order.
ALERT_COLUMNS = [
    "loan_number",
    "country",
    "borrower",
    "project_name",
    "original_principal_amount",
    "cancelled_amount",
    "cancellation_ratio",
    "risk_level",
    "loan_status",
    "board_approval_date",
    "ingestion_timestamp",
    "source_file",
]


class Field(NamedTuple):
    """A warehouse column: declared type, length limit, NOT NULL and default."""

    name: str
    type: str
    length: int | None = None
    required: bool = False
    default: str | None = None


# Declared warehouse tables.
WAREHOUSE = {
    "dim_country": [
        Field("country_key", "bigint", required=True),
        Field("country_code", "string", 10, True),
        Field("country", "string", 200, True, "Unknown"),
        Field("region", "string", 200, True, "Unknown"),
        Field("guarantor_country_code", "string", 10, False, "N/A"),
        Field("guarantor", "string", 200, False, "N/A"),
    ],
    "dim_project": [
        Field("project_key", "bigint", required=True),
        Field("project_id", "string", 50, True),
        Field("project_name", "string", 500, True, "Unknown Project"),
    ],
    "dim_loan_type": [
        Field("loan_type_key", "bigint", required=True),
        Field("loan_type", "string", 50, True, "Unknown"),
        Field("loan_status", "string", 100, True, "Unknown"),
        Field("currency_of_commitment", "string", 10, True, "USD"),
    ],
    "dim_borrower": [
        Field("borrower_key", "bigint", required=True),
        Field("borrower", "string", 500, True, "Unknown Borrower"),
        Field("country_code", "string", 10, False, "N/A"),
    ],
    "fact_loans": [
        Field("loan_fact_key", "bigint", required=True),
        Field("country_key", "bigint"),
        Field("project_key", "bigint"),
        Field("loan_type_key", "bigint"),
        Field("borrower_key", "bigint"),
        Field("loan_number", "string", 50),
        Field("end_of_period", "date"),
        Field("board_approval_date", "date"),
        Field("effective_date_most_recent", "date"),
        Field("closed_date_most_recent", "date"),
        Field("agreement_signing_date", "date"),
        Field("first_repayment_date", "date"),
        Field("last_repayment_date", "date"),
        Field("last_disbursement_date", "date"),
        Field("original_principal_amount", "decimal(18,2)"),
        Field("cancelled_amount", "decimal(18,2)"),
        Field("undisbursed_amount", "decimal(18,2)"),
        Field("disbursed_amount", "decimal(18,2)"),
        Field("repaid_to_ibrd", "decimal(18,2)"),
        Field("due_to_ibrd", "decimal(18,2)"),
        Field("borrowers_obligation", "decimal(18,2)"),
        Field("sold_3rd_party", "decimal(18,2)"),
        Field("repaid_3rd_party", "decimal(18,2)"),
        Field("due_3rd_party", "decimal(18,2)"),
        Field("loans_held", "decimal(18,2)"),
        Field("interest_rate", "decimal(8,4)"),
        Field("service_charge_rate", "decimal(8,4)"),
    ],
}

# Surrogate key first, then the natural key of each warehouse table.
KEYS = {
    "dim_country": ("country_key", ["country_code"]),
    "dim_project": ("project_key", ["project_id"]),
    "dim_loan_type": (
        "loan_type_key",
        ["loan_type", "loan_status", "currency_of_commitment"],
    ),
    "dim_borrower": ("borrower_key", ["borrower"]),
    "fact_loans": ("loan_fact_key", ["loan_number"]),
}

# Physical order of the tables that are filtered most.
CLUSTERING = {
    "fact_loans": ["country_key", "board_approval_date"],
    "dim_country": ["region"],
}


def names(table: str) -> list[str]:
    return [f.name for f in WAREHOUSE[table]]


def table_schema(table: str) -> T.StructType:
    """Schema of a Gold table; nullability is checked by the quality operators."""
    return T.StructType(
        [T.StructField(f.name, T.DataType.fromDDL(f.type)) for f in WAREHOUSE[table]]
    )


def bronze_schema(header: list[str]) -> T.StructType:
    """All columns as text plus the column that receives malformed lines."""
    return T.StructType([T.StructField(c, T.StringType()) for c in [*header, CORRUPT]])


def silver_schema() -> T.StructType:
    """Typed Silver columns, the partition column last as Spark reads it."""

    def kind(column: str) -> T.DataType:
        if column in NUMERIC:
            return T.DoubleType()
        return T.DateType() if column in DATES else T.StringType()

    ordered = [c for c in COLUMNS if c != PARTITION_COLUMN] + [PARTITION_COLUMN]
    return T.StructType([T.StructField(c, kind(c)) for c in ordered])
