from datetime import date

from loanlens import contract

BASE = {
    "end_of_period": "2024-01-31",
    "loan_number": "L1",
    "region": "ASIA",
    "country_code": "01",
    "country": "Aland",
    "borrower": "Ministry",
    "guarantor_country_code": "02",
    "guarantor": "Bland",
    "loan_type": "FSL",
    "loan_status": "Repaying",
    "interest_rate": "2.5",
    "service_charge_rate": "0.5",
    "currency_of_commitment": "USD",
    "project_id": "P1",
    "project_name": "Roads",
    "original_principal_amount": "100.0",
    "cancelled_amount": "10.0",
    "undisbursed_amount": "20.0",
    "disbursed_amount": "70.0",
    "repaid_to_ibrd": "30.0",
    "due_to_ibrd": "40.0",
    "borrowers_obligation": "40.0",
    "sold_3rd_party": "0.0",
    "repaid_3rd_party": "0.0",
    "due_3rd_party": "0.0",
    "loans_held": "40.0",
    "first_repayment_date": "2010-01-15",
    "last_repayment_date": "2020-01-15",
    "agreement_signing_date": "2005-03-01",
    "board_approval_date": "2005-01-01",
    "effective_date_most_recent": "2005-06-01",
    "closed_date_most_recent": "2012-01-01",
    "last_disbursement_date": "2011-01-01",
}


def raw_rows(spark, *changes):
    """Raw text rows: the base row with each set of changes."""
    rows = [tuple({**BASE, **c}[k] for k in contract.COLUMNS) for c in changes]
    schema = ", ".join(f"{c} string" for c in contract.COLUMNS)
    return spark.createDataFrame(rows, schema)


def typed(row):
    def cell(column, value):
        if value is None:
            return None
        if column in contract.NUMERIC:
            return float(value)
        if column in contract.DATES and not isinstance(value, date):
            return date.fromisoformat(value)
        return value

    return tuple(cell(c, row[c]) for c in contract.COLUMNS)


def silver_rows(spark, *changes):
    """Typed Silver rows: the base row with each set of changes."""

    def kind(column):
        if column in contract.NUMERIC:
            return "double"
        return "date" if column in contract.DATES else "string"

    schema = ", ".join(f"{c} {kind(c)}" for c in contract.COLUMNS)
    return spark.createDataFrame([typed({**BASE, **c}) for c in changes], schema)


def bronze_line(**changes):
    row = {**BASE, **changes}
    return ",".join("" if row[c] is None else str(row[c]) for c in contract.COLUMNS)


def write_csv(path, lines, header=None):
    path.parent.mkdir(parents=True, exist_ok=True)
    text = [",".join(header or contract.BRONZE_HEADER), *lines]
    path.write_text("\n".join(text) + "\n", encoding="utf-8")
