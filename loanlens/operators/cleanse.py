"""Raw text to typed, filled Silver columns.

Raw text is typed with the ``try_`` functions: what cannot be read becomes NULL and
is then filled, while ANSI mode stays on for everything else.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens import contract
from loanlens.operators.dedup import latest_loans

# Declared defaults per dimension attribute.
DIMENSION_DEFAULTS = {
    table: {f.name: f.default for f in fields if f.default is not None}
    for table, fields in contract.WAREHOUSE.items()
    if any(f.default is not None for f in fields)
}


def standard_name(name: str) -> str:
    """Snake-case form; apostrophes join the letters around them."""
    plain = re.sub(r"['’]", "", name.strip())
    return re.sub(r"[^a-zA-Z0-9]+", "_", plain).strip("_").lower()


def standardize_names(df: DataFrame) -> DataFrame:
    """Renames all columns at once; two columns with one name are an error."""
    names = [standard_name(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"columns share a name after standardisation: {clashes}")
    return df.toDF(*names)


def _fits(column: str, name: str | None = None) -> Column:
    """Whether a text is a plain decimal number that fits the column's declared type.

    The cast to that type is the whole test: it refuses the words a cast to double would
    take for numbers (NaN, Infinity, a trailing d) and values Gold could not hold.
    """
    kind = contract.RATE_TYPE if (name or column) in contract.RATES else contract.MONEY_TYPE
    return F.col(column).try_cast(kind).isNotNull()


def number_from_text(column: str, name: str | None = None) -> Column:
    """Number of a plain decimal text that fits the column's declared type, else NULL.

    ``name`` is the column's standard name, if it has another.
    What Gold could not hold is lost here, where it is counted, not there.  Texts that
    fit keep all their digits.
    """
    return F.when(_fits(column, name), F.col(column).try_cast("double"))


def date_from_text(column: str) -> Column:
    """Date of a text in any of the known patterns, else NULL.

    Each pattern has a character the others lack, so one look at the text picks the
    only pattern that can match instead of failing through all four per value.
    """
    text = F.col(column)
    iso_millis, iso, slashed, plain = (
        F.try_to_date(text, fmt) for fmt in contract.DATE_FORMATS
    )
    return (
        F.when(text.contains("/"), slashed)
        .when(text.contains("T") & text.contains("."), iso_millis)
        .when(text.contains("T"), iso)
        .otherwise(plain)
    )


def is_unreadable(column: str) -> Column:
    """Whether a text is there but is no number, or no date, of its column."""
    text = F.col(column)
    read = _fits(column) if column in contract.NUMERIC else date_from_text(column).isNotNull()
    return text.isNotNull() & ~read


def cast_numbers(df: DataFrame) -> DataFrame:
    present = [c for c in contract.NUMERIC if c in df.columns]
    return df.withColumns({c: number_from_text(c) for c in present})


def parse_dates(df: DataFrame) -> DataFrame:
    present = [c for c in contract.DATES if c in df.columns]
    return df.withColumns({c: date_from_text(c) for c in present})


def fill_defaults(df: DataFrame) -> DataFrame:
    """Missing numbers become 0, missing categories 'Unknown'; dates stay missing."""
    defaults = {c: 0.0 for c in contract.NUMERIC} | {
        c: "Unknown" for c in contract.CATEGORICAL
    }
    return df.fillna({c: v for c, v in defaults.items() if c in df.columns})


def fill_dimension(df: DataFrame, table: str) -> DataFrame:
    """Defaults of one dimension; only reached by rows that skipped Silver."""
    return df.fillna(DIMENSION_DEFAULTS[table])


def trim_text(df: DataFrame) -> DataFrame:
    """Trims every text column."""
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.trim(c) for c in text})


def warehouse_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Casts to declared types; ``_cast_failures`` counts the values lost per row."""
    present = {c: t for c, t in types.items() if c in df.columns}
    typed = {c: F.col(c).try_cast(t) for c, t in present.items()}
    lost = [
        (F.col(c).isNotNull() & typed[c].isNull()).cast("int") for c in present
    ]
    failures = sum(lost[1:], lost[0]) if lost else F.lit(0)
    return df.select(
        *[typed[c].alias(c) if c in typed else F.col(c) for c in df.columns],
        failures.alias("_cast_failures"),
    )


def typed_rows(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Raw text rows under contract names, typed and filled, duplicates included.

    ``keep`` names further columns, in standard form, that stay as they are.

    Columns of the contract that a file lacks are added as missing, so they are
    filled and reported rather than silently absent downstream.
    """
    named = standardize_names(raw)
    lacking = [c for c in contract.COLUMNS if c not in named.columns]
    named = named.withColumns({c: F.lit(None).cast("string") for c in lacking})
    filled = fill_defaults(parse_dates(cast_numbers(named)))
    return filled.select(*contract.COLUMNS, *keep)


def cleanse(raw: DataFrame) -> DataFrame:
    """Raw text rows to Silver rows, one per loan."""
    return latest_loans(typed_rows(raw))
