"""Text masks of the report measures.

Values are rounded half away from zero before they are printed, because number
formatting alone rounds half to even.  The rounding is done in decimal, where the last
bits of a double (4.225 held as 4.2249999999999996) do not decide.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NOT_AVAILABLE = "N/A"


def _rounded(value: Column, places: int) -> Column:
    return F.round(value.cast("decimal(30,10)"), places)


def _money(value: Column, places: int, unit: str) -> Column:
    rounded = _rounded(value, places)
    sign = F.when(rounded < 0, "-").otherwise("")
    return F.concat(
        sign, F.lit("$"), F.format_number(F.abs(rounded), places), F.lit(unit)
    )


def billions(value: Column) -> Column:
    """``$#,##0.00B`` of a value already in billions."""
    return _money(value, 2, "B")


def millions(value: Column) -> Column:
    """``$#,##0.00M`` of a value already in millions."""
    return _money(value, 2, "M")


def dollars(value: Column) -> Column:
    """``$#,##0``; a missing value prints as ``$0``."""
    return _money(F.coalesce(value, F.lit(0.0)), 0, "")


def percent(share: Column, places: int = 2) -> Column:
    """``0.00%`` (or ``0.0%``) of a share; a missing share prints as ``N/A``."""
    rounded = _rounded(share * 100, places).cast("double")
    text = F.format_string(f"%.{places}f%%", rounded)
    return F.when(share.isNull(), NOT_AVAILABLE).otherwise(text)


def signed_percent(share: Column) -> Column:
    """``+0.0%;-0.0%;0.0%`` of a share; a missing share prints as ``N/A``."""
    text = percent(share, 1)
    return F.when(_rounded(share * 100, 1) > 0, F.concat(F.lit("+"), text)).otherwise(text)


def rate_percent(rate: Column) -> Column:
    """``0.00%`` of a rate that is already in percent units."""
    return percent(rate / 100, 2)
