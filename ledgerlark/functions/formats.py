"""Report masks. Every mask rounds half away from zero before formatting,
because ``format_number`` alone rounds half to even."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _masked(value: Column, mask: str) -> Column:
    return F.call_function("format_number", value, F.lit(mask))


def plain_amount(value: str | Column, digits: int = 2) -> Column:
    """``1234.50``; zero prints as ``.00``."""
    return _masked(F.round(_col(value), digits), "#." + "0" * digits)


def grouped_integer(value: str | Column) -> Column:
    """``1,234,567``."""
    return _masked(F.round(_col(value), 0), "#,##0")


def percent(value: str | Column, digits: int = 2) -> Column:
    """``12.50 %`` with at least one digit before the point; NULL stays NULL."""
    return F.concat(_masked(F.round(_col(value), digits), "##0." + "0" * digits), F.lit(" %"))


def plain_percent(value: str | Column, digits: int = 4) -> Column:
    """``12.3456 %``; below one the leading zero is left out."""
    return F.concat(plain_amount(value, digits), F.lit(" %"))
