"""Calendar parts and calendar ranges.

Ranges compare the bare column with date literals, so that the predicate
reaches the Parquet scan for DATE and TIMESTAMP_NTZ columns alike.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def day(column: str | Column) -> Column:
    return _col(column).cast("date")


def between_days(column: str | Column, first: date, last: date) -> Column:
    """Whole days ``first`` .. ``last``, also for timestamps inside a day."""
    return half_open(column, first, date.fromordinal(last.toordinal() + 1))


def half_open(column: str | Column, start: date, end: date) -> Column:
    return (_col(column) >= F.lit(start)) & (_col(column) < F.lit(end))


def in_years(column: str | Column, first: int, last: int) -> Column:
    return half_open(column, date(first, 1, 1), date(last + 1, 1, 1))


def in_listed_years(column: str | Column, years: list[int]) -> Column:
    """One range for the scan, then the exact list."""
    return in_years(column, min(years), max(years)) & F.year(_col(column)).isin(list(years))


def quarter_start(column: str | Column) -> Column:
    return F.date_trunc("quarter", _col(column)).cast("date")


def quarter_bounds(when: date) -> tuple[date, date]:
    first_month = 3 * ((when.month - 1) // 3) + 1
    start = date(when.year, first_month, 1)
    end = date(when.year + 1, 1, 1) if first_month == 10 else date(when.year, first_month + 3, 1)
    return start, end


def month_label(column: str | Column) -> Column:
    return F.date_format(_col(column), "yyyy-MM")


def second_label(column: str | Column) -> Column:
    return F.date_format(_col(column), "yyyy-MM-dd HH:mm:ss")


def day_name(column: str | Column) -> Column:
    return F.date_format(_col(column), "EEEE")


def iso_week(column: str | Column) -> Column:
    return F.weekofyear(_col(column))


def month_end(column: str | Column) -> Column:
    return F.last_day(_col(column))
