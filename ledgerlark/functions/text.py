"""Text functions whose rules differ from the Spark built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def same_text(left: str | Column, right: str | Column) -> Column:
    """Equality that ignores case; a plain string on the right is a literal."""
    right = F.lit(right) if isinstance(right, str) else right
    return F.lower(_col(left)) == F.lower(right)


def one_of(column: str | Column, names: list[str]) -> Column:
    return F.lower(_col(column)).isin([name.lower() for name in names])


def matches(column: str | Column, pattern: str) -> Column:
    """``LIKE`` with both sides lowered."""
    return F.lower(_col(column)).like(pattern.lower())


def merged(first: str | Column, second: str | Column) -> Column:
    """``first``, or ``first, second`` where the second part is not blank."""
    first, second = _col(first), _col(second)
    return F.when(second.isNull() | (second == ""), first).otherwise(
        F.concat(first, F.lit(", "), second)
    )


def joined(*parts: str | Column) -> Column:
    """Concatenation in which NULL counts as the empty text."""
    columns = [_col(part).cast("string") for part in parts]
    return F.concat(*[F.coalesce(column, F.lit("")) for column in columns])


def capitalised(column: str | Column) -> Column:
    """Capital first letter of every run of letters or digits, rest lowered."""
    runs = F.regexp_extract_all(
        F.lower(_col(column)), F.lit(r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"), F.lit(0)
    )
    return F.array_join(
        F.transform(runs, lambda run: F.concat(F.upper(F.left(run, F.lit(1))), F.substr(run, F.lit(2)))),
        "",
    )


def mapped(column: str | Column, labels: dict, default: str | None = None) -> Column:
    """CASE mapping from exact values to labels; no match gives ``default``."""
    column = _col(column)
    result = None
    for value, label in labels.items():
        if result is None:
            result = F.when(column == value, F.lit(label))
        else:
            result = result.when(column == value, F.lit(label))
    return result if default is None else result.otherwise(F.lit(default))
