"""Row and column access as filters and projections for a principal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def principal_name(first_name: str | Column, last_name: str | Column) -> Column:
    """``client_{first}_{last}``, lowered."""
    return F.lower(F.concat_ws("_", F.lit("client"), first_name, last_name))


def first_active_principal(customer: DataFrame, rental: DataFrame, payment: DataFrame) -> DataFrame:
    """One row: the principal of the first customer with a rental and a payment."""
    return (
        customer.join(rental.select("customer_id"), "customer_id", "left_semi")
        .join(payment.select("customer_id"), "customer_id", "left_semi")
        .orderBy("customer_id")
        .limit(1)
        .select(principal_name(F.col("first_name"), F.col("last_name")).alias("principal"))
    )


def own_customer(customer: DataFrame, principal: DataFrame) -> Column:
    """The customer id that belongs to the one-row relation ``principal``, as a
    scalar subquery, which is known before the tables it filters are scanned."""
    name = principal.limit(1).select(F.lower("principal")).scalar()
    named = customer.where(principal_name(F.col("first_name"), F.col("last_name")) == name)
    return named.agg(F.min("customer_id")).scalar()


def own_rows(table: DataFrame, customer: DataFrame, principal: DataFrame) -> DataFrame:
    """Rows of the principal's own customer; every other row is silently absent.

    Apply it before any filter of the user, so that asking for another
    customer's rows gives no rows and no error.
    """
    return table.where(F.col("customer_id") == own_customer(customer, principal))


def visible(table: DataFrame, allowed: list[str], wanted: list[str] | None = None) -> DataFrame:
    """Column subset; asking for another column is an error."""
    refused = [column for column in wanted or [] if column not in allowed]
    if refused:
        raise PermissionError(f"no access to columns {refused}")
    return table.select(*(wanted or allowed))
