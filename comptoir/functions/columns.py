"""Business rules as column expressions; all of them stay in whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def identifier(name: str) -> Column:
    """Identifiers are compared without case and surrounding spaces."""
    return F.upper(F.trim(F.col(name)))


def blank(value: Column) -> Column:
    return F.trim(value) == ""


def missing(name: str, data_type: str) -> Column:
    """True for null and, in text columns, for a value of spaces only."""
    value = F.col(name)
    return value.isNull() | blank(value) if data_type == "string" else value.isNull()


def city_standard(value: Column) -> Column:
    """'  PARIS ' becomes 'Paris'; a blank city becomes null."""
    return F.nullif(F.initcap(F.trim(value)), F.lit(""))


def strict_date(value: Column) -> Column:
    """Nearly all dates have the plain form, which a cast reads several times as fast as a pattern; others go by the pattern."""
    plain = value.rlike(r"^[1-9][0-9]{3}-[0-9]{2}-[0-9]{2}\z")
    return F.when(plain, value.try_cast("date")).otherwise(F.try_to_date(value, "yyyy-MM-dd"))


def whole_number(value: Column) -> Column:
    """Integer held in a text such as '3.0'; null for anything else, also beyond the int range."""
    number = value.try_cast("double")
    whole = number.try_cast("int")
    return F.when(whole == number, whole)


def line_amount(quantity: Column, price: Column) -> Column:
    return F.round(quantity * price, 2)


def total_amount(amount: Column) -> Column:
    """Sum of two-decimal amounts, the same whatever order the rows arrive in.

    Amounts are summed as decimals. What is no decimal of 38 digits (NaN, infinities, 10**36 and more)
    is added as a double.
    """
    exact = amount.try_cast("decimal(38,2)")
    outside = F.sum(F.when(exact.isNull(), amount))
    total = F.try_sum(exact).cast("double")
    return F.round(F.when(outside.isNull(), total)
                   .otherwise(F.coalesce(total, F.lit(0.0)) + outside), 2)


def joined_labels(labels: list[tuple[Column, str]], before: Column | None = None) -> Column:
    """Comma-separated labels whose condition holds, after an optional existing list."""
    parts = [] if before is None else [before]
    parts += [F.when(condition, F.lit(label)) for condition, label in labels]
    return F.nullif(F.concat_ws(", ", *parts), F.lit(""))
