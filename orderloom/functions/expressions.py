"""Text, number, date and measure expressions. All stay inside generated code."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# The order states the warehouse knows, and what anything else becomes.
ORDER_STATUSES = ("new", "paid", "shipped", "returned", "cancelled")
DEFAULT_STATUS = "new"

MONEY = "decimal(14,2)"
QUANTITY = "decimal(14,3)"


def blank_to_null(column: str) -> Column:
    """Empty text as NULL, without trimming: blanks around a number are left to the cast."""
    return F.nullif(F.col(column), F.lit(""))


def clean_text(column: str) -> Column:
    """Trimmed text, NULL when nothing is left."""
    return F.nullif(F.trim(F.col(column)), F.lit(""))


def lower_trimmed(column: str) -> Column:
    """Trimmed lower-case text; blank text stays blank."""
    return F.lower(F.trim(F.col(column)))


def upper_trimmed(column: str) -> Column:
    return F.upper(F.trim(F.col(column)))


def order_status(column: str) -> Column:
    """The known state in lower case; unknown, padded or missing text is a new order."""
    lowered = F.lower(F.col(column))
    return F.when(lowered.isin(*ORDER_STATUSES), lowered).otherwise(F.lit(DEFAULT_STATUS))


def money(column: str) -> Column:
    return F.col(column).cast(MONEY)


def money_or_zero(column: str) -> Column:
    """Blank or missing text as 0.00; bad text still raises."""
    return F.coalesce(blank_to_null(column).cast(MONEY), F.lit(0).cast(MONEY))


def positive_number(column: str) -> Column:
    """True for text above zero, however little; text that is no number raises.

    The cast settles what a number is but rounds to its scale, so the digits decide: no
    minus, and one of them before any exponent is not zero.
    """
    not_below = F.col(column).cast("decimal(38,18)") >= F.lit(0)
    return not_below & F.col(column).rlike(r"^\s*\+?[0-9.]*[1-9]")


def timestamp_literal(moment: datetime) -> Column:
    """A zone-less timestamp literal that no session time zone can shift."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def date_key(day: Column) -> Column:
    """The day as yyyymmdd: unique per date, sortable, the same in every run."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("bigint")


def iso_day_of_week(day: Column) -> Column:
    """1 for Monday to 7 for Sunday."""
    return F.weekday(day) + F.lit(1)


def month_number(day: Column) -> Column:
    """Months since year 0, so that months subtract as integers."""
    return F.year(day) * 12 + F.month(day) - 1


def month_start(number: Column) -> Column:
    """First day of a ``month_number``."""
    return F.make_date(F.floor(number / 12).cast("int"), number % 12 + 1, F.lit(1))


def line_amount(quantity: Column, price: Column) -> Column:
    """Quantity times price, rounded once."""
    return (quantity * price).cast(MONEY)


def line_margin(quantity: Column, price: Column, cost: Column) -> Column:
    """Net value less cost, rounded once at the end and not per term."""
    return (quantity * price - quantity * cost).cast(MONEY)


def average(total: Column, count: Column) -> Column:
    """Decimal mean with 16 digits after the point; NULL for no rows."""
    return total / F.nullif(count, F.lit(0)).cast("decimal(20,0)")
