"""Dimension rows from staged rows. Surrogates are added when a dimension is stored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions import expressions as x
from orderloom.operators.latest import latest_staged
from orderloom.operators.upsert import null_safe_match

GEOGRAPHY = ("country", "city", "postal_code")


def dates(orders: DataFrame) -> DataFrame:
    """One row per order day with its calendar attributes."""
    day = F.col("date_day")
    return (
        orders.select(F.col("order_date").alias("date_day"))
        .distinct()
        .select(
            x.date_key(day).alias("date_id"),
            "date_day",
            F.year(day).alias("year"),
            F.quarter(day).alias("quarter"),
            F.month(day).alias("month"),
            F.dayofmonth(day).alias("day"),
            F.weekofyear(day).alias("week"),
            x.iso_day_of_week(day).alias("day_of_week"),
        )
    )


def channels(orders: DataFrame) -> DataFrame:
    named = orders.where(F.col("sales_channel").isNotNull())
    return named.select(F.col("sales_channel").alias("channel_name")).distinct()


def geographies(customers: DataFrame) -> DataFrame:
    """Distinct places; a postal code alone names none."""
    placed = customers.where(F.col("country").isNotNull() | F.col("city").isNotNull())
    return placed.select(*GEOGRAPHY).distinct()


def customers(staged: DataFrame, geography: DataFrame) -> DataFrame:
    """Newest version of each customer, linked to its place with NULL matching NULL."""
    newest, place = latest_staged(staged, "customer_id").alias("newest"), geography.alias("place")
    return newest.join(place, null_safe_match("newest", "place", GEOGRAPHY), "left").select(
        F.col("customer_id").alias("customer_nk"),
        "email",
        "phone",
        "segment",
        "geography_id",
    )


def products(staged: DataFrame) -> DataFrame:
    return latest_staged(staged, "part_sku").drop("batch_date", "loaded_at")
