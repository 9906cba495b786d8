"""Cleaning of landed rows: required keys, newest version, typed and normalised columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions import expressions as x
from orderloom.operators.latest import latest_landed


def _with_keys(raw: DataFrame, *keys: str) -> DataFrame:
    for key in keys:
        raw = raw.where(F.col(key).isNotNull())
    return raw


def clean_orders(raw: DataFrame) -> DataFrame:
    kept = _with_keys(raw, "order_id", "customer_id", "order_created_at")
    return latest_landed(kept, "order_id").select(
        "order_id",
        "customer_id",
        F.col("order_created_at").cast("timestamp_ntz").alias("order_created_at"),
        F.col("order_created_at").cast("date").alias("order_date"),
        x.order_status("status").alias("status"),
        x.lower_trimmed("sales_channel").alias("sales_channel"),
        x.upper_trimmed("currency").alias("currency"),
        x.money_or_zero("discount_amount").alias("discount_amount"),
        "delivery_method",
        "batch_date",
    )


def clean_order_items(raw: DataFrame) -> DataFrame:
    """Lines with a positive quantity. Prices keep their NULLs, discount and tax do not."""
    kept = _with_keys(raw, "order_item_id", "order_id", "part_sku").where(x.positive_number("qty"))
    return latest_landed(kept, "order_item_id").select(
        "order_item_id",
        "order_id",
        F.col("line_no").cast("int").alias("line_no"),
        "part_sku",
        F.col("qty").cast(x.QUANTITY).alias("qty"),
        x.money("unit_price_net").alias("unit_price_net"),
        x.money("unit_price_gross").alias("unit_price_gross"),
        x.money_or_zero("discount_amount").alias("discount_amount"),
        x.money_or_zero("tax_amount").alias("tax_amount"),
        "batch_date",
    )


def clean_customers(raw: DataFrame) -> DataFrame:
    kept = _with_keys(raw, "customer_id")
    return latest_landed(kept, "customer_id").select(
        "customer_id",
        F.lower(x.clean_text("email")).alias("email"),
        x.clean_text("phone").alias("phone"),
        x.lower_trimmed("segment").alias("segment"),
        x.clean_text("country").alias("country"),
        x.clean_text("city").alias("city"),
        x.clean_text("postal_code").alias("postal_code"),
        x.clean_text("street").alias("street"),
        "batch_date",
    )


def clean_products(raw: DataFrame) -> DataFrame:
    kept = _with_keys(raw, "part_sku")
    return latest_landed(kept, "part_sku").select(
        "part_sku",
        "part_name",
        x.lower_trimmed("category").alias("category"),
        "brand",
        "manufacturer",
        x.clean_text("oe_number").alias("oe_number"),
        x.clean_text("compatible_make").alias("compatible_make"),
        x.clean_text("compatible_model").alias("compatible_model"),
        x.blank_to_null("compatible_year_from").cast("int").alias("compatible_year_from"),
        x.blank_to_null("compatible_year_to").cast("int").alias("compatible_year_to"),
        x.money_or_zero("cost_net").alias("cost_net"),
        x.money_or_zero("price_net").alias("price_net"),
        "batch_date",
    )


# Staging table -> (landing table, cleaner), in load order.
CLEANERS = {
    "orders_clean": ("orders", clean_orders),
    "order_items_clean": ("order_items", clean_order_items),
    "customers_clean": ("customers", clean_customers),
    "products_clean": ("products", clean_products),
}
