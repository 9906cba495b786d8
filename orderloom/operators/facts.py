"""Fact rows of one batch from staged rows and stored dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions import expressions as x
from orderloom.operators.asof import asof_join


def calendar(dim_date: DataFrame) -> DataFrame:
    """Day and key of the date dimension, to be broadcast.

    The size is bounded by the calendar, whatever the orders: ten thousand years of
    12-byte rows come to 44 MB.
    """
    return F.broadcast(dim_date.select("date_id", "date_day"))


def fact_orders(
    orders: DataFrame, dim_customer: DataFrame, dim_date: DataFrame, dim_channel: DataFrame
) -> DataFrame:
    """Orders with their dimension keys; an unknown customer drops the order, a missing
    channel does not."""
    customer = dim_customer.select(
        F.col("customer_id").alias("customer_sk"), F.col("customer_nk").alias("customer_id")
    )
    return (
        orders.join(calendar(dim_date), F.col("order_date") == F.col("date_day"))
        .join(dim_channel, F.col("sales_channel") == F.col("channel_name"), "left")
        .join(customer, "customer_id")
        .select(
            F.col("order_id").alias("order_nk"),
            F.col("customer_sk").alias("customer_id"),
            "date_id",
            "channel_id",
            F.col("status").alias("order_status"),
            "currency",
            "delivery_method",
            "discount_amount",
        )
    )


def fact_order_items(items: DataFrame, orders: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Lines with order and product keys and their amounts, at the product's present cost.

    The order may come from an earlier batch; a line of an unknown order or product
    is dropped.
    """
    order = orders.select(F.col("order_id").alias("order_sk"), F.col("order_nk").alias("order_id"))
    product = dim_product.select("product_id", "part_sku", "cost_net")
    # Orders follow the lines: joined by shuffle at every size.
    return _measured(items.join(product, "part_sku").join(order.hint("merge"), "order_id"))


def order_day(orders: DataFrame) -> Column:
    """The day of a stored order, from its date key."""
    return F.to_date(orders["date_id"].cast("string"), "yyyyMMdd")


def fact_order_items_as_of(
    items: DataFrame, orders: DataFrame, dim_product: DataFrame, product_history: DataFrame
) -> DataFrame:
    """Lines as in ``fact_order_items``, at the cost that held on the day of their order.

    An order older than the first version of its part takes the present cost.
    """
    order = orders.select(
        F.col("order_id").alias("order_sk"), F.col("order_nk").alias("order_id"), order_day(orders).alias("order_day")
    )
    product = dim_product.select("product_id", "part_sku", F.col("cost_net").alias("present_cost"))
    # Orders follow the lines: joined by shuffle at every size.
    dated = items.join(order.hint("merge"), "order_id")
    costed = asof_join(dated, product_history, "part_sku", "order_day", ["cost_net"], days=order).join(product, "part_sku")
    return _measured(costed.withColumn("cost_net", F.coalesce("cost_net", "present_cost")))


def changed_parts(old_history: DataFrame, new_history: DataFrame) -> DataFrame:
    """(part_sku) of the parts whose cost on some day differs between two histories.

    A part's versions are one row on either side before they meet.
    """

    def timeline(versions: DataFrame, name: str) -> DataFrame:
        steps = F.sort_array(F.collect_list(F.struct("valid_from", "valid_to", "cost_net")))
        return versions.groupBy("part_sku").agg(steps.alias(name))

    both = timeline(old_history, "old").join(timeline(new_history, "new"), "part_sku", "full_outer")
    return both.where(~F.col("old").eqNullSafe(F.col("new"))).select("part_sku")


def margin_corrections(
    items: DataFrame, orders: DataFrame, dim_product: DataFrame, old_history: DataFrame, new_history: DataFrame
) -> DataFrame:
    """(order_item_nk, margin_amount, batch_date if it is there) of the stored lines whose margin a change of costs moves.

    Only lines of changed parts meet their order and their costs.
    """
    parts = changed_parts(old_history, new_history).join(
        dim_product.select("product_id", "part_sku", F.col("cost_net").alias("present_cost")), "part_sku"
    )
    batch = [c for c in ("batch_date",) if c in items.columns]
    lines = items.select("order_item_nk", "order_id", "product_id", "qty", "unit_price_net", "margin_amount", *batch)
    order = orders.select("order_id", order_day(orders).alias("order_day"))
    dated = lines.join(parts, "product_id").join(order.hint("merge"), "order_id")
    costed = asof_join(dated, new_history, "part_sku", "order_day", ["cost_net"], days=order)
    now = x.line_margin(F.col("qty"), F.col("unit_price_net"), F.coalesce("cost_net", "present_cost"))
    moved = costed.withColumn("_now", now).where(~F.col("_now").eqNullSafe(F.col("margin_amount")))
    return moved.select("order_item_nk", F.col("_now").alias("margin_amount"), *batch)


def with_margins(items: DataFrame, corrections: DataFrame) -> DataFrame:
    """Lines with corrected margins, and ``corrected``: whether there was one."""
    new = corrections.select("order_item_nk", F.col("margin_amount").alias("_margin"), F.lit(True).alias("_found"))
    joined = items.join(new, "order_item_nk", "left")
    margin = F.when(F.col("_found"), F.col("_margin")).otherwise(F.col("margin_amount"))
    columns = [margin.alias(c) if c == "margin_amount" else F.col(c) for c in items.columns]
    return joined.select(*columns, F.col("_found").isNotNull().alias("corrected"))


def _measured(lines: DataFrame) -> DataFrame:
    qty, net = F.col("qty"), F.col("unit_price_net")
    return lines.select(
        F.col("order_item_id").alias("order_item_nk"),
        F.col("order_sk").alias("order_id"),
        "product_id",
        "qty",
        "unit_price_net",
        "unit_price_gross",
        "discount_amount",
        "tax_amount",
        x.line_amount(qty, F.col("unit_price_gross")).alias("gross_amount"),
        x.line_amount(qty, net).alias("net_amount"),
        x.line_margin(qty, net, F.col("cost_net")).alias("margin_amount"),
    )
