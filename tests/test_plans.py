"""Physical plans: pruning, pushdown, map-side folding, and splitting of hot keys."""

from __future__ import annotations

import re
from contextlib import contextmanager
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from orderloom.operators import clean, dimensions, facts, marts
from orderloom.operators.upsert import KeyList, rows_with_keys
from orderloom.plans.registry import QUERIES
from orderloom.plans.warehouse import Warehouse
from orderloom.session import settle
from orderloom.sources import landing
from orderloom.sources import sample_tables as sample

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """The plan as adapted while running."""
    executed = df._jdf.queryExecution().executedPlan()
    executed.execute().count()
    return executed.toString()


@contextmanager
def settings(spark, **conf):
    conf = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


# Small tables stand for large ones: nothing is broadcast by size, partitions stay apart,
# and a partition is hot at a few kilobytes.
LARGE = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__maxShuffledHashJoinLocalMapThreshold": "0",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2.0",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "4k",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "4k",
    "spark__sql__adaptive__coalescePartitions__enabled": "false",
}


@pytest.mark.parametrize("name", ["orders", "order_items", "customers", "products"])
def test_keep_latest_is_cut_before_and_after_the_shuffle(spark, name):
    cleaner = {raw: fn for raw, fn in clean.CLEANERS.values()}[name]
    text = plan(cleaner(sample.LANDED[name](spark, FOLDER)))
    assert len(re.findall(r"WindowGroupLimit .*Partial", text)) == 1
    assert len(re.findall(r"WindowGroupLimit .*Final", text)) == 1


def test_batch_filter_prunes_partitions(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    orders = sample.landed_orders(spark, FOLDER)
    for day in ("2001-12-30", "2001-12-31"):
        warehouse.append_raw("orders", landing.land(orders, day, datetime(2002, 1, 1)))
    one = warehouse.raw("orders").where(F.col("batch_date") == F.lit("2001-12-31").cast("date"))
    named = warehouse.raw("orders", ["2001-12-31", "2002-01-01"])
    assert {f.split("/")[-2] for f in named.inputFiles()} == {"batch_date=2001-12-31"}
    assert named.count() == one.count() > 0 and named.columns == one.columns
    text = plan(clean.clean_orders(one))
    assert re.search(r"PartitionFilters: \[isnotnull\(batch_date#\d+\), \(batch_date#\d+ = 2001-12-31\)\]", text)
    assert "IsNotNull(order_id)" in text


def test_staging_scan_skips_files_by_load_time(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    rows = clean.clean_orders(sample.landed_orders(spark, FOLDER))
    warehouse.replace_staged("orders_clean", rows, "2001-12-31", datetime(2002, 1, 1))
    newer = warehouse.staged("orders_clean").where("loaded_at > timestamp_ntz'2002-01-02 00:00:00'")
    assert "GreaterThan(loaded_at,2002-01-02T00:00)" in plan(dimensions.dates(newer))


def test_key_lookup_pushes_its_range_into_the_scan(spark, tmp_path):
    held = settle(spark.range(100).select(F.col("id").cast("string").alias("order_nk"), "id"))
    keys = spark.createDataFrame([("10",), ("20",)], "order_nk string")
    many = spark.range(1_500_000).select(F.col("id").cast("string").alias("order_nk"))
    for wanted in (keys, many):
        text = plan(rows_with_keys(held, KeyList(wanted, "10", "20")))
        assert "GreaterThanOrEqual(order_nk,10), LessThanOrEqual(order_nk,20)" in text
        assert "LeftSemi" in text


def test_scans_read_only_what_a_mart_needs(spark):
    text = QUERIES["mart_cohort_retention"](spark, FOLDER)
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan(text))
    assert sorted(schemas) == ["o_custkey:bigint,o_orderdate:timestamp_ntz", "o_orderdate:timestamp_ntz"]


@pytest.mark.parametrize(
    "name",
    [
        "mart_daily_sales", "mart_top_parts", "mart_margin_by_category", "mart_cohort_retention",
        "mart_cohort_retention_full", "mart_rfm_segments", "dq_order_sum_mismatch", "contract_checks",
    ],
)
def test_groups_are_folded_before_every_shuffle(spark, name):
    with settings(spark, **LARGE):
        text = plan(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    # A final aggregate sits on an exchange whose input is its own partial.
    finals = re.findall(r"HashAggregate\(keys=\[[^]]+\], functions=\[(?!partial_|\])[^]]", text)
    partials = re.findall(r"HashAggregate\(keys=\[[^]]+\], functions=\[partial_", text)
    assert len(partials) >= len(finals) > 0
    assert "distinct" not in text.lower().replace("isnotdistinct", "")


def test_cohorts_cross_one_wide_shuffle(spark):
    with settings(spark, **LARGE):
        text = plan(QUERIES["mart_cohort_retention"](spark, FOLDER))
    assert len(re.findall(r"Exchange hashpartitioning\(customer_id", text)) == 1
    assert "SortMergeJoin" not in text and "Window" not in text


def hot_batch(spark):
    """Staged orders, customers and lines; one customer, order and part hold a third of all."""
    keys = spark.range(60_000).withColumn("hot", F.col("id") % 3 == 0)
    orders = keys.select(
        F.concat(F.lit("O"), "id").alias("order_id"),
        F.when(F.col("hot"), "C0").otherwise(F.concat(F.lit("C"), F.col("id") % 997)).alias("customer_id"),
        F.lit("2026-01-01").cast("date").alias("order_date"),
        F.lit("paid").alias("status"),
        F.lit("web").alias("sales_channel"),
        F.lit("PLN").alias("currency"),
        F.lit(0).cast("decimal(14,2)").alias("discount_amount"),
        F.lit("courier").alias("delivery_method"),
    )
    one = F.lit(1).cast("decimal(14,2)")
    lines = keys.select(
        F.concat(F.lit("I"), "id").alias("order_item_id"),
        F.when(F.col("hot"), "O0").otherwise(F.concat(F.lit("O"), F.col("id"))).alias("order_id"),
        F.when(F.col("hot"), "S0").otherwise(F.concat(F.lit("S"), F.col("id") % 997)).alias("part_sku"),
        F.lit(1).cast("decimal(14,3)").alias("qty"),
        *[one.alias(c) for c in ("unit_price_net", "unit_price_gross", "discount_amount", "tax_amount")],
    )
    ids = spark.range(997)
    customers = ids.select(F.col("id").alias("customer_id"), F.concat(F.lit("C"), "id").alias("customer_nk"))
    products = ids.select(
        F.col("id").alias("product_id"),
        F.concat(F.lit("S"), "id").alias("part_sku"),
        F.lit(0).cast("decimal(14,2)").alias("cost_net"),
    )
    channels = spark.range(1).select(F.col("id").alias("channel_id"), F.lit("web").alias("channel_name"))
    return orders, lines, customers, products, channels


def test_hot_keys_of_the_fact_joins_are_split(spark):
    orders, lines, customers, products, channels = hot_batch(spark)
    numbered = orders.select(F.expr("cast(substring(order_id, 2) as bigint)").alias("order_id"),
                             F.col("order_id").alias("order_nk"))
    with settings(spark, **LARGE):
        loaded = facts.fact_orders(orders, customers, dimensions.dates(orders), F.broadcast(channels))
        assert "SortMergeJoin(skew=true)" in final_plan(loaded)
        text = final_plan(facts.fact_order_items(lines, numbered, products))
        assert text.count("SortMergeJoin(skew=true)") >= 2
        assert loaded.count() == 60_000


def test_hot_place_of_the_customer_link_is_split(spark):
    staged = spark.range(60_000).select(
        F.concat(F.lit("C"), "id").alias("customer_id"),
        *[F.lit(None).cast("string").alias(c) for c in ("email", "phone", "segment")],
        F.lit("PL").alias("country"),
        F.when(F.col("id") % 3 == 0, None).otherwise(F.concat(F.lit("city"), F.col("id") % 997)).alias("city"),
        F.lit(None).cast("string").alias("postal_code"),
        F.lit("2026-01-01").cast("date").alias("batch_date"),
        F.lit("2026-01-01").cast("timestamp_ntz").alias("loaded_at"),
    )
    places = settle(dimensions.geographies(staged).withColumn("geography_id", F.lit(1)))
    with settings(spark, **LARGE):
        linked = dimensions.customers(staged, places)
        assert "SortMergeJoin(skew=true)" in final_plan(linked)
        assert linked.where("geography_id is null").isEmpty()


def test_marts_over_hot_keys_are_right(spark):
    orders, lines, customers, products, channels = hot_batch(spark)
    days = dimensions.dates(orders)
    with settings(spark, **LARGE):
        fact_orders = facts.fact_orders(orders, customers, days, channels).withColumn(
            "order_id", F.expr("cast(substring(order_nk, 2) as bigint)")
        )
        items = facts.fact_order_items(lines, fact_orders, products)
        (day,) = marts.daily_sales(items, fact_orders, days).collect()
        assert (day.orders_count, int(day.revenue_net)) == (40_001, 60_000)
        top = marts.top_parts(items, products.selectExpr("*", "'' part_name", "'' category", "'' brand"), 1)
        assert top.first().part_sku == "S0" and int(top.first().units_sold) > 20_000
        rfm = marts.rfm_segments(
            customers.withColumn("segment", F.lit("a")), fact_orders, days, items
        ).where("customer_nk = 'C0'").first()
        assert rfm.frequency > 20_000


def test_lines_meet_their_orders_by_shuffle_at_every_size(spark):
    """Orders follow the lines, so they never pass through the driver, however small their files."""
    loaded = facts.fact_order_items(
        clean.clean_order_items(sample.landed_order_items(spark, FOLDER)),
        sample.star_orders(spark, FOLDER).select("order_id", "order_nk"),
        sample.star_products(spark, FOLDER).select("product_id", "part_sku", "cost_net"),
    )
    assert re.search(r"SortMergeJoin \[order_id#\d+\], \[order_id#\d+\]", plan(loaded))
