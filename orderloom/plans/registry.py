"""The registered queries: every operator over the whole sample tables.

Each takes (spark, folder) and returns a DataFrame. Amounts leave as doubles, dates and
times as text, so that any engine's result compares by value; surrogates stay inside.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampNTZType

from orderloom.functions.expressions import timestamp_literal
from orderloom.operators import (
    audit,
    clean,
    compatibility,
    dimensions,
    facts,
    history,
    kept_marts,
    marts,
    quality,
    quarantine,
    reconcile,
    rejects,
)
from orderloom.operators.latest import latest_by_key
from orderloom.operators.upsert import absent_rows, upsert, with_new_ids
from orderloom.plans import batch
from orderloom.plans.warehouse import Warehouse
from orderloom.schemas import DWH, RAW, REJECTS, STG
from orderloom.session import configure, in_parallel, scratch_dir, settle
from orderloom.sources import landing
from orderloom.sources import sample_tables as sample
from orderloom.streaming import landing_stream

AS_OF = date(2001, 8, 2)
TOP_K = 20

Query = Callable[[SparkSession, str], DataFrame]


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, dates and times as text."""
    columns = []
    for f in df.schema.fields:
        if isinstance(f.dataType, DecimalType):
            columns.append(F.col(f.name).cast("double").alias(f.name))
        elif isinstance(f.dataType, (DateType, TimestampNTZType)):
            columns.append(F.col(f.name).cast("string").alias(f.name))
        else:
            columns.append(F.col(f.name))
    return df.select(*columns)


# Landing


#: Rows of a delivery's part file: some 80 MB of text for order lines.
PART_ROWS = 1_000_000


def _deliver(spark: SparkSession, folder: str, name: str, rows: DataFrame) -> str:
    """Write landing rows as one CSV delivery of part files and return its path.

    The parts are gzipped. Such a file is read by one task, so none holds more than ``PART_ROWS`` rows.
    """
    path = f"{folder}/{name}"
    business = [c for c in rows.columns if c not in ("ingested_at", "batch_date")]
    text = rows.select(*[F.col(c).cast("string").alias(c) for c in business])
    (
        text.write.option("header", True)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", PART_ROWS)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def raw_csv_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines written as CSV and read back as a landing table."""
    rows = sample.landed_order_items(spark, folder)
    path = _deliver(spark, scratch_dir(spark), "order_items.csv", rows)
    landing.require_files(spark, {"order_items.csv": path})
    table = RAW["order_items"]
    return plain(landing.read_delivery(spark, path, table))


def raw_append_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Two dated batches appended, the second one twice: rows per batch and load."""
    warehouse = Warehouse(spark, scratch_dir(spark))
    orders = sample.landed_orders(spark, folder).drop("ingested_at", "batch_date")
    early = F.col("order_created_at") < "1998-01-01"
    for hour, (day, rows) in enumerate(
        [
            ("2001-12-30", orders.where(early)),
            ("2001-12-31", orders.where(~early)),
            ("2001-12-31", orders.where(~early)),
        ]
    ):
        warehouse.append_raw("orders", landing.land(rows, day, datetime(2002, 1, 1, hour)))
    stored = warehouse.raw("orders").groupBy("batch_date", "ingested_at")
    return plain(
        stored.agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count("source_updated_at").alias("dated_rows"),
            F.sum(F.length("discount_amount")).alias("discount_chars"),
        )
    )


# Staging


def stg_orders_clean(spark: SparkSession, folder: str) -> DataFrame:
    return plain(clean.clean_orders(sample.landed_orders(spark, folder)))


def stg_order_items_clean(spark: SparkSession, folder: str) -> DataFrame:
    return plain(clean.clean_order_items(sample.landed_order_items(spark, folder)))


def stg_customers_clean(spark: SparkSession, folder: str) -> DataFrame:
    return plain(clean.clean_customers(sample.landed_customers(spark, folder)))


def stg_products_clean(spark: SparkSession, folder: str) -> DataFrame:
    years = ("compatible_year_from", "compatible_year_to")
    cleaned = clean.clean_products(sample.landed_products(spark, folder))
    return plain(cleaned.withColumns({y: F.col(y).cast("string") for y in years}))


def stg_partition_replace(spark: SparkSession, folder: str) -> DataFrame:
    """Two batches staged; the second staged again with fewer orders, the first with none."""
    warehouse = Warehouse(spark, scratch_dir(spark))
    orders = clean.clean_orders(sample.landed_orders(spark, folder)).drop("batch_date")
    early = F.col("order_date") < "1998-01-01"
    paid = F.col("status") == "paid"
    for hour, (day, rows) in enumerate(
        [
            ("2001-12-29", orders.where(early)),
            ("2001-12-30", orders.where(~early)),
            ("2001-12-31", orders.where(early)),
            ("2001-12-30", orders.where(~early & ~paid)),
            ("2001-12-29", orders.where(F.lit(False))),
        ]
    ):
        warehouse.replace_staged("orders_clean", rows, day, datetime(2002, 1, 1, hour))
    return plain(warehouse.staged("orders_clean").select("batch_date", "order_id", "status", "loaded_at"))


# Dimensions. Staging holds two overlapping batches; the dimensions know the first.


def _stage(df: DataFrame, day: str, hour: int) -> DataFrame:
    loaded = timestamp_literal(datetime(2002, 1, 1, hour))
    return df.withColumn("batch_date", F.lit(day).cast("date")).withColumn("loaded_at", loaded)


def _staged_orders(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Orders to 1998 as first sent; orders from 1998 on, all cancelled, as sent later."""
    orders = settle(clean.clean_orders(sample.landed_orders(spark, folder)))
    first = orders.where(F.col("order_date") < "1999-01-01")
    second = orders.where(F.col("order_date") >= "1998-01-01")
    return (
        _stage(first, "2001-12-30", 1),
        _stage(second.withColumn("status", F.lit("cancelled")), "2001-12-31", 2),
    )


def _staged_customers(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Customers with a postal code first; later those with a phone, in a new segment."""
    cleaned = settle(clean.clean_customers(sample.landed_customers(spark, folder)))
    first = cleaned.where(F.col("postal_code").isNotNull())
    second = cleaned.where(F.col("phone").isNotNull())
    return (
        _stage(first, "2001-12-30", 1),
        _stage(second.withColumn("segment", F.concat(F.lit("new "), "segment")), "2001-12-31", 2),
    )


def dim_date(spark: SparkSession, folder: str) -> DataFrame:
    """The calendar of the first batch, and the days the second one adds."""
    first, second = _staged_orders(spark, folder)
    known = dimensions.dates(first)
    added = dimensions.dates(first.unionByName(second)).join(
        known.select("date_day"), "date_day", "left_anti"
    )
    return plain(known.unionByName(added.select(*known.columns)))


def dim_channel(spark: SparkSession, folder: str) -> DataFrame:
    first, second = _staged_orders(spark, folder)
    known = dimensions.channels(first.where(F.col("sales_channel") > "3"))
    added = absent_rows(known, dimensions.channels(second), ["channel_name"])
    return known.unionByName(added)


def dim_geography(spark: SparkSession, folder: str) -> DataFrame:
    """Places of the first batch plus the new ones of both: a NULL part is added once."""
    first, second = _staged_customers(spark, folder)
    keys = list(dimensions.GEOGRAPHY)
    known = dimensions.geographies(first)
    added = absent_rows(known, dimensions.geographies(first.unionByName(second)), keys)
    return known.unionByName(added)


def _numbered_places(customers: DataFrame) -> DataFrame:
    places = dimensions.geographies(customers)
    return settle(with_new_ids(places, "geography_id", 1))


def dim_customer_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """A dimension built from the first batch, upserted from all of staging."""
    first, second = _staged_customers(spark, folder)
    staged = first.unionByName(second)
    places = _numbered_places(staged)
    merged = upsert(
        dimensions.customers(first, places), dimensions.customers(staged, places), "customer_nk"
    )
    return merged.join(places, "geography_id", "left").drop("geography_id")


def dim_product_upsert(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = settle(clean.clean_products(sample.landed_products(spark, folder)))
    first = _stage(cleaned.where("category != 'promo'"), "2001-12-30", 1)
    second = _stage(
        cleaned.where("category != 'large'").withColumn("cost_net", F.lit(1).cast("decimal(14,2)")),
        "2001-12-31",
        2,
    )
    target = dimensions.products(first)
    merged = upsert(target, dimensions.products(first.unionByName(second)), "part_sku")
    return plain(merged.select("part_sku", "part_name", "category", "brand", "oe_number", "cost_net"))


# Facts


def _known_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with a phone; orders of the others find no customer."""
    cleaned = clean.clean_customers(sample.landed_customers(spark, folder))
    known = cleaned.where(F.col("phone").isNotNull())
    return known.select(
        F.col("customer_id").cast("bigint").alias("customer_id"),
        F.col("customer_id").alias("customer_nk"),
    )


def fact_orders_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Two overlapping batches of orders; the later one replaces what it sends again."""
    first, second = _staged_orders(spark, folder)
    both = first.unionByName(second)
    days = settle(dimensions.dates(both))
    channels = settle(with_new_ids(dimensions.channels(both), "channel_id", 1))
    customers = _known_customers(spark, folder)
    loaded = [facts.fact_orders(b, customers, days, channels) for b in (first, second)]
    merged = upsert(loaded[0], loaded[1], "order_nk")
    return plain(merged.join(channels, "channel_id", "left").drop("channel_id"))


def fact_order_items_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of two batches over one set of orders; promo parts are not in the catalogue."""
    landed = sample.landed_order_items(spark, folder)
    batches = [
        clean.clean_order_items(landed.where(F.col("source_updated_at") < "1999-01-01")),
        clean.clean_order_items(landed.where(F.col("source_updated_at") >= "1998-01-01")),
    ]
    products = clean.clean_products(sample.landed_products(spark, folder))
    catalogue = products.where("category != 'promo'").select(
        F.col("part_sku").cast("bigint").alias("product_id"), "part_sku", "cost_net"
    )
    orders = sample.star_orders(spark, folder).select("order_id", "order_nk")
    loaded = [facts.fact_order_items(b, orders, catalogue) for b in batches]
    return plain(upsert(loaded[0], loaded[1], "order_item_nk"))


# History, compatibility, rejects


def _customer_batches(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Customers with a postal code, then those with a phone in a new segment, then, late, all of a country in another."""
    cleaned = settle(clean.clean_customers(sample.landed_customers(spark, folder))).drop("batch_date")
    cleaned = cleaned.withColumnRenamed("customer_id", "customer_nk")
    return {
        "2001-12-10": cleaned.where(F.col("postal_code").isNotNull()),
        "2001-12-30": cleaned.where(F.col("phone").isNotNull()).withColumn("segment", F.concat(F.lit("new "), "segment")),
        "2001-12-31": cleaned.where(F.col("phone").isNotNull()).withColumn("segment", F.concat(F.lit("new "), "segment")),
        "2001-12-20": cleaned.where(F.col("country").isNotNull()).withColumn("segment", F.concat(F.lit("old "), "segment")),
        # Sent again: what the day said first no longer counts.
        "2001-12-10 again": cleaned.where(F.col("email").isNull()).withColumn("street", F.lit("main street")),
    }


def _history(batches: dict[str, DataFrame], key: str) -> DataFrame:
    """The batches merged one after the other, as daily runs do."""
    found: DataFrame | None = None
    for day, rows in batches.items():
        sent = rows.withColumn("day", F.lit(day.split(" ")[0]).cast("date"))
        attributes = [c for c in rows.columns if c != key]
        if found is None:
            found = history.versions(sent, key, attributes, "day")
        else:
            found = settle(history.merge_versions(found, sent, key, attributes, "day"))
    return found


def dim_customer_history(spark: SparkSession, folder: str) -> DataFrame:
    """Versions of customers after five batches, the last two late."""
    found = _history(_customer_batches(spark, folder), "customer_nk")
    return plain(found.withColumn("days_observed", F.size("observed")).drop("observed"))


def dim_customer_as_of(spark: SparkSession, folder: str) -> DataFrame:
    """The customers as they were on a day between two batches."""
    found = history.as_of(_history(_customer_batches(spark, folder), "customer_nk"), "2001-12-25")
    return plain(found.drop("observed", "valid_to", "is_current"))


def _product_costs(spark: SparkSession, folder: str, late: bool = True) -> DataFrame:
    """Versions of the catalogue: costs of 1995, raised in 1999, and, sent late, halved for some parts from 1997 on."""
    products = settle(clean.clean_products(sample.landed_products(spark, folder))).select("part_sku", "category", "cost_net")
    times = {"1995-01-01": "1", "1999-07-01": "1.25", "1997-03-05": "0.5"}
    batches = {
        day: products.withColumn("cost_net", (F.col("cost_net") * F.lit(rate).cast("decimal(3,2)")).cast("decimal(14,2)"))
        for day, rate in times.items()
    }
    batches["1997-03-05"] = batches["1997-03-05"].where("category in ('promo', 'large')")
    if not late:
        del batches["1997-03-05"]
    return _history(batches, "part_sku")


def _lines_at_cost(spark: SparkSession, folder: str, costs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Lines at the cost of their order's day, the orders and the parts."""
    items = clean.clean_order_items(sample.landed_order_items(spark, folder))
    products = clean.clean_products(sample.landed_products(spark, folder)).select(
        F.col("part_sku").cast("bigint").alias("product_id"), "part_sku", "cost_net"
    )
    orders = sample.star_orders(spark, folder).select("order_id", "order_nk", "date_id")
    return facts.fact_order_items_as_of(items, orders, products, costs), orders, products


def fact_margin_asof(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with their margin at the cost that held on the day of the order."""
    lines, _, _ = _lines_at_cost(spark, folder, _product_costs(spark, folder))
    return plain(lines.select("order_item_nk", "product_id", "qty", "net_amount", "margin_amount"))


def fact_margin_repriced(spark: SparkSession, folder: str) -> DataFrame:
    """Lines loaded before a cost came late, and corrected then: as if loaded after, and which were touched."""
    old, new = (settle(_product_costs(spark, folder, late)) for late in (False, True))
    lines, orders, products = _lines_at_cost(spark, folder, old)
    # Only what the corrections and the result read is stored.
    lines = settle(lines.select("order_item_nk", "order_id", "product_id", "qty", "unit_price_net", "net_amount", "margin_amount"))
    corrections = facts.margin_corrections(lines, orders, products, old, new)
    repriced = facts.with_margins(lines, corrections)
    return plain(repriced.select("order_item_nk", "product_id", "qty", "net_amount", "margin_amount", "corrected"))


def _compatibility(spark: SparkSession, folder: str) -> DataFrame:
    """A bridge that took in three deliveries, the second and third with other years."""
    products = settle(clean.clean_products(sample.landed_products(spark, folder)))
    low, high = F.col("compatible_year_from"), F.col("compatible_year_to")
    sent = [
        products,
        products.withColumns({"compatible_year_from": high + 1 + (high % 3), "compatible_year_to": high + 10}),
        products.withColumns({"compatible_year_to": F.coalesce(low, high) - (high % 7), "compatible_year_from": F.lit(1960)}),
    ]
    bridge = compatibility.coalesce_ranges(compatibility.fitted_ranges(sent[0]))
    columns = bridge.columns
    for more in sent[1:]:
        bridge = compatibility.coalesce_ranges(bridge.unionByName(compatibility.fitted_ranges(more).select(*columns)))
    return bridge


def bridge_product_compatibility(spark: SparkSession, folder: str) -> DataFrame:
    return _compatibility(spark, folder)


def bridge_product_gaps(spark: SparkSession, folder: str) -> DataFrame:
    return compatibility.range_gaps(_compatibility(spark, folder))


def fact_orders_replayed(spark: SparkSession, folder: str) -> DataFrame:
    """Orders whose customers come a batch late: rejected, stored, and loaded when their customer is there.

    Customers without a phone come late, those of one segment never.
    """
    first, second = _staged_orders(spark, folder)
    both = first.unionByName(second)
    days = settle(dimensions.dates(both))
    channels = settle(with_new_ids(dimensions.channels(both), "channel_id", 1))
    everyone = clean.clean_customers(sample.landed_customers(spark, folder)).where("segment != 'building'")
    keys = [F.col("customer_id").cast("bigint").alias("customer_id"), F.col("customer_id").alias("customer_nk")]
    known = [everyone.where(F.col("phone").isNotNull()).select(*keys), everyone.select(*keys)]
    columns = [c for c in STG["orders_clean"].columns if c in REJECTS["rejected_orders"].columns]
    rejected = spark.createDataFrame([], REJECTS["rejected_orders"].schema)
    merged = None
    for batch_rows, customers, day in zip((first, second), known, ("2001-12-30", "2001-12-31"), strict=True):
        rows = settle(rejects.tried(batch_rows, rejected, "order_id", columns, day))
        loaded = facts.fact_orders(rows, customers, days, channels)
        merged = loaded if merged is None else upsert(merged, loaded, "order_nk")
        rejected = settle(rejects.rejected_orders(rows, customers))
    stored = merged.select("order_nk", "order_status", F.lit(None).cast("string").alias("reason"), F.lit(None).cast("int").alias("tries"))
    left = rejected.select(F.col("order_id").alias("order_nk"), F.col("status").alias("order_status"), "reason", "tries")
    return stored.unionByName(left)


# Marts


def mart_daily_sales(spark: SparkSession, folder: str) -> DataFrame:
    mart = marts.daily_sales(
        sample.star_order_items(spark, folder),
        sample.star_orders(spark, folder),
        sample.star_dates(spark, folder),
    )
    return plain(mart.withColumn("avg_line_value", F.round("avg_line_value", 6)))


def mart_top_parts(spark: SparkSession, folder: str, k: int | None = None) -> DataFrame:
    items, products = sample.star_order_items(spark, folder), sample.star_products(spark, folder)
    return plain(marts.top_parts(items, products, k))


def mart_margin_by_category(spark: SparkSession, folder: str) -> DataFrame:
    items, products = sample.star_margins(spark, folder), sample.star_products(spark, folder)
    return plain(marts.margin_by_category(items, products))


def mart_cohort_retention(
    spark: SparkSession, folder: str, full_offset: bool = False
) -> DataFrame:
    orders, days = sample.star_orders(spark, folder), sample.star_dates(spark, folder)
    return plain(marts.cohort_retention(orders, days, full_offset))


def mart_rfm_segments(spark: SparkSession, folder: str) -> DataFrame:
    mart = marts.rfm_segments(
        sample.star_customers(spark, folder),
        sample.star_orders(spark, folder),
        sample.star_dates(spark, folder),
        sample.star_order_items(spark, folder),
        AS_OF,
    )
    return plain(mart)


def _kept_states(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Mart states that began with other facts: a third of the orders on another day with thrice the goods,
    a fifth missing, and of a quarter some lines missing.

    The present facts come as a difference for the orders that changed, as a batch brings them.
    """
    items = settle(sample.star_margins(spark, folder).select(*batch.ITEM_MEASURES))
    orders = settle(sample.star_orders(spark, folder).select("order_id", "customer_id", "date_id"))
    changed, absent, partly = (F.col("order_id") % n == 0 for n in (3, 5, 4))
    old_orders = orders.where(~absent).withColumn("date_id", F.when(changed, F.lit(19950615)).otherwise(F.col("date_id")))
    old_items = items.where(~absent).withColumn("qty", F.when(changed, F.col("qty") * 3).otherwise(F.col("qty")).cast("decimal(14,3)"))
    old_items = old_items.where(~(partly & (F.col("product_id") % 7 == 0)))
    states = {}
    before = kept_marts.contributions(old_items, old_orders)
    touched = changed | absent | partly
    now = kept_marts.contributions(items.where(touched), orders.where(touched))
    then = kept_marts.contributions(old_items.where(touched), old_orders.where(touched))
    for name in kept_marts.STATES:
        stored = before[name].unionByName(kept_marts.difference(name, now[name], then[name]))
        states[name] = kept_marts.current(name, settle(stored))
    return states


def kept_daily_sales(spark: SparkSession, folder: str) -> DataFrame:
    mart = kept_marts.daily_sales(_kept_states(spark, folder)["sales_by_day"], sample.star_dates(spark, folder))
    return plain(mart.withColumn("avg_line_value", F.round("avg_line_value", 6)))


def kept_top_parts(spark: SparkSession, folder: str) -> DataFrame:
    return plain(kept_marts.top_parts(_kept_states(spark, folder)["sales_by_product"], sample.star_products(spark, folder)))


def kept_margin_by_category(spark: SparkSession, folder: str) -> DataFrame:
    states = _kept_states(spark, folder)
    return plain(kept_marts.margin_by_category(states["sales_by_product"], sample.star_products(spark, folder)))


def kept_cohort_retention(spark: SparkSession, folder: str) -> DataFrame:
    states = _kept_states(spark, folder)
    return plain(kept_marts.cohort_retention(states["customer_days"], sample.star_dates(spark, folder)))


def kept_rfm_segments(spark: SparkSession, folder: str) -> DataFrame:
    days, calendar = _kept_states(spark, folder)["customer_days"], sample.star_dates(spark, folder)
    return plain(kept_marts.rfm_segments(sample.star_customers(spark, folder), days, calendar, AS_OF))


# Quality. The sample tables are clean, so faults are put in by condition.


def _faulty_orders(spark: SparkSession, folder: str) -> DataFrame:
    urgent = F.col("channel_name") == "1-URGENT"
    big = F.col("discount_amount") > 400000
    return sample.star_orders(spark, folder).withColumns(
        {
            "customer_id": F.when(~urgent, F.col("customer_id")),
            "date_id": F.when(~big, F.col("date_id")),
        }
    )


def dq_fact_orders_null_fk(spark: SparkSession, folder: str) -> DataFrame:
    return quality.orders_null_fk(_faulty_orders(spark, folder))


def dq_fact_order_items_missing_fk(spark: SparkSession, folder: str) -> DataFrame:
    return quality.order_items_missing_fk(
        sample.sent_lines(spark, folder),
        sample.star_orders(spark, folder).where("channel_name != '1-URGENT'"),
        sample.star_products(spark, folder).where("category != 'promo'"),
    )


def dq_fact_orders_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    sent = sample.landed_orders(spark, folder)
    return quality.orders_duplicates(sent.select(F.col("order_id").alias("order_nk")))


def dq_order_sum_mismatch(spark: SparkSession, folder: str) -> DataFrame:
    """The order total against the sum of its line prices."""
    return quality.order_sum_mismatch(
        sample.sent_lines(spark, folder), sample.star_orders(spark, folder)
    )


def contract_checks(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with holes and lines sent twice, against the star's promises."""
    lines = sample.sent_lines(spark, folder).withColumn(
        "fact_order_item_id", F.col("order_id") * 8 + F.element_at(F.split("order_item_nk", "-"), 2).cast("int")
    )
    frames = {
        "dim_date": sample.star_dates(spark, folder),
        "dim_customer": sample.star_customers(spark, folder).where("segment != 'building'"),
        "dim_product": sample.star_products(spark, folder),
        "dim_geography": sample.star_geography(spark, folder).where("city != 'ASIA'"),
        "dim_channel": sample.star_orders(spark, folder)
        .select("channel_name")
        .distinct()
        .select(F.substring("channel_name", 1, 1).cast("bigint").alias("channel_id"), "channel_name"),
        "fact_orders": _faulty_orders(spark, folder).withColumn(
            "channel_id", F.substring("channel_name", 1, 1).cast("bigint")
        ),
        "fact_order_items": lines,
    }
    return quality.contract_checks(DWH, frames)


def contract_checks_staging(spark: SparkSession, folder: str) -> DataFrame:
    """Staging with states missing from urgent orders and every product staged twice."""
    cleaned = {
        name: _stage(clean_batch(sample.LANDED[raw](spark, folder)).drop("batch_date"), "2001-12-31", 1)
        for name, (raw, clean_batch) in clean.CLEANERS.items()
    }
    state = F.when(~F.col("sales_channel").eqNullSafe("1-urgent"), F.col("status"))
    cleaned["orders_clean"] = cleaned["orders_clean"].withColumn("status", state)
    cleaned["products_clean"] = cleaned["products_clean"].unionByName(cleaned["products_clean"])
    return quality.contract_checks(STG, cleaned)


def gate_delta_checks(spark: SparkSession, folder: str) -> DataFrame:
    """What the gate finds in a run that wrote the orders from 1998 on, with holes, over batches of 1997 and 1998.

    1998 is also in a batch that the run left alone; 1997 was in a batch that it replaced, and is gone.
    """
    orders = _faulty_orders(spark, folder).withColumn("channel_id", F.substring("channel_name", 1, 1).cast("bigint"))
    sound = sample.star_orders(spark, folder).withColumn("channel_id", F.lit(1).cast("bigint"))
    years = sample.star_orders(spark, folder).select("order_id", F.floor(F.col("date_id") / 10000).alias("year"))
    written = orders.join(years, "order_id").where("year >= 1998").drop("year")
    untouched = sound.join(years, "order_id").where("year = 1998").drop("year")
    replaced = sound.join(years, "order_id").where("year between 1997 and 1998").drop("year")
    after = {
        "dim_customer": sample.star_customers(spark, folder).where("segment != 'building'"),
        "dim_date": sample.star_dates(spark, folder),
        "dim_channel": spark.range(2, 6).select(F.col("id").alias("channel_id")),
    }
    return quality.delta_checks(DWH, {"fact_orders": quality.Change(written, untouched, replaced)}, after)


def quarantine_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines delivered with bad cells: what is set aside, by column and reason."""
    landed = sample.landed_order_items(spark, folder)
    odd = F.expr("cast(order_id as bigint) % 100")
    broken = landed.withColumns(
        {
            "qty": F.when(odd == 1, F.concat("qty", F.lit(" pcs"))).otherwise(F.col("qty")),
            "unit_price_net": F.when(odd == 2, F.concat(F.lit("99999999999999"), F.coalesce("unit_price_net", F.lit("0")))).otherwise(
                F.col("unit_price_net")
            ),
            "tax_amount": F.when(odd.isin(1, 3), F.lit("n/a")).otherwise(F.col("tax_amount")),
            "line_no": F.when(odd == 4, F.concat("line_no", F.lit(".0"))).when(odd == 5, F.lit("3000000000")).otherwise(F.col("line_no")),
        }
    )
    flagged = quarantine.with_errors(broken, "order_items")
    return quarantine.counts(quarantine.set_aside(flagged, "order_items"))


def reconcile_layers(spark: SparkSession, folder: str) -> DataFrame:
    """Lines by month of shipping against a copy that lost some, doubled some and changed some: told by month."""
    lines = sample.read(spark, folder, "lineitem").select(
        F.date_format("l_shipdate", "yyyy-MM").alias("month"),
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("line"),
        F.col("l_quantity").cast("decimal(14,3)").alias("qty"),
        F.col("l_extendedprice").cast("decimal(14,2)").alias("price"),
        F.col("l_returnflag").alias("flag"),
    )
    month = F.substring("month", 6, 2)
    copy = lines.where(~((month == "02") & (F.col("flag") == "R")))
    copy = copy.withColumn("price", F.when((month == "05") & (F.col("flag") == "N"), F.col("price") + 1).otherwise(F.col("price")))
    copy = copy.unionByName(lines.where((month == "09") & (F.col("flag") == "A")))
    columns = ["line", "qty", "price", "flag"]
    found = reconcile.differences(*(reconcile.checksums(df, "month", columns) for df in (lines, copy)))
    return reconcile.located(found).withColumnRenamed("batch", "month")


def quality_report(spark: SparkSession, folder: str) -> DataFrame:
    """All four checks over the sample star as one report."""
    return quality.run_checks(
        {
            "fact_orders": sample.star_orders(spark, folder),
            "fact_order_items": sample.sent_lines(spark, folder),
            "dim_product": sample.star_products(spark, folder),
        }
    )


# Audit and the whole batch


def run_audit_latest(spark: SparkSession, folder: str) -> DataFrame:
    """The event table as a run log: one run per user, its last event as the state."""
    events = sample.read(spark, folder, "events").select(
        F.col("user_id").alias("run_id"),
        F.col("ts").cast("date").alias("run_date"),
        F.col("event_id").alias("event_no"),
        F.date_trunc("second", F.col("ts")).cast("timestamp_ntz").alias("event_at"),
        F.when(F.col("event_type") == "click", audit.RUNNING).otherwise(F.col("event_type")).alias("status"),
        F.col("event_id").alias("rows_loaded"),
        F.when(F.col("event_type") == "error", F.col("props")).alias("error_message"),
    )
    return plain(audit.current_runs(events))


def latest_event_by_user(spark: SparkSession, folder: str) -> DataFrame:
    """Keep-latest on its own: the newest event of each user."""
    events = sample.read(spark, folder, "events").select("user_id", "event_id", "ts", "event_type", "value")
    newest = latest_by_key(events, ["user_id"], [F.desc_nulls_first("ts"), F.desc_nulls_first("event_id")])
    return newest.select("user_id", "event_id", "event_type", "value")


def _deliver_batches(spark: SparkSession, folder: str, landing_root: str, days: list[str]) -> None:
    """Two daily deliveries of all four files: orders and lines up to 1998, then 1998 again and more."""
    orders = sample.landed_orders(spark, folder)
    items = sample.landed_order_items(spark, folder)
    when_ordered, when_shipped = F.col("order_created_at"), F.col("source_updated_at")
    slices = {
        "2001-12-30": (when_ordered < "1999-01-01", when_shipped < "1999-01-01"),
        "2001-12-31": (when_ordered >= "1998-01-01", when_shipped >= "1998-01-01"),
    }
    for day in days:
        ordered, shipped = slices[day]
        deliveries = {
            "customers.csv": sample.landed_customers(spark, folder),
            "products.csv": sample.landed_products(spark, folder),
            "orders.csv": orders.where(ordered),
            "order_items.csv": items.where(shipped),
        }
        in_parallel(
            spark,
            *[
                partial(_deliver, spark, f"{landing_root}/{day}", name, rows)
                for name, rows in deliveries.items()
            ]
        )


BATCH_DAYS = ["2001-12-30", "2001-12-31"]


def batch_daily_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Two daily batches run from CSV to the stored star, then daily sales from it."""
    warehouse = Warehouse(spark, scratch_dir(spark))
    landing_root = scratch_dir(spark)
    for day in BATCH_DAYS:
        _deliver_batches(spark, folder, landing_root, [day])
        batch.run_batch(spark, warehouse.root, landing_root, day, AS_OF)
    mart = marts.all_marts(warehouse.star(), AS_OF)["daily_sales"]
    return plain(mart.withColumn("avg_line_value", F.round("avg_line_value", 6)))


def stream_daily_sales(spark: SparkSession, folder: str) -> DataFrame:
    """The same deliveries as a stream of dated folders, with kept marts: daily sales from their states.

    Each day is marked complete and streamed; then a new stream sees both days again, and changes nothing.
    """
    warehouse = Warehouse(spark, scratch_dir(spark))
    landing_root, checkpoint = scratch_dir(spark), scratch_dir(spark)
    extras = batch.Extras(kept_marts=True)
    for day in BATCH_DAYS:
        _deliver_batches(spark, folder, landing_root, [day])
        landing_stream.mark_complete(spark, landing_root, day)
        landing_stream.stream_batches(spark, warehouse.root, landing_root, checkpoint, AS_OF, extras=extras).awaitTermination()
    landing_stream.stream_batches(spark, warehouse.root, landing_root, scratch_dir(spark), AS_OF, extras=extras).awaitTermination()
    star, states = warehouse.star(), warehouse.mart_states()
    mart = kept_marts.all_marts(states, star, AS_OF)["daily_sales"]
    return plain(mart.withColumn("avg_line_value", F.round("avg_line_value", 6)))


_QUERIES: dict[str, Query] = {
    "raw_csv_ingest": raw_csv_ingest,
    "raw_append_batches": raw_append_batches,
    "stg_orders_clean": stg_orders_clean,
    "stg_order_items_clean": stg_order_items_clean,
    "stg_customers_clean": stg_customers_clean,
    "stg_products_clean": stg_products_clean,
    "stg_partition_replace": stg_partition_replace,
    "dim_date": dim_date,
    "dim_channel": dim_channel,
    "dim_geography": dim_geography,
    "dim_customer_upsert": dim_customer_upsert,
    "dim_product_upsert": dim_product_upsert,
    "fact_orders_upsert": fact_orders_upsert,
    "fact_order_items_upsert": fact_order_items_upsert,
    "dim_customer_history": dim_customer_history,
    "dim_customer_as_of": dim_customer_as_of,
    "fact_margin_asof": fact_margin_asof,
    "fact_margin_repriced": fact_margin_repriced,
    "bridge_product_compatibility": bridge_product_compatibility,
    "bridge_product_gaps": bridge_product_gaps,
    "fact_orders_replayed": fact_orders_replayed,
    "mart_daily_sales": mart_daily_sales,
    "mart_top_parts": mart_top_parts,
    "mart_top_parts_k": partial(mart_top_parts, k=TOP_K),
    "mart_margin_by_category": mart_margin_by_category,
    "mart_cohort_retention": mart_cohort_retention,
    "mart_cohort_retention_full": partial(mart_cohort_retention, full_offset=True),
    "mart_rfm_segments": mart_rfm_segments,
    "kept_daily_sales": kept_daily_sales,
    "kept_top_parts": kept_top_parts,
    "kept_margin_by_category": kept_margin_by_category,
    "kept_cohort_retention": kept_cohort_retention,
    "kept_rfm_segments": kept_rfm_segments,
    "dq_fact_orders_null_fk": dq_fact_orders_null_fk,
    "dq_fact_order_items_missing_fk": dq_fact_order_items_missing_fk,
    "dq_fact_orders_duplicates": dq_fact_orders_duplicates,
    "dq_order_sum_mismatch": dq_order_sum_mismatch,
    "quality_report": quality_report,
    "contract_checks": contract_checks,
    "contract_checks_staging": contract_checks_staging,
    "gate_delta_checks": gate_delta_checks,
    "quarantine_counts": quarantine_counts,
    "reconcile_layers": reconcile_layers,
    "run_audit_latest": run_audit_latest,
    "latest_event_by_user": latest_event_by_user,
    "batch_daily_sales": batch_daily_sales,
    "stream_daily_sales": stream_daily_sales,
}


def _configured(query: Query) -> Query:
    return lambda spark, folder: query(configure(spark), folder)


QUERIES: dict[str, Query] = {name: _configured(query) for name, query in _QUERIES.items()}
