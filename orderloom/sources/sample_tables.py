"""The generic sample tables (customer, part, orders, lineitem, ...) as this engine's inputs.

``landed_*`` render them as landing rows: text with the blanks, case, padding, resent
versions and bad quantities that cleaning is for. ``star_*`` read them as a loaded star.
Natural keys are numbers there, so they serve as surrogates too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions import expressions as x
from orderloom.operators import dimensions
from orderloom.operators.latest import latest_by_key

BATCH_DATE = "2001-12-31"
_LOADED = (
    "timestamp_ntz'2001-12-31 02:00:00' as ingested_at",
    f"date'{BATCH_DATE}' as batch_date",
)


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _with_resent(df: DataFrame, condition: str) -> DataFrame:
    """Each row as version 0, and as version 1 too where it was sent again."""
    return df.selectExpr("*", f"explode(sequence(0, if({condition}, 1, 0))) as version")


def landed_customers(spark: SparkSession, folder: str) -> DataFrame:
    placed = (
        read(spark, folder, "customer")
        .join(read(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(read(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return _with_resent(placed, "c_acctbal < 0").selectExpr(
        "cast(c_custkey as string) as customer_id",
        "if(c_mktsegment = 'FURNITURE', '   ', concat(' ', upper(c_name), '@Example.COM ')) as email",
        "if(c_acctbal < 0, '', concat(' +48', c_custkey, ' ')) as phone",
        "if(version = 1, ' VIP ', concat(c_mktsegment, ' ')) as segment",
        "if(r_name = 'ASIA', null, concat(' ', n_name)) as country",
        "if(c_mktsegment = 'MACHINERY', null, r_name) as city",
        "if(c_acctbal > 5000, ' ', concat(c_nationkey, '-001')) as postal_code",
        "'' as street",
        "timestamp_ntz'2001-12-01 00:00:00' + make_dt_interval(version) as source_updated_at",
        *_LOADED,
    )


def landed_products(spark: SparkSession, folder: str) -> DataFrame:
    price = "cast(p_retailprice as decimal(14,2))"
    cost = f"cast({price} * cast(0.60 as decimal(3,2)) as decimal(14,2))"
    return read(spark, folder, "part").selectExpr(
        "cast(p_partkey as string) as part_sku",
        "p_name as part_name",
        "concat(' ', p_type, ' ') as category",
        "p_brand as brand",
        "p_brand as manufacturer",
        "if(p_type = 'PROMO', '  ', concat('OE', p_partkey, ' ')) as oe_number",
        "concat(p_brand, ' ') as compatible_make",
        "'' as compatible_model",
        "if(p_size > 40, '', cast(1980 + p_size as string)) as compatible_year_from",
        "cast(2000 + p_size as string) as compatible_year_to",
        f"if(p_type = 'SMALL', '', cast({cost} as string)) as cost_net",
        f"cast({price} as string) as price_net",
        "cast(null as timestamp_ntz) as source_updated_at",
        *_LOADED,
    )


def landed_orders(spark: SparkSession, folder: str) -> DataFrame:
    return _with_resent(read(spark, folder, "orders"), "o_orderstatus = 'P'").selectExpr(
        "cast(o_orderkey as string) as order_id",
        "cast(o_custkey as string) as customer_id",
        "cast(o_orderdate as string) as order_created_at",
        "case when version = 1 then 'RETURNED'"
        " when o_orderstatus = 'O' and o_orderpriority = '5-LOW' then null"
        " when o_orderstatus = 'O' then 'New' when o_orderstatus = 'P' then 'PAID'"
        " when o_totalprice > 400000 then ' shipped' else 'Shipped' end as status",
        "if(o_orderpriority = '4-NOT SPECIFIED', null, concat(' ', o_orderpriority, '  '))"
        " as sales_channel",
        "if(o_totalprice < 100000, 'courier', 'in_store') as delivery_method",
        "if(o_orderstatus = 'O', '', cast(cast(o_totalprice as decimal(14,2)) as string))"
        " as discount_amount",
        "' pln ' as currency",
        "if(o_orderpriority = '1-URGENT', null, o_orderdate + make_dt_interval(version))"
        " as source_updated_at",
        *_LOADED,
    )


def landed_order_items(spark: SparkSession, folder: str) -> DataFrame:
    net = "cast(l_extendedprice as decimal(14,2))"
    gross = f"cast({net} * (1 + cast(l_tax as decimal(3,2))) as decimal(14,2))"
    return read(spark, folder, "lineitem").selectExpr(
        "concat(l_orderkey, '-', l_linenumber) as order_item_id",
        "cast(l_orderkey as string) as order_id",
        "cast(l_linenumber as string) as line_no",
        "cast(l_partkey as string) as part_sku",
        "case when l_returnflag = 'R' and l_linestatus = 'F' and l_quantity > 45 then '-1'"
        " when l_returnflag = 'R' and l_linestatus = 'F' and l_quantity < 3 then '0.0004'"
        " else cast(cast(l_quantity as decimal(14,3)) as string) end as qty",
        f"if(l_returnflag = 'N' and l_quantity > 48, null, cast({net} as string))"
        " as unit_price_net",
        f"cast({gross} as string) as unit_price_gross",
        "if(l_discount = 0, '', cast(cast(l_discount as decimal(14,2)) as string))"
        " as discount_amount",
        "cast(cast(l_tax as decimal(14,2)) as string) as tax_amount",
        "l_shipdate as source_updated_at",
        *_LOADED,
    )


LANDED = {
    "customers": landed_customers,
    "products": landed_products,
    "orders": landed_orders,
    "order_items": landed_order_items,
}


def star_orders(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderkey").cast("string").alias("order_nk"),
        F.col("o_custkey").alias("customer_id"),
        x.date_key(F.col("o_orderdate").cast("date")).alias("date_id"),
        F.col("o_orderpriority").alias("channel_name"),
        F.col("o_totalprice").cast(x.MONEY).alias("discount_amount"),
    )


def star_dates(spark: SparkSession, folder: str) -> DataFrame:
    days = F.col("o_orderdate").cast("date").alias("order_date")
    return dimensions.dates(read(spark, folder, "orders").select(days))


def star_customers(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_nk"),
        F.lower("c_mktsegment").alias("segment"),
        F.col("c_nationkey").cast("bigint").alias("geography_id"),
    )


def star_geography(spark: SparkSession, folder: str) -> DataFrame:
    regions = read(spark, folder, "region")
    return (
        read(spark, folder, "nation")
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("n_nationkey").cast("bigint").alias("geography_id"),
            F.col("n_name").alias("country"),
            F.col("r_name").alias("city"),
            F.lit(None).cast("string").alias("postal_code"),
        )
    )


def star_products(spark: SparkSession, folder: str) -> DataFrame:
    price = F.col("p_retailprice").cast(x.MONEY)
    return read(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_partkey").cast("string").alias("part_sku"),
        F.col("p_name").alias("part_name"),
        F.lower("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        (price * F.lit("0.60").cast("decimal(3,2)")).cast(x.MONEY).alias("cost_net"),
    )


def sent_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Every line as sent, repeated line keys included."""
    net = F.col("l_extendedprice").cast(x.MONEY)
    qty = F.col("l_quantity").cast(x.QUANTITY)
    gross = (net * (F.lit(1) + F.col("l_tax").cast("decimal(3,2)"))).cast(x.MONEY)
    return read(spark, folder, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("order_item_nk"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        qty.alias("qty"),
        net.alias("unit_price_net"),
        F.col("l_extendedprice").cast(x.MONEY).alias("discount_amount"),
        x.line_amount(qty, gross).alias("gross_amount"),
        x.line_amount(qty, net).alias("net_amount"),
    )


def star_order_items(spark: SparkSession, folder: str) -> DataFrame:
    """The newest version of each line, with its amounts."""
    newest = latest_by_key(
        read(spark, folder, "lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
            "l_extendedprice", "l_tax", "l_shipdate",
        ),
        ["l_orderkey", "l_linenumber"],
        [
            F.col(c).desc_nulls_first()
            for c in (
                "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_tax",
            )
        ],
    )
    net = F.col("l_extendedprice").cast(x.MONEY)
    qty = F.col("l_quantity").cast(x.QUANTITY)
    gross = (net * (F.lit(1) + F.col("l_tax").cast("decimal(3,2)"))).cast(x.MONEY)
    return newest.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        qty.alias("qty"),
        net.alias("unit_price_net"),
        x.line_amount(qty, gross).alias("gross_amount"),
        x.line_amount(qty, net).alias("net_amount"),
    )


def star_margins(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with their margin at the product's cost."""
    cost = star_products(spark, folder).select("product_id", "cost_net")
    margin = x.line_margin(F.col("qty"), F.col("unit_price_net"), F.col("cost_net"))
    lines = star_order_items(spark, folder).join(cost, "product_id")
    return lines.withColumn("margin_amount", margin)
