"""What each registered query must return, as SQL over the same sample tables."""

from __future__ import annotations

_LOADED = "TIMESTAMP '2001-12-31 02:00:00' AS ingested_at, DATE '2001-12-31' AS batch_date"


def _resent(table: str, condition: str) -> str:
    return f"(SELECT *, 0 AS version FROM {table} UNION ALL SELECT *, 1 FROM {table} WHERE {condition})"


_PLACED = """(SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey)"""

_LANDED_CUSTOMERS = f"""
SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
    CASE WHEN c_mktsegment = 'FURNITURE' THEN '   '
         ELSE ' ' || upper(c_name) || '@Example.COM ' END AS email,
    CASE WHEN c_acctbal < 0 THEN '' ELSE ' +48' || c_custkey || ' ' END AS phone,
    CASE WHEN version = 1 THEN ' VIP ' ELSE c_mktsegment || ' ' END AS segment,
    CASE WHEN r_name = 'ASIA' THEN NULL ELSE ' ' || n_name END AS country,
    CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE r_name END AS city,
    CASE WHEN c_acctbal > 5000 THEN ' ' ELSE c_nationkey || '-001' END AS postal_code,
    '' AS street,
    TIMESTAMP '2001-12-01 00:00:00' + to_days(version) AS source_updated_at, {_LOADED}
FROM {_resent(_PLACED, "c_acctbal < 0")}"""

_LANDED_PRODUCTS = f"""
SELECT CAST(p_partkey AS VARCHAR) AS part_sku, p_name AS part_name, ' ' || p_type || ' ' AS category,
    p_brand AS brand, p_brand AS manufacturer,
    CASE WHEN p_type = 'PROMO' THEN '  ' ELSE 'OE' || p_partkey || ' ' END AS oe_number,
    p_brand || ' ' AS compatible_make, '' AS compatible_model,
    CASE WHEN p_size > 40 THEN '' ELSE CAST(1980 + p_size AS VARCHAR) END AS compatible_year_from,
    CAST(2000 + p_size AS VARCHAR) AS compatible_year_to,
    CASE WHEN p_type = 'SMALL' THEN '' ELSE CAST(CAST(CAST(p_retailprice AS DECIMAL(14,2))
        * CAST(0.60 AS DECIMAL(3,2)) AS DECIMAL(14,2)) AS VARCHAR) END AS cost_net,
    CAST(CAST(p_retailprice AS DECIMAL(14,2)) AS VARCHAR) AS price_net,
    CAST(NULL AS TIMESTAMP) AS source_updated_at, {_LOADED}
FROM part"""

_LANDED_ORDERS = f"""
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
    CAST(o_orderdate AS VARCHAR) AS order_created_at,
    CASE WHEN version = 1 THEN 'RETURNED'
         WHEN o_orderstatus = 'O' AND o_orderpriority = '5-LOW' THEN NULL
         WHEN o_orderstatus = 'O' THEN 'New' WHEN o_orderstatus = 'P' THEN 'PAID'
         WHEN o_totalprice > 400000 THEN ' shipped' ELSE 'Shipped' END AS status,
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL
         ELSE ' ' || o_orderpriority || '  ' END AS sales_channel,
    CASE WHEN o_totalprice < 100000 THEN 'courier' ELSE 'in_store' END AS delivery_method,
    CASE WHEN o_orderstatus = 'O' THEN ''
         ELSE CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS VARCHAR) END AS discount_amount,
    ' pln ' AS currency,
    CASE WHEN o_orderpriority = '1-URGENT' THEN NULL
         ELSE o_orderdate + to_days(version) END AS source_updated_at, {_LOADED}
FROM {_resent("orders", "o_orderstatus = 'P'")}"""

_NET = "CAST(l_extendedprice AS DECIMAL(14,2))"
_GROSS = f"CAST({_NET} * (1 + CAST(l_tax AS DECIMAL(3,2))) AS DECIMAL(14,2))"
_LANDED_ITEMS = f"""
SELECT l_orderkey || '-' || l_linenumber AS order_item_id, CAST(l_orderkey AS VARCHAR) AS order_id,
    CAST(l_linenumber AS VARCHAR) AS line_no, CAST(l_partkey AS VARCHAR) AS part_sku,
    CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' AND l_quantity > 45 THEN '-1'
         WHEN l_returnflag = 'R' AND l_linestatus = 'F' AND l_quantity < 3 THEN '0.0004'
         ELSE CAST(CAST(l_quantity AS DECIMAL(14,3)) AS VARCHAR) END AS qty,
    CASE WHEN l_returnflag = 'N' AND l_quantity > 48 THEN NULL
         ELSE CAST({_NET} AS VARCHAR) END AS unit_price_net,
    CAST({_GROSS} AS VARCHAR) AS unit_price_gross,
    CASE WHEN l_discount = 0 THEN ''
         ELSE CAST(CAST(l_discount AS DECIMAL(14,2)) AS VARCHAR) END AS discount_amount,
    CAST(CAST(l_tax AS DECIMAL(14,2)) AS VARCHAR) AS tax_amount,
    l_shipdate AS source_updated_at, {_LOADED}
FROM lineitem"""


def _newest(source: str, key: str, content: str, where: str) -> str:
    ties = ", ".join(f"{c} DESC NULLS LAST" for c in content.split())
    return f"""(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {key}
        ORDER BY coalesce(source_updated_at, ingested_at) DESC NULLS FIRST,
        ingested_at DESC NULLS LAST, {ties}) AS rn FROM ({source}) WHERE {where}) WHERE rn = 1)"""


_CLEAN_ORDERS = f"""
SELECT order_id, customer_id, CAST(order_created_at AS TIMESTAMP) AS order_created_at,
    CAST(order_created_at AS DATE) AS order_date,
    CASE WHEN lower(status) IN ('new', 'paid', 'shipped', 'returned', 'cancelled')
         THEN lower(status) ELSE 'new' END AS status,
    lower(trim(sales_channel)) AS sales_channel, upper(trim(currency)) AS currency,
    coalesce(CAST(nullif(discount_amount, '') AS DECIMAL(14,2)), 0) AS discount_amount,
    delivery_method, batch_date
FROM {_newest(_LANDED_ORDERS, "order_id", "customer_id order_created_at status sales_channel "
              "delivery_method discount_amount currency",
              "order_id IS NOT NULL AND customer_id IS NOT NULL AND order_created_at IS NOT NULL")}"""

_ITEM_CONTENT = (
    "order_id line_no part_sku qty unit_price_net unit_price_gross discount_amount tax_amount"
)


def _clean_items(landed: str) -> str:
    kept = (
        "order_item_id IS NOT NULL AND order_id IS NOT NULL AND part_sku IS NOT NULL "
        "AND CAST(qty AS DECIMAL(38,18)) > 0"
    )
    return f"""
SELECT order_item_id, order_id, CAST(line_no AS INTEGER) AS line_no, part_sku,
    CAST(CAST(qty AS DECIMAL(38,18)) AS DECIMAL(14,3)) AS qty,
    CAST(unit_price_net AS DECIMAL(14,2)) AS unit_price_net,
    CAST(unit_price_gross AS DECIMAL(14,2)) AS unit_price_gross,
    coalesce(CAST(nullif(discount_amount, '') AS DECIMAL(14,2)), 0) AS discount_amount,
    coalesce(CAST(nullif(tax_amount, '') AS DECIMAL(14,2)), 0) AS tax_amount, batch_date
FROM {_newest(landed, "order_item_id", _ITEM_CONTENT, kept)}"""


_CLEAN_CUSTOMERS = f"""
SELECT customer_id, nullif(lower(trim(email)), '') AS email, nullif(trim(phone), '') AS phone,
    lower(trim(segment)) AS segment, nullif(trim(country), '') AS country,
    nullif(trim(city), '') AS city, nullif(trim(postal_code), '') AS postal_code,
    nullif(trim(street), '') AS street, batch_date
FROM {_newest(_LANDED_CUSTOMERS, "customer_id",
              "email phone segment country city postal_code street", "customer_id IS NOT NULL")}"""

_CLEAN_PRODUCTS = f"""
SELECT part_sku, part_name, lower(trim(category)) AS category, brand, manufacturer,
    nullif(trim(oe_number), '') AS oe_number, nullif(trim(compatible_make), '') AS compatible_make,
    nullif(trim(compatible_model), '') AS compatible_model,
    CAST(nullif(compatible_year_from, '') AS INTEGER) AS compatible_year_from,
    CAST(nullif(compatible_year_to, '') AS INTEGER) AS compatible_year_to,
    coalesce(CAST(nullif(cost_net, '') AS DECIMAL(14,2)), 0) AS cost_net,
    coalesce(CAST(nullif(price_net, '') AS DECIMAL(14,2)), 0) AS price_net, batch_date
FROM {_newest(_LANDED_PRODUCTS, "part_sku", "part_name category brand", "part_sku IS NOT NULL")}"""

# The two overlapping batches of the dimension and fact queries.
_ORDER_BATCHES = f"""
cleaned AS ({_CLEAN_ORDERS}),
first_batch AS (SELECT * FROM cleaned WHERE order_date < DATE '1999-01-01'),
second_batch AS (SELECT * REPLACE ('cancelled' AS status) FROM cleaned
    WHERE order_date >= DATE '1998-01-01')"""

_CUSTOMER_BATCHES = f"""
cleaned AS ({_CLEAN_CUSTOMERS}),
first_batch AS (SELECT * FROM cleaned WHERE postal_code IS NOT NULL),
second_batch AS (SELECT * REPLACE ('new ' || segment AS segment) FROM cleaned
    WHERE phone IS NOT NULL)"""

# The star as loaded.
_ITEMS = """
items AS (SELECT l_orderkey, l_partkey, CAST(l_quantity AS DECIMAL(14,3)) AS qty,
    CAST(l_extendedprice AS DECIMAL(14,2)) AS price,
    CAST(CAST(l_quantity AS DECIMAL(14,3)) * CAST(l_extendedprice AS DECIMAL(14,2)) AS DECIMAL(14,2)) AS net,
    CAST(CAST(l_quantity AS DECIMAL(14,3)) * CAST(CAST(l_extendedprice AS DECIMAL(14,2))
        * (1 + CAST(l_tax AS DECIMAL(3,2))) AS DECIMAL(14,2)) AS DECIMAL(14,2)) AS gross
  FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
    l_extendedprice DESC, l_tax DESC) AS rn FROM lineitem) WHERE rn = 1)"""


def _mean(values: str, condition: str) -> str:
    """Decimal mean to six places in whole numbers: no float rounding on the way."""
    cents = f"CAST(sum({values}) FILTER (WHERE {condition}) * 100 AS HUGEINT)"
    rows = f"count(*) FILTER (WHERE {condition})"
    return (
        f"CAST(({cents} * 20000 + {rows}) // nullif(2 * {rows}, 0) AS DOUBLE) / 1000000"
    )


_DAILY = f"""count(DISTINCT order_key) AS orders_count,
    CAST(sum(net) AS DOUBLE) AS revenue_net, CAST(sum(gross) AS DOUBLE) AS revenue_gross,
    {_mean("net", "net > 0")} AS avg_line_value"""


def _cohorts(offset: str) -> str:
    return f"""
WITH first_orders AS (SELECT o_custkey, min(o_orderdate) AS first_day FROM orders GROUP BY 1)
SELECT CAST(CAST(date_trunc('month', first_day) AS DATE) AS VARCHAR) AS cohort_month,
    CAST({offset} AS INTEGER) AS month_offset, count(DISTINCT o_custkey) AS active_customers
FROM orders JOIN first_orders USING (o_custkey) GROUP BY 1, 2"""


_AGE = "age(date_trunc('month', o_orderdate), date_trunc('month', first_day))"

_TOP_PARTS = f"""
WITH {_ITEMS}
SELECT CAST(p_partkey AS VARCHAR) AS part_sku, p_name AS part_name, lower(p_type) AS category,
    p_brand AS brand, CAST(sum(qty) AS DOUBLE) AS units_sold, CAST(sum(net) AS DOUBLE) AS revenue_net
FROM items JOIN part ON p_partkey = l_partkey GROUP BY ALL"""


def _check(name: str, bad: str) -> str:
    return f"SELECT '{name}' AS check_name, count(*) AS bad_rows FROM ({bad})"


_SUM_MISMATCH = """SELECT o_orderkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey
    GROUP BY o_orderkey, o_totalprice
    HAVING abs(CAST(o_totalprice AS DECIMAL(14,2)) - sum(CAST(l_extendedprice AS DECIMAL(14,2)))) > 0.01"""


def _contract(table: str, rule: str, column: str, bad: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{rule}' AS rule, '{column}' AS column_name, "
        f"count(*) AS bad_rows FROM ({bad})"
    )


def _no_nulls(table: str, columns: str, nullable: dict[str, str] | None = None) -> list[str]:
    bad = nullable or {}
    nothing = "SELECT 1 FROM region WHERE false"
    return [_contract(table, "not_null", c, bad.get(c, nothing)) for c in columns.split()]


_NOTHING = "SELECT 1 FROM region WHERE false"
_URGENT = "SELECT 1 FROM orders WHERE o_orderpriority = '1-URGENT'"
_BIG = "SELECT 1 FROM orders WHERE o_totalprice > 400000"
_CONTRACTS = "\nUNION ALL ".join(
    [
        *_no_nulls("dim_date", "date_id date_day year quarter month day week day_of_week"),
        _contract("dim_date", "primary_key", "date_id", _NOTHING),
        _contract("dim_date", "unique", "date_day", _NOTHING),
        *_no_nulls("dim_channel", "channel_id channel_name"),
        _contract("dim_channel", "primary_key", "channel_id", _NOTHING),
        _contract("dim_channel", "unique", "channel_name", _NOTHING),
        *_no_nulls("dim_geography", "geography_id"),
        _contract("dim_geography", "primary_key", "geography_id", _NOTHING),
        _contract("dim_geography", "unique", "country+city+postal_code", _NOTHING),
        *_no_nulls("dim_customer", "customer_id customer_nk"),
        _contract("dim_customer", "primary_key", "customer_id", "SELECT c_custkey FROM customer GROUP BY 1 HAVING count(*) > 1"),
        _contract("dim_customer", "unique", "customer_nk",
                  "SELECT c_name FROM customer GROUP BY c_name HAVING count(*) > 1"),
        _contract("dim_customer", "references", "geography_id",
                  "SELECT 1 FROM customer JOIN nation ON c_nationkey = n_nationkey "
                  "JOIN region ON n_regionkey = r_regionkey "
                  "WHERE r_name = 'ASIA' AND c_mktsegment <> 'BUILDING'"),
        *_no_nulls("dim_product", "product_id part_sku"),
        _contract("dim_product", "primary_key", "product_id", "SELECT p_partkey FROM part GROUP BY 1 HAVING count(*) > 1"),
        _contract("dim_product", "unique", "part_sku",
                  "SELECT p_partkey FROM part GROUP BY 1 HAVING count(*) > 1"),
        *_no_nulls("fact_orders", "order_id order_nk customer_id date_id",
                   {"customer_id": _URGENT, "date_id": _BIG}),
        _contract("fact_orders", "primary_key", "order_id", "SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1"),
        _contract("fact_orders", "unique", "order_nk",
                  "SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1"),
        _contract("fact_orders", "references", "customer_id",
                  "SELECT 1 FROM orders WHERE o_orderpriority <> '1-URGENT' AND o_custkey NOT IN "
                  "(SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')"),
        _contract("fact_orders", "references", "date_id", _NOTHING),
        _contract("fact_orders", "references", "channel_id", _NOTHING),
        *_no_nulls("fact_order_items", "fact_order_item_id order_item_nk order_id product_id qty"),
        _contract("fact_order_items", "primary_key", "fact_order_item_id", "SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"),
        _contract("fact_order_items", "unique", "order_item_nk",
                  "SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"),
        _contract("fact_order_items", "references", "order_id",
                  "SELECT 1 FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)"),
        _contract("fact_order_items", "references", "product_id",
                  "SELECT 1 FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)"),
    ]
)

_STAGING_CONTRACTS = "\nUNION ALL ".join(
    [
        *_no_nulls("customers_clean", "customer_id batch_date"),
        _contract("customers_clean", "unique", "batch_date+customer_id", _NOTHING),
        *_no_nulls("products_clean", "part_sku batch_date"),
        _contract("products_clean", "unique", "batch_date+part_sku", "SELECT p_partkey FROM part GROUP BY 1"),
        *_no_nulls("orders_clean", "order_id customer_id order_created_at order_date status batch_date",
                   {"status": _URGENT}),
        _contract("orders_clean", "unique", "batch_date+order_id", _NOTHING),
        *_no_nulls("order_items_clean", "order_item_id order_id part_sku qty batch_date"),
        _contract("order_items_clean", "unique", "batch_date+order_item_id", _NOTHING),
    ]
)

_GATE_YEAR = "date_part('year', o_orderdate)"
_GATE_WRITTEN = f"(SELECT * FROM orders WHERE {_GATE_YEAR} >= 1998)"
_GATE = "\nUNION ALL ".join(
    [
        *_no_nulls("fact_orders", "order_id order_nk customer_id date_id",
                   {"customer_id": f"SELECT 1 FROM {_GATE_WRITTEN} WHERE o_orderpriority = '1-URGENT'",
                    "date_id": f"SELECT 1 FROM {_GATE_WRITTEN} WHERE o_totalprice > 400000"}),
        _contract("fact_orders", "unique", "order_nk", f"SELECT 1 FROM {_GATE_WRITTEN} GROUP BY o_orderkey HAVING count(*) > 1"),
        _contract("fact_orders", "unique_over_batches", "order_nk", f"SELECT 1 FROM orders WHERE {_GATE_YEAR} = 1998"),
        _contract("fact_orders", "primary_key", "order_id", f"SELECT 1 FROM {_GATE_WRITTEN} GROUP BY o_orderkey HAVING count(*) > 1"),
        _contract("fact_orders", "primary_key_over_batches", "order_id", f"SELECT 1 FROM orders WHERE {_GATE_YEAR} = 1998"),
        _contract("fact_orders", "kept", "order_id", f"SELECT 1 FROM orders WHERE {_GATE_YEAR} = 1997"),
        _contract("fact_orders", "references", "customer_id",
                  f"SELECT 1 FROM {_GATE_WRITTEN} WHERE o_orderpriority <> '1-URGENT' AND o_custkey NOT IN "
                  "(SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')"),
        _contract("fact_orders", "references", "date_id", _NOTHING),
        _contract("fact_orders", "references", "channel_id", f"SELECT 1 FROM {_GATE_WRITTEN} WHERE o_orderpriority = '1-URGENT'"),
    ]
)


def _day(column: str) -> str:
    return f"CAST({column} AS VARCHAR) AS {column}"


_CUSTOMER_VERSIONS = f"""
cleaned AS (SELECT * EXCLUDE (batch_date) FROM ({_CLEAN_CUSTOMERS})),
again AS (SELECT DATE '2001-12-10' AS day, * REPLACE ('main street' AS street) FROM cleaned WHERE email IS NULL),
sent AS (
    SELECT * FROM again
    UNION ALL SELECT DATE '2001-12-10', * FROM cleaned
        WHERE postal_code IS NOT NULL AND customer_id NOT IN (SELECT customer_id FROM again)
    UNION ALL SELECT DATE '2001-12-30', * REPLACE ('new ' || segment AS segment) FROM cleaned WHERE phone IS NOT NULL
    UNION ALL SELECT DATE '2001-12-31', * REPLACE ('new ' || segment AS segment) FROM cleaned WHERE phone IS NOT NULL
    UNION ALL SELECT DATE '2001-12-20', * REPLACE ('old ' || segment AS segment) FROM cleaned WHERE country IS NOT NULL),
marked AS (SELECT *, CASE WHEN row(email, phone, segment, country, city, postal_code, street) IS NOT DISTINCT FROM
        lag(row(email, phone, segment, country, city, postal_code, street)) OVER w THEN 0 ELSE 1 END AS changed
    FROM sent WINDOW w AS (PARTITION BY customer_id ORDER BY day)),
numbered AS (SELECT *, sum(changed) OVER (PARTITION BY customer_id ORDER BY day) AS run FROM marked),
versions AS (SELECT customer_id AS customer_nk, email, phone, segment, country, city, postal_code, street,
        min(day) AS valid_from, CAST(count(*) AS INTEGER) AS days_observed
    FROM numbered GROUP BY customer_id, email, phone, segment, country, city, postal_code, street, run),
intervals AS (SELECT *, lead(valid_from) OVER (PARTITION BY customer_nk ORDER BY valid_from) AS valid_to FROM versions)"""

_AS_OF_COSTS = f"""
items AS ({_clean_items(_LANDED_ITEMS)}),
products AS (SELECT part_sku, category, cost_net FROM ({_CLEAN_PRODUCTS})),
costs AS (SELECT part_sku, DATE '1995-01-01' AS day, cost_net, false AS late FROM products
    UNION ALL SELECT part_sku, DATE '1999-07-01', CAST(cost_net * CAST(1.25 AS DECIMAL(3,2)) AS DECIMAL(14,2)), false FROM products
    UNION ALL SELECT part_sku, DATE '1997-03-05', CAST(cost_net * CAST(0.5 AS DECIMAL(3,2)) AS DECIMAL(14,2)), true FROM products
        WHERE category IN ('promo', 'large')),
costed AS (SELECT i.*, p.cost_net AS present,
        (SELECT arg_max(c.cost_net, c.day) FROM costs c WHERE c.part_sku = i.part_sku
            AND c.day <= CAST(o_orderdate AS DATE)) AS held,
        (SELECT arg_max(c.cost_net, c.day) FROM costs c WHERE c.part_sku = i.part_sku
            AND c.day <= CAST(o_orderdate AS DATE) AND NOT c.late) AS first_held
    FROM items i JOIN orders ON CAST(o_orderkey AS VARCHAR) = i.order_id JOIN products p ON p.part_sku = i.part_sku),
margins AS (SELECT *, CAST(qty * unit_price_net - qty * coalesce(held, present) AS DECIMAL(14,2)) AS margin,
        CAST(qty * unit_price_net - qty * coalesce(first_held, present) AS DECIMAL(14,2)) AS first_margin FROM costed)"""

_RANGES = f"""
cleaned AS (SELECT part_sku, lower(compatible_make) AS make, lower(compatible_model) AS model,
        compatible_year_from AS low, compatible_year_to AS high FROM ({_CLEAN_PRODUCTS}) WHERE compatible_make IS NOT NULL),
sent AS (SELECT * FROM cleaned
    UNION ALL SELECT part_sku, make, model, high + 1 + high % 3, high + 10 FROM cleaned
    UNION ALL SELECT part_sku, make, model, 1960, coalesce(low, high) - high % 7 FROM cleaned),
years AS (SELECT DISTINCT part_sku, make, model, unnest(range(coalesce(low, -9999), coalesce(high, 9999) + 1)) AS year FROM sent),
islands AS (SELECT *, year - row_number() OVER (PARTITION BY part_sku, make, model ORDER BY year) AS island FROM years),
bridge AS (SELECT part_sku, make, model, CAST(nullif(min(year), -9999) AS INTEGER) AS year_from,
        CAST(nullif(max(year), 9999) AS INTEGER) AS year_to FROM islands GROUP BY part_sku, make, model, island)"""


ORACLE_SQL: dict[str, str] = {
    "raw_csv_ingest": f"""
SELECT * EXCLUDE (ingested_at, batch_date)
    REPLACE (CAST(source_updated_at AS VARCHAR) AS source_updated_at) FROM ({_LANDED_ITEMS})""",
    "raw_append_batches": f"""
WITH landed AS ({_LANDED_ORDERS}),
appended AS (
    SELECT '2001-12-30' AS batch_date, '2002-01-01 00:00:00' AS ingested_at, landed.* EXCLUDE (batch_date, ingested_at)
        FROM landed WHERE order_created_at < '1998-01-01'
    UNION ALL SELECT '2001-12-31', '2002-01-01 01:00:00', landed.* EXCLUDE (batch_date, ingested_at)
        FROM landed WHERE order_created_at >= '1998-01-01'
    UNION ALL SELECT '2001-12-31', '2002-01-01 02:00:00', landed.* EXCLUDE (batch_date, ingested_at)
        FROM landed WHERE order_created_at >= '1998-01-01')
SELECT batch_date, ingested_at, count(*) AS row_count, count(source_updated_at) AS dated_rows,
    CAST(sum(length(discount_amount)) AS BIGINT) AS discount_chars
FROM appended GROUP BY 1, 2""",
    "stg_orders_clean": f"""
SELECT order_id, customer_id, CAST(order_created_at AS VARCHAR) AS order_created_at,
    CAST(order_date AS VARCHAR) AS order_date, status, sales_channel, currency,
    CAST(discount_amount AS DOUBLE) AS discount_amount, delivery_method,
    CAST(batch_date AS VARCHAR) AS batch_date FROM ({_CLEAN_ORDERS})""",
    "stg_order_items_clean": f"""
SELECT order_item_id, order_id, line_no, part_sku, CAST(qty AS DOUBLE) AS qty,
    CAST(unit_price_net AS DOUBLE) AS unit_price_net,
    CAST(unit_price_gross AS DOUBLE) AS unit_price_gross,
    CAST(discount_amount AS DOUBLE) AS discount_amount, CAST(tax_amount AS DOUBLE) AS tax_amount,
    CAST(batch_date AS VARCHAR) AS batch_date FROM ({_clean_items(_LANDED_ITEMS)})""",
    "stg_customers_clean": f"""
SELECT * REPLACE (CAST(batch_date AS VARCHAR) AS batch_date) FROM ({_CLEAN_CUSTOMERS})""",
    "stg_products_clean": f"""
SELECT * REPLACE (CAST(compatible_year_from AS VARCHAR) AS compatible_year_from,
    CAST(compatible_year_to AS VARCHAR) AS compatible_year_to, CAST(cost_net AS DOUBLE) AS cost_net,
    CAST(price_net AS DOUBLE) AS price_net, CAST(batch_date AS VARCHAR) AS batch_date)
FROM ({_CLEAN_PRODUCTS})""",
    "stg_partition_replace": f"""
WITH cleaned AS ({_CLEAN_ORDERS})
SELECT '2001-12-30' AS batch_date, order_id, status, '2002-01-01 03:00:00' AS loaded_at
    FROM cleaned WHERE order_date >= DATE '1998-01-01' AND status <> 'paid'
UNION ALL SELECT '2001-12-31', order_id, status, '2002-01-01 02:00:00'
    FROM cleaned WHERE order_date < DATE '1998-01-01'""",
    "dim_date": """
SELECT DISTINCT CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS date_id,
    CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date_day,
    CAST(date_part('year', o_orderdate) AS INTEGER) AS year,
    CAST(date_part('quarter', o_orderdate) AS INTEGER) AS quarter,
    CAST(date_part('month', o_orderdate) AS INTEGER) AS month,
    CAST(date_part('day', o_orderdate) AS INTEGER) AS day,
    CAST(date_part('week', o_orderdate) AS INTEGER) AS week,
    CAST(date_part('isodow', o_orderdate) AS INTEGER) AS day_of_week
FROM orders""",
    "dim_channel": f"""
WITH {_ORDER_BATCHES}
SELECT DISTINCT sales_channel AS channel_name FROM (SELECT sales_channel FROM first_batch
    WHERE sales_channel > '3' UNION ALL SELECT sales_channel FROM second_batch)
WHERE sales_channel IS NOT NULL""",
    "dim_geography": f"""
WITH {_CUSTOMER_BATCHES}
SELECT DISTINCT country, city, postal_code
FROM (SELECT * FROM first_batch UNION ALL SELECT * FROM second_batch)
WHERE country IS NOT NULL OR city IS NOT NULL""",
    "dim_customer_upsert": f"""
WITH {_CUSTOMER_BATCHES}, merged AS (
    SELECT coalesce(s.customer_id, f.customer_id) AS customer_nk,
        CASE WHEN s.customer_id IS NULL THEN f.email ELSE s.email END AS email,
        CASE WHEN s.customer_id IS NULL THEN f.phone ELSE s.phone END AS phone,
        CASE WHEN s.customer_id IS NULL THEN f.segment ELSE s.segment END AS segment,
        coalesce(s.country, f.country) AS country, coalesce(s.city, f.city) AS city,
        coalesce(s.postal_code, f.postal_code) AS postal_code
    FROM first_batch f FULL OUTER JOIN second_batch s ON s.customer_id = f.customer_id)
SELECT customer_nk, email, phone, segment, country, city,
    CASE WHEN country IS NULL AND city IS NULL THEN NULL ELSE postal_code END AS postal_code
FROM merged""",
    "dim_product_upsert": f"""
WITH cleaned AS ({_CLEAN_PRODUCTS}),
f AS (SELECT * FROM cleaned WHERE category <> 'promo'),
s AS (SELECT * REPLACE (1 AS cost_net) FROM cleaned WHERE category <> 'large')
SELECT coalesce(s.part_sku, f.part_sku) AS part_sku, coalesce(s.part_name, f.part_name) AS part_name,
    coalesce(s.category, f.category) AS category, coalesce(s.brand, f.brand) AS brand,
    coalesce(s.oe_number, f.oe_number) AS oe_number,
    CAST(coalesce(s.cost_net, f.cost_net) AS DOUBLE) AS cost_net
FROM f FULL OUTER JOIN s ON s.part_sku = f.part_sku""",
    "fact_orders_upsert": f"""
WITH {_ORDER_BATCHES}, merged AS (
    SELECT * FROM second_batch UNION ALL
    SELECT * FROM first_batch WHERE order_id NOT IN (SELECT order_id FROM second_batch))
SELECT order_id AS order_nk, CAST(m.customer_id AS BIGINT) AS customer_id,
    CAST(strftime(order_date, '%Y%m%d') AS BIGINT) AS date_id, status AS order_status, currency,
    delivery_method, CAST(discount_amount AS DOUBLE) AS discount_amount,
    sales_channel AS channel_name
FROM merged m JOIN customer ON CAST(c_custkey AS VARCHAR) = m.customer_id AND c_acctbal >= 0""",
    "fact_order_items_upsert": f"""
WITH landed AS ({_LANDED_ITEMS}),
first_batch AS ({_clean_items("SELECT * FROM landed WHERE source_updated_at < TIMESTAMP '1999-01-01'")}),
second_batch AS ({_clean_items("SELECT * FROM landed WHERE source_updated_at >= TIMESTAMP '1998-01-01'")}),
products AS (SELECT * FROM ({_CLEAN_PRODUCTS}) WHERE category <> 'promo'),
known AS (SELECT 1 AS batch, * FROM first_batch UNION ALL SELECT 2, * FROM second_batch),
joined AS (SELECT * FROM known JOIN products USING (part_sku) WHERE order_id IN
    (SELECT CAST(o_orderkey AS VARCHAR) FROM orders))
SELECT order_item_id AS order_item_nk, CAST(order_id AS BIGINT) AS order_id,
    CAST(part_sku AS BIGINT) AS product_id, CAST(qty AS DOUBLE) AS qty,
    CAST(unit_price_net AS DOUBLE) AS unit_price_net,
    CAST(unit_price_gross AS DOUBLE) AS unit_price_gross,
    CAST(discount_amount AS DOUBLE) AS discount_amount, CAST(tax_amount AS DOUBLE) AS tax_amount,
    CAST(CAST(qty * unit_price_gross AS DECIMAL(14,2)) AS DOUBLE) AS gross_amount,
    CAST(CAST(qty * unit_price_net AS DECIMAL(14,2)) AS DOUBLE) AS net_amount,
    CAST(CAST(qty * unit_price_net - qty * cost_net AS DECIMAL(14,2)) AS DOUBLE) AS margin_amount
FROM joined QUALIFY row_number() OVER (PARTITION BY order_item_id ORDER BY batch DESC) = 1""",
    "mart_daily_sales": f"""
WITH {_ITEMS}
SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date_day, {_DAILY}
FROM (SELECT items.*, o_orderdate, o_orderkey AS order_key FROM items JOIN orders ON o_orderkey = l_orderkey)
GROUP BY 1""",
    "mart_top_parts": f"{_TOP_PARTS} ORDER BY sum(net) DESC NULLS FIRST, part_sku",
    "mart_top_parts_k": f"{_TOP_PARTS} ORDER BY sum(net) DESC NULLS FIRST, part_sku LIMIT 20",
    "mart_margin_by_category": f"""
WITH {_ITEMS}, lines AS (SELECT lower(p_type) AS category, net,
    CAST(qty * price - qty * CAST(CAST(p_retailprice AS DECIMAL(14,2))
        * CAST(0.60 AS DECIMAL(3,2)) AS DECIMAL(14,2)) AS DECIMAL(14,2)) AS margin
  FROM items JOIN part ON p_partkey = l_partkey),
sums AS (SELECT category, CAST(sum(net) * 100 AS HUGEINT) AS net, CAST(sum(margin) * 100 AS HUGEINT) AS margin
    FROM lines GROUP BY 1)
SELECT category, CAST(net AS DOUBLE) / 100 AS net_sales, CAST(margin AS DOUBLE) / 100 AS margin_value,
    CASE WHEN net = 0 THEN 0 ELSE sign(margin) * CAST((abs(margin) * 20000 + net) // (2 * net) AS DOUBLE) / 100
    END AS margin_pct
FROM sums""",
    "mart_cohort_retention": _cohorts(f"date_part('month', {_AGE})"),
    "mart_cohort_retention_full": _cohorts("date_diff('month', first_day, o_orderdate)"),
    "mart_rfm_segments": f"""
WITH {_ITEMS}, base AS (
    SELECT c_custkey AS customer_id, c_name AS customer_nk, lower(c_mktsegment) AS segment,
        CAST(max(o_orderdate) AS DATE) AS last_day, count(DISTINCT o_orderkey) AS frequency,
        coalesce(sum(net), 0) AS monetary
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey
    LEFT JOIN items ON l_orderkey = o_orderkey GROUP BY ALL)
SELECT customer_id, customer_nk, segment,
    CAST(DATE '2001-08-02' - coalesce(last_day, DATE '2001-08-02') AS INTEGER) AS recency_days, frequency,
    CAST(monetary AS DOUBLE) AS monetary,
    CASE WHEN frequency >= 10 AND monetary >= 5000 THEN 'champions'
         WHEN frequency >= 5 AND monetary >= 2000 THEN 'loyal'
         WHEN frequency <= 1 AND DATE '2001-08-02' - coalesce(last_day, DATE '2001-08-02') > 90
         THEN 'at_risk' ELSE 'regular' END AS rfm_segment
FROM base""",
    "dq_fact_orders_null_fk": _check(
        "fact_orders_null_fk",
        "SELECT 1 FROM orders WHERE o_orderpriority = '1-URGENT' OR o_totalprice > 400000",
    ),
    "dq_fact_order_items_missing_fk": _check(
        "fact_order_items_missing_fk",
        "SELECT 1 FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderpriority <> '1-URGENT') "
        "ON o_orderkey = l_orderkey LEFT JOIN (SELECT * FROM part WHERE p_type <> 'PROMO') "
        "ON p_partkey = l_partkey WHERE o_orderkey IS NULL OR p_partkey IS NULL",
    ),
    "dq_fact_orders_duplicates": _check(
        "fact_orders_duplicates",
        f"SELECT order_id FROM ({_LANDED_ORDERS}) GROUP BY 1 HAVING count(*) > 1",
    ),
    "dq_order_sum_mismatch": _check("order_sum_mismatch", _SUM_MISMATCH),
    "quality_report": " UNION ALL ".join(
        [
            _check(
                "fact_orders_null_fk",
                "SELECT 1 FROM orders WHERE o_custkey IS NULL OR o_orderdate IS NULL",
            ),
            _check(
                "fact_order_items_missing_fk",
                "SELECT 1 FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey "
                "LEFT JOIN part ON p_partkey = l_partkey "
                "WHERE o_orderkey IS NULL OR p_partkey IS NULL",
            ),
            _check(
                "fact_orders_duplicates",
                "SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1",
            ),
            _check("order_sum_mismatch", _SUM_MISMATCH),
        ]
    ),
    "contract_checks": _CONTRACTS,
    "contract_checks_staging": _STAGING_CONTRACTS,
    "run_audit_latest": """
WITH ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id
    ORDER BY date_trunc('second', ts) DESC, event_id DESC) AS rn,
    min(date_trunc('second', ts)) OVER (PARTITION BY user_id) AS started_at FROM events)
SELECT user_id AS run_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS run_date,
    strftime(started_at, '%Y-%m-%d %H:%M:%S') AS started_at,
    CASE WHEN event_type <> 'click' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS ended_at,
    CASE WHEN event_type = 'click' THEN 'RUNNING' ELSE event_type END AS status,
    event_id AS rows_loaded, CASE WHEN event_type = 'error' THEN props END AS error_message
FROM ranked WHERE rn = 1""",
    "latest_event_by_user": """
SELECT user_id, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "batch_daily_sales": f"""
WITH sent_orders AS ({_LANDED_ORDERS}),
orders_now AS (SELECT order_id, CAST(order_created_at AS DATE) AS order_date FROM sent_orders
    GROUP BY ALL),
landed AS ({_LANDED_ITEMS}),
lines AS (
    SELECT 1 AS batch, * FROM
        ({_clean_items("SELECT * FROM landed WHERE source_updated_at < TIMESTAMP '1999-01-01'")})
    WHERE order_id IN (SELECT order_id FROM orders_now WHERE order_date < DATE '1999-01-01')
    UNION ALL SELECT 2, * FROM
        ({_clean_items("SELECT * FROM landed WHERE source_updated_at >= TIMESTAMP '1998-01-01'")})),
kept AS (SELECT * FROM lines JOIN orders_now USING (order_id)
    WHERE part_sku IN (SELECT CAST(p_partkey AS VARCHAR) FROM part)
    QUALIFY row_number() OVER (PARTITION BY order_item_id ORDER BY batch DESC) = 1),
amounts AS (SELECT order_id AS order_key, order_date,
    CAST(qty * unit_price_net AS DECIMAL(14,2)) AS net,
    CAST(qty * unit_price_gross AS DECIMAL(14,2)) AS gross FROM kept)
SELECT CAST(order_date AS VARCHAR) AS date_day, {_DAILY} FROM amounts GROUP BY 1""",
    "dim_customer_history": f"""
WITH {_CUSTOMER_VERSIONS}
SELECT * REPLACE ({_day("valid_from")}, {_day("valid_to")}), valid_to IS NULL AS is_current FROM intervals""",
    "dim_customer_as_of": f"""
WITH {_CUSTOMER_VERSIONS}
SELECT * EXCLUDE (valid_to, days_observed) REPLACE ({_day("valid_from")}) FROM intervals
WHERE valid_from <= DATE '2001-12-25' AND coalesce(valid_to > DATE '2001-12-25', true)""",
    "fact_margin_asof": f"""
WITH {_AS_OF_COSTS}
SELECT order_item_id AS order_item_nk, CAST(part_sku AS BIGINT) AS product_id, CAST(qty AS DOUBLE) AS qty,
    CAST(CAST(qty * unit_price_net AS DECIMAL(14,2)) AS DOUBLE) AS net_amount, CAST(margin AS DOUBLE) AS margin_amount
FROM margins""",
    "fact_margin_repriced": f"""
WITH {_AS_OF_COSTS}
SELECT order_item_id AS order_item_nk, CAST(part_sku AS BIGINT) AS product_id, CAST(qty AS DOUBLE) AS qty,
    CAST(CAST(qty * unit_price_net AS DECIMAL(14,2)) AS DOUBLE) AS net_amount, CAST(margin AS DOUBLE) AS margin_amount,
    margin IS DISTINCT FROM first_margin AS corrected
FROM margins""",
    "bridge_product_compatibility": f"WITH {_RANGES} SELECT * FROM bridge",
    "bridge_product_gaps": f"""
WITH {_RANGES}, following AS (SELECT *, lead(year_from) OVER (PARTITION BY part_sku, make, model
    ORDER BY year_from NULLS FIRST) AS next FROM bridge)
SELECT part_sku, make, model, year_to + 1 AS gap_from, next - 1 AS gap_to FROM following WHERE next IS NOT NULL""",
    "fact_orders_replayed": f"""
WITH {_ORDER_BATCHES},
customers AS (SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_acctbal >= 0 AS early
    FROM customer WHERE c_mktsegment <> 'BUILDING' OR c_acctbal < 0),
sent AS (
    SELECT order_id, status, customer_id, 1 AS batch FROM first_batch WHERE order_id NOT IN (SELECT order_id FROM second_batch)
    UNION ALL SELECT order_id, status, customer_id, 2 FROM second_batch)
SELECT order_id AS order_nk, status AS order_status, NULL AS reason, CAST(NULL AS INTEGER) AS tries
    FROM sent WHERE customer_id IN (SELECT customer_id FROM customers)
UNION ALL SELECT order_id, status, 'unknown customer', CAST(3 - batch AS INTEGER)
    FROM sent WHERE customer_id NOT IN (SELECT customer_id FROM customers)""",
    "gate_delta_checks": _GATE,
    "quarantine_counts": f"""
WITH landed AS (SELECT DISTINCT *, CAST(order_id AS BIGINT) % 100 AS odd FROM ({_LANDED_ITEMS}))
SELECT 'order_items' AS table_name, column_name, reason, count(*) AS bad_cells FROM (
    SELECT 'qty' AS column_name, 'not a number' AS reason FROM landed WHERE odd = 1
    UNION ALL SELECT 'unit_price_net', 'too large' FROM landed WHERE odd = 2
    UNION ALL SELECT 'tax_amount', 'not a number' FROM landed WHERE odd IN (1, 3)
    UNION ALL SELECT 'line_no', 'not a whole number' FROM landed WHERE odd = 4
    UNION ALL SELECT 'line_no', 'too large' FROM landed WHERE odd = 5)
GROUP BY ALL""",
    "reconcile_layers": """
WITH months AS (SELECT strftime(l_shipdate, '%Y-%m') AS month, strftime(l_shipdate, '%m') AS m, l_returnflag AS flag FROM lineitem)
SELECT month, CAST(CASE WHEN m = '02' THEN -count(*) WHEN m = '09' THEN count(*) ELSE 0 END AS BIGINT) AS rows_more,
    CASE m WHEN '02' THEN 'rows lost' WHEN '09' THEN 'rows added' ELSE 'values changed' END AS verdict,
    CASE WHEN m = '05' THEN 'price' ELSE '' END AS changed
FROM months WHERE (m = '02' AND flag = 'R') OR (m = '05' AND flag = 'N') OR (m = '09' AND flag = 'A') GROUP BY month, m""",
}
for _mart in ("daily_sales", "top_parts", "margin_by_category", "cohort_retention", "rfm_segments"):
    ORACLE_SQL[f"kept_{_mart}"] = ORACLE_SQL[f"mart_{_mart}"]
ORACLE_SQL["stream_daily_sales"] = ORACLE_SQL["batch_daily_sales"]
