"""Cleaning rules on hand-written landing rows."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest

from orderloom.operators import clean
from orderloom.schemas import RAW

LOADED, DAY = datetime(2026, 1, 1, 12), date(2026, 1, 1)


def landed(spark, table, *rows):
    """Rows as dicts; what is left out is NULL."""
    schema = RAW[table].schema
    base = {"ingested_at": LOADED, "batch_date": DAY}
    return spark.createDataFrame([tuple({**base, **r}.get(c) for c in schema.names) for r in rows], schema)


def order(key="O1", at=None, **rest):
    row = {"order_id": key, "customer_id": "C1", "order_created_at": "2026-01-01 23:10:05"}
    return {**row, "source_updated_at": at, **rest}


def item(key="I1", at=None, **rest):
    row = {"order_item_id": key, "order_id": "O1", "part_sku": "S1", "qty": "2", "line_no": "1"}
    return {**row, "source_updated_at": at, **rest}


def only(df):
    (row,) = df.collect()
    return row


@pytest.mark.parametrize(
    ("sent", "kept"),
    [("PAID", "paid"), ("Cancelled", "cancelled"), (" paid", "new"), ("weird", "new"), ("", "new"), (None, "new")],
)
def test_status(spark, sent, kept):
    assert only(clean.clean_orders(landed(spark, "orders", order(status=sent)))).status == kept


def test_order_columns(spark):
    row = only(
        clean.clean_orders(
            landed(
                spark, "orders",
                order(sales_channel=" Web ", currency=" pln ", discount_amount="", delivery_method=" As is "),
            )
        )
    )
    assert row.order_created_at == datetime(2026, 1, 1, 23, 10, 5)
    assert row.order_date == DAY
    assert (row.sales_channel, row.currency, row.delivery_method) == ("web", "PLN", " As is ")
    assert row.discount_amount == Decimal("0.00")


def test_order_needs_its_keys(spark):
    rows = [order("O1", customer_id=None), order(None), order("O3", order_created_at=None), order("")]
    assert [r.order_id for r in clean.clean_orders(landed(spark, "orders", *rows)).collect()] == [""]


def test_latest_version_wins(spark):
    early, late = datetime(2026, 1, 1, 8), datetime(2026, 1, 1, 9)
    rows = [order(at=early, status="new"), order(at=late, status="shipped"), order(at=early, status="paid")]
    assert only(clean.clean_orders(landed(spark, "orders", *rows))).status == "shipped"


def test_load_time_stands_in_for_a_missing_source_time(spark):
    rows = [order(at=datetime(2026, 1, 1, 11), status="paid"), order(at=None, status="shipped")]
    assert only(clean.clean_orders(landed(spark, "orders", *rows))).status == "shipped"
    rows[0]["source_updated_at"] = datetime(2026, 1, 1, 13)
    assert only(clean.clean_orders(landed(spark, "orders", *rows))).status == "paid"


def test_equal_times_are_settled_the_same_way_in_any_order(spark):
    rows = [order(status=s, discount_amount=d) for s in ("paid", "new") for d in ("1", "2")]
    first = only(clean.clean_orders(landed(spark, "orders", *rows)))
    again = only(clean.clean_orders(landed(spark, "orders", *reversed(rows)).repartition(4)))
    assert first == again


@pytest.mark.parametrize(
    ("qty", "kept"),
    [("0", None), ("-1", None), (None, None), ("0.0004", "0.000"), ("2.0005", "2.001"), (" 3 ", "3.000"),
     ("0.0000000000000000001", "0.000"), ("-0.0000000000000000001", None), ("1e-25", "0.000"), ("0e7", None), ("+.5", "0.500")],
)
def test_quantity(spark, qty, kept):
    rows = clean.clean_order_items(landed(spark, "order_items", item(qty=qty))).collect()
    assert [r.qty for r in rows] == ([Decimal(kept)] if kept else [])


def test_item_amounts(spark):
    row = only(
        clean.clean_order_items(
            landed(spark, "order_items", item(unit_price_net="10.005", discount_amount="", tax_amount=None))
        )
    )
    assert (row.unit_price_net, row.unit_price_gross) == (Decimal("10.01"), None)
    assert (row.discount_amount, row.tax_amount, row.line_no) == (Decimal("0.00"), Decimal("0.00"), 1)


@pytest.mark.parametrize("column", ["qty", "unit_price_net", "discount_amount", "line_no"])
def test_bad_numbers_fail_the_batch(spark, column):
    rows = landed(spark, "order_items", item(**{column: "abc"}))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        clean.clean_order_items(rows).collect()


def test_bad_dates_fail_the_batch(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        clean.clean_orders(landed(spark, "orders", order(order_created_at="soon"))).collect()


def test_customer_text(spark):
    row = only(
        clean.clean_customers(
            landed(
                spark, "customers",
                {"customer_id": "C1", "email": " A@X.PL ", "phone": "  ", "segment": " ", "city": " Lodz "},
            )
        )
    )
    assert (row.email, row.phone, row.segment, row.city, row.country) == ("a@x.pl", None, "", "Lodz", None)


def test_product_columns(spark):
    row = only(
        clean.clean_products(
            landed(
                spark, "products",
                {
                    "part_sku": "S1", "part_name": " As is ", "category": " Filtry ", "oe_number": " ",
                    "compatible_year_from": "", "compatible_year_to": "2020", "cost_net": "", "price_net": "9.999",
                },
            )
        )
    )
    assert (row.part_name, row.category, row.oe_number) == (" As is ", "filtry", None)
    assert (row.compatible_year_from, row.compatible_year_to) == (None, 2020)
    assert (row.cost_net, row.price_net) == (Decimal("0.00"), Decimal("10.00"))


def test_year_with_a_point_fails(spark):
    rows = landed(spark, "products", {"part_sku": "S1", "compatible_year_from": "1.0"})
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        clean.clean_products(rows).collect()
