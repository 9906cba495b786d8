"""Hand-written deliveries for batch tests."""

from __future__ import annotations

import csv
from pathlib import Path

HEADERS = {
    "customers": "customer_id email phone segment country city postal_code street source_updated_at",
    "products": "part_sku part_name category brand manufacturer oe_number compatible_make "
    "compatible_model compatible_year_from compatible_year_to cost_net price_net source_updated_at",
    "orders": "order_id customer_id order_created_at status sales_channel delivery_method "
    "discount_amount currency source_updated_at",
    "order_items": "order_item_id order_id line_no part_sku qty unit_price_net unit_price_gross "
    "discount_amount tax_amount source_updated_at",
}


def customer(key, segment="detal", postal="00-001", country="PL", city="Lodz", at="2026-01-01 10:00:00"):
    return [key, f" {key}@X.PL ", "", segment, country, city, postal, "Polna 1", at]


def product(sku, cost="10.00", category=" Filtry ", at="2026-01-01 10:00:00"):
    return [sku, f"part {sku}", category, "B1", "M1", "", "VW", "Golf", "2001", "", cost, "20.00", at]


def order(key, who, created="2026-01-01 09:00:00", status="PAID", discount="1.00", at="2026-01-01 10:00:00"):
    return [key, who, created, status, " Web ", "courier", discount, " pln ", at]


def item(key, order_key, sku, qty="2", net="50.00", discount="1.00", at="2026-01-01 10:00:00"):
    return [key, order_key, "1", sku, qty, net, "61.50", discount, "23.00", at]


def deliver(root, day: str, **tables) -> None:
    folder = Path(root) / day
    folder.mkdir(parents=True, exist_ok=True)
    for name, header in HEADERS.items():
        with (folder / f"{name}.csv").open("w", newline="", encoding="utf-8") as out:
            writer = csv.writer(out)
            writer.writerow(header.split())
            writer.writerows(tables.get(name, []))
