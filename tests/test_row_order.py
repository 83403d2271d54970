"""The order in which sorted reports give their rows, by the columns that they show."""

import pytest

from salesops.plans.registry import QUERIES

# report -> its sort columns among those shown; "-" marks a descending one
ORDERS = {
    "monthly_price_and_sales": ["date_year", "date_month"],
    "slow_items_by_month": ["date_year", "date_month", "item_name"],
    "months_zero_filled": ["date_year", "date_month"],
    "orders_price_or_quantity": ["quarter", "third"],
    "orders_price_or_quantity_page": ["quarter", "third"],
    "orders_page_walk": ["-order_date"],
    "expected_deliveries": ["supplier_name"],
    "item_functions": ["item_name", "item_id"],
    "last_customer_by_seller": ["seller_name", "seller_id"],
    "addresses_unpivot": ["customer_name", "address_line"],
    "codes_unpivot": ["item_id", "code"],
    "tuned_cross_billing": ["customer_id", "item_id"],
    "cross_billing_original": ["customer_id", "item_id"],
}


@pytest.mark.parametrize("name", ORDERS)
def test_rows_come_in_order(spark, sf, name):
    got = [r.asDict() for r in QUERIES[name](spark, sf).collect()]
    assert got
    want = list(got)
    for col in reversed(ORDERS[name]):  # stable sorts from the last column to the first; NULL first ascending, last descending
        col, down = col.lstrip("-"), col.startswith("-")
        want.sort(key=lambda r: (r[col] is not None, r[col]) if r[col] is not None else (False,), reverse=down)
    assert want == got
