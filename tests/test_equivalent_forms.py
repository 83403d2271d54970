"""Two formulations of one report must agree on the test tables."""

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from salesops.plans import changes, documents, monthly, procedures, rankings, reshaping, selections, tuning
from salesops.sources import sales
from tests.conftest import rows


def test_anti_join_forms(spark, sf):
    left = rows(selections.entities_without_children(spark, sf))
    assert left
    assert left == rows(selections.entities_without_children_full(spark, sf))
    assert left == rows(selections.entities_without_children_not_in(spark, sf))


def test_top_n_and_in_form(spark, sf):
    assert rows(selections.cheapest_items(spark, sf)) == rows(selections.cheapest_items_in(spark, sf))


def test_running_total_forms(spark, sf):
    assert rows(monthly.running_month_total_selfjoin(spark, sf)) == rows(monthly.running_month_total_window(spark, sf))


def test_pages_partition_the_report(spark, sf):
    whole = [tuple(r) for r in selections.orders_price_or_quantity(spark, sf).collect()]
    pages = []
    for num in range(1, len(whole) // 400 + 2):
        pages += [tuple(r) for r in selections.orders_price_or_quantity_page(spark, sf, 0, 400, num).collect()]
    assert sorted(pages) == sorted(whole) and [p[:1] for p in pages] == [w[:1] for w in whole]


def test_sort_by_text_is_not_by_date(spark, sf):
    by_date = [r.order_date_text for r in selections.orders_price_or_quantity(spark, sf).collect()]
    by_text = [r.order_date_text for r in selections.orders_price_or_quantity(spark, sf, by_text=True).collect()]
    assert sorted(by_date) == sorted(by_text) and by_date != by_text


def test_ties_are_complete(spark, sf):
    heads = sales.orders(spark, sf)
    for n in (1, 3, 10):
        ranked = heads.withColumn("r", F.rank().over(W.orderBy(F.col("order_date").desc()))).filter(F.col("r") <= n)
        assert rows(selections.last_sales_with_ties(spark, sf, n).select("order_id")) == rows(ranked.select("order_id"))


def test_apply_form_keeps_price_ties(spark, sf):
    """The ranked form gives at most two purchases per customer, the apply form all items at the two top prices."""
    per_customer = rankings.top2_purchases_by_customer(spark, sf).groupBy("customer_id").count()
    assert per_customer.filter("count > 2").count() == 0
    prices = rankings.top2_prices_by_customer_apply(spark, sf).groupBy("customer_id").agg(F.countDistinct("top_price").alias("n"))
    assert prices.filter("n > 2").count() == 0


def test_function_forms(spark, sf):
    assert rows(procedures.invoices_by_function(spark, sf)) == rows(procedures.invoices_of_customers(spark, sf))
    best = procedures.customer_id_with_max_invoice(spark, sf)
    by_id = rows(procedures.invoices_of_customer(spark, sf, best))
    assert by_id and by_id == rows(procedures.invoices_of_customer(spark, sf, -123))
    one = spark.createDataFrame([(best,), (10**9,)], "customer_id bigint")
    applied = rows(procedures.invoices_of_customers(spark, sf, one))
    assert applied == sorted(by_id + [(10**9, None, None, None)], key=repr)


def test_fan_out_forms(spark, sf):
    """Counting the movements per item equals joining them one by one."""
    mine = tuning.tuned_cross_billing(spark, sf)
    assert mine.count() > 0
    assert rows(mine) == rows(tuning.cross_billing_original(spark, sf))
    lines = sales.lines(spark, sf)
    plain = (
        lines.alias("d").join(sales.items(spark, sf).filter("brand = 'Brand#12'"), "item_id")
        .join(sales.orders(spark, sf).select("order_id", "customer_id", "order_date"), "order_id")
        .join(tuning.invoices(spark, sf).select("order_id", "invoice_date", "bill_to_id"), "order_id")
        .filter("bill_to_id <> customer_id AND invoice_date = order_date")
        .join(lines.select(F.col("item_id").alias("moved_item")), F.col("item_id") == F.col("moved_item"))
        .groupBy("customer_id", "item_id").agg(F.count("*").alias("n"))
    )
    got = mine.select("customer_id", "item_id", "order_count")
    assert got.exceptAll(plain).count() == 0


def test_dynamic_pivot_refuses_too_many_columns(spark, sf):
    from salesops.operators.reshape import pivot_dynamic

    cells = sales.orders(spark, sf).groupBy("status", "priority").agg(F.count("*").alias("n"))
    wide = pivot_dynamic(cells, "status", "priority", "n", limit=5)
    assert wide.columns == ["status", "1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    with pytest.raises(ValueError, match="more than 4"):
        pivot_dynamic(cells, "status", "priority", "n", limit=4)


def test_pivots_are_sorted_by_date(spark, sf):
    for report in (reshaping.customer_month_pivot, reshaping.customer_month_pivot_dynamic):
        months = [r.invoice_month for r in report(spark, sf).collect()]
        assert months == sorted(months, key=lambda m: m.split(".")[::-1]) != sorted(months)
        assert [r.invoice_month for r in report(spark, sf, by_text=True).collect()] == sorted(months)


def test_pivot_cells_and_nulls(spark, sf):
    pivot = reshaping.customer_month_pivot(spark, sf)
    total = sum(v or 0 for r in pivot.collect() for v in r[1:])
    assert total == sales.orders(spark, sf).count()


def test_xml_file_and_column_agree(spark, sf):
    shredded = documents.xml_shred(spark, sf).drop("StockItemID")
    assert rows(shredded) == rows(documents.xml_roundtrip(spark, sf))


def test_insert_adds_five(spark, sf):
    counts = changes.insert_then_count(spark, sf).first()
    assert counts.rows_after == counts.rows_before + 5 and counts.marked_rows == 5
