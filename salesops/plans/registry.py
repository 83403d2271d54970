"""All named queries by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from salesops.plans import (
    changes, documents, finance, monthly, procedures, rankings, requests, reshaping, scalars, selections, tuning, versions,
)

Query = Callable[[SparkSession, str], DataFrame]

_FUNCTIONS: list[Query] = [
    # selections and joins
    selections.items_by_name_pattern,
    selections.entities_without_children,
    selections.entities_without_children_full,
    selections.entities_without_children_not_in,
    selections.orders_price_or_quantity,
    selections.orders_price_or_quantity_page,
    selections.orders_price_or_quantity_deep_page,
    selections.orders_page_walk,
    selections.expected_deliveries,
    selections.expected_deliveries_by_month,
    selections.last_sales_with_ties,
    selections.buyers_of_item,
    selections.sellers_without_sale_on_day,
    selections.cheapest_items,
    selections.cheapest_items_in,
    selections.items_at_minimal_price,
    selections.largest_payers,
    selections.largest_payers_ascending,
    selections.cities_of_dearest_items,
    selections.large_invoices_with_picked_total,
    # monthly reports
    monthly.monthly_price_and_sales,
    monthly.months_over_threshold,
    monthly.slow_items_by_month,
    monthly.months_zero_filled,
    monthly.slow_items_zero_filled,
    monthly.running_month_total_selfjoin,
    monthly.running_month_total_window,
    monthly.running_month_totals,
    monthly.months_with_sales,
    monthly.customer_range_profile,
    monthly.order_and_line_counts,
    # windows
    rankings.top2_items_by_month,
    rankings.item_functions,
    rankings.last_customer_by_seller,
    rankings.top2_purchases_by_customer,
    rankings.top2_prices_by_customer_apply,
    rankings.customer_price_ranks,
    rankings.top2_orders_per_customer,
    rankings.line_tiles,
    rankings.order_neighbours,
    rankings.running_order_count,
    rankings.customer_name_ranks,
    rankings.line_share_of_order,
    # pivots and unpivots
    reshaping.customer_month_pivot,
    reshaping.customer_month_pivot_dynamic,
    reshaping.customer_month_long,
    reshaping.addresses_unpivot,
    reshaping.codes_unpivot,
    reshaping.segment_list_by_nation,
    reshaping.customer_list_by_nation,
    # scalar functions
    scalars.order_date_parts,
    scalars.days_to_ship,
    scalars.item_texts,
    scalars.customer_names_trimmed,
    # table changes and files
    changes.insert_marked,
    changes.insert_then_count,
    changes.delete_marked,
    changes.update_marked,
    changes.update_balances,
    changes.merge_customers,
    changes.merge_customers_log,
    changes.merge_parties,
    changes.merge_parties_log,
    changes.delimited_roundtrip,
    changes.delimited_roundtrip_wide,
    changes.delimited_documents,
    changes.new_dictionary_day,
    changes.materialized_customers,
    # versions of stored tables
    versions.merge_month,
    versions.merge_month_log,
    versions.correct_month,
    versions.insert_after_delete,
    # XML, JSON, property lists
    documents.xml_shred,
    documents.xml_accepted,
    documents.xml_rejected,
    documents.xml_roundtrip,
    documents.xml_merge,
    documents.xml_merge_log,
    documents.json_columns,
    documents.json_tag_filter,
    documents.json_tag_rows,
    documents.event_properties,
    documents.property_list,
    # functions and procedures
    procedures.customer_with_max_invoice,
    procedures.invoices_of_customer,
    procedures.invoices_of_customers,
    procedures.invoices_by_function,
    procedures.best_customer_by_function,
    # tuning pair
    tuning.tuned_cross_billing,
    tuning.cross_billing_original,
    # finance
    finance.seed_and_validate_finance,
    finance.check_account_fields,
    finance.check_account_clients,
    finance.check_line_keys,
    finance.dictionary_upsert,
    finance.dictionary_upsert_log,
    finance.insert_reports_seed,
    finance.account_upsert,
    finance.staging_resolve,
    finance.posting_reconcile,
    finance.posting_reconcile_again,
    finance.postings_in_period,
    finance.postings_in_period_by_month,
    # streaming
    requests.report_requests_stream,
    requests.report_requests_batches,
    requests.report_requests_as_written,
    requests.report_requests_rejected,
    requests.report_requests_batch,
    requests.report_requests_delivered_twice,
    requests.report_requests_compacted,
    requests.requests_answered,
    requests.requests_still_open,
]

QUERIES: dict[str, Query] = {f.__name__: f for f in _FUNCTIONS}
