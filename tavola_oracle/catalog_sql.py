"""Oracle SQL per query name (DuckDB over the raw parquet views)."""

from __future__ import annotations

from tavola_oracle import views_sql as V
from tavola_oracle.mart_sql import stable

ORACLE: dict[str, str] = {
    "current_base_cost_first": V.current_base_cost("Beer", "first"),
    "current_base_cost_last": V.current_base_cost("Liquor", "last"),
    "current_base_cost_wine": V.current_base_cost("Wine", "first"),
    "stock_category_totals": stable(V.stockcount_category_totals(), "date"),
    "stock_conversion": stable(V.stockcount_conversion(), "date"),
    "stock_monthly_densified": stable(V.stockcount_monthly(), "date"),
    "stock_purchases": stable(V.stockcount_purchases(), "date"),
    "stock_waste": stable(V.stockcount_waste(), "date"),
    "stock_waste_fanout": stable(V.stockcount_waste(fanout=True), "date"),
}

from tavola_oracle import sales_sql as S  # noqa: E402

ORACLE.update({
    "theoretical_usage": S.stockcount_sales(V.AS_OF),
    "theoretical_usage_single_concept": S.stockcount_sales_single_concept(V.AS_OF),
})

from tavola_oracle import cost_sql as C  # noqa: E402

ORACLE.update({
    "latest_item_price": C.latest_item_price(),
    "weekly_item_base_cost": C.weekly_item_base_cost(2000, 6, 2),
    "weekly_base_cost_year": C.weekly_base_cost_year((2000,)),
    "weekly_base_cost_all": C.weekly_cost_spans(),
    "weekly_base_cost_by_store": C.weekly_base_cost_by_store(),
    "weekly_cost_increment": C.weekly_cost_spans(),
})

from tavola_oracle import menu_sql as M  # noqa: E402

ORACLE.update({
    "menu_engineering": M.menu_engineering("2001-08-01", 2001, 8),
    "menu_rating": M.menu_rating(),
    "menu_rating_totals": M.menu_rating_totals(),
    "uncategorised_top25": M.uncategorised_top25(),
})

from tavola_oracle import recipes_sql as RC  # noqa: E402

ORACLE.update({
    "recipe_explosion": RC.recipe_explosion(),
    "menu_item_recipes": RC.menu_item_recipes(),
    "recipe_base_units": RC.recipe_base_units(),
    "menu_cost_converted": RC.menu_cost_converted(),
})

from tavola_oracle import maintenance_sql as MT  # noqa: E402

ORACLE.update({
    "upsert_full": MT.upsert_full(),
    "upsert_subset": MT.upsert_subset(),
    "replace_keys": MT.replace_keys(),
    "drop_superseded_any": MT.drop_superseded_any(),
    "drop_superseded_absent": MT.drop_superseded_absent(),
    "replace_range": MT.replace_range(),
    "replace_year": MT.replace_year(),
    "sync_full": MT.sync_full(),
    "find_renamed": MT.renamed_customers(),
    "apply_renames": MT.orders_with_renames(),
    "dedup_keep_last": MT.events_dedup("last"),
    "dedup_keep_first": MT.events_dedup("first"),
    "fk_validate": MT.orders_fk_validated(),
    "duplicate_report": MT.lineitem_duplicates(),
})

from tavola_oracle import dims_sql as D  # noqa: E402

ORACLE.update({
    "fiscal_calendar": D.fiscal_calendar(),
    "calendar_rollforward": D.calendar_rollforward(),
    "fiscal_range": D.fiscal_range(),
    "business_date_0400": D.business_date_0400(),
    "budget_unpivot": D.budget_unpivot(),
    "item_name_parts": D.item_name_parts(),
    "paren_negative": D.invoice_money_text(),
})

from tavola_oracle import pos_sql as P  # noqa: E402

ORACLE.update({
    "payment_summary": P.payment_summary(),
    "product_mix_nested": P.product_mix(),
})

from tavola_oracle import reports_sql as RP  # noqa: E402

ORACLE.update({
    "receiving_vendor": RP.receiving("VendorName"),
    "receiving_location": RP.receiving("LocationName"),
    "stock_category_margins": RP.category_margins(2, 6, 2000),
    "recipe_cost_snapshot": RP.recipe_cost(V.AS_OF),
    "menu_items": RP.menu_items(),
    "unmapped_items": RP.unmapped_items(),
    "item_conversion_sync": RP.item_conversion(),
    "holidays": RP.holidays(),
})

from tavola_oracle import feeds_sql as FD  # noqa: E402

ORACLE.update({
    "feed_transaction": FD.transaction(), "feed_transaction_detail": FD.transaction_detail(),
    "feed_labor_detail": FD.labor_detail(), "feed_sales_detail": FD.sales_detail(),
    "feed_sales_employee": FD.summaries("click", "salesid"), "feed_sales_payment": FD.summaries("purchase", "salespaymentid"),
    "dss_list": FD.dss_list(), "dim_job_titles": FD.job_titles(), "dim_sales_accounts": FD.sales_accounts(),
    "dim_purchase_items": FD.purchase_items(), "dim_units": FD.units(),
})

from tavola_oracle import records_sql as RS  # noqa: E402

ORACLE.update({
    "menu_tree": RS.MENU_TREE, "pos_item_dictionary": RS.DICTIONARY, "store_config": RS.STORE_CONFIG,
    "daily_sales_totals": RS.DAILY_TOTALS, "payment_ids": RS.PAYMENT_IDS, "item_part_b": RS.PART_B,
})

from tavola_oracle import streams_sql as ST  # noqa: E402

ORACLE["stream_sales_upsert"] = ST.sales_stream()

from tavola_oracle import checks_sql as CK  # noqa: E402

ORACLE.update({
    "menu_report": M.menu_report(), "menu_report_by_quantity": M.menu_report("quantity", "profit"),
    "uncategorised_top25_quantity": M.uncategorised_top25("quantity"),
    "check_counts": CK.CHECK_COUNTS, "quarantined_lines": CK.QUARANTINED, "accepted_totals": CK.ACCEPTED, "null_lines": CK.NULL_LINES,
    "unmapped_units": CK.UNMAPPED, "received_lines": CK.RECEIVED, "store_sums": CK.STORE_SUMS, "store_means": CK.STORE_MEANS,
    "orders_with_customer": CK.ORDERS_CUSTOMER, "order_weeks": CK.ORDER_WEEKS, "business_days": CK.business_days(),
    "payment_rows": CK.PAYMENT_ROWS, "budget_long": D.budget_long(), "item_labels": CK.ITEM_LABELS,
    "fiscal_totals": CK.FISCAL_TOTALS, "store_days": CK.STORE_DAYS,
})

from tavola_oracle import loads_sql as LD  # noqa: E402

ORACLE.update({
    "dim_gl_accounts": LD.GL_ACCOUNTS, "dim_locations": LD.LOCATIONS, "dim_companies": LD.COMPANIES, "dim_items": LD.ITEMS,
    "dim_purchase_items_all": LD.PURCHASE_ITEMS, "dim_recipes": LD.RECIPES, "inventory_headers": LD.INVENTORY_HEADERS,
    "invoice_headers": LD.INVOICE_HEADERS, "product_mix_table": LD.product_mix_table(), "menu_items_table": LD.menu_items_table(),
    "budget_table": LD.budget_table(), "weekly_cost_table": LD.weekly_cost_table(2000, 6, 2),
})
