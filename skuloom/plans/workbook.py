"""Reports that belong together, as bundles of tables. Nothing runs until they are written."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from skuloom.plans import ageing, catalog, purchase, sales, sellers
from skuloom.sources.writers import write_bundle, write_report

Inputs = Mapping[str, DataFrame]

# Input tables of the workbook.
WORKBOOK_INPUTS = (
    "catalog", "sales_paid", "sales_shipped", "order_lines", "today_sales", "stock",
    "purchase_history", "purchase_current", "sales_history", "sales_current",
    "channel", "size_rule", "module",
)


def daily_workbook(inputs: Inputs, excluded_styles: Sequence[str] = ()) -> dict[str, DataFrame]:
    """The thirteen merchandise tables of one day.

    No style is left out by default; a caller that wants some left out of the active SKCs names them.
    """
    return {
        "active_skc": catalog.active_skc(inputs, excluded_styles=excluded_styles),
        "catalog": catalog.catalog_clean(inputs),
        "stock": catalog.stock_by_sku(inputs),
        "purchase_history": purchase.purchase_history(inputs),
        "today_sales": sales.today_sales(inputs),
        "sales_detail": sales.sales_detail(inputs),
        "shipped_daily": sales.shipped_daily(inputs),
        "paid_summary": sales.paid_summary(inputs),
        "shipped_detail": sales.shipped_detail(inputs),
        "paid_detail": sales.paid_detail(inputs),
        "first_hot_day": sales.first_hot_day(inputs),
        "all_time_sales": sales.all_time_sales(inputs),
        "first_purchase": purchase.first_purchase(inputs),
    }


def _write(sheets: Mapping[str, DataFrame], path: str, as_unit: bool) -> str | None:
    """A directory per table, or with `as_unit` a run that readers see whole or not at all (`read_run`), and its name."""
    return write_bundle(sheets, path) if as_unit else write_report(sheets, path)


def write_daily_workbook(
    inputs: Inputs, path: str, excluded_styles: Sequence[str] = (), as_unit: bool = False
) -> str | None:
    return _write(daily_workbook(inputs, excluded_styles), path, as_unit)


def sellers_workbook(inputs: Inputs, as_of: dt.date) -> dict[str, DataFrame]:
    """Best styles of yesterday and of the week, their shares, and the titles."""
    return {
        "top20": sellers.top_styles(inputs, as_of, days=1, k=20),
        "top30": sellers.top_styles(inputs, as_of, days=7, k=30),
        "top36": sellers.top_shares(inputs, as_of, k=36),
        "titles": sellers.title_table(inputs),
    }


def write_sellers_workbook(inputs: Inputs, path: str, as_of: dt.date, as_unit: bool = False) -> str | None:
    return _write(sellers_workbook(inputs, as_of), path, as_unit)


def ageing_workbook(inputs: Inputs, as_of: dt.date) -> dict[str, DataFrame]:
    """Stock by class and age, and the stock lines."""
    return {"ageing": ageing.stock_ageing(inputs, as_of), "detail": ageing.ageing_detail(inputs, as_of)}


def write_ageing_workbook(inputs: Inputs, path: str, as_of: dt.date, as_unit: bool = False) -> str | None:
    return _write(ageing_workbook(inputs, as_of), path, as_unit)
