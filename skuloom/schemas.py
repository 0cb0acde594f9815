"""Schemas of the input tables. Every table may also carry `_ord`, its ingest order."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "S": T.StringType(),
    "D": T.DoubleType(),
    "I": T.IntegerType(),
    "TS": T.TimestampNTZType(),
}


def _schema(lenient: str = "", **columns: str) -> T.StructType:
    """Columns by type; `lenient` ones read null where a text cannot be read, others raise."""
    fields = [
        T.StructField(name, _TYPES[kind], metadata={"lenient": name in lenient.split()})
        for kind, names in columns.items()
        for name in names.split()
    ]
    return T.StructType([*fields, T.StructField("_ord", T.LongType())])


CATALOG = _schema(
    S="image_url style_code sku color spec category year season title supplier national_code",
    D="list_price cost",
    TS="created_at",
)
_SALES_TEXT = "channel shop sku style_code color_spec category"
_MEASURES = (
    "cost sold_qty shipped_qty shipped_amt sold_amt return_qty returned_qty return_amt returned_amt"
)
SALES = _schema(S=_SALES_TEXT, TS="date", D=_MEASURES)
ORDER_LINES = _schema(
    S="order_no shop sku streamer_id style_code color_spec category online_title claim_type",
    TS="paid_at claim_at claim_confirmed_at",
    D=_MEASURES,
)
TODAY_SALES = _schema(S="sku skc", D="sold_qty")
STOCK = _schema(
    S="style_code sku color spec",
    D="on_hand reserved return_wh inbound_wh on_order return_transit virtual available public_available",
)
PURCHASE_LINES = _schema(
    S="color_spec style_code row_type status remark tags supplier",
    TS="po_date",
    D="po_qty received_qty",
)
PO_LINES = _schema(
    S="po_no sku style_code color_spec category status tags remark",
    TS="po_date completed_at",
    D="po_qty received_qty",
)
RECEIPTS = _schema(S="po_no sku tags", TS="received_at po_date", D="qty")
SALES_HISTORY = _schema(S="style_code color_spec sold_qty return_qty")
STOCK_DAILY = _schema(S="sku skc", TS="date", D="opening_qty")
LIVE_SALES = _schema(lenient="paid_at", S="streamer_id style_code", TS="paid_at", D="sold_qty")
MERCH_BOARD = _schema(
    lenient="launch_date created_at last_order_date",
    S="style_code skc color class category plan_category image",
    TS="launch_date created_at last_order_date",
    D="available total_stock reserved cost avg3d_sales",
)
LISTINGS = _schema(
    S="shop site store_style store_sku online_style online_sku raw_sku online_title "
    "online_color_spec system_style system_sku system_title system_color_spec",
    D="shop_stock shop_price",
    I="is_listed",
)
CATEGORY = _schema(S="category plan_category")
CHANNEL = _schema(S="shop channel")
SIZE_RULE = _schema(S="spec spec_final")
MODULE = _schema(S="module uid")

TABLES = {
    "catalog": CATALOG,
    "sales_paid": SALES,
    "sales_shipped": SALES,
    "order_lines": ORDER_LINES,
    "today_sales": TODAY_SALES,
    "stock": STOCK,
    "purchase_history": PURCHASE_LINES,
    "purchase_current": PURCHASE_LINES,
    "po_lines": PO_LINES,
    "receipts": RECEIPTS,
    "sales_history": SALES_HISTORY,
    "sales_current": SALES_HISTORY,
    "stock_daily": STOCK_DAILY,
    "live_sales": LIVE_SALES,
    "merch_board": MERCH_BOARD,
    "listings": LISTINGS,
    "category": CATEGORY,
    "channel": CHANNEL,
    "size_rule": SIZE_RULE,
    "module": MODULE,
}

# Column headers of the exports, and the columns they stand for; a table takes the first that it has.
EXPORT_HEADERS = {
    "款式编码": "style_code", "款号": "style_code", "货号": "style_code", "颜色": "color", "规格": "spec", "规格终": "spec_final",
    "颜色规格": "color_spec", "款色": "skc", "货号+色号": "skc", "商品编码": "sku", "商品编号": "sku", "渠道": "channel",
    "店铺": "shop", "日期": "date", "付款日期": "paid_at", "产品分类": "category", "商品分类": "category", "分类": "category",
    "新品类（企划版）": "plan_category", "成本价": "cost", "基本售价": "list_price", "销售数量": "sold_qty", "销售金额": "sold_amt",
    "实发数量": "shipped_qty", "实发金额": "shipped_amt", "退货数量": "return_qty", "退货金额": "return_amt",
    "实退数量": "returned_qty", "实退金额": "returned_amt", "达人编号": "streamer_id", "模块": "module",
    "实际库存数": "on_hand", "订单占有数": "reserved", "采购在途数": "on_order", "可用数": "available", "采购单号": "po_no",
    "采购日期": "po_date", "采购供应商": "supplier", "采购数量": "po_qty", "总入库量": "received_qty", "总入库数量": "received_qty",
    "备注": "remark", "状态": "status", "售后登记日期": "claim_at", "售后分类": "claim_type", "上新日": "launch_date",
    "是否上架": "is_listed",
}
