"""Logical tables as SQL over the synthetic tables.

The text runs in Spark and in DuckDB, so both sides start from the same rows.
It only renames, labels and injects cases (nulls, brackets, blanks, repeated
keys); the logic under test is written twice, in the library and in
`checks.oracle`.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skuloom.constants import STOCK_EXPORT_COLUMNS
from skuloom.operators.blocks import in_tasks, tasks_for

SOURCE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
)

AS_OF = dt.date(1999, 6, 15)
AGEING_AS_OF = dt.date(2001, 9, 1)
STREAMER = "17"
LIVE_STREAMER = "purchase"
ROUTED_SHOP = "NATION_3"
EXCLUDED_STYLE = "Brand#7"

_COLOR = """CASE WHEN p_size = 50 THEN NULL
    WHEN p_type = 'LARGE' THEN replace(p_name, ' ', '_x002B_') ELSE p_name END"""
_COLOR_SPEC = """CASE WHEN p_size <= 7 THEN p_name
    ELSE concat(p_name, ';', CAST(p_size AS STRING), ' (cm)') END"""
_STOCK_SPEC = """concat(CAST(p_size AS STRING), CASE WHEN p_type = 'PROMO' THEN ' 【cm】'
    WHEN p_type = 'LARGE' THEN '（cm）' WHEN p_type = 'MEDIUM' THEN ' (cm）' ELSE ' (cm)' END)"""
# A third as the catalogue writes it, a third upper-cased as the image table does, a third of its own.
_STYLE = """CASE p_size % 3 WHEN 0 THEN p_brand WHEN 1 THEN upper(p_brand)
    ELSE concat(p_brand, '-', CAST(p_size AS STRING)) END"""
_MEASURES = """p_retailprice AS cost,
    l_quantity AS sold_qty, l_extendedprice AS sold_amt,
    CASE WHEN l_linestatus = 'F' THEN l_quantity END AS shipped_qty,
    CASE WHEN l_linestatus = 'F' THEN l_extendedprice END AS shipped_amt,
    CASE WHEN l_returnflag = 'R' THEN l_quantity END AS return_qty,
    CASE WHEN l_returnflag = 'R' THEN l_extendedprice END AS return_amt,
    CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN l_quantity END AS returned_qty,
    CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN l_extendedprice END AS returned_amt,
    l_orderkey * 10 + l_linenumber AS _ord"""
_SALES = f"""SELECT r_name AS channel, s_name AS shop, {{date}} AS date,
    concat('　sku', CAST(l_partkey AS STRING), ' ') AS sku, p_brand AS style_code,
    {_COLOR_SPEC} AS color_spec, p_type AS category, {_MEASURES}
    FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey
    JOIN {{part}} ON l_partkey = p_partkey JOIN {{supplier}} ON l_suppkey = s_suppkey
    JOIN {{nation}} ON s_nationkey = n_nationkey JOIN {{region}} ON n_regionkey = r_regionkey"""
_PURCHASE = f"""SELECT {_COLOR_SPEC} AS color_spec, p_brand AS style_code,
    CASE WHEN l_linenumber = 7 THEN '汇总' ELSE '明细' END AS row_type,
    CASE WHEN l_tax >= 0.08 THEN '作废' WHEN l_linestatus = 'F' THEN '完成' ELSE '已确认' END AS status,
    CASE o_orderpriority WHEN '1-URGENT' THEN '小晶专供' WHEN '2-HIGH' THEN '唯品'
        WHEN '3-MEDIUM' THEN '小晶、唯品' WHEN '5-LOW' THEN '次品' END AS remark,
    CASE l_returnflag WHEN 'R' THEN '返修退货' WHEN 'N' THEN '普通' END AS tags,
    s_name AS supplier, o_orderdate AS po_date, l_quantity AS po_qty,
    CASE WHEN l_linestatus = 'F' THEN l_quantity END AS received_qty,
    l_orderkey * 10 + l_linenumber AS _ord
    FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey
    JOIN {{part}} ON l_partkey = p_partkey JOIN {{supplier}} ON l_suppkey = s_suppkey
    WHERE o_orderdate {{op}} TIMESTAMP '1998-01-01 00:00:00'"""
_HISTORY = f"""SELECT p_brand AS style_code, {_COLOR_SPEC} AS color_spec,
    CASE WHEN l_tax = 0 THEN 'n/a' WHEN l_tax = 0.01 THEN 'nan' WHEN l_tax = 0.02 THEN 'inf'
        WHEN l_tax = 0.03 THEN concat(CAST(l_linenumber AS STRING), 'd') ELSE CAST(l_quantity AS STRING) END AS sold_qty,
    CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS STRING) END AS return_qty
    FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey WHERE l_shipdate {{op}} TIMESTAMP '1998-01-01 00:00:00'"""

# the stock export: codes with an escaped plus, texts, and a number for every other column
_TEXTS = {
    "款式编码": "p_brand", "颜色": "replace(p_name, ' ', '_x002B_')", "规格": "concat(CAST(p_size AS STRING), ' (cm)')",
    "品牌": "p_brand", "商品编码": "concat('SKU_x002B_', CAST(p_partkey AS STRING))", "名称": "p_name",
    "图片地址链接": "concat('img/', CAST(p_partkey AS STRING))",
}
EXPORT = {
    c: _TEXTS.get(c, f"CAST((p_size * {i + 3} + p_partkey) % 97 AS STRING)") for i, c in enumerate(STOCK_EXPORT_COLUMNS)
}

# texts of dates in the forms that exports have
DATE_TEXTS_SQL = """SELECT o_orderdate, CASE o_orderkey % 5 WHEN 0 THEN 'iso' WHEN 1 THEN 'slash' WHEN 2 THEN 'compact'
    WHEN 3 THEN 'slash time' ELSE 'none' END AS form FROM orders"""
DATE_TEXTS = f"""SELECT form, CASE form WHEN 'iso' THEN day WHEN 'slash' THEN replace(day, '-', '/')
    WHEN 'compact' THEN replace(day, '-', '') WHEN 'slash time' THEN concat(replace(day, '-', '/'), ' 08:30')
    ELSE '待定' END AS text FROM (SELECT form, CAST(CAST(o_orderdate AS DATE) AS STRING) AS day
    FROM ({DATE_TEXTS_SQL.replace('FROM orders', 'FROM {orders}')}) t) z"""

# `{name}` stands for a synthetic table.
TABLES = {
    "catalog": f"""SELECT CASE WHEN p_size >= 10 THEN concat('img/', CAST(p_partkey AS STRING)) END AS image_url,
        p_brand AS style_code, concat(' SKU', CAST(p_partkey AS STRING)) AS sku, {_COLOR} AS color,
        concat(CAST(p_size AS STRING), ' (cm)') AS spec, p_retailprice AS list_price, p_retailprice AS cost,
        concat('1998-03-', CASE WHEN p_size < 10 THEN '0' ELSE '1' END, '1 08:30:00') AS created_at,
        CASE WHEN p_size = 49 THEN NULL WHEN p_type = 'SMALL' THEN '辅料' ELSE p_type END AS category,
        concat('199', CAST(p_size % 3 AS STRING)) AS year, CASE WHEN p_size < 30 THEN 'S' ELSE 'W' END AS season, concat(p_name, ' ', p_brand) AS title,
        concat('V', CAST(p_size AS STRING)) AS supplier,
        concat('N', p_name, CAST(p_size AS STRING)) AS national_code, p_partkey AS _ord
        FROM {{part}}""",
    "sales_paid": _SALES.replace("{date}", "o_orderdate"),
    "sales_shipped": _SALES.replace("{date}", "l_shipdate"),
    "order_lines": f"""SELECT CAST(l_orderkey AS STRING) AS order_no, s_name AS shop, o_orderdate AS paid_at,
        concat(CASE WHEN l_linestatus = 'O' AND l_returnflag = 'N' THEN 'gift' ELSE 'sku' END,
            CAST(l_partkey AS STRING), ' ') AS sku,
        CASE WHEN o_orderpriority <> '5-LOW' THEN concat(' ', CAST(o_custkey AS STRING), '.0') END AS streamer_id,
        {_STYLE} AS style_code, {_COLOR_SPEC} AS color_spec, p_type AS category,
        CASE WHEN p_size >= 10 THEN concat('【', p_name, '】', p_brand) ELSE concat(p_name, ' ', p_brand) END AS online_title,
        l_shipdate AS claim_at, CASE WHEN l_returnflag = 'R' THEN '仅退款' ELSE '退货' END AS claim_type,
        {_MEASURES}
        FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey
        JOIN {{part}} ON l_partkey = p_partkey JOIN {{supplier}} ON l_suppkey = s_suppkey""",
    "today_sales": """SELECT concat('sku', CAST(l_partkey AS STRING)) AS sku, 'old' AS skc,
        CASE WHEN l_linenumber < 6 THEN l_quantity END AS sold_qty FROM {lineitem}""",
    "stock": f"""SELECT p_brand AS style_code,
        concat(CASE WHEN p_size >= 25 THEN 'SKU' ELSE ' sku' END, CAST(p_partkey AS STRING)) AS sku,
        {_COLOR} AS color, {_STOCK_SPEC} AS spec, CAST(p_size - 1 AS DOUBLE) AS on_hand,
        CASE WHEN p_size > 3 THEN CAST(0 AS DOUBLE) END AS reserved, CAST(p_size % 4 AS DOUBLE) AS return_wh,
        CAST(p_size % 5 AS DOUBLE) AS inbound_wh, CASE WHEN p_size < 5 THEN CAST(p_size AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS on_order,
        CAST(p_size % 2 AS DOUBLE) AS return_transit, CAST(p_size % 7 AS DOUBLE) AS virtual, CAST(p_size AS DOUBLE) AS available, CAST(p_size AS DOUBLE) AS public_available
        FROM {{part}}""",
    "purchase_history": _PURCHASE.replace("{op}", "<"),
    "purchase_current": _PURCHASE.replace("{op}", ">="),
    "po_lines": f"""SELECT CAST(l_orderkey AS STRING) AS po_no, concat('SKU', CAST(l_partkey AS STRING)) AS sku,
        p_brand AS style_code, {_COLOR_SPEC} AS color_spec, p_type AS category,
        CASE WHEN l_tax >= 0.08 THEN '作废' WHEN l_linestatus = 'F' THEN '完成' ELSE '已确认' END AS status,
        CASE l_returnflag WHEN 'R' THEN '返修退货' WHEN 'N' THEN '普通' END AS tags,
        CASE WHEN l_linenumber = 6 THEN '返修' WHEN l_linenumber = 5 THEN '加急' END AS remark,
        o_orderdate AS po_date, CASE WHEN l_linestatus = 'F' THEN l_shipdate END AS completed_at,
        l_quantity AS po_qty, CASE WHEN l_linestatus = 'F' THEN l_quantity END AS received_qty,
        l_orderkey * 10 + l_linenumber AS _ord
        FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey JOIN {{part}} ON l_partkey = p_partkey""",
    "receipts": """SELECT CASE WHEN l_tax = 0 THEN concat('X', CAST(l_orderkey AS STRING)) WHEN l_tax = 0.01 THEN 'nan'
            WHEN l_tax = 0.02 THEN CAST(90000000000000567 + l_orderkey AS STRING)
            ELSE concat(CAST(l_orderkey AS STRING), '.0') END AS po_no,
        concat('SKU', CAST(l_partkey AS STRING)) AS sku,
        CASE WHEN l_returnflag = 'A' THEN '调整单' END AS tags,
        l_shipdate AS received_at, o_orderdate AS po_date, l_quantity AS qty
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    "sales_history": _HISTORY.replace("{op}", "<"),
    "sales_current": _HISTORY.replace("{op}", ">="),
    "sessions": """SELECT concat('s', CAST(event_id AS STRING)) AS label, ts AS start,
        CASE event_id % 5 WHEN 0 THEN ts + INTERVAL '40' MINUTE WHEN 1 THEN ts + INTERVAL '5' HOUR WHEN 2 THEN ts + INTERVAL '26' HOUR
            WHEN 3 THEN ts + INTERVAL '9' DAY WHEN 4 THEN ts - INTERVAL '1' HOUR END AS end,
        (event_id * 7919) % 1000003 AS _ord FROM {events} WHERE event_id % 89 = 0""",
    "stock_daily": """SELECT o_orderdate AS date, CAST(l_partkey AS STRING) AS sku,
        concat(p_brand, p_name) AS skc, CAST(p_size AS DOUBLE) AS opening_qty
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {part} ON l_partkey = p_partkey""",
    "live_sales": """SELECT ts AS paid_at, concat(event_type, ' ') AS streamer_id,
        CAST(user_id AS STRING) AS style_code, value AS sold_qty FROM {events}""",
    "merch_board": """SELECT p_brand AS style_code, concat(p_brand, p_name) AS skc, p_name AS color,
        CASE p_type WHEN 'PROMO' THEN '服装' WHEN 'LARGE' THEN '配饰' WHEN 'SMALL' THEN '鞋子' ELSE p_type END AS class,
        CASE p_type WHEN 'MEDIUM' THEN '美妆' ELSE p_type END AS category,
        CASE p_type WHEN 'MEDIUM' THEN '美妆' ELSE concat('P-', p_type) END AS plan_category,
        CASE WHEN max(p_size) < 45 THEN concat('img/', p_name) END AS image,
        CASE WHEN max(p_size) < 48 THEN max(CASE WHEN o_orderpriority = '2-HIGH' THEN o_orderdate END) END AS launch_date,
        min(o_orderdate) AS created_at,
        max(CASE WHEN o_orderpriority = '1-URGENT' AND l_returnflag = 'R' THEN o_orderdate END) AS last_order_date,
        CAST(min(p_size) - 1 AS DOUBLE) AS available, CAST(max(p_size) AS DOUBLE) AS total_stock,
        CAST(max(l_quantity) - 40 AS DOUBLE) AS reserved, max(p_retailprice) AS cost,
        CAST(count(DISTINCT l_orderkey) AS DOUBLE) AS avg3d_sales, min(p_partkey) AS _ord
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {part} ON l_partkey = p_partkey
        GROUP BY p_brand, p_name, p_type""",
    "listings": """SELECT n_name AS shop,
        CASE r_name WHEN 'AFRICA' THEN 'Tmall' WHEN 'AMERICA' THEN 'Jos' WHEN 'ASIA' THEN 'WXChannel'
            WHEN 'EUROPE' THEN 'Vipapis' ELSE 'Elsewhere' END AS site,
        concat('N', p_name, CAST(p_size AS STRING)) AS online_style,
        p_brand AS system_style, concat(CASE WHEN p_size = 30 THEN 'SKU' ELSE ' SKU' END,
            CAST(p_partkey AS STRING)) AS system_sku,
        max(CASE WHEN l_linestatus = 'O' AND l_returnflag <> 'A' AND l_quantity >= 50 THEN 1 ELSE 0 END) AS is_listed
        FROM {lineitem} JOIN {part} ON l_partkey = p_partkey JOIN {supplier} ON l_suppkey = s_suppkey
        JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
        GROUP BY n_name, r_name, p_partkey, p_brand, p_name, p_size""",
    "stock_export": "SELECT " + ", ".join(f"{v} AS `{k}`" for k, v in EXPORT.items()) + ", 'x' AS `多余` FROM {part}",
    "category": """SELECT p_type AS category, concat('P-', p_type) AS plan_category, min(p_partkey) AS _ord
        FROM {part} WHERE p_type <> 'PROMO' GROUP BY p_type
        UNION ALL SELECT p_type, 'P-more', max(p_partkey) + 1000000000 FROM {part}
        WHERE p_type = 'SMALL' GROUP BY p_type""",
    "channel": """SELECT s_name AS shop, concat('CH-', CAST(s_nationkey AS STRING)) AS channel FROM {supplier}""",
    "size_rule": """SELECT DISTINCT concat(CAST(p_size AS STRING), ' (cm)') AS spec,
        CASE WHEN p_size < 20 THEN 'S' ELSE 'L' END AS spec_final FROM {part}
        UNION ALL SELECT DISTINCT CAST(p_size AS STRING), CASE WHEN p_size < 20 THEN 'S' ELSE 'L' END FROM {part}""",
    "module": """SELECT c_mktsegment AS module, concat(CAST(c_custkey AS STRING), '.0') AS uid FROM {customer}""",
}


# numbers of very different size: by order, from 10^-300 to 10^300, of both signs
SIZES = (1e-300, 1e-21, 1e-5, 1.0, 1e26, 1e300)


def EXTREME(column) -> Column:
    """A line's quantity at the size that its order has; lines that were sent back count against the others."""
    size = F.element_at(F.array(*[F.lit(s) for s in SIZES]), (column("l_orderkey") % len(SIZES) + 1).cast("int"))
    sign = F.when(column("l_returnflag") == "R", -1.0).otherwise(1.0)
    return column("l_quantity") * size * sign


EXTREME_SQL = f"""l_quantity * ({[*SIZES]})[l_orderkey % {len(SIZES)} + 1]::DOUBLE
    * CASE WHEN l_returnflag = 'R' THEN -1.0 ELSE 1.0 END::DOUBLE"""


# what the board takes from the lines, per order and SKC first: all but the orders counted are a least or a greatest
BOARD = {
    "min_size": (F.min, "p_size"), "max_size": (F.max, "p_size"), "max_price": (F.max, "p_retailprice"), "first_part": (F.min, "p_partkey"),
    "max_qty": (F.max, "l_quantity"), "first_date": (F.min, "o_orderdate"),
    "high_date": (F.max, "CASE WHEN o_orderpriority = '2-HIGH' THEN o_orderdate END"),
    "urgent_date": (F.max, "CASE WHEN o_orderpriority = '1-URGENT' AND l_returnflag = 'R' THEN o_orderdate END"),
}
MERCH_BOARD = """SELECT p_brand AS style_code, concat(p_brand, p_name) AS skc, p_name AS color,
    CASE p_type WHEN 'PROMO' THEN '服装' WHEN 'LARGE' THEN '配饰' WHEN 'SMALL' THEN '鞋子' ELSE p_type END AS class,
    CASE p_type WHEN 'MEDIUM' THEN '美妆' ELSE p_type END AS category,
    CASE p_type WHEN 'MEDIUM' THEN '美妆' ELSE concat('P-', p_type) END AS plan_category,
    CASE WHEN max_size < 45 THEN concat('img/', p_name) END AS image,
    CASE WHEN max_size < 48 THEN high_date END AS launch_date, first_date AS created_at, urgent_date AS last_order_date,
    CAST(min_size - 1 AS DOUBLE) AS available, CAST(max_size AS DOUBLE) AS total_stock,
    CAST(max_qty - 40 AS DOUBLE) AS reserved, max_price AS cost, CAST(orders AS DOUBLE) AS avg3d_sales, first_part AS _ord FROM {sums}"""


def merch_board(lineitem: DataFrame, orders: DataFrame, part: DataFrame) -> DataFrame:
    """The rows of TABLES["merch_board"], with orders counted in tasks of bounded size.

    Lines and orders are dealt by order, so that the lines of an order and SKC are one group of one task; a group counts once
    for its SKC.
    """
    tasks = tasks_for(lineitem.count())
    lines = lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_returnflag").join(part, F.expr("l_partkey = p_partkey"))
    own = orders.select("o_orderkey", "o_orderdate", "o_orderpriority")
    lines = in_tasks(lines, tasks, "l_orderkey").join(in_tasks(own, tasks, "o_orderkey"), F.expr("l_orderkey = o_orderkey"))
    skc = ["p_brand", "p_name", "p_type"]
    pairs = lines.groupBy("l_orderkey", *skc).agg(*[fn(F.expr(src)).alias(c) for c, (fn, src) in BOARD.items()])
    sums = pairs.groupBy(*skc).agg(*[fn(c).alias(c) for c, (fn, _) in BOARD.items()], F.count(F.lit(1)).alias("orders"))
    return part.sparkSession.sql(MERCH_BOARD, sums=sums)


#: Tables that Spark builds by another way than the text, for the same rows.
BUILT = {"merch_board": merch_board}


class Inputs(dict):
    """Logical tables, built when they are asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.spark, self.sf_dir = spark, sf_dir
        self._raw: dict[str, DataFrame] = {}

    def raw(self, table: str) -> DataFrame:
        """One of the synthetic tables."""
        if table not in self._raw:
            self._raw[table] = self.spark.read.parquet(f"{self.sf_dir}/{table}.parquet")
        return self._raw[table]

    def __missing__(self, name: str) -> DataFrame:
        text = TABLES[name]
        used = {t: self.raw(t) for t in SOURCE_TABLES if "{" + t + "}" in text}
        self[name] = BUILT[name](**used) if name in BUILT else self.spark.sql(text, **used)
        return self[name]


def duck(name: str) -> str:
    """The same table as a DuckDB subquery."""
    text = TABLES[name].replace("`", '"').replace("AS STRING", "AS VARCHAR")
    for t in SOURCE_TABLES:
        text = text.replace("{" + t + "}", t)
    return text
