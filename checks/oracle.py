"""DuckDB SQL for the registered queries."""

from __future__ import annotations

import re

from checks import fixtures as X
from checks.queries import DAY_HOURS, LABELS, MONTH_HOURS, MONTH_SESSIONS, MONTHS, RATE_DATES, REFUND_DELAYS, SHOPS

ORACLE: dict[str, str] = {}


# Dates are compared as text: the two engines hand them over in different types.
DATES = {
    "p14_coalesce_chain": "last_order",
    "a4_min_date": "first_day",
    "a11_first_hot_day": "first_day",
    "w2_running_delay": "paid_date",
    "q08_sales_detail": "paid_date",
    "q09_shipped_daily": "date",
    "q09_shipped_detail": "date",
    "q10_paid_detail": "date",
    "q10_first_hot_day": "first_hot_day",
    "q12_top20": "launch_time launch_date",
    "q12_top30": "launch_time launch_date",
    "q14_live_lines": "date",
    "q14_live_lines_spans": "date",
    "q15_refund_curve": "paid_date",
    "q15_refund_curve_wide": "paid_date",
    "q15_refund_curve_columns": "paid_date",
    "q17_ageing_detail": "as_of last_order_date",
    "q18_priority_skc": "launch_date",
}


def add(name: str, text: str) -> None:
    """Prefix a query with the logical tables it names."""
    if name in DATES:
        texts = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in DATES[name].split())
        text = f"SELECT * REPLACE ({texts}) FROM ({_query(text)}) dated"
        ORACLE[name] = text
    else:
        ORACLE[name] = _query(text)


def _query(text: str) -> str:
    used = [t for t in X.TABLES if re.search(rf"\b(FROM|JOIN) {t}\b", text)]
    ctes = [f"{t} AS ({X.duck(t)})" for t in used]
    body = text.strip()
    if body.startswith("WITH "):
        return f"WITH {', '.join([*ctes, ''])}{body[5:]}"
    return f"WITH {', '.join(ctes)} {body}" if ctes else body


def s(x: str) -> str:
    """Sum of doubles, exact to 2^-66 and rounded at the end: whole-number words are added apart."""
    w = "4194304.0::DOUBLE"
    finite = f"(CASE WHEN isfinite(({x})::DOUBLE) THEN ({x})::DOUBLE END)"
    sign, v = f"(CASE WHEN ({x}) < 0 THEN -1 ELSE 1 END)", f"abs({finite})"
    high = f"floor(floor({v}) / {w})"
    f0 = f"({v} - floor({v}))"
    f1 = f"(({f0} * {w}) % 1.0::DOUBLE)"
    f2 = f"(({f1} * {w}) % 1.0::DOUBLE)"
    words = [high, f"floor({v}) - {high} * {w}", f"floor({f0} * {w})", f"floor({f1} * {w})", f"floor({f2} * {w})"]
    h, a, b, c, d = (f"CAST(coalesce(sum({sign} * CAST({word} AS BIGINT)), 0) AS DOUBLE)" for word in words)
    return f"({h} * {w} + ({a} + ({b} + ({c} + {d} / {w}) / {w}) / {w}))"


def r(x: str, digits: int) -> str:
    scale = f"{10**digits}.0"
    return f"round_even(({x}) * {scale}, 0) / {scale}" if digits else f"round_even({x}, 0)"


def code(x: str) -> str:
    return f"upper(trim({x}, ' 　'))"


def days(a: str, b: str) -> str:
    return f"((epoch_us({b}) - epoch_us({a})) / 1e6 / CAST(86400 AS DOUBLE))"


def same(a: str, b: str) -> str:
    return f"{a} IS NOT DISTINCT FROM {b}"


def color(x: str = "color_spec") -> str:
    return f"split_part({x}, ';', 1)"


def spec(x: str = "color_spec") -> str:
    return f"CASE WHEN contains({x}, ';') THEN substr({x}, instr({x}, ';') + 1) END"


def session(x: str, sessions) -> str:
    spans = " ".join(
        f"WHEN {x} >= TIMESTAMP '{a.start}' AND {x} <= TIMESTAMP '{a.end}' THEN '{a.label}'"
        for a in reversed(sessions)
    )
    return f"CASE {spans} END"


HOUR = "strftime(paid_at, '%m.%d %H:00') || '-' || strftime(paid_at + INTERVAL 1 HOUR, '%H:00')"
CHANNEL = """CASE site WHEN 'Tmall' THEN '天猫' WHEN 'Jos' THEN '京东' WHEN 'WXChannel' THEN '微信'
    WHEN 'Vipapis' THEN '唯品' ELSE '未知' END"""
TAG = """CASE WHEN coalesce(contains(remark, '小晶'), false) THEN '小晶' ELSE '' END ||
    CASE WHEN coalesce(contains(remark, '唯品'), false) THEN '唯专' ELSE '' END"""
YESTERDAY = f"paid_at >= TIMESTAMP '{X.AS_OF}' - INTERVAL 1 DAY AND paid_at < TIMESTAMP '{X.AS_OF}'"
WEEK = f"paid_at >= TIMESTAMP '{X.AS_OF}' - INTERVAL 7 DAY AND paid_at < TIMESTAMP '{X.AS_OF}'"
AGE_DAYS = f"date_diff('day', {{x}}, DATE '{X.AGEING_AS_OF}')"
AGE = """CASE WHEN {x} / 30.44 <= -1 THEN NULL WHEN {x} / 30.44 <= 6 THEN '0-6个月'
    WHEN {x} / 30.44 <= 12 THEN '7-12个月' WHEN {x} / 30.44 <= 18 THEN '13-18个月'
    WHEN {x} / 30.44 <= 24 THEN '19-24个月' WHEN {x} IS NOT NULL THEN '24个月以上' END"""
BINS = "(VALUES ('0-6个月'), ('7-12个月'), ('13-18个月'), ('19-24个月'), ('24个月以上')) b(age)"

BOTH = "(SELECT * FROM purchase_history UNION ALL SELECT * FROM purchase_current) u"

# --- operators

add("s1_first_of_export", "SELECT p_brand, min(p_partkey) AS p_partkey, CAST(NULL AS DOUBLE) AS missing FROM part GROUP BY 1")
add("s2_read_bundle", "SELECT n_nationkey, n_name FROM nation")
add("s5_discover", "SELECT l_orderkey, l_linenumber FROM lineitem")
add(
    "s1_first_of_landed_csv",
    """SELECT l_partkey, l_orderkey, l_linenumber, l_quantity FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_quantity) = 1""",
)
add(
    "s4_missing_tokens",
    """SELECT CAST(p_partkey AS VARCHAR) AS p_partkey,
    CASE p_type WHEN 'PROMO' THEN 'NA' WHEN 'LARGE' THEN NULL WHEN 'SMALL' THEN 'nan' ELSE p_type END AS p_type FROM part""",
)
add("s6_promoted_header", "SELECT CAST(p_partkey AS VARCHAR) AS part, p_brand AS brand FROM part")
add("s6_positional", "SELECT s_name AS shop, s_suppkey AS shop_id FROM supplier")

add("s3_pruned_read", "SELECT l_partkey, l_quantity FROM lineitem")
add("p1_conform", "SELECT p_name, CAST(NULL AS VARCHAR) AS missing, p_partkey, p_size FROM part")
add("p2_p3_rename_drop", "SELECT s_suppkey AS shop_id, s_name AS shop FROM supplier")
add(
    "p6_not_equal_null",
    "SELECT tags, count(*) AS n FROM " + BOTH + " WHERE tags IS DISTINCT FROM '返修退货' GROUP BY tags",
)
add(
    "p8_in_list",
    f"SELECT status, {s('po_qty')} AS qty FROM {BOTH} WHERE status IN ('完成', '已确认') GROUP BY status",
)
add(
    "p10_any_nonzero",
    "SELECT l_linestatus, count(*) AS n FROM lineitem WHERE l_discount <> 0 OR l_tax <> 0 GROUP BY 1",
)
add(
    "p11_threshold",
    "SELECT skc, category, total_stock, available FROM merch_board WHERE total_stock >= 10 AND available >= 1",
)
add("p12_trailing_window", f"SELECT order_no, paid_at, sold_qty FROM order_lines WHERE {WEEK}")
add(
    "p13_fill",
    """SELECT coalesce(shipped_qty, 0) AS shipped_qty, coalesce(return_qty, 0) AS return_qty, count(*) AS n
    FROM sales_paid GROUP BY 1, 2""",
)
add(
    "p14_coalesce_chain",
    """SELECT skc, category, CAST(coalesce(last_order_date, launch_date, created_at) AS DATE) AS last_order
    FROM merch_board""",
)
add(
    "p15_conditional",
    """SELECT CASE WHEN category = '美妆' THEN '美妆' ELSE class END AS class, count(*) AS n
    FROM merch_board GROUP BY 1""",
)
add("p16_tags", f"SELECT {TAG} AS tag, count(*) AS n FROM {BOTH} GROUP BY 1")
add("p17_map_default", f"SELECT site, {CHANNEL} AS channel, count(*) AS n FROM listings GROUP BY 1, 2")
add("p18_null_tokens", "SELECT nullif(l_returnflag, 'N') AS flag, count(*) AS n FROM lineitem GROUP BY 1")

add(
    "j1_lookup_fanout",
    f"""SELECT a.category, plan_category, {s('sold_qty')} AS sold_qty FROM sales_paid a
    LEFT JOIN category c ON {same('a.category', 'c.category')} GROUP BY 1, 2""",
)
SKU_SKC = f"sku_skc AS (SELECT {code('sku')} AS sku, style_code || color AS skc FROM catalog)"
add(
    "j1_lookup_split",
    f"""WITH {SKU_SKC} SELECT {code('a.sku')} AS sku, category, sold_qty, _ord, skc FROM sales_paid a
    LEFT JOIN sku_skc c ON {same(code('a.sku'), 'c.sku')}""",
)
add(
    "j2_composite",
    f"""WITH d AS (SELECT date AS paid_at, style_code || {color()} AS skc, {s('sold_qty')} AS sold_qty
        FROM sales_paid GROUP BY 1, 2),
    k AS (SELECT date, skc, {s('opening_qty')} AS opening_stock FROM stock_daily GROUP BY 1, 2)
    SELECT paid_at, d.skc, sold_qty, opening_stock FROM d
    LEFT JOIN k ON d.paid_at = k.date AND d.skc = k.skc""",
)
FIRST_PLAN = """plan AS (SELECT category, arg_min(plan_category, _ord) AS plan_category FROM category GROUP BY 1)"""
add(
    "j4_lookup_first",
    f"""WITH {FIRST_PLAN} SELECT po_no, a.category, po_qty, _ord, plan_category FROM po_lines a
    LEFT JOIN plan p ON {same('a.category', 'p.category')}""",
)
add(
    "j5_self_status",
    """WITH a AS (SELECT po_no, status, po_qty FROM po_lines WHERE status IN ('完成', '已确认')),
    d AS (SELECT DISTINCT po_no, status FROM a)
    SELECT a.po_no, a.status, po_qty, d.status AS po_status FROM a LEFT JOIN d ON a.po_no = d.po_no""",
)
add(
    "j6_join_back",
    f"""WITH t AS (SELECT po_no, {s('po_qty')} AS all_qty FROM po_lines GROUP BY 1)
    SELECT a.po_no, _ord, po_qty, all_qty FROM po_lines a LEFT JOIN t ON a.po_no = t.po_no""",
)
add(
    "j7_semi",
    """SELECT style_code || color AS skc, sku FROM catalog
    WHERE style_code || color IN (SELECT skc FROM merch_board WHERE image IS NULL)""",
)
add(
    "j8_range_last_wins",
    f"SELECT paid_at, style_code, sold_qty, {session('paid_at', MONTH_SESSIONS)} AS session FROM live_sales",
)
ROUTED = f"""routed AS (SELECT l.shop, site, online_style, c.style_code AS system_style, c.sku AS system_sku, is_listed
        FROM listings l LEFT JOIN catalog c ON {same('l.online_style', 'c.national_code')}
        WHERE l.shop = '{X.ROUTED_SHOP}'
        UNION ALL SELECT shop, site, online_style, system_style, system_sku, is_listed
        FROM listings WHERE shop IS DISTINCT FROM '{X.ROUTED_SHOP}'),
    enriched AS (SELECT r.*, c.color, {CHANNEL} AS channel, system_style || coalesce(c.color, '') AS skc
        FROM routed r LEFT JOIN catalog c ON {same('r.system_sku', 'c.sku')})"""
LAST_SPAN = """arg_max({x}, (s._ord, s.start)) FILTER (l.paid_at BETWEEN s.start AND s."end")"""
add(
    "j8_spans_table",
    f"""WITH l AS (SELECT row_number() OVER () AS rid, * FROM live_sales)
    SELECT l.paid_at, l.style_code, l.sold_qty, {LAST_SPAN.format(x="s.label")} AS session, {LAST_SPAN.format(x="s.start")} AS since
    FROM l LEFT JOIN sessions s ON l.paid_at BETWEEN s.start AND s."end" GROUP BY l.rid, 1, 2, 3""",
)
add(
    "j8_spans_by_key",
    f"""WITH l AS (SELECT row_number() OVER () AS rid, * FROM live_sales)
    SELECT l.paid_at, CAST(length(l.style_code) AS INTEGER) AS k, l.sold_qty, {LAST_SPAN.format(x="s.label")} AS session
    FROM l LEFT JOIN sessions s ON l.paid_at BETWEEN s.start AND s."end" AND length(l.style_code) = length(s.label) - 1
    GROUP BY l.rid, 1, 2, 3""",
)
add(
    "q14_live_lines_spans",
    f"""WITH l AS (SELECT row_number() OVER () AS rid, * FROM live_sales WHERE trim(streamer_id, ' 　') = '{X.LIVE_STREAMER}')
    SELECT l.paid_at, CAST(l.paid_at AS DATE) AS date, trim(l.streamer_id, ' 　') AS streamer_id, l.style_code, l.sold_qty,
        {HOUR.replace('paid_at', 'l.paid_at')} AS hour, {LAST_SPAN.format(x="s.label")} AS session
    FROM l LEFT JOIN sessions s ON l.paid_at BETWEEN s.start AND s."end" GROUP BY l.rid, 1, 2, 3, 4, 5, 6""",
)
add(
    "w1_prefix_sums",
    f"""SELECT l_returnflag, l_shipdate, l_orderkey, l_linenumber, l_quantity, l_extendedprice, sum(l_quantity) OVER w AS cum_qty,
    {s('l_extendedprice').replace('AS BIGINT)), 0)', 'AS BIGINT)) OVER w, 0)')} AS cum_amt FROM lineitem
    WINDOW w AS (PARTITION BY l_returnflag ORDER BY l_shipdate, l_orderkey, l_linenumber, l_extendedprice, l_quantity ROWS UNBOUNDED PRECEDING)""",
)
add(
    "w3_row_positions",
    """SELECT l_orderkey, l_linenumber, l_extendedprice,
    row_number() OVER (ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS position FROM lineitem""",
)
add("j9_routed_union", f"WITH {ROUTED} SELECT shop, system_sku, color FROM enriched")

add(
    "a1_group_sum",
    f"""SELECT date, plan_category, {s('sold_qty')} AS sold_qty, {s('shipped_qty')} AS shipped_qty,
    {s('return_qty')} AS return_qty, {s('sold_amt')} AS sold_amt FROM sales_paid a
    LEFT JOIN category c ON {same('a.category', 'c.category')} WHERE plan_category IS NOT NULL GROUP BY 1, 2""",
)


def whole_range(keys: str, x: str, name: str, table: str) -> str:
    """Sums of doubles of any size: exact inside bands of 68 bits, which are then joined, the largest first."""
    scale = "pow(2::DOUBLE, 34 * {b})"
    up, down = scale.format(b="b"), scale.format(b="-b")
    return f"""SELECT {keys}, list_reduce([0::DOUBLE] || list(v ORDER BY b DESC), lambda p, q: p + q) AS {name} FROM (
        SELECT {keys}, b, {s('y')} * {up} * {up} AS v FROM (
            SELECT *, x * {down} * {down} AS y FROM (
                SELECT {keys}, {x} AS x, CASE WHEN abs({x}) >= pow(2::DOUBLE, -13) AND abs({x}) < pow(2::DOUBLE, 55) OR ({x}) = 0 THEN 0
                    ELSE CAST(floor((log2(abs({x})) + 13) / 68) AS INTEGER) END AS b FROM {table}) banded) scaled
        GROUP BY {keys}, b) added GROUP BY {keys}"""


add("a1_fine_sums", whole_range("l_suppkey", "l_quantity * l_tax / 7000", "fine", "lineitem"))
add(
    "a1_extreme_sums",
    f"""WITH e AS ({whole_range('l_suppkey', X.EXTREME_SQL, 'extreme', 'lineitem')}),
    q AS (SELECT l_suppkey, {s('l_quantity')} AS qty FROM lineitem GROUP BY 1)
    SELECT l_suppkey, extreme, qty FROM e JOIN q USING (l_suppkey)""",
)
add(
    "w1_running_extreme",
    f"""WITH d AS ({whole_range('l_suppkey, l_shipdate', 'l_quantity * 1e25::DOUBLE', 'large', 'lineitem')}),
    t AS (SELECT *, large * pow(2::DOUBLE, -34) * pow(2::DOUBLE, -34) AS y FROM d),
    k AS (SELECT a.l_suppkey, a.l_shipdate, {s('b.y')} AS y FROM t a JOIN t b ON a.l_suppkey = b.l_suppkey
        AND b.l_shipdate <= a.l_shipdate GROUP BY 1, 2)
    SELECT l_suppkey, l_shipdate, large, k.y * pow(2::DOUBLE, 34) * pow(2::DOUBLE, 34) AS cum_large FROM d JOIN k USING (l_suppkey, l_shipdate)""",
)
LARGE = "CASE WHEN l_returnflag = 'R' THEN -l_extendedprice * 1e10::DOUBLE ELSE l_extendedprice * 1e10::DOUBLE END"
add(
    "a1_large_sums",
    f"""SELECT l_linenumber, {s('large')} AS large, {s('large + l_tax')} AS mixed
    FROM (SELECT *, {LARGE} AS large FROM lineitem) z GROUP BY 1""",
)
add(
    "a2_count_and_sum",
    f"SELECT class, count(last_order_date) AS n, {s('total_stock')} AS stock FROM merch_board GROUP BY 1",
)
add("a4_min_date", "SELECT style_code, CAST(min(date) AS DATE) AS first_day FROM sales_paid GROUP BY 1")
add("a5_max_flag", "SELECT shop, online_style, max(is_listed) AS is_listed FROM listings GROUP BY 1, 2")
FIRST_DONE = """(SELECT po_no, arg_min(completed_at, (_ord, completed_at)) AS completed_at
    FROM {t} WHERE completed_at IS NOT NULL GROUP BY 1)"""
add("a6_first_nonnull", f"SELECT * FROM {FIRST_DONE.format(t='po_lines')} z")
add(
    "a8_subtotals",
    f"""SELECT category, style_code, {s('sold_qty')} AS sold_qty FROM sales_paid GROUP BY 1, 2
    UNION ALL SELECT category, '总计', {s('sold_qty')} FROM sales_paid GROUP BY 1""",
)
DETAIL = f"""base AS (SELECT *, coalesce(launch_date, created_at) AS launch FROM merch_board
        WHERE category IS NOT NULL AND available >= 1),
    dated AS (SELECT *, CAST(coalesce(last_order_date, launch) AS DATE) AS last_order FROM base),
    aged AS (SELECT *, {AGE_DAYS.format(x='last_order')} AS age_days FROM dated),
    detail AS (SELECT style_code, skc, color, CASE WHEN category = '美妆' THEN '美妆' ELSE class END AS class,
        category, plan_category, image, launch AS launch_date, created_at, last_order AS last_order_date,
        available, total_stock, reserved, cost, avg3d_sales, DATE '{X.AGEING_AS_OF}' AS as_of,
        CAST(age_days AS INTEGER) AS age_days, {AGE.format(x='age_days')} AS age,
        total_stock * cost AS stock_cost FROM aged)"""
GRID = f"""grid AS (SELECT c.class, b.age, count(d.skc) AS skc_count, {s('d.total_stock')} AS total_stock,
        {s('d.stock_cost')} AS stock_cost
        FROM (SELECT DISTINCT class FROM detail WHERE class IS NOT NULL) c CROSS JOIN {BINS}
        LEFT JOIN detail d ON d.class = c.class AND d.age = b.age GROUP BY 1, 2)"""
add("a9_dense_grid", f"WITH {DETAIL}, {GRID} SELECT * FROM grid")
NUMBER = "CAST(coalesce(TRY_CAST(po_no AS BIGINT), 0) AS VARCHAR)"
RECEIPTS = f"""timed AS (SELECT {NUMBER} || sku AS po_sku, {r(days('po_date', 'received_at'), 2)} AS d, qty
        FROM receipts WHERE tags IS DISTINCT FROM '调整单'),
    weighted AS (SELECT po_sku, {s(r('qty * d', 2))} AS w, {s('qty')} AS receipt_qty FROM timed GROUP BY 1),
    rec AS (SELECT po_sku, receipt_qty, {r(r('w', 2) + ' / nullif(receipt_qty, 0)', 2)} AS avg_receipt_days
        FROM weighted)"""
add("a10_weighted_mean", f"WITH {RECEIPTS} SELECT * FROM rec")
add(
    "a11_first_hot_day",
    f"""WITH d AS (SELECT style_code || {color()} AS skc, CAST(date AS DATE) AS date, {s('sold_qty')} AS q
        FROM sales_paid GROUP BY 1, 2)
    SELECT skc, min(date) AS first_day FROM d WHERE q > 10 GROUP BY 1""",
)
add(
    "a12_ratios",
    f"""WITH t AS (SELECT style_code, date, {s('sold_amt')} AS a, {s('return_amt')} AS b, {s('sold_qty')} AS q,
        {s('shipped_qty')} AS f, {s('returned_qty')} AS g FROM sales_paid GROUP BY 1, 2)
    SELECT style_code, date, {r('1.0::DOUBLE - b / nullif(a, 0)', 4)} AS kept,
    {r('g / nullif(f, 0)', 2)} AS returned, {r('a / nullif(q, 0)', 0)} AS unit_price FROM t""",
)
add("a13_distinct", f"SELECT DISTINCT style_code, status FROM {BOTH}")



def hour_cells(hours: list[str]) -> str:
    return ", ".join(
        f"""{s(f"CASE WHEN hour = '{h}' THEN sold_qty END")} AS "{h}\""""
        for h in hours
    )


add(
    "r1_hour_pivot",
    f"""WITH h AS (SELECT *, substr({HOUR}, 7) AS hour FROM live_sales)
    SELECT style_code, {s('sold_qty')} AS total, {hour_cells(DAY_HOURS)} FROM h GROUP BY 1""",
)
_shop_cells = ", ".join(
    f"""CASE WHEN max(CASE WHEN channel = '{c}' AND shop = '{shop}' THEN is_listed END) = 1
    THEN '是' ELSE '' END AS "{c}_{shop}\""""
    for c, shop in SHOPS
)
add(
    "r2_flag_pivot",
    f"""WITH l AS (SELECT *, {CHANNEL} AS channel FROM listings)
    SELECT system_style, {_shop_cells} FROM l GROUP BY 1""",
)
REFUND_LINES = f"""lines AS (SELECT CAST(paid_at AS DATE) AS paid_date, style_code || {color()} AS skc, category,
        CAST(ceil({days('paid_at', 'claim_at')}) AS INTEGER) AS delay, claim_type,
        sold_qty, shipped_qty, return_qty, returned_qty FROM order_lines{{where}})"""


def fixed(x: str, digits: int) -> str:
    return f"coalesce(CAST(CAST({x} AS DECIMAL(28,{digits})) AS VARCHAR), '')"


def cells(key: str, values: list[str], digits: int) -> str:
    """A map as text."""
    shown = " || '/' || ".join(fixed(v, digits) for v in values)
    return f"string_agg(CAST({key} AS VARCHAR) || '=' || {shown}, ';' ORDER BY {key})"


add(
    "r3_delay_spread",
    f"""WITH {REFUND_LINES.format(where='')},
    t AS (SELECT skc, delay, {s('return_qty')} AS return_qty, {s('sold_qty')} AS sold_qty FROM lines
        WHERE skc IS NOT NULL AND delay IS NOT NULL GROUP BY 1, 2)
    SELECT skc, {cells('delay', ['return_qty', 'sold_qty'], 2)} AS cells FROM t GROUP BY 1""",
)
_month_cells = ", ".join(f"""max(CASE WHEN month = '{m}' THEN v END) AS "{m}\"""" for m in MONTHS)
add(
    "r4_metric_rows",
    f"""WITH t AS (SELECT style_code, category, strftime(date, '%m') AS month, {s('sold_qty')} AS sold_qty,
        {s('return_qty')} AS return_qty FROM sales_paid GROUP BY 1, 2, 3),
    m AS (SELECT style_code, category, month, 'sold_qty' AS metric, sold_qty AS v FROM t UNION ALL
        SELECT style_code, category, month, 'rate', {r('return_qty / nullif(sold_qty, 0)', 2)} FROM t)
    SELECT style_code, category, metric, {_month_cells} FROM m WHERE v IS NOT NULL GROUP BY 1, 2, 3""",
)

add(
    "w1_running_sum",
    f"""WITH t AS (SELECT style_code || {color()} AS skc, date, category, {s('sold_qty')} AS sold_qty,
        {s('return_qty')} AS return_qty FROM sales_paid GROUP BY 1, 2, 3)
    SELECT *, sum(sold_qty) OVER w AS cum_sold, sum(return_qty) OVER w AS cum_return FROM t
    WINDOW w AS (PARTITION BY skc ORDER BY date, category ROWS UNBOUNDED PRECEDING)""",
)
add(
    "w2_running_delay",
    f"""WITH {REFUND_LINES.format(where=" WHERE claim_type = '仅退款'")},
    t AS (SELECT paid_date, skc, delay, {s('return_qty')} AS return_qty FROM lines GROUP BY 1, 2, 3)
    SELECT *, sum(return_qty) OVER (PARTITION BY paid_date, skc ORDER BY delay ROWS UNBOUNDED PRECEDING)
    AS cum_refund FROM t""",
)
add(
    "w4_keep_one",
    """SELECT style_code, color, sku, category FROM catalog
    QUALIFY row_number() OVER (PARTITION BY style_code, color ORDER BY _ord) = 1""",
)
add(
    "w4_keep_last",
    f"""SELECT style_code, po_date, supplier FROM (SELECT DISTINCT style_code, po_date, supplier FROM {BOTH}) z
    QUALIFY row_number() OVER (PARTITION BY style_code ORDER BY po_date, supplier DESC) = 1""",
)
add(
    "w5_group_fill",
    f"""SELECT a.po_no, _ord, coalesce(f.completed_at, a.completed_at) AS completed_at FROM po_lines a
    LEFT JOIN {FIRST_DONE.format(t='po_lines')} f ON a.po_no = f.po_no""",
)
add(
    "w6_share",
    f"""WITH t AS (SELECT style_code, {s('sold_amt')} AS sold_amt, {s('sold_qty')} AS sold_qty
        FROM sales_paid GROUP BY 1)
    SELECT *, {r('sold_amt / (SELECT ' + s('sold_amt') + ' FROM sales_paid)', 4)} AS share FROM t""",
)
add(
    "w7_top_flag",
    """SELECT skc, category, avg3d_sales, skc || category AS row_key,
    CASE WHEN row_number() OVER (ORDER BY avg3d_sales DESC, skc || category) <= 200 THEN '是' ELSE '否' END AS top200
    FROM merch_board""",
)
add(
    "o1_mixed_sort",
    f"SELECT style_code, po_date, {s('po_qty')} AS po_qty FROM {BOTH} GROUP BY 1, 2 ORDER BY 1, 2 DESC",
)
add(
    "o3_top_k",
    f"""WITH t AS (SELECT style_code || {color()} AS skc, {s('sold_amt')} AS sold_amt, {s('sold_qty')} AS sold_qty
        FROM sales_paid GROUP BY 1)
    SELECT *, CAST(row_number() OVER (ORDER BY sold_amt DESC, skc) AS INTEGER) AS rank FROM t
    QUALIFY rank <= 36""",
)
_position = " ".join(f"WHEN '{x}' THEN {i}" for i, x in enumerate(LABELS, 1))
add(
    "o4_label_order",
    f"""SELECT category, {s('sold_qty')} AS sold_qty, CASE category {_position} ELSE {len(LABELS) + 1} END AS position
    FROM sales_paid GROUP BY 1 ORDER BY position, category""",
)
add(
    "u1_union",
    f"""WITH u AS (SELECT style_code, NULL AS supplier, po_qty FROM purchase_history
        UNION ALL SELECT style_code, supplier, po_qty FROM purchase_current)
    SELECT style_code, supplier, {s('po_qty')} AS po_qty FROM u GROUP BY 1, 2""",
)
add(
    "u3_union_distinct",
    """SELECT style_code, shop, sold_qty FROM sales_paid WHERE sold_qty >= 45
    UNION SELECT style_code, shop, sold_qty FROM sales_paid WHERE style_code = 'Brand#2'""",
)

add(
    "f2_codes",
    f"""SELECT {code('sku')} AS sku, trim(sku, ' 　') AS stripped, count(*) AS n FROM sales_paid GROUP BY ALL""",
)
add(
    "f3_strip_brackets",
    r"""SELECT sku, spec, regexp_replace(regexp_replace(regexp_replace(regexp_replace(spec,
    '\s*\([^)]*\)', '', 'g'), '\s*【[^】]*】', '', 'g'), '\s*（[^）]*）', '', 'g'), '\s*\([^）]*）', '', 'g')
    AS clean FROM stock""",
)
add(
    "f4_split",
    f"SELECT {color()} AS color, coalesce({spec()}, '') AS spec, count(*) AS n FROM po_lines GROUP BY 1, 2",
)
add("f5_color_spec", f"SELECT {color()} AS color, {spec()} AS spec, count(*) AS n FROM sales_paid GROUP BY 1, 2")
TITLE = "coalesce(nullif(regexp_extract(online_title, '【([^】]+)】', 1), ''), online_title)"
add("f6_bracket_title", f"SELECT online_title, {TITLE} AS short_title, count(*) AS n FROM order_lines GROUP BY 1, 2")
add("f8_unescape", "SELECT sku, replace(color, '_x002B_', '+') AS color FROM catalog")
STREAMER = "trim(split_part(streamer_id, '.', 1))"
add("f9_id_canon", f"SELECT {STREAMER} AS streamer, count(*) AS n FROM order_lines GROUP BY 1")
FINITE = "CASE WHEN isfinite(TRY_CAST({x} AS DOUBLE)) THEN TRY_CAST({x} AS DOUBLE) END"
SOLD = "(SELECT * FROM sales_history UNION ALL SELECT * FROM sales_current) u"
add(
    "f11_to_number",
    f"""SELECT style_code, {s('TRY_CAST(sold_qty AS DOUBLE)')} AS sold, count({FINITE.format(x='sold_qty')}) AS n
    FROM {SOLD} GROUP BY 1""",
)
add(
    "f12_parse_ts",
    f"""SELECT form, CAST(CASE form WHEN 'none' THEN NULL WHEN 'slash time' THEN day + INTERVAL '8 hours 30 minutes'
    ELSE day END AS VARCHAR) AS at, count(*) AS n
    FROM (SELECT form, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS day FROM ({X.DATE_TEXTS_SQL}) t) z GROUP BY 1, 2""",
)
add("f14_hour_label", f"SELECT {HOUR} AS hour, count(*) AS n FROM live_sales GROUP BY 1")
add(
    "f15_elapsed_days",
    f"""SELECT po_no, sku, {r(days('po_date', 'received_at'), 2)} AS days,
    CAST(ceil({days('po_date', 'received_at')}) AS INTEGER) AS whole_days FROM receipts""",
)
add(
    "f16_age_bins",
    f"""WITH a AS (SELECT {AGE_DAYS.format(x='CAST(date AS DATE)')} AS d FROM sales_paid)
    SELECT {AGE.format(x='d')} AS age, count(*) AS n, CAST(min(d) AS INTEGER) AS least,
    CAST(max(d) AS INTEGER) AS most FROM a GROUP BY 1""",
)
add(
    "f18_round_even",
    f"""SELECT p_partkey, {r('p_size / 8', 2)} AS a, {r('p_retailprice / 8', 2)} AS b, {r('p_size / 2', 0)} AS c
    FROM part""",
)

# --- reports

LINE_SUMS = """per AS (SELECT {keys}c.skc, {sums} FROM {lines} a LEFT JOIN sku_skc c ON {on}
    WHERE c.skc IS NOT NULL GROUP BY ALL)"""


def skc_sums(lines: str, measures: list[str], keys: str = "") -> str:
    sums = ", ".join(f"{s(m)} AS {m}" for m in measures)
    on = same(code("a.sku"), "c.sku")
    return LINE_SUMS.format(keys=keys, sums=sums, lines=lines, on=on)


add(
    "q01_active_skc",
    f"""WITH {SKU_SKC}, {skc_sums('sales_paid', ['sold_qty'])},
    st AS (SELECT style_code || color AS skc, {s('on_hand')} AS a, {s('reserved')} AS b, {s('on_order')} AS c
        FROM stock GROUP BY 1),
    first AS (SELECT * FROM catalog QUALIFY row_number() OVER (PARTITION BY style_code, color ORDER BY _ord) = 1)
    SELECT replace(f.style_code || f.color, '_x002B_', '+') AS skc, f.style_code,
        replace(f.color, '_x002B_', '+') AS color, f.image_url
    FROM first f LEFT JOIN st ON f.style_code || f.color = st.skc LEFT JOIN per ON f.style_code || f.color = per.skc
    WHERE f.category IS DISTINCT FROM '辅料' AND f.category IS DISTINCT FROM '邮费' AND f.color IS NOT NULL
    AND f.style_code IS DISTINCT FROM '{X.EXCLUDED_STYLE}'
    AND (coalesce(a, 0) <> 0 OR coalesce(b, 0) <> 0 OR coalesce(c, 0) <> 0 OR coalesce(sold_qty, 0) <> 0)""",
)
add(
    "q02_catalog_clean",
    f"""SELECT style_code, image_url, {code('sku')} AS sku, color, spec, list_price, cost,
    CAST(created_at AS TIMESTAMP) AS created_at, supplier, category, year, season, title FROM catalog""",
)
CLEAN_STOCK = r"""clean AS (SELECT * REPLACE (regexp_replace(regexp_replace(regexp_replace(regexp_replace(spec,
        '\s*\([^)]*\)', '', 'g'), '\s*【[^】]*】', '', 'g'), '\s*（[^）]*）', '', 'g'), '\s*\([^）]*）', '', 'g')
        AS spec) FROM stock),
    psi AS (SELECT style_code || color AS skc, style_code, sku, color, k.spec, spec_final, on_hand, reserved,
        return_wh, inbound_wh, on_order, return_transit, virtual, available, public_available
        FROM clean k LEFT JOIN size_rule z ON k.spec IS NOT DISTINCT FROM z.spec)"""
add("q03_stock_by_sku", f"WITH {CLEAN_STOCK} SELECT * FROM psi")
PURCHASE = f"""lines AS (SELECT *, style_code || {color()} AS skc FROM
        (SELECT * FROM purchase_history UNION ALL SELECT * FROM purchase_current) u
        WHERE row_type = '明细' AND status IN ('完成', '已确认')),
    received AS (SELECT skc, {s('received_qty')} AS all_received_qty FROM lines WHERE skc IS NOT NULL GROUP BY 1),
    tagged AS (SELECT DISTINCT skc, {TAG} AS tag FROM lines),
    hist AS (SELECT l.skc, po_date, supplier, {s('po_qty')} AS po_qty, {s('received_qty')} AS received_qty
        FROM lines l WHERE tags IS DISTINCT FROM '返修退货'
        AND NOT coalesce(regexp_matches(remark, '次品|返修'), false) GROUP BY 1, 2, 3),
    final AS (SELECT h.*, all_received_qty FROM hist h LEFT JOIN received r ON h.skc = r.skc)"""
add("q04_purchase_history", f"WITH {PURCHASE} SELECT * FROM final ORDER BY skc, po_date DESC, supplier")
add(
    "q05_received_with_tags",
    f"""WITH {PURCHASE} SELECT r.skc, all_received_qty AS received_qty, tag FROM received r
    LEFT JOIN tagged t ON r.skc = t.skc""",
)
add(
    "q06_first_purchase",
    f"""WITH {PURCHASE}, f AS (SELECT * FROM final
        QUALIFY row_number() OVER (PARTITION BY skc ORDER BY po_date, supplier DESC) = 1)
    SELECT f.*, tag FROM f LEFT JOIN tagged t ON f.skc = t.skc""",
)
add("q07_today_sales", f"WITH {SKU_SKC}, {skc_sums('today_sales', ['sold_qty'])} SELECT * FROM per")
OWN = "(c.skc IS NULL AND a.category IS NOT NULL AND contains(a.color_spec, ';'))"
add(
    "q08_sales_detail",
    f"""WITH {SKU_SKC}, m AS (SELECT module, split_part(uid, '.', 1) AS uid FROM module)
    SELECT CASE WHEN {OWN} THEN a.style_code || '+' || {color('a.color_spec')} ELSE c.skc END AS skc,
        a.shop, CAST(paid_at AS DATE) AS paid_date, channel, a.style_code, order_no, a.sku, color_spec,
        CASE WHEN {OWN} THEN {color('a.color_spec')} END AS color, CASE WHEN {OWN} THEN {spec('a.color_spec')} END AS spec,
        coalesce({STREAMER}, '') AS streamer_id, a.category, coalesce(sold_qty, 0) AS sold_qty, shipped_qty,
        return_qty, returned_qty, module, uid
    FROM order_lines a LEFT JOIN sku_skc c ON {same(code('a.sku'), 'c.sku')}
    LEFT JOIN channel h ON {same('a.shop', 'h.shop')} LEFT JOIN m ON {same(STREAMER, 'm.uid')}""",
)
add(
    "q09_shipped_daily",
    f"""WITH {SKU_SKC}, shipped AS (SELECT * REPLACE (CAST(date AS DATE) AS date) FROM sales_shipped),
    {skc_sums('shipped', ['shipped_qty', 'returned_qty'], 'date, ')} SELECT * FROM per""",
)
LINE = """c.skc, {spec} AS spec, z.spec_final, h.channel, a.shop, CAST(a.date AS DATE) AS date, {sku} AS sku,
    a.style_code, a.color_spec, a.category, a.cost, {qty}, a.shipped_qty, a.shipped_amt, a.returned_qty,
    a.returned_amt, a.cost * (a.sold_qty - {ret}) AS net_cost, a.channel AS report_channel"""
add(
    "q09_shipped_detail",
    f"""WITH {SKU_SKC}, {CLEAN_STOCK} SELECT {LINE.format(
        spec='z.spec', sku=code('a.sku'), qty='sold_qty, sold_amt, return_qty, return_amt', ret='a.return_qty')}
    FROM sales_shipped a LEFT JOIN sku_skc c ON {same(code('a.sku'), 'c.sku')}
    LEFT JOIN psi z ON {same(code('a.sku'), 'z.sku')} LEFT JOIN channel h ON {same('a.shop', 'h.shop')}""",
)
FILLED = "coalesce(a.{x}, 0) AS {x}"
PAID = f"""paid AS (SELECT {LINE.format(
        spec=spec('a.color_spec'), sku=code('a.sku'),
        qty=', '.join(FILLED.format(x=m) for m in ('sold_qty', 'sold_amt', 'return_qty', 'return_amt')),
        ret='coalesce(a.return_qty, 0)')}
    FROM sales_paid a LEFT JOIN sku_skc c ON {same(code('a.sku'), 'c.sku')}
    LEFT JOIN size_rule z ON {same(spec('a.color_spec'), 'z.spec')}
    LEFT JOIN channel h ON {same('a.shop', 'h.shop')})"""
add("q10_paid_detail", f"WITH {SKU_SKC}, {PAID} SELECT * FROM paid")
_paid_sums = ", ".join(
    f"{s(m)} AS {m}" for m in ("sold_amt", "return_amt", "sold_qty", "return_qty", "net_cost")
)
add(
    "q10_paid_summary",
    f"""WITH {SKU_SKC}, {PAID}, t AS (SELECT skc, {_paid_sums} FROM paid WHERE skc IS NOT NULL GROUP BY 1)
    SELECT *, sold_amt - return_amt AS net_amt,
    {r('1.0::DOUBLE - net_cost / nullif(sold_amt - return_amt, 0)', 4)} AS margin,
    {r('sold_amt / nullif(sold_qty, 0)', 0)} AS unit_price FROM t""",
)
add(
    "q10_first_hot_day",
    f"""WITH {SKU_SKC}, {PAID}, t AS (SELECT skc, date, {s('sold_qty')} AS q FROM paid WHERE skc IS NOT NULL
        GROUP BY 1, 2) SELECT skc, min(date) AS first_hot_day FROM t WHERE q > 10 GROUP BY 1""",
)
add(
    "q11_all_time_sales",
    f"""WITH t AS (SELECT style_code, {color()} AS color, coalesce({FINITE.format(x='sold_qty')}, 0) AS a,
        coalesce({FINITE.format(x='return_qty')}, 0) AS b FROM {SOLD})
    SELECT style_code || color AS skc, style_code, color, {s('a')} AS sold_qty, {s('b')} AS return_qty,
    {s('a - b')} AS net_qty FROM t WHERE style_code || color IS NOT NULL GROUP BY 1, 2, 3""",
)
add("q12_titles", f"SELECT style_code, {TITLE} AS short_title, online_title AS title FROM order_lines")
TOP = """t AS (SELECT style_code, {amt} AS sold_amt, {qty} AS sold_qty FROM order_lines WHERE {days} GROUP BY 1),
    ranked AS (SELECT *, CAST(row_number() OVER (ORDER BY sold_amt DESC, style_code) AS INTEGER) AS rank FROM t)"""
IMAGE = """img AS (SELECT upper(style_code) AS style, arg_min(image_url, _ord) AS image_url FROM catalog
        WHERE image_url IS NOT NULL GROUP BY 1),
    launch AS (SELECT upper(style_code) AS board_style, min(CAST(launch_date AS DATE)) AS launch_date
        FROM merch_board WHERE launch_date IS NOT NULL GROUP BY style_code)"""
for name, window, k in (("q12_top20", YESTERDAY, 20), ("q12_top30", WEEK, 30)):
    add(
        name,
        f"""WITH {TOP.format(amt=s('sold_amt'), qty=s('sold_qty'), days=window)}, {IMAGE}
        SELECT rank, style_code, CAST(NULL AS DATE) AS launch_time, CAST(NULL AS VARCHAR) AS category,
        CAST(NULL AS DOUBLE) AS ref_price, sold_amt, CAST(sold_qty AS INTEGER) AS sold_qty, image_url,
        board_style, launch_date FROM ranked LEFT JOIN img ON style_code = style
        LEFT JOIN launch ON style_code = board_style WHERE rank <= {k}""",
    )
for name, k in (("q12_top36", 36), ("q12_top12_shares", 12)):
    add(
        name,
        f"""WITH {TOP.format(amt=s('sold_amt'), qty=s('sold_qty'), days=YESTERDAY)},
        names AS (SELECT style_code, online_title AS title, {TITLE} AS short_title FROM order_lines WHERE {YESTERDAY}
            QUALIFY row_number() OVER (PARTITION BY style_code ORDER BY _ord, online_title) = 1)
        SELECT rank, ranked.style_code, '' AS image,
        {r('sold_amt / nullif((SELECT ' + s('sold_amt') + ' FROM t), 0)', 4)} AS amt_share,
        {r('sold_qty / nullif((SELECT ' + s('sold_qty') + ' FROM t), 0)', 4)} AS qty_share, short_title, title
        FROM ranked LEFT JOIN names ON ranked.style_code = names.style_code WHERE rank <= {k}""",
    )
_measures4 = ("sold_qty", "shipped_qty", "return_qty", "returned_qty")
_four = ", ".join(f"{s(m)} AS {m}" for m in _measures4)
RATES = f"""lines AS (SELECT strftime(date, '%Y-%m-%d') AS date, style_code || {color()} AS skc, plan_category,
        sold_qty, shipped_qty, return_qty, returned_qty
        FROM sales_paid a LEFT JOIN category c ON {same('a.category', 'c.category')}),
    daily AS (SELECT date, skc, plan_category, {_four} FROM lines
        WHERE date IS NOT NULL AND skc IS NOT NULL AND plan_category IS NOT NULL GROUP BY 1, 2, 3),
    cum AS (SELECT date, skc, plan_category, {', '.join(f'sum({m}) OVER w AS {m}' for m in _measures4)} FROM daily
        WINDOW w AS (PARTITION BY skc ORDER BY date, plan_category ROWS UNBOUNDED PRECEDING)),
    period AS (SELECT skc, {_four} FROM lines WHERE skc IS NOT NULL GROUP BY 1),
    rates AS (SELECT c.date, c.skc, c.plan_category,
        {r('c.return_qty / nullif(c.sold_qty, 0)', 2)} AS cum_return_rate,
        {r('(c.sold_qty - c.shipped_qty) / nullif(c.sold_qty, 0)', 2)} AS cum_refund_only_rate,
        {r('c.returned_qty / nullif(c.shipped_qty, 0)', 2)} AS cum_shipped_return_rate,
        p.sold_qty AS period_sold, p.return_qty AS period_return,
        {r('p.return_qty / nullif(p.sold_qty, 0)', 2)} AS period_return_rate,
        p.sold_qty - p.shipped_qty AS period_refund_only,
        {r('(p.sold_qty - p.shipped_qty) / nullif(p.sold_qty, 0)', 2)} AS period_refund_only_rate,
        p.shipped_qty AS period_shipped, p.returned_qty AS period_returned,
        {r('p.returned_qty / nullif(p.shipped_qty, 0)', 2)} AS period_shipped_return_rate
        FROM cum c LEFT JOIN period p ON c.skc = p.skc)"""
add("q13_return_rates", f"WITH {RATES} SELECT * FROM rates")
_ids = """skc, plan_category, period_sold, period_return, period_return_rate, period_refund_only,
    period_refund_only_rate, period_shipped, period_returned, period_shipped_return_rate"""
_metric_rows = " UNION ALL ".join(
    f"SELECT {_ids}, '{m}' AS metric, date AS day, {m} AS v FROM rates"
    for m in ("cum_return_rate", "cum_refund_only_rate", "cum_shipped_return_rate")
)
add(
    "q13_return_rate_matrix",
    f"""WITH {RATES}, m AS ({_metric_rows})
    SELECT {_ids}, '' AS image, metric, {cells('day', ['v'], 2)} AS rates FROM m WHERE v IS NOT NULL
    GROUP BY {_ids}, metric""",
)
add("q13_return_rate_blocks", f"""WITH {RATES} SELECT skc, plan_category, date, cum_return_rate, cum_refund_only_rate,
    cum_shipped_return_rate FROM rates WHERE date IS NOT NULL""")
_rate_cells = ", ".join(f"""max(CASE WHEN day = '{d}' THEN v END) AS "{d}\"""" for d in RATE_DATES)
add(
    "q13_return_rate_columns",
    f"""WITH {RATES}, m AS ({_metric_rows})
    SELECT {_ids}, '' AS image, metric, {_rate_cells} FROM m WHERE v IS NOT NULL AND day BETWEEN '{RATE_DATES[0]}' AND '{RATE_DATES[-1]}'
    GROUP BY {_ids}, metric""",
)
LIVE = f"""live AS (SELECT paid_at, CAST(paid_at AS DATE) AS date, trim(streamer_id) AS streamer_id, style_code,
        sold_qty, {HOUR} AS hour, {{session}} AS session FROM live_sales
        WHERE trim(streamer_id) = '{X.LIVE_STREAMER}')"""
add("q14_live_lines", f"WITH {LIVE.format(session=session('paid_at', MONTH_SESSIONS))} SELECT * FROM live")
add(
    "q14_live_board",
    f"""WITH {LIVE.format(session=session('paid_at', MONTH_SESSIONS))}
    SELECT style_code, '' AS image, '' AS category, {s('sold_qty')} AS session_total, {hour_cells(MONTH_HOURS)}
    FROM live WHERE session IS NOT NULL GROUP BY 1""",
)
CURVE = f"""{REFUND_LINES.format(where=f" WHERE trim(streamer_id) IS DISTINCT FROM '{X.STREAMER}.0'")},
    refunds AS (SELECT * FROM lines WHERE claim_type = '仅退款'),
    by_delay AS (SELECT paid_date, skc, delay, {s('return_qty')} AS return_qty FROM refunds
        WHERE delay IS NOT NULL GROUP BY 1, 2, 3),
    cum AS (SELECT *, sum(return_qty) OVER (PARTITION BY paid_date, skc ORDER BY delay ROWS UNBOUNDED PRECEDING)
        AS cum_refund FROM by_delay),
    by_day AS (SELECT paid_date, skc, {s('return_qty')} AS day_refund_only FROM refunds GROUP BY 1, 2),
    opening AS (SELECT CAST(date AS DATE) AS paid_date, skc, {s('opening_qty')} AS opening_stock
        FROM stock_daily GROUP BY 1, 2),
    totals AS (SELECT paid_date, skc, category, {_four} FROM lines WHERE category IS NOT NULL GROUP BY 1, 2, 3),
    curve AS (SELECT c.paid_date, c.skc, c.delay, c.return_qty, cum_refund, day_refund_only, category, opening_stock,
        t.sold_qty AS day_sold, t.shipped_qty AS day_shipped,
        {r('t.returned_qty / nullif(t.shipped_qty, 0)', 2)} AS post_ship_refund_rate,
        {r('t.return_qty / nullif(t.sold_qty, 0)', 2)} AS full_return_rate,
        {r('day_refund_only / nullif(t.sold_qty, 0)', 2)} AS pre_ship_refund_rate,
        {r('cum_refund / nullif(t.sold_qty, 0)', 2)} AS cum_share
        FROM cum c LEFT JOIN totals t ON c.paid_date = t.paid_date AND c.skc = t.skc
        LEFT JOIN by_day d ON c.paid_date = d.paid_date AND c.skc = d.skc
        LEFT JOIN opening o ON t.paid_date = o.paid_date AND t.skc = o.skc)"""
add("q15_refund_curve", f"WITH {CURVE} SELECT * FROM curve")
add(
    "q15_refund_curve_wide",
    f"""WITH {CURVE} SELECT paid_date, skc, category, opening_stock, day_sold, day_refund_only, day_shipped,
    pre_ship_refund_rate, post_ship_refund_rate, full_return_rate,
    {cells('delay', ['return_qty', 'cum_refund', 'cum_share'], 4)} AS curve
    FROM curve WHERE delay <= 25 GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9, 10""",
)
_curve_cells = ", ".join(
    f'''max(CASE WHEN delay = {d} THEN {m} END) AS "{m}_{d}"''' for m in ("return_qty", "cum_refund", "cum_share") for d in REFUND_DELAYS
)
add(
    "q15_refund_curve_columns",
    f"""WITH {CURVE} SELECT paid_date, skc, category, opening_stock, day_sold, day_refund_only, day_shipped,
    pre_ship_refund_rate, post_ship_refund_rate, full_return_rate, {_curve_cells}
    FROM curve WHERE delay BETWEEN {REFUND_DELAYS[0]} AND {REFUND_DELAYS[-1]} GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9, 10""",
)
add(
    "q16_po_lead_time",
    f"""WITH {RECEIPTS}, {FIRST_PLAN},
    lines AS (SELECT *, {color()} AS color, coalesce({spec()}, '') AS spec, style_code || {color()} AS skc,
        po_no || style_code || {color()} AS po_skc, po_no || sku AS po_sku FROM po_lines
        WHERE status IN ('完成', '已确认') AND tags IS DISTINCT FROM '返修退货'
        AND NOT coalesce(regexp_matches(remark, '次品|返修'), false)),
    statuses AS (SELECT DISTINCT po_no, status AS po_status FROM lines),
    fanned AS (SELECT l.*, po_status FROM lines l LEFT JOIN statuses z ON l.po_no = z.po_no),
    ratio AS (SELECT po_skc, coalesce({r(s('received_qty') + ' / nullif(' + s('po_qty') + ', 0)', 2)}, 0)
        AS completion_ratio FROM fanned GROUP BY 1)
    SELECT f.po_no, f.sku, f.style_code, f.color_spec, f.category, f.status, f.tags, f.remark, f.po_date,
        coalesce(d.completed_at, f.completed_at) AS completed_at, f.po_qty, f.received_qty, f.color, f.spec,
        f.skc, f.po_skc, f.po_sku, f.po_status, avg_receipt_days, receipt_qty, plan_category,
        completion_ratio, CASE WHEN completion_ratio >= 0.75 THEN '完结' ELSE '未完结' END AS done
    FROM fanned f LEFT JOIN {FIRST_DONE.format(t='lines')} d ON f.po_no = d.po_no
    LEFT JOIN rec ON f.po_sku = rec.po_sku LEFT JOIN plan p ON f.category = p.category
    LEFT JOIN ratio ON f.po_skc = ratio.po_skc""",
)
add(
    "q17_stock_ageing",
    f"""WITH {DETAIL}, {GRID},
    sub AS (SELECT * FROM grid UNION ALL SELECT class, '总计', sum(skc_count), {s('total_stock')}, {s('stock_cost')}
        FROM grid GROUP BY class),
    rounded AS (SELECT class, age, CAST(skc_count AS DOUBLE) AS skc_count, total_stock,
        round_even(stock_cost, 0) AS stock_cost FROM sub),
    shared AS (SELECT *, CASE WHEN (SELECT sum(stock_cost) FROM rounded) = 0 THEN 0
        ELSE {r('stock_cost / (SELECT sum(stock_cost) FROM rounded)', 4)} END * 2 AS cost_share FROM rounded),
    everything AS (SELECT * FROM shared UNION ALL SELECT '总计', '合计', sum(skc_count) / 2, sum(total_stock) / 2,
        sum(stock_cost) / 2, sum(cost_share) / 2 FROM shared)
    SELECT class, age, skc_count, total_stock, stock_cost, round(cost_share, 4) AS cost_share FROM everything""",
)
add("q17_ageing_detail", f"WITH {DETAIL} SELECT * FROM detail")
add("q18_listing_lines", f"WITH {ROUTED} SELECT * FROM enriched")
add(
    "q18_listing_matrix",
    f"""WITH {ROUTED} SELECT replace(skc, '_x002B_', '+') AS skc, {_shop_cells} FROM enriched
    WHERE skc IS NOT NULL GROUP BY enriched.skc""",
)
add(
    "q18_listing_maps",
    f"""WITH {ROUTED}, f AS (SELECT skc, channel, shop, max(is_listed) AS v FROM enriched
        WHERE skc IS NOT NULL AND channel IS NOT NULL AND shop IS NOT NULL GROUP BY 1, 2, 3),
    n AS (SELECT skc, '{{' || channel || ', ' || shop || '}}' AS place, channel, shop, v FROM f)
    SELECT replace(skc, '_x002B_', '+') AS skc,
    string_agg(place || '=' || {fixed('v', 0)}, ';' ORDER BY channel, shop) AS listed FROM n GROUP BY n.skc""",
)
add(
    "q18_priority_skc",
    """WITH k AS (SELECT style_code, skc, color, CAST(launch_date AS DATE) AS launch_date, plan_category, total_stock,
        reserved, CAST(avg3d_sales AS INTEGER) AS avg3d_sales,
        row_number() OVER (ORDER BY CAST(avg3d_sales AS INTEGER) DESC, skc, _ord) AS n
        FROM merch_board WHERE total_stock >= 10 OR reserved >= 10)
    SELECT * EXCLUDE n, CASE WHEN n <= 200 THEN '是' ELSE '否' END AS top200 FROM k
    WHERE plan_category IS DISTINCT FROM '美妆'""",
)
_escaped = ("款式编码", "颜色", "商品编码")
add(
    "q18_stock_export",
    "SELECT " + ", ".join(
        f"""replace("{c}", '_x002B_', '+') AS "{c}\"""" if c in _escaped else f'"{c}"' for c in X.EXPORT
    ) + " FROM stock_export",
)
add(
    "q18_image_worklist",
    """SELECT image_url, style_code, color, style_code || color AS skc FROM catalog
    WHERE style_code || color IN (SELECT skc FROM merch_board WHERE image IS NULL)
    QUALIFY row_number() OVER (PARTITION BY style_code || color ORDER BY _ord) = 1""",
)
