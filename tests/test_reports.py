"""Rules of single reports, on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from skuloom import schemas
from skuloom.functions.dates import Session
from skuloom.operators.projection import conform
from skuloom.plans import ageing, catalog, listing, live, purchase, returns, sales, sellers


@pytest.fixture
def table(spark):
    """A table of the given rows, all other columns null."""

    def make(name, *rows):
        schema = schemas.TABLES[name]
        full = [{**{"_ord": i}, **r} for i, r in enumerate(rows)]
        return spark.createDataFrame(
            [tuple(r.get(f.name) for f in schema) for r in full], schema
        )

    return make


def day(d, h=0):
    return dt.datetime(2024, 1, d, h)


def test_sums_follow_repeated_catalogue_rows(table, rows):
    x = {
        "today_sales": table("today_sales", {"sku": " a1", "sold_qty": 2.0}, {"sku": "A1　", "sold_qty": 1.0},
                             {"sku": None, "sold_qty": 5.0}, {"sku": "zz", "sold_qty": 7.0}),
        "catalog": table("catalog", {"sku": "a1 ", "style_code": "S", "color": "红"},
                         {"sku": "A1", "style_code": "S", "color": "红"},
                         {"sku": None, "style_code": "T", "color": "蓝"},
                         {"sku": "zz", "style_code": "U", "color": None}),
    }
    assert rows(sales.today_sales(x)) == [("S红", 6.0), ("T蓝", 5.0)]


def test_active_skc(table, rows):
    x = {
        "catalog": table(
            "catalog",
            {"style_code": "S", "color": "红_x002B_", "sku": "s1", "category": None, "image_url": "first"},
            {"style_code": "S", "color": "红_x002B_", "sku": "s2", "category": "x", "image_url": "second"},
            {"style_code": "D", "color": "灰", "sku": "d1", "category": "辅料"},
            {"style_code": "D", "color": "灰", "sku": "d2", "category": "x"},
            {"style_code": "E", "color": None, "sku": "e1"},
            {"style_code": "F", "color": "白", "sku": "f1"},
            {"style_code": "G", "color": "白", "sku": "g1"},
            {"style_code": "X", "color": "白", "sku": "x1"},
        ),
        "stock": table("stock", {"style_code": "D", "color": "灰", "on_hand": 5.0},
                       {"style_code": "G", "color": "白", "on_hand": 0.0},
                       {"style_code": "X", "color": "白", "on_order": 1.0},
                       {"style_code": "F", "color": "白", "reserved": -1.0}),
        "sales_paid": table("sales_paid", {"sku": "S2", "sold_qty": 1.0}, {"sku": "g1"}),
    }
    got = rows(catalog.active_skc(x, excluded_styles=["X"]))
    # the first row of a style and colour decides on its category
    assert got == [("F白", "F", "白", None), ("S红+", "S", "红+", "first")]


def test_fallback_skc_of_unknown_skus(table, rows):
    x = {
        "order_lines": table(
            "order_lines",
            {"sku": "a", "style_code": "S", "category": "c", "color_spec": "红;M;2", "streamer_id": " 17.0"},
            {"sku": "no", "style_code": "S", "category": "c", "color_spec": "红;M;2", "streamer_id": None},
            {"sku": "no", "style_code": None, "category": "c", "color_spec": "红;M"},
            {"sku": "no", "style_code": "S", "category": None, "color_spec": "红;M"},
            {"sku": "no", "style_code": "S", "category": "c", "color_spec": "红"},
        ),
        "catalog": table("catalog", {"sku": "A", "style_code": "S", "color": "红"}),
        "channel": table("channel"),
        "module": table("module", {"module": "m", "uid": "17.0 "}),
    }
    out = sales.sales_detail(x)
    assert rows(out, "skc", "color", "spec", "streamer_id", "module") == [
        ("S+红", "红", "M;2", "", None), ("S红", None, None, "17", "m"),
        ("nan+红", "红", "M", "", None), (None, None, None, "", None), (None, None, None, "", None),
    ]


def test_stock_codes_stay_as_written_unless_asked(table, rows):
    x = {
        "sales_shipped": table("sales_shipped", {"sku": "a1 ", "date": day(1), "cost": 2.0, "sold_qty": 3.0}),
        "catalog": table("catalog"), "channel": table("channel"), "size_rule": table("size_rule"),
        "stock": table("stock", {"sku": "a1", "spec": "M (x)"}),
    }
    assert rows(sales.shipped_detail(x), "spec", "net_cost") == [(None, None)]
    assert rows(sales.shipped_detail(x, normalise_stock=True), "spec") == [("M",)]


def test_paid_summary_counts_repeated_dimension_rows(table, rows):
    line = {"sku": "a", "shop": "s", "color_spec": "红;M", "cost": 1.0, "sold_qty": 4.0, "sold_amt": 10.0,
            "return_qty": 1.0, "return_amt": 2.5, "date": day(1)}
    x = {
        "sales_paid": table("sales_paid", line, {**line, "cost": None, "return_qty": None, "return_amt": None}),
        "catalog": table("catalog", {"sku": "A", "style_code": "S", "color": "红"}),
        "size_rule": table("size_rule", {"spec": "M", "spec_final": "1"}, {"spec": "M", "spec_final": "2"}),
        "channel": table("channel", {"shop": "s", "channel": "c"}),
    }
    got = sales.paid_summary(x).first().asDict()
    assert (got["sold_amt"], got["return_amt"], got["net_cost"]) == (40.0, 5.0, 6.0)
    assert (got["net_amt"], got["margin"], got["unit_price"]) == (35.0, 0.8286, 2.0)
    assert sales.paid_detail(x).count() == 4
    hot = sales.first_hot_day(x, threshold=10).first()
    assert hot["first_hot_day"] == dt.date(2024, 1, 1)


def po(**kw):
    return {"row_type": "明细", "status": "完成", "style_code": "S", "color_spec": "红;M", "supplier": "v",
            "po_date": day(1), "po_qty": 1.0, "received_qty": 1.0, **kw}


def test_purchase_reports(table, rows):
    x = {
        "purchase_history": table("purchase_history", po(remark="小晶"), po(po_date=day(2), tags="返修退货"),
                                  po(remark="次品", received_qty=10.0), po(row_type="汇总"), po(status="作废")),
        "purchase_current": table("purchase_current", po(supplier="w", po_qty=5.0), po(supplier=None),
                                  po(po_date=day(3), supplier="a")),
    }
    assert rows(purchase.purchase_history(x)) == [
        ("S红", day(1), "v", 1.0, 1.0, 15.0), ("S红", day(1), "w", 5.0, 1.0, 15.0),
        ("S红", day(3), "a", 1.0, 1.0, 15.0),
    ]
    assert rows(purchase.received_with_tags(x)) == [("S红", 15.0, ""), ("S红", 15.0, "小晶")]
    # earliest day, of its suppliers the last by name, once per tag
    assert rows(purchase.first_purchase(x)) == [
        ("S红", day(1), "w", 5.0, 1.0, 15.0, ""), ("S红", day(1), "w", 5.0, 1.0, 15.0, "小晶"),
    ]


def test_po_lead_time_quirks(table, rows):
    line = {"style_code": "S", "color_spec": "红", "category": "c", "po_date": day(1), "po_qty": 4.0}
    x = {
        "po_lines": table(
            "po_lines",
            {**line, "po_no": "1", "sku": "a", "status": "完成", "received_qty": 3.0, "completed_at": day(9)},
            {**line, "po_no": "1", "sku": "b", "status": "已确认", "completed_at": day(5)},
            {**line, "po_no": None, "sku": "c", "status": "完成", "completed_at": day(7)},
            {**line, "po_no": None, "sku": "d", "status": "完成"},
            {**line, "po_no": "2", "sku": "e", "status": "完成", "po_qty": 0.0, "received_qty": 5.0},
            {**line, "po_no": "3", "sku": "f", "status": "完成", "tags": "返修退货"},
            {**line, "po_no": "3", "sku": "g", "status": "完成", "remark": "返修一下"},
        ),
        "receipts": table(
            "receipts",
            {"po_no": "1.0", "sku": "a", "po_date": day(1), "received_at": day(3), "qty": 1.0},
            {"po_no": "1", "sku": "a", "po_date": day(1), "received_at": day(5), "qty": 3.0},
            {"po_no": "1", "sku": "a", "po_date": day(1), "received_at": day(9), "qty": 9.0, "tags": "调整单"},
            {"po_no": "bad", "sku": "a", "po_date": day(1), "received_at": day(3), "qty": 1.0},
        ),
        "category": table("category", {"category": "c", "plan_category": "first"},
                          {"category": "c", "plan_category": "second"}),
    }
    out = purchase.po_lead_time(x)
    # an order with two statuses doubles its lines; its first completion replaces their own
    got = rows(out, "po_no", "sku", "po_status", "completed_at", "avg_receipt_days", "completion_ratio", "done")
    first, open_ = dt.datetime(2024, 1, 9), "未完结"
    assert got == sorted(
        [
            ("1", s, p, first, 3.5 if s == "a" else None, 0.38, open_)
            for s in "ab" for p in ("完成", "已确认")
        ]
        + [(None, "c", "完成", day(7), None, 0.0, open_), (None, "d", "完成", None, None, 0.0, open_),
           ("2", "e", "完成", None, None, 0.0, open_)],
        key=lambda t: [(v is None, str(v)) for v in t],
    )
    assert rows(out.select("po_sku", "po_skc", "plan_category").filter("po_sku like 'nan%'").distinct()) == [
        ("nanc", "nanS红", "first"), ("nand", "nanS红", "first"),
    ]


def test_return_rates(table, rows):
    line = {"style_code": "S", "color_spec": "红;M", "category": "c"}
    x = {
        "sales_paid": table(
            "sales_paid",
            {**line, "date": day(1, 9), "sold_qty": 8.0, "shipped_qty": 4.0, "return_qty": 1.0},
            {**line, "date": day(2), "sold_qty": 8.0, "shipped_qty": 4.0, "returned_qty": 2.0, "return_qty": 2.0},
            {**line, "date": day(2), "category": "unknown", "sold_qty": 84.0},
            {**line, "date": None, "sold_qty": 100.0},
        ),
        "category": table("category", {"category": "c", "plan_category": "p"}),
    }
    got = rows(returns.return_rates(x), "date", "cum_return_rate", "cum_refund_only_rate",
               "cum_shipped_return_rate", "period_sold", "period_return_rate")
    # lines without a plan category or a date count in the period only
    assert got == [("2024-01-01", 0.12, 0.5, 0.0, 200.0, 0.02), ("2024-01-02", 0.19, 0.5, 0.25, 200.0, 0.02)]
    wide = returns.return_rate_matrix(x, [dt.date(2024, 1, 1), dt.date(2024, 1, 2)])
    assert wide.columns[-2:] == ["2024-01-01", "2024-01-02"]
    assert rows(wide, "metric", "`2024-01-01`", "`2024-01-02`") == [
        ("cum_refund_only_rate", 0.5, 0.5), ("cum_return_rate", 0.12, 0.19),
        ("cum_shipped_return_rate", 0.0, 0.25),
    ]
    maps = {r["metric"]: r["rates"] for r in returns.return_rate_maps(x).collect()}
    assert maps["cum_return_rate"] == {"2024-01-01": 0.12, "2024-01-02": 0.19}
    assert maps["cum_shipped_return_rate"] == {"2024-01-01": 0.0, "2024-01-02": 0.25}


def test_refund_curve(table, rows):
    line = {"style_code": "S", "color_spec": "红", "category": "c", "paid_at": day(1, 12), "sold_qty": 10.0,
            "claim_type": "仅退款", "return_qty": 1.0}
    x = {
        "order_lines": table(
            "order_lines",
            {**line, "claim_at": day(1, 13)}, {**line, "claim_at": day(2, 13), "streamer_id": None},
            {**line, "claim_at": None}, {**line, "claim_at": day(1, 13), "streamer_id": " 99 "},
            {**line, "claim_at": day(1, 13), "claim_type": "退货"},
        ),
        "stock_daily": table("stock_daily", {"date": day(1), "skc": "S红", "opening_qty": 3.0},
                             {"date": day(1, 5), "skc": "S红", "opening_qty": 4.0}),
    }
    out = returns.refund_curve(x, excluded_streamer="99")
    assert rows(out, "delay", "return_qty", "cum_refund", "day_refund_only", "day_sold", "opening_stock",
                "cum_share", "pre_ship_refund_rate") == [
        (1, 1.0, 1.0, 3.0, 40.0, 7.0, 0.02, 0.08), (2, 1.0, 2.0, 3.0, 40.0, 7.0, 0.05, 0.08),
    ]
    wide = returns.refund_curve_wide(x, [1, 2, 30], excluded_streamer="99")
    assert [c for c in wide.columns if c.startswith("cum_refund")] == ["cum_refund_1", "cum_refund_2"]
    assert wide.count() == 1
    early = {**line, "paid_at": day(3, 12), "claim_at": day(1, 13)}
    x["order_lines"] = x["order_lines"].unionByName(table("order_lines", early, {**early, "category": None}))
    by_day = {str(r["paid_date"]): r for r in returns.refund_curve_maps(x, excluded_streamer="99").collect()}
    assert {d: c["cum_refund"] for d, c in by_day["2024-01-01"]["curve"].items()} == {1: 1.0, 2: 2.0}
    # a claim before the payment counts too, and so does the line without a category, but for the totals by category
    assert {d: tuple(c) for d, c in by_day["2024-01-03"]["curve"].items()} == {-1: (2.0, 2.0, 0.2)}
    assert by_day["2024-01-03"]["day_sold"] == 10.0


def test_live_board_shows_the_hours_of_the_sessions(table):
    x = {"live_sales": table(
        "live_sales",
        {"paid_at": day(1, 9), "streamer_id": "1 ", "style_code": "a", "sold_qty": 2.0},
        {"paid_at": day(1, 11), "streamer_id": "1", "style_code": "b", "sold_qty": 5.0},
        {"paid_at": day(1, 11), "streamer_id": "2", "style_code": "b", "sold_qty": 50.0},
        {"paid_at": day(2, 11), "streamer_id": "1", "style_code": "b", "sold_qty": 50.0},
    )}
    board = live.live_board(x, "1", [Session("s", day(1, 8), day(1, 12))])
    assert board.columns == ["style_code", "image", "category", "session_total",
                             "01.01 08:00-09:00", "01.01 09:00-10:00", "01.01 10:00-11:00", "01.01 11:00-12:00",
                             "01.01 12:00-13:00"]
    assert [tuple(r) for r in board.collect()] == [
        ("b", "", "", 5.0, 0.0, 0.0, 0.0, 5.0, 0.0), ("a", "", "", 2.0, 0.0, 2.0, 0.0, 0.0, 0.0),
    ]


def test_ageing_steps_and_totals(table):
    row = {"category": "x", "available": 1.0, "cost": 1.0, "skc": "k"}
    x = {"merch_board": table(
        "merch_board",
        {**row, "class": "配饰", "total_stock": 1.0, "last_order_date": day(1)},
        {**row, "class": "其他", "total_stock": 2.5, "launch_date": day(1)},
        {**row, "class": "其他", "total_stock": 9.0, "category": None},
        {**row, "class": "其他", "total_stock": 9.0, "available": 0.0},
        {**row, "class": "其他", "category": "美妆", "total_stock": 3.0, "created_at": dt.datetime(2021, 1, 1)},
    )}
    out = [tuple(r) for r in ageing.stock_ageing(x, dt.date(2024, 1, 31)).collect()]
    assert [r[0] for r in out] == ["配饰"] * 6 + ["美妆"] * 6 + ["总计"] + ["其他"] * 6
    by_key = {r[:2]: r[2:] for r in out}
    # 2.5 rounds to 2, shares are twice the rounded share of all rows
    assert by_key[("其他", "0-6个月")] == (1.0, 2.5, 2.0, 0.3334)
    assert by_key[("美妆", "24个月以上")] == (1.0, 3.0, 3.0, 0.5)
    assert by_key[("配饰", "7-12个月")] == (0.0, 0.0, 0.0, 0.0)
    assert by_key[("总计", "合计")] == (3.0, 6.5, 6.0, 1.0)


def test_listing_routes_one_shop(table, rows):
    x = {
        "listings": table(
            "listings",
            {"shop": "vip", "site": "Vipapis", "online_style": "N1", "system_style": "old", "is_listed": 1},
            {"shop": "t", "site": "Tmall", "system_style": "S", "system_sku": "s1", "is_listed": 0},
            {"shop": None, "site": "?", "system_style": "S", "system_sku": "none", "is_listed": 1},
        ),
        "catalog": table("catalog", {"style_code": "S", "sku": "s1", "color": "红_x002B_", "national_code": "N1"}),
    }
    assert rows(listing.listing_lines(x, "vip"), "shop", "channel", "system_style", "skc") == [
        ("t", "天猫", "S", "S红_x002B_"), ("vip", "唯品", "S", "S红_x002B_"), (None, "未知", "S", "S"),
    ]
    maps = {r["skc"]: {tuple(k): v for k, v in r["listed"].items()} for r in listing.listing_maps(x, "vip").collect()}
    assert maps == {"S红+": {("唯品", "vip"): 1, ("天猫", "t"): 0}}
    matrix = listing.listing_matrix(x, "vip", [("唯品", "vip"), ("天猫", "t")])
    assert matrix.columns == ["skc", "唯品_vip", "天猫_t"] and rows(matrix) == [("S红+", "是", "")]


def test_priority_rank_counts_removed_rows(table, rows):
    x = {"merch_board": table(
        "merch_board",
        {"skc": "a", "plan_category": "美妆", "total_stock": 10.0, "avg3d_sales": 9.0},
        {"skc": "b", "plan_category": None, "reserved": 10.0, "avg3d_sales": 8.9},
        {"skc": "b", "plan_category": None, "reserved": 10.0, "avg3d_sales": 8.9},
        {"skc": "c", "total_stock": 99.0, "avg3d_sales": 1.0},
        {"skc": "d", "total_stock": 9.0, "avg3d_sales": 99.0},
    )}
    assert rows(listing.priority_skc(x, top=2), "skc", "avg3d_sales", "top200") == [("b", 8, "是"), ("c", 1, "否")]


def test_top_sellers(table, rows):
    line = {"paid_at": day(9, 10), "sold_qty": 1.9, "sold_amt": 10.0}
    x = {
        "order_lines": table(
            "order_lines",
            {**line, "style_code": "a", "online_title": "【短】a"}, {**line, "style_code": "B", "online_title": "b"},
            {**line, "style_code": "B", "online_title": "later"}, {**line, "style_code": None},
            {**line, "style_code": "a", "paid_at": day(10)}, {**line, "style_code": "w", "paid_at": day(3), "sold_amt": 99.0},
        ),
        "catalog": table("catalog", {"style_code": "b", "image_url": None}, {"style_code": "b", "image_url": "1"},
                         {"style_code": "B", "image_url": "2"}, {"style_code": "a", "image_url": "3"}),
        "merch_board": table("merch_board", {"style_code": "b", "launch_date": day(5)},
                             {"style_code": "B", "launch_date": day(4)}, {"style_code": "B", "launch_date": day(6)}),
    }
    as_of = dt.date(2024, 1, 10)
    got = sellers.top_styles(x, as_of, 1, 20).select("rank", "style_code", "sold_qty", "image_url", "launch_date")
    # catalogue styles are upper-cased, sales styles are not; case variants of the board repeat the row
    assert [tuple(r) for r in got.collect()] == [
        (1, "B", 3, "1", dt.date(2024, 1, 4)), (1, "B", 3, "1", dt.date(2024, 1, 5)), (2, "a", 1, None, None),
    ]
    assert sellers.top_styles(x, as_of, 7, 1).first()["style_code"] == "w"
    got = sellers.top_shares(x, as_of).select("rank", "style_code", "amt_share", "short_title", "title")
    assert [tuple(r) for r in got.collect()] == [(1, "B", 0.6667, "b", "b"), (2, "a", 0.3333, "短", "【短】a")]
    assert sellers.title_table(x).count() == 6


def test_export_and_worklist(spark, table, rows):
    df = spark.createDataFrame([("a_x002B_b", "x", "y")], "`款式编码` string, `多余` string, `可用数` string")
    out = catalog.stock_export({"stock_export": df})
    assert len(out.columns) == 28 and out.first()["款式编码"] == "a+b" and out.first()["可用数"] == "y"
    x = {
        "merch_board": table("merch_board", {"skc": "S红"}, {"skc": None}, {"skc": "T白", "image": "i"}),
        "catalog": table("catalog", {"style_code": "S", "color": "红", "image_url": "1"},
                         {"style_code": "S", "color": "红", "image_url": "2"}, {"style_code": "T", "color": "白"},
                         {"style_code": "U", "color": None, "image_url": "3"}),
    }
    assert rows(catalog.image_worklist(x), "skc", "image_url") == [("S红", "1"), (None, "3")]
    strict = {"catalog": conform(table("catalog").withColumn("created_at", F.lit("x")), catalog.CATALOG_COLUMNS)}
    assert catalog.catalog_clean(strict).count() == 0
