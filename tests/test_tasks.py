"""Steps dealt into tasks of bounded size: the same rows as the plain form, whatever the number of tasks."""

import datetime as dt

import pytest

from checks import fixtures as X


def day(n):
    return dt.datetime(1997, 1, 1) + dt.timedelta(days=n)


@pytest.fixture()
def tables(spark):
    """A few lines with nulls, repeated orders and parts, and a key that most rows share."""
    lines = [
        (k % 5 if k % 7 else None, 0 if k % 3 else k % 11, k % 2, k % 7 + 1, float(k % 60) if k % 13 else None, 10.0 * k, 0.05, k % 9 / 100,
         "RAN"[k % 3], "FO"[k % 2], day(k % 4))
        for k in range(120)
    ]
    orders = [(k % 4, k % 3, "O", 1.0, day(k % 3), ("1-URGENT", "2-HIGH", None, "5-LOW")[k % 4]) for k in range(6)]
    part = [(k % 9, "red ring" if k % 2 else None, f"Brand#{k % 2}", ("PROMO", "MEDIUM", None)[k % 3], 40 + k, 900.0 + k) for k in range(12)]
    x = X.Inputs(spark, "/nowhere")
    x._raw = {
        "lineitem": spark.createDataFrame(
            lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double,"
            " l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"),
        "orders": spark.createDataFrame(
            orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"),
        "part": spark.createDataFrame(part, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
    }
    return x


@pytest.mark.parametrize("tasks", [1, 7])
def test_board_in_tasks_has_the_rows_of_its_text(tables, rows, monkeypatch, tasks):
    monkeypatch.setattr(X, "tasks_for", lambda n: tasks)
    text = X.TABLES["merch_board"]
    plain = tables.spark.sql(text, **{t: tables.raw(t) for t in ("lineitem", "orders", "part")})
    board = tables["merch_board"]
    assert board.dtypes == plain.dtypes
    assert rows(board) == rows(plain) and plain.count() > 3


def test_board_counts_orders_without_a_scan_task_that_holds_them_all(tables):
    plan = tables["merch_board"]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") + plan.count("repartition") >= 2 and "distinct" not in plan


def test_tasks_grow_with_the_rows():
    assert [X.tasks_for(n) for n in (0, 1, 200_000, 200_001, 216_000_000)] == [1, 1, 1, 2, 1080]


def exchanges(df, *texts):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and all(t in line for t in texts)]


def test_lead_time_shuffles_parts_and_means_once(spark):
    from checks.queries import QUERIES

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = QUERIES["q16_po_lead_time"](spark, "/root/testdata/sf0.001")
        # the groups and the lines by code, the windows by order and by code: no join shuffles parts or means anew
        assert len(exchanges(out, "po_sku")) <= 2 and not exchanges(out, "coalesce(po_skc")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_sales_detail_joins_the_module_before_texts_are_cut(tables):
    from checks.queries import QUERIES

    out = QUERIES["q08_sales_detail"](tables.spark, "/root/testdata/sf0.001")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    # the first cut of a colour stands above the join of the module
    cut, join = plan.find("substring_index(color_spec"), plan.find("Join LeftOuter")
    assert 0 <= cut < join


@pytest.mark.parametrize("n", [None, 1, 900_000])
def test_sums_of_dealt_lines(spark, rows, n):
    from skuloom.plans.catalog import skc_sums

    lines = [(f"d{k % 3}" if k % 5 else None, (" sku1", "SKU1 ", None, "sku2")[k % 4], None if k % 6 == 0 else k / 8) for k in range(90)]
    lines = spark.createDataFrame(lines, "date string, sku string, qty double")
    catalog = spark.createDataFrame([("sku1", "A", "red"), ("SKU1", "A", "red"), ("sku2", "B", None), (None, "C", "blue")], "sku string, style_code string, color string")
    got = skc_sums(lines, catalog, ["date"], ["qty"], n)
    plain = skc_sums(lines, catalog, ["date"], ["qty"])
    assert rows(got) == rows(plain) and plain.count() > 3
    assert ("REPARTITION_BY_NUM" in got._jdf.queryExecution().executedPlan().toString()) == (n is not None)


@pytest.mark.parametrize("n", [None, 1, 900_000])
def test_first_of_dealt_rows(spark, rows, n):
    from skuloom.operators.windows import keep_one

    data = spark.createDataFrame([(None if k % 2 else k % 7, ("f", 97 - k), k) for k in range(98)], "k int, _ord struct<file:string,row:int>, v int")
    got = keep_one(data, ["k"], ["_ord"], rows=n)
    assert rows(got, "k", "v") == rows(keep_one(data, ["k"], ["_ord"]), "k", "v")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and ("REPARTITION_BY_NUM" in plan) == (n is not None)
