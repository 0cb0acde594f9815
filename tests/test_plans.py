"""Physical plans."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from checks.fixtures import Inputs
from checks.queries import QUERIES
from skuloom.operators import windows as W

SF = "/root/testdata/sf0.001"
REPORTS = [n for n in QUERIES if n.startswith("q")]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_python_and_no_nested_loops(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "Python" not in text and "Pandas" not in text and "ArrowEval" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", REPORTS)
def test_windows_are_partitioned_or_limited(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for line in text.splitlines():
        found = re.search(r"Window \[row_number\(\) windowspecdefinition\((\S+)", line)
        if found and re.search(r"\], \[\S+ (ASC|DESC)", line) is None:
            assert "TakeOrderedAndProject" in text or "GlobalLimit" in text


def test_scan_reads_needed_columns_and_filters(spark):
    text = plan(QUERIES["s3_pruned_read"](spark, SF))
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in text
    df = spark.read.parquet(f"{SF}/orders.parquet")
    from skuloom.functions.dates import within_days

    text = plan(df.filter(within_days("o_orderdate", dt.date(1999, 6, 15), 7)).select("o_orderkey"))
    pushed = re.search(r"PushedFilters: \[(.*?)\]", text).group(1)
    assert "GreaterThanOrEqual(o_orderdate" in pushed and "LessThan(o_orderdate" in pushed


def test_top_k_takes_and_orders(spark):
    df = spark.range(100).withColumn("v", F.col("id") % 7)
    assert "TakeOrderedAndProject" in plan(W.top_k(df, 5, [F.desc("v"), F.asc("id")]))


def test_keep_one_cuts_groups_before_the_shuffle(spark):
    text = plan(W.keep_one(spark.range(100).withColumn("k", F.col("id") % 7), ["k"], ["id"]))
    before = text[text.index("Exchange"):]
    assert "WindowGroupLimit" in before and "Partial" in before


def test_small_lookup_is_broadcast(spark):
    from skuloom.operators.joins import lookup

    x = Inputs(spark, SF)
    text = plan(lookup(x.raw("lineitem"), x.raw("supplier"), {"l_suppkey": "s_suppkey"}, ["s_name"]))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_return_rates_shuffle_twice(spark):
    text = plan(QUERIES["q13_return_rates"](spark, SF))
    main = [line for line in text.splitlines() if "Exchange hashpartitioning(skc" in line]
    assert len(main) == 2


@pytest.mark.parametrize(
    ("name", "reads"),
    # reads of the line items: q04 and q06 one for each purchase table, q16 with the receipts, q15 with the stock table
    [("q04_purchase_history", 2), ("q06_first_purchase", 2), ("q12_top36", 2), ("q15_refund_curve", 2), ("q16_po_lead_time", 3)],
)
def test_facts_are_read_once(spark, name, reads):
    text = QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Relation \[l_orderkey", text)) <= reads


def test_refund_curve_sums_over_one_window(spark):
    # the running sum; totals by category and by delay come from the aggregation
    text = plan(QUERIES["q15_refund_curve"](spark, SF))
    assert len(re.findall(r"[+\-*:( ]Window \[", text)) == 1
