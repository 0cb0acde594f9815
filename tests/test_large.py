"""Operators for tables and keys larger than a task: blocks, spans in a table, sums of any size, bundles as a unit."""

import builtins
import datetime as dt
import importlib
import math
import random
import sys
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from skuloom.functions import numeric as N
from skuloom.operators import aggregates as A
from skuloom.operators import blocks as B
from skuloom.operators import intervals as I
from skuloom.operators import reshape as R
from skuloom.operators import windows as W
from skuloom.plans import history, purchase, sales
from skuloom.sources import writers


# --- sums

VALUES = {
    "one": [1e26], "three": [1e26] * 3, "tiny": [1e-21] * 10, "cancel": [1e300, 1.0, -1e300], "least": [5e-324] * 10,
    "most": [1.7e308, -1.7e308, 2.5], "mixed": [1e26, 1e-21, 0.1, 0.2, None], "none": [0.0, None], "odd": [float("nan"), float("inf"), 3.0],
}


@pytest.mark.parametrize("seed", [1, 2])
def test_doubles_of_any_size_add_up_in_any_order(spark, seed):
    r = random.Random(7)
    data = VALUES | {f"r{k}": [r.choice((-1, 1)) * r.random() * 2.0 ** r.randrange(-1000, 1000) for _ in range(30)] for k in range(8)}
    rows = [(k, v, 1.5) for k, vs in data.items() for v in vs]
    random.Random(seed).shuffle(rows)
    df = spark.createDataFrame(rows, "k string, v double, w double").repartition(1 + 2 * seed)
    got = {x["k"]: (x["v"], x["w"]) for x in A.group_sum(df, ["k"], ["v", "w"], any_size=True).collect()}
    for k, vs in data.items():
        want = float(sum(Fraction(v) for v in vs if v is not None and math.isfinite(v)))
        assert abs(got[k][0] - want) <= math.ulp(want) and got[k][1] == 1.5 * len(vs)
    assert {k: got[k][0] for k in ("one", "three", "tiny", "cancel")} == {"one": 1e26, "three": 3 * 1e26, "tiny": 1e-20, "cancel": 1.0}


def test_sums_do_not_saturate(spark):
    df = spark.createDataFrame([("a", 1e26)], "k string, v double")
    with pytest.raises(Exception, match="any_size"):
        A.group_sum(df, ["k"], ["v"]).collect()
    with pytest.raises(Exception, match="need group_sum"):
        df.agg(N.total("v")).collect()
    assert A.group_sum(df, [], ["v"], any_size=True).first()[0] == 1e26


def test_partial_sums_of_any_size_add_further(spark):
    rows = [(i % 7, "ab"[i % 2], v) for i, v in enumerate([1e26, 1.0, 1e-21, -1e26, 0.25] * 9)]
    df = spark.createDataFrame(rows, "i int, k string, v double")
    parts = A.partial_sums(df, ["i", "k"], ["v"], any_size=True)
    got = {r["k"]: r["v"] for r in A.final_sums(parts, ["k"], ["v"]).collect()}
    assert got == {k: float(sum(Fraction(v) for _, x, v in rows if x == k)) for k in "ab"}


def test_running_sums_of_any_size(spark):
    rows = [("a", i, v) for i, v in enumerate([1e26, 1e26, 3e25])] + [("b", i, 2e-30) for i in range(4)] + [("c", 0, 0.0), ("c", 1, 1.5)]
    got = W.running_sum(spark.createDataFrame(rows, "k string, d int, v double"), ["k"], ["d"], {"v": "c"}, any_size=True)
    found = {(r["k"], r["d"]): r["c"] for r in got.collect()}
    for (k, d), c in found.items():
        want = float(sum(Fraction(v) for x, i, v in rows if x == k and i <= d))
        assert abs(c - want) <= math.ulp(want)


def test_plans_of_sums_are_short(spark):
    from checks.queries import QUERIES

    def size(name):
        return len(QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString())

    assert size("q11_all_time_sales") < 20_000


# --- blocks


@pytest.mark.parametrize("block", [7, 1000])
def test_positions_without_a_window_over_all_rows(spark, block):
    r = random.Random(block)
    rows = [(r.choice((None, 0, 1, 1, 1, 2)), i) for i in range(200)]
    df = spark.createDataFrame(rows, "v int, id int").repartition(5)
    got = B.row_positions(df, [F.desc("v"), F.asc("id")], block_rows=block).collect()
    want = sorted(rows, key=lambda x: (x[0] is None, -(x[0] or 0), x[1]))
    assert [(x["v"], x["id"]) for x in sorted(got, key=lambda x: x["position"])] == want
    assert [x["position"] for x in sorted(got, key=lambda x: x["position"])] == list(range(1, 201))


def test_positions_of_equal_rows_and_of_nothing(spark):
    df = spark.createDataFrame([(1,)] * 50, "v int")
    assert sorted(r["position"] for r in B.row_positions(df, ["v"], block_rows=8).collect()) == list(range(1, 51))
    assert B.row_positions(df.filter("v > 1"), ["v"]).count() == 0


@pytest.mark.parametrize("block", [9, 10_000])
def test_prefix_sums_are_running_sums(spark, block):
    r = random.Random(3)
    rows = [(r.choice(("hot",) * 8 + ("a", "b", None)), i, r.choice((None, 0.1, 2.0, -3.25))) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, d int, v double").repartition(4)
    got = B.prefix_sums(df, ["k"], ["d"], {"v": "c"}, block_rows=block)
    want = W.running_sum(df, ["k"], ["d"], {"v": "c"})
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))


def test_no_block_is_larger_than_asked_by_much(spark):
    df = spark.range(5000).select(F.lit("all").alias("k"), F.col("id").alias("d"), F.lit(1.0).alias("v"))
    sizes = [r["count"] for r in B.in_blocks(df, ["k", "d"], 500).groupBy(B.BLOCK).count().collect()]
    assert max(sizes) <= 1500 and sum(sizes) == 5000


def test_blocks_are_few_where_they_are_small(spark):
    df = spark.range(1500).select(F.lit("all").alias("k"), F.col("id").alias("d"))
    assert B.in_blocks(df, ["k", "d"], 1).rdd.getNumPartitions() <= 512
    assert sorted(r["position"] for r in B.row_positions(df, ["d"], block_rows=1).collect()) == list(range(1, 1501))


def test_blocks_need_a_shared_folder_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda key, default: default)})

    class Frame:
        sparkSession = Session()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        B.written(Frame())


# --- spans


def plain_spans(rows, spans):
    found = []
    for at, k in rows:
        own = [s for s in spans if at is not None and s[1] is not None and s[2] is not None and s[1] <= at <= s[2]]
        found.append((at, k, max(own, key=lambda s: (s[3], s[1], s[2], s[0]))[0] if own else None))
    return found


@pytest.mark.parametrize("widths", [I.WIDTHS, (60,), (3600, 10**6)])
def test_span_join(spark, widths):
    r, day = random.Random(5), dt.datetime(2024, 2, 28)
    rows = [(day + dt.timedelta(seconds=r.randrange(4 * 86400), microseconds=r.randrange(3)), i) for i in range(150)] + [(None, 1)]
    spans = [("x", None, day, 1), ("y", day + dt.timedelta(days=1), day, 99)]
    for i in range(40):
        start = day + dt.timedelta(seconds=r.randrange(4 * 86400))
        length = r.choice((0, 600, 7200, 40_000, 3 * 86400)) if max(widths) > 60 else r.choice((0, 50, 600, 3000))
        spans.append((f"s{i}", start, start + dt.timedelta(seconds=length), r.randrange(20)))
    # ends are included
    spans.append(("edge", rows[0][0], rows[0][0], 1000))
    df = spark.createDataFrame(rows, "at timestamp_ntz, k int")
    table = spark.createDataFrame(spans, "label string, start timestamp_ntz, end timestamp_ntz, _ord int")
    got = I.span_join(df, "at", table, {"label": "session"}, widths=widths)
    assert sorted(map(str, (tuple(x) for x in got.collect()))) == sorted(map(str, plain_spans(rows, spans)))
    assert {x[2] for x in plain_spans(rows, spans)} >= {None, "edge"}


def test_spans_that_overlap_all_along(spark):
    r, day = random.Random(8), dt.datetime(2024, 2, 28)
    spans = []
    for i in range(400):
        start = day + dt.timedelta(seconds=r.randrange(86400), microseconds=r.randrange(3))
        spans.append((f"s{i}", start, start + dt.timedelta(hours=r.choice((0, 1, 20, 50))), r.randrange(300), i % 2))
    # a date far off does not make the buckets wide
    spans.append(("far", day - dt.timedelta(days=90_000), day - dt.timedelta(days=89_999), 1, 1))
    rows = [(day + dt.timedelta(seconds=r.randrange(-3600, 4 * 86400)), r.choice((0, 1, None))) for _ in range(200)]
    table = spark.createDataFrame(spans, "label string, start timestamp_ntz, end timestamp_ntz, _ord int, g int")
    got = I.span_join(spark.createDataFrame(rows, "at timestamp_ntz, k int"), "at", table, {"label": "session"}, on={"k": "g"})
    want = [x for g in (0, 1) for x in plain_spans([y for y in rows if y[1] == g], [s[:4] for s in spans if s[4] == g])]
    assert sorted(map(str, (tuple(x) for x in got.collect()))) == sorted(map(str, [*want, *((*y, None) for y in rows if y[1] is None)]))
    # no list holds the spans that lie over its whole bucket
    own = table.select("label", F.struct("label").alias("_span"), I._micros(F.col("start")).alias("_from"), I._micros(F.col("end")).alias("_to"))
    lists = I._lists(own, [], round(I.widths_of(table, "start", "end")[0] * I.MICROS))
    assert lists.agg(F.max(F.size("_spans"))).first()[0] <= 4 * I.ENDS


def test_span_join_of_no_spans(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "at timestamp_ntz")
    table = spark.createDataFrame([], "label string, start timestamp_ntz, end timestamp_ntz, _ord int")
    assert I.span_join(df, "at", table, ["label"]).first()["label"] is None


# --- wide tables in blocks


def test_column_blocks_hold_every_cell(spark):
    rows = [(f"k{i % 5}", d, float(i * d)) for i in range(11) for d in range(40) if (i + d) % 3 and i < 5]
    df = spark.createDataFrame([*rows, ("k9", None, 1.0)], "k string, d int, v double")
    blocks, columns = R.column_blocks(df, ["k"], "d", ["v"], width=7)
    assert {len(r["cells"]) for r in blocks.collect()} == {7} and columns.count() == 40
    assert sorted(map(tuple, R.from_blocks(blocks, columns, ["k"], "d").collect())) == sorted(rows)
    wide = {r["k"]: r["c"] for r in R.spread_metrics_map(df, ["k"], "d", ["v"], "c").collect() if r["k"] != "k9"}
    assert sum(map(len, wide.values())) == len(rows)


# --- day by day


def test_history_in_any_order_of_days(spark, tmp_path):
    r = random.Random(2)
    days = {dt.date(2024, 1, 1 + i): [(f"S{r.randrange(4)}", f"c{r.randrange(2)};9", r.choice(("3", "0.1", "1e26", "n/a", None)), r.choice(("1", None))) for _ in range(25)] for i in range(4)}
    schema = "style_code string, color_spec string, sold_qty string, return_qty string"
    frames = {d: spark.createDataFrame(rows, schema) for d, rows in days.items()}
    order = [*days, list(days)[1]]
    r.shuffle(order)
    store = str(tmp_path / "store")
    # a day that is first wrong, then repeated
    history.merge_day(frames[order[-1]].limit(3), store, order[-1])
    for day in order:
        history.merge_day(frames[day], store, day)
    every = spark.createDataFrame([x for rows in days.values() for x in rows], schema)
    want = A.group_sum(sales.sold_lines(every), sales.SALES_KEYS, sales.SALES_SUMS, any_size=True)
    got = history.all_time_sales(spark, store)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.columns == want.columns


def test_history_equals_the_report(spark, tmp_path):
    from checks.fixtures import Inputs

    x = Inputs(spark, "/root/testdata/sf0.001")
    store = str(tmp_path / "store")
    history.merge_day(x["sales_current"], store, dt.date(2024, 1, 2))
    history.merge_day(x["sales_history"], store, dt.date(2024, 1, 1))
    assert sorted(map(tuple, history.all_time_sales(spark, store).collect())) == sorted(map(tuple, sales.all_time_sales(x).collect()))


# --- bundles as a unit


def test_a_bundle_is_seen_whole_or_not_at_all(spark, tmp_path):
    path = str(tmp_path / "bundle")
    with pytest.raises(FileNotFoundError):
        writers.read_run(spark, path)
    good = {"a": spark.range(3), "b": spark.range(4)}
    first = writers.write_bundle(good, path)
    bad = {"a": spark.range(30), "b": spark.range(4).select(F.raise_error(F.lit("no")))}
    with pytest.raises(Exception, match="no"):
        writers.write_bundle(bad, path)
    assert {n: d.count() for n, d in writers.read_run(spark, path).items()} == {"a": 3, "b": 4}
    writers.write_bundle({"a": spark.range(5)}, path, "csv")
    assert {n: d.count() for n, d in writers.read_run(spark, path).items()} == {"a": 5}
    assert writers.read_run(spark, path, first)["b"].count() == 4
    assert writers.old_runs(spark, path) == [first]


# --- lead times of lines without an order


def test_lines_without_an_order_number(spark):
    rows = [(None, f"s{i}", "st", "c;1", "cat", ("完成", "已确认")[i % 2], None, None, "2024-01-01", None, 2.0, 1.0, i) for i in range(10_000)]
    columns = "po_no string, sku string, style_code string, color_spec string, category string, status string, tags string, remark string, po_date string, completed_at string, po_qty double, received_qty double, _ord long"
    inputs = {
        "po_lines": spark.createDataFrame(rows, columns),
        "category": spark.createDataFrame([("cat", "P", 1)], "category string, plan_category string, _ord long"),
        "receipts": spark.createDataFrame([], "po_no string, sku string, tags string, po_date string, received_at string, qty double"),
    }
    got = purchase.po_lead_time(inputs)
    assert got.count() == 20_000 and {r["po_status"] for r in got.select("po_status").distinct().collect()} == {"完成", "已确认"}


# --- the optional part


def test_entry_without_the_corpus_operators(monkeypatch):
    own = builtins.__import__

    def refuse(name, *args, **kwargs):
        if name.split(".")[0] == "public_tokenizers":
            raise ModuleNotFoundError(name)
        return own(name, *args, **kwargs)

    for name in [n for n in sys.modules if n == "__spark_entry__" or n == "corpus_pipeline" or n.startswith(("skuloom.llm", "public_tokenizers"))]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setattr(builtins, "__import__", refuse)
    entry = importlib.import_module("__spark_entry__")
    from checks.queries import QUERIES

    assert set(entry.queries()) >= set(QUERIES) and len(QUERIES) >= 103
    monkeypatch.delitem(sys.modules, "__spark_entry__")
