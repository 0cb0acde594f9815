"""Reading and writing."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.fixtures import AGEING_AS_OF, AS_OF, Inputs
from skuloom import schemas
from skuloom.functions.dates import Session
from skuloom.operators.windows import keep_one
from skuloom.plans import live, sellers, workbook
from skuloom.sources import ordered_text, readers, writers

SF = "/root/testdata/sf0.001"


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_only_empty_text_is_missing(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'po_no,sku,tags\nNA,nan,\n1,"",NULL\n')
    got = readers.read_table(spark, path, columns=["po_no", "sku", "tags"]).collect()
    assert [tuple(r) for r in got] == [("NA", "nan", None), ("1", None, "NULL")]


def test_schema_pins_types_and_adds_columns(spark, tmp_path):
    path = write(tmp_path / "b.csv", "sku,date,extra\ns1,2024-01-02,x\ns2,2024-01-03,y\n")
    df = readers.read_table(spark, path, schemas.STOCK_DAILY)
    assert df.schema.names == ["sku", "skc", "date", "opening_qty", "_ord"]
    rows = df.orderBy("_ord").collect()
    assert [r["sku"] for r in rows] == ["s1", "s2"]
    assert rows[0]["date"] == dt.datetime(2024, 1, 2) and rows[0]["skc"] is None


def test_discover_takes_the_first_match(spark, tmp_path):
    for name in ("b商品资料.csv", "a商品资料库存视角.csv", "c商品资料.csv", "其他.csv"):
        write(tmp_path / name, "x\n1\n")
    found = readers.discover(spark, str(tmp_path), "*商品资料*.csv", exclude="库存视角")
    assert readers.read_table(spark, found).count() == 1
    assert spark.sparkContext._jvm.java.net.URI(found).getPath().endswith("/b商品资料.csv")
    with pytest.raises(FileNotFoundError):
        readers.discover(spark, str(tmp_path), "*没有*.csv")


def test_header_is_promoted(spark, tmp_path):
    path = write(tmp_path / "c.csv", "公式,,\n货号 ,上新日,余\nA1,2024-01-01,z\nA2,,z\n")
    df = readers.promote_header(spark, path, row=1, first_columns=2)
    assert df.columns == ["货号", "上新日", "_ord"]
    assert [tuple(r)[:2] for r in df.orderBy("_ord").collect()] == [("A1", "2024-01-01"), ("A2", None)]
    picked = readers.positional(df, [0, 1], ["style_code", "launch_date"])
    assert picked.columns == ["style_code", "launch_date"]


def test_report_round_trip(spark, tmp_path):
    a = spark.range(3)
    b = spark.createDataFrame([("x", None)], "k string, v string")
    writers.write_report({"a": a, "b": b}, str(tmp_path / "out"))
    writers.write_report({"a": a, "b": b}, str(tmp_path / "out"))
    assert readers.read_bundle(spark, str(tmp_path / "out"), "a").count() == 3
    writers.write_table(b, str(tmp_path / "b.csv"), "csv")
    assert readers.read_table(spark, str(tmp_path / "b.csv")).first() == ("x", None)


def test_workbook_from_files_to_files(spark, tmp_path):
    x = Inputs(spark, SF)
    base = str(tmp_path / "in")
    for name in workbook.WORKBOOK_INPUTS:
        writers.write_table(x[name], f"{base}/{name}")
    inputs = readers.load_inputs(spark, base, workbook.WORKBOOK_INPUTS)
    workbook.write_daily_workbook(inputs, str(tmp_path / "out"), ["Brand#7"])
    sheets = workbook.daily_workbook(inputs)
    assert len(sheets) == 13
    for name in sheets:
        assert readers.read_bundle(spark, str(tmp_path / "out"), name).count() > 0
    total = readers.read_bundle(spark, str(tmp_path / "out"), "all_time_sales")
    want = x["sales_history"].unionByName(x["sales_current"]).agg(
        F.sum(F.try_to_number("sold_qty", F.lit("99.9")))
    ).first()[0]
    assert total.agg(F.sum("sold_qty")).first()[0] == float(want)


def test_order_follows_the_files(spark, tmp_path):
    write(tmp_path / "d" / "01.csv", "k,v\na,first\n")
    write(tmp_path / "d" / "02.csv", "k,v\n" + "".join(f"a,{i}\n" for i in range(50)))
    schema = T.StructType().add("k", "string").add("v", "string").add("_ord", "long")
    df = readers.read_table(spark, str(tmp_path / "d"), schema, fmt="csv")
    assert keep_one(df, ["k"], ["_ord"]).first()["v"] == "first"
    for i, part in enumerate((df.filter("v = 'first'"), df.filter("v <> 'first'"))):
        part.drop("_ord").coalesce(1).write.parquet(str(tmp_path / "p" / f"x={i}"))
    df = readers.read_table(spark, str(tmp_path / "p"), schema)
    assert keep_one(df, ["k"], ["_ord"]).first()["v"] == "first"
    assert [r["v"] for r in df.orderBy("_ord").collect()] == ["first", *map(str, range(50))]


@pytest.mark.parametrize("split", ["64b", "1k", "128m"])
def test_order_of_text_does_not_hang_on_the_splits(spark, tmp_path, split):
    for name, first, n in (("02.csv", 200, 300), ("01.csv", 0, 200), ("03.csv", 500, 1)):
        write(tmp_path / "d" / name, "k,v\n" + "".join(f"{'x' * (i % 7)},{i}\n" for i in range(first, first + n)))
    write(tmp_path / "d" / "00.csv", "k,v\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        raw = spark.read.csv(str(tmp_path / "d"), header=True)
        assert raw.rdd.getNumPartitions() > 3 or split != "64b"
        want = [(f"0{1 + (i >= 200) + (i >= 500)}.csv", i - (200 if i >= 200 else 0) - (300 if i >= 500 else 0), str(i)) for i in range(501)]

        def told(df):
            return [(r["_ord"]["file"].rsplit("/", 1)[1], r["_ord"]["row"], r["v"]) for r in df.orderBy("_ord").collect()]

        rows = ordered_text.text_rows(raw)
        assert told(rows) == want
        # the same places where a filter takes most rows away
        assert told(rows.filter("v % 50 = 7")) == [w for w in want if int(w[2]) % 50 == 7]
        schema = T.StructType().add("k", "string").add("v", "long").add("_ord", "long")
        landed = ordered_text.land(spark, str(tmp_path / "d"), str(tmp_path / "landed"))
        df = readers.read_table(spark, landed, schema).filter("k = 'xxx'")
        assert "EqualTo(k,xxx)" in df._jdf.queryExecution().executedPlan().toString()
        assert [(f, n, str(v)) for f, n, v in told(df)] == [w for w in want if int(w[2]) % 7 == 3]
        assert df.filter("v = 3").count() == 1 and readers.read_table(spark, landed).filter("k IS NULL").count() == 72
        assert readers.read_table(spark, landed, schema).dtypes[:2] == [("k", "string"), ("v", "bigint")]
        found = readers.promote_header(spark, str(tmp_path / "d"), row=1)
        assert found.columns[:2] == ["k", "v"] and [r["v"] for r in found.orderBy("_ord").limit(2).collect()] == ["0", "1"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_filters_reach_the_scan_through_the_reader(spark, tmp_path):
    x = Inputs(spark, SF)
    base = str(tmp_path / "in")
    for name in ("order_lines", "live_sales"):
        writers.write_table(x[name].drop("_ord"), f"{base}/{name}")
    inputs = readers.load_inputs(spark, base, ["order_lines", "live_sales"])
    text = sellers.top_shares(inputs, dt.date(1999, 6, 15))._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in text.splitlines() if "FileScan" in line]
    assert scans and all("GreaterThanOrEqual(paid_at" in s for s in scans) and len(scans) <= 2
    session = Session("s", dt.datetime(2024, 1, 1, 9), dt.datetime(2024, 1, 1, 12))
    text = live.live_board(inputs, "purchase", [session])._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(paid_at" in text and "LessThanOrEqual(paid_at" in text


def test_headers_of_exports_are_renamed(spark, tmp_path):
    path = write(tmp_path / "e.csv", "商品编码,销售数量,余\ns1,3,x\n")
    row = readers.read_table(spark, path, schemas.TODAY_SALES).first()
    assert (row["sku"], row["sold_qty"]) == ("s1", 3.0)
    path = write(tmp_path / "f.csv", "甲,乙\n1,2\n")
    with pytest.raises(ValueError, match="none of the columns"):
        readers.read_table(spark, path, schemas.TODAY_SALES)


def test_lenient_columns_read_null_and_strict_ones_raise(spark, tmp_path):
    path = write(tmp_path / "g.csv", "style_code,launch_date\nA,待定\nB,2024/01/02\n")
    rows = readers.read_table(spark, path, schemas.MERCH_BOARD).orderBy("style_code").collect()
    assert [r["launch_date"] for r in rows] == [None, dt.datetime(2024, 1, 2)]
    path = write(tmp_path / "h.csv", "sku,date\nA,待定\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        readers.read_table(spark, path, schemas.STOCK_DAILY).collect()


def test_bundles_of_sellers_and_ageing(spark, tmp_path):
    x = Inputs(spark, SF)
    workbook.write_sellers_workbook(x, str(tmp_path / "s"), AS_OF)
    workbook.write_ageing_workbook(x, str(tmp_path / "a"), AGEING_AS_OF)
    assert sorted(p.name for p in (tmp_path / "s").iterdir()) == ["titles", "top20", "top30", "top36"]
    assert sorted(p.name for p in (tmp_path / "a").iterdir()) == ["ageing", "detail"]
    for path in (*(tmp_path / "s").iterdir(), *(tmp_path / "a").iterdir()):
        assert readers.read_table(spark, str(path), fmt="parquet").count() > 0
