"""The shuffle join with frequent keys split."""

import pytest
from pyspark.sql import functions as F

from checks import fixtures as X
from skuloom.operators import joins as J
from skuloom.plans import listing, purchase, sales


@pytest.fixture
def tables(spark):
    # a third of all rows has the key "hot", a good part has none
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .when(F.col("id") % 7 == 0, F.lit(None))
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string")))
        .alias("key"),
        F.col("id").alias("line"),
    )
    right = spark.createDataFrame(
        [("hot", 1), ("hot", 2), (None, 3), ("k1", 4), ("k2", 5), ("k2", 6), ("nobody", 7)],
        "_key0 string, v int",
    )
    return left, right


def test_split_join_equals_the_plain_join(tables, rows):
    left, right = tables
    plain = left.join(right, F.col("key").eqNullSafe(F.col("_key0")), "left").select("key", "line", "v")
    for split_rows in (1, 100, 10_000):
        got = J.split_join(left, right, [("key", "_key0")], split_rows).select("key", "line", "v")
        assert rows(got) == rows(plain)


def test_counts_may_come_from_elsewhere(tables, rows):
    left, right = tables
    plain = J.split_join(left, right, [("key", "_key0")], 10_000).select("line", "v")
    wrong = left.filter(F.col("key").isNull())
    empty = left.limit(0)
    for source in (wrong, empty):
        got = J.split_join(left, right, [("key", "_key0")], 10, keys_from=source).select("line", "v")
        assert rows(got) == rows(plain)


def test_a_frequent_key_is_spread(spark, tables):
    left, right = tables
    before = spark.conf.get("spark.sql.adaptive.enabled")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        def tasks(split_rows):
            joined = J.split_join(left, right, [("key", "_key0")], split_rows)
            hot = joined.filter("key = 'hot'").select(F.spark_partition_id().alias("p"))
            return hot.distinct().count()

        assert tasks(10_000) == 1
        assert tasks(50) == 4
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_lookup_salts_when_asked(tables, rows):
    left, right = tables
    dim = right.withColumnRenamed("_key0", "code")
    plain = rows(J.lookup(left, dim, {"key": "code"}, ["v"]))
    assert rows(J.lookup(left, dim, {"key": "code"}, ["v"], salt_rows=100)) == plain


def test_lookup_without_nulls_and_with_one_row_per_key(tables, rows):
    left, right = tables
    dim = right.withColumnRenamed("_key0", "code")
    for salt in (None, 100):
        got = J.lookup(left, dim, {"key": "code"}, ["v"], null_safe=False, salt_rows=salt)
        assert got.filter("key IS NULL AND v IS NOT NULL").count() == 0
    first = J.lookup(left, dim, {"key": "code"}, ["v"], dedupe=[F.desc("v")])
    assert first.count() == left.count()
    assert rows(first.filter("key = 'hot'").select("v").distinct()) == [(2,)]


def test_every_frequent_key_is_split(spark):
    left = spark.range(20_000).select((F.col("id") % 5000).cast("string").alias("key"), F.col("id").alias("line"))
    right = left.select(F.col("key").alias("_key0"), F.lit(1).alias("v")).distinct()
    assert J.split_join(left, right, [("key", "_key0")], 2).filter("v = 1").count() == 20_000


def test_frequent_keys_are_found_within_the_bound(spark):
    n, held = 60_000, 256
    # rare keys by far outnumber the places of the sketch; a third of all rows has one key
    left = spark.range(n).repartition(7).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 11 == 0, F.lit(None))
        .when(F.col("id") % 13 == 0, F.concat(F.lit("w"), (F.col("id") % 2).cast("string")))
        .otherwise(F.col("id").cast("string")).alias("k"),
        F.when(F.col("id") % 5 > 0, F.col("id") % 2).alias("d"),
    )
    exact = {(r["k"], r["d"]): r["count"] for r in left.groupBy("k", "d").count().collect()}
    error, over = 3.5 * n / held, 500
    found = {(r["k"], r["d"]): r["rows"] for r in J.frequent_keys(left, over, held).collect()}
    assert {k for k, c in exact.items() if c > max(over, 2 * error)} <= set(found)
    assert all(abs(c - exact[k]) <= error and c > over for k, c in found.items())
    assert found.keys() >= {("hot", 0), ("hot", 1), ("hot", None)}
    assert len(J.frequent_keys(left, 0, held).collect()) <= held


def test_frequent_keys_of_odd_values(spark, rows):
    odd = [None, "", "null", '"', "{}", "a\\n", "\u00e9", " a", "a"]
    left = spark.createDataFrame([(k, i) for k in odd for i in range(4)], "key string, line int")
    assert rows(J.frequent_keys(left.select("key"), 3)) == sorted([(k, 4) for k in odd], key=lambda t: [(x is None, str(x)) for x in t])
    assert J.frequent_keys(left.select("key").limit(0), 3).collect() == []
    right = spark.createDataFrame([(k, k) for k in odd], "_key0 string, v string")
    got = J.split_join(left, right, [("key", "_key0")], 1).select("key", "v", "line")
    assert rows(got) == rows(left.select("key", F.col("key").alias("v"), "line"))
    zeros = spark.createDataFrame([(0.0, 1), (-0.0, 2), (float("nan"), 3)] * 4, "key double, line int")
    side = spark.createDataFrame([(0.0, "z"), (float("nan"), "n")], "_key0 double, v string")
    got = J.split_join(zeros, side, [("key", "_key0")], 2).select("line", "v")
    assert rows(got) == sorted([(1, "z"), (2, "z"), (3, "n")] * 4)
    numbers = spark.range(12).select((F.col("id") % 2).cast("int").alias("key"), F.col("id").alias("line"))
    longs = spark.createDataFrame([(0, "a"), (1, "b"), (1 << 40, "c")], "_key0 long, v string")
    got = J.split_join(numbers, longs, [("key", "_key0")], 2).select("line", "v")
    assert rows(got) == rows(numbers.select("line", F.when(F.col("key") == 0, "a").otherwise("b")))


def test_counting_keys_adds_no_shuffle_of_rows(spark, tables):
    left, right = tables
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = J.split_join(left, right, [("key", "_key0")], 100)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    # both sides of the join itself
    assert plan.count("Exchange hashpartitioning") == 2


def test_composite_keys(spark, rows):
    left = spark.createDataFrame([("a", 1), ("a", None), (None, None)] * 5, "k string, d int")
    right = spark.createDataFrame([("a", None, "x"), (None, None, "y")], "_key0 string, _key1 int, v string")
    got = rows(J.split_join(left, right, [("k", "_key0"), ("d", "_key1")], 2).select("k", "d", "v"))
    assert got == [("a", 1, None)] * 5 + [("a", None, "x")] * 5 + [(None, None, "y")] * 5


def test_chained_lookup_gives_the_rows_of_two(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), ("z", 5)], "k string, id int")
    first = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", "y"), ("b", None), (None, "x"), ("c", "q")], "code string, s string")
    second = spark.createDataFrame([("x", "red"), ("x", "blue"), (None, "grey"), (None, "pink")], "s string, color string")
    two = J.lookup(J.lookup(df, first, {"k": "code"}, {"s": "sku"}), second, {"sku": "s"}, ["color"])
    one = J.chained_lookup(df, first, {"k": "code"}, {"s": "sku"}, second, {"sku": "s"}, ["color"])
    assert one.columns == two.columns and rows(one) == rows(two)
    assert one.filter("k IS NULL").count() == 2


def test_the_many_rows_of_a_chained_lookup_are_dealt_into_tasks(spark, rows):
    # 300 codes, and none, with 4 rows on one side and 5 on the other
    code = F.when(F.col("id") % 301 > 0, F.concat(F.lit("c"), (F.col("id") % 301).cast("string")))
    df = spark.range(1204).select(code.alias("k"), F.col("id").alias("line"))
    first = spark.range(1505).select(code.alias("code"), F.concat(F.lit("s"), F.col("id").cast("string")).alias("s"))
    second = first.select("s", F.when(F.col("code").isNotNull(), F.lower("s")).alias("color"))
    shown = {"shown": F.concat("sku", F.coalesce("color", F.lit("")))}
    two = J.lookup(J.lookup(df, first, {"k": "code"}, {"s": "sku"}), second, {"sku": "s"}, ["color"]).withColumns(shown)
    for threshold in ("10MB", "-1"):
        before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            one = J.chained_lookup(df, first, {"k": "code"}, {"s": "sku"}, second, {"sku": "s"}, ["color"], derive=shown)
            assert one.columns == two.columns and rows(one) == rows(two) and one.count() == 301 * 4 * 5
            # what is read is small enough for one task
            assert one.select(F.spark_partition_id().alias("p")).distinct().count() > 4 * J.PRODUCT_TASKS / 2
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_product_join_of_several_and_of_other_keys(spark, rows):
    left = spark.createDataFrame([("a", "", 1), ("a", None, 2), (None, None, 3), ("", "x", 4), ("z", "z", 5)] * 2, "k string, d string, line int")
    right = spark.createDataFrame([("a", None, "p"), (None, None, "q"), ("", "x", "r"), ("a", "", "s"), (None, "x", "t")], "_k string, _d string, v string")
    got = rows(J.product_join(left, right, [("k", "_k"), ("d", "_d")]).select("line", "v"))
    assert got == sorted([(1, "s"), (2, "p"), (3, "q"), (4, "r")] * 2)
    numbers = spark.createDataFrame([(0, 1), (None, 2), (7, 3)], "k int, line int")
    side = spark.createDataFrame([(0, "a"), (None, "b"), (None, "c")], "_k int, v string")
    assert rows(J.product_join(numbers, side, [("k", "_k")]).select("line", "v")) == [(1, "a"), (2, "b"), (2, "c")]


def test_shop_lines_are_as_many_as_their_skcs(spark):
    listings = spark.createDataFrame(
        [("vip", "Vipapis", f"N{i % 2}", "old", f"s{i}", i % 2) for i in range(20)],
        "shop string, site string, online_style string, system_style string, system_sku string, is_listed int",
    )
    catalog = spark.createDataFrame([("S", f"s{i}", "red", f"N{i % 2}") for i in range(50)], "style_code string, sku string, color string, national_code string")
    x = {"listings": listings, "catalog": catalog}
    assert listing._shop_lines(x, "vip").count() == 2
    assert [(r["skc"], list(r["listed"].values())) for r in listing.listing_maps(x, "vip").collect()] == [("Sred", [1])]
    assert listing.listing_lines(x | {"listings": listings.withColumn("_ord", F.lit(0))}, "vip").count() == 500


def test_keep_matching_is_null_safe(spark, rows):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "k string")
    keys = spark.createDataFrame([("a",), ("a",), (None,)], "j string")
    assert rows(J.keep_matching(df, keys, {"k": "j"})) == [("a",), (None,)]


@pytest.mark.parametrize(
    ("name", "report", "params"),
    [
        ("q08_sales_detail", sales.sales_detail, {}), ("q09_shipped_detail", sales.shipped_detail, {}),
        ("q10_paid_detail", sales.paid_detail, {}), ("q16_po_lead_time", purchase.po_lead_time, {}),
        ("q18_listing_lines", listing.listing_lines, {"routed_shop": X.ROUTED_SHOP}),
    ],
)
def test_reports_with_every_lookup_salted(spark, name, report, params):
    from checks.compare import connect, difference
    from checks.oracle import ORACLE
    from checks.queries import _date_texts

    sf_dir = "/root/testdata/sf0.001"
    got = _date_texts(report(X.Inputs(spark, sf_dir), salt_rows=20, **params)).toPandas()
    assert difference(got, connect(sf_dir).execute(ORACLE[name]).df()) is None
