"""The registered queries: every operator, then every report."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T_

from checks import fixtures as X
from checks.fixtures import Inputs
from skuloom import constants as K
from skuloom.functions import dates as D
from skuloom.functions import numeric as N
from skuloom.functions import text as T
from skuloom.operators import aggregates as A
from skuloom.operators import blocks as B
from skuloom.operators import intervals as I
from skuloom.operators import joins as J
from skuloom.operators import projection as P
from skuloom.operators import reshape as R
from skuloom.operators import windows as W
from skuloom.sources import readers
from skuloom.sources.ordered_text import land
from skuloom.plans import ageing, catalog, listing, live, purchase, returns, sales, sellers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# two overlapping sessions on every day of the events
MONTH_SESSIONS = [
    D.Session(f"{day:%m-%d}{name}", day + dt.timedelta(hours=a), day + dt.timedelta(hours=b))
    for day in (dt.datetime(2024, 1, 1) + dt.timedelta(days=i) for i in range(30))
    for name, a, b in (("首场", 9, 15.5), ("晚场", 15, 24.4))
]
MONTH_HOURS = D.session_hours(MONTH_SESSIONS)
DAY_HOURS = [f"{h:02d}:00-{(h + 1) % 24:02d}:00" for h in range(24)]
MONTHS = [f"{m:02d}" for m in range(1, 13)]
SHOPS = [
    (("天猫", "京东", "微信", "唯品", "未知")[i % 5], f"NATION_{i}") for i in range(25)
]
LABELS = ["PROMO", "SMALL", "LARGE"]


def _date_texts(df: DataFrame) -> DataFrame:
    """Dates as text, which compares the same in every client."""
    dates = [c for c, kind in df.dtypes if kind == "date"]
    return df.withColumns({c: F.col(c).cast("string") for c in dates}) if dates else df


def operator(fn: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    """Register a query under the name of its function."""
    QUERIES[fn.__name__] = lambda spark, sf_dir: _date_texts(fn(Inputs(spark, sf_dir)))
    return fn


def map_text(cells: str, digits: int) -> Callable[[DataFrame], Column]:
    """A map as text, "key=value;key=value" by key; numbers, also those of a struct, with a fixed number of digits."""

    def shown(value: Column) -> Column:
        return F.coalesce(value.cast(f"decimal(28,{digits})").cast("string"), F.lit(""))

    def cell(entry: Column, fields: list[str]) -> Column:
        parts = [shown(entry["value"][f]) for f in fields] if fields else [shown(entry["value"])]
        return F.concat(entry["key"].cast("string"), F.lit("="), F.concat_ws("/", *parts))

    return lambda df: F.array_join(
        F.transform(
            F.array_sort(F.map_entries(cells)),
            lambda e: cell(e, getattr(df.schema[cells].dataType.valueType, "names", [])),
        ),
        ";",
    )


def report(name: str, fn: Callable[..., DataFrame], texts: dict[str, int] | None = None, **params) -> None:
    """Register a report; its map columns `texts` are shown as text, which compares the same in every client."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = fn(Inputs(spark, sf_dir), **params)
        return _date_texts(df.withColumns({c: map_text(c, digits)(df) for c, digits in (texts or {}).items()}))

    QUERIES[name] = run


def date_texts(x: Inputs) -> DataFrame:
    return x.spark.sql(X.DATE_TEXTS, orders=x.raw("orders"))


def both_purchases(x: Inputs) -> DataFrame:
    return P.union_all(x["purchase_history"], x["purchase_current"])


# --- sources, projections, filters


@operator
def s3_pruned_read(x):
    return x.raw("lineitem").select("l_partkey", "l_quantity")


@operator
def s1_first_of_export(x):
    """The first row per brand in the order of the file, through the reader and its schema."""
    schema = T_.StructType().add("p_brand", "string").add("p_partkey", "long").add("missing", "double").add("_ord", "long")
    df = readers.read_table(x.spark, f"{x.sf_dir}/part.parquet", schema)
    return W.keep_one(df, ["p_brand"], ["_ord"]).drop("_ord")


@operator
def s2_read_bundle(x):
    return readers.read_bundle(x.spark, x.sf_dir, "nation.parquet", columns=["n_nationkey", "n_name"])


@operator
def s5_discover(x):
    path = readers.discover(x.spark, x.sf_dir, "*item.parquet", exclude="bench")
    return readers.read_table(x.spark, path, columns=["l_orderkey", "l_linenumber"])


def _as_csv(x, df, **options):
    """The rows as CSV files in the shared folder, in their order."""
    path = f"{B.shared_folder(x.spark)}/csv-{uuid.uuid4().hex}"
    df.write.options(**{"header": True, "emptyValue": "", **options}).csv(path)
    return path


@operator
def s1_first_of_landed_csv(x):
    """The first line of every part in the order of CSV files, which are landed with the place of every row."""
    lines = x.raw("lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_quantity")
    path = _as_csv(x, lines.orderBy("l_orderkey", "l_linenumber", "l_quantity", "l_partkey"))
    schema = T_.StructType([lines.schema[c] for c in lines.columns]).add("_ord", "long")
    landed = land(x.spark, path, path.replace("/csv-", "/landed-"))
    rows = readers.read_table(x.spark, landed, schema)
    return W.keep_one(rows, ["l_partkey"], ["_ord"], rows=rows.count()).drop("_ord")


@operator
def s4_missing_tokens(x):
    """Only an empty cell of a CSV export is missing; NA and nan are texts."""
    marked = x.raw("part").selectExpr(
        "p_partkey", "p_name", "CASE p_type WHEN 'PROMO' THEN 'NA' WHEN 'LARGE' THEN '' WHEN 'SMALL' THEN 'nan' ELSE p_type END AS p_type"
    )
    return readers.read_table(x.spark, _as_csv(x, marked), columns=["p_partkey", "p_type"], fmt="csv")


@operator
def s6_promoted_header(x):
    """Column names from the second row of an export, below its title."""
    top = x.spark.createDataFrame([(0, "stock list", None, None), (1, " part ", "brand\u3000", "rest")], "n long, a string, b string, c string")
    rows = x.raw("part").selectExpr("p_partkey + 2", "CAST(p_partkey AS STRING)", "p_brand", "p_type")
    path = _as_csv(x, top.union(rows).orderBy("n").drop("n"), header=False, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return readers.promote_header(x.spark, path, row=1, first_columns=2).drop("_ord")


@operator
def s6_positional(x):
    return readers.positional(x.raw("supplier"), [1, 0], ["shop", "shop_id"])


@operator
def p1_conform(x):
    return P.conform(x.raw("part"), ["p_name", "missing", "p_partkey", "p_size"])


@operator
def p2_p3_rename_drop(x):
    df = x.raw("supplier").withColumnsRenamed({"s_name": "shop", "s_suppkey": "shop_id"})
    return P.drop_columns(df, "s_acctbal", positions=[2])


@operator
def p6_not_equal_null(x):
    return both_purchases(x).filter(P.differs("tags", K.REWORK_TAG)).groupBy("tags").agg(
        F.count(F.lit(1)).alias("n")
    )


@operator
def p8_in_list(x):
    return (
        both_purchases(x).filter(F.col("status").isin(*K.OPEN_STATUSES))
        .groupBy("status").agg(N.total("po_qty").alias("qty"))
    )


@operator
def p10_any_nonzero(x):
    df = P.fill(x.raw("lineitem"), ["l_discount", "l_tax"]).filter(
        P.any_nonzero(["l_discount", "l_tax"])
    )
    return df.groupBy("l_linestatus").agg(F.count(F.lit(1)).alias("n"))


@operator
def p11_threshold(x):
    return (
        x["merch_board"].filter((F.col("total_stock") >= 10) & (F.col("available") >= 1))
        .select("skc", "category", "total_stock", "available")
    )


@operator
def p12_trailing_window(x):
    lines = x["order_lines"].select("order_no", "paid_at", "sold_qty")
    return lines.filter(D.within_days("paid_at", X.AS_OF, 7))


@operator
def p13_fill(x):
    df = P.fill(x["sales_paid"].select("shipped_qty", "return_qty", "category"), ["shipped_qty", "return_qty"])
    return df.groupBy("shipped_qty", "return_qty").agg(F.count(F.lit(1)).alias("n"))


@operator
def p14_coalesce_chain(x):
    return x["merch_board"].select(
        "skc", "category",
        F.coalesce("last_order_date", "launch_date", "created_at").cast("date").alias("last_order"),
    )


@operator
def p15_conditional(x):
    cls = F.when(F.col("category") == K.BEAUTY, F.lit(K.BEAUTY)).otherwise(F.col("class"))
    return x["merch_board"].groupBy(cls.alias("class")).agg(F.count(F.lit(1)).alias("n"))


@operator
def p16_tags(x):
    return both_purchases(x).groupBy(T.tags("remark").alias("tag")).agg(
        F.count(F.lit(1)).alias("n")
    )


@operator
def p17_map_default(x):
    channel = T.map_values("site", K.SITE_CHANNELS, K.UNKNOWN_CHANNEL)
    return x["listings"].groupBy("site", channel.alias("channel")).agg(F.count(F.lit(1)).alias("n"))


@operator
def p18_null_tokens(x):
    tokens = F.when(F.col("l_returnflag") == "N", F.lit(" nan ")).otherwise(F.col("l_returnflag"))
    return x.raw("lineitem").groupBy(T.null_tokens(tokens).alias("flag")).agg(
        F.count(F.lit(1)).alias("n")
    )


# --- joins


@operator
def j1_lookup_fanout(x):
    lines = x["sales_paid"].select("category", "sold_qty")
    out = J.lookup(lines, x["category"], ["category"], ["plan_category"])
    return out.groupBy("category", "plan_category").agg(N.total("sold_qty").alias("sold_qty"))


@operator
def j1_lookup_split(x):
    """The shuffle form of the lookup, with frequent keys split from 20 rows on."""
    lines = x["sales_paid"].select(
        T.code("sku").alias("sku"), F.col("category"), F.col("sold_qty"), F.col("_ord")
    )
    side = catalog.sku_to_skc(x["catalog"]).withColumnRenamed("sku", "_key0")
    return J.split_join(lines, side, [("sku", "_key0")], split_rows=20).drop("_key0")


@operator
def j2_composite(x):
    lines = x["sales_paid"].select(
        F.col("date").alias("paid_at"), "style_code", T.color_of("color_spec").alias("color"), "sold_qty"
    ).withColumn("skc", T.join_key("style_code", "color"))
    daily = A.group_sum(lines, ["paid_at", "skc"], ["sold_qty"])
    stock = A.group_sum(x["stock_daily"], ["date", "skc"], {"opening_qty": "opening_stock"})
    return J.lookup(daily, stock, {"paid_at": "date", "skc": "skc"}, ["opening_stock"])


@operator
def j4_lookup_first(x):
    first = W.keep_one(x["category"], ["category"], ["_ord"])
    lines = x["po_lines"].select("po_no", "category", "po_qty", "_ord")
    return J.lookup(lines, first, ["category"], ["plan_category"])


@operator
def j5_self_status(x):
    lines = x["po_lines"].filter(F.col("status").isin(*K.OPEN_STATUSES)).select("po_no", "status", "po_qty")
    statuses = lines.select("po_no", "status").distinct()
    return J.lookup(lines, statuses, ["po_no"], {"status": "po_status"})


@operator
def j6_join_back(x):
    lines = x["po_lines"].select("po_no", "_ord", "po_qty")
    return J.lookup(lines, A.group_sum(lines, ["po_no"], {"po_qty": "all_qty"}), ["po_no"], ["all_qty"])


@operator
def j7_semi(x):
    missing = x["merch_board"].filter(F.col("image").isNull())
    products = x["catalog"].withColumn("skc", T.join_key("style_code", "color"))
    return J.keep_matching(products, missing, {"skc": "skc"}).select("skc", "sku")


@operator
def j8_range_last_wins(x):
    return x["live_sales"].select(
        "paid_at", "style_code", "sold_qty", D.session_label("paid_at", MONTH_SESSIONS).alias("session")
    )


@operator
def j8_spans_table(x):
    """Spans from a table: short ones, some over midnight, some of days, many that overlap, some that end before they start."""
    lines = x["live_sales"].select("paid_at", "style_code", "sold_qty")
    return I.span_join(lines, "paid_at", x["sessions"], {"label": "session", "start": "since"})


@operator
def j8_spans_by_key(x):
    """The same per key, spans in buckets of ten minutes and of a day."""
    lines = x["live_sales"].select("paid_at", F.length("style_code").alias("k"), "sold_qty")
    spans = x["sessions"].withColumn("digits", (F.length("label") - 1).cast("int"))
    return I.span_join(lines, "paid_at", spans, {"label": "session"}, on={"k": "digits"}, widths=(600, 86_400))


@operator
def j9_routed_union(x):
    routed = J.chained_lookup(
        x["listings"].filter(F.col("shop") == X.ROUTED_SHOP).drop("system_sku"),
        x["catalog"], {"online_style": "national_code"}, {"sku": "system_sku"},
        x["catalog"], {"system_sku": "sku"}, ["color"],
    )
    others = x["listings"].filter(P.differs("shop", X.ROUTED_SHOP))
    others = J.lookup(others, x["catalog"], {"system_sku": "sku"}, ["color"])
    return P.union_all(routed.select("shop", "system_sku", "color"), others.select("shop", "system_sku", "color"))


# --- aggregations


@operator
def a1_group_sum(x):
    lines = J.lookup(x["sales_paid"], x["category"], ["category"], ["plan_category"])
    return A.group_sum(lines, ["date", "plan_category"], ["sold_qty", "shipped_qty", "return_qty", "sold_amt"])


@operator
def a1_fine_sums(x):
    """Values with many decimals."""
    fine = F.col("l_quantity") * F.col("l_tax") / 7000
    return A.group_sum(x.raw("lineitem").withColumn("fine", fine), ["l_suppkey"], ["fine"], any_size=True)


@operator
def a1_extreme_sums(x):
    """Doubles from 10^-300 to 10^300 that partly cancel out, one measure beside another that is ordinary."""
    lines = x.raw("lineitem").withColumn("extreme", X.EXTREME(F.col))
    return A.group_sum(lines, ["l_suppkey"], {"extreme": "extreme", "l_quantity": "qty"}, any_size=True)


@operator
def w1_running_extreme(x):
    """Running sums of very large numbers, each key's scaled by its own."""
    daily = A.group_sum(x.raw("lineitem").withColumn("large", F.col("l_quantity") * 1e25), ["l_suppkey", "l_shipdate"], ["large"], any_size=True)
    return W.running_sum(daily, ["l_suppkey"], ["l_shipdate"], {"large": "cum_large"}, any_size=True)


@operator
def a1_large_sums(x):
    """Values near 10^15, some with decimals, of both signs."""
    large = F.when(F.col("l_returnflag") == "R", -F.col("l_extendedprice") * 1e10).otherwise(F.col("l_extendedprice") * 1e10)
    return x.raw("lineitem").groupBy("l_linenumber").agg(N.total(large).alias("large"), N.total(large + F.col("l_tax")).alias("mixed"))


@operator
def a2_count_and_sum(x):
    return x["merch_board"].groupBy("class").agg(
        F.count("last_order_date").alias("n"), N.total("total_stock").alias("stock")
    )


@operator
def a4_min_date(x):
    return x["sales_paid"].groupBy("style_code").agg(F.min(D.day_of("date")).alias("first_day"))


@operator
def a5_max_flag(x):
    return x["listings"].groupBy("shop", "online_style").agg(F.max("is_listed").alias("is_listed"))


@operator
def a6_first_nonnull(x):
    return A.first_nonnull(x["po_lines"], ["po_no"], "completed_at", ["_ord"])


@operator
def a8_subtotals(x):
    base = A.group_sum(x["sales_paid"], ["category", "style_code"], ["sold_qty"])
    return A.with_subtotals(base, "category", "style_code", ["sold_qty"], K.CLASS_TOTAL)


@operator
def a9_dense_grid(x):
    detail = ageing.ageing_detail(x, X.AGEING_AS_OF)
    return A.dense_grid(detail, "class", "age", K.AGE_LABELS, ageing.MEASURES)


@operator
def a10_weighted_mean(x):
    return purchase.receipt_days(x)


@operator
def a11_first_hot_day(x):
    lines = x["sales_paid"].select(
        T.join_key("style_code", T.color_of("color_spec")).alias("skc"),
        D.day_of("date").alias("date"), "sold_qty",
    )
    daily = A.group_sum(lines, ["skc", "date"], ["sold_qty"])
    return A.first_day_above(daily, "skc", "date", "sold_qty", 10, "first_day")


@operator
def a12_ratios(x):
    sums = A.group_sum(
        x["sales_paid"], ["style_code", "date"],
        ["sold_amt", "return_amt", "sold_qty", "shipped_qty", "returned_qty"],
    )
    return sums.select(
        "style_code", "date",
        N.round_even(1.0 - N.ratio("return_amt", "sold_amt"), 4).alias("kept"),
        N.ratio("returned_qty", "shipped_qty", 2).alias("returned"),
        N.ratio("sold_amt", "sold_qty", 0).alias("unit_price"),
    )


@operator
def a13_distinct(x):
    return both_purchases(x).select("style_code", "status").distinct()


# --- reshape


@operator
def r1_hour_pivot(x):
    lines = x["live_sales"].withColumn("hour", F.substr(D.hour_label("paid_at"), F.lit(7)))
    return R.spread_sum(lines, ["style_code"], "hour", DAY_HOURS, "sold_qty", "total")


@operator
def r2_flag_pivot(x):
    lines = x["listings"].withColumn(
        "channel", T.map_values("site", K.SITE_CHANNELS, K.UNKNOWN_CHANNEL)
    )
    return R.spread_flag(lines, ["system_style"], ["channel", "shop"], SHOPS, "is_listed", K.YES)


@operator
def r3_delay_spread(x):
    lines = returns.refund_lines(x).select("skc", "delay", "return_qty", "sold_qty")
    sums = A.group_sum(lines, ["skc", "delay"], ["return_qty", "sold_qty"])
    cells = R.spread_metrics_map(sums, ["skc"], "delay", ["return_qty", "sold_qty"], "cells")
    return cells.withColumn("cells", map_text("cells", 2)(cells))


@operator
def r4_metric_rows(x):
    sums = A.group_sum(
        x["sales_paid"].withColumn("month", F.substr(D.day_text("date"), F.lit(6), F.lit(2))),
        ["style_code", "category", "month"], ["sold_qty", "return_qty"],
    ).withColumn("rate", N.ratio("return_qty", "sold_qty", 2))
    return R.metrics_to_rows(
        sums, ["style_code", "category"], ["sold_qty", "rate"], "month", MONTHS
    )


# --- windows, ranking, sets


@operator
def w1_running_sum(x):
    daily = A.group_sum(
        x["sales_paid"].withColumn("skc", T.join_key("style_code", T.color_of("color_spec"))),
        ["skc", "date", "category"], ["sold_qty", "return_qty"],
    )
    return W.running_sum(
        daily, ["skc"], ["date", "category"], {"sold_qty": "cum_sold", "return_qty": "cum_return"}
    )


@operator
def w2_running_delay(x):
    lines = returns.refund_lines(x).filter(F.col("claim_type") == K.REFUND_ONLY)
    daily = A.group_sum(lines, ["paid_date", "skc", "delay"], ["return_qty"])
    return W.running_sum(daily, ["paid_date", "skc"], ["delay"], {"return_qty": "cum_refund"})


@operator
def w1_prefix_sums(x):
    """Running sums over all rows of three keys, in blocks of a few thousand rows."""
    lines = x.raw("lineitem").select("l_returnflag", "l_shipdate", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    measures = {"l_quantity": "cum_qty", "l_extendedprice": "cum_amt"}
    return B.prefix_sums(lines, ["l_returnflag"], ["l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity"], measures, block_rows=5_000)


@operator
def w3_row_positions(x):
    """The position of every line by price, without a window over all rows."""
    lines = x.raw("lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return B.row_positions(lines, [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber")], block_rows=5_000)


@operator
def w4_keep_one(x):
    first = W.keep_one(x["catalog"], ["style_code", "color"], ["_ord"])
    return first.select("style_code", "color", "sku", "category")


@operator
def w4_keep_last(x):
    lines = both_purchases(x).select("style_code", "po_date", "supplier").distinct()
    return W.keep_one(lines, ["style_code"], [F.asc("po_date"), F.desc("supplier")])


@operator
def w5_group_fill(x):
    lines = x["po_lines"].select("po_no", "_ord", "completed_at")
    first = A.first_nonnull(lines, ["po_no"], "completed_at", ["_ord"], "_first")
    return J.lookup(lines, first, ["po_no"], ["_first"]).select(
        "po_no", "_ord", F.coalesce("_first", "completed_at").alias("completed_at")
    )


@operator
def w6_share(x):
    sums = A.group_sum(x["sales_paid"], ["style_code"], ["sold_amt", "sold_qty"])
    amount = sums.agg(N.total("sold_amt")).scalar()
    return sums.withColumn("share", N.ratio(F.col("sold_amt"), amount, 4))


@operator
def w7_top_flag(x):
    lines = x["merch_board"].select("skc", "category", "avg3d_sales")
    lines = lines.withColumn("row_key", T.text_key("skc", "category"))
    order = [F.desc("avg3d_sales"), F.asc("row_key")]
    return W.flag_top(lines, 200, order, "row_key", "top200", K.YES, K.NO)


@operator
def o1_mixed_sort(x):
    return both_purchases(x).groupBy("style_code", "po_date").agg(
        N.total("po_qty").alias("po_qty")
    ).orderBy(F.asc("style_code"), F.desc("po_date"))


@operator
def o3_top_k(x):
    sums = A.group_sum(
        x["sales_paid"].withColumn("skc", T.join_key("style_code", T.color_of("color_spec"))),
        ["skc"], ["sold_amt", "sold_qty"],
    )
    return W.top_k(sums, 36, [F.desc("sold_amt"), F.asc("skc")], "rank")


@operator
def o4_label_order(x):
    return x["sales_paid"].groupBy("category").agg(N.total("sold_qty").alias("sold_qty")).withColumn(
        "position", W.label_rank("category", LABELS)
    ).orderBy("position", "category")


@operator
def u1_union(x):
    both = P.union_all(
        x["purchase_history"].select("style_code", "po_qty"),
        x["purchase_current"].select("style_code", "supplier", "po_qty"),
    )
    return both.groupBy("style_code", "supplier").agg(N.total("po_qty").alias("po_qty"))


@operator
def u3_union_distinct(x):
    return P.distinct_where(
        x["sales_paid"].select("style_code", "shop", "sold_qty"),
        F.col("sold_qty") >= 45, F.col("style_code") == "Brand#2",
    )


# --- scalar functions


@operator
def f2_codes(x):
    return x["sales_paid"].groupBy(T.code("sku").alias("sku"), T.strip("sku").alias("stripped")).agg(
        F.count(F.lit(1)).alias("n")
    )


@operator
def f3_strip_brackets(x):
    return x["stock"].select("sku", "spec", T.strip_brackets("spec").alias("clean"))


@operator
def f4_split(x):
    return x["po_lines"].groupBy(
        T.head_of("color_spec").alias("color"), F.coalesce(T.tail_of("color_spec"), F.lit("")).alias("spec")
    ).agg(F.count(F.lit(1)).alias("n"))


@operator
def f5_color_spec(x):
    return x["sales_paid"].groupBy(
        T.color_of("color_spec").alias("color"), T.spec_of("color_spec").alias("spec")
    ).agg(F.count(F.lit(1)).alias("n"))


@operator
def f6_bracket_title(x):
    return x["order_lines"].groupBy(
        "online_title", T.bracket_title("online_title").alias("short_title")
    ).agg(F.count(F.lit(1)).alias("n"))


@operator
def f8_unescape(x):
    return x["catalog"].select("sku", T.unescape_plus("color").alias("color"))


@operator
def f9_id_canon(x):
    return x["order_lines"].groupBy(T.id_head("streamer_id").alias("streamer")).agg(
        F.count(F.lit(1)).alias("n")
    )


@operator
def f11_to_number(x):
    return P.union_all(x["sales_history"], x["sales_current"]).groupBy("style_code").agg(
        N.total(N.to_number("sold_qty")).alias("sold"), F.count(N.to_number("sold_qty")).alias("n")
    )


@operator
def f12_parse_ts(x):
    return date_texts(x).groupBy("form", D.parse_ts("text").cast("string").alias("at")).agg(F.count(F.lit(1)).alias("n"))


@operator
def f14_hour_label(x):
    return x["live_sales"].groupBy(D.hour_label("paid_at").alias("hour")).agg(
        F.count(F.lit(1)).alias("n")
    )


@operator
def f15_elapsed_days(x):
    days = D.elapsed_days("po_date", "received_at")
    return x["receipts"].select(
        "po_no", "sku", N.round_even(days, 2).alias("days"), F.ceil(days).cast("int").alias("whole_days")
    )


@operator
def f16_age_bins(x):
    days = F.datediff(F.lit(X.AGEING_AS_OF), D.day_of("date"))
    return x["sales_paid"].groupBy(D.age_bin(days).alias("age")).agg(
        F.count(F.lit(1)).alias("n"), F.min(days).alias("least"), F.max(days).alias("most")
    )


@operator
def f18_round_even(x):
    return x.raw("part").select(
        "p_partkey",
        N.round_even(F.col("p_size") / 8, 2).alias("a"),
        N.round_even(F.col("p_retailprice") / 8, 2).alias("b"),
        N.round_even(F.col("p_size") / 2, 0).alias("c"),
    )


# --- reports

report("q01_active_skc", catalog.active_skc, excluded_styles=[X.EXCLUDED_STYLE])
report("q02_catalog_clean", catalog.catalog_clean)
report("q03_stock_by_sku", catalog.stock_by_sku)
report("q04_purchase_history", purchase.purchase_history)
report("q05_received_with_tags", purchase.received_with_tags)
report("q06_first_purchase", purchase.first_purchase)
report("q07_today_sales", sales.today_sales)
report("q08_sales_detail", sales.sales_detail)
report("q09_shipped_daily", lambda x: sales.shipped_daily(x, rows=x.raw("lineitem").count()))
report("q09_shipped_detail", sales.shipped_detail)
report("q10_paid_detail", sales.paid_detail)
report("q10_paid_summary", sales.paid_summary)
report("q10_first_hot_day", lambda x: sales.first_hot_day(x, rows=x.raw("lineitem").count()))
report("q11_all_time_sales", sales.all_time_sales)
report("q12_titles", sellers.title_table)
report("q12_top20", sellers.top_styles, as_of=X.AS_OF, days=1, k=20)
report("q12_top30", sellers.top_styles, as_of=X.AS_OF, days=7, k=30)
report("q12_top36", sellers.top_shares, as_of=X.AS_OF, k=36)
report("q12_top12_shares", sellers.top_shares, as_of=X.AS_OF, k=12)
report("q13_return_rates", returns.return_rates)
report("q13_return_rate_matrix", returns.return_rate_maps, texts={"rates": 2})
REFUND_DELAYS = range(-5, 26)
RATE_DATES = [dt.date(1996, 1, 1) + dt.timedelta(days=i) for i in range(60)]
report("q13_return_rate_columns", returns.return_rate_matrix, dates=RATE_DATES)
report("q14_live_lines", live.live_lines, streamer_id=X.LIVE_STREAMER, sessions=MONTH_SESSIONS)
QUERIES["q14_live_lines_spans"] = lambda spark, sf_dir: _date_texts(
    live.live_lines(x := Inputs(spark, sf_dir), X.LIVE_STREAMER, x["sessions"])
)
report(
    "q14_live_board", live.live_board,
    streamer_id=X.LIVE_STREAMER, sessions=MONTH_SESSIONS, hours=MONTH_HOURS,
)
report("q15_refund_curve", returns.refund_curve, excluded_streamer=X.STREAMER + ".0")
report(
    "q15_refund_curve_wide", returns.refund_curve_maps, texts={"curve": 4},
    excluded_streamer=X.STREAMER + ".0",
)
report(
    "q15_refund_curve_columns", returns.refund_curve_wide,
    delays=REFUND_DELAYS, excluded_streamer=X.STREAMER + ".0",
)


def q13_return_rate_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rates of all dates as blocks of 100 columns, put together again."""
    rates = returns.return_rates(Inputs(spark, sf_dir))
    keys = ["skc", "plan_category"]
    blocks, columns = R.column_blocks(rates, keys, "date", returns.RETURN_METRICS, width=100)
    return R.from_blocks(blocks, columns, keys, "date")


QUERIES["q13_return_rate_blocks"] = q13_return_rate_blocks
report("q16_po_lead_time", purchase.po_lead_time)
report("q17_stock_ageing", ageing.stock_ageing, as_of=X.AGEING_AS_OF)
report("q17_ageing_detail", ageing.ageing_detail, as_of=X.AGEING_AS_OF)
report("q18_listing_lines", listing.listing_lines, routed_shop=X.ROUTED_SHOP)
report("q18_listing_matrix", listing.listing_matrix, routed_shop=X.ROUTED_SHOP, shops=SHOPS)
report("q18_listing_maps", listing.listing_maps, texts={"listed": 0}, routed_shop=X.ROUTED_SHOP)
report("q18_priority_skc", listing.priority_skc)
report("q18_stock_export", catalog.stock_export)
report("q18_image_worklist", catalog.image_worklist)
