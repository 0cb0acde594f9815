"""Null, text, rounding and join rules, with pandas as the second opinion."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from skuloom import constants as K
from skuloom.functions import dates as D
from skuloom.functions import numeric as N
from skuloom.functions import text as T
from skuloom.operators import aggregates as A
from skuloom.operators import joins as J
from skuloom.operators import projection as P
from skuloom.operators import reshape as R
from skuloom.operators import windows as W


def values(df, column="v"):
    return [r[column] for r in df.collect()]


def texts(spark, items):
    return spark.createDataFrame([(i, x) for i, x in enumerate(items)], "i int, c string").coalesce(1)


def test_not_equal_is_true_for_null(spark):
    df = texts(spark, ["a", "b", None]).filter(P.differs("c", "a"))
    want = pd.Series(["a", "b", None])
    assert values(df, "c") == want[want != "a"].tolist()


def test_lookup_null_matches_null_and_repeats(spark, rows):
    left = spark.createDataFrame([("x",), (None,), ("z",)], "k string")
    dim = spark.createDataFrame([("x", 1), ("x", 2), (None, 3)], "k string, v int")
    got = rows(J.lookup(left, dim, ["k"], ["v"]))
    want = left.toPandas().merge(dim.toPandas(), on="k", how="left")
    assert len(got) == len(want) == 4
    assert got == [("x", 1), ("x", 2), ("z", None), (None, 3)]


def test_lookup_rejects_a_name_that_is_taken(spark):
    df = spark.createDataFrame([("x", 1)], "k string, v int")
    with pytest.raises(ValueError, match="already there"):
        J.lookup(df, df, ["k"], ["v"])


def test_group_sum_drops_null_keys_and_sums_nothing_to_zero(spark, rows):
    df = spark.createDataFrame([("a", None), ("a", None), (None, 1.0), ("b", 2.5)], "k string, v double")
    assert rows(A.group_sum(df, ["k"], ["v"])) == [("a", 0.0), ("b", 2.5)]
    pdf = df.toPandas()
    assert pd.pivot_table(pdf, index="k", values="v", aggfunc="sum")["v"].to_dict() == {"a": 0.0, "b": 2.5}


def test_sum_ignores_not_a_number(spark):
    df = spark.createDataFrame([("a", float("nan")), ("a", 1.25)], "k string, v double")
    assert values(A.group_sum(df, ["k"], ["v"])) == [1.25]


def test_concat_is_null_with_a_null_part(spark):
    df = spark.createDataFrame([("a", None), ("a", "b")], "x string, y string")
    assert values(df.select(T.join_key("x", "y").alias("v"))) == [None, "ab"]


def test_text_key_writes_nan(spark):
    df = spark.createDataFrame([(None, "b"), ("a", None)], "x string, y string")
    assert values(df.select(T.text_key("x", "y").alias("v"))) == ["nanb", "anan"]


def test_round_half_even_on_the_scaled_double(spark):
    xs = [0.575, 0.125, 0.135, 2.675, -0.125, 1.005, 0.5, 1.5, 2.5, 1e-9, None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double").coalesce(1)
    for digits in (0, 2, 4):
        got = values(df.select(N.round_even("x", digits).alias("v")))
        want = pd.Series(xs, dtype=float).round(digits)
        assert [None if np.isnan(w) else w for w in want] == got


def test_ratio_by_zero_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (1.0, 8.0)], "a double, b double")
    assert values(df.select(N.ratio("a", "b", 2).alias("v"))) == [None, None, 0.12]


def test_running_sum_matches_cumsum(spark):
    data = [("a", 1, 1.5), ("a", 2, 2.25), ("b", 1, 4.0), ("a", 3, 0.0)]
    df = spark.createDataFrame(data, "k string, d int, v double")
    got = W.running_sum(df, ["k"], ["d"], {"v": "c"}).orderBy("k", "d").toPandas()
    want = df.toPandas().sort_values(["k", "d"])
    assert got["c"].tolist() == want.groupby("k")["v"].cumsum().tolist()


COLOR_SPECS = ["红;M", "红", "红;M;L", ";M", "红;", "", "a\nb;c", "a;b\nc", "a;b\n", "a\n;b;c", "a;b\r", None]


def test_color_and_spec_match_the_pattern(spark):
    df = texts(spark, COLOR_SPECS)
    got = df.select("i", T.color_of("c").alias("color"), T.spec_of("c").alias("spec")).orderBy("i").collect()
    source = pd.Series(COLOR_SPECS, dtype=object)
    # Java's flag for plain line ends is Python's default
    groups = source.str.extract(K.COLOR_SPEC_PATTERN.removeprefix("(?d)"))
    color = groups[0].where(groups[0].notna(), source)
    for r, c, s in zip(got, color, groups[1]):
        assert r["color"] == (None if pd.isna(c) else c)
        assert r["spec"] == (None if pd.isna(s) else s)


def test_head_and_tail_split_once(spark):
    items = ["a;b;c", "a", None, ";b", "a;"]
    got = texts(spark, items).select(T.head_of("c").alias("h"), T.tail_of("c").alias("t")).collect()
    want = pd.Series(items, dtype=object).str.split(";", n=1, expand=True)
    assert [(r["h"], r["t"]) for r in got] == [
        tuple(None if pd.isna(x) else x for x in pair) for pair in want.to_numpy()
    ]


def test_strip_removes_every_white_space(spark):
    items = ["　a b\t", " x ", "\x1cq\x1f", "plain", "  ", None]
    got = values(texts(spark, items).select(T.strip("c").alias("v")))
    assert got == [None if x is None else x.strip() for x in items]


def test_codes_are_upper_cased(spark):
    assert values(texts(spark, [" ab1　"]).select(T.code("c").alias("v"))) == ["AB1"]


def test_brackets_are_removed_in_turn(spark):
    items = ["M (165/88A)", "L【长】", "XL（均码）", "S (165）", "M(1)(2)", "均码", "A　(x)", None]
    want = pd.Series(items, dtype=object)
    for p in K.BRACKET_PATTERNS:
        want = want.str.replace(p, "", regex=True)
    got = values(texts(spark, items).select(T.strip_brackets("c").alias("v")))
    assert got == [None if pd.isna(x) else x for x in want]


def test_title_is_the_first_bracket_group(spark):
    items = ["【短】长【二】", "没有", "【】x", "【】【有】", None]
    found = pd.Series(items, dtype=object).str.extract(K.TITLE_PATTERN, expand=False)
    got = values(texts(spark, items).select(T.bracket_title("c").alias("v")))
    assert got == [i if pd.isna(f) else f for f, i in zip(found, items)]


def test_tags_concatenate(spark):
    items = ["小晶", "唯品x", "唯品小晶", "无", None]
    assert values(texts(spark, items).select(T.tags("c").alias("v"))) == ["小晶", "唯专", "小晶唯专", "", ""]


def test_ids_lose_the_float_tail(spark):
    items = ["123.0", " 123 ", "abc", "1.2.3", None]
    assert values(texts(spark, items).select(T.id_head("c").alias("v"))) == ["123", "123", "abc", "1", None]


def test_numbers_of_text(spark):
    items = ["12", " 1.5 ", "1e3", "12d", "1.5F", "x", "", None]
    want = pd.to_numeric(pd.Series(items, dtype=object), errors="coerce")
    got = values(texts(spark, items).select(N.to_number("c").alias("v")))
    assert got == [None if pd.isna(x) else x for x in want]


def test_unescape_and_tokens_and_mapping(spark):
    assert values(texts(spark, ["a_x002B_b"]).select(T.unescape_plus("c").alias("v"))) == ["a+b"]
    got = values(texts(spark, [" nan", "NaN", "None", "", "x", None]).select(T.null_tokens("c").alias("v")))
    assert got == [None, None, None, None, "x", None]
    got = values(texts(spark, ["Jos", "?", None]).select(T.map_values("c", {"Jos": "京东"}, "未知").alias("v")))
    assert got == ["京东", "未知", "未知"]


def test_strict_dates_raise_and_lenient_dates_null(spark):
    df = texts(spark, ["2024-01-02 03:04:05", "2024/13/45"])
    assert values(df.select(D.parse_ts("c").alias("v"))) == [dt.datetime(2024, 1, 2, 3, 4, 5), None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.select(D.parse_ts("c", strict=True)).collect()


def test_nulls_sort_last(spark):
    df = spark.createDataFrame([(3,), (None,), (1,)], "v int")
    assert values(df.orderBy(F.desc("v"))) == [3, 1, None]
    assert values(df.orderBy(F.asc_nulls_last("v"))) == [1, 3, None]


def test_age_bins_are_right_closed(spark):
    days = [-40, -31, -30, 0, 182, 183, 365, 366, 548, 731, None]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "i int, d int").coalesce(1)
    labels = ["0-6个月", "7-12个月", "13-18个月", "19-24个月", "24个月以上"]
    want = pd.cut(pd.Series(days, dtype=float) / 30.44, [-1, 6, 12, 18, 24, np.inf], labels=labels)
    assert values(df.select(D.age_bin("d").alias("v"))) == [None if pd.isna(x) else x for x in want]


def test_elapsed_days(spark):
    a, b = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2, 0, 0, 0, 1)
    df = spark.createDataFrame([(a, b), (b, a), (a, None)], "a timestamp_ntz, b timestamp_ntz")
    ceil = values(df.select(F.ceil(D.elapsed_days("a", "b")).alias("v")))
    assert ceil == [2, -1, None]


def test_hour_label_and_midnight(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 6, 23, 59),)], "t timestamp_ntz")
    assert values(df.select(D.hour_label("t").alias("v"))) == ["01.06 23:00-00:00"]


def test_last_session_wins_and_ends_count(spark):
    at = [dt.datetime(2024, 1, 1, h, m) for h, m in ((9, 0), (10, 0), (10, 30), (11, 0), (11, 1))]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(at)], "i int, t timestamp_ntz").coalesce(1)
    sessions = [
        D.Session("a", dt.datetime(2024, 1, 1, 9), dt.datetime(2024, 1, 1, 10, 30)),
        D.Session("b", dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 11)),
    ]
    assert values(df.select(D.session_label("t", sessions).alias("v"))) == ["a", "b", "b", "b", None]
    assert D.session_hours(sessions) == ["01.01 09:00-10:00", "01.01 10:00-11:00", "01.01 11:00-12:00"]
    assert values(df.select(D.session_label("t", []).alias("v"))) == [None] * 5


def test_trailing_days_end_yesterday(spark):
    at = [dt.datetime(2024, 1, d, h) for d, h in ((2, 23), (3, 0), (9, 23), (10, 0))]
    df = spark.createDataFrame([(t,) for t in at], "t timestamp_ntz")
    got = values(df.filter(D.within_days("t", dt.date(2024, 1, 10), 7)), "t")
    assert sorted(got) == at[1:3]


def test_keep_one_takes_null_as_a_key(spark, rows):
    data = [("a", 2), ("a", 1), (None, 5), (None, 4)]
    df = spark.createDataFrame(data, "k string, o int")
    assert rows(W.keep_one(df, ["k"], ["o"])) == [("a", 1), (None, 4)]


def test_dense_grid_matches_a_categorical_pivot(spark):
    data = [("A", "x", "s1", 1.0), ("A", "x", None, 2.0), ("B", None, "s3", 5.0), (None, "y", "s4", 7.0)]
    df = spark.createDataFrame(data, "k string, bin string, skc string, v double")
    got = A.dense_grid(df, "k", "bin", ["x", "y"], {"n": ("count", "skc"), "v": ("sum", "v")})
    pdf = df.toPandas()
    pdf["bin"] = pd.Categorical(pdf["bin"], ["x", "y"], ordered=True)
    want = pd.pivot_table(
        pdf, index=["k", "bin"], values=["skc", "v"], aggfunc={"skc": "count", "v": "sum"}, observed=False
    ).reset_index()
    assert sorted(map(tuple, got.select("k", "bin", "n", "v").collect())) == sorted(
        want[["k", "bin", "skc", "v"]].itertuples(index=False, name=None)
    )


def test_subtotals(spark, rows):
    df = spark.createDataFrame([("A", "x", 1.0), ("A", "y", 2.0), ("B", "x", 4.0)], "k string, p string, v double")
    assert rows(A.with_subtotals(df, "k", "p", ["v"], "T")) == [
        ("A", "T", 3.0), ("A", "x", 1.0), ("A", "y", 2.0), ("B", "T", 4.0), ("B", "x", 4.0),
    ]


def test_conform_adds_missing_and_prunes(spark):
    df = spark.createDataFrame([(1, "x", "y")], "a int, b string, c string")
    out = P.conform(df, ["c", "new", "a"])
    assert out.columns == ["c", "new", "a"] and out.first() == ("y", None, 1)
    assert P.drop_columns(df, "c", positions=[1]).columns == ["a"]


def test_union_by_name_fills_missing(spark, rows):
    a = spark.createDataFrame([("x", 1)], "k string, v int")
    b = spark.createDataFrame([("z",)], "k string")
    assert rows(P.union_all(a, b)) == [("x", 1), ("z", None)]


def test_distinct_where_ignores_the_position(spark, rows):
    df = spark.createDataFrame([("a", 5, 3), ("a", 5, 1), ("b", 1, 2)], "k string, v int, _ord int")
    got = rows(P.distinct_where(df, F.col("v") > 4, F.col("k") == "a", order="_ord"))
    assert got == [("a", 5, 1)]


def test_spread_sum_and_total(spark):
    df = spark.createDataFrame([("a", "h1", 1.5), ("a", "h1", 1.0), ("b", "h2", 2.0), ("b", None, 9.0)],
                               "k string, h string, v double")
    got = R.spread_sum(df, ["k"], "h", ["h1", "h2"], "v", "t").orderBy("k").collect()
    assert [tuple(r) for r in got] == [("a", 2.5, 2.5, 0.0), ("b", 2.0, 0.0, 2.0)]


def test_all_null_metric_rows_vanish(spark, rows):
    df = spark.createDataFrame([("a", "d1", 1.0, None), ("a", "d2", 2.0, None)],
                               "k string, d string, m double, n double")
    assert rows(R.metrics_to_rows(df, ["k"], ["m", "n"], "d", ["d1", "d2"])) == [("a", "m", 1.0, 2.0)]


def test_map_forms_need_no_list(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("a", -3, 0.5), ("a", 1, 1.0), ("b", None, 9.0)], "k string, d int, v double")
    got = R.spread_sum_map(df, ["k"], "d", "v", "total", "cells").collect()
    assert [tuple(r) for r in got] == [("a", 3.5, {-3: 0.5, 1: 3.0})]
    many = spark.range(3000).select(F.lit("a").alias("k"), F.col("id").alias("d"), (F.col("id") * 2).alias("v"))
    cells = R.spread_metrics_map(many, ["k"], "d", ["v"], "cells").first()["cells"]
    assert len(cells) == 3000 and cells[2999]["v"] == 5998


def test_labels_that_join_alike_stay_apart(spark):
    df = spark.createDataFrame([("x", "a_b", "c", 1), ("x", "a", "b_c", 0)], "k string, p string, q string, f int")
    got = R.spread_flag(df, ["k"], ["p", "q"], [("a_b", "c"), ("a", "b_c")], "f", "是")
    assert got.columns == ["k", "a__b_c", "a_b__c"] and tuple(got.first()) == ("x", "是", "")


@pytest.mark.parametrize("data", [
    [0.00004] * 10, [1e14] * 10, [1e15 + 0.5, -1e15, 0.25], [0.1] * 10, [1e24, 1.0, -1e24], [2.0**-60] * 3, [-0.3, 0.3], [0.01, -0.01, 0.01], [-0.01, -7e9 - 0.3, 5.5],
    [float("inf"), 1.0, float("nan"), None],
])
def test_sums_are_exact_in_any_order(spark, data):
    from fractions import Fraction

    want = float(sum(Fraction(x) for x in data if x is not None and abs(x) < 1e300))
    for order in (data, data[::-1]):
        df = spark.createDataFrame([(x,) for x in order], "v double").repartition(3)
        got = df.agg(N.total("v")).first()[0]
        assert got == pytest.approx(want, rel=2e-16, abs=2.0**-66)


def test_texts_of_numbers_and_dates(spark):
    df = texts(spark, ["12", "nan", "inf", "-Infinity", "12d", " 3.5 ", "", None])
    assert values(df.select(N.to_number("c").alias("v"))) == [12.0, None, None, None, None, 3.5, None, None]
    df = texts(spark, ["90000000000000567", "12.0", "nan", "x", "1e3", None, "inf"])
    assert values(df.select(N.to_whole("c").alias("v"))) == [90000000000000567, 12, None, None, 1000, None, None]
    df = texts(spark, ["2024-01-02", "2024/1/2 8:30", "20240102", "20240102 08:30:00", "待定", None])
    got = values(df.select(D.parse_ts("c").cast("string").alias("v")))
    day, time = "2024-01-02 00:00:00", "2024-01-02 08:30:00"
    assert got == [day, time, day, time, None, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.select(D.parse_ts("c", strict=True)).collect()


def test_top_k_and_flag(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3), ("c", 3), ("d", None)], "k string, v int")
    order = [F.desc("v"), F.asc("k")]
    assert [tuple(r) for r in W.top_k(df, 3, order, "r").orderBy("r").collect()] == [
        ("b", 3, 1), ("c", 3, 2), ("a", 1, 3),
    ]
    flagged = W.flag_top(df, 2, order, "k", "top", "是", "否").orderBy("k").collect()
    assert [r["top"] for r in flagged] == ["否", "是", "是", "否"]


def test_label_rank_puts_unknown_last(spark):
    df = texts(spark, ["z", "鞋子", "服装", None])
    assert values(df.select(W.label_rank("c", ["服装", "鞋子"]).alias("v"))) == [3, 2, 1, 3]


def test_weighted_mean_rounds_in_stages(spark):
    df = spark.createDataFrame([("a", 1.11, 3.0), ("a", 2.225, 1.0), ("a", None, 2.0), ("b", 1.0, 0.0)],
                               "k string, d double, q double")
    got = {r["k"]: (r["q_all"], r["m"]) for r in A.weighted_mean(df, ["k"], "d", "q", "m", "q_all").collect()}
    pdf = df.toPandas()
    pdf["p"] = (pdf["q"] * pdf["d"]).round(2)
    want = pdf.groupby("k").agg(p=("p", "sum"), q=("q", "sum"))
    assert got["a"] == (6.0, round(round(want["p"]["a"], 2) / want["q"]["a"], 2))
    assert got["b"] == (0.0, None)


def test_first_nonnull(spark, rows):
    df = spark.createDataFrame([("a", None, 1), ("a", "x", 3), ("a", "y", 2), ("b", None, 1)],
                               "k string, v string, _ord int")
    assert rows(A.first_nonnull(df, ["k"], "v", ["_ord"])) == [("a", "y")]


def test_many_sessions_and_many_hours(spark):
    start = dt.datetime(2024, 1, 1)
    hour = dt.timedelta(hours=1)
    sessions = [
        D.Session(str(i), start + i * hour, start + (i + 1) * hour - dt.timedelta(seconds=1))
        for i in range(1500)
    ]
    df = spark.createDataFrame([("a", start + 700 * hour, 2.0)], "k string, t timestamp_ntz, v double")
    df = df.select("k", "v", D.session_label("t", sessions).alias("s"), D.hour_label("t").alias("h"))
    hours = D.session_hours(sessions)
    row = R.spread_sum(df, ["k", "s"], "h", hours, "v", "total").first()
    assert len(hours) == 1500 and row["s"] == "700" and row["total"] == 2.0
    assert row[hours[700]] == 2.0 and row[hours[0]] == 0.0


def test_the_last_of_overlapping_sessions_wins(spark):
    r = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    minute = dt.timedelta(minutes=1)
    for _ in range(20):
        spans = []
        for i in range(r.randrange(1, 9)):
            a = r.randrange(60)
            spans.append(D.Session(str(i % 4), start + a * minute, start + (a + r.randrange(30)) * minute))
        df = spark.range(-1, 95).select((F.lit(start) + F.make_dt_interval(mins=F.col("id").cast("int"))).cast("timestamp_ntz").alias("t"))
        got = [(x["t"], x["s"]) for x in df.select("t", D.session_label("t", spans).alias("s")).collect()]
        assert got == [(t, next((s.label for s in reversed(spans) if s.start <= t <= s.end), None)) for t, _ in got]
