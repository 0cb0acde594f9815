"""Properties on generated rows."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from skuloom.operators import aggregates as A
from skuloom.operators import joins as J
from skuloom.operators import reshape as R
from skuloom.operators import windows as W

few = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
cents = st.integers(-10**6, 10**6).map(lambda n: n / 100)
lines = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 4), st.none() | cents),
    min_size=1,
    max_size=30,
)


def frame(spark, data):
    return spark.createDataFrame(data, "k string, d int, v double")


@few
@given(lines)
def test_last_running_sum_is_the_group_sum(spark, data):
    df = frame(spark, data)
    daily = A.group_sum(df, ["k", "d"], ["v"])
    cum = W.running_sum(daily, ["k"], ["d"], {"v": "c"})
    last = {r["k"]: r["c"] for r in cum.orderBy("k", "d").collect()}
    assert last == {r["k"]: r["v"] for r in A.group_sum(df, ["k"], ["v"]).collect()}


@few
@given(lines)
def test_subtotals_add_up(spark, data):
    base = A.group_sum(frame(spark, data).selectExpr("k", "cast(d as string) d", "v"), ["k", "d"], ["v"])
    out = A.with_subtotals(base, "k", "d", ["v"], "T").collect()
    parts = round(sum(r["v"] for r in out if r["d"] != "T"), 4)
    assert parts == round(sum(r["v"] for r in out if r["d"] == "T"), 4)


@few
@given(lines)
def test_a_unique_lookup_keeps_the_rows(spark, data):
    df = frame(spark, data)
    dim = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, n int")
    assert J.lookup(df, dim, ["k"], ["n"]).count() == len(data)


@few
@given(lines, st.integers(1, 4))
def test_split_join_is_the_join(spark, data, split_rows):
    df = frame(spark, data)
    dim = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "_key0 string, n int")
    got = J.split_join(df, dim, [("k", "_key0")], split_rows)
    want = J.lookup(df, dim, {"k": "_key0"}, ["n"])
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(map(tuple, got.select("k", "d", "v", "n").collect()), key=key) == sorted(
        map(tuple, want.collect()), key=key
    )


@few
@given(lines)
def test_spread_and_back(spark, data):
    sums = A.group_sum(frame(spark, data), ["k", "d"], ["v"])
    wide = R.spread_sum(sums, ["k"], "d", [0, 1, 2, 3, 4], "v", "t")
    back = wide.drop("t").unpivot(["k"], ["0", "1", "2", "3", "4"], "d", "v")
    got = {(r["k"], int(r["d"])): r["v"] for r in back.collect() if r["v"] != 0}
    assert got == {(r["k"], r["d"]): r["v"] for r in sums.collect() if r["v"] != 0}


@few
@given(lines)
def test_top_k_heads_the_ranking(spark, data):
    sums = A.group_sum(frame(spark, data), ["k", "d"], ["v"])
    order = ["v", "k", "d"]
    full = [tuple(r) for r in sums.orderBy(*order).collect()]
    assert [tuple(r) for r in W.top_k(sums, 3, order).orderBy(*order).collect()] == full[:3]
