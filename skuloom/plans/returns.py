"""Return and refund reports."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skuloom import constants as K
from skuloom.functions.dates import day_of, day_text, elapsed_days, parse_ts
from skuloom.functions.numeric import ratio, total
from skuloom.functions.text import color_of, join_key, strip
from skuloom.operators.aggregates import all_present, group_sum
from skuloom.operators.joins import lookup
from skuloom.operators.projection import differs
from skuloom.operators.reshape import (
    metrics_to_rows, metrics_to_rows_map, spread_metrics, spread_metrics_map,
)
from skuloom.operators.windows import running_sum, window_sums

Inputs = Mapping[str, DataFrame]

RETURN_METRICS = ("cum_return_rate", "cum_refund_only_rate", "cum_shipped_return_rate")
RETURN_IDS = (
    "skc", "plan_category", "period_sold", "period_return", "period_return_rate",
    "period_refund_only", "period_refund_only_rate", "period_shipped",
    "period_returned", "period_shipped_return_rate",
)
REFUND_DAYS = 25
REFUND_IDS = (
    "paid_date", "skc", "category", "opening_stock", "day_sold", "day_refund_only",
    "day_shipped", "pre_ship_refund_rate", "post_ship_refund_rate", "full_return_rate",
)
REFUND_METRICS = ("return_qty", "cum_refund", "cum_share")


def return_rates(inputs: Inputs) -> DataFrame:
    """Cumulative return rates per SKC, plan category and day, with period totals.

    A line without a plan category or a date counts in the period totals only.
    One aggregation feeds both: its rows, at most one per day and plan category
    of an SKC, share a single shuffle by SKC.
    """
    lines = lookup(
        inputs["sales_paid"].select(
            "date", "style_code", "color_spec", "category",
            "sold_qty", "shipped_qty", "return_qty", "returned_qty",
        ),
        inputs["category"],
        ["category"],
        ["plan_category"],
    ).withColumns(
        {
            "date": day_of(parse_ts("date")),
            "skc": join_key("style_code", color_of("color_spec")),
        }
    )
    measures = ["sold_qty", "shipped_qty", "return_qty", "returned_qty"]
    daily = group_sum(
        lines.filter(F.col("skc").isNotNull()),
        ["skc", "date", "plan_category"],
        measures,
        keep_null_keys=True,
    )
    counted = F.col("date").isNotNull() & F.col("plan_category").isNotNull()
    daily = daily.withColumns({f"_{m}": F.when(counted, F.col(m)).otherwise(0.0) for m in measures})
    cumulated = running_sum(
        daily, ["skc"], ["date", "plan_category"], {f"_{m}": f"cum_{m}" for m in measures}
    )
    whole = Window.partitionBy("skc")
    out = window_sums(cumulated, whole, {m: f"all_{m}" for m in measures}).filter(counted)
    return out.select(
        day_text("date").alias("date"),
        "skc",
        "plan_category",
        ratio("cum_return_qty", "cum_sold_qty", 2).alias("cum_return_rate"),
        ratio(F.col("cum_sold_qty") - F.col("cum_shipped_qty"), "cum_sold_qty", 2).alias(
            "cum_refund_only_rate"
        ),
        ratio("cum_returned_qty", "cum_shipped_qty", 2).alias("cum_shipped_return_rate"),
        F.col("all_sold_qty").alias("period_sold"),
        F.col("all_return_qty").alias("period_return"),
        ratio("all_return_qty", "all_sold_qty", 2).alias("period_return_rate"),
        (F.col("all_sold_qty") - F.col("all_shipped_qty")).alias("period_refund_only"),
        ratio(F.col("all_sold_qty") - F.col("all_shipped_qty"), "all_sold_qty", 2).alias(
            "period_refund_only_rate"
        ),
        F.col("all_shipped_qty").alias("period_shipped"),
        F.col("all_returned_qty").alias("period_returned"),
        ratio("all_returned_qty", "all_shipped_qty", 2).alias("period_shipped_return_rate"),
    )


def return_rate_maps(inputs: Inputs) -> DataFrame:
    """Return rates with metrics as rows and all their dates in a map."""
    out = metrics_to_rows_map(return_rates(inputs), RETURN_IDS, RETURN_METRICS, "date", "rates")
    return out.select("skc", F.lit("").alias("image"), *RETURN_IDS[1:], "metric", "rates")


def return_rate_matrix(inputs: Inputs, dates: Sequence[dt.date]) -> DataFrame:
    """Return rates with metrics as rows and the given dates as columns."""
    names = [d.isoformat() for d in dates]
    out = metrics_to_rows(return_rates(inputs), RETURN_IDS, RETURN_METRICS, "date", names)
    return out.select(
        "skc", F.lit("").alias("image"), *RETURN_IDS[1:], "metric", *[f"`{n}`" for n in names]
    )


def refund_lines(inputs: Inputs, excluded_streamer: str | None = None) -> DataFrame:
    """Order lines with paid date, SKC and days from payment to the claim."""
    lines = inputs["order_lines"]
    if excluded_streamer is not None:
        lines = lines.filter(differs(strip(F.col("streamer_id")), excluded_streamer))
    paid, claim = parse_ts("paid_at"), parse_ts("claim_at")
    return lines.select(
        day_of(paid).alias("paid_date"),
        join_key("style_code", color_of("color_spec")).alias("skc"),
        "category",
        F.ceil(elapsed_days(paid, claim)).cast("int").alias("delay"),
        "claim_type",
        "sold_qty",
        "shipped_qty",
        "return_qty",
        "returned_qty",
    )


def refund_curve(inputs: Inputs, excluded_streamer: str | None = None) -> DataFrame:
    """Refund-only quantity by days since payment, with running sum and shares."""
    lines = refund_lines(inputs, excluded_streamer).filter(
        all_present(["paid_date", "skc"])
    )
    day = ["paid_date", "skc"]

    # one aggregation of the lines: a line counts in the totals of its category, and a refund also in those of its delay, in a
    # row of its own with one measure. So there are no rows per category and delay, and nothing to sum over windows of them
    refund = F.col("claim_type") == K.REFUND_ONLY
    measures = ["sold_qty", "shipped_qty", "returned_qty", "return_qty"]
    none = {c: F.lit(None).cast(lines.schema[c].dataType).alias(c) for c in ["category", "delay", *measures]}
    of_category = F.struct(F.lit(False).alias("_refund"), "category", none["delay"], *measures)
    of_delay = F.struct(
        F.lit(True).alias("_refund"), none["category"], "delay", *[none[m] for m in measures[:-1]], "return_qty"
    )
    parts = (
        lines.select(*day, F.inline(F.when(refund, F.array(of_category, of_delay)).otherwise(F.array(of_category))))
        .groupBy(*day, "_refund", "category", "delay").agg(*[total(m).alias(m) for m in measures])
    )
    # refunds without a claim time count in the total of the day only
    with_refund = F.col("_refund") & F.col("delay").isNotNull()
    gathered = parts.groupBy(*day).agg(
        total(F.when(F.col("_refund"), F.col("return_qty"))).alias("day_refund_only"),
        F.collect_list(F.when(with_refund, F.struct("delay", "return_qty"))).alias("_delays"),
        F.collect_list(
            F.when(
                F.col("category").isNotNull(),
                F.struct(
                    "category",
                    F.col("sold_qty").alias("day_sold"),
                    F.col("shipped_qty").alias("day_shipped"),
                    ratio("returned_qty", "shipped_qty", 2).alias("post_ship_refund_rate"),
                    ratio("return_qty", "sold_qty", 2).alias("full_return_rate"),
                ),
            )
        ).alias("_totals"),
    )
    refunds = running_sum(
        gathered.select(*day, "day_refund_only", "_totals", F.inline("_delays")),
        day, ["delay"], {"return_qty": "cum_refund"},
    )
    stock = group_sum(
        inputs["stock_daily"].select(
            day_of(parse_ts("date")).alias("paid_date"), "skc", "opening_qty"
        ),
        day,
        {"opening_qty": "opening_stock"},
    )
    # the stock belongs to the totals: without any there is none
    out = refunds.select("*", F.explode_outer("_totals").alias("_t")).select(
        *[c for c in refunds.columns if c != "_totals"], "_t.*"
    )
    out = lookup(out, stock, day, {"opening_stock": "_opening"})
    return out.withColumns(
        {
            "opening_stock": F.when(F.col("category").isNotNull(), F.col("_opening")),
            "pre_ship_refund_rate": ratio("day_refund_only", "day_sold", 2),
            "cum_share": ratio("cum_refund", "day_sold", 2),
        }
    ).drop("_opening")


def refund_curve_maps(
    inputs: Inputs, excluded_streamer: str | None = None, max_days: int = REFUND_DAYS
) -> DataFrame:
    """Refund curve up to `max_days`, with all delays, negative ones too, in a map to the metrics."""
    curve = refund_curve(inputs, excluded_streamer).filter(F.col("delay") <= max_days)
    return spread_metrics_map(curve, REFUND_IDS, "delay", REFUND_METRICS, "curve").orderBy(
        F.desc("skc"), F.asc("paid_date")
    )


def refund_curve_wide(
    inputs: Inputs,
    delays: Sequence[int],
    excluded_streamer: str | None = None,
    max_days: int = REFUND_DAYS,
) -> DataFrame:
    """Refund curve up to `max_days`, one column per metric and given delay."""
    curve = refund_curve(inputs, excluded_streamer).filter(F.col("delay") <= max_days)
    delays = [d for d in delays if d <= max_days]
    return spread_metrics(
        curve.filter(F.col("delay").isin(*delays)), REFUND_IDS, "delay", delays, REFUND_METRICS
    ).orderBy(F.desc("skc"), F.asc("paid_date"))
