"""Top-seller reports."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuloom.functions.dates import day_of, parse_ts, within_days
from skuloom.functions.numeric import ratio, total
from skuloom.functions.text import bracket_title, null_tokens
from skuloom.operators.joins import keep_matching, lookup
from skuloom.operators.windows import keep_one, top_k

Inputs = Mapping[str, DataFrame]


def title_table(inputs: Inputs) -> DataFrame:
    """Style, short title and title of every order line."""
    return inputs["order_lines"].select(
        "style_code",
        bracket_title("online_title").alias("short_title"),
        F.col("online_title").alias("title"),
    )


def _style_sums(inputs: Inputs, as_of: dt.date, days: int) -> DataFrame:
    """Amount and quantity per style, and the title of its first line."""
    lines = inputs["order_lines"].filter(within_days("paid_at", as_of, days) & F.col("style_code").isNotNull())
    return lines.groupBy("style_code").agg(
        total("sold_amt").alias("sold_amt"), total("sold_qty").alias("sold_qty"),
        F.min(F.struct("_ord", "online_title"))["online_title"].alias("online_title"),
    )


def _order() -> list:
    return [F.desc("sold_amt"), F.asc("style_code")]


def top_styles(inputs: Inputs, as_of: dt.date, days: int = 1, k: int = 20) -> DataFrame:
    """Best styles of the days before `as_of`, with image and launch date."""
    top = top_k(_style_sums(inputs, as_of, days), k, _order(), "rank").select(
        "rank",
        "style_code",
        F.lit(None).cast("date").alias("launch_time"),
        F.lit(None).cast("string").alias("category"),
        F.lit(None).cast("double").alias("ref_price"),
        "sold_amt",
        F.col("sold_qty").cast("int").alias("sold_qty"),
    )
    out = _with_launch(_with_image(top, inputs["catalog"]), inputs["merch_board"])
    return out.orderBy("rank", "launch_date")


def _with_image(top: DataFrame, catalog: DataFrame) -> DataFrame:
    """First image of the style; catalogue styles are upper-cased, sales styles are not."""
    images = catalog.filter(F.col("image_url").isNotNull()).select(
        F.upper(F.coalesce("style_code", F.lit("nan"))).alias("style_code"), "image_url", "_ord"
    )
    wanted = keep_matching(images, top, {"style_code": "style_code"})
    first = keep_one(wanted, ["style_code"], ["_ord"])
    return lookup(top, first, ["style_code"], ["image_url"])


def launch_dates(board: DataFrame) -> DataFrame:
    """Earliest launch date per style as it is written, then upper-cased."""
    dates = board.select(
        "style_code", null_tokens("launch_date").alias("launch_date")
    ).filter(F.col("launch_date").isNotNull())
    return (
        dates.groupBy("style_code")
        .agg(F.min(day_of(parse_ts("launch_date"))).alias("launch_date"))
        .select(F.upper(F.coalesce("style_code", F.lit("nan"))).alias("board_style"), "launch_date")
    )


def _with_launch(top: DataFrame, board: DataFrame) -> DataFrame:
    dates = launch_dates(board)
    wanted = keep_matching(dates, top, {"board_style": "style_code"})
    return lookup(
        top,
        wanted.withColumn("_style", F.col("board_style")),
        {"style_code": "_style"},
        ["board_style", "launch_date"],
    )


def top_shares(inputs: Inputs, as_of: dt.date, k: int = 36) -> DataFrame:
    """Best styles of yesterday with their share of all sales and their title."""
    sums = _style_sums(inputs, as_of, 1)
    # all sales of the day, before the list is cut
    totals = sums.agg(F.struct(total("sold_amt").alias("amt"), total("sold_qty").alias("qty"))).scalar()
    top = top_k(sums, k, _order(), "rank").withColumn("_all", totals).select(
        "rank",
        "style_code",
        F.lit("").alias("image"),
        ratio("sold_amt", F.col("_all.amt"), 4).alias("amt_share"),
        ratio("sold_qty", F.col("_all.qty"), 4).alias("qty_share"),
        bracket_title("online_title").alias("short_title"),
        F.col("online_title").alias("title"),
    )
    return top.orderBy("rank")
