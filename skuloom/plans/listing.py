"""Listing reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skuloom import constants as K
from skuloom.functions.dates import day_of, parse_ts
from skuloom.functions.text import map_values, unescape_plus
from skuloom.operators.joins import chained_lookup, lookup
from skuloom.operators.projection import differs, distinct_where, union_all
from skuloom.operators.reshape import spread_flag, spread_flag_map
from skuloom.operators.windows import flag_top

Inputs = Mapping[str, DataFrame]

PRIORITY_COLUMNS = (
    "style_code", "skc", "color", "launch_date", "plan_category", "total_stock",
    "reserved", "avg3d_sales",
)


ROUTED_TAKE = {"style_code": "system_style", "sku": "system_sku"}


def _channel() -> Column:
    return map_values("site", K.SITE_CHANNELS, K.UNKNOWN_CHANNEL)


def _skc() -> Column:
    # a missing colour reads as empty
    return F.concat("system_style", F.coalesce("color", F.lit("")))


def _with_skc(lines: DataFrame) -> DataFrame:
    return lines.withColumns({"channel": _channel(), "skc": _skc()})


def listing_lines(inputs: Inputs, routed_shop: str, salt_rows: int | None = None) -> DataFrame:
    """Listing lines with catalogue style, SKU, colour, channel and SKC.

    One shop lists by national code: its style and SKU come from the catalogue by
    that code. Then all listings take the colour from the catalogue by SKU. Channel and SKC are told before the codes
    multiply the listings.
    """
    listings, catalog = inputs["listings"].drop("_ord"), inputs["catalog"]
    columns = [*listings.columns, "color", "channel", "skc"]
    listings = listings.withColumn("channel", _channel())
    routed = chained_lookup(
        listings.filter(F.col("shop") == routed_shop).drop("system_style", "system_sku"),
        catalog,
        {"online_style": "national_code"},
        ROUTED_TAKE,
        catalog,
        {"system_sku": "sku"},
        ["color"],
        salt_rows=salt_rows,
        derive={"skc": _skc()},
    )
    others = lookup(
        listings.filter(differs("shop", routed_shop)), catalog, {"system_sku": "sku"}, ["color"], salt_rows=salt_rows
    ).withColumn("skc", _skc())
    return union_all(routed.select(*columns), others.select(*columns))


def _shop_lines(inputs: Inputs, routed_shop: str) -> DataFrame:
    """Shop, channel, SKC and flag of the lines, reduced before and after the catalogue is joined.

    A code of the routed shop stands for all SKCs that the catalogue has for it: they are told from the catalogue first, each
    once. A line without a style has no SKC.
    """
    listings, catalog = inputs["listings"], inputs["catalog"]
    flag = F.max("is_listed").alias("is_listed")
    colors = catalog.select("sku", "color").distinct()
    styles = catalog.select("national_code", "style_code", "sku").distinct()
    styles = lookup(styles, colors, ["sku"], ["color"]).select(
        "national_code", "style_code", F.coalesce("color", F.lit("")).alias("color")
    ).distinct()
    routed = listings.filter(F.col("shop") == routed_shop).groupBy("shop", "site", "online_style").agg(flag)
    routed = lookup(routed, styles, {"online_style": "national_code"}, {"style_code": "system_style", "color": "color"})
    others = (
        listings.filter(differs("shop", routed_shop)).groupBy("shop", "site", "system_style", "system_sku").agg(flag)
    )
    others = lookup(others, colors, {"system_sku": "sku"}, ["color"])
    columns = ["shop", "site", "system_style", "color", "is_listed"]
    return _with_skc(union_all(routed.select(*columns), others.select(*columns)))


def listing_maps(inputs: Inputs, routed_shop: str) -> DataFrame:
    """Whether an SKC is listed, in a map from every (channel, shop) found to 1 or 0."""
    lines = _shop_lines(inputs, routed_shop)
    found = spread_flag_map(lines, ["skc"], ["channel", "shop"], "is_listed", "listed")
    return found.withColumn("skc", unescape_plus("skc"))


def listing_matrix(inputs: Inputs, routed_shop: str, shops: Sequence[tuple[str, str]]) -> DataFrame:
    """Whether an SKC is listed, a column per given channel and shop."""
    lines = _shop_lines(inputs, routed_shop)
    matrix = spread_flag(lines, ["skc"], ["channel", "shop"], shops, "is_listed", K.YES)
    return matrix.withColumn("skc", unescape_plus("skc"))


def priority_skc(
    inputs: Inputs,
    min_qty: float = 10,
    excluded_category: str = K.BEAUTY,
    top: int = 200,
) -> DataFrame:
    """SKCs with enough stock or reservations, and whether they sell among the best.

    The rank counts the rows of the excluded category as well.
    """
    board = distinct_where(
        inputs["merch_board"],
        F.col("total_stock") >= min_qty,
        F.col("reserved") >= min_qty,
        order="_ord",
    )
    board = board.select(*PRIORITY_COLUMNS, "_ord").withColumns(
        {
            "launch_date": day_of(parse_ts("launch_date")),
            "avg3d_sales": F.col("avg3d_sales").cast("int"),
        }
    )
    order = [F.desc("avg3d_sales"), F.asc("skc"), F.asc("_ord")]
    flagged = flag_top(board, top, order, "_ord", "top200", K.YES, K.NO)
    return (
        flagged.filter(differs("plan_category", excluded_category)).orderBy(*order).drop("_ord")
    )
