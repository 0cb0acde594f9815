"""Catalogue and stock reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuloom import constants as K
from skuloom.functions.dates import parse_ts
from skuloom.functions.numeric import zero
from skuloom.functions.text import code, join_key, strip_brackets, unescape_plus
from skuloom.operators.aggregates import all_present, final_sums, group_sum, partial_sums
from skuloom.operators.blocks import in_tasks, tasks_for
from skuloom.operators.joins import keep_matching, lookup
from skuloom.operators.projection import any_nonzero, conform, differs, union_all
from skuloom.operators.windows import keep_one

Inputs = Mapping[str, DataFrame]

CATALOG_COLUMNS = (
    "style_code", "image_url", "sku", "color", "spec", "list_price", "cost",
    "created_at", "supplier", "category", "year", "season", "title",
)
STOCK_MEASURES = (
    "on_hand", "reserved", "return_wh", "inbound_wh", "on_order",
    "return_transit", "virtual", "available", "public_available",
)


def sku_to_skc(catalog: DataFrame) -> DataFrame:
    """Normalised SKU and its SKC, one row per catalogue row."""
    return catalog.select(code("sku").alias("sku"), join_key("style_code", "color").alias("skc"))


#: A SKU's lines of one key go to so many tasks, where lines are dealt before they are summed.
SKU_PARTS = 16


def skc_sums(
    lines: DataFrame, catalog: DataFrame, keys: Sequence[str], measures: Sequence[str], rows: int | None = None
) -> DataFrame:
    """Sums of sales lines per SKC (and further keys).

    Lines are summed per SKU as written first. That happens in part before the
    shuffle, so a SKU with very many lines weighs little, and only one row per SKU
    is normalised and meets the catalogue. Repeated catalogue rows still multiply
    the sums.

    With keys such as days, there may be about as many SKUs per key as lines. Given `rows`, about how many lines there are,
    they are dealt into tasks of bounded size first, a SKU's lines of one key into up to `SKU_PARTS`. The number only steers
    the work.
    """
    if keys:
        lines = lines.filter(all_present(keys))
    by = [*keys, "sku"]
    if rows is not None:
        lines = lines.select(*by, *measures).withColumn("_part", F.pmod(F.xxhash64(*measures), F.lit(SKU_PARTS)))
        by.append("_part")
        lines = in_tasks(lines, tasks_for(rows), *by)
    per_sku = partial_sums(lines, by, measures).withColumn("sku", code("sku"))
    with_skc = lookup(per_sku, sku_to_skc(catalog), ["sku"], ["skc"])
    return final_sums(with_skc, [*keys, "skc"], measures)


def catalog_clean(inputs: Inputs) -> DataFrame:
    """Product sheet with normalised SKU."""
    df = conform(inputs["catalog"], CATALOG_COLUMNS)
    return df.withColumns({"sku": code("sku"), "created_at": parse_ts("created_at", strict=True)})


def active_skc(
    inputs: Inputs,
    excluded_categories: Sequence[str] = K.NON_MERCHANDISE,
    excluded_styles: Sequence[str] = (),
) -> DataFrame:
    """SKCs of the catalogue with any stock, reservation, order or sales."""
    stock = inputs["stock"].select(
        join_key("style_code", "color").alias("skc"), "on_hand", "reserved", "on_order"
    )
    activity = union_all(
        group_sum(stock, ["skc"], ["on_hand", "reserved", "on_order"]),
        skc_sums(inputs["sales_paid"], inputs["catalog"], [], ["sold_qty"]),
    )
    # each measure comes from one side of the union; a missing one counts as 0
    measures = ["on_hand", "reserved", "on_order", "sold_qty"]
    active = activity.select("skc", *[zero(m).alias(m) for m in measures]).filter(
        any_nonzero(measures)
    )
    products = keep_one(
        inputs["catalog"].select("style_code", "color", "category", "image_url", "_ord"),
        ["style_code", "color"],
        ["_ord"],
    ).filter(F.col("color").isNotNull())
    for category in excluded_categories:
        products = products.filter(differs("category", category))
    for style in excluded_styles:
        products = products.filter(differs("style_code", style))
    products = products.withColumn("skc", join_key("style_code", "color"))
    return keep_matching(products, active, {"skc": "skc"}).select(
        unescape_plus("skc").alias("skc"),
        "style_code",
        unescape_plus("color").alias("color"),
        "image_url",
    )


def stock_by_sku(inputs: Inputs) -> DataFrame:
    """Stock rows with the size text cleaned and mapped to its final size."""
    stock = inputs["stock"].withColumns(
        {"skc": join_key("style_code", "color"), "spec": strip_brackets("spec")}
    )
    out = lookup(stock, inputs["size_rule"], ["spec"], ["spec_final"])
    return conform(
        out, ["skc", "style_code", "sku", "color", "spec", "spec_final", *STOCK_MEASURES]
    )


def stock_export(inputs: Inputs, table: str = "stock_export") -> DataFrame:
    """Stock export in its fixed column order, escaped plus signs restored."""
    df = conform(inputs[table], K.STOCK_EXPORT_COLUMNS)
    return df.withColumns({c: unescape_plus(c) for c in ("款式编码", "商品编码", "颜色")})


def image_worklist(inputs: Inputs) -> DataFrame:
    """Catalogue rows, one per SKC, of the SKCs without an image on the board."""
    missing = inputs["merch_board"].filter(F.col("image").isNull()).select("skc")
    products = inputs["catalog"].select(
        "image_url", "style_code", "color", "_ord", join_key("style_code", "color").alias("skc")
    )
    # the semi join first: the image of other SKCs is never sorted
    wanted = keep_matching(products, missing, {"skc": "skc"})
    return keep_one(wanted, ["skc"], ["_ord"]).drop("_ord")
