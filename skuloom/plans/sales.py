"""Sales reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuloom.functions.dates import day_of, parse_ts
from skuloom.functions.numeric import ratio, round_even, to_number, zero
from skuloom.functions.text import (
    code, color_of, head_of, id_head, join_key, spec_of, tail_of,
)
from skuloom.operators.aggregates import first_day_above, group_sum
from skuloom.operators.joins import lookup
from skuloom.operators.projection import conform, fill, union_all
from skuloom.plans.catalog import sku_to_skc, skc_sums, stock_by_sku

Inputs = Mapping[str, DataFrame]

SALES_DETAIL_COLUMNS = (
    "skc", "shop", "paid_date", "channel", "style_code", "order_no", "sku",
    "color_spec", "color", "spec", "streamer_id", "category", "sold_qty",
    "shipped_qty", "return_qty", "returned_qty",
)
LINE_COLUMNS = (
    "skc", "spec", "spec_final", "channel", "shop", "date", "sku", "style_code",
    "color_spec", "category", "cost", "sold_qty", "shipped_qty", "shipped_amt",
    "sold_amt", "return_qty", "returned_qty", "return_amt", "returned_amt",
    "net_cost", "report_channel",
)


def today_sales(inputs: Inputs) -> DataFrame:
    """Sold quantity per SKC."""
    lines = inputs["today_sales"].drop("skc")
    return skc_sums(lines, inputs["catalog"], [], ["sold_qty"])


def sales_detail(inputs: Inputs, sep: str = "+", salt_rows: int | None = None) -> DataFrame:
    """Order lines with SKC, channel and the module of the streamer.

    A line whose SKU is not in the catalogue takes its SKC from its own style and
    colour, joined by `sep`.
    """
    lines = inputs["order_lines"].withColumns(
        {
            "_sku": code("sku"),
            "paid_date": day_of(parse_ts("paid_at", strict=True)),
            "streamer_id": id_head("streamer_id"),
        }
    )
    lines = lookup(lines, sku_to_skc(inputs["catalog"]), {"_sku": "sku"}, ["skc"], salt_rows=salt_rows).drop("_sku")
    lines = lookup(lines, inputs["channel"], ["shop"], ["channel"], salt_rows=salt_rows)
    module = inputs["module"].select("module", id_head("uid").alias("uid"))
    lines = lookup(
        lines,
        module.withColumn("_uid", F.col("uid")),
        {"streamer_id": "_uid"},
        ["module", "uid"],
        salt_rows=salt_rows,
    )
    # what follows from other columns of a line is told after the joins, so that no shuffle carries it
    own = (
        F.col("skc").isNull()
        & F.col("category").isNotNull()
        & F.coalesce(F.contains("color_spec", F.lit(";")), F.lit(False))
    )
    lines = lines.withColumns(
        {
            "skc": F.when(
                own,
                F.concat(
                    F.coalesce("style_code", F.lit("nan")), F.lit(sep), head_of("color_spec")
                ),
            ).otherwise(F.col("skc")),
            "color": F.when(own, head_of("color_spec")),
            "spec": F.when(own, tail_of("color_spec")),
        }
    )
    lines = conform(fill(lines, ["sold_qty"]), (*SALES_DETAIL_COLUMNS, "module", "uid"))
    return fill(lines, ["streamer_id"], "")


def shipped_daily(inputs: Inputs, rows: int | None = None) -> DataFrame:
    """Shipped and received-back quantity per day and SKC. `rows`: about how many lines there are, see `skc_sums`."""
    lines = inputs["sales_shipped"].withColumn("date", day_of(parse_ts("date", strict=True)))
    return skc_sums(lines, inputs["catalog"], ["date"], ["shipped_qty", "returned_qty"], rows)


def shipped_detail(
    inputs: Inputs, normalise_stock: bool = False, salt_rows: int | None = None
) -> DataFrame:
    """Shipped lines with SKC, size, channel and net cost.

    The SKU of the stock table is taken as it is unless `normalise_stock`.
    """
    lines = inputs["sales_shipped"].withColumns(
        {"sku": code("sku"), "date": day_of(parse_ts("date", strict=True))}
    ).withColumnRenamed("channel", "report_channel")
    stock = stock_by_sku(inputs)
    if normalise_stock:
        stock = stock.withColumn("sku", code("sku"))
    out = lookup(lines, inputs["channel"], ["shop"], ["channel"], salt_rows=salt_rows)
    out = lookup(out, sku_to_skc(inputs["catalog"]), ["sku"], ["skc"], salt_rows=salt_rows)
    out = lookup(out, stock, ["sku"], ["spec", "spec_final"], salt_rows=salt_rows)
    return _with_net_cost(out)


def _with_net_cost(lines: DataFrame) -> DataFrame:
    net_cost = F.col("cost") * (F.col("sold_qty") - F.col("return_qty"))
    return conform(lines.withColumn("net_cost", net_cost), LINE_COLUMNS)


def _paid_lines(inputs: Inputs, salt_rows: int | None = None) -> DataFrame:
    """Paid lines with size and channel."""
    lines = inputs["sales_paid"].withColumns(
        {
            "date": day_of(parse_ts("date", strict=True)),
            "color": color_of("color_spec"),
            "spec": spec_of("color_spec"),
        }
    ).withColumnRenamed("channel", "report_channel")
    out = lookup(lines, inputs["size_rule"], ["spec"], ["spec_final"], salt_rows=salt_rows)
    out = lookup(out, inputs["channel"], ["shop"], ["channel"], salt_rows=salt_rows)
    return fill(out, ["sold_amt", "return_amt", "sold_qty", "return_qty"])


def paid_detail(inputs: Inputs, salt_rows: int | None = None) -> DataFrame:
    """Paid lines with SKC, size, channel and net cost."""
    lines = _paid_lines(inputs, salt_rows).withColumn("sku", code("sku"))
    lines = lookup(lines, sku_to_skc(inputs["catalog"]), ["sku"], ["skc"], salt_rows=salt_rows)
    return _with_net_cost(lines)


def paid_summary(inputs: Inputs) -> DataFrame:
    """Sales, returns, net amount, margin and unit price per SKC."""
    lines = _paid_lines(inputs).withColumn(
        "net_cost", F.col("cost") * (F.col("sold_qty") - F.col("return_qty"))
    )
    sums = skc_sums(
        lines,
        inputs["catalog"],
        [],
        ["sold_amt", "return_amt", "sold_qty", "return_qty", "net_cost"],
    )
    return sums.withColumn("net_amt", F.col("sold_amt") - F.col("return_amt")).withColumns(
        {
            "margin": round_even(F.lit(1.0) - ratio("net_cost", "net_amt"), 4),
            "unit_price": ratio("sold_amt", "sold_qty", 0),
        }
    )


def first_hot_day(inputs: Inputs, threshold: float = 10, rows: int | None = None) -> DataFrame:
    """First day on which an SKC sold more than the threshold. `rows`: about how many lines there are, see `skc_sums`."""
    daily = skc_sums(_paid_lines(inputs), inputs["catalog"], ["date"], ["sold_qty"], rows)
    hot = first_day_above(daily, "skc", "date", "sold_qty", threshold, "first_hot_day")
    return hot.orderBy("first_hot_day", "skc")


SALES_KEYS = ("skc", "style_code", "color")
SALES_SUMS = ("sold_qty", "return_qty", "net_qty")


def sold_lines(lines: DataFrame) -> DataFrame:
    """Lines of a sales export with their SKC and net quantity; what is no number counts as 0."""
    return lines.select(
        join_key("style_code", color_of("color_spec")).alias("skc"),
        "style_code",
        color_of("color_spec").alias("color"),
        zero(to_number("sold_qty")).alias("sold_qty"),
        zero(to_number("return_qty")).alias("return_qty"),
    ).withColumn("net_qty", F.col("sold_qty") - F.col("return_qty"))


def all_time_sales(inputs: Inputs) -> DataFrame:
    """Sold, returned and net quantity per SKC, history and current export. `history` keeps them up to date day by day."""
    lines = sold_lines(union_all(inputs["sales_history"], inputs["sales_current"]))
    return group_sum(lines, SALES_KEYS, SALES_SUMS)
