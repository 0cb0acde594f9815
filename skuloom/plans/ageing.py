"""Stock ageing."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuloom import constants as K
from skuloom.functions.dates import age_bin, day_of, parse_ts
from skuloom.functions.numeric import round_even, total
from skuloom.operators.aggregates import dense_grid, with_subtotals
from skuloom.operators.windows import label_rank

Inputs = Mapping[str, DataFrame]

MEASURES = {
    "skc_count": ("count", "skc"),
    "total_stock": ("sum", "total_stock"),
    "stock_cost": ("sum", "stock_cost"),
}


def ageing_detail(inputs: Inputs, as_of: dt.date) -> DataFrame:
    """Available stock with the age since its last order."""
    launch = F.coalesce(parse_ts("launch_date"), parse_ts("created_at"))
    last_order = day_of(F.coalesce(parse_ts("last_order_date"), launch))
    days = F.datediff(F.lit(as_of), last_order)
    return (
        inputs["merch_board"]
        .filter(F.col("category").isNotNull() & (F.col("available") >= 1))
        .withColumns(
            {
                "class": F.when(F.col("category") == K.BEAUTY, F.lit(K.BEAUTY)).otherwise(
                    F.col("class")
                ),
                "launch_date": launch,
                "last_order_date": last_order,
                "as_of": F.lit(as_of),
                "age_days": days,
                "age": age_bin(days),
                "stock_cost": F.col("total_stock") * F.col("cost"),
            }
        )
        .drop("_ord")
    )


def stock_ageing(inputs: Inputs, as_of: dt.date) -> DataFrame:
    """SKCs, stock and stock cost per class and age, with subtotals and grand total.

    The grand total is half the sum of all rows, subtotals included, so it keeps
    the rounding of the rows; shares come in steps of 0.0002.
    """
    detail = ageing_detail(inputs, as_of)
    grid = dense_grid(detail, "class", "age", K.AGE_LABELS, MEASURES)
    rows = with_subtotals(grid, "class", "age", list(MEASURES), K.CLASS_TOTAL)
    rows = rows.withColumn("stock_cost", round_even("stock_cost", 0))
    everything = rows.agg(total("stock_cost")).scalar()
    rows = rows.withColumn(
        "cost_share",
        F.when(everything == 0, F.lit(0.0)).otherwise(
            round_even(F.try_divide(F.col("stock_cost"), everything), 4)
        )
        * 2,
    )
    # each row counts for itself and, by half, for the grand total
    measures = [*MEASURES, "cost_share"]
    both = F.array(
        F.struct("class", "age", *[F.col(m).cast("double").alias(m) for m in measures]),
        F.struct(
            F.lit(K.CLASS_TOTAL).alias("class"),
            F.lit(K.GRAND_TOTAL).alias("age"),
            *[(F.col(m) / 2).alias(m) for m in measures],
        ),
    )
    out = (
        rows.select(F.inline(both))
        .groupBy("class", "age")
        .agg(*[total(m).alias(m) for m in measures])
    )
    return out.orderBy(
        label_rank("class", K.CLASS_ORDER),
        "class",
        label_rank("age", [*K.AGE_LABELS, K.CLASS_TOTAL, K.GRAND_TOTAL]),
    )
