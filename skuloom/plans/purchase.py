"""Purchasing reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skuloom import constants as K
from skuloom.functions.dates import elapsed_days, parse_ts
from skuloom.functions.numeric import ratio, round_even, to_whole, total
from skuloom.functions.text import head_of, join_key, label, matches, tags, tail_of, text_key
from skuloom.operators.aggregates import all_present, group_sum, weighted_mean
from skuloom.operators.joins import lookup
from skuloom.operators.projection import differs, union_all
from skuloom.operators.windows import keep_one

Inputs = Mapping[str, DataFrame]


def _usable(df: DataFrame) -> DataFrame:
    """Without rework orders and defective goods."""
    return df.filter(differs("tags", K.REWORK_TAG) & ~matches("remark", K.DEFECT_PATTERN))


def purchase_lines(inputs: Inputs) -> DataFrame:
    """Detail lines of finished and confirmed orders, history and current export."""
    lines = union_all(inputs["purchase_history"], inputs["purchase_current"])
    return lines.filter(
        (F.col("row_type") == K.DETAIL_ROW) & F.col("status").isin(*K.OPEN_STATUSES)
    ).withColumns(
        {
            "color": head_of("color_spec"),
            "spec": F.coalesce(tail_of("color_spec"), F.lit("")),
            "skc": join_key("style_code", head_of("color_spec")),
        }
    )


def tagged_totals(lines: DataFrame) -> DataFrame:
    """All received quantity of an SKC, one row for each tag that occurs with it."""
    # an SKC has four tags at most, so the window sees up to four rows of it
    per_tag = group_sum(
        lines.withColumn("tag", tags("remark")), ["skc", "tag"], ["received_qty"]
    )
    whole = Window.partitionBy("skc")
    return per_tag.select(
        "skc",
        "tag",
        total("received_qty", whole).alias("received_qty"),
    )


def _purchase_rows(inputs: Inputs) -> DataFrame:
    """Ordered and received quantity per SKC, date and supplier, with the SKC's total and its tags.

    One aggregation of the lines feeds all three: the total and the tags, at most four, also count the lines that are
    not usable. Its rows, a few per SKC and date, are then seen by SKC.
    """
    lines = purchase_lines(inputs).filter(F.col("skc").isNotNull())
    usable = differs("tags", K.REWORK_TAG) & ~matches("remark", K.DEFECT_PATTERN)
    parts = group_sum(
        lines.withColumns(
            {"_usable": usable, "_tag": tags("remark"), "po_date": parse_ts("po_date", strict=True)}
        ),
        ["skc", "po_date", "supplier", "_usable", "_tag"],
        ["po_qty", "received_qty"],
        keep_null_keys=True,
    )
    whole = Window.partitionBy("skc")
    seen = parts.withColumns(
        {"all_received_qty": total("received_qty", whole), "_tags": F.collect_set("_tag").over(whole)}
    ).filter(F.col("_usable") & all_present(["po_date", "supplier"]))
    return seen.groupBy("skc", "po_date", "supplier").agg(
        total("po_qty").alias("po_qty"), total("received_qty").alias("received_qty"),
        F.max("all_received_qty").alias("all_received_qty"), F.any_value("_tags").alias("_tags"),
    )


def purchase_history(inputs: Inputs) -> DataFrame:
    """Ordered and received quantity per SKC, date and supplier, with the SKC's total."""
    out = _purchase_rows(inputs).drop("_tags")
    return out.orderBy(F.asc("skc"), F.desc("po_date"), F.asc("supplier"))


def received_with_tags(inputs: Inputs) -> DataFrame:
    """Received quantity per SKC, one row for each tag of the SKC."""
    return tagged_totals(purchase_lines(inputs)).select("skc", "received_qty", "tag")


def first_purchase(inputs: Inputs) -> DataFrame:
    """Earliest purchase row per SKC, one row for each tag of the SKC."""
    first = keep_one(
        _purchase_rows(inputs), ["skc"], [F.col("po_date").asc(), F.col("supplier").desc()]
    )
    return first.select("*", F.explode("_tags").alias("tag")).drop("_tags")


def receipt_days(inputs: Inputs) -> DataFrame:
    """Quantity-weighted days from order to receipt per PO and SKU."""
    number = F.coalesce(to_whole("po_no"), F.lit(0).cast("long")).cast("string")
    receipts = (
        inputs["receipts"]
        .filter(differs("tags", K.ADJUSTMENT_TAG))
        .select(
            text_key(number, "sku").alias("po_sku"),
            round_even(
                elapsed_days(parse_ts("po_date", strict=True), parse_ts("received_at", strict=True)),
                2,
            ).alias("days"),
            "qty",
        )
    )
    return weighted_mean(receipts, ["po_sku"], "days", "qty", "avg_receipt_days", "receipt_qty")


def po_lead_time(inputs: Inputs, salt_rows: int | None = None) -> DataFrame:
    """Purchase-order lines with receipt days, completion ratio and done label.

    A line appears once for each status of its order, and takes the first
    completion time of the order.
    """
    lines = _usable(inputs["po_lines"].filter(F.col("status").isin(*K.OPEN_STATUSES)))
    skc = join_key("style_code", head_of("color_spec"))
    po_sku = text_key("po_no", "sku")
    lines = lines.withColumns(
        {
            "po_skc": text_key("po_no", skc),
            "completed_at": parse_ts("completed_at", strict=True),
            "po_date": parse_ts("po_date", strict=True),
        }
    )
    # per order and SKC: sums, statuses (two at most) and the first completion time; from its rows those of the order
    position = F.struct("_ord", "completed_at")
    done_at = F.when(F.col("completed_at").isNotNull(), position)
    parts = lines.groupBy("po_no", "po_skc").agg(
        total("received_qty").alias("_received"), total("po_qty").alias("_ordered"),
        *[F.max((F.col("status") == s).cast("int")).alias(f"_is{i}") for i, s in enumerate(K.OPEN_STATUSES)],
        F.min(done_at).alias("_done_at"),
    )
    order = Window.partitionBy("po_no")
    flags = [f"_is{i}" for i in range(len(K.OPEN_STATUSES))]
    parts = parts.withColumns(
        # flags, not lists: lines without an order number are all one order
        {**{f: F.max(f).over(order) for f in flags}, "_first_completed": F.min("_done_at").over(order)["completed_at"]}
    )
    # a line counts once for each status of its order
    factor = sum((F.coalesce(F.col(f), F.lit(0)) for f in flags), F.lit(0))
    code = Window.partitionBy("po_skc")
    completion = F.coalesce(
        ratio(total(F.col("_received") * factor, code), total(F.col("_ordered") * factor, code), 2), F.lit(0.0)
    )
    parts = parts.withColumn("completion_ratio", completion)
    # what follows from other columns of a line is told after the joins, so that no shuffle carries it
    of_order = [*flags, "_first_completed", "completion_ratio"]
    if salt_rows is None:
        # parts lie by `po_skc` already, which is never null and all but tells the order: no key of the join but a condition,
        # a null order being one of them, so that parts are not shuffled again
        side = parts.select(F.col("po_no").alias("_po_no"), F.col("po_skc").alias("_po_skc"), *of_order)
        same = F.coalesce(F.col("po_no") == F.col("_po_no"), F.col("po_no").isNull() & F.col("_po_no").isNull())
        out = lines.join(side, (F.col("po_skc") == F.col("_po_skc")) & same, "left").drop("_po_no", "_po_skc")
    else:
        out = lookup(lines, parts, ["po_no", "po_skc"], of_order, salt_rows=salt_rows)
    out = out.drop("po_skc").withColumn("po_sku", po_sku)
    # one row per category: the first
    plan = keep_one(inputs["category"], ["category"], ["_ord"])

    days = ["avg_receipt_days", "receipt_qty"]
    # never null on either side: the means lie by it already
    out = lookup(out, receipt_days(inputs), ["po_sku"], days, null_safe=False, salt_rows=salt_rows)
    out = lookup(out, plan, ["category"], ["plan_category"], salt_rows=salt_rows)
    statuses = F.array_compact(F.array(*[F.when(F.col(f) == 1, F.lit(s)) for f, s in zip(flags, K.OPEN_STATUSES, strict=True)]))
    out = out.withColumns(
        {
            "color": head_of("color_spec"),
            "spec": F.coalesce(tail_of("color_spec"), F.lit("")),
            "skc": skc,
            "po_skc": text_key("po_no", skc),
            "po_sku": F.when(F.col("po_sku") == "nan", F.lit("")).otherwise(F.col("po_sku")),
            # lines without an order number keep their own time
            "completed_at": F.when(F.col("po_no").isNull(), F.col("completed_at")).otherwise(
                F.coalesce("_first_completed", "completed_at")
            ),
            "done": label(F.col("completion_ratio") >= K.DONE_RATIO, K.DONE_LABEL, K.OPEN_LABEL),
        }
    )
    own = [c for c in lines.columns if c not in ("_ord", "po_skc")]
    derived = ["color", "spec", "skc", "po_skc", "po_sku"]
    return out.select(
        *own, *derived, "completion_ratio", "done", F.explode(statuses).alias("po_status"), *days, "plan_category"
    )
