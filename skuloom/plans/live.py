"""Live-session reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuloom.functions.dates import (
    Session, hour_label, parse_ts, session_hours, session_label, within_sessions,
)
from skuloom.functions.text import strip
from skuloom.operators.intervals import span_join
from skuloom.operators.reshape import spread_sum

Inputs = Mapping[str, DataFrame]


def _typed(sales: DataFrame) -> bool:
    return sales.schema["paid_at"].dataType.typeName().startswith("timestamp")


def live_lines(inputs: Inputs, streamer_id: str, sessions: Sequence[Session] | DataFrame) -> DataFrame:
    """Lines of one streamer with hour and session label; null outside all sessions.

    The sessions are a list, or a table with `label`, `start`, `end` and `_ord`; the last of overlapping ones wins.
    """
    sales = inputs["live_sales"]
    paid = F.col("paid_at").cast("timestamp_ntz") if _typed(sales) else parse_ts("paid_at")
    lines = sales.filter(strip(F.col("streamer_id").cast("string")) == streamer_id).withColumn("paid_at", paid)
    if isinstance(sessions, DataFrame):
        lines = span_join(lines, "paid_at", sessions, {"label": "_session"})
        session = F.col("_session")
    else:
        session = session_label("paid_at", sessions)
    return lines.select(
        "paid_at",
        F.col("paid_at").cast("date").alias("date"),
        strip(F.col("streamer_id").cast("string")).alias("streamer_id"),
        "style_code",
        "sold_qty",
        hour_label("paid_at").alias("hour"),
        session.alias("session"),
    )


def live_board(
    inputs: Inputs,
    streamer_id: str,
    sessions: Sequence[Session],
    hours: Sequence[str] | None = None,
) -> DataFrame:
    """Sold quantity per style and hour of the sessions, best style first.

    Without `hours` the columns are all hours that the sessions touch. Only the time between the first start and the last
    end is read, where the table holds timestamps.
    """
    sales = inputs["live_sales"]
    if _typed(sales):
        sales = sales.filter(within_sessions("paid_at", sessions))
    lines = live_lines({"live_sales": sales}, streamer_id, sessions).filter(F.col("session").isNotNull())
    hours = session_hours(sessions) if hours is None else hours
    board = spread_sum(lines, ["style_code"], "hour", hours, "sold_qty", "session_total")
    return board.select(
        "style_code",
        F.lit("").alias("image"),
        F.lit("").alias("category"),
        "session_total",
        *[f"`{h}`" for h in hours],
    ).orderBy(F.desc("session_total"), F.asc("style_code"))
