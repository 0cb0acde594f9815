"""The live board on a stream of sales."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuloom.functions.dates import Session, hour_label
from skuloom.functions.numeric import total
from skuloom.plans.live import live_lines


def live_hours(
    lines: DataFrame, streamer_id: str, sessions: Sequence[Session], late: str = "1 hour"
) -> DataFrame:
    """Sold quantity per style and hour of the sessions, in long form.

    The same lines as the live board; an hour closes once the stream is `late`
    past its end. State is one sum per style and open hour. Event time is read in
    the session's zone: with UTC, windows are the hours of the day as written.
    """
    tagged = live_lines({"live_sales": lines}, streamer_id, sessions).filter(
        F.col("session").isNotNull()
    )
    return (
        tagged.withColumn("paid_at", F.col("paid_at").cast("timestamp"))
        .withWatermark("paid_at", late)
        .groupBy(F.window("paid_at", "1 hour"), "style_code")
        .agg(total("sold_qty").alias("sold_qty"))
        .select("style_code", hour_label("window.start").alias("hour"), "sold_qty")
    )
