"""Timestamps, dates, elapsed time. Nothing here reads the clock."""

from __future__ import annotations

import datetime as dt
import heapq
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from skuloom import constants as K


class Session(NamedTuple):
    """Labelled time span, both ends included."""

    label: str
    start: dt.datetime
    end: dt.datetime


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_ts(c: Column | str, strict: bool = False) -> Column:
    """Timestamp without zone; a bad text raises if strict, else reads null.

    Besides 2024-01-02, texts may say 2024/01/02 or 20240102, each with a time behind it.
    """
    c = _col(c)
    text = F.regexp_replace(F.trim(c.cast("string")), r"^(\d{4})/(\d{1,2})/(\d{1,2})", "$1-$2-$3")
    text = F.regexp_replace(text, r"^(\d{4})(\d{2})(\d{2})(?=$|[ T])", "$1-$2-$3")
    plain = c.try_cast("timestamp_ntz")
    return F.coalesce(plain, text.cast("timestamp_ntz") if strict else text.try_cast("timestamp_ntz"))


def day_of(c: Column | str) -> Column:
    return _col(c).cast("date")


def day_text(c: Column | str) -> Column:
    """Date as "yyyy-MM-dd"."""
    return day_of(c).cast("string")


def within_days(c: Column | str, as_of: dt.date, back: int) -> Column:
    """From `back` days before `as_of` up to the day before it.

    Compares the raw timestamp with two literals, so that the filter reaches the scan.
    """
    first = dt.datetime.combine(as_of - dt.timedelta(days=back), dt.time())
    end = dt.datetime.combine(as_of, dt.time())
    c = _col(c)
    return (c >= _ts(first)) & (c < _ts(end))


def hour_label(c: Column | str) -> Column:
    """Hour of a timestamp as "MM.dd HH:00-HH:00", whatever the session's zone."""
    c = _col(c).cast("timestamp_ntz")
    start = c.cast("string")
    end = (c + F.expr("INTERVAL 1 HOUR")).cast("string")

    def part(text: Column, at: int) -> Column:
        return F.substr(text, F.lit(at), F.lit(2))

    return F.concat(
        part(start, 6), F.lit("."), part(start, 9), F.lit(" "), part(start, 12),
        F.lit(":00-"), part(end, 12), F.lit(":00"),
    )


def elapsed_days(start: Column | str, end: Column | str) -> Column:
    """Days between two timestamps, with fraction."""
    micros = F.timestamp_diff("MICROSECOND", _col(start), _col(end))
    return micros / F.lit(1e6) / F.lit(86400.0)


def age_bin(days: Column | str) -> Column:
    """Age label of a number of days; null for null or for a month or more ahead."""
    months = _col(days) / F.lit(K.DAYS_PER_MONTH)
    out = F.when(months <= K.AGE_EDGES[0], F.lit(None))
    for edge, text in zip(K.AGE_EDGES[1:], K.AGE_LABELS):
        out = out.when(months <= edge, F.lit(text))
    return out.when(months.isNotNull(), F.lit(K.AGE_LABELS[-1]))


def segments(sessions: Sequence[Session]) -> list[Session]:
    """The spans without overlaps, by time: the last of overlapping spans wins."""
    tick = dt.timedelta(microseconds=1)
    edges = sorted({s.start for s in sessions} | {s.end + tick for s in sessions})
    found: list[Session] = []
    # spans that have begun, by their place in the list; those that have ended are dropped when they come up
    begun: list[tuple[int, Session]] = []
    waiting = sorted(((s.start, -i, s) for i, s in enumerate(sessions)), key=lambda x: x[:2])
    at = 0
    for start, end in zip(edges, edges[1:], strict=False):
        while at < len(waiting) and waiting[at][0] <= start:
            heapq.heappush(begun, waiting[at][1:])
            at += 1
        while begun and begun[0][1].end < start:
            heapq.heappop(begun)
        if begun:
            label = begun[0][1].label
            if found and found[-1].label == label and found[-1].end + tick == start:
                found[-1] = found[-1]._replace(end=end - tick)
            else:
                found.append(Session(label, start, end - tick))
    return found


def session_label(c: Column | str, sessions: Sequence[Session]) -> Column:
    """Label of the span a timestamp lies in, null outside; the last of overlapping spans wins.

    The spans are a parameter of a report. They become disjoint and are searched by halves, so that a row meets a few
    comparisons however many there are.
    """
    c = _col(c)

    def search(spans: list[Session]) -> Column:
        if len(spans) == 1:
            return F.when(c.between(_ts(spans[0].start), _ts(spans[0].end)), F.lit(spans[0].label))
        half = len(spans) // 2
        return F.when(c < _ts(spans[half].start), search(spans[:half])).otherwise(search(spans[half:]))

    found = segments(sessions)
    return search(found) if found else F.lit(None).cast("string")


def within_sessions(c: Column | str, sessions: Sequence[Session]) -> Column:
    """From the first start to the last end; plain comparisons, which reach the scan."""
    if not sessions:
        return F.lit(False)
    return (_col(c) >= _ts(min(s.start for s in sessions))) & (_col(c) <= _ts(max(s.end for s in sessions)))


def session_hours(sessions: Sequence[Session]) -> list[str]:
    """Hour labels that the sessions touch, by time."""
    hours = set()
    for s in sessions:
        hour = s.start.replace(minute=0, second=0, microsecond=0)
        while hour <= s.end:
            hours.add(hour)
            hour += dt.timedelta(hours=1)
    labels = [
        f"{h:%m.%d %H}:00-{h + dt.timedelta(hours=1):%H}:00" for h in sorted(hours)
    ]
    return list(dict.fromkeys(labels))


def _ts(value: dt.datetime) -> Column:
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
