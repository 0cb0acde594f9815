"""Join with time spans that stand in a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skuloom.operators.joins import lookup

#: Buckets of the narrowest width hold about so many starts and ends of spans, each next width is so many times the last,
#: and there are so many widths at most.
ENDS = 16
STEP = 32
LEVELS = 4
#: Seconds of the widths, for a table that says nothing of them.
WIDTHS = (3_600, 86_400, 32 * 86_400)

MICROS = 1_000_000


def _micros(c: Column) -> Column:
    """A timestamp as written, whatever its zone, in microseconds."""
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, c.cast("timestamp_ntz"))


def _bucket(micros: Column, width: int) -> Column:
    """Number of the bucket of that width, in microseconds, that a time lies in."""
    w = F.lit(width).cast("long")
    return F.call_function("div", micros - F.pmod(micros, w), w)


def _range(first: Column, last: Column) -> Column:
    """The numbers from first to last, none where there are none."""
    return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))


def _covered(s: Column, e: Column, widths: Sequence[int]) -> list[Column]:
    """Per width, the buckets that lie in a span as a whole but in no bucket of the next width that does."""
    whole = [(-_bucket(-s, w), _bucket(e + 1, w) - 1) for w in widths]
    out = []
    for i, (w, (first, last)) in enumerate(zip(widths, whole, strict=True)):
        if i == len(widths) - 1:
            out.append(_range(first, last))
            continue
        wider, (from_, to) = widths[i + 1], whole[i + 1]
        before = _range(first, F.least(last, _bucket(from_ * wider - 1, w)))
        after = _range(F.greatest(first, _bucket((to + 1) * wider, w)), last)
        out.append(F.when(from_ <= to, F.array_union(before, after)).otherwise(_range(first, last)))
    return out


def widths_of(spans: DataFrame, start: str, end: str) -> tuple[float, ...]:
    """Widths in seconds that suit the spans: one row is brought to the driver.

    The narrowest buckets hold about `ENDS` starts and ends each, counted over the time in which the middle 90 % of them lie, so
    that a few far dates do not widen them.
    """
    ends = spans.select(F.explode(F.array(_micros(F.col(start)), _micros(F.col(end)))).alias("at"))
    found = ends.agg(F.count("at").alias("n"), F.percentile_approx("at", [0.05, 0.95]).alias("middle")).first()
    if not found["n"]:
        return WIDTHS
    low, high = found["middle"]
    narrowest = max(1_000, int((high - low) / 0.9 * ENDS / found["n"]))
    return tuple(narrowest * STEP**i / MICROS for i in range(LEVELS))


def _lists(own: DataFrame, keys: Sequence[str], width: int) -> DataFrame:
    """Per bucket, the spans that start or end in it and do not cover it."""
    first, last = -_bucket(-F.col("_from"), width), _bucket(F.col("_to") + 1, width) - 1
    ends = F.array_distinct(F.array(_bucket(F.col("_from"), width), _bucket(F.col("_to"), width)))
    parts = own.select(*keys, "_span", F.explode(F.filter(ends, lambda b: (b < first) | (b > last))).alias("_at"))
    return parts.groupBy(*keys, "_at").agg(F.collect_list("_span").alias("_spans"))


def span_join(
    df: DataFrame,
    at: str,
    spans: DataFrame,
    take: Mapping[str, str] | Sequence[str],
    start: str = "start",
    end: str = "end",
    order: str = "_ord",
    on: Mapping[str, str] | None = None,
    widths: Sequence[float] | None = None,
    salt_rows: int | None = None,
) -> DataFrame:
    """Every row with columns of the last span, by `order`, that its time lies in, both ends included; null outside all.

    Time is cut into buckets of a few widths, by default as many as suit the spans (`widths_of`). Where a span covers a whole
    bucket, only the last span that does counts, one per bucket. It is cut into the widest buckets that it covers, some tens
    for each width. Only the narrowest buckets keep lists: of the spans that start or end in them, so that a span is in two
    lists at most, however long it is and however many overlap it. A row looks one span up per width, and the list of its
    narrowest bucket: plain equality joins, no pairs of rows and spans, and the row is never repeated. `on` (columns of `df` to
    columns of `spans`) keeps spans of different keys apart. A row without a time is in no span; a span without a start or end,
    or that ends before it starts, holds nothing. Spans of equal order go by their start, end and taken columns.
    """
    on = dict(on or {})
    take = dict(take) if isinstance(take, Mapping) else {c: c for c in take}
    fields = [F.col(order).alias("o"), F.col(start).cast("timestamp_ntz").alias("s"), F.col(end).cast("timestamp_ntz").alias("e")]
    span = F.struct(*fields, *[F.col(c).alias(f"t{i}") for i, c in enumerate(take)])
    valid = spans.filter(F.col(start) <= F.col(end))
    widths = [max(1, round(w * MICROS)) for w in sorted(widths or widths_of(valid, start, end))]
    own = valid.select(*on.values(), span.alias("_span")).withColumns({"_from": _micros(F.col("_span.s")), "_to": _micros(F.col("_span.e"))})
    covered = _covered(F.col("_from"), F.col("_to"), widths)
    time = F.col(at).cast("timestamp_ntz")

    # the row with `_last`, the last span found so far; lists come last, so that no shuffle carries them
    out = df.withColumn("_last", F.lit(None).cast(own.schema["_span"].dataType))
    for i in reversed(range(len(widths))):
        whole = own.select(*on.values(), "_span", F.explode(covered[i]).alias("_at"))
        winners = whole.groupBy(*on.values(), "_at").agg(F.max("_span").alias("_found"))
        out = out.withColumn("_at", _bucket(_micros(F.col(at)), widths[i]))
        out = lookup(out, winners, {**on, "_at": "_at"}, ["_found"], null_safe=False, salt_rows=salt_rows)
        out = out.withColumn("_last", F.greatest("_last", "_found")).drop("_found", "_at")

    lists = _lists(own, list(on.values()), widths[0])
    out = out.withColumn("_at", _bucket(_micros(F.col(at)), widths[0]))
    out = lookup(out, lists, {**on, "_at": "_at"}, ["_spans"], null_safe=False, salt_rows=salt_rows)
    held = F.array_max(F.filter("_spans", lambda x: (x["s"] <= time) & (time <= x["e"])))
    out = out.withColumn("_last", F.greatest("_last", held))
    return out.select(*df.columns, *[F.col("_last")[f"t{i}"].alias(name) for i, name in enumerate(take.values())])
