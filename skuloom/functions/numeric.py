"""Numbers: rounding, ratios, exact sums, tolerant parsing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

# A double is added in words of 22 bits, two above and three below the binary point, each in a 64-bit integer of its own.
# The parts of a double from 2^-66 on add up without rounding, so that a result does not depend on the order in which
# the shuffle delivers the rows; sums may reach 10^25, groups 10^12 rows. Beyond that, doubles are first scaled by their
# exponent band (`band`): those of band b lie from 2^(68 b - 13) up to 2^(68 b + 55), so that scaled down by 2^(68 b) they fit
# the words. Band 0 holds all ordinary numbers.
WORD = float(1 << 22)
WORDS = 5
LARGEST = float(1 << 85)
BAND_BITS = 68
ORDINARY = (2.0**-13, 2.0**55)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_even(c: Column | str, digits: int = 0) -> Column:
    """Round half to even on the scaled double."""
    scale = float(10**digits)
    return F.rint(_col(c) * F.lit(scale)) / F.lit(scale)


def ratio(n: Column | str, d: Column | str, digits: int | None = None) -> Column:
    """n / d, null where d is 0, rounded if asked."""
    out = F.try_divide(_col(n), _col(d))
    return out if digits is None else round_even(out, digits)


def finite(c: Column | str) -> Column:
    """The number as double; what is no number or infinite counts as missing."""
    c = _col(c).cast("double")
    # a NaN is larger than all numbers
    return F.when(F.abs(c) < F.lit(float("inf")), c)


def split_words(x: Column) -> list[Column]:
    """The whole-number words of a finite double below `LARGEST`, largest first, all with its sign. They take no rounding:
    a remainder is exact, a cast cuts off."""
    part = x % 1.0 * WORD
    out = [(x / WORD).cast("long"), (x % WORD).cast("long")]
    for _ in range(WORDS - 2):
        out.append(part.cast("long"))
        part = part % 1.0 * WORD
    return out


def split_columns(df: DataFrame, names: Sequence[str]) -> tuple[DataFrame, dict[str, list[Column]]]:
    """The same words of columns of finite doubles, each step computed once per row and without remainders of doubles,
    which are slow. A number from 2^62 on raises."""
    size = F.lit(1 << 22)
    too_large = F.raise_error(F.lit("numbers from 4.6e18 on need group_sum with any_size")).cast("long")
    df = df.withColumns({f"{m}_i": F.when(F.abs(m) >= float(1 << 62), too_large).otherwise(F.col(m).cast("long")) for m in names})
    df = df.withColumns({f"{m}_f": (F.col(m) - F.col(f"{m}_i").cast("double")) * (WORD * WORD) for m in names})
    df = df.withColumns({f"{m}_t": F.col(f"{m}_f").cast("long") for m in names})

    def parts(m: str) -> list[Column]:
        i, f, t = (F.col(f"{m}_{k}") for k in "ift")
        last = ((f - t.cast("double")) * WORD).cast("long")
        return [F.call_function("div", i, size), i % size, F.call_function("div", t, size), t % size, last]

    return df, {m: parts(m) for m in names}


def words(c: Column | str) -> list[Column]:
    """The words of a double; null for a missing number. A number whose words do not fit raises."""
    x = finite(c)
    first, *others = split_words(x)
    too_large = F.raise_error(F.lit(f"sums from {LARGEST:.1e} on need group_sum or running_sum")).cast("long")
    return [F.when(F.abs(x) >= LARGEST, too_large).otherwise(first), *others]


def band(x: Column) -> Column:
    """Exponent band of a finite double; null for 0 and for a missing number, which fit any."""
    size = F.abs(x)
    ordinary = (size >= ORDINARY[0]) & (size < ORDINARY[1])
    # a band has a bit to spare on either side, for the rounding of the logarithm
    other = F.floor((F.log2(size) + 13) / BAND_BITS).cast("int")
    return F.when(ordinary, F.lit(0)).when(size > 0, other)


def shifted(x: Column, bands: Column, up: bool = False) -> Column:
    """A double times 2^(68 b) if `up`, else divided by it; in two steps, as the factor may have no double itself."""
    half = BAND_BITS // 2 if up else -BAND_BITS // 2
    # a power of whole numbers is exact
    factor = F.pow(F.lit(2.0), bands * half)
    return F.when(F.coalesce(bands, F.lit(0)) == 0, x).otherwise(x * factor * factor)


def joined(sums: Sequence[Column | str]) -> Column:
    """The double of summed words; nothing to add is 0."""
    parts = [F.coalesce(_col(s), F.lit(0).cast("long")).cast("double") for s in sums]
    out = parts[-1]
    for part in reversed(parts[1:-1]):
        out = part + out / WORD
    return parts[0] * WORD + out


def total(c: Column | str, over: WindowSpec | None = None) -> Column:
    """Sum aggregate, or sum over a window: 0 where there is nothing to add, independent of row order.

    For numbers below 10^25; larger ones raise, parts under 2^-66 are left out. `group_sum` and `running_sum` add any doubles.
    """
    sums = [F.sum(w) for w in words(c)]
    return joined(sums if over is None else [s.over(over) for s in sums])


def to_number(c: Column | str) -> Column:
    """Finite number of a text, null for a text that is none."""
    c = _col(c).cast("string")
    # the cast also reads Java's type suffixes ("12d"), which are no numbers here
    return finite(F.when(~c.rlike(r"[0-9.][dDfF]\s*$"), c.try_cast("double")))


def to_whole(c: Column | str) -> Column:
    """Whole number of a text, digit by digit where it is one, else the whole part of a finite number; null for others."""
    text = _col(c).cast("string")
    return F.coalesce(F.trim(text).try_cast("long"), to_number(text).try_cast("long"))


def zero(c: Column | str) -> Column:
    """Null as 0."""
    return F.coalesce(_col(c), F.lit(0.0))
