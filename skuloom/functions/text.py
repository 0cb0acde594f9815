"""Text columns: codes, colour/spec texts, titles, tags."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from skuloom import constants as K

# Every Unicode white-space character; Spark's plain trim removes blanks only.
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove leading and trailing white space of any kind."""
    return F.trim(_col(c), F.lit(WHITESPACE))


def code(c: Column | str) -> Column:
    """Normalised code: stripped and upper-cased."""
    return F.upper(strip(c))


def join_key(*cols: Column | str) -> Column:
    """Concatenation that is null as soon as one part is null."""
    return F.concat(*[_col(c) for c in cols])


def text_key(*cols: Column | str) -> Column:
    """Concatenation in which a missing part reads 'nan'."""
    return F.concat(*[F.coalesce(_col(c).cast("string"), F.lit("nan")) for c in cols])


def head_of(c: Column | str) -> Column:
    """Text before the first ';' (the whole text without one)."""
    return F.substring_index(_col(c), ";", 1)


def tail_of(c: Column | str) -> Column:
    """Text after the first ';', null without one."""
    c = _col(c)
    return F.when(F.contains(c, F.lit(";")), F.substr(c, F.instr(c, ";") + 1))


def color_of(c: Column | str) -> Column:
    """Colour of a one-line "colour;spec" text; other texts are colour as a whole."""
    c = _col(c)
    return (
        F.when(~F.contains(c, F.lit(";")), c)
        .when(~F.contains(c, F.lit("\n")), head_of(c))
        .when(c.rlike(K.COLOR_SPEC_PATTERN), F.regexp_extract(c, K.COLOR_SPEC_PATTERN, 1))
        .otherwise(c)
    )


def spec_of(c: Column | str) -> Column:
    """Spec of a one-line "colour;spec" text, else null."""
    c = _col(c)
    return (
        F.when(~F.contains(c, F.lit(";")), F.lit(None))
        .when(~F.contains(c, F.lit("\n")), F.substr(c, F.instr(c, ";") + 1))
        .when(c.rlike(K.COLOR_SPEC_PATTERN), F.regexp_extract(c, K.COLOR_SPEC_PATTERN, 2))
    )


def strip_brackets(c: Column | str) -> Column:
    """Remove bracketed suffixes such as "(cm)" or "【cm】"."""
    out = _col(c)
    for pattern in K.BRACKET_PATTERNS:
        out = F.regexp_replace(out, "(?U)" + pattern, "")
    return out


def bracket_title(c: Column | str) -> Column:
    """First 【…】 group of a title, else the title itself."""
    c = _col(c)
    return F.coalesce(F.nullif(F.regexp_extract(c, K.TITLE_PATTERN, 1), F.lit("")), c)


def matches(c: Column | str, pattern: str) -> Column:
    """True where the text contains the pattern; null counts as no match."""
    return F.coalesce(_col(c).rlike(pattern), F.lit(False))


def label(condition: Column, yes: str, no: str = "") -> Column:
    """Boolean to label."""
    return F.when(condition, F.lit(yes)).otherwise(F.lit(no))


def tags(c: Column | str, pairs=K.EXCLUSIVE_TAGS) -> Column:
    """Concatenated tags of all the texts found in a remark."""
    return F.concat(*[label(matches(c, text), tag) for text, tag in pairs])


def unescape_plus(c: Column | str) -> Column:
    """Write an escaped plus sign as '+'."""
    return F.replace(_col(c), F.lit(K.ESCAPED_PLUS), F.lit("+"))


def id_head(c: Column | str) -> Column:
    """Id that went through a float: text before the first '.', stripped."""
    return strip(F.substring_index(_col(c).cast("string"), ".", 1))


def null_tokens(c: Column | str, tokens=K.MISSING_TOKENS) -> Column:
    """Stripped text with the missing tokens as null."""
    c = strip(_col(c).cast("string"))
    return F.when(~c.isin(*tokens), c)


def map_values(c: Column | str, mapping: Mapping[str, str], default: str) -> Column:
    """Value of a fixed mapping, a default for everything else."""
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), _col(c)), F.lit(default))
