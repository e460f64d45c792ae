"""Column functions: pure expressions that stay in Spark's own code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Texts that count as empty besides null, after trimming and lower-casing (fixed values).
EMPTY_WORDS = ("null", "", "()", "[]", "{}")
#: Layouts of test timestamps, in the order in which they are tried.
TIMESTAMP_LAYOUTS = ("yyyy-M-d H:m:s", "d.M.yy h:mm a", "d.M.yy H:m", "d.M.yyyy H:m:s", "d.M.yyyy H:m", "d.M.yy h:mma")
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def normalize_orcid(c: Column) -> Column:
    """An ORCID in any usual form as a dashed URL; null unless 16 characters of 0-9 and X are left."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(c), r"^https?://orcid\.org/", ""), "[^0-9X]", "")
    dashed = F.concat_ws("-", *[F.substring(bare, at, 4) for at in (1, 5, 9, 13)])
    return F.when(F.length(bare) == 16, F.concat(F.lit("https://orcid.org/"), dashed))


def clean_text(c: Column, max_words: int = 500) -> Column:
    """Text without tags and with single blanks; beyond max_words words the first ones and ``...``."""
    flat = F.trim(F.regexp_replace(F.regexp_replace(c, "<[^>]+>", ""), r"(?U)\s+", " "))
    words = F.split(flat, " ")
    return F.when(F.size(words) > max_words, F.concat(F.array_join(F.slice(words, 1, max_words), " "), F.lit("..."))).otherwise(flat)


def year_of(c: Column) -> Column:
    """The year that a date text starts with, or null."""
    return F.substring(c, 1, 4).try_cast("int")


def composed_id(*parts: Column) -> Column:
    return F.concat_ws("_", *parts)


def standard_name(c: Column) -> Column:
    """A standard's name without its edition: what stands before the first colon, trimmed."""
    return F.trim(F.substring_index(c, ":", 1))


def is_emptyish(c: Column) -> Column:
    """Null, or a text that stands for nothing."""
    return c.isNull() | F.lower(F.trim(c.cast("string"))).isin(*EMPTY_WORDS)


def is_emptyish_array(c: Column) -> Column:
    return c.isNull() | (F.size(c) == 0)


def otherwise(a: Column, b: Column) -> Column:
    """a unless it is emptyish, else b. Write a with try_ functions where it could fail."""
    return F.when(~is_emptyish(a), a).otherwise(b)


def parse_timestamp(c: Column) -> Column:
    """A timestamp without zone from the first layout that fits. Two-digit years from 69 on are 19xx.

    The look of a text leaves one layout that may fit (two, where it has a.m. or p.m.), so it is parsed once at most."""
    text = F.trim(c)
    century = lambda t: F.when(t >= F.lit("2069-01-01").cast("timestamp_ntz"), t - F.make_ym_interval(F.lit(100), F.lit(0))).otherwise(t)

    def read(layout: str) -> Column:
        value = F.try_to_timestamp(text, F.lit(layout)).cast("timestamp_ntz")
        # as an array's only element, so that it is parsed once
        return value if "yyyy" in layout else F.get(F.transform(F.array(value), century), F.lit(0))

    dashed, spaced, short, seconds, long, joined = map(read, TIMESTAMP_LAYOUTS)
    look = F.when(~text.rlike(r"^[+-]?[0-9]+[.-][0-9]+[.-][0-9]+ [0-9]"), F.lit(None).cast("timestamp_ntz")).when(F.contains(text, F.lit("-")), dashed).when(text.rlike("[A-Za-z]"), F.coalesce(spaced, joined))
    return look.when(text.rlike(r"^[0-9]+\.[0-9]+\.[0-9]{2} "), short).when(text.rlike(":[0-9]*:"), seconds).otherwise(long)


def parse_number(c: Column) -> Column:
    """A double where the text is a plain finite number, else null."""
    return F.when(F.trim(c).rlike(NUMBER), F.trim(c).try_cast("double"))


def parse_percent(c: Column) -> Column:
    """A ratio from a percentage with or without its sign."""
    return parse_number(F.replace(c, F.lit("%"), F.lit(""))) / 100


def parse_orientation(c: Column) -> Column:
    """Degrees from a short text that starts with a number, after an optional direction such as <001>."""
    plain = F.trim(F.replace(c, F.lit("°"), F.lit("")))
    return F.when(F.length(plain) < 50, parse_number(F.nullif(F.regexp_extract(plain, r"^(?:<[0-9]+>)?[,\s]*([0-9.]+)", 1), F.lit(""))))


def iso_duration(start: Column, end: Column) -> Column:
    """ISO 8601 duration of days, hours, minutes and seconds without zero parts; PT0S unless end is after start."""
    seconds = F.timestamp_diff("SECOND", start, end)
    days, hours, minutes, rest = F.floor(seconds / 86400), F.floor(seconds / 3600) % 24, F.floor(seconds / 60) % 60, seconds % 60
    part = lambda n, unit: F.when(n > 0, F.concat(n.cast("long").cast("string"), F.lit(unit))).otherwise(F.lit(""))
    time = F.concat(part(hours, "H"), part(minutes, "M"), part(rest, "S"))
    whole = F.concat(F.lit("P"), part(days, "D"), F.when(time != "", F.concat(F.lit("T"), time)).otherwise(F.lit("")))
    return F.when(seconds > 0, whole).otherwise(F.lit("PT0S"))


def number_text(c: Column) -> Column:
    """A double as text with a decimal point and without an exponent for everyday sizes, with all its digits."""
    plain = c.cast("string")
    wide = F.rtrim(plain.cast("decimal(38,21)").cast("string"), F.lit("0"))  # 17 digits at most, from the fourth place on
    wide = F.when(wide.endswith("."), F.concat(wide, F.lit("0"))).otherwise(wide)
    return F.when((F.abs(c) >= 1e7) & (F.abs(c) < 1e16) | (F.abs(c) < 1e-3) & (F.abs(c) >= 1e-4), wide).otherwise(plain)
