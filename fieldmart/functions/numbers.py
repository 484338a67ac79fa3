"""Column functions for numbers in text, shares, and durations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_decimal(c: Column, digits: int | None = None) -> Column:
    """Comma or dot decimals; NULL for junk, nan and infinities; half-up rounding to `digits`."""
    text = F.replace(F.trim(c), F.lit(","), F.lit("."))
    x = F.regexp_extract(text, r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d{1,2})?$", 0).try_cast("double")
    return x if digits is None else F.round(x, digits)


def to_int(c: Column, default: int | None = None, least: int | None = None) -> Column:
    """Truncated number; `default` for junk, and for numbers under `least`."""
    x = to_decimal(c).try_cast("int")
    if least is not None:
        x = F.when(x >= least, x)
    return x if default is None else F.coalesce(x, F.lit(default))


def extract_int(c: Column) -> Column:
    """The digits, dots and signs of a text as a truncated number."""
    return F.regexp_replace(c, r"[^0-9.\-]", "").try_cast("double").try_cast("int")


def int_token(c: Column) -> Column:
    """The number if the text is digits only."""
    return F.when(c.rlike("^[0-9]+$"), c.try_cast("int"))


def pct(part: Column, total: Column, digits: int = 2) -> Column:
    """Percentage, NULL unless the total is positive."""
    return F.when(total > 0, F.round(part / total * 100, digits))


def humidity_pct(c: Column) -> Column:
    """Fractions up to 1 become percentages; NULL outside 0 to 100."""
    x = F.when((c >= 0) & (c <= 1), c * 100).otherwise(c)
    return F.when((x >= 0) & (x <= 100), x)


def format_duration(seconds: Column) -> Column:
    """'45s', '3m 05s'."""
    s = seconds.cast("bigint")
    short = F.concat(s.cast("string"), F.lit("s"))
    return F.when(s < 60, short).otherwise(F.format_string("%dm %02ds", F.floor(s / 60), s % 60))


def ratio(num: Column, den: Column) -> Column:
    return F.when(den > 0, num / den)
