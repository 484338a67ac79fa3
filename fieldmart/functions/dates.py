"""Column functions for dates: formats, serials, calendars, seasons."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldmart.functions.bind import bind

# fixed values: the season, and serials
SEASON = ("2025-03-01", "2026-06-30")
OPEN_DOMAINS = ("clima", "historico", "induccion_floral", "tasa_crecimiento_brotes")
SERIAL_EPOCH = "1899-12-30"
SERIAL_RANGE = (30000, 60000)
HARVEST_BASE = "2025-03-01"


def excel_serial(c: Column, low: int = SERIAL_RANGE[0], high: int = SERIAL_RANGE[1]) -> Column:
    """Date of a spreadsheet serial day number within bounds."""
    n = F.floor(c.try_cast("double")).try_cast("int")
    return F.when((n >= low) & (n <= high), F.date_add(F.lit(SERIAL_EPOCH).cast("date"), n))


_TIME = r"(?: (\d{1,2}:\d{1,2}(?::\d{1,2}(?:\.\d+)?)?(?: ?[apAP]\.?[mM]\.?)?))?"
_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"


def _squeezed(c: Column) -> Column:
    """Trimmed, with single spaces and a space for each T."""
    return F.trim(F.regexp_replace(F.replace(c, F.lit("T"), F.lit(" ")), r"(?U)\s+", " "))


_DATED = r"^\d{1,4}[-/.]\d{1,2}[-/.]\d{1,4}( |$)|^\d{8}( |$)"


def _at(iso: Column) -> Column:
    """Timestamp of y-m-d [h:m[:s]]: the cast of Spark reads it without exceptions."""
    return iso.try_cast("timestamp")


def _short(text: Column) -> Column:
    """nn/nn/nn or nn-nn-nn, with a time or not, of a squeezed text."""
    shape = r"^(\d\d)([/-])(\d\d)\2(\d\d)(?: (\d{1,2}:\d\d(?::\d\d)?))?$"

    def made(order: str) -> Column:
        full = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, shape, order), r"^(69|[7-9]\d)-", "19$1-"), r"^(\d\d)-", "20$1-")
        return _at(F.trim(full))

    ymd, dmy = made("$1-$3-$4 $5"), made("$4-$3-$1 $5")
    year_first = (F.substring(text, 1, 2) >= "20") & (F.substring(text, 7, 2) <= "31")
    return F.when(text.rlike(shape), F.when(year_first, F.coalesce(ymd, dmy)).otherwise(F.coalesce(dmy, ymd)))


def parse_short_date(c: Column) -> Column:
    """nn/nn/nn or nn-nn-nn, with a time or not: year first if the first part is 20 or more and the third a day; the other order is the second try."""
    return bind(_squeezed(c), _short)


def _half_days(iso: Column) -> Column:
    """y-m-d h:m[:s] am or pm as 24 hours; NULL where there is neither."""
    hour = F.regexp_extract(iso, r" (\d{1,2}):", 1).try_cast("int")
    pm = iso.rlike(r"(?i)p\.?m\.?$")
    turned = F.when((hour >= 1) & (hour <= 12) & iso.rlike(r"(?i)\d ?[ap]\.?m\.?$"), hour % 12 + F.when(pm, 12).otherwise(0))
    return F.concat(F.regexp_extract(iso, r"^(\S+)", 1), F.lit(" "), turned.cast("string"), F.regexp_extract(iso, r"(:\d{1,2}(?::\d{1,2}(?:\.\d+)?)?) ?[apAP]", 1))


def _named_months(text: Column) -> Column:
    """'5 mar 2025 [time]' and 'march 5, 2025 [time]' as y-m-d."""
    name = F.lower(F.regexp_extract(text, r"([A-Za-z]{3})[A-Za-z]*\.?[ ,-]", 1))
    at = F.call_function("locate", name, F.lit(_MONTHS))
    month = F.when((F.length(name) == 3) & (at % 3 == 1), ((at + 2) / 3).cast("int").cast("string"))
    day_first = r"^(\d{1,2})[ .-]*(?:de |of )?[A-Za-z]{3,9}\.?[ ,-]*(?:de |of )?(\d{4})" + _TIME + "$"
    month_first = r"^[A-Za-z]{3,9}\.? (\d{1,2})(?:st|nd|rd|th)?,? (\d{4})" + _TIME + "$"
    parts = lambda shape: F.trim(F.concat(F.regexp_extract(text, shape, 2), F.lit("-"), month, F.lit("-"), F.regexp_extract(text, shape, 1), F.lit(" "), F.regexp_extract(text, shape, 3)))
    return F.when(text.rlike(day_first), parts(day_first)).when(text.rlike(month_first), parts(month_first))


def parse_datetime(c: Column) -> Column:
    """A date with or without a time, by its shape: year first, day first with a year of four digits or two, eight digits, a short date, a serial.

    What the shape can't be in its own order (day 03, month 25) is tried in the other; a time may have fractions of a
    second or am and pm; English month names are read. NULL if nothing fits. Patterns rewrite each shape as y-m-d, and one
    cast builds the value, so that a miss costs no exception.
    """
    year, day, eight = r"^(\d{4})([-/])(\d{1,2})\2(\d{1,2})" + _TIME + "$", r"^(\d{1,2})([-/.])(\d{1,2})\2(\d{4})" + _TIME + "$", r"^(\d{4})(\d\d)(\d\d)" + _TIME + "$"
    iso = lambda text: F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(text, year, "$1-$3-$4 $5"), day, "$4-$3-$1 $5"), eight, "$1-$2-$3 $4"))
    turned = lambda x: F.regexp_replace(x, r"^(\d{4})-(\d{1,2})-(\d{1,2})", "$1-$3-$2")
    read = lambda x: F.coalesce(_at(x), _at(turned(x)))

    brief = r"^(\d{1,2})([-/.])(\d{1,2})\2(\d\d)" + _TIME + "$"
    century = lambda x: F.regexp_replace(F.regexp_replace(x, r"^(69|[7-9]\d)-", "19$1-"), r"^(\d\d)-", "20$1-")

    def loose(text: Column) -> Column:
        """One or two digits for the day and the month, two for the year: day first."""
        x = F.trim(century(F.regexp_replace(text, brief, "$4-$3-$1 $5")))
        return F.when(text.rlike(brief), bind(F.coalesce(_half_days(x), x), read))

    def found(text: Column) -> Column:
        named = F.when(text.rlike("[A-Za-z]{3}"), bind(_named_months(text), lambda x: _at(F.coalesce(_half_days(x), x))))
        dated = bind(iso(text), lambda x: F.coalesce(_at(x), _short(text), F.when(text.rlike("[aApP]"), bind(_half_days(x), read)), _at(turned(x)), loose(text)))
        serial = F.when(text.rlike(r"^\d{5}(\.\d+)?$"), excel_serial(text).cast("timestamp"))
        return F.when(text.rlike(_DATED) & (F.length(text) >= 6), dated).otherwise(F.coalesce(serial, named))

    return bind(_squeezed(c), found)


def date_id(c: Column) -> Column:
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def iso_week(c: Column) -> Column:
    return F.weekofyear(c)


def iso_weekday(c: Column) -> Column:
    """1 for Monday to 7 for Sunday."""
    return F.weekday(c) + 1


def harvest_week(c: Column, base: str = HARVEST_BASE) -> Column:
    """1 plus the Sundays crossed since the base date."""
    sundays = lambda d: F.floor(F.datediff(d, F.lit("1899-12-31").cast("date")) / 7)
    return (sundays(c) - sundays(F.lit(base).cast("date")) + 1).cast("int")


def in_season(c: Column, domain: str | None = None, low: str = SEASON[0], high: str = SEASON[1]) -> Column:
    if domain in OPEN_DOMAINS:
        return c.isNotNull()
    return F.coalesce(c.cast("date").between(F.lit(low).cast("date"), F.lit(high).cast("date")), F.lit(False))


def time_of_day(c: Column) -> Column:
    """First h:mm[:ss] of a text as h:mm:ss."""
    found = F.nullif(F.regexp_extract(c, r"(\d{1,2}:\d{2}(?::\d{2})?)", 1), F.lit(""))
    return F.when(F.length(found) <= 5, F.concat(found, F.lit(":00"))).otherwise(found)


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start)


def weeks_since(start: Column, end: Column) -> Column:
    return F.floor(F.datediff(end, start) / 7).cast("int")


def first_of(columns: list[Column]) -> Column:
    return reduce(lambda a, b: F.coalesce(a, b), columns)
