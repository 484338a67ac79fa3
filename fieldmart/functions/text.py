"""Column functions for text: white space, case, accents, identifiers, codes."""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldmart.functions.bind import bind

# fixed values
NULL_TOKENS = ("", "none", "nan", "null")
TEST_BLOCK_WORDS = ("TEST", "BLOCK")
DASHES = "–—−"
APOSTROPHES = "’`"


def _accents() -> tuple[str, str]:
    """Latin letters with marks, and the letters that they decompose to."""
    pairs = []
    for code in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        bare = "".join(x for x in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(x))
        if len(bare) == 1 and bare != chr(code):
            pairs.append((chr(code), bare))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


ACCENTED, PLAIN = _accents()


def squeeze(c: Column) -> Column:
    """White space collapsed to one space and trimmed."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def title(c: Column) -> Column:
    """Every run of letters starts with a capital and goes on in lower case."""
    runs = F.regexp_extract_all(F.lower(c), F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(0))
    return F.array_join(F.transform(runs, lambda x: F.concat(F.upper(F.substring(x, 1, 1)), x.substr(F.lit(2), F.length(x)))), "")


def upper_squeeze(c: Column) -> Column:
    return F.upper(squeeze(c))


def strip_accents(c: Column) -> Column:
    """Letters without their marks, composed or combining; letters that don't decompose (ø, ß) stay."""
    return F.regexp_replace(F.translate(c, ACCENTED, PLAIN), "[\\u0300-\\u036f]", "")


def nullish(c: Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """NULL where the trimmed text, in any case, is one of the tokens."""
    return F.when(~F.lower(F.trim(c)).isin(*tokens), c)


def match_key(c: Column) -> Column:
    """Typographic variants of one name get one key: accents, dashes, apostrophes, spaces around -(), letter-digit gaps, case."""
    x = F.translate(strip_accents(squeeze(c)), DASHES + APOSTROPHES, "-" * len(DASHES) + "'" * len(APOSTROPHES))
    for pattern, to in ((r"\s*-\s*", "-"), (r"\s*\(\s*", "("), (r"\s*\)\s*", ")"), (r"([A-Za-z])\s+(\d)", "$1$2"), (r"(\d)\s+([A-Za-z])", "$1$2")):
        x = F.regexp_replace(x, pattern, to)
    return bind(F.upper(squeeze(x)), lambda key: nullish(key))


def compact_key(c: Column) -> Column:
    """Letters and digits of the match key; NULL if none."""
    return bind(F.regexp_replace(match_key(c), "[^A-Z0-9]+", ""), lambda x: F.nullif(x, F.lit("")))


def contains_any(c: Column, words: Sequence[str] = TEST_BLOCK_WORDS) -> Column:
    found = F.lit(False)
    for word in words:
        found = found | F.upper(c).contains(word)
    return F.coalesce(found, F.lit(False))


def last_number(c: Column) -> Column:
    """Last number in the text without leading zeros or a fraction of zeros; test-block texts and texts without a number stay, in upper case."""
    last = lambda text: F.try_element_at(F.regexp_extract_all(text, F.lit(r"([+-]?\d+(?:\.\d+)?)"), F.lit(1)), F.lit(-1))
    whole = lambda number: F.when(number.rlike(r"^[+-]?\d+(\.0+)?$"), number.try_cast("decimal(38,0)").cast("string")).otherwise(number)
    kept = lambda text: F.when(contains_any(text), text).otherwise(F.coalesce(bind(last(text), whole), text))
    return bind(upper_squeeze(c), lambda x: bind(nullish(x), kept))


def clean_numeric_text(c: Column) -> Column:
    """'25.0' becomes '25'; other text stays, squeezed."""
    text = squeeze(c)
    return F.coalesce(text.try_cast("double").try_cast("bigint").cast("string"), text)


def geo_token(c: Column) -> Column:
    """Lower-case token; whole numbers lose their fraction, '9.1' stays."""
    text = F.lower(squeeze(c))
    return F.when(text.rlike(r"^\d+\.0+$"), F.regexp_extract(text, r"^(\d+)", 1)).otherwise(text)


def split_version(c: Column) -> tuple[Column, Column]:
    """'9.1' gives 9 and 1; '9' gives 9 and NULL; other text two NULLs."""
    text = F.trim(c)
    return (F.regexp_extract(text, r"^(\d+)(?:\.(\d+))?$", 1).try_cast("int"), F.regexp_extract(text, r"^(\d+)\.(\d+)$", 2).try_cast("int"))


def clean_id(c: Column, size: int = 8) -> Column:
    """Fraction of zeros, dots and spaces removed, padded with zeros to `size`; longer ids stay as they are."""
    text = F.regexp_replace(F.regexp_replace(F.trim(c), r"\.0+$", ""), r"[. ]", "")
    return bind(text, lambda x: F.when(F.length(x) < size, F.when(x != "", F.lpad(x, size, "0"))).otherwise(x))


def valid_id(c: Column, size: int = 8) -> Column:
    return F.coalesce(c.rlike(rf"^[0-9]{{{size}}}$"), F.lit(False))


def state_key(c: Column) -> Column:
    """Unaccented upper-case words, all else one space."""
    return F.trim(F.regexp_replace(F.upper(strip_accents(c)), "[^A-Z0-9]+", " "))


def map_code(c: Column, codes: Mapping[str, str], keep: bool = True) -> Column:
    """Synonym table on the trimmed upper-case text; unknown text stays (or NULL with keep=False)."""
    key = F.nullif(F.upper(F.trim(c)), F.lit(""))
    table = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])
    found = F.try_element_at(table, key)
    return F.coalesce(found, key) if keep else found


def split_list(c: Column) -> Column:
    """JSON array, or items between newlines, commas, semicolons and bars; blank items go."""
    plain = F.transform(F.split(c, r"[\n,;|]+"), lambda x: F.trim(x))
    parsed = F.when(F.trim(c).startswith("["), F.from_json(c, "array<string>"))
    return F.filter(F.coalesce(F.transform(parsed, lambda x: F.trim(x)), plain), lambda x: x != "")


def eq_ci(a: Column, b: Column) -> Column:
    return F.lower(F.trim(a)) == F.lower(F.trim(b))


def compatible_type(c: Column, accepted: Sequence[str]) -> Column:
    """Blank passes; otherwise the normalised text equals or contains an accepted one."""
    key = F.lower(state_key(c))
    found = key.isNull() | (key == "")
    for text in accepted:
        found = found | key.contains(text.lower())
    return found
