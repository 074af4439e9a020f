"""Column expressions for text cleaning and number extraction.

All of these are built-in Spark SQL expressions (codegen, no Python per row).
Each keeps the missing-value semantics of the listing job: a failed parse or a
regex without a match gives NULL, never an empty string or NaN.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tableprep import config as C

# Whitespace as Python's str.isspace() defines it (what str.strip() removes),
# derived by rule over the code points rather than listed by hand.
WHITESPACE = ''.join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


_WS_CHARS = list(WHITESPACE)


def strip_ws(c) -> Column:
    """Strip leading/trailing Unicode whitespace (trim() only removes spaces).

    Fast path: plain space trim; the character-set trim (much slower per
    cell) runs only when the first or last character is still whitespace."""
    t = F.trim(col(c))
    edge = F.substring(t, 1, 1).isin(_WS_CHARS) | F.substring(t, -1, 1).isin(_WS_CHARS)
    return F.when(edge, F.btrim(t, F.lit(WHITESPACE))).otherwise(t)


def numeric(c) -> Column:
    """Guarded text → double: plain decimal numbers only, else NULL."""
    c = col(c)
    return F.when(c.rlike(C.NUMERIC_TEXT), F.trim(c).try_cast('double'))


def regex_group(text, pattern: str, group: int = 1) -> Column:
    """First match of `pattern` (group `group`), NULL when there is no match."""
    return F.nullif(F.regexp_extract(col(text), pattern, group), F.lit(''))


def number_in_text(text, pattern: str) -> Column:
    """First match of a number pattern, thousands separators removed → double."""
    return numeric(F.replace(F.regexp_extract(col(text), pattern, 1), F.lit(','), F.lit('')))  # numeric('') is missing


def _found_number(text, pattern: str) -> Column:
    """number_in_text() for a pattern whose group holds digits, separators and one
    point alone: needs no guard, so the pattern runs once."""
    return F.replace(F.regexp_extract(col(text), pattern, 1), F.lit(','), F.lit('')).try_cast('double')


# --- conversion rules (C12 / E1-E5) -----------------------------------------

def currency(c, prefix: str = C.PRICE_PREFIX) -> Column:
    """'RM 340 000' → 340000.0 (prefix and inner spaces removed)."""
    return numeric(F.replace(F.replace(col(c), F.lit(prefix), F.lit('')), F.lit(' '), F.lit('')))


def before_unit(c, pattern: str = C.SIZE_UNIT_PATTERN) -> Column:
    """'1,000.5 sq.ft.' → 1000.5 (number right before the unit)."""
    return _found_number(c, pattern) if pattern == C.SIZE_UNIT_PATTERN else number_in_text(c, pattern)


def digits(c) -> Column:
    """Keep only the digits of the text ('1000.5' → 10005)."""
    return numeric(F.nullif(F.regexp_replace(col(c), C.DIGITS_ONLY, ''), F.lit('')))


def first_decimal(c) -> Column:
    """First signed decimal number anywhere in the text."""
    return numeric(regex_group(c, C.FIRST_DECIMAL))


RULES = {
    'currency': currency,
    'before_unit': before_unit,
    'numeric': numeric,
    'digits': digits,
    'first_decimal': first_decimal,
}


# --- evidence extraction (E6-E9) ---------------------------------------------

def extract_size(text) -> Column:
    return _found_number(text, C.SIZE_PATTERN)


def extract_size_source(text) -> Column:
    """struct(value, is_land): a 'Land Area' figure wins over a generic mention."""
    land = _found_number(text, C.LAND_AREA_PATTERN)
    generic = extract_size(text)
    return F.struct(F.coalesce(land, generic).alias('value'),
                    land.isNotNull().alias('is_land'))


def extract_rooms(text, kind: str = 'bed') -> Column:
    pattern = C.BEDROOM_PATTERN if kind == 'bed' else C.BATHROOM_PATTERN
    return _found_number(text, pattern)


def extract_bedrooms_strict(text) -> Column:
    """Bedroom count that cannot span a line break ('SQFT : 3000\\nBEDROOMS')."""
    return _found_number(text, C.BEDROOM_STRICT_PATTERN)


# --- lists and segments (E12-E14) --------------------------------------------

def last_segment_match(c, vocab, sep: str = ',') -> Column:
    """Scan comma segments from the end; first whole-segment, case-insensitive
    match in `vocab`, returned in its canonical spelling."""
    lowered = {v.lower(): v for v in vocab}
    canon = F.create_map(*[x for k, v in lowered.items() for x in (F.lit(k), F.lit(v))])
    segs = F.transform(F.split(col(c), sep), lambda s: F.lower(strip_ws(s)))
    hits = F.filter(F.reverse(segs), lambda s: s.isin(list(lowered)))
    return F.element_at(canon, F.get(hits, 0))


_CASED = r'^[\p{Lu}\p{Ll}\p{Lt}]$'


def title_case(c) -> Column:
    """Python str.title(): upper-case a cased letter that follows an uncased
    character, lower-case the others ('house-bar' → 'House-Bar')."""
    c = col(c)
    chars = F.split(c, '')
    # where ASCII letters and spaces alone occur, initcap() says the same
    return F.when(c.rlike(r'^[A-Za-z ]*$'), F.initcap(c)).otherwise(F.array_join(F.transform(
        chars,
        lambda ch, i: F.when((i == 0) | ~F.element_at(chars, i).rlike(_CASED), F.upper(ch))
                       .otherwise(F.lower(ch))), ''))


def _items(c, sep: str = ',') -> Column:
    return F.transform(F.split(col(c), sep), lambda s: strip_ws(s))


def _keep_item(s) -> Column:
    return (s != '') & ~s.rlike(r'(?U)^\d+$')


def parse_list(c, sep: str = ',') -> Column:
    """Split, strip, title-case; drop empty and digit-only items. NULL → []."""
    items = F.filter(F.transform(_items(c, sep), title_case), _keep_item)
    return F.coalesce(items, F.array().cast('array<string>'))


def list_count(c, sep: str = ',') -> Column:
    """Number of listed items (empty and digit-only excluded); 0 when missing."""
    return F.coalesce(F.size(F.filter(_items(c, sep), _keep_item)), F.lit(0))
