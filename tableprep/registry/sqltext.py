"""SQL text of the listing stages, for the DuckDB oracles.

Each function returns CTE fragments ("name AS (...)") that chain on the
`listings` fixture view, mirroring the Spark stages in plans/prepare.py.
RE2 (DuckDB) has no look-ahead: `(?!\\w)` is written `(?:\\W|$)`, which
selects the same group 1.
"""

from __future__ import annotations

from tableprep import config as C
from tableprep.sources.fixtures import LISTING_COLUMNS, LISTINGS_CTE

STR_COLS = LISTING_COLUMNS[1:]
NUMERIC_COLS = ['bedroom', 'bathroom', 'completion_year', 'floors', 'total_units', 'parking_lot']
TYPED_DOUBLE = ['price', 'property_size'] + NUMERIC_COLS
HALF = int(C.TEST_FRACTION * 4294967296)


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def in_list(vals) -> str:
    return "(" + ", ".join(lit(v) for v in vals) + ")"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def numeric(x: str) -> str:
    return (f"CASE WHEN regexp_matches({x}, {lit(C.NUMERIC_TEXT)}) "
            f"THEN TRY_CAST(trim({x}) AS DOUBLE) END")


def group(x: str, pattern: str) -> str:
    return f"nullif(regexp_extract({x}, {lit(pattern)}, 1), '')"


def number_in_text(x: str, pattern: str) -> str:
    return numeric(f"replace({group(x, pattern)}, ',', '')")


SIZE_RE2 = C.SIZE_PATTERN.replace('(?!\\w)', '(?:\\W|$)')


def extract_size(x: str) -> str:
    return number_in_text(x, SIZE_RE2)


def extract_land(x: str) -> str:
    return number_in_text(x, C.LAND_AREA_PATTERN)


def rooms(x: str, kind: str) -> str:
    return numeric(group(x, C.BEDROOM_PATTERN if kind == 'bed' else C.BATHROOM_PATTERN))


def rooms_strict(x: str) -> str:
    return numeric(group(x, C.BEDROOM_STRICT_PATTERN))


def currency(x: str) -> str:
    return numeric(f"replace(replace({x}, 'RM', ''), ' ', '')")


def before_unit(x: str) -> str:
    return number_in_text(x, C.SIZE_UNIT_PATTERN)


def digits(x: str) -> str:
    return numeric(f"nullif(regexp_replace({x}, '[^0-9]', '', 'g'), '')")


def first_decimal(x: str) -> str:
    return numeric(group(x, C.FIRST_DECIMAL))


def state(x: str) -> str:
    low = {s.lower(): s for s in C.VALID_STATES}
    segs = f"list_transform(string_split({x}, ','), lambda s: lower({strip('s')}))"
    hit = f"list_filter(list_reverse({segs}), lambda s: s IN {in_list(low)})[1]"
    cases = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in low.items())
    return f"(CASE {hit} {cases} END)"


def _item_keep(v: str) -> str:
    return f"({v} <> '' AND NOT regexp_matches({v}, '^[0-9]+$'))"


def title(x: str) -> str:
    chars = f"string_split({x}, '')"
    return (f"array_to_string(list_transform({chars}, lambda ch, i: CASE WHEN i = 1 OR NOT "
            f"regexp_matches({chars}[i - 1], '^[A-Za-z]$') THEN upper(ch) ELSE lower(ch) END), '')")


def parse_list(x: str) -> str:
    items = f"list_transform(string_split({x}, ','), lambda s: {strip('s')})"
    return (f"coalesce(list_filter(list_transform({items}, lambda s: {title('s')}), "
            f"lambda s: {_item_keep('s')}), [])")


def list_count(x: str) -> str:
    items = f"list_transform(string_split({x}, ','), lambda s: {strip('s')})"
    return f"CAST(coalesce(len(list_filter({items}, lambda s: {_item_keep('s')})), 0) AS INTEGER)"


def fingerprint(cols) -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), chr(2))" for c in cols)
    return f"md5(concat_ws(chr(1), {parts}))"


def completeness(cols) -> str:
    return " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in cols)


def row_order(cols) -> str:
    """Merge priority as sortable text: missing cells with leading zeros, then the md5 fingerprint."""
    return f"printf('%06d', {len(cols)} - ({completeness(cols)})) || {fingerprint(cols)}"


def split_case(key: str = 'ad_id', seed: int = C.SPLIT_SEED) -> str:
    h = f"('0x' || substr(md5('{seed}|' || coalesce(CAST({key} AS VARCHAR), chr(0))), 1, 8))::BIGINT"
    return f"CASE WHEN {h} < {HALF} THEN 'test' ELSE 'train' END"


# --- stage CTEs -----------------------------------------------------------------------

def clean_cte() -> str:
    sel = ", ".join(f"CASE WHEN {strip(c)} IN {in_list(C.CANDIDATE_SENTINELS)} THEN NULL "
                    f"ELSE {strip(c)} END AS {c}" for c in STR_COLS)
    return f"clean AS (SELECT ad_id, {sel} FROM listings)"


def merged_cte() -> str:
    cols = LISTING_COLUMNS
    agg = ", ".join(f"arg_min({c}, __o) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in STR_COLS)
    return (f"exact AS (SELECT DISTINCT * FROM clean), "
            f"ranked AS (SELECT *, {row_order(cols)} AS __o FROM exact), "
            f"merged AS (SELECT ad_id, {agg} FROM ranked WHERE ad_id IS NOT NULL GROUP BY ad_id)")


def scoped_cte() -> str:
    return "scoped AS (SELECT * FROM merged WHERE property_type IS DISTINCT FROM 'Others')"


def typed_cte() -> str:
    conv = {'price': currency('price'), 'property_size': before_unit('property_size')}
    conv.update({c: numeric(c) for c in NUMERIC_COLS})
    sel = ", ".join(f"{conv[c]} AS {c}" if c in conv else c for c in LISTING_COLUMNS)
    return f"typed AS (SELECT {sel} FROM scoped)"


def corrected_cte() -> str:
    size = (f"round_even(CASE WHEN property_size < {C.SIZE_MIN_PLAUSIBLE} THEN {extract_size('description')} "
            f"ELSE property_size END, 0)")
    fac = f"regexp_replace(facilities, {lit(C.TRAILING_TEN)}, '')"
    floors = f"CASE WHEN floors > {C.FLOOR_MAX} THEN NULL ELSE floors END"
    rep = {'property_size': size, 'facilities': fac, 'floors': floors}
    sel = ", ".join(f"{rep[c]} AS {c}" if c in rep else c for c in LISTING_COLUMNS)
    return f"corrected AS (SELECT {sel} FROM typed)"


def recovered_cte() -> str:
    rep = {'bedroom': f"coalesce(bedroom, {rooms('description', 'bed')})",
           'bathroom': f"coalesce(bathroom, {rooms('description', 'bath')})"}
    sel = ", ".join(f"{rep[c]} AS {c}" if c in rep else c for c in LISTING_COLUMNS)
    return f"recovered AS (SELECT {sel} FROM corrected)"


def split_cte() -> str:
    return (f"splitted AS (SELECT *, {split_case()} AS split, "
            f"CASE WHEN price > 0 THEN ln(price) END AS log_price FROM recovered)")


def size_rule_cte(src: str = 'splitted') -> str:
    """F7 with per-split mean/std (fit_scope='each')."""
    z = (f"zs AS (SELECT split, avg(property_size) AS m, stddev_samp(property_size) AS s FROM {src} GROUP BY split), "
         f"sz AS (SELECT t.*, (t.property_size - zs.m) / zs.s AS __z, {extract_land('t.description')} AS __land, "
         f"{extract_size('t.description')} AS __gen FROM {src} t LEFT JOIN zs USING (split)), "
         f"sz2 AS (SELECT *, coalesce(__land, __gen) AS __val, __land IS NOT NULL AS __is_land, "
         f"coalesce(abs(__z) > {C.Z_THRESHOLD}, false) AS __flag FROM sz), "
         f"sz3 AS (SELECT *, CASE WHEN __val <> 0 THEN property_size / __val END AS __ratio FROM sz2), "
         f"sz4 AS (SELECT *, coalesce(__ratio > 0 AND (" +
         " OR ".join(f"abs(__ratio / {f} - 1) < {C.DIGIT_SHIFT_TOLERANCE}" for f in C.DIGIT_SHIFT_FACTORS) +
         f"), false) AS __shift FROM sz3), "
         f"sz5 AS (SELECT *, CASE WHEN __val IS NULL THEN 'no_evidence' WHEN __is_land THEN 'land_area' "
         f"WHEN __shift THEN 'digit_shift' ELSE 'confirmed' END AS __reason, "
         f"CASE WHEN __val IS NULL THEN NULL WHEN __is_land OR __shift THEN round_even(__val, 0) "
         f"ELSE property_size END AS __new FROM sz4)")
    return z


def outliers_cte() -> str:
    """F7 → F8 → C6 (parking, threshold from the train median price)."""
    cols = LISTING_COLUMNS + ['split', 'log_price']
    after_size = ", ".join("CASE WHEN __flag THEN __new ELSE property_size END AS property_size"
                           if c == 'property_size' else c for c in cols)
    bed_ev = rooms_strict('description')
    after_bed = ", ".join(
        f"CASE WHEN bedroom >= {C.BEDROOM_LIMIT} AND {bed_ev} IS NOT NULL AND {bed_ev} <> bedroom "
        f"THEN {bed_ev} ELSE bedroom END AS bedroom" if c == 'bedroom' else c for c in cols)
    after_park = ", ".join(
        f"CASE WHEN coalesce(parking_lot >= {C.PARKING_LIMIT} AND price < (SELECT thr FROM park_thr), false) "
        f"THEN NULL ELSE parking_lot END AS parking_lot" if c == 'parking_lot' else c for c in cols)
    return (size_rule_cte() + f", o1 AS (SELECT {after_size} FROM sz5), o2 AS (SELECT {after_bed} FROM o1), "
            f"park_thr AS (SELECT quantile_cont(price, 0.5) * {C.PARKING_PRICE_SHARE} AS thr FROM o2 "
            f"WHERE split = 'train'), outl AS (SELECT {after_park} FROM o2)")


def features_cte(src: str = 'outl') -> str:
    land = "CASE WHEN land_title = 'Malay Reserved' THEN 'Bumi Lot' ELSE land_title END"
    return (f"feat AS (SELECT * REPLACE ({land} AS land_title), {state('address')} AS state, "
            f"CASE WHEN {C.REFERENCE_YEAR} - completion_year >= 0 THEN {C.REFERENCE_YEAR} - completion_year END "
            f"AS property_age, {list_count('facilities')} AS listed_facility_count, "
            f"CAST(school IS NOT NULL AS INTEGER) AS Has_school, CAST(mall IS NOT NULL AS INTEGER) AS Has_mall, "
            f"CASE WHEN land_title IN ('Malay Reserved', 'Bumi Lot') THEN 0 WHEN land_title = 'Non Bumi Lot' THEN 1 END "
            f"AS Is_Non_Bumi_Lot, "
            f"CASE tenure_type WHEN 'Freehold' THEN 1 WHEN 'Leasehold' THEN 0 END AS Freehold_Indicator, "
            f"CASE floor_range WHEN 'Low' THEN 1 WHEN 'Medium' THEN 2 WHEN 'High' THEN 3 END AS Floor_Range_Ordinal "
            f"FROM {src})")


def with_stages(upto: str) -> str:
    """'WITH listings..., <stages up to `upto`>' prefix."""
    order = [('clean', clean_cte), ('merged', merged_cte), ('scoped', scoped_cte), ('typed', typed_cte),
             ('corrected', corrected_cte), ('recovered', recovered_cte), ('splitted', split_cte),
             ('outl', outliers_cte), ('feat', features_cte)]
    parts = [LISTINGS_CTE]
    if upto == 'listings':
        return "WITH " + LISTINGS_CTE
    for name, fn in order:
        parts.append(fn())
        if name == upto:
            break
    return "WITH " + ", ".join(parts)
