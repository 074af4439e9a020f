"""Registered queries: duplicates (D) and text extraction (E)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tableprep.functions import text as X
from tableprep.operators import dedup
from tableprep.plans import prepare as PP
from tableprep.registry import sqltext as S
from tableprep.registry.base import by_key, exact, query, raw, stage, table
from tableprep.session import materialize
from tableprep.sources.fixtures import LISTING_COLUMNS

W = S.with_stages
STR = S.STR_COLS
SUBSET = [c for c in LISTING_COLUMNS if c not in ('ad_id', 'description')]
SUB = ", ".join(SUBSET)


# --- D: duplicates and record merging ---------------------------------------------------

@query('d1_drop_exact', f"{W('merged')} SELECT * FROM exact")
def d1(spark, sf):
    return stage(spark, sf, 'exact')


@query('d2_duplicate_keys', f"{W('merged')} SELECT ad_id, count(*) AS n FROM exact GROUP BY ad_id HAVING count(*) > 1")
def d2(spark, sf):
    return dedup.duplicate_keys(stage(spark, sf, 'exact'), 'ad_id')[0]


@query('d3_key_conflicts', f"{W('merged')}, cells AS (SELECT DISTINCT * FROM (" + " UNION ALL ".join(
    f"SELECT ad_id, '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value FROM exact" for c in STR) +
    ") WHERE value IS NOT NULL), n AS (SELECT ad_id, \"column\", count(*) AS n_values FROM cells "
    "GROUP BY ALL HAVING count(*) > 1) SELECT * FROM cells JOIN n USING (ad_id, \"column\")")
def d3(spark, sf):
    return by_key(spark, sf, lambda r: dedup.key_conflicts(materialize(exact(r), 'exact'), 'ad_id'), 'conflicts')


@query('d4_completeness', f"{W('merged')} SELECT ad_id, {S.completeness(LISTING_COLUMNS)} AS completeness FROM exact")
def d4(spark, sf):
    df = stage(spark, sf, 'exact')
    return df.select('ad_id', dedup.completeness(df.columns).alias('completeness'))


@query('d5_merge_by_key', f"{W('merged')} SELECT * FROM merged")
def d5(spark, sf):
    return by_key(spark, sf, lambda r: dedup.merge_by_key(exact(r), 'ad_id'), 'merged')


@query('d6_merge_evidence', f"{W('merged')}, g AS (SELECT ad_id FROM exact GROUP BY ad_id HAVING count(*) > 1) "
       "SELECT 'before' AS stage, e.* FROM exact e SEMI JOIN g USING (ad_id) "
       "UNION ALL SELECT 'after_merge' AS stage, m.* FROM merged m SEMI JOIN g USING (ad_id)")
def d6(spark, sf):
    return by_key(spark, sf, evidence, 'evidence')


def evidence(r):
    """D1, D5 and D6 on raw rows."""
    e = materialize(exact(r), 'exact')
    return dedup.merge_evidence(e, dedup.merge_repeated(e, 'ad_id'), 'ad_id')


@query('d7_near_duplicate_count', f"{W('merged')}, g AS (SELECT count(*) AS n FROM merged GROUP BY {SUB}) "
       "SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows, "
       "CAST(coalesce(sum(CASE WHEN n > 1 THEN 1 END), 0) AS BIGINT) AS groups, "
       "CAST(coalesce(sum(CASE WHEN n > 1 THEN n END), 0) AS BIGINT) AS rows_in_groups FROM g")
def d7(spark, sf):
    return dedup.near_duplicate_count(stage(spark, sf, 'merged'), ['ad_id', 'description'])


_ND_GROUPS = (f"g AS (SELECT {SUB}, count(*) AS group_size, min(ad_id) AS group_id, "
              f"count(DISTINCT description) + max(CAST(description IS NULL AS INTEGER)) <= 1 AS description_identical "
              f"FROM merged GROUP BY ALL HAVING count(*) > 1)")
_ND_JOIN = " AND ".join(f"m.{c} IS NOT DISTINCT FROM g.{c}" for c in SUBSET)


@query('d8_near_duplicate_groups', f"{W('merged')}, {_ND_GROUPS} SELECT g.group_id, g.description_identical, "
       f"g.group_size, m.* FROM merged m JOIN g ON {_ND_JOIN}")
def d8(spark, sf):
    return dedup.near_duplicate_groups(stage(spark, sf, 'merged', whole=True), ['ad_id', 'description'], 'description', 'ad_id')


_TORN = ['bedroom', 'bathroom', 'property_size', 'floors', 'total_units', 'parking_lot', 'property_type',
         'log_price']


@query('d9_torn_groups', f"{W('splitted')}, g AS (SELECT count(*) AS n, count(DISTINCT split) AS sides FROM "
       f"splitted GROUP BY {', '.join(_TORN)}) SELECT CAST(coalesce(sum(CASE WHEN n > 1 AND sides > 1 THEN 1 END), 0) "
       "AS BIGINT) AS torn_groups, CAST(coalesce(sum(CASE WHEN n > 1 THEN 1 END), 0) AS BIGINT) AS identical_groups FROM g")
def d9(spark, sf):
    return dedup.torn_groups(stage(spark, sf, 'splitted'), _TORN)


@query('d10_identical_groups', "WITH g AS (SELECT count(*) AS n, min(p_retailprice) IS NOT DISTINCT FROM "
       "max(p_retailprice) AS same FROM part GROUP BY p_brand, p_type, p_size HAVING count(*) > 1) "
       "SELECT count(*) AS groups, CAST(coalesce(sum(n), 0) AS BIGINT) AS rows, "
       "CAST(coalesce(sum(CAST(same AS INTEGER)), 0) AS BIGINT) AS groups_same_label FROM g")
def d10(spark, sf):
    return dedup.identical_groups(table(spark, sf, 'part'), ['p_brand', 'p_type', 'p_size'], 'p_retailprice')


@query('d11_duplicate_impact', f"{W('merged')}, s AS (SELECT property_type, sum(n - 1) AS surplus FROM "
       f"(SELECT property_type, count(*) AS n FROM merged GROUP BY {SUB} HAVING count(*) > 1) GROUP BY 1), "
       "r AS (SELECT property_type, count(*) AS rows FROM merged GROUP BY 1) "
       "SELECT property_type, rows, CAST(coalesce(surplus, 0) AS BIGINT) AS surplus, "
       "round(coalesce(surplus, 0) * 100.0 / rows, 2) AS surplus_pct FROM r LEFT JOIN s USING (property_type)")
def d11(spark, sf):
    return dedup.duplicate_impact(stage(spark, sf, 'merged', whole=True), 'property_type', ['ad_id', 'description'])


_CD_ORDER = f"{S.row_order(LISTING_COLUMNS)} AS __o"


@query('d12_collapse_near_duplicates', f"{W('merged')}, {_ND_GROUPS}, "
       f"tagged AS (SELECT g.group_id, m.* FROM merged m LEFT JOIN (SELECT * FROM g WHERE description_identical) g "
       f"ON {_ND_JOIN}), mem AS (SELECT * EXCLUDE (group_id) REPLACE (group_id AS ad_id) FROM tagged "
       f"WHERE group_id IS NOT NULL), rk AS (SELECT *, {_CD_ORDER} FROM mem) "
       "SELECT * EXCLUDE (group_id) FROM tagged WHERE group_id IS NULL UNION ALL SELECT ad_id, " +
       ", ".join(f"arg_min({c}, __o) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in STR) +
       " FROM rk GROUP BY ad_id")
def d12(spark, sf):
    return dedup.collapse_near_duplicates(stage(spark, sf, 'merged', whole=True), ['ad_id', 'description'],
                                          'description', 'ad_id')


# --- E: text and number extraction -------------------------------------------------------

@query('e1_currency', f"{W('listings')} SELECT ad_id, {S.currency('price')} AS value FROM listings")
def e1(spark, sf):
    return raw(spark, sf).select('ad_id', X.currency('price').alias('value'))


@query('e2_before_unit', f"{W('listings')} SELECT ad_id, {S.before_unit('property_size')} AS value FROM listings")
def e2(spark, sf):
    return raw(spark, sf).select('ad_id', X.before_unit('property_size').alias('value'))


@query('e3_numeric', f"{W('listings')} SELECT ad_id, " + ", ".join(
    f"{S.numeric(c)} AS {c}" for c in S.NUMERIC_COLS) + " FROM listings")
def e3(spark, sf):
    return raw(spark, sf).select('ad_id', *[X.numeric(c).alias(c) for c in S.NUMERIC_COLS])


@query('e4_digits', f"{W('listings')} SELECT ad_id, {S.digits('price')} AS price, "
       f"{S.digits('property_size')} AS property_size FROM listings")
def e4(spark, sf):
    return raw(spark, sf).select('ad_id', X.digits('price').alias('price'),
                                 X.digits('property_size').alias('property_size'))


@query('e5_first_decimal', f"SELECT doc_id, {S.first_decimal('text')} AS value FROM documents")
def e5(spark, sf):
    """E5 over whole document texts."""
    return table(spark, sf, 'documents').select('doc_id', X.first_decimal('text').alias('value'))


@query('e6_extract_size', f"{W('listings')} SELECT ad_id, {S.extract_size('description')} AS size FROM listings")
def e6(spark, sf):
    return raw(spark, sf).select('ad_id', X.extract_size('description').alias('size'))


@query('e7_extract_size_source', f"{W('listings')} SELECT ad_id, coalesce({S.extract_land('description')}, "
       f"{S.extract_size('description')}) AS value, {S.extract_land('description')} IS NOT NULL AS is_land FROM listings")
def e7(spark, sf):
    return raw(spark, sf).select('ad_id', X.extract_size_source('description').alias('s')) \
        .select('ad_id', 's.value', 's.is_land')


@query('e8_extract_rooms', f"{W('listings')} SELECT ad_id, {S.rooms('description', 'bed')} AS bedrooms, "
       f"{S.rooms('description', 'bath')} AS bathrooms FROM listings")
def e8(spark, sf):
    return raw(spark, sf).select('ad_id', X.extract_rooms('description', 'bed').alias('bedrooms'),
                                 X.extract_rooms('description', 'bath').alias('bathrooms'))


@query('e9_extract_bedrooms_strict', f"{W('listings')} SELECT ad_id, {S.rooms_strict('description')} AS bedrooms "
       "FROM listings")
def e9(spark, sf):
    return raw(spark, sf).select('ad_id', X.extract_bedrooms_strict('description').alias('bedrooms'))


@query('e10_recover_from_text', f"{W('corrected')} " + " UNION ALL ".join(
    f"SELECT ad_id AS key, '{c}' AS variable, CAST(NULL AS DOUBLE) AS original, {S.rooms('description', k)} "
    f"AS evidence, {S.rooms('description', k)} AS final FROM corrected WHERE {c} IS NULL"
    for c, k in [('bedroom', 'bed'), ('bathroom', 'bath')]))
def e10(spark, sf):
    return PP.recovered(stage(spark, sf, 'corrected'))[1]['room_recovery']


@query('e11_correct_from_text', f"{W('typed')} SELECT ad_id AS key, property_size AS original, "
       f"{S.extract_size('description')} AS evidence, round_even({S.extract_size('description')}, 0) AS final "
       "FROM typed WHERE property_size < 100")
def e11(spark, sf):
    return PP.corrected(stage(spark, sf, 'typed'))[1]['size_correction']


@query('e12_last_segment_match', f"{W('clean')} SELECT ad_id, {S.state('address')} AS state FROM clean")
def e12(spark, sf):
    return stage(spark, sf, 'clean').select('ad_id', X.last_segment_match('address', PP.C.VALID_STATES).alias('state'))


@query('e13_parse_list', f"{W('clean')} SELECT ad_id, array_to_string({S.parse_list('facilities')}, '|') AS items "
       "FROM clean")
def e13(spark, sf):
    return stage(spark, sf, 'clean').select('ad_id', F.array_join(X.parse_list('facilities'), '|').alias('items'))


@query('e14_list_count', f"{W('clean')} SELECT ad_id, {S.list_count('facilities')} AS n_items FROM clean")
def e14(spark, sf):
    return stage(spark, sf, 'clean').select('ad_id', X.list_count('facilities').alias('n_items'))


