"""Registered queries: sources (A), profiling (B), cleaning (C)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tableprep import config as C
from tableprep.operators import clean, profile
from tableprep.plans import prepare as PP
from tableprep.registry import sqltext as S
from tableprep.registry.base import by_key, query, raw, rnd, round_doubles, stage, table
from tableprep.session import materialize, scratch_dir
from tableprep.sources import io
from tableprep.sources.fixtures import LISTING_COLUMNS

W = S.with_stages
STR = S.STR_COLS


def _scratch(spark, tag):
    return scratch_dir(spark, f"{tag}-{uuid.uuid4().hex[:12]}")


# --- A: sources and sinks ----------------------------------------------------------------

@query('a1_read_table', f"{W('listings')} SELECT * FROM listings")
def a1(spark, sf):
    """A1: listings written as multi-line CSV and scanned back with a schema."""
    path = _scratch(spark, 'a1')
    src = raw(spark, sf)
    io.write_csv(src, path)
    return io.read_table(spark, path, schema=src.schema)


_MESSY = [
    "CAST(o_orderkey AS STRING) AS id",
    "CASE WHEN o_orderkey % 7 = 0 THEN '#N/A' ELSE CAST(o_custkey AS STRING) END AS cust",
    "CASE WHEN o_orderkey % 11 = 0 THEN 'NaN' ELSE CAST(o_totalprice AS STRING) END AS price",
    "CASE WHEN o_orderkey % 13 = 0 THEN '<NA>' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS day",
    "CASE WHEN o_orderkey % 3 = 0 THEN 'True' WHEN o_orderkey % 3 = 1 THEN 'FALSE' ELSE 'null' END AS flag",
    "CASE WHEN o_orderkey % 5 = 0 THEN 'n/a' ELSE o_orderpriority END AS priority",
    "CASE WHEN o_orderkey % 17 = 0 THEN concat(o_custkey, '.50') ELSE CAST(o_custkey AS STRING) END AS mixed",
    "'nan' AS nothing",
]


@query('a1_read_typed', "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey END AS cust, "
       "CASE WHEN o_orderkey % 11 <> 0 THEN o_totalprice END AS price, CASE WHEN o_orderkey % 13 <> 0 THEN CAST(o_orderdate AS DATE) END AS day, "
       "CASE o_orderkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS flag, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS priority, "
       "o_custkey + CASE WHEN o_orderkey % 17 = 0 THEN 0.5::DOUBLE ELSE 0::DOUBLE END AS mixed, CAST(NULL AS VARCHAR) AS nothing FROM orders")
def a1_typed(spark, sf):
    """A1 as a loader: orders written as text with missing tokens, read back with voted types."""
    path = _scratch(spark, 'a1-typed')
    io.write_csv(table(spark, sf, 'orders').selectExpr(*_MESSY), path)
    return io.read_typed(spark, path)


_A2_SQL = ("SELECT CAST(row_number() OVER () - 1 AS INTEGER) AS position, column_name AS \"column\", "
           "CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' "
           "WHEN 'DOUBLE' THEN 'double' ELSE lower(column_type) END AS data_type "
           f"FROM (DESCRIBE {W('listings')} SELECT * FROM listings)")


@query('a2_snapshot', _A2_SQL)
def a2(spark, sf):
    """A2: schema snapshot of the raw listings as rows (position, column, type)."""
    return io.snapshot(raw(spark, sf))


@query('a3_write_stage', f"{W('scoped')} SELECT * FROM scoped")
def a3(spark, sf):
    root = _scratch(spark, 'a3')
    io.write_stage(stage(spark, sf, 'scoped', whole=True), root, 'cleaned')
    return io.read_stage(spark, root, 'cleaned')


_D6_SQL = (f"{W('merged')}, g AS (SELECT ad_id FROM exact GROUP BY ad_id HAVING count(*) > 1) "
           f"SELECT 'before' AS stage, e.* FROM exact e SEMI JOIN g USING (ad_id) "
           f"UNION ALL SELECT 'after_merge' AS stage, m.* FROM merged m SEMI JOIN g USING (ad_id)")


@query('a4_write_evidence', _D6_SQL)
def a4(spark, sf):
    from tableprep.registry.q_dedup import evidence
    path = _scratch(spark, 'a4')
    io.write_evidence(by_key(spark, sf, evidence, 'evidence'), path)
    return spark.read.parquet(path)


@query('a5_write_split', rnd(f"{W('splitted')} SELECT * FROM splitted", ['log_price']))
def a5(spark, sf):
    root = _scratch(spark, 'a5')
    io.write_split(stage(spark, sf, 'splitted', whole=True), root, 'imputed')
    back = io.read_split(spark, root, 'imputed')
    return round_doubles(back.select(*LISTING_COLUMNS, 'split', 'log_price'))


_EDA_SQL = (f"{W('feat')} SELECT * EXCLUDE (description, nearby_school, address, completion_year, school, mall, "
            f"facilities, split, log_price) REPLACE (CAST(round_even(price, 0) AS BIGINT) AS price) "
            f"FROM feat WHERE split = 'train'")


@query('a6_eda_snapshot', _EDA_SQL)
def a6(spark, sf):
    """A6 on the fixed-rule feature stage (train rows, fixed drop list, whole-number price)."""
    return io.eda_snapshot(stage(spark, sf, 'feat'), PP.EDA_DROP + ['log_price'], 'price')


DESCRIBE_SPEC = {'Price': ('price', 'digits'), 'Property Size': ('property_size', 'digits'),
                 'Bedroom': ('bedroom', 'first_decimal'), 'Bathroom': ('bathroom', 'first_decimal'),
                 'Completion Year': ('completion_year', 'first_decimal'),
                 'Floors': ('floors', 'first_decimal'), 'Total Units': ('total_units', 'first_decimal'),
                 'Parking Lot': ('parking_lot', 'first_decimal')}


def describe_sql(src: str, spec: dict) -> str:
    conv = {'digits': S.digits, 'first_decimal': S.first_decimal, 'numeric': S.numeric}
    sel = ", ".join(f"{conv[r](c)} AS v{i}" for i, (c, r) in enumerate(spec.values()))
    stats = [('Count', 0, "CAST(count(v{i}) AS DOUBLE)"), ('Mean', 1, "round(avg(v{i}), 4)"),
             ('Median', 2, "quantile_cont(v{i}, 0.5)"), ('Standard deviation', 3, "round(stddev_samp(v{i}), 4)"),
             ('Minimum', 4, "min(v{i})"), ('25th percentile', 5, "quantile_cont(v{i}, 0.25)"),
             ('75th percentile', 6, "quantile_cont(v{i}, 0.75)"), ('Maximum', 7, "max(v{i})")]
    parts = []
    for name, _, e in stats:
        cols = ", ".join(f"{e.format(i=i)} AS \"{lab}\"" for i, lab in enumerate(spec))
        parts.append(f"SELECT '{name}' AS statistic, {cols} FROM parsed")
    return f"parsed AS (SELECT {sel} FROM {src}) " + " UNION ALL ".join(parts)


@query('a7_write_stats', f"{W('listings')}, {describe_sql('listings', DESCRIBE_SPEC)}")
def a7(spark, sf):
    out = profile.describe_table(raw(spark, sf), DESCRIBE_SPEC)
    path = _scratch(spark, 'a7')
    io.write_stats(out, path)
    return spark.read.parquet(path)


# --- B: profiling ---------------------------------------------------------------------

_TYPES = {'ad_id': 'bigint'}


@query('b1_profile_shape', f"{W('listings')} " + " UNION ALL ".join(
    f"SELECT '{c}' AS column, {i} AS position, '{_TYPES.get(c, 'string')}' AS data_type, "
    f"count({c}) AS non_null, count(*) AS rows FROM listings" for i, c in enumerate(LISTING_COLUMNS)))
def b1(spark, sf):
    return profile.profile_shape(raw(spark, sf))


@query('b2_profile_distinct', f"{W('clean')} " + " UNION ALL ".join(
    f"SELECT '{c}' AS column, count(DISTINCT {c}) AS n_distinct FROM clean" for c in LISTING_COLUMNS))
def b2(spark, sf):
    return profile.profile_distinct(stage(spark, sf, 'clean'))


_ALL = ", ".join(LISTING_COLUMNS)


@query('b3_duplicate_rows',
       f"{W('listings')}, g AS (SELECT count(*) AS n FROM listings GROUP BY ALL_COLS) "
       .replace('ALL_COLS', _ALL) +
       "SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows, "
       "CAST(coalesce(sum(CASE WHEN n > 1 THEN 1 END), 0) AS BIGINT) AS groups, "
       "CAST(coalesce(sum(CASE WHEN n > 1 THEN n END), 0) AS BIGINT) AS rows_in_groups FROM g")
def b3(spark, sf):
    return profile.duplicate_rows(raw(spark, sf))


def _missing_sql(src: str, cols, only=True) -> str:
    body = " UNION ALL ".join(
        f"SELECT '{c}' AS column, CAST(count(*) - count({c}) AS BIGINT) AS missing_count, "
        f"round((count(*) - count({c})) * 100.0 / count(*), 1) AS missing_pct FROM {src}" for c in cols)
    return f"SELECT * FROM ({body}) WHERE missing_count > 0" if only else body


@query('b4_missing_by_column', f"{W('clean')} {_missing_sql('clean', LISTING_COLUMNS)}")
def b4(spark, sf):
    return profile.missing_by_column(stage(spark, sf, 'clean'))


_NULLS = " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in LISTING_COLUMNS)


@query('b5_missing_per_row', rnd(
    f"{W('clean')}, m AS (SELECT {_NULLS} AS m FROM clean) SELECT count(m) AS count, avg(m) AS mean, "
    "stddev_samp(m) AS std, CAST(min(m) AS DOUBLE) AS min, quantile_cont(m, 0.25) AS p25, "
    "quantile_cont(m, 0.5) AS p50, quantile_cont(m, 0.75) AS p75, CAST(max(m) AS DOUBLE) AS max FROM m",
    ['mean', 'std']))
def b5(spark, sf):
    return round_doubles(profile.missing_per_row(stage(spark, sf, 'clean')))


_DROPPED = PP.DROP_NO_ENGINEERING + ['address', 'completion_year', 'school', 'mall', 'tenure_type',
                                     'land_title', 'floor_range', 'facilities', 'property_type']


@query('b6_non_null_counts', f"{W('typed')} " + " UNION ALL ".join(
    f"SELECT '{c}' AS column, count({c}) AS non_null FROM typed" for c in _DROPPED))
def b6(spark, sf):
    return profile.non_null_counts(stage(spark, sf, 'typed'), _DROPPED)


@query('b7_missing_delta', f"{W('clean')}, mb AS ({_missing_sql('listings', LISTING_COLUMNS, False)}), "
       f"ma AS ({_missing_sql('clean', LISTING_COLUMNS, False)}) "
       "SELECT \"column\", mb.missing_count AS missing_before, ma.missing_count AS missing_after, "
       "ma.missing_count - mb.missing_count AS difference FROM mb JOIN ma USING (\"column\") "
       "WHERE mb.missing_count > 0 OR ma.missing_count > 0")
def b7(spark, sf):
    return profile.missing_delta(raw(spark, sf), stage(spark, sf, 'clean'))


_RANGE = ['property_size', 'floors', 'bedroom', 'bathroom']


@query('b8_value_range', f"{W('corrected')} " + " UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM corrected"
    for c in _RANGE))
def b8(spark, sf):
    return profile.value_range(stage(spark, sf, 'corrected'), _RANGE)


@query('b9_value_counts', f"{W('clean')} SELECT floor_range AS value, count(*) AS count FROM clean GROUP BY 1")
def b9(spark, sf):
    return profile.value_counts(stage(spark, sf, 'clean'), 'floor_range', dropna=False)


_FLAGS = ['Has_school', 'Has_mall', 'Is_Non_Bumi_Lot', 'Freehold_Indicator']


@query('b10_indicator_totals', f"{W('feat')} " + " UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(coalesce(sum({c}), 0) AS BIGINT) AS total FROM feat" for c in _FLAGS))
def b10(spark, sf):
    return profile.indicator_totals(stage(spark, sf, 'feat', _FLAGS), _FLAGS)


@query('b11_total_missing', f"{W('clean')} SELECT CAST(coalesce(sum({_NULLS}), 0) AS BIGINT) AS missing FROM clean")
def b11(spark, sf):
    """The remaining-missing total that `assert_no_missing` checks."""
    return profile.total_missing(stage(spark, sf, 'clean'))


_SC = ['bedroom', 'bathroom', 'property_size', 'floors', 'total_units', 'parking_lot']


@query('b12_mean_std', rnd(f"{W('splitted')} " + " UNION ALL ".join(
    f"SELECT split, '{c}' AS column, avg(ln(1 + {c})) AS mean, stddev_samp(ln(1 + {c})) AS std "
    f"FROM splitted GROUP BY split" for c in _SC), ['mean', 'std']))
def b12(spark, sf):
    from tableprep.operators import impute
    return round_doubles(profile.mean_std(impute.log1p_columns(stage(spark, sf, 'splitted'), _SC), _SC))


_LI_SPEC = {'Quantity': ('l_quantity', 'first_decimal'), 'Line number': ('l_linenumber', 'first_decimal'),
            'Order key': ('l_orderkey', 'digits')}


@query('b13_describe_table', "WITH li AS (SELECT CAST(l_quantity AS VARCHAR) AS l_quantity, "
       "CAST(l_linenumber AS VARCHAR) AS l_linenumber, CAST(l_orderkey AS VARCHAR) AS l_orderkey FROM lineitem), "
       + describe_sql('li', _LI_SPEC))
def b13(spark, sf):
    li = table(spark, sf, 'lineitem').select(*[F.col(c).cast('string').alias(c)
                                               for c in ['l_quantity', 'l_linenumber', 'l_orderkey']])
    return profile.describe_table(li, _LI_SPEC)


@query('b14_column_screen', f"{W('clean')} SELECT *, CASE WHEN n_distinct <= 1 THEN 'constant' "
       "WHEN n_distinct > 1000 THEN 'high_cardinality' END AS reason FROM (" + " UNION ALL ".join(
           f"SELECT '{c}' AS column, count(DISTINCT {c}) AS n_distinct FROM clean" for c in LISTING_COLUMNS) + ")")
def b14(spark, sf):
    return profile.column_screen(stage(spark, sf, 'clean'), 1000)


_PAIRS = [('nearby_school', 'school'), ('mall', 'school')]


@query('b15_presence_subset', f"{W('clean')} " + " UNION ALL ".join(
    f"SELECT '{a}' AS column, '{b}' AS within, v AS violations, v = 0 AS holds FROM "
    f"(SELECT CAST(coalesce(sum(CAST({a} IS NOT NULL AND {b} IS NULL AS INTEGER)), 0) AS BIGINT) AS v FROM clean)"
    for a, b in _PAIRS))
def b15(spark, sf):
    return profile.presence_subset(stage(spark, sf, 'clean'), _PAIRS)


_CHECKS = {'age_is_reference_minus_year': f"property_age = {C.REFERENCE_YEAR} - completion_year",
           'zero_count_iff_missing': "(listed_facility_count = 0) = (facilities IS NULL)"}


@query('b16_identity_check', f"{W('feat')} " + " UNION ALL ".join(
    f"SELECT '{k}' AS \"check\", CAST(coalesce(sum(CASE WHEN {e} THEN 1 END), 0) AS BIGINT) AS holds, "
    f"CAST(coalesce(sum(CASE WHEN NOT ({e}) THEN 1 END), 0) AS BIGINT) AS fails, "
    f"CAST(coalesce(sum(CASE WHEN ({e}) IS NULL THEN 1 END), 0) AS BIGINT) AS unknown FROM feat"
    for k, e in _CHECKS.items()))
def b16(spark, sf):
    cols = ['property_age', 'completion_year', 'listed_facility_count', 'facilities']
    return profile.identity_check(stage(spark, sf, 'feat', cols), _CHECKS)


# --- C: projections, filters, predicates ------------------------------------------------

@query('c1_trim_strings', f"{W('listings')} SELECT ad_id, " +
       ", ".join(f"{S.strip(c)} AS {c}" for c in STR) + " FROM listings")
def c1(spark, sf):
    return clean.trim_strings(raw(spark, sf))


@query('c2_find_sentinels', f"{W('listings')}, cells AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column, {S.strip(c)} AS value FROM listings" for c in STR) +
    f") SELECT value AS sentinel, count(*) AS cells, count(DISTINCT \"column\") AS columns FROM cells "
    f"WHERE value IN {S.in_list(C.CANDIDATE_SENTINELS)} GROUP BY value")
def c2(spark, sf):
    return clean.find_sentinels(clean.trim_strings(raw(spark, sf)), C.CANDIDATE_SENTINELS)


@query('c3_standardise_missing', f"{W('clean')} SELECT * FROM clean")
def c3(spark, sf):
    return stage(spark, sf, 'clean')


@query('c4_remove_category', f"{W('scoped')} SELECT * FROM scoped")
def c4(spark, sf):
    return clean.remove_category(stage(spark, sf, 'merged', whole=True), 'property_type', 'Others')


@query('c5_invalidate_above', f"{W('typed')} SELECT ad_id, floors AS old_value FROM typed WHERE floors > {C.FLOOR_MAX}")
def c5(spark, sf):
    return clean.invalidate_above(stage(spark, sf, 'typed'), 'floors', C.FLOOR_MAX, 'ad_id')[1]


@query('c6_invalidate_if', f"{W('splitted')}, thr AS (SELECT quantile_cont(price, 0.5) * 0.5 AS t FROM splitted "
       "WHERE split = 'train') SELECT ad_id, parking_lot AS old_value FROM splitted, thr "
       "WHERE parking_lot >= 4 AND price < thr.t")
def c6(spark, sf):
    from tableprep.operators import impute
    df = stage(spark, sf, 'splitted')
    med = impute.fit_median(df.filter("split = 'train'"), {'price': None}).medians['price']
    cond = (F.col('parking_lot') >= C.PARKING_LIMIT) & (F.col('price') < med * C.PARKING_PRICE_SHARE)
    return clean.invalidate_if(df, 'parking_lot', cond, 'ad_id')[1]


@query('c7_tail_review', f"{W('typed')}, thr AS (SELECT quantile_cont(property_size, 0.01) AS threshold FROM typed) "
       "SELECT ad_id, property_size, threshold FROM typed, thr WHERE property_size <= threshold")
def c7(spark, sf):
    return clean.tail_review(stage(spark, sf, 'typed'), 'property_size', 0.01, 'ad_id')


# Confirmed-correction table (the reviewed list is an input of the job): keys
# chosen from the order keys present at every scale, one of them absent.
CORRECTIONS = [(9, 'bathroom', '2', 'description states 2 bathrooms'),
               (17, 'parking_lot', '1', 'reviewed'),
               (999999999999, 'bathroom', '3', 'key not in the table')]


def _corr_values():
    return ", ".join(f"({k}, '{c}', '{v}', '{n}')" for k, c, v, n in CORRECTIONS)


@query('c8_apply_corrections', f"{W('recovered')}, fix AS (SELECT * FROM (VALUES {_corr_values()}) "
       "t(ad_id, \"column\", value, note)) SELECT r.* REPLACE ("
       "coalesce((SELECT TRY_CAST(value AS DOUBLE) FROM fix WHERE fix.ad_id = r.ad_id AND \"column\" = 'bathroom'), "
       "r.bathroom) AS bathroom, coalesce((SELECT TRY_CAST(value AS DOUBLE) FROM fix WHERE fix.ad_id = r.ad_id "
       "AND \"column\" = 'parking_lot'), r.parking_lot) AS parking_lot) FROM recovered r")
def c8(spark, sf):
    fixes = spark.createDataFrame(CORRECTIONS, 'ad_id long, column string, value string, note string')
    return clean.apply_corrections(stage(spark, sf, 'recovered'), fixes, 'ad_id')[0]


@query('c9_strip_token', f"{W('typed')} SELECT ad_id, facilities AS before, "
       f"regexp_replace(facilities, {S.lit(C.TRAILING_TEN)}, '') AS after FROM typed "
       f"WHERE regexp_replace(facilities, {S.lit(C.TRAILING_TEN)}, '') <> facilities")
def c9(spark, sf):
    return clean.strip_token(stage(spark, sf, 'typed'), 'facilities', C.TRAILING_TEN, key='ad_id')[1]


_STAGES = {'no_engineering': PP.DROP_NO_ENGINEERING,
           'replaced': ['address', 'completion_year', 'school', 'mall', 'tenure_type', 'land_title',
                        'floor_range', 'facilities', 'state', 'property_type']}


@query('c10_drop_columns', f"{W('feat')} " + " UNION ALL ".join(
    f"SELECT '{s}' AS stage, '{c}' AS column, count({c}) AS non_null FROM feat"
    for s, cs in _STAGES.items() for c in cs))
def c10(spark, sf):
    return clean.drop_columns(stage(spark, sf, 'feat', [c for cs in _STAGES.values() for c in cs]), _STAGES)[1]


_MAJOR = ['Condominium', 'Apartment', 'Service Residence', 'Flat']


@query('c11_keep_categories', f"{W('typed')} SELECT property_type AS value, count(*) AS count FROM typed "
       f"WHERE NOT (property_type IN {S.in_list(_MAJOR)}) GROUP BY 1")
def c11(spark, sf):
    return clean.keep_categories(stage(spark, sf, 'typed'), 'property_type', _MAJOR)[1]


@query('c12_convert_columns', f"{W('typed')} " + " UNION ALL ".join(
    f"SELECT '{c}' AS column, '{r}' AS rule, count(s.{c}) AS non_null_before, count(t.{c}) AS non_null_after, "
    f"count(s.{c}) - count(t.{c}) AS failures FROM scoped s JOIN typed t USING (ad_id)"
    for c, r in PP.CONVERSION_RULES.items()))
def c12(spark, sf):
    return clean.convert_columns(stage(spark, sf, 'scoped'), PP.CONVERSION_RULES)[1]


@query('c13_fill_constant', f"{W('clean')} SELECT ad_id, coalesce(floor_range, 'Unknown') AS floor_range FROM clean")
def c13(spark, sf):
    return clean.fill_constant(stage(spark, sf, 'clean'), {'floor_range': 'Unknown'}).select('ad_id', 'floor_range')
