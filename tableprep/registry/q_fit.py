"""Registered queries: outliers (F), split (G), features (H), encoding (I),
imputation and scaling (J). Fitted steps fit on the rows with split='train'."""

from __future__ import annotations

from pyspark.sql import functions as F

from tableprep import config as C
from tableprep.operators import encode, features, impute, outliers, split, vocabulary
from tableprep.plans import prepare as PP
from tableprep.registry import sqltext as S
from tableprep.registry.base import query, rnd, round_doubles, stage, table
from tableprep.session import materialize

W = S.with_stages
Z_COLS = ['property_size', 'bedroom', 'bathroom', 'parking_lot']


def _train(df):
    return df.filter("split = 'train'")


def _long_flags(df, key, cols):
    return df.select(key, F.explode(F.array(*[
        F.struct(F.lit(c).alias('column'), F.col(f"`{c}`").alias('value')) for c in cols])).alias('r')) \
        .select(key, 'r.*')


# --- F: outliers ---------------------------------------------------------------------

@query('f1_zscore', rnd(f"{W('splitted')} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", z.m AS mean, z.s AS std, "
    f"CAST(coalesce(sum(CASE WHEN split = 'train' AND abs(({c} - z.m) / z.s) > 3 THEN 1 END), 0) AS BIGINT) "
    f"AS train_outliers, CAST(coalesce(sum(CASE WHEN split = 'test' AND abs(({c} - z.m) / z.s) > 3 THEN 1 END), 0) "
    f"AS BIGINT) AS test_outliers FROM splitted, (SELECT avg({c}) AS m, stddev_samp({c}) AS s FROM splitted "
    f"WHERE split = 'train') z GROUP BY z.m, z.s" for c in Z_COLS), ['mean', 'std']))
def f1(spark, sf):
    df = stage(spark, sf, 'splitted')
    p = outliers.fit_zscore(_train(df), Z_COLS)
    flagged = outliers.zscore_flags(df, p)
    counts = flagged.agg(*[x for i, c in enumerate(Z_COLS) for x in (
        F.sum(F.when((F.col('split') == 'train') & F.col(f"{c}_z_outlier"), 1).otherwise(0)).cast('long')
        .alias(f"tr{i}"),
        F.sum(F.when((F.col('split') == 'test') & F.col(f"{c}_z_outlier"), 1).otherwise(0)).cast('long')
        .alias(f"te{i}"))])
    out = counts.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias('column'), F.lit(p.mean[c]).alias('mean'), F.lit(p.std[c]).alias('std'),
                 F.col(f"tr{i}").alias('train_outliers'), F.col(f"te{i}").alias('test_outliers'))
        for i, c in enumerate(Z_COLS)])).alias('r')).select('r.*')
    return round_doubles(out)


def _iqr_sql(cols) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", q.q1, q.q3, q.q1 - 1.5 * (q.q3 - q.q1) AS lower, "
        f"q.q3 + 1.5 * (q.q3 - q.q1) AS upper, q.q1 = q.q3 AS degenerate, "
        f"CAST(coalesce(sum(CASE WHEN t.{c} < q.q1 - 1.5 * (q.q3 - q.q1) OR t.{c} > q.q3 + 1.5 * (q.q3 - q.q1) "
        f"THEN 1 END), 0) AS BIGINT) AS outliers FROM tr t, (SELECT quantile_cont({c}, 0.25) AS q1, "
        f"quantile_cont({c}, 0.75) AS q3 FROM tr) q GROUP BY q.q1, q.q3" for c in cols)


@query('f2_iqr', f"{W('splitted')}, tr AS (SELECT * FROM splitted WHERE split = 'train') {_iqr_sql(Z_COLS)}")
def f2(spark, sf):
    return outliers.iqr_table(_train(stage(spark, sf, 'splitted')), Z_COLS)


@query('f3_iqr_degenerate', f"{W('splitted')}, tr AS (SELECT * FROM splitted WHERE split = 'train') "
       f"SELECT \"column\", q1, q3, degenerate FROM ({_iqr_sql(['bedroom', 'bathroom'])})")
def f3(spark, sf):
    return outliers.iqr_table(_train(stage(spark, sf, 'splitted')), ['bedroom', 'bathroom']) \
        .select('column', 'q1', 'q3', 'degenerate')


_M = ("pair AS (SELECT * FROM splitted WHERE split = 'train' AND {x} IS NOT NULL AND {y} IS NOT NULL), "
      "mm AS (SELECT avg({x}) AS mx, avg({y}) AS my, var_samp({x}) AS vx, var_samp({y}) AS vy, "
      "covar_samp({x}, {y}) AS cxy, count(*) AS n FROM pair), "
      "d AS (SELECT pair.*, (({x} - mx) * ({x} - mx) * vy - 2 * cxy * ({x} - mx) * ({y} - my) + "
      "({y} - my) * ({y} - my) * vx) / (vx * vy - cxy * cxy) AS d2 FROM pair, mm)")
CUT = outliers.chi2_cutoff_df2(C.CHI2_P)


@query('f4_mahalanobis', rnd(f"{W('splitted')}, {_M.format(x='floors', y='total_units')} "
       f"SELECT (SELECT n FROM mm) AS pairs, CAST({CUT!r} AS DOUBLE) AS cutoff, CAST(coalesce(sum(CASE WHEN d2 > {CUT!r} THEN 1 END), 0) "
       "AS BIGINT) AS outliers FROM d", ['cutoff']))
def f4(spark, sf):
    return round_doubles(outliers.mahalanobis_table(_train(stage(spark, sf, 'splitted')), 'floors', 'total_units'))


#: chi-square, 0.975, three degrees of freedom, from a printed table.
CUT3 = 9.348403604496148
_M3 = ("tri AS (SELECT ad_id, floors AS x, total_units AS y, property_size AS z FROM splitted WHERE split = 'train' AND floors IS NOT NULL "
       "AND total_units IS NOT NULL AND property_size IS NOT NULL), "
       "mo AS (SELECT avg(x) AS mx, avg(y) AS my, avg(z) AS mz, var_samp(x) AS a, covar_samp(x, y) AS b, covar_samp(x, z) AS c, "
       "var_samp(y) AS d, covar_samp(y, z) AS e, var_samp(z) AS f, count(*) AS n FROM tri), "
       "iv AS (SELECT *, a * (d * f - e * e) - b * (b * f - c * e) + c * (b * e - c * d) AS det FROM mo), "
       "m3 AS (SELECT tri.*, ((x - mx) * (x - mx) * (d * f - e * e) + (y - my) * (y - my) * (a * f - c * c) + (z - mz) * (z - mz) * (a * d - b * b) "
       "+ 2 * (x - mx) * (y - my) * (c * e - b * f) + 2 * (x - mx) * (z - mz) * (b * e - c * d) + 2 * (y - my) * (z - mz) * (b * c - a * e)) / det AS d2 "
       "FROM tri, iv)")


@query('f4_three_columns', rnd(f"{W('splitted')}, {_M3} SELECT (SELECT n FROM mo) AS rows, CAST({CUT3!r} AS DOUBLE) AS cutoff, "
       f"CAST(coalesce(sum(CASE WHEN d2 > {CUT3!r} THEN 1 END), 0) AS BIGINT) AS outliers, avg(d2) AS mean_d2 FROM m3", ['cutoff', 'mean_d2']))
def f4_three(spark, sf):
    """F4 on three columns; the SQL writes the inverse out, Spark solves by a factor."""
    return round_doubles(outliers.distance_table(_train(stage(spark, sf, 'splitted')), ['floors', 'total_units', 'property_size']))


@query('f6_parking_price', rnd(f"{W('splitted')}, raw AS (SELECT * REPLACE (exp(log_price) AS price) FROM splitted WHERE log_price IS NOT NULL), "
       f"{_M.format(x='parking_lot', y='price').replace('FROM splitted', 'FROM raw')} SELECT ad_id, parking_lot, price, d2, d2 > {CUT!r} AS outlier FROM d",
       ['price', 'd2'], 4))
def f6_price(spark, sf):
    """F6 on parking lots and price, the label taken back from its logarithm to its own units."""
    tr = _train(stage(spark, sf, 'splitted')).withColumn('price', F.exp('log_price'))
    return round_doubles(outliers.distance_review(tr, ['parking_lot', 'price'], 'ad_id', every=True), 4)


@query('f5_ellipse', rnd(f"{W('splitted')}, {_M.format(x='floors', y='total_units')}, "
       "ev AS (SELECT *, (vx + vy) / 2 + sqrt(pow((vx - vy) / 2, 2) + cxy * cxy) AS l1, "
       "(vx + vy) / 2 - sqrt(pow((vx - vy) / 2, 2) + cxy * cxy) AS l2 FROM mm), "
       "an AS (SELECT *, degrees(atan2(l1 - vx, cxy)) AS raw FROM ev) "
       "SELECT mx AS center_x, my AS center_y, CASE WHEN raw > 90 THEN raw - 180 WHEN raw <= -90 THEN raw + 180 "
       f"ELSE raw END AS angle, 2 * sqrt(greatest(l1, 0.0) * {CUT!r}) AS width, "
       f"2 * sqrt(greatest(l2, 0.0) * {CUT!r}) AS height FROM an",
       ['center_x', 'center_y', 'angle', 'width', 'height'], 4))
def f5(spark, sf):
    tr = _train(stage(spark, sf, 'splitted')).filter('floors IS NOT NULL AND total_units IS NOT NULL')
    m = tr.agg(F.avg('floors').alias('center_x'), F.avg('total_units').alias('center_y'),
               F.var_samp('floors').alias('vx'), F.var_samp('total_units').alias('vy'),
               F.covar_samp('floors', 'total_units').alias('cxy'))
    e = outliers.ellipse_expr(F.col('vx'), F.col('vy'), F.col('cxy'), CUT)
    return round_doubles(m.select('center_x', 'center_y', e['angle'].alias('angle'),
                                  e['width'].alias('width'), e['height'].alias('height')), 4)


@query('f6_review', f"{W('splitted')}, {_M.format(x='floors', y='total_units')} "
       f"SELECT ad_id, floors, total_units FROM d WHERE d2 > {CUT!r}")
def f6(spark, sf):
    df = stage(spark, sf, 'splitted')
    tr = _train(df)
    p = outliers.fit_mahalanobis(tr, 'floors', 'total_units')
    return outliers.review(outliers.mahalanobis_flags(tr, p), 'mahalanobis_outlier',
                           ['floors', 'total_units'], 'ad_id')


@query('f7_resolve_size_outliers', f"{W('splitted')}, {S.size_rule_cte()} SELECT ad_id AS key, split, "
       "property_size AS original, __val AS evidence, __is_land AS is_land, __new AS final, __reason AS reason "
       "FROM sz5 WHERE __flag")
def f7(spark, sf):
    return outliers.resolve_size_outliers(stage(spark, sf, 'splitted'), 'property_size', 'description', 'ad_id')[1]


_BED = S.rooms_strict('description')


@query('f8_resolve_room_outliers', f"{W('splitted')} SELECT ad_id AS key, bedroom AS original, {_BED} AS evidence, "
       f"CASE WHEN {_BED} IS NOT NULL AND {_BED} <> bedroom THEN {_BED} ELSE bedroom END AS final, "
       f"CASE WHEN {_BED} IS NULL THEN 'no_evidence' WHEN {_BED} <> bedroom THEN 'corrected' ELSE 'confirmed' END "
       f"AS reason, split FROM splitted WHERE bedroom >= {C.BEDROOM_LIMIT}")
def f8(spark, sf):
    return outliers.resolve_room_outliers(stage(spark, sf, 'splitted'), 'bedroom', 'description', 'ad_id')[1]


RATIO_MAX = 15   # units per floor above this are listed for review


@query('f9_ratio_screen', rnd(f"{W('typed')} SELECT ad_id, total_units, floors, total_units / floors AS ratio "
       f"FROM typed WHERE floors <> 0 AND total_units / floors > {RATIO_MAX}", ['ratio']))
def f9(spark, sf):
    return round_doubles(outliers.ratio_screen(stage(spark, sf, 'typed'), 'total_units', 'floors', RATIO_MAX, 'ad_id'))


# --- G: split ---------------------------------------------------------------------------

@query('g1_split_random', f"{W('recovered')} SELECT ad_id, {S.split_case()} AS split FROM recovered")
def g1(spark, sf):
    return split.split_random(stage(spark, sf, 'recovered'), 'ad_id', C.TEST_FRACTION, C.SPLIT_SEED) \
        .select('ad_id', 'split')


@query('g1_split_exact', f"{W('recovered')} SELECT ad_id, CASE WHEN row_number() OVER (ORDER BY md5('42|' || "
       "coalesce(CAST(ad_id AS VARCHAR), chr(0)))) <= ceil(round(0.2 * (SELECT count(*) FROM recovered), 9)) "
       "THEN 'test' ELSE 'train' END AS split FROM recovered")
def g1_exact(spark, sf):
    """G1 with exactly ceil(0.2 * n) test rows."""
    keys = materialize(stage(spark, sf, 'recovered').select('ad_id'), 'keys')
    return split.split_exact(keys, 'ad_id', C.TEST_FRACTION, C.SPLIT_SEED)


@query('g2_split_grouped', "SELECT o_orderkey, o_custkey, CASE WHEN ('0x' || substr(md5('42|' || "
       f"CAST(o_custkey AS VARCHAR)), 1, 8))::BIGINT < {S.HALF} THEN 'test' ELSE 'train' END AS split FROM orders")
def g2(spark, sf):
    """Every customer's orders land on one side."""
    o = table(spark, sf, 'orders').select('o_orderkey', 'o_custkey')
    return split.split_grouped(o, ['o_custkey'], C.TEST_FRACTION, C.SPLIT_SEED)


@query('g3_split_report', f"{W('splitted')} SELECT split, count(*) AS rows, round(count(*) / sum(count(*)) OVER (), 3) "
       "AS share FROM splitted GROUP BY split")
def g3(spark, sf):
    return split.split_report(stage(spark, sf, 'splitted'))


@query('g4_log_label', rnd(f"{W('splitted')} SELECT ad_id, log_price, CAST(round_even(exp(log_price), 0) AS BIGINT) "
       "AS price_back FROM splitted", ['log_price']))
def g4(spark, sf):
    df = stage(spark, sf, 'splitted')
    return round_doubles(df.select('ad_id', 'log_price', split.back_transform(F.col('log_price')).alias('price_back')))


# --- H: features ------------------------------------------------------------------------

@query('h1_age', f"{W('feat')} SELECT ad_id, property_age FROM feat")
def h1(spark, sf):
    return stage(spark, sf, 'outl', ['completion_year']).select('ad_id', features.age('completion_year').alias('property_age'))


@query('h2_presence_flags', f"{W('feat')} SELECT ad_id, Has_school, Has_mall FROM feat")
def h2(spark, sf):
    return features.presence_flags(stage(spark, sf, 'outl', ['school', 'mall']), ['school', 'mall']).select('ad_id', 'Has_school', 'Has_mall')


@query('h3_engineering_report', f"{W('feat')} SELECT split, count(*) AS rows, "
       "CAST(sum(CAST(address IS NULL AS INTEGER)) AS BIGINT) AS address_missing, "
       "CAST(sum(CAST(address IS NOT NULL AND state IS NULL AS INTEGER)) AS BIGINT) AS state_unmatched, "
       "CAST(sum(CAST(state IS NULL AS INTEGER)) AS BIGINT) AS state_missing, "
       "CAST(sum(CAST(completion_year IS NULL AS INTEGER)) AS BIGINT) AS year_missing, "
       "CAST(coalesce(sum(CAST(completion_year > 2023 AS INTEGER)), 0) AS BIGINT) AS off_plan, "
       "CAST(sum(CAST(property_age IS NULL AS INTEGER)) AS BIGINT) AS age_missing, "
       "CAST(sum(CAST(facilities IS NULL AS INTEGER)) AS BIGINT) AS facilities_missing, "
       "min(listed_facility_count) AS facility_count_min, max(listed_facility_count) AS facility_count_max "
       "FROM feat GROUP BY split")
def h3(spark, sf):
    cols = ['address', 'state', 'completion_year', 'property_age', 'facilities', 'listed_facility_count']
    return features.engineering_report(stage(spark, sf, 'feat', cols), 'address', 'completion_year', 'facilities')


@query('h4_is_after', f"{W('feat')} SELECT ad_id, CAST(completion_year > 2023 AS INTEGER) AS is_off_plan FROM feat")
def h4(spark, sf):
    return stage(spark, sf, 'feat', ['completion_year']).select('ad_id', features.is_after('completion_year').alias('is_off_plan'))


@query('h5_row_sum', f"{W('feat')} SELECT ad_id, Has_school + Has_mall AS amenity_count, bedroom + bathroom AS rooms "
       "FROM feat")
def h5(spark, sf):
    df = stage(spark, sf, 'feat', ['Has_school', 'Has_mall', 'bedroom', 'bathroom'])
    return df.select('ad_id', features.row_sum(['Has_school', 'Has_mall']).alias('amenity_count'),
                     features.row_sum(['bedroom', 'bathroom']).alias('rooms'))


@query('h6_safe_ratio', rnd(f"{W('feat')} SELECT ad_id, CASE WHEN floors <> 0 THEN total_units / floors END "
       "AS units_per_floor, CASE WHEN bedroom <> 0 THEN property_size / bedroom END AS size_per_bedroom FROM feat",
       ['units_per_floor', 'size_per_bedroom']))
def h6(spark, sf):
    df = stage(spark, sf, 'feat', ['total_units', 'floors', 'property_size', 'bedroom'])
    return round_doubles(df.select('ad_id', features.safe_ratio('total_units', 'floors').alias('units_per_floor'),
                                   features.safe_ratio('property_size', 'bedroom').alias('size_per_bedroom')))


# --- I: encoding -----------------------------------------------------------------------------

@query('i1_merge_values', f"{W('outl')} SELECT ad_id, CASE WHEN land_title = 'Malay Reserved' THEN 'Bumi Lot' "
       "ELSE land_title END AS land_title FROM outl")
def i1(spark, sf):
    return stage(spark, sf, 'outl', ['land_title']).select('ad_id', encode.merge_values('land_title', C.LAND_TITLE_MERGE)
                                           .alias('land_title'))


@query('i2_binary_map', f"{W('feat')} SELECT ad_id, Is_Non_Bumi_Lot, Freehold_Indicator FROM feat")
def i2(spark, sf):
    df = stage(spark, sf, 'outl', ['land_title', 'tenure_type'])
    land = encode.merge_values('land_title', C.LAND_TITLE_MERGE)
    return df.select('ad_id', encode.binary_map(land, C.LAND_TITLE_MAP).alias('Is_Non_Bumi_Lot'),
                     encode.binary_map('tenure_type', C.TENURE_MAP).alias('Freehold_Indicator'))


@query('i3_ordinal_map', f"{W('feat')} SELECT ad_id, Floor_Range_Ordinal FROM feat")
def i3(spark, sf):
    return stage(spark, sf, 'outl', ['floor_range']).select(
        'ad_id', encode.ordinal_map('floor_range', C.FLOOR_RANGE_ORDER).alias('Floor_Range_Ordinal'))


@query('i4_known_flag', f"{W('feat')} SELECT ad_id, CAST(coalesce(floor_range IN ('Low', 'Medium', 'High'), false) "
       "AS INTEGER) AS Floor_Range_Known FROM feat")
def i4(spark, sf):
    return stage(spark, sf, 'outl', ['floor_range']).select(
        'ad_id', encode.known_flag('floor_range', C.FLOOR_RANGE_ORDER).alias('Floor_Range_Known'))


_ITEMS = S.parse_list('facilities')


@query('i5_multi_hot', f"{W('feat')}, it AS (SELECT ad_id, split, {_ITEMS} AS items FROM feat), "
       "vocab AS (SELECT DISTINCT unnest(items) AS item FROM it WHERE split = 'train') "
       "SELECT ad_id, 'Has_' || replace(item, ' ', '_') AS \"column\", CAST(list_contains(items, item) AS INTEGER) "
       "AS value FROM it, vocab")
def i5(spark, sf):
    """I5 in long form (key, column, value): the vocabulary is fitted on train."""
    df = stage(spark, sf, 'feat', ['facilities'])
    items = PP.facility_items()
    p = encode.fit_multi_hot(_train(df), items)
    return _long_flags(encode.apply_multi_hot(df, items, p), 'ad_id', p.columns())


@query('i5_sparse_items', f"{W('feat')}, it AS (SELECT ad_id, split, {_ITEMS} AS items FROM feat), "
       "voc AS (SELECT item, row_number() OVER (ORDER BY item) - 1 AS index FROM (SELECT DISTINCT unnest(items) AS item "
       "FROM it WHERE split = 'train')) SELECT ad_id, index, 'Has_' || replace(item, ' ', '_') AS \"column\", 1 AS value "
       "FROM (SELECT DISTINCT ad_id, unnest(items) AS item FROM it) JOIN voc USING (item)")
def i5_sparse(spark, sf):
    """I5 for any vocabulary: (key, index, column, value) of the cells that are 1."""
    df = materialize(stage(spark, sf, 'feat', ['facilities']).select('ad_id', 'split', PP.facility_items().alias('items')), 'items')
    p = vocabulary.fit_sparse(_train(df).select(F.explode('items').alias('value')).distinct(), 'items', 'Has')
    return vocabulary.sparse_rows(df, 'ad_id', F.col('items'), p).join(p.names(), 'index').select('ad_id', 'index', 'column', 'value')


@query('i7_sparse_names', "WITH p AS (SELECT p_partkey, p_name, ('0x' || substr(md5('42|' || CAST(p_partkey AS VARCHAR)), 1, 8))::BIGINT "
       f"< {S.HALF} AS test FROM part), voc AS (SELECT v, row_number() OVER (ORDER BY v) - 2 AS index FROM (SELECT DISTINCT p_name "
       "AS v FROM p WHERE NOT test AND p_name IS NOT NULL)) SELECT p_partkey, index, 'Name_' || replace(v, ' ', '_') AS \"column\", "
       "1 AS value FROM p JOIN voc ON p_name = v WHERE index >= 0")
def i7_sparse(spark, sf):
    """I7 for any number of categories: every part name of the training rows is one."""
    df = split.split_random(table(spark, sf, 'part').select('p_partkey', 'p_name'), 'p_partkey', C.TEST_FRACTION, C.SPLIT_SEED)
    df = materialize(df, 'names')
    p = vocabulary.fit_sparse(_train(df).filter('p_name IS NOT NULL').select('p_name').distinct(), 'p_name', 'Name', reference=True)
    return vocabulary.sparse_rows(df, 'p_partkey', F.col('p_name'), p).join(p.names(), 'index').select('p_partkey', 'index', 'column', 'value')


_STATE_RARE = ("st AS (SELECT ad_id, split, coalesce(state, 'Unknown') AS state FROM feat), "
               f"rare AS (SELECT state FROM st WHERE split = 'train' GROUP BY state HAVING count(*) < {C.RARE_STATE_THRESHOLD})")


@query('i6_rare_merge', f"{W('feat')}, {_STATE_RARE} SELECT ad_id, CASE WHEN state IN (SELECT state FROM rare) "
       "THEN 'Other' ELSE state END AS state FROM st")
def i6(spark, sf):
    from tableprep.operators import clean
    df = clean.fill_constant(stage(spark, sf, 'feat', ['state']), {'state': 'Unknown'})
    rare = encode.rare_table(_train(df), 'state', C.RARE_STATE_THRESHOLD)
    return encode.merge_rare(df, rare, 'state').select('ad_id', 'state')


_TYPE_RARE = (f"rt AS (SELECT property_type FROM feat WHERE split = 'train' GROUP BY 1 "
              f"HAVING count(*) < {C.RARE_PROPERTY_TYPE_THRESHOLD}), "
              "pt AS (SELECT ad_id, split, CASE WHEN property_type IN (SELECT property_type FROM rt) THEN 'Other' "
              "ELSE property_type END AS property_type FROM feat), "
              "cats AS (SELECT DISTINCT property_type AS cat FROM pt WHERE split = 'train' AND property_type IS NOT NULL), "
              "kept AS (SELECT cat FROM cats WHERE cat > (SELECT min(cat) FROM cats))")


@query('i7_one_hot', f"{W('feat')}, {_TYPE_RARE} SELECT ad_id, 'PropertyType_' || replace(cat, ' ', '_') AS \"column\", "
       "CAST(coalesce(property_type = cat, false) AS INTEGER) AS value FROM pt, kept")
def i7(spark, sf):
    """I7 in long form (key, column, value): drop-first categories fitted on train."""
    df = stage(spark, sf, 'feat', ['property_type'])
    rt, p = encode.fit_rare_one_hot(_train(df), {
        'property_type': (C.RARE_PROPERTY_TYPE_THRESHOLD, 'PropertyType')})['property_type']
    return _long_flags(encode.apply_one_hot(encode.apply_rare(df, rt), p), 'ad_id', p.columns())


# --- J: imputation and scaling ----------------------------------------------------------------

_J1 = {'property_age': 'Property_Age_Missing', 'floors': 'Num_Floors_Missing',
       'total_units': 'Total_Units_Missing', 'parking_lot': 'Parking_Lot_Missing'}
_J2 = ['property_size', 'Floor_Range_Ordinal']


def _median_sql(spec: dict) -> str:
    meds = ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in spec)
    sel = ", ".join(f"coalesce(CAST({c} AS DOUBLE), CAST(med.m_{c} AS DOUBLE)) "
                    f"AS {c}" + (f", CAST({c} IS NULL AS INTEGER) AS {f}" if f else "") for c, f in spec.items())
    return (f", med AS (SELECT {meds} FROM feat WHERE split = 'train') SELECT ad_id, {sel} FROM feat, med")


@query('j1_impute_median', f"{W('feat')}{_median_sql(_J1)}")
def j1(spark, sf):
    df = stage(spark, sf, 'feat', list(_J1))
    p = impute.fit_median(_train(df), _J1)
    return impute.apply_median(df, p).select('ad_id', *[x for c, f in _J1.items() for x in (c, f)])


@query('j2_impute_no_flag', f"{W('feat')}{_median_sql({c: None for c in _J2})}")
def j2(spark, sf):
    df = stage(spark, sf, 'feat', _J2)
    p = impute.fit_median(_train(df), {c: None for c in _J2})
    return impute.apply_median(df, p).select('ad_id', *_J2)


@query('j3_log1p', rnd(f"{W('feat')} SELECT ad_id, " + ", ".join(
    f"ln(1 + {c}) AS {c}" for c in PP.SCALE_COLS) + " FROM feat", PP.SCALE_COLS))
def j3(spark, sf):
    return round_doubles(impute.log1p_columns(stage(spark, sf, 'feat', PP.SCALE_COLS), PP.SCALE_COLS).select('ad_id', *PP.SCALE_COLS))


_J4 = ['bedroom', 'bathroom', 'property_size']


@query('j4_standardise', rnd(f"{W('feat')}, sp AS (SELECT " + ", ".join(
    f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 OR stddev_pop({c}) IS NULL THEN 1 ELSE stddev_pop({c}) END "
    f"AS s_{c}" for c in _J4) + " FROM feat WHERE split = 'train') SELECT ad_id, " + ", ".join(
    f"({c} - m_{c}) / s_{c} AS {c}" for c in _J4) + " FROM feat, sp", _J4))
def j4(spark, sf):
    df = stage(spark, sf, 'feat', _J4)
    p = impute.fit_standardise(_train(df), _J4)
    return round_doubles(impute.apply_standardise(df, p).select('ad_id', *_J4))
