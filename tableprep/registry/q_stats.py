"""Registered queries: statistics (K) on whole driver tables, compositions (P)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tableprep.operators import stats
from tableprep.plans import apply as AP
from tableprep.plans import describe as DS
from tableprep.plans import eda as ED
from tableprep.plans import prepare as PP
from tableprep.plans import store
from tableprep.registry import sqltext as S
from tableprep.registry.base import ORACLES, by_key, query, raw, rnd, round_doubles, stage, table
from tableprep.registry.q_clean import describe_sql
from tableprep.session import materialize, scratch_dir

W = S.with_stages


def _pop_skew(src: str, x: str) -> str:
    return (f"(SELECT avg(pow({x} - m, 3)) / pow(avg(pow({x} - m, 2)), 1.5) FROM {src}, "
            f"(SELECT avg({x}) AS m FROM {src} WHERE {x} IS NOT NULL) WHERE {x} IS NOT NULL)")


@query('k1_central', rnd("WITH v AS (SELECT l_quantity AS v FROM lineitem WHERE l_quantity IS NOT NULL), "
       "c AS (SELECT v, count(*) AS n FROM v GROUP BY v), "
       "m AS (SELECT v AS mode, n AS mode_rows FROM c ORDER BY n DESC, v ASC LIMIT 1) "
       "SELECT count(*) AS count, avg(v) AS mean, quantile_cont(v, 0.5) AS median, stddev_samp(v) AS std, "
       "CAST(min(v) AS DOUBLE) AS min, CAST(max(v) AS DOUBLE) AS max, (SELECT CAST(mode AS DOUBLE) FROM m) AS mode, "
       "(SELECT mode_rows FROM m) AS mode_rows FROM v", ['mean', 'std']))
def k1(spark, sf):
    return round_doubles(stats.central(table(spark, sf, 'lineitem'), 'l_quantity'))


_SKEW = _pop_skew('orders', 'o_totalprice')


@query('k2_skew', rnd(f"SELECT {_SKEW} AS skewness, CASE WHEN {_SKEW} > 0.5 THEN 'right-skewed' WHEN {_SKEW} < -0.5 "
       "THEN 'left-skewed' ELSE 'approximately symmetrical' END AS direction", ['skewness']))
def k2(spark, sf):
    return round_doubles(stats.skew(table(spark, sf, 'orders'), 'o_totalprice'))


@query('k3_skew_compare', rnd(f"WITH lg AS (SELECT CASE WHEN o_totalprice > 0 THEN log10(o_totalprice) END AS lv "
       f"FROM orders) SELECT {_SKEW} AS skew_raw, {_pop_skew('lg', 'lv')} AS skew_log10",
       ['skew_raw', 'skew_log10']))
def k3(spark, sf):
    return round_doubles(stats.skew_compare(table(spark, sf, 'orders'), 'o_totalprice'))


_K4 = ("SELECT {by}, count(*) AS count, avg({x}) AS mean, quantile_cont({x}, 0.5) AS median, "
       "quantile_cont({x}, 0.75) - quantile_cont({x}, 0.25) AS iqr, CAST(min({x}) AS DOUBLE) AS min, "
       "CAST(max({x}) AS DOUBLE) AS max, stddev_samp({x}) AS std FROM {src} WHERE {x} IS NOT NULL GROUP BY {by}")
_K4_ROUND = ['mean', 'median', 'iqr', 'min', 'max', 'std']


@query('k4_grouped_summary', rnd(_K4.format(by='c_mktsegment', x='c_acctbal', src='customer'), _K4_ROUND))
def k4(spark, sf):
    return round_doubles(stats.grouped_summary(table(spark, sf, 'customer'), 'c_mktsegment', 'c_acctbal'))


@query('k5_arg_max', "WITH s AS (" + _K4.format(by='c_mktsegment', x='c_acctbal', src='customer') +
       ") SELECT c_mktsegment AS \"group\", round(median, 6) AS value, 'median' AS measure FROM s "
       "ORDER BY median DESC, c_mktsegment LIMIT 1")
def k5(spark, sf):
    s = stats.grouped_summary(table(spark, sf, 'customer'), 'c_mktsegment', 'c_acctbal')
    return round_doubles(stats.arg_max(s, 'c_mktsegment', 'median'))


@query('k6_histogram', rnd("WITH st AS (SELECT min(value) AS lo, max(value) AS hi FROM events WHERE value IS NOT NULL), "
       "b AS (SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((value - lo) / ((hi - lo) / 50)), 49) END AS INTEGER) "
       "AS bin FROM events, st WHERE value IS NOT NULL), c AS (SELECT bin, count(*) AS n FROM b GROUP BY bin), "
       "g AS (SELECT CAST(unnest(range(0, 50)) AS INTEGER) AS bin) "
       "SELECT g.bin, lo + g.bin * ((hi - lo) / 50) AS lower, lo + (g.bin + 1) * ((hi - lo) / 50) AS upper, "
       "CAST(coalesce(n, 0) AS BIGINT) AS count FROM g CROSS JOIN st LEFT JOIN c USING (bin)", ['lower', 'upper']))
def k6(spark, sf):
    return round_doubles(stats.histogram(table(spark, sf, 'events'), 'value', 50))


@query('k7_kde', rnd("WITH v AS (SELECT value AS v FROM events WHERE value IS NOT NULL), "
       "st AS (SELECT count(*) AS n, min(v) AS lo, max(v) AS hi, stddev_samp(v) * pow(count(*), -0.2) AS h FROM v), "
       "w AS (SELECT v, count(*) AS w FROM v GROUP BY v), g AS (SELECT CAST(unnest(range(0, 200)) AS INTEGER) AS point) "
       "SELECT point, lo + point * ((hi - lo) / 199) AS x, sum(w * exp(-pow(lo + point * ((hi - lo) / 199) - v, 2) "
       "/ (2 * h * h))) / (n * h * sqrt(2 * pi())) AS density FROM g, st, w GROUP BY point, lo, hi, h, n",
       ['x', 'density'], 9))
def k7(spark, sf):
    return round_doubles(stats.kde(table(spark, sf, 'events'), 'value', 200), 9)


@query('k8_box_stats', rnd("WITH r AS (SELECT l_returnflag, l_extendedprice AS v FROM lineitem WHERE l_extendedprice "
       "IS NOT NULL), q AS (SELECT l_returnflag, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, "
       "quantile_cont(v, 0.75) AS q3 FROM r GROUP BY 1), j AS (SELECT r.*, q1, median, q3, "
       "v >= q1 - 1.5 * (q3 - q1) AND v <= q3 + 1.5 * (q3 - q1) AS inside FROM r JOIN q USING (l_returnflag)) "
       "SELECT l_returnflag, q1, median, q3, min(CASE WHEN inside THEN v END) AS whisker_low, "
       "max(CASE WHEN inside THEN v END) AS whisker_high, CAST(sum(CAST(NOT inside AS INTEGER)) AS BIGINT) AS outliers "
       "FROM j GROUP BY l_returnflag, q1, median, q3", ['q1', 'median', 'q3', 'whisker_low', 'whisker_high']))
def k8(spark, sf):
    return round_doubles(stats.box_stats(table(spark, sf, 'lineitem'), 'l_returnflag', 'l_extendedprice'))


_K9 = ['l_quantity', 'l_discount', 'l_tax']


_SIMPSON = "(CASE WHEN i IN (0, {k}) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)"


def _with_t(sql: str) -> str:
    """Adds the two-sided p of t at n - 2 degrees: one less twice the density's integral
    from 0 to |t| (beyond 40 nearly nothing is left), by Simpson's rule."""
    d, top = "(n - 2)::DOUBLE", "least(abs(t), 40)"
    density = f"exp(lgamma(({d} + 1) / 2) - lgamma({d} / 2) - 0.5 * ln({d} * pi()) - ({d} + 1) / 2 * ln(1 + pow({top} * i / 4000, 2) / {d}))"
    return (f"WITH st AS ({sql}) SELECT st.*, round(greatest(1 - 2 * {top} / 12000 * (SELECT sum({_SIMPSON.format(k=4000)} * {density}) "
            "FROM range(4001) g(i)), 0), 6) AS p_value FROM st")


def _with_f(sql: str) -> str:
    """Adds the upper p of f, from the density's integral from 0 to f in the same way."""
    a, b, u = "df_between::DOUBLE", "df_within::DOUBLE", "(f * i / 20000)"
    density = (f"exp(lgamma(({a} + {b}) / 2) - lgamma({a} / 2) - lgamma({b} / 2) + {a} / 2 * ln({a} / {b}) + ({a} / 2 - 1) * ln{u} "
               f"- ({a} + {b}) / 2 * ln(1 + {a} * {u} / {b}))")
    return (f"WITH st AS ({sql}) SELECT st.*, round(greatest(1 - f / 60000 * (SELECT sum({_SIMPSON.format(k=20000)} * {density}) "
            "FROM range(1, 20001) g(i)), 0), 6) AS p_value FROM st")


@query('k9_pearson', rnd(_with_t(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, corr({c}, l_extendedprice) AS r, CAST(sum(CAST({c} IS NOT NULL AND l_extendedprice "
    f"IS NOT NULL AS INTEGER)) AS BIGINT) AS n, corr({c}, l_extendedprice) * sqrt((sum(CAST({c} IS NOT NULL AND "
    f"l_extendedprice IS NOT NULL AS INTEGER)) - 2) / (1 - pow(corr({c}, l_extendedprice), 2))) AS t FROM lineitem"
    for c in _K9)), ['r', 't']))
def k9(spark, sf):
    return round_doubles(stats.pearson(table(spark, sf, 'lineitem'), _K9, 'l_extendedprice'))


@query('k10_anova', rnd(_with_f("WITH g AS (SELECT o_orderpriority, count(*) AS n, avg(o_totalprice) AS m, "
       "var_samp(o_totalprice) AS v FROM orders WHERE o_totalprice IS NOT NULL AND o_orderpriority IS NOT NULL "
       "GROUP BY 1), t AS (SELECT sum(n) AS nn, sum(n * m) / sum(n) AS gm, count(*) AS k FROM g) "
       "SELECT (sum(n * pow(m - gm, 2)) / (k - 1)) / (sum(coalesce((n - 1) * v, 0)) / (nn - k)) AS f, "
       "k AS groups, CAST(nn AS BIGINT) AS n, k - 1 AS df_between, CAST(nn - k AS BIGINT) AS df_within "
       "FROM g, t GROUP BY nn, gm, k"), ['f']))
def k10(spark, sf):
    return round_doubles(stats.anova(table(spark, sf, 'orders'), 'o_orderpriority', 'o_totalprice'))


_EDGES = [0, 10, 20, 30, 40]


def _bucket_sql(x: str) -> str:
    pos = " ".join(f"WHEN {x} >= {a} AND {x} < {b} THEN {i}" for i, (a, b) in enumerate(zip(_EDGES[:-1], _EDGES[1:])))
    lab = " ".join(f"WHEN {x} >= {a} AND {x} < {b} THEN '[{a},{b})'" for a, b in zip(_EDGES[:-1], _EDGES[1:]))
    return (f"CASE {pos} WHEN {x} >= {_EDGES[-1]} THEN {len(_EDGES) - 1} END AS pos, "
            f"CASE {lab} WHEN {x} >= {_EDGES[-1]} THEN '[{_EDGES[-1]},+inf)' END AS bucket")


@query('k11_bucket_median', rnd(f"WITH b AS (SELECT {_bucket_sql('l_quantity')}, l_extendedprice FROM lineitem "
       "WHERE l_extendedprice IS NOT NULL), g AS (SELECT pos, bucket, count(*) AS count, "
       "quantile_cont(l_extendedprice, 0.5) AS median FROM b WHERE pos IS NOT NULL GROUP BY 1, 2) "
       "SELECT g.pos, g.bucket, g.count, g.median, CASE WHEN p.median IS NULL THEN NULL ELSE g.median >= p.median END "
       "AS rises FROM g LEFT JOIN g p ON p.pos + 1 = g.pos", ['median']))
def k11(spark, sf):
    return round_doubles(stats.bucket_median(table(spark, sf, 'lineitem'), 'l_quantity', _EDGES, 'l_extendedprice'))


@query('k12_flag_effect', rnd(_with_t("WITH d AS (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS f, l_extendedprice AS y "
       "FROM lineitem) SELECT regr_r2(y, f) AS r2, regr_slope(y, f) AS slope, regr_intercept(y, f) AS intercept, "
       "CAST(regr_count(y, f) AS BIGINT) AS n, sign(regr_slope(y, f)) * sqrt(regr_r2(y, f) * (regr_count(y, f) - 2) / "
       "(1 - regr_r2(y, f))) AS t FROM d"), ['r2', 'slope', 'intercept', 't']))
def k12(spark, sf):
    d = table(spark, sf, 'lineitem').select((F.col('l_returnflag') == 'R').cast('int').alias('f'),
                                            F.col('l_extendedprice').alias('y'))
    return round_doubles(stats.flag_effect(d, 'f', 'y'))


_K13 = {'is_open': "l_linestatus = 'O'", 'is_a': "l_returnflag = 'A'"}


@query('k13_indicator_screen', rnd("WITH d AS (SELECT " + ", ".join(
    f"CAST({e} AS INTEGER) AS {k}" for k, e in _K13.items()) + ", l_extendedprice FROM lineitem) " + " UNION ALL ".join(
    f"SELECT '{k}' AS flag, avg({k}) AS rate, CAST(sum({k}) AS BIGINT) AS positives, "
    f"corr(CAST({k} AS DOUBLE), l_extendedprice) AS r, count({k}) AS n FROM d" for k in _K13), ['rate', 'r']))
def k13(spark, sf):
    d = table(spark, sf, 'lineitem').select(*[F.expr(f"CAST({e} AS INT)").alias(k) for k, e in _K13.items()],
                                            'l_extendedprice')
    return round_doubles(stats.indicator_screen(d, list(_K13), 'l_extendedprice'))


# --- P: compositions ----------------------------------------------------------------------------

@query('p1_prepare')
def p1(spark, sf):
    """The whole listing preparation job; its accounting table (B17 + D9)."""
    return PP.prepare(raw(spark, sf)).reports['summary']


def _p1_reports_sql() -> str:
    """The reports of P1's pass by SQL over the fixture and its stages."""
    cols = S.LISTING_COLUMNS
    miss = lambda src: ", ".join(f"sum(CAST({c} IS NULL AS INTEGER)) AS {c}" for c in cols)
    per_row = " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in cols)
    unpivot = lambda src, name: f"{name} AS (SELECT * FROM (SELECT {miss(src)} FROM {src}) UNPIVOT (k FOR item IN ({', '.join(cols)})))"
    eng = ['rows', 'address_missing', 'state_unmatched', 'state_missing', 'year_missing', 'off_plan', 'age_missing',
           'facilities_missing', 'facility_count_min', 'facility_count_max']
    h3 = ("SELECT split, count(*) AS rows, sum(CAST(address IS NULL AS INTEGER)) AS address_missing, "
          "sum(CAST(address IS NOT NULL AND state IS NULL AS INTEGER)) AS state_unmatched, "
          "sum(CAST(state IS NULL AS INTEGER)) AS state_missing, sum(CAST(completion_year IS NULL AS INTEGER)) AS year_missing, "
          "coalesce(sum(CAST(completion_year > 2023 AS INTEGER)), 0) AS off_plan, sum(CAST(property_age IS NULL AS INTEGER)) AS age_missing, "
          "sum(CAST(facilities IS NULL AS INTEGER)) AS facilities_missing, min(listed_facility_count) AS facility_count_min, "
          "max(listed_facility_count) AS facility_count_max FROM feat GROUP BY split")
    parts = [
        "SELECT 'missing_raw' AS report, item, 'count' AS metric, CAST(k AS DOUBLE) AS value FROM mr WHERE k > 0",
        "SELECT 'missing_raw', item, 'pct', round(k * 100.0 / (SELECT count(*) FROM listings), 1) FROM mr WHERE k > 0",
        *[f"SELECT 'missing_per_row', 'raw', '{m}', CAST({e} AS DOUBLE) FROM (SELECT {per_row} AS m FROM listings)" for m, e in (
            ('count', 'count(*)'), ('mean', 'avg(m)'), ('std', 'stddev_samp(m)'), ('min', 'min(m)'), ('p25', 'quantile_cont(m, 0.25)'),
            ('p50', 'quantile_cont(m, 0.5)'), ('p75', 'quantile_cont(m, 0.75)'), ('max', 'max(m)'))],
        "SELECT 'non_null', item, 'count', (SELECT count(*) FROM clean) - k FROM mc",
        *[f"SELECT 'missing_delta', item, '{m}', {e} FROM mr JOIN mc USING (item) WHERE mr.k > 0 OR mc.k > 0" for m, e in (
            ('before', 'mr.k'), ('after', 'mc.k'), ('difference', 'mc.k - mr.k'))],
        *[f"SELECT 'duplicate_keys', 'key', '{m}', coalesce({e}, 0) FROM keys" for m, e in (
            ('repeated_keys', 'sum(CAST(n > 1 AS INTEGER))'), ('rows_of_repeated_keys', 'sum(CASE WHEN n > 1 THEN n END)'),
            ('rows_merged_away', 'sum(n - 1)'))],
        "SELECT 'duplicate_keys', 'key', 'null_keys', count(*) FROM clean WHERE ad_id IS NULL",
        "SELECT 'scope', 'property_type', 'removed', (SELECT count(*) FROM merged) - (SELECT count(*) FROM scoped)",
        "SELECT 'scope', 'property_type', 'kept', count(*) FROM scoped",
        "SELECT 'split', split, 'rows', count(*) FROM splitted GROUP BY split",
        "SELECT 'split', split, 'share', round(count(*) / (SELECT count(*) FROM splitted), 3) FROM splitted GROUP BY split",
        *[f"SELECT 'engineering', split, '{m}', {m} FROM h3" for m in eng],
        *[f"SELECT 'mean_std', split || '.{c}', '{m}', {f}({c}) FROM feat GROUP BY split" for c in ('log_price', 'property_size')
          for m, f in (('mean', 'avg'), ('std', 'stddev_samp'))],
    ]
    return (f"{W('feat')}, {unpivot('listings', 'mr')}, {unpivot('clean', 'mc')}, "
            f"keys AS (SELECT count(*) AS n FROM clean WHERE ad_id IS NOT NULL GROUP BY ad_id), h3 AS ({h3}) "
            "SELECT report, item, metric, round(CAST(value AS DOUBLE), 6) AS value FROM (" + " UNION ALL ".join(parts) + ")")


@query('p1_reports', _p1_reports_sql())
def p1_reports(spark, sf):
    """P1's reports (B4-B7, C4, D2, G3 from metrics of its own pass; H3 and B12 from its features)."""
    made = PP.prepare(raw(spark, sf)).reports
    return round_doubles(made['pass'].unionByName(made['features']))


@query('p2_describe_job', f"{W('listings')}, {describe_sql('listings', DS.LISTING_SPEC)}")
def p2(spark, sf):
    return DS.describe_job(raw(spark, sf))


def _p3_sql() -> str:
    """All ten reports in SQL: the K queries' SQL turned to the snapshot's columns."""
    swap = lambda name, src, col, by=None: (ORACLES[name].replace(src, '{src}').replace(col, 'price').replace(by or '\0', 'property_type'))
    ctes = {
        'central': swap('k1_central', 'lineitem', 'l_quantity').format(src='snap'),
        'skew': swap('k2_skew', 'orders', 'o_totalprice').format(src='snap'),
        'skew_compare': swap('k3_skew_compare', 'orders', 'o_totalprice').format(src='snap'),
        'histogram': ORACLES['k6_histogram'].replace('events', 'pv'),
        'kde': ORACLES['k7_kde'].replace('events', 'pv'),
        'excluded_categories': f"SELECT property_type AS value, count(*) AS count FROM snap WHERE NOT (property_type IN {S.in_list(ED.MAJOR_CATEGORIES)}) GROUP BY 1",
        'grouped_summary': _K4.format(by='property_type', x='price', src='major'),
        'highest_median': 'SELECT property_type AS "group", median AS value FROM grouped_summary ORDER BY median DESC, property_type LIMIT 1',
        'highest_spread': 'SELECT property_type AS "group", std AS value FROM grouped_summary ORDER BY std DESC, property_type LIMIT 1',
        'box': swap('k8_box_stats', 'lineitem', 'l_extendedprice', 'l_returnflag').format(src='major'),
    }
    parts = []
    for name, (item, numbers, texts) in ED.LONG.items():
        key = f'CAST("{item.format(by="property_type")}" AS VARCHAR)' if item else 'CAST(NULL AS VARCHAR)'
        parts += [f"SELECT '{name}' AS report, {key} AS item, '{m}' AS metric, CAST(\"{m}\" AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS text FROM r_{name}" for m in numbers]
        parts += [f"SELECT '{name}', {key}, '{m}', CAST(NULL AS DOUBLE), \"{m}\" FROM r_{name}" for m in texts]
    made = ", ".join(f"r_{name} AS ({sql.replace('FROM grouped_summary', 'FROM r_grouped_summary')})" for name, sql in ctes.items())
    return (f"{W('feat')}, snap AS (SELECT property_type, CAST(round_even(price, 0) AS BIGINT) AS price FROM feat WHERE split = 'train'), "
            "pv AS (SELECT CAST(price AS DOUBLE) AS value FROM snap), "
            f"major AS (SELECT * FROM snap WHERE property_type IN {S.in_list(ED.MAJOR_CATEGORIES)}), {made} "
            "SELECT report, item, metric, CASE WHEN abs(value) < 1 THEN round(value, 9) ELSE round(value, 6) END AS value, text FROM ("
            + " UNION ALL ".join(parts) + ")")


@query('p3_eda_report', _p3_sql())
def p3(spark, sf):
    """P3 on the EDA snapshot (A6 of the fixed-rule feature stage): all ten reports."""
    from tableprep.sources import io
    snap = io.eda_snapshot(stage(spark, sf, 'feat', ['property_type', 'price']), PP.EDA_DROP + ['log_price'], 'price')
    out = ED.eda_long(snap)
    return out.withColumn('value', F.when(F.abs('value') < 1, F.round('value', 9)).otherwise(F.round('value', 6)))


def _long_features(df, key: str, cols):
    """(key, feature, value) rows: one per feature of every row."""
    return df.select(key, F.explode(F.array(*[
        F.struct(F.lit(c).alias('feature'), F.col(f"`{c}`").cast('double').alias('value')) for c in cols]))
        .alias('r')).select(key, 'r.*')


@query('p4_apply')
def p4(spark, sf):
    """P1 fits on the training rows and its parameters go to a store; the raw
    records of the held-out keys are then new rows, transformed with what is read
    back. Reported in long form
    (ad_id, feature, value) because the one-hot/multi-hot columns are fitted."""
    r = raw(spark, sf)
    prepared = PP.prepare(r)
    test_keys = materialize(prepared.data.filter("split = 'test'").select('ad_id'), 'test-keys')
    root = scratch_dir(spark, f"params-{uuid.uuid4().hex[:12]}")
    store.save(spark, prepared.params, root, 1)
    params = store.load(spark, root)
    out = by_key(spark, sf, lambda r: AP.transform(r.join(test_keys, 'ad_id', 'left_semi'), params), 'transformed')
    return round_doubles(_long_features(out, 'ad_id', PP.feature_columns(out)))


def _p1_sql() -> str:
    """P1 accounting in SQL: the whole job from the raw view to the summary."""
    med_cols = {'property_age': 'a', 'floors': 'f', 'total_units': 'u', 'parking_lot': 'p',
                'property_size': 's', 'Floor_Range_Ordinal': 'o'}
    meds = ", ".join(f"quantile_cont({c}, 0.5) AS {k}" for c, k in med_cols.items())
    filled = ", ".join(f"coalesce(CAST({c} AS DOUBLE), CAST(med.{k} AS DOUBLE)) AS {c}" for c, k in med_cols.items())
    flags = ", ".join(f"CAST({c} IS NULL AS INTEGER) AS {f}" for c, f in PP.IMPUTE_SPEC.items() if f)
    group_cols = (list(med_cols) + ['bedroom', 'bathroom', 'listed_facility_count', 'Has_school', 'Has_mall',
                                    'Is_Non_Bumi_Lot', 'Freehold_Indicator', 'mh', 'sk', 'tk', 'log_price'] +
                  [f for f in PP.IMPUTE_SPEC.values() if f])
    return (f"{W('feat')}, "
            f"it AS (SELECT *, {S.parse_list('facilities')} AS __items, coalesce(state, 'Unknown') AS __st FROM feat), "
            "vocab AS (SELECT DISTINCT unnest(__items) AS item FROM it WHERE split = 'train'), "
            "vl AS (SELECT list_sort(list(item)) AS v, count(*) AS nv FROM vocab), "
            f"rs AS (SELECT __st AS v FROM it WHERE split = 'train' GROUP BY 1 HAVING count(*) < {PP.C.RARE_STATE_THRESHOLD}), "
            "rt AS (SELECT property_type AS v FROM it WHERE split = 'train' AND property_type IS NOT NULL GROUP BY 1 "
            f"HAVING count(*) < {PP.C.RARE_PROPERTY_TYPE_THRESHOLD}), "
            "m AS (SELECT *, CASE WHEN __st IN (SELECT v FROM rs) THEN 'Other' ELSE __st END AS __sm, "
            "CASE WHEN property_type IN (SELECT v FROM rt) THEN 'Other' ELSE property_type END AS __tm FROM it), "
            "sc AS (SELECT DISTINCT __sm AS c FROM m WHERE split = 'train' AND __sm IS NOT NULL), "
            "tc AS (SELECT DISTINCT __tm AS c FROM m WHERE split = 'train' AND __tm IS NOT NULL), "
            "scl AS (SELECT count(*) - 1 AS n, min(c) AS ref FROM sc), "
            "tcl AS (SELECT count(*) - 1 AS n, min(c) AS ref FROM tc), "
            f"med AS (SELECT {meds} FROM m WHERE split = 'train'), "
            f"fin AS (SELECT split, log_price, bedroom, bathroom, listed_facility_count, Has_school, Has_mall, "
            f"Is_Non_Bumi_Lot, Freehold_Indicator, {filled}, {flags}, "
            "list_sort(list_distinct(list_filter(__items, lambda x: list_contains(vl.v, x)))) AS mh, "
            "CASE WHEN __sm IN (SELECT c FROM sc) AND __sm <> (SELECT ref FROM scl) THEN __sm END AS sk, "
            "CASE WHEN __tm IN (SELECT c FROM tc) AND __tm <> (SELECT ref FROM tcl) THEN __tm END AS tk "
            "FROM m, med, vl), "
            f"g AS (SELECT count(*) AS n, count(DISTINCT split) AS sides FROM fin GROUP BY {', '.join(group_cols)}), "
            "k AS (SELECT (SELECT nv FROM vl) AS v, (SELECT n FROM scl) AS s, (SELECT n FROM tcl) AS t) "
            "SELECT 'raw_features_retained' AS item, CAST(6 AS BIGINT) AS result "
            f"UNION ALL SELECT 'raw_features_dropped', {len(PP.DROP_NO_ENGINEERING) + len(PP.DROP_REPLACED)} "
            "UNION ALL SELECT 'engineered_features', CAST(11 + v + s + t AS BIGINT) FROM k "
            "UNION ALL SELECT 'state_one_hot_columns', CAST(s AS BIGINT) FROM k "
            "UNION ALL SELECT 'property_type_one_hot_columns', CAST(t AS BIGINT) FROM k "
            "UNION ALL SELECT 'missing_indicator_flags', 4 "
            "UNION ALL SELECT 'final_features', CAST(17 + v + s + t AS BIGINT) FROM k "
            "UNION ALL SELECT 'rows_entering_split', count(*) FROM fin "
            "UNION ALL SELECT 'train_rows', count(*) FROM fin WHERE split = 'train' "
            "UNION ALL SELECT 'test_rows', count(*) FROM fin WHERE split = 'test' "
            "UNION ALL SELECT 'remaining_missing', CAST(sum(CAST(bedroom IS NULL AS INTEGER) + CAST(bathroom IS NULL AS "
            "INTEGER) + CAST(Is_Non_Bumi_Lot IS NULL AS INTEGER) + CAST(Freehold_Indicator IS NULL AS INTEGER)) AS BIGINT) "
            "FROM fin UNION ALL SELECT 'torn_groups', CAST(coalesce(sum(CASE WHEN n > 1 AND sides > 1 THEN 1 END), 0) "
            "AS BIGINT) FROM g")


from tableprep.registry.base import ORACLES as _OR  # noqa: E402

_OR['p1_prepare'] = _p1_sql()


def _p4_sql() -> str:
    """P4 in SQL: training fits from the P1 stages, applied to the test keys'
    records with the training size moments (not re-fitted on the new rows)."""
    land = S.extract_land('description')
    gen = S.extract_size('description')
    shift = " OR ".join(f"abs(property_size / __val / {f} - 1) < {PP.C.DIGIT_SHIFT_TOLERANCE}"
                        for f in PP.C.DIGIT_SHIFT_FACTORS)
    bed = S.rooms_strict('description')
    nfeat = S.features_cte('n3').replace('feat AS (', 'nfeat AS (', 1)
    med_cols = {'property_age': 'a', 'floors': 'f', 'total_units': 'u', 'parking_lot': 'p',
                'property_size': 's', 'Floor_Range_Ordinal': 'o'}
    meds = ", ".join(f"quantile_cont({c}, 0.5) AS {k}" for c, k in med_cols.items())
    fixed = ['bedroom', 'bathroom', 'listed_facility_count', 'Has_school', 'Has_mall', 'Is_Non_Bumi_Lot',
             'Freehold_Indicator']
    parts = [f"SELECT ad_id, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM nfeat" for c in fixed]
    parts += [f"SELECT ad_id, '{c}' AS feature, CAST(coalesce(CAST({c} AS DOUBLE), med.{k}) AS DOUBLE) AS value "
              f"FROM nfeat, med" for c, k in med_cols.items()]
    parts += [f"SELECT ad_id, '{f}' AS feature, CAST({c} IS NULL AS DOUBLE) AS value FROM nfeat"
              for c, f in PP.IMPUTE_SPEC.items() if f]
    parts += ["SELECT ad_id, 'Has_' || replace(item, ' ', '_') AS feature, "
              f"CAST(list_contains({S.parse_list('facilities')}, item) AS DOUBLE) AS value FROM nfeat, vocab",
              "SELECT ad_id, 'State_' || replace(c, ' ', '_') AS feature, "
              "CAST(coalesce(CASE WHEN coalesce(state, 'Unknown') IN (SELECT v FROM rs) THEN 'Other' "
              "ELSE coalesce(state, 'Unknown') END = c, false) AS DOUBLE) AS value FROM nfeat, skept",
              "SELECT ad_id, 'PropertyType_' || replace(c, ' ', '_') AS feature, "
              "CAST(coalesce(CASE WHEN property_type IN (SELECT v FROM rt) THEN 'Other' "
              "ELSE property_type END = c, false) AS DOUBLE) AS value FROM nfeat, tkept"]
    return (f"{W('feat')}, "
            "trz AS (SELECT avg(property_size) AS m, stddev_samp(property_size) AS s, "
            f"quantile_cont(price, 0.5) * {PP.C.PARKING_PRICE_SHARE} AS thr FROM splitted WHERE split = 'train'), "
            "nw AS (SELECT * FROM splitted WHERE split = 'test'), "
            f"n1 AS (SELECT nw.*, coalesce(abs((property_size - trz.m) / trz.s) > {PP.C.Z_THRESHOLD}, false) AS __flag, "
            f"coalesce({land}, {gen}) AS __val, {land} IS NOT NULL AS __is_land FROM nw, trz), "
            "n1b AS (SELECT * REPLACE (CASE WHEN NOT __flag THEN property_size WHEN __val IS NULL THEN NULL "
            f"WHEN __is_land OR coalesce(__val <> 0 AND property_size / __val > 0 AND ({shift}), false) "
            "THEN round_even(__val, 0) ELSE property_size END AS property_size) FROM n1), "
            f"n2 AS (SELECT * REPLACE (CASE WHEN bedroom >= {PP.C.BEDROOM_LIMIT} AND {bed} IS NOT NULL AND {bed} <> bedroom "
            f"THEN {bed} ELSE bedroom END AS bedroom) FROM n1b), "
            f"n3 AS (SELECT n2.* REPLACE (CASE WHEN coalesce(parking_lot >= {PP.C.PARKING_LIMIT} AND price < trz.thr, false) "
            "THEN NULL ELSE parking_lot END AS parking_lot) FROM n2, trz), "
            f"{nfeat}, "
            f"vocab AS (SELECT DISTINCT unnest({S.parse_list('facilities')}) AS item FROM feat WHERE split = 'train'), "
            "st AS (SELECT coalesce(state, 'Unknown') AS s FROM feat WHERE split = 'train'), "
            f"rs AS (SELECT s AS v FROM st GROUP BY 1 HAVING count(*) < {PP.C.RARE_STATE_THRESHOLD}), "
            "sc AS (SELECT DISTINCT CASE WHEN s IN (SELECT v FROM rs) THEN 'Other' ELSE s END AS c FROM st), "
            "skept AS (SELECT c FROM sc WHERE c > (SELECT min(c) FROM sc)), "
            "rt AS (SELECT property_type AS v FROM feat WHERE split = 'train' AND property_type IS NOT NULL "
            f"GROUP BY 1 HAVING count(*) < {PP.C.RARE_PROPERTY_TYPE_THRESHOLD}), "
            "tc AS (SELECT DISTINCT CASE WHEN property_type IN (SELECT v FROM rt) THEN 'Other' ELSE property_type END "
            "AS c FROM feat WHERE split = 'train' AND property_type IS NOT NULL), "
            "tkept AS (SELECT c FROM tc WHERE c > (SELECT min(c) FROM tc)), "
            f"med AS (SELECT {meds} FROM feat WHERE split = 'train') "
            "SELECT ad_id, feature, round(value, 6) AS value FROM (" + " UNION ALL ".join(parts) + ")")


_OR['p4_apply'] = _p4_sql()
