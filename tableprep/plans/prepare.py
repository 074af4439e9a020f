"""P1 — the listing preparation job: raw table → clean, leakage-free features.

Stage order (the original job's run order): clean (C1-C3) → exact dedup and
key merge (D1, D5) → scope filter (C4) → typed conversion (C12) → invalid
values (E11, C9, C5) → recovery from text (E10) → split (G1, G4) → outlier
rules (F7, F8, C8, C6) → features (E12-E14, H1-H2) → fixed encodings
(I1-I3) → multi-hot (I5) → EDA snapshot (A6) → rare merge and one-hot
(I6-I7) → column drop (C10) → median imputation (J1-J2) → log1p (J3) →
accounting (B17, D9).

Every fitted parameter comes from the training rows only and is kept in
`PreparedTable.params`; `plans.apply.transform` replays them on new rows.
The split result is written as a parquet table into the shared checkpoint
folder and read back, so the fits after it scan only the columns they need
and a lost executor re-reads files instead of replaying the cleaning plan.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableprep import config as C
from tableprep.config import PrepareConfig
from tableprep.functions import text as X
from tableprep.operators import clean, dedup, encode, extract, features, impute, observed, outliers, profile, split
from tableprep.operators.quantile import exact_quantiles
from tableprep.operators.vocabulary import SparseParams
from tableprep.session import in_passes, materialize, pass_count

CONVERSION_RULES = {
    'price': 'currency', 'property_size': 'before_unit',
    'bedroom': 'numeric', 'bathroom': 'numeric', 'completion_year': 'numeric',
    'floors': 'numeric', 'total_units': 'numeric', 'parking_lot': 'numeric',
}

IMPUTE_SPEC = {
    'property_age': 'Property_Age_Missing', 'floors': 'Num_Floors_Missing',
    'total_units': 'Total_Units_Missing', 'parking_lot': 'Parking_Lot_Missing',
    'property_size': None, 'Floor_Range_Ordinal': None,
}

SCALE_COLS = ['bedroom', 'bathroom', 'property_size', 'floors', 'total_units', 'parking_lot',
              'property_age', 'listed_facility_count', 'Floor_Range_Ordinal']

DROP_NO_ENGINEERING = ['description', 'nearby_school']
DROP_REPLACED = ['address', 'completion_year', 'school', 'mall', 'tenure_type', 'land_title',
                 'floor_range', 'facilities', 'state', 'property_type']

EDA_DROP = ['description', 'nearby_school', 'address', 'completion_year', 'school', 'mall', 'facilities']


# --- stages before the split (row-local or one shuffle each) -------------------------

def cleaned(raw: DataFrame, cfg: PrepareConfig = PrepareConfig()) -> DataFrame:
    return clean.clean_missing(raw, cfg.sentinels)


def merged(raw: DataFrame, cfg: PrepareConfig = PrepareConfig()) -> DataFrame:
    """D1 + D5 in one shuffle: exact copies share completeness, fingerprint and
    values, so they never change a `min_by` pick — merging the cleaned rows
    directly gives the same table as merging after `drop_exact`, without the
    extra whole-table shuffle of the row-level DISTINCT."""
    return dedup.merge_by_key(cleaned(raw, cfg), cfg.cols.key)


def scoped(raw: DataFrame, cfg: PrepareConfig = PrepareConfig()) -> DataFrame:
    return clean.remove_category(merged(raw, cfg), cfg.cols.property_type, cfg.out_of_scope_type)


def typed(raw: DataFrame, cfg: PrepareConfig = PrepareConfig()):
    """(typed table, conversion report)."""
    return clean.convert_columns(scoped(raw, cfg), CONVERSION_RULES)


def corrected(df_typed: DataFrame, cfg: PrepareConfig = PrepareConfig()):
    """Invalid-value stage on the typed table: (table, logs)."""
    c = cfg.cols
    df, size_log = extract.correct_from_text(
        df_typed, c.size, X.extract_size(F.col(c.text)), F.col(c.size) < cfg.size_min, c.key)
    df, fac_log = clean.strip_token(df, c.facilities, C.TRAILING_TEN, key=c.key)
    df, floor_log = clean.invalidate_above(df, c.floors, cfg.floor_max, c.key)
    return df, {'size_correction': size_log, 'facilities_token': fac_log, 'floors_invalid': floor_log}


def recovered(df_corr: DataFrame, cfg: PrepareConfig = PrepareConfig()):
    c = cfg.cols
    df, bed = extract.recover_from_text(df_corr, c.bedroom, X.extract_rooms(F.col(c.text), 'bed'), c.key)
    df, bath = extract.recover_from_text(df, c.bathroom, X.extract_rooms(F.col(c.text), 'bath'), c.key)
    return df, {'room_recovery': bed.unionByName(bath)}


def split_stage(df_rec: DataFrame, cfg: PrepareConfig = PrepareConfig()) -> DataFrame:
    if cfg.exact_split:  # selects among all keys first, so what leads up to here runs once and is written
        out = split.split_exact(materialize(df_rec, 'recovered-stage'), cfg.cols.key, cfg.test_fraction, cfg.seed)
    else:
        out = split.split_random(df_rec, cfg.cols.key, cfg.test_fraction, cfg.seed)
    return out.withColumn('log_price', F.when(F.col(cfg.cols.price) > 0, F.ln(F.col(cfg.cols.price))))


def until_recovered(raw: DataFrame, cfg: PrepareConfig = PrepareConfig(), watch: observed.Watch | None = None):
    """(typed, corrected and recovered table, logs). With `watch`, the same plan with the reports' metrics in it."""
    if watch is None:
        t, report = typed(raw, cfg)
    else:
        t, report = clean.convert_columns(watched_scope(raw, cfg, watch), CONVERSION_RULES)
    corr, logs = corrected(t, cfg)
    rec, logs2 = recovered(corr, cfg)
    return rec, {'conversion': report, **logs, **logs2}


def until_split(raw: DataFrame, cfg: PrepareConfig = PrepareConfig(), watch: observed.Watch | None = None):
    """(split table, logs). With `watch`, the same plan with the reports' metrics in it."""
    rec, logs = until_recovered(raw, cfg, watch)
    return split_stage(rec, cfg), logs


def split_in_passes(raw: DataFrame, cfg: PrepareConfig, watch: observed.Watch, n: int, *sides) -> DataFrame:
    """The split table, merged in `n` passes over the keys, with all metrics in `watch`."""
    def rec(part):
        watch.next_pass()
        return until_recovered(part, cfg, watch)[0]
    if cfg.exact_split:  # which selects among the keys of all passes
        done = split_stage(in_passes(raw, [cfg.cols.key], rec, 'merged-stage', n), cfg)
        return materialize(watch.rows(done, 'split', *sides), 'split-stage')
    return in_passes(raw, [cfg.cols.key], lambda part: watch.rows(split_stage(rec(part), cfg), 'split', *sides), 'split-stage', n)


def watched_scope(raw: DataFrame, cfg: PrepareConfig, watch: observed.Watch) -> DataFrame:
    """scoped() with metrics of the raw and cleaned cells, the merge and the scope."""
    c = cfg.cols
    null_key = F.coalesce(F.sum(F.col(c.key).isNull().cast('long')), F.lit(0)).alias('null_keys')
    df = watch.rows(raw, 'raw', *observed.missing_exprs(raw.columns))
    df = watch.rows(cleaned(df, cfg), 'clean', null_key, *observed.missing_exprs(raw.columns))
    df = dedup.merge_by_key(df, c.key, '__merged')
    n = F.col('__merged')
    total = lambda x, name: F.coalesce(F.sum(x), F.lit(0)).cast('long').alias(name)
    df = watch.rows(df, 'merged', total(n, 'merged_rows'), total((n > 1).cast('long'), 'repeated_keys'),
                    total(F.when(n > 1, n), 'rows_of_repeated_keys'),
                    total(F.col(c.property_type).eqNullSafe(F.lit(cfg.out_of_scope_type)).cast('long'), 'out_of_scope'))
    return clean.remove_category(df.drop('__merged'), c.property_type, cfg.out_of_scope_type)


def pass_reports(watch: observed.Watch, raw: DataFrame) -> DataFrame:
    """(report, item, metric, value): B4-B7, C4, D2 and G3, all read from the metrics of
    the pass that wrote the split table. As many rows as columns, whatever the input."""
    cols, merged = raw.columns, watch.get('merged')
    # rows without a key don't come through the merge: they are counted beside it
    passed = watch.get('clean')
    rows = passed['null_keys'] + merged['merged_rows']
    passed = watch.get('clean', rows)
    if passed['null_keys'] + merged['merged_rows'] != rows:
        rows = passed['rows']
    before = watch.get('raw', rows)
    b, a = observed.missing_counts(before, cols), observed.missing_counts(passed, cols)
    n = before['rows']
    out = [('missing_raw', x, m, v) for x, k in b.items() if k for m, v in (('count', k), ('pct', round(k * 100.0 / n, 1)))]
    out += [('missing_per_row', 'raw', m, v) for m, v in observed.missing_per_row(before, cols).items()]
    out += [('non_null', x, 'count', n - k) for x, k in a.items()]
    out += [('missing_delta', x, m, v) for x in cols if b[x] or a[x]
            for m, v in (('before', b[x]), ('after', a[x]), ('difference', a[x] - b[x]))]
    out += [('duplicate_keys', 'key', m, merged[m]) for m in ('repeated_keys', 'rows_of_repeated_keys')]
    out += [('duplicate_keys', 'key', 'rows_merged_away', merged['merged_rows'] - merged['rows']),
            ('duplicate_keys', 'key', 'null_keys', passed['null_keys'])]
    out += [('scope', 'property_type', 'removed', merged['out_of_scope']),
            ('scope', 'property_type', 'kept', merged['rows'] - merged['out_of_scope'])]
    sides = watch.get('split')
    for side in ('train', 'test'):
        out += [('split', side, 'rows', sides[side])] if sides[side] else []
        out += [('split', side, 'share', round(sides[side] / sides['rows'], 3))] if sides[side] else []
    return raw.sparkSession.createDataFrame([(r, i, m, float(v)) for r, i, m, v in out],
                                            'report string, item string, metric string, value double')


def feature_reports(feat: DataFrame, cfg: PrepareConfig) -> DataFrame:
    """(report, item, metric, value): H3 per split and B12 (label and size), one
    aggregate over the featured rows."""
    c = cfg.cols
    g = features.engineering_report(feat, c.address, c.year, c.facilities).alias('g')
    names = [x for x in g.columns if x != 'split']
    long = g.select(F.col('split').alias('item'), F.explode(F.array(*[
        F.struct(F.lit(x).alias('metric'), F.col(x).cast('double').alias('value')) for x in names])).alias('r')) \
        .select(F.lit('engineering').alias('report'), 'item', 'r.*')
    ms = profile.mean_std(feat, ['log_price', c.size])
    ms = ms.select(F.lit('mean_std').alias('report'), F.concat_ws('.', 'split', 'column').alias('item'), F.explode(F.array(
        F.struct(F.lit('mean').alias('metric'), F.col('mean').alias('value')),
        F.struct(F.lit('std').alias('metric'), F.col('std').alias('value')))).alias('r')).select('report', 'item', 'r.*')
    return long.unionByName(ms)


# --- stages after the split (fits on train only) -----------------------------------

def outlier_rules(df: DataFrame, cfg: PrepareConfig, corrections: DataFrame = None):
    """F7, F8, C8, C6 on the split table. Returns (df, logs, params).

    The size z-parameters and the price median are fitted on the training rows
    (price is not touched by F7/F8, so fitting before them is the same as after)."""
    c = cfg.cols
    train = df.filter("split = 'train'")
    m = train.agg(F.avg(c.size).alias('m'), F.stddev_samp(c.size).alias('s')).first()
    r = {'m': m['m'], 's': m['s'], 'med': exact_quantiles(train, [c.price], [0.5])[c.price][0]}
    zp_train = outliers.ZParams({c.size: r['m']}, {c.size: r['s']})
    zp = zp_train if cfg.fit_scope == 'train' else None
    df, size_log = outliers.resolve_size_outliers(df, c.size, c.text, c.key, 'split', cfg.z, zp)
    df, bed_log = outliers.resolve_room_outliers(df, c.bedroom, c.text, c.key)
    logs = {'size_outliers': size_log, 'bedroom_outliers': bed_log}
    if corrections is not None:
        df, unmatched = clean.apply_corrections(df, corrections, c.key)
        logs['corrections_unmatched'] = unmatched
    # without a price among the training rows there is no threshold, and no cell is invalid
    threshold = None if r['med'] is None else r['med'] * C.PARKING_PRICE_SHARE
    cond = (F.col(c.parking) >= C.PARKING_LIMIT) & (F.col(c.price) < F.lit(threshold).cast('double'))
    df, park_log = clean.invalidate_if(df, c.parking, cond, c.key)
    logs['parking_invalid'] = park_log
    return df, logs, {'parking_price_threshold': threshold, 'size_z_train': zp_train}


def fixed_features(df: DataFrame, cfg: PrepareConfig = PrepareConfig(), only=None) -> DataFrame:
    """E12-E14, H1-H2 and the fixed encodings I1-I3 (no fitted values). With `only` the
    features it names alone, so that `df` may be without the others' inputs."""
    c = cfg.cols
    land = encode.merge_values(F.col(c.land_title), C.LAND_TITLE_MERGE)
    made = {
        **features.columns(c.address, c.year, c.facilities, list(c.nearby), ref=cfg.reference_year),
        c.land_title: land,
        'Is_Non_Bumi_Lot': encode.binary_map(land, C.LAND_TITLE_MAP),
        'Freehold_Indicator': encode.binary_map(F.col(c.tenure), C.TENURE_MAP),
        'Floor_Range_Ordinal': encode.ordinal_map(F.col(c.floor_range), C.FLOOR_RANGE_ORDER),
    }
    return df.withColumns({n: e for n, e in made.items() if only is None or n in only})


def rule_columns(cfg: PrepareConfig = PrepareConfig()) -> list:
    """What outlier_rules() reads and writes."""
    c = cfg.cols
    return [c.key, 'split', c.price, c.size, c.bedroom, c.parking, c.text]


def feature_inputs(cols, cfg: PrepareConfig = PrepareConfig()) -> list:
    """The split table's columns that fixed_features() makes `cols` of; those it doesn't make are their own."""
    c = cfg.cols
    made = {'state': c.address, 'property_age': c.year, 'listed_facility_count': c.facilities,
            **{features.flag_name(n): n for n in c.nearby}, 'Is_Non_Bumi_Lot': c.land_title,
            'Freehold_Indicator': c.tenure, 'Floor_Range_Ordinal': c.floor_range}
    return [made.get(x, x) for x in cols]


def facility_items(cfg: PrepareConfig = PrepareConfig()):
    return X.parse_list(F.col(cfg.cols.facilities))


@dataclass
class PreparedTable:
    data: DataFrame                      # final features + key, split, price, log_price
    scaled: DataFrame                    # log1p version of the same rows
    eda: DataFrame                       # A6 snapshot (train only)
    params: dict = field(default_factory=dict)
    logs: dict = field(default_factory=dict)
    reports: dict = field(default_factory=dict)


#: Holds facility_items() beside the featured rows, so that the lists are parsed once.
ITEMS = '__facility_items'


def encode_fit_apply(df: DataFrame, cfg: PrepareConfig):
    """I5-I7 fitted on train, applied to all rows, which have their parsed facilities in
    ITEMS. Returns (df, eda, params, reports)."""
    c = cfg.cols
    items = F.col(ITEMS)
    train = df.filter("split = 'train'")
    # an item that shares its name with a presence flag gets a name of its own; the others keep theirs
    mh = encode.fit_items(train, items, taken=tuple(f"Has_{n}" for n in c.nearby), max_categories=cfg.max_columns)
    out = encode.apply_items(df, c.key, items, mh)
    unseen = encode.unseen_items(out.filter("split = 'test'"), items, mh)
    out = out.drop(ITEMS)
    eda = out.filter("split = 'train'").drop(*EDA_DROP, 'log_price', 'split')
    out = clean.fill_constant(out, {'state': 'Unknown'})
    fitted = encode.fit_rare_one_hot(out.filter("split = 'train'"), {
        'state': (cfg.rare_state, 'State'), c.property_type: (cfg.rare_type, 'PropertyType')}, max_categories=cfg.max_columns)
    (rs, oh_s), (rt, oh_t) = fitted['state'], fitted[c.property_type]
    out = encode.apply_rare(encode.apply_rare(out, rs), rt)
    # a test value the training rows never had is not a category: all zeros
    out = encode.apply_one_hot(encode.apply_one_hot(out, oh_s), oh_t)
    params = {'multi_hot': mh, 'rare_state': rs, 'rare_type': rt, 'one_hot_state': oh_s,
              'one_hot_type': oh_t}
    return out, eda, params, {'unseen_facilities': unseen}


def prepare(raw: DataFrame, cfg: PrepareConfig = PrepareConfig(), corrections: DataFrame = None,
            checkpoint: bool = True, strict: bool = True) -> PreparedTable:
    """The whole job. With `strict` the table fails while it is read or written when a
    feature outside `cfg.may_miss` still has a missing cell (B11)."""
    c = cfg.cols
    watch = observed.Watch() if checkpoint else None  # without a write here there is no pass to watch
    n = pass_count(raw) if checkpoint else 1
    df, logs = until_split(raw, cfg, watch if n == 1 else None)
    passed = None
    if checkpoint:
        sides = [F.coalesce(F.sum((F.col('split') == x).cast('long')), F.lit(0)).alias(x) for x in ('train', 'test')]
        df = materialize(watch.rows(df, 'split', *sides), 'split-stage') if n == 1 else split_in_passes(raw, cfg, watch, n, *sides)
        passed = pass_reports(watch, raw)
    df, olog, oparams = outlier_rules(df, cfg, corrections)
    logs.update(olog)
    # The encoder and imputation fits, the accounting and the caller all read the
    # featured rows: keep them once, as a table (a cache takes several times its size
    # and stays on the executors' disks), or without a checkpoint in the cache.
    df = fixed_features(df, cfg).withColumn(ITEMS, facility_items(cfg))
    df = materialize(df, 'featured-stage') if checkpoint else df.persist(StorageLevel.MEMORY_AND_DISK)
    featured = feature_reports(df, cfg)
    df, eda, eparams, ereports = encode_fit_apply(df, cfg)
    eda = eda.withColumn(c.price, F.bround(F.col(c.price), 0).cast('long'))
    df, drop_report = clean.drop_columns(df, {'no_engineering': DROP_NO_ENGINEERING,
                                              'replaced': DROP_REPLACED})
    mp = impute.fit_median(df.filter("split = 'train'"), IMPUTE_SPEC)
    df = impute.apply_median(df, mp)
    if strict:
        df = profile.require_no_missing(df, [x for x in feature_columns(df, cfg) if x not in cfg.may_miss])
    scaled = impute.log1p_columns(df, SCALE_COLS)
    params = {**oparams, **eparams, 'medians': mp}
    feats = feature_columns(df, cfg)
    reports = {'drop': drop_report, **ereports, 'features': featured, **({'pass': passed} if passed is not None else {}),
               'summary': summary(raw, df, feats, params, cfg)}
    return PreparedTable(df, scaled, eda, params, logs, reports)


def feature_columns(df: DataFrame, cfg: PrepareConfig = PrepareConfig()):
    c = cfg.cols
    return [x for x in df.columns if x not in (c.key, 'split', c.price, 'log_price')]


def summary(raw: DataFrame, final: DataFrame, feats, params: dict, cfg: PrepareConfig) -> DataFrame:
    """Accounting table (item, result), every number computed by Spark."""
    raw_cols = set(raw.columns)
    retained = [x for x in feats if x in raw_cols]
    engineered = [x for x in feats if x not in raw_cols]
    dropped = DROP_NO_ENGINEERING + DROP_REPLACED
    # a sparse column stands for as many features as it has categories
    inside = sum(params[p].width - 1 for p in ('multi_hot', 'one_hot_state', 'one_hot_type') if isinstance(params[p], SparseParams))
    spark = final.sparkSession
    n_split = final.groupBy('split').agg(F.count(F.lit(1)).alias('n'))
    counts = n_split.agg(
        F.sum('n').cast('long').alias('rows'),
        F.sum(F.when(F.col('split') == 'train', F.col('n'))).cast('long').alias('train'),
        F.sum(F.when(F.col('split') == 'test', F.col('n'))).cast('long').alias('test'))
    miss = profile.total_missing(final.select(*feats))
    torn = dedup.torn_groups(final.select(*feats, 'log_price', 'split'), feats + ['log_price'], sides=('train', 'test'))
    fixed = spark.createDataFrame([
        ('raw_features_retained', len(retained)),
        ('raw_features_dropped', len(dropped)),
        ('engineered_features', len(engineered) + inside),
        ('state_one_hot_columns', params['one_hot_state'].width),
        ('property_type_one_hot_columns', params['one_hot_type'].width),
        ('missing_indicator_flags', sum(1 for v in IMPUTE_SPEC.values() if v)),
        ('final_features', len(feats) + inside),
    ], 'item string, result long')
    def rows(frame, pairs):
        return frame.select(F.explode(F.array(*[
            F.struct(F.lit(item).alias('item'), F.col(c).cast('long').alias('result')) for item, c in pairs]))
            .alias('r')).select('r.*')
    return (fixed
            .unionByName(rows(counts, [('rows_entering_split', 'rows'), ('train_rows', 'train'),
                                       ('test_rows', 'test')]))
            .unionByName(rows(miss, [('remaining_missing', 'missing')]))
            .unionByName(rows(torn, [('torn_groups', 'torn_groups')])))
