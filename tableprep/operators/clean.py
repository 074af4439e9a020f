"""Projections, filters and value fixes.

Every mutating operator is a single projection or filter; where the original
job printed the affected rows, the operator also returns a lazily built log
DataFrame (never collected row by row).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableprep.functions import text as X
from tableprep.operators import profile as P
from tableprep.operators.quantile import exact_quantiles
from tableprep.session import materialize


def _q(c: str):
    return F.col(f"`{c}`")


def string_columns(df: DataFrame):
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def trim_strings(df: DataFrame, cols=None) -> DataFrame:
    """Strip Unicode whitespace in every string column (one projection)."""
    cols = cols or string_columns(df)
    return df.withColumns({c: X.strip_ws(_q(c)) for c in cols})


def find_sentinels(df: DataFrame, candidates, cols=None) -> DataFrame:
    """Which candidate tokens occur, in how many cells and columns.

    Unpivots the string columns and keeps candidate cells only, so the shuffle
    carries at most |candidates| groups with map-side partial counts.
    """
    cols = cols or string_columns(df)
    cand = list(candidates)
    cells = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias('column'), _q(c).alias('value')) for c in cols])).alias('r')) \
        .select('r.*').filter(F.col('value').isin(cand))
    return cells.groupBy(F.col('value').alias('sentinel')).agg(
        F.count(F.lit(1)).alias('cells'), F.count_distinct('column').alias('columns'))


def standardise_missing(df: DataFrame, tokens, cols=None) -> DataFrame:
    """Whole-value sentinel tokens → NULL in every string column."""
    cols = cols or string_columns(df)
    toks = list(tokens)
    return df.withColumns({c: F.when(~_q(c).isin(toks), _q(c)) for c in cols})


def clean_missing(df: DataFrame, tokens, cols=None) -> DataFrame:
    """C1 + C3: strip, then sentinel → NULL (row-local, no shuffle)."""
    cols = cols or string_columns(df)
    toks = list(tokens)
    # two projections: the stripped value is computed once and then tested
    # (Catalyst keeps them apart rather than inlining a non-trivial alias twice)
    stripped = df.withColumns({c: X.strip_ws(_q(c)) for c in cols})
    return stripped.withColumns({c: F.when(~_q(c).isin(toks), _q(c)) for c in cols})


def remove_category(df: DataFrame, col: str, value) -> DataFrame:
    """C4: drop rows whose `col` equals `value`; missing values are kept."""
    return df.filter(~_q(col).eqNullSafe(F.lit(value)))


def invalidate_above(df: DataFrame, col: str, limit, key: str):
    """Values above `limit` → NULL. Returns (df, log of affected rows)."""
    bad = _q(col) > F.lit(limit)
    log = df.filter(bad).select(key, _q(col).alias('old_value'))
    return df.withColumn(col, F.when(~bad | bad.isNull(), _q(col))), log


def invalidate_if(df: DataFrame, col: str, cond, key: str):
    """C6 (apply side): set `col` to NULL where `cond` holds; returns (df, log)."""
    cond = F.coalesce(cond, F.lit(False))
    log = df.filter(cond).select(key, _q(col).alias('old_value'))
    return df.withColumn(col, F.when(~cond, _q(col))), log


def tail_review(df: DataFrame, col: str, q: float, key: str) -> DataFrame:
    """Rows at or below the q-quantile of `col` (threshold as a column)."""
    df = materialize(df.select(_q(key), _q(col)), 'tail')  # the fit scans it three times: what leads up to it runs once
    thr = exact_quantiles(df, [col], [q])[col][0]                         # one-row fit
    return df.filter(_q(col) <= F.lit(thr)).select(key, col, F.lit(thr).cast('double').alias('threshold'))


def apply_corrections(df: DataFrame, corrections: DataFrame, key: str):
    """Set listed columns to confirmed values for listed keys.

    `corrections` has columns (key, column, value, note); values are text and
    are cast to the target column's type (missing where they can't be). Where a
    cell has several fixes, the one with the largest `seq` wins if there is such
    a column, else the largest value. Returns (df, unmatched keys).
    """
    cols = [r['column'] for r in corrections.select('column').distinct().collect()]
    unknown = set(cols) - set(df.columns)
    if unknown:
        raise ValueError(f"corrections name unknown columns: {sorted(unknown)}")
    wide = corrections.groupBy(F.col(key)).pivot('column', cols).agg(F.max_by('value', 'seq') if 'seq' in corrections.columns else F.max('value'))
    wide = wide.select(key, *[F.col(f"`{c}`").alias(f"__fix_{i}") for i, c in enumerate(cols)],
                       F.lit(True).alias('__fixed'))
    j = df.join(wide, key, 'left')
    out = j.withColumns({
        c: F.when(F.col('__fixed') & F.col(f"__fix_{i}").isNotNull(),
                  F.col(f"__fix_{i}").try_cast(df.schema[c].dataType)).otherwise(_q(c))
        for i, c in enumerate(cols)}).select(*df.columns)
    there = df.select(key).join(corrections.select(key).distinct(), key, 'left_semi').distinct()
    unmatched = corrections.join(there, key, 'left_anti')
    return out, unmatched


def strip_token(df: DataFrame, col: str, regex: str = r',\s*10\s*$', keys=None, key: str = None):
    """Remove a trailing junk token; for listed keys only or for every row."""
    fixed = F.regexp_replace(_q(col), regex, '')
    if keys is not None:
        fixed = F.when(_q(key).isin(list(keys)), fixed).otherwise(_q(col))
    changed = F.coalesce(fixed != _q(col), F.lit(False))
    log = df.filter(changed).select(key or F.lit(None).alias('key'),
                                    _q(col).alias('before'), fixed.alias('after'))
    return df.withColumn(col, fixed), log


def drop_columns(df: DataFrame, stages: dict):
    """Drop named column lists; report (stage, column, non_null) taken before."""
    cols = [c for cs in stages.values() for c in cs]
    counts = P.non_null_counts(df, cols)
    stage_of = F.create_map(*[x for s, cs in stages.items() for c in cs for x in (F.lit(c), F.lit(s))])
    report = counts.select(stage_of[F.col('column')].alias('stage'), 'column', 'non_null')
    return df.drop(*cols), report


def keep_categories(df: DataFrame, col: str, cats):
    """C11: keep rows whose `col` is in `cats`; counts of the excluded values."""
    inside = _q(col).isin(list(cats))
    kept = df.filter(inside)
    excluded = df.filter(~inside).groupBy(_q(col).alias('value')).agg(F.count(F.lit(1)).alias('count'))
    return kept, excluded


def convert_columns(df: DataFrame, rules: dict):
    """Typed conversion of text columns with a report.

    `rules` = {column: rule name in functions.text.RULES}. All conversions run
    in one projection; the report (rule, non-null before/after, failures) is one
    aggregate over the originals and the converted values side by side.
    """
    conv = {c: X.RULES[r](_q(c)) for c, r in rules.items()}
    side = df.select(*[_q(c).alias(f"b{i}") for i, c in enumerate(rules)],
                     *[conv[c].alias(f"a{i}") for i, c in enumerate(rules)])
    aggs = []
    for i in range(len(rules)):
        aggs += [F.count(f"b{i}").alias(f"before__{i}"), F.count(f"a{i}").alias(f"after__{i}")]
    row = side.agg(*aggs)
    report = row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias('column'), F.lit(r).alias('rule'),
                 F.col(f"before__{i}").alias('non_null_before'),
                 F.col(f"after__{i}").alias('non_null_after'),
                 (F.col(f"before__{i}") - F.col(f"after__{i}")).alias('failures'))
        for i, (c, r) in enumerate(rules.items())])).alias('r')).select('r.*')
    return df.withColumns(conv), report


def fill_constant(df: DataFrame, values: dict) -> DataFrame:
    """Constant fill of missing values (same on every split)."""
    return df.withColumns({c: F.coalesce(_q(c), F.lit(v)) for c, v in values.items()})


def union_all(frames):
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
