"""Profiling aggregates.

Every report is one aggregate pass over the table (partial aggregation on each
partition, a single tiny final stage) followed by an unpivot of the one-row
result into long form. No per-column jobs, no collects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableprep.operators.quantile import exact_quantiles
from tableprep.session import materialize


def _long(row: DataFrame, names, value_cols: dict, name_col: str = 'column') -> DataFrame:
    """Unpivot a one-row aggregate whose columns are `{alias}__{name}`."""
    structs = [F.struct(F.lit(n).alias(name_col),
                        *[F.col(f"{a}__{i}").alias(a) for a in value_cols])
               for i, n in enumerate(names)]
    return row.select(F.explode(F.array(*structs)).alias('r')).select('r.*')


def profile_shape(df: DataFrame) -> DataFrame:
    """B1: per column: type, non-null count and total rows (one pass)."""
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias('rows')]
    aggs += [F.count(F.col(f"`{c}`")).alias(f"non_null__{i}") for i, c in enumerate(cols)]
    row = df.agg(*aggs)
    types = {c: df.schema[c].dataType.simpleString() for c in cols}
    structs = [F.struct(F.lit(c).alias('column'), F.lit(i).alias('position'),
                        F.lit(types[c]).alias('data_type'),
                        F.col(f"non_null__{i}").alias('non_null'), F.col('rows'))
               for i, c in enumerate(cols)]
    return row.select(F.explode(F.array(*structs)).alias('r')).select('r.*')


def head_rows(df: DataFrame, n: int = 5, order_by=None) -> DataFrame:
    """B1: first rows (deterministic when an order is given)."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def profile_distinct(df: DataFrame, cols=None, approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """B2: distinct non-null values per column."""
    cols = cols or df.columns
    fn = (lambda c: F.approx_count_distinct(F.col(f"`{c}`"), rsd)) if approx \
        else (lambda c: F.count_distinct(F.col(f"`{c}`")))
    row = df.agg(*[fn(c).alias(f"n_distinct__{i}") for i, c in enumerate(cols)])
    return _long(row, cols, {'n_distinct': None})


def shared_hashes(marked: DataFrame) -> DataFrame:
    """The values of `__hash` that several rows have, as a table of its true size."""
    return materialize(marked.groupBy('__hash').count().filter('count > 1').select('__hash'), 'shared-hashes')


def rows_with_likeness(df: DataFrame, cols) -> DataFrame:
    """Rows whose hash over `cols` another row shares. Equal rows are all among them, so
    a comparison of whole rows needs no others: every row sends its hash alone. Reads
    `df` twice."""
    marked = df.withColumn('__hash', F.xxhash64(*[F.col(f"`{c}`") for c in cols]))
    return marked.join(shared_hashes(marked), '__hash', 'left_semi').drop('__hash')


def duplicate_rows(df: DataFrame, subset=None) -> DataFrame:
    """Rows beyond the first among rows equal on `subset` (NULL == NULL). Reads
    `df` twice, so it should be cheap to read."""
    subset = subset or df.columns
    g = rows_with_likeness(df, subset).groupBy(*[F.col(f"`{c}`") for c in subset]).count()
    return g.agg(F.coalesce(F.sum(F.col('count') - 1), F.lit(0)).cast('long').alias('duplicate_rows'),
                 F.coalesce(F.sum(F.when(F.col('count') > 1, 1)), F.lit(0)).cast('long').alias('groups'),
                 F.coalesce(F.sum(F.when(F.col('count') > 1, F.col('count'))), F.lit(0)).cast('long')
                 .alias('rows_in_groups'))


def null_count_columns(df: DataFrame, cols=None) -> DataFrame:
    cols = cols or df.columns
    aggs = [F.count(F.lit(1)).alias('rows')]
    aggs += [F.sum(F.col(f"`{c}`").isNull().cast('long')).alias(f"missing__{i}") for i, c in enumerate(cols)]
    row = df.agg(*aggs)
    structs = [F.struct(F.lit(c).alias('column'),
                        F.coalesce(F.col(f"missing__{i}"), F.lit(0)).cast('long').alias('missing_count'),
                        F.col('rows'))
               for i, c in enumerate(cols)]
    return row.select(F.explode(F.array(*structs)).alias('r')).select('r.*')


def missing_by_column(df: DataFrame, cols=None, only_missing: bool = True) -> DataFrame:
    """Missing count and percent (1 decimal) per column, >0 only, most missing first."""
    out = null_count_columns(df, cols).select(
        'column', 'missing_count',
        F.round(F.col('missing_count') * 100.0 / F.col('rows'), 1).alias('missing_pct'))
    out = out.filter('missing_count > 0') if only_missing else out
    return out.orderBy(F.desc('missing_count'), 'column')          # one row per column


def null_count_expr(cols) -> Column:
    return sum((F.col(f"`{c}`").isNull().cast('int') for c in cols), F.lit(0))


def missing_per_row(df: DataFrame) -> DataFrame:
    """Distribution of missing cells per row (count/mean/std/min/quartiles/max)."""
    return _missing_per_row(df.select(null_count_expr(df.columns).alias('m')))


def _missing_per_row(m: DataFrame) -> DataFrame:
    q = F.percentile(F.col('m'), [0.25, 0.5, 0.75])  # of counts of columns: as many values as columns at most
    return m.agg(F.count('m').alias('count'), F.avg('m').alias('mean'),
                 F.stddev_samp('m').alias('std'), F.min('m').cast('double').alias('min'),
                 q.alias('q'), F.max('m').cast('double').alias('max')).select(
        'count', 'mean', 'std', 'min', F.col('q')[0].alias('p25'), F.col('q')[1].alias('p50'),
        F.col('q')[2].alias('p75'), 'max')


def non_null_counts(df: DataFrame, cols) -> DataFrame:
    """Non-null count of each listed column."""
    row = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"non_null__{i}") for i, c in enumerate(cols)])
    return _long(row, cols, {'non_null': None})


def missing_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """Missing per column before and after a step (columns missing on either side)."""
    b = null_count_columns(before).select('column', F.col('missing_count').alias('missing_before'))
    a = null_count_columns(after).select('column', F.col('missing_count').alias('missing_after'))
    j = b.join(a, 'column', 'full_outer')
    return j.select('column', F.coalesce('missing_before', F.lit(0)).alias('missing_before'),
                    F.coalesce('missing_after', F.lit(0)).alias('missing_after')) \
        .withColumn('difference', F.col('missing_after') - F.col('missing_before')) \
        .filter('missing_before > 0 OR missing_after > 0')


def total_missing(df: DataFrame) -> DataFrame:
    return df.agg(F.coalesce(F.sum(null_count_expr(df.columns)), F.lit(0)).cast('long').alias('missing'))


def value_range(df: DataFrame, cols) -> DataFrame:
    """Min and max of numeric columns."""
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.min(F.col(f"`{c}`")).cast('double').alias(f"min__{i}"),
                 F.max(F.col(f"`{c}`")).cast('double').alias(f"max__{i}")]
    return _long(df.agg(*aggs), cols, {'min': None, 'max': None})


def value_counts(df: DataFrame, col: str, dropna: bool = True) -> DataFrame:
    """Count per value, descending (missing excluded unless dropna=False)."""
    src = df.filter(F.col(f"`{col}`").isNotNull()) if dropna else df
    return src.groupBy(F.col(f"`{col}`").alias('value')).agg(F.count(F.lit(1)).alias('count')) \
        .orderBy(F.desc('count'), F.asc_nulls_first('value'))


def indicator_totals(df: DataFrame, cols) -> DataFrame:
    """Totals of 0/1 indicator columns."""
    row = df.agg(*[F.coalesce(F.sum(F.col(f"`{c}`")), F.lit(0)).cast('long').alias(f"total__{i}")
                   for i, c in enumerate(cols)])
    return _long(row, cols, {'total': None}).orderBy(F.desc('total'), 'column')


def assert_no_missing(df: DataFrame) -> int:
    """Raise when any cell is missing; returns the (zero) count."""
    n = total_missing(df).first()['missing']
    if n:
        raise AssertionError(f"{n} missing cells remain")
    return n


def require_no_missing(df: DataFrame, cols) -> DataFrame:
    """B11 inside the plan: the job that writes `df` fails at the first row with a
    missing cell in `cols`, naming its columns; no pass of its own. A filter, so
    that column pruning can't take the check away."""
    names = F.concat_ws(', ', *[F.when(F.col(f"`{c}`").isNull(), F.lit(c)) for c in cols])
    bad = F.raise_error(F.concat(F.lit('missing cells remain in: '), names)).cast('boolean')
    return df.filter(F.when(null_count_expr(cols) > 0, bad).otherwise(F.lit(True))) if cols else df


def mean_std(df: DataFrame, cols, by: str = 'split') -> DataFrame:
    """Mean and sample std per column and group."""
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.avg(F.col(f"`{c}`")).alias(f"mean__{i}"), F.stddev_samp(F.col(f"`{c}`")).alias(f"std__{i}")]
    g = df.groupBy(by).agg(*aggs)
    structs = [F.struct(F.lit(c).alias('column'), F.col(f"mean__{i}").alias('mean'),
                        F.col(f"std__{i}").alias('std')) for i, c in enumerate(cols)]
    return g.select(by, F.explode(F.array(*structs)).alias('r')).select(by, 'r.*')


STAT_ORDER = ['Count', 'Mean', 'Median', 'Standard deviation', 'Minimum',
              '25th percentile', '75th percentile', 'Maximum']


def describe_table(df: DataFrame, spec: dict) -> DataFrame:
    """Statistics × variables over non-missing parsed values.

    `spec` = {label: (column, rule)} with rule a name in functions.text.RULES
    or a Column-producing callable. One projection parses every variable, the
    quantiles of all are read as a fit, one aggregate computes the other
    statistics, then the result is unpivoted and pivoted back to one column per
    label (labels are known up front, so the pivot needs no extra pass).
    """
    from tableprep.functions.text import RULES
    labels = list(spec)
    # parsed once: the fits and the statistics read the numbers
    parsed = materialize(df.select(*[
        (RULES[rule](F.col(f"`{c}`")) if isinstance(rule, str) else rule(F.col(f"`{c}`"))).alias(f"v{i}")
        for i, (c, rule) in enumerate(spec.values())]), 'parsed')
    fitted = exact_quantiles(parsed, parsed.columns, [0.5, 0.25, 0.75])
    aggs = []
    for i in range(len(labels)):
        v = F.col(f"v{i}")
        q = [F.lit(x).cast('double') for x in fitted[f"v{i}"]]
        aggs += [F.count(v).cast('double').alias(f"Count__{i}"),
                 F.round(F.avg(v), 4).alias(f"Mean__{i}"),
                 q[0].alias(f"Median__{i}"),
                 F.round(F.stddev_samp(v), 4).alias(f"Standard deviation__{i}"),
                 F.min(v).alias(f"Minimum__{i}"),
                 q[1].alias(f"25th percentile__{i}"),
                 q[2].alias(f"75th percentile__{i}"),
                 F.max(v).alias(f"Maximum__{i}")]
    row = parsed.agg(*aggs)
    long = row.select(F.explode(F.array(*[
        F.struct(F.lit(s).alias('statistic'), F.lit(k).alias('pos'), F.lit(lab).alias('label'),
                 F.col(f"`{s}__{i}`").alias('value'))
        for k, s in enumerate(STAT_ORDER) for i, lab in enumerate(labels)])).alias('r')).select('r.*')
    return long.groupBy('statistic', 'pos').pivot('label', labels).agg(F.first('value')) \
        .orderBy('pos').drop('pos')


def column_screen(df: DataFrame, max_card: int, cols=None) -> DataFrame:
    """Distinct count per column with a drop reason (constant / high cardinality)."""
    d = profile_distinct(df, cols)
    return d.withColumn('reason', F.when(F.col('n_distinct') <= 1, F.lit('constant'))
                        .when(F.col('n_distinct') > max_card, F.lit('high_cardinality')))


def presence_subset(df: DataFrame, pairs) -> DataFrame:
    """For each (a, b): rows where a is filled but b is not; a ⊂ b holds when 0."""
    aggs = [F.coalesce(F.sum((F.col(f"`{a}`").isNotNull() & F.col(f"`{b}`").isNull()).cast('long')),
                       F.lit(0)).alias(f"violations__{i}") for i, (a, b) in enumerate(pairs)]
    row = df.agg(*aggs)
    structs = [F.struct(F.lit(a).alias('column'), F.lit(b).alias('within'),
                        F.col(f"violations__{i}").alias('violations'),
                        (F.col(f"violations__{i}") == 0).alias('holds'))
               for i, (a, b) in enumerate(pairs)]
    return row.select(F.explode(F.array(*structs)).alias('r')).select('r.*')


def identity_check(df: DataFrame, checks: dict) -> DataFrame:
    """For each named boolean expression: rows where it holds / fails / is unknown."""
    aggs = []
    for i, e in enumerate(checks.values()):
        e = F.expr(e) if isinstance(e, str) else e
        aggs += [F.coalesce(F.sum(F.when(e, 1)), F.lit(0)).cast('long').alias(f"holds__{i}"),
                 F.coalesce(F.sum(F.when(~e, 1)), F.lit(0)).cast('long').alias(f"fails__{i}"),
                 F.coalesce(F.sum(F.when(e.isNull(), 1)), F.lit(0)).cast('long').alias(f"unknown__{i}")]
    return _long(df.agg(*aggs), list(checks), {'holds': None, 'fails': None, 'unknown': None},
                 name_col='check')


def summary_table(items: list) -> DataFrame:
    """B17 helper: (item, result) rows from already-computed one-row frames."""
    from functools import reduce
    parts = [f.select(F.lit(name).alias('item'), F.col(c).cast('string').alias('result'))
             for name, f, c in items]
    return reduce(DataFrame.unionByName, parts)

