"""Exact quantiles with linear interpolation (pandas/NumPy 'linear' method), in memory
that doesn't follow the number of distinct values.

Three scans of the columns serve all columns, groups and ranks together, and no row is
copied. The first takes a `percentile_approx` sketch per group and column, asked a little
below and above each rank; its error is bounded, so the wanted rank lies between the two
answers or right beside them. The second counts how many values lie below and above each
pair of answers, and the values next to them. The third counts the values between them,
which only rows that have such a value reach. What one group's window orders is those
distinct values: about 8 / ACCURACY of the group's rows at most, whatever the distribution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tableprep.session import materialize

#: Rank error of a sketch is one ACCURACY-th of its group's rows.
ACCURACY = 100_000

#: Fitted rows that come through the driver; a longer table is written and read back.
#: Either way Spark knows the table's bytes, and picks the join by them.
READ_ROWS = 1_000


def _q(c: str):
    return F.col(f"`{c}`")


def join_fitted(df: DataFrame, fitted: DataFrame, by) -> DataFrame:
    """Inner join of rows to their group's fitted row, missing group values included.
    The fitted table is worked out first, so that Spark joins by its true size: a small
    one is broadcast and rows of a hot group stay where they are; beside a large one a
    hot group's rows are split by AQE's skew join."""
    head = fitted.limit(READ_ROWS + 1).collect()
    fitted = df.sparkSession.createDataFrame(head, fitted.schema) if len(head) <= READ_ROWS else materialize(fitted, 'fitted')
    fitted = fitted.withColumnsRenamed({b: f"__on{i}" for i, b in enumerate(by)})
    cond = F.lit(True)
    for i, b in enumerate(by):
        cond = cond & _q(b).eqNullSafe(F.col(f"__on{i}"))
    return df.join(fitted, cond).drop(*[f"__on{i}" for i in range(len(by))])


def quantile_table(df: DataFrame, by, cols, probs, accuracy: int = ACCURACY) -> DataFrame:
    """(*by, column, q): per group and column the array of exact quantiles over its
    non-missing values. Groups without any give no row."""
    by, cols, probs = list(by), list(cols), list(probs)
    groups = [f"__k{i}" for i in range(len(by))]
    vs = [f"__v{i}" for i in range(len(cols))]
    rows = df.select(*[_q(b).alias(k) for b, k in zip(by, groups)], *[_q(c).cast('double').alias(v) for c, v in zip(cols, vs)])

    aside = 4.0 / accuracy
    edges = [e for p in probs for e in (max(0.0, p - aside), min(1.0, p + aside))]
    sketch = rows.groupBy(*groups).agg(*[F.percentile_approx(v, edges, accuracy).alias(f"__e{i}") for i, v in enumerate(vs)])
    if groups:
        rows = join_fitted(rows, sketch, groups)
        edge = lambda i, e: F.col(f"__e{i}")[e]
    else:  # one row: its answers are literals
        found = sketch.first()
        edge = lambda i, e: F.lit(found[i][e] if found[i] else None).cast('double')
    asked = [(i, j, F.col(v), edge(i, 2 * j), edge(i, 2 * j + 1)) for i, v in enumerate(vs) for j in range(len(probs))]

    def cell(i, j, val, m):
        return F.struct(F.lit(cols[i]).alias('__c'), F.lit(j).alias('__i'), val.alias('__val'), m.cast('long').alias('__m'))

    # values outside the answers are one cell a side; only the one next to them can be wanted
    n = len(asked)
    outside = rows.groupBy(*groups).agg(*[e for k, (_, _, v, lo, hi) in enumerate(asked) for e in (
        F.count(F.when(v < lo, 1)).alias(f"__b{k}"), F.max(F.when(v < lo, v)).alias(f"__bv{k}"),
        F.count(F.when(v > hi, 1)).alias(f"__a{k}"), F.min(F.when(v > hi, v)).alias(f"__av{k}"))])
    outside = outside.select(*groups, F.explode(F.array(*[
        cell(asked[k][0], asked[k][1], F.col(f"__{s}v{k}"), F.col(f"__{s}{k}")) for k in range(n) for s in 'ba'])).alias('r')) \
        .select(*groups, 'r.*').filter('__m > 0')
    hits = [(v >= lo) & (v <= hi) for _, _, v, lo, hi in asked]
    some = hits[0]
    for h in hits[1:]:
        some = some | h
    inside = rows.filter(some).select(*groups, F.explode(F.array_compact(F.array(*[
        F.when(h, F.struct(F.lit(cols[i]).alias('__c'), F.lit(j).alias('__i'), v.alias('__val'))) for h, (i, j, v, _, _) in zip(hits, asked)]))).alias('r')) \
        .select(*groups, 'r.*').groupBy(*groups, '__c', '__i', '__val').agg(F.count(F.lit(1)).alias('__m'))
    counted = outside.unionByName(inside)
    keys = [*groups, '__c']
    rank = Window.partitionBy(*keys, '__i')
    ranked = counted.withColumn('__up', F.sum('__m').over(rank.orderBy('__val'))) \
        .withColumn('__n', F.sum('__m').over(rank))

    pos = [F.lit(float(p)) * (F.col('__n') - 1) for p in probs]
    reach = [F.min(F.when((F.col('__i') == i) & (F.col('__up') > edge(x)), F.col('__val'))).alias(f"{name}{i}")
             for i, x in enumerate(pos) for name, edge in (('__a', F.floor), ('__b', F.ceil))]
    found = ranked.groupBy(*keys).agg(F.max('__n').alias('__n'), *reach)
    out = []
    for i, x in enumerate(pos):
        a, b = F.col(f"__a{i}"), F.col(f"__b{i}")
        out.append(F.when(a == b, a).otherwise((F.ceil(x) - x) * a + (x - F.floor(x)) * b))
    return found.select(*[F.col(k).alias(b) for k, b in zip(keys, by)], F.col('__c').alias('column'),
                        F.array(*out).alias('q'))


def exact_quantiles(df: DataFrame, cols, probs, accuracy: int = ACCURACY) -> dict:
    """{column: [quantile per prob]} over the non-missing values of each column (one
    row a column is read); a column without values has None."""
    cols, probs = list(cols), list(probs)
    got = {r['column']: list(r['q']) for r in quantile_table(df, [], cols, probs, accuracy).collect()}
    return {c: got.get(c, [None] * len(probs)) for c in cols}
