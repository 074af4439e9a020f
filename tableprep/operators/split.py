"""Deterministic train/test splits.

A row's side is a pure function of (seed, key): the first 32 bits of
md5(seed|key) compared with frac·2³². It needs no sort, no shuffle and no
driver state, is identical for any partitioning, survives executor loss
(recomputed tasks give the same answer), and is reproducible in SQL engines
that have md5.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPACE = 4294967296  # 2**32


def hash_bucket(seed: int, *cols) -> Column:
    """Unsigned 32-bit bucket from md5(seed|c1|c2...) (NULL-safe serialisation)."""
    parts = [F.coalesce(F.col(c).cast('string') if isinstance(c, str) else c.cast('string'),
                        F.lit('\u0000')) for c in cols]
    h = F.md5(F.concat_ws('|', F.lit(str(seed)), *parts))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast('long')


def split_random(df: DataFrame, key: str, test_frac: float = 0.2, seed: int = 42,
                 out: str = 'split') -> DataFrame:
    """G1: row-level split on the key hash (expected test share = test_frac)."""
    b = hash_bucket(seed, key)
    return df.withColumn(out, F.when(b < F.lit(int(test_frac * _SPACE)), 'test').otherwise('train'))


def _digest(seed: int, *cols) -> Column:
    """All 128 bits behind hash_bucket(), as text that sorts like the number."""
    parts = [F.coalesce(F.col(c).cast('string'), F.lit('\u0000')) for c in cols]
    return F.md5(F.concat_ws('|', F.lit(str(seed)), *parts))


def kth_digest(digests: DataFrame, col: str, k: int, ranked: int = 4096) -> str:
    """The k-th smallest (from 1) of a column of md5 texts. Each round counts rows by
    the next three digits under the prefix found so far, 4096 numbers at most, and goes
    into the bucket that holds the k-th; a bucket of up to `ranked` rows is
    read and counted off. No row is sorted, nothing depends on the partitioning."""
    prefix, size = '', None
    while len(prefix) < 32:
        inside = digests.filter(F.col(col).startswith(prefix)) if prefix else digests
        if size is not None and size <= ranked:
            for r in sorted(inside.groupBy(col).agg(F.count(F.lit(1)).alias('n')).collect()):
                if k <= r['n']:
                    return r[col]
                k -= r['n']
        digits = F.substring(col, len(prefix) + 1, 3).alias('d')
        for r in sorted(inside.groupBy(digits).agg(F.count(F.lit(1)).alias('n')).collect()):
            if k <= r['n']:
                prefix, size = prefix + r['d'], r['n']
                break
            k -= r['n']
        else:
            raise ValueError("fewer rows than k")
    return prefix


def split_exact(df: DataFrame, key: str, test_frac: float = 0.2, seed: int = 42, out: str = 'split') -> DataFrame:
    """G1 with an exact size: the ceil(test_frac * n) rows with the smallest key digests
    are the test side, n being the rows of `df`. Rows that repeat a key stay on one side,
    so with repeated keys the test side is the least set of whole keys of at least that
    size. The key column is written once; its digests are selected by counting."""
    import math

    from tableprep.session import materialize
    digests = materialize(df.select(_digest(seed, key).alias('h')), 'split-digests')
    n = digests.count()
    k = min(n, math.ceil(round(test_frac * n, 9)))
    if k <= 0:
        return df.withColumn(out, F.lit('train'))
    last = kth_digest(digests, 'h', k)
    return df.withColumn(out, F.when(_digest(seed, key) <= F.lit(last), 'test').otherwise('train'))


def split_grouped(df: DataFrame, group_cols, test_frac: float = 0.2, seed: int = 42,
                  out: str = 'split') -> DataFrame:
    """Group-aware split — the hash runs over the group's columns, so all
    rows of a group land on one side without building a group table."""
    # grouping takes -0.0 and 0.0 for one value, so their text must be one as well
    kinds = dict(df.dtypes)
    b = hash_bucket(seed, *[F.col(c) + F.lit(0.0).cast(kinds[c]) if kinds.get(c) in ('double', 'float') else c for c in group_cols])
    return df.withColumn(out, F.when(b < F.lit(int(test_frac * _SPACE)), 'test').otherwise('train'))


def split_report(df: DataFrame, split: str = 'split') -> DataFrame:
    """Rows per side and share of the total."""
    g = df.groupBy(split).agg(F.count(F.lit(1)).alias('rows'))
    total = g.agg(F.sum('rows')).first()[0]                              # one row per side
    return g.select(split, 'rows', F.round(F.col('rows') / F.lit(total), 3).alias('share'))


def log_label(df: DataFrame, col: str, out: str = None) -> DataFrame:
    """Natural-log label (NULL outside the domain); the raw column is kept."""
    return df.withColumn(out or f"log_{col}", F.ln(F.col(col)))


def back_transform(c: Column) -> Column:
    """Exp of a log label, rounded half-to-even to a whole amount."""
    return F.bround(F.exp(c), 0).cast('long')
