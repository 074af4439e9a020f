"""A1's load-time types: which texts are missing, and the narrowest type of each column.

A type vote is one aggregate over the text table: per column, how many values are
there and how many of them each type could hold. The narrowest type that holds them
all is taken; nothing is sampled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableprep import config as C

#: From narrow to wide; a value that fits one fits those it leads to.
LATTICE = ('boolean', 'bigint', 'double', 'date', 'timestamp_ntz')


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def read(c: Column, kind: str) -> Column:
    """The text as `kind`, missing where it isn't one."""
    if kind == 'boolean':
        return F.when(F.lower(c) == 'true', True).when(F.lower(c) == 'false', False)
    if kind == 'bigint':
        return F.when(c.rlike(r'^\s*[+-]?[0-9]+\s*$'), F.trim(c).try_cast('bigint'))
    if kind == 'double':
        return F.when(c.rlike(C.NUMERIC_TEXT), F.trim(c).try_cast('double'))
    if kind == 'date':
        return F.when(c.rlike(r'^[0-9]{4}-[0-9]{2}-[0-9]{2}$'), c.try_cast('date'))
    if kind == 'timestamp_ntz':
        return F.when(c.rlike(r'^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?)?$'), c.try_cast('timestamp_ntz'))
    return c


def without_missing(df: DataFrame, tokens=tuple(C.LOAD_MISSING)) -> DataFrame:
    """Text cells that are one of `tokens`, as they stand, become missing."""
    return df.withColumns({c: F.when(~_q(c).isin(list(tokens)), _q(c)) for c, t in df.dtypes if t == 'string'})


def type_vote(df: DataFrame) -> DataFrame:
    """(column, present, *types): values there, and how many of them each type holds."""
    cols = [c for c, t in df.dtypes if t == 'string']
    row = df.agg(*[e for i, c in enumerate(cols) for e in (
        F.count(_q(c)).alias(f"n__{i}"), *[F.count(read(_q(c), k)).alias(f"{k}__{i}") for k in LATTICE])])
    return row.select(F.explode(F.array(*[F.struct(
        F.lit(c).alias('column'), F.col(f"n__{i}").alias('present'), *[F.col(f"{k}__{i}").alias(k) for k in LATTICE])
        for i, c in enumerate(cols)])).alias('r')).select('r.*')


def infer(df: DataFrame) -> dict[str, str]:
    """{column: type} of the text columns: the first of LATTICE that holds every value;
    text where none does or where there is no value."""
    if not any(t == 'string' for _, t in df.dtypes):
        return {}
    return {r['column']: next((k for k in LATTICE if r['present'] and r[k] == r['present']), 'string')
            for r in type_vote(df).collect()}  # a row per column


def typed(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    return df.withColumns({c: read(_q(c), k) for c, k in kinds.items() if k != 'string'})


def load(df: DataFrame, tokens=tuple(C.LOAD_MISSING)) -> DataFrame:
    """A text table with its missing tokens and types as a loader would give them."""
    df = without_missing(df, tokens)
    return typed(df, infer(df))
