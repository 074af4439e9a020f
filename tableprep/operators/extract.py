"""Evidence recovery and correction from free text.

Both are one projection plus a log built from the same expressions; the log is
(key, column, original, evidence, final, reason) and stays lazy. The text is searched
in the rows that need it alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def recover_from_text(df: DataFrame, col: str, evidence: Column, key: str):
    """Fill missing `col` from the text evidence; log every attempt."""
    staged = df.withColumn('__ev', F.when(_q(col).isNull(), evidence))
    log = staged.filter(_q(col).isNull()).select(
        _q(key).alias('key'), F.lit(col).alias('variable'),
        F.lit(None).cast('double').alias('original'), F.col('__ev').alias('evidence'),
        F.col('__ev').alias('final'))
    out = staged.withColumn(col, F.coalesce(_q(col), F.col('__ev'))).drop('__ev')
    return out, log


def correct_from_text(df: DataFrame, col: str, evidence: Column, when: Column, key: str,
                      round_all: bool = True):
    """For rows matching `when`, replace `col` by the text evidence
    (missing evidence → missing); then round half-to-even."""
    cond = F.coalesce(when, F.lit(False))
    staged = df.withColumn('__ev', F.when(cond, evidence))
    new = F.when(cond, F.col('__ev')).otherwise(_q(col))
    final = F.bround(new, 0) if round_all else new
    log = staged.filter(cond).select(
        _q(key).alias('key'), _q(col).cast('double').alias('original'),
        F.col('__ev').alias('evidence'), F.bround(F.col('__ev'), 0).alias('final'))
    out = staged.withColumn(col, final).drop('__ev')
    return out, log
