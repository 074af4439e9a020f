"""Rows are not shuffled by a key of two values."""

from pyspark.sql import functions as F

from tableprep.operators import outliers
from tableprep.session import materialize


def test_group_moments_do_not_shuffle_rows(spark):
    """Beside a table whose size passes the broadcast threshold by far."""
    df = materialize(spark.range(30000).select('id', F.when(F.col('id') % 7 > 0, F.when(F.col('id') % 5 > 0, 'train').otherwise('test')).alias('split'),
                                               (F.col('id') % 11).cast('double').alias('v')))
    name = 'spark.sql.autoBroadcastJoinThreshold'
    old = spark.conf.get(name)
    spark.conf.set(name, '20000')
    try:
        out = outliers.zscore_by_group(df, 'v', 'split')
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = out.agg(F.count(F.lit(1)), F.count('__z'), F.count(F.when(F.col('split').isNull(), 1))).first()
    finally:
        spark.conf.set(name, old)
    assert 'BroadcastHashJoin' in plan and 'SortMergeJoin' not in plan
    assert tuple(got) == (30000, 30000 - 4286, 4286)  # without a group there is no z
