"""Rows with a key of their own are neither compared, merged nor unpivoted."""

from pyspark.sql import functions as F

from tableprep.operators import dedup

ROWS = [(1, 'a', None), (1, 'a', None), (1, None, 'x'), (2, 'b', 'y'), (3, None, None), (None, 'n', 'n'), (None, 'n', 'n'), (None, 'm', None)]


def test_apart_by_key(spark):
    df = spark.createDataFrame(ROWS, 'k long, a string, b string')
    alone, rest = dedup.apart(df, 'k')
    assert {r['k'] for r in alone.collect()} == {2, 3} and rest.count() == 6
    one = dedup.apart(spark.createDataFrame(ROWS[4:6], df.schema), 'k')  # a missing key of one row is a key of its own
    assert one[0].count() == 2 and one[1].count() == 0


def test_results_are_those_of_the_whole_table(spark):
    df = spark.createDataFrame(ROWS, 'k long, a string, b string')
    rows = lambda x: sorted(map(tuple, x.collect()), key=str)
    assert rows(dedup.drop_exact(df, 'k')) == rows(df.distinct())
    assert rows(dedup.merge_repeated(df, 'k')) == rows(dedup.merge_by_key(df, 'k')) == [(1, 'a', 'x'), (2, 'b', 'y'), (3, None, None)]
    assert rows(dedup.key_conflicts(df.union(spark.createDataFrame([(1, 'z', 'x')], df.schema)), 'k')) == [(1, 'a', 'a', 2), (1, 'a', 'z', 2)]


def test_lone_rows_are_not_shuffled_whole(spark):
    """Only rows of repeated keys reach the wide aggregation and the unpivoting."""
    df = spark.range(5000).select('id', F.repeat(F.lit('x'), 50).alias('a'), F.col('id').cast('string').alias('b'))
    df = df.union(df.limit(3))
    alone, rest = dedup.apart(df, 'id')
    assert (alone.count(), rest.count()) == (4997, 6)
    plan = dedup.merge_repeated(df, 'id')._jdf.queryExecution().optimizedPlan().toString()
    assert 'LeftAnti' in plan and plan.index('Aggregate') < plan.index('LeftSemi')
