"""Cases at the edge: constant, collinear and empty columns, -0.0, missing categories."""

from pyspark.sql import functions as F

from tableprep.operators import clean, dedup, outliers, split, stats


def test_constant_column_flags_nothing(spark):
    df = spark.createDataFrame([(1.0, 'a'), (1.0, 'a'), (None, 'b')], 'x double, g string')
    p = outliers.fit_zscore(df, ['x'])
    assert [r['x_z_outlier'] for r in outliers.zscore_flags(df, p).collect()] == [False] * 3
    assert [r['__z'] for r in outliers.zscore_by_group(df, 'x', 'g').collect()] == [None] * 3


def test_collinear_pair_flags_nothing(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i) for i in range(5)], 'x double, y double')
    p = outliers.fit_mahalanobis(df, 'x', 'y')
    assert not any(r['mahalanobis_outlier'] for r in outliers.mahalanobis_flags(df, p).collect())


def test_statistics_without_variation_are_missing(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, 'g', i % 2) for i in range(4)], 'x double, y double, g string, f int')
    assert stats.pearson(df, ['x'], 'y').first()['t'] is None
    assert stats.anova(df, 'g', 'y').first()['f'] is None
    assert stats.flag_effect(df.withColumn('y', F.col('f') * 3.0), 'f', 'y').first()['t'] is None
    assert stats.kde(df.withColumn('x', F.lit(1.0)), 'x').count() == 0
    assert stats.kde(df.limit(0), 'x').count() == 0
    assert outliers.fit_iqr(df.limit(0), ['x'], 1.5).lo('x') is None


def test_grouped_split_keeps_signed_zeros_together(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,)], 'g double')
    for seed in range(12):
        assert split.split_grouped(df, ['g'], seed=seed).select('split').distinct().count() == 1


def test_duplicate_impact_counts_missing_categories(spark):
    df = spark.createDataFrame([(1, None, 5), (2, None, 5), (3, 'a', 5)], 'id int, c string, v int')
    got = {r['c']: (r['rows'], r['surplus']) for r in dedup.duplicate_impact(df, 'c', ['id']).collect()}
    assert got == {None: (2, 1), 'a': (1, 0)}


def test_last_correction_wins_and_bad_text_is_missing(spark):
    df = spark.createDataFrame([(1, 10, 1), (2, 20, 2)], 'k int, v int, w int')
    fixes = spark.createDataFrame([(1, 'v', '11', '', 1), (1, 'v', '12', '', 2), (2, 'w', 'x', '', 3), (9, 'v', '1', '', 4)],
                                  'k int, column string, value string, note string, seq int')
    out, unmatched = clean.apply_corrections(df, fixes, 'k')
    assert sorted(map(tuple, out.collect())) == [(1, 12, 1), (2, 20, None)]
    assert [r['k'] for r in unmatched.collect()] == [9]
