"""Steps that run once, on the rows that need them, with short state."""

import pytest
from pyspark.sql import functions as F

from tableprep.functions import text as X
from tableprep.operators import clean, dedup, extract, outliers, profile
from tableprep.plans import prepare as PP
from tableprep.sources.fixtures import LISTING_COLUMNS


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_merge_state_holds_the_short_rank(spark):
    rows = [(1, 'é', None, 1.5, None), (1, 'z', 'ü', None, b'\x00'), (1, None, '', 2.5, None), (2, None, None, None, None),
            (3, '', 'a', -0.5, b'x'), (3, 'b', None, None, None), (None, 'q', 'q', 1.0, b'q')]
    df = spark.createDataFrame(rows, 'k long, a string, b string, d double, x binary')
    by = lambda f: sorted(map(str, f.collect()))
    ranked = df.filter('k IS NOT NULL').withColumn('o', dedup.row_order(df.columns))
    plain = ranked.groupBy('k').agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), F.col('o'))).alias(c) for c in 'abdx'])
    merged = dedup.merge_by_key(df, 'k')
    assert by(merged) == by(plain)
    assert merged.schema == df.schema and 'struct' not in plan(merged)  # no struct of text in a column's state


@pytest.mark.parametrize('n', [2, 40])
def test_rank_orders_like_row_order(spark, n):
    cols = [f"c{i}" for i in range(n)]
    df = spark.range(60).select(*[F.when(F.pmod(F.hash('id', F.lit(i)), F.lit(3)) > 0, F.col('id').cast('string')).alias(c) for i, c in enumerate(cols)])
    df = df.withColumns({'o': dedup.row_order(cols), 'r': dedup.row_rank(cols)})
    assert [x['o'] for x in df.orderBy('o').collect()] == [x['o'] for x in df.orderBy('r', 'o').collect()]
    assert df.select('r').distinct().count() == df.select('o').distinct().count()
    assert df.select(F.max(F.length('r'))).first()[0] == 17


def test_torn_groups_by_sides(spark):
    df = spark.createDataFrame([(1, 'train'), (1, 'test'), (2, 'train'), (2, 'train'), (3, 'test'), (None, 'train'), (None, 'test')], 'a int, split string')
    sides = dedup.torn_groups(df, ['a'], sides=('train', 'test'))
    assert sides.collect() == dedup.torn_groups(df, ['a']).collect() == [(2, 3)]
    assert 'SortAggregate' not in plan(sides)


def test_text_is_searched_in_rows_that_need_it(spark):
    """The evidence raises where it is worked out for a row that doesn't need it."""
    df = spark.createDataFrame([(1, None, '2 bedrooms'), (2, 3.0, 'x'), (3, 50.0, '900 sqft')], 'k long, v double, t string')
    only = lambda ok, ev: F.when(ok, ev).otherwise(F.raise_error(F.lit('searched')).cast('double'))
    out, log = extract.recover_from_text(df, 'v', only(F.col('v').isNull(), X.extract_rooms('t', 'bed')), 'k')
    assert [r['v'] for r in out.orderBy('k').collect()] == [2.0, 3.0, 50.0] and log.count() == 1
    assert log.first()['evidence'] == 2.0
    out, log = extract.correct_from_text(df, 'v', only(F.col('v') > 40, X.extract_size('t')), F.col('v') > 40, 'k')
    assert [r['v'] for r in out.orderBy('k').collect()] == [None, 3.0, 900.0] and log.first()['evidence'] == 900.0


def test_outlier_evidence_of_flagged_rows_alone(spark, monkeypatch):
    df = spark.createDataFrame([(i, 100.0 if i else 9000.0, 2.0 if i else 9.0, 'normal' if i else '900 sqft, 4 bedrooms') for i in range(40)],
                               'k long, s double, b double, t string').withColumn('split', F.lit('train'))
    for name in ('extract_size_source', 'extract_bedrooms_strict'):
        real = getattr(X, name)
        monkeypatch.setattr(X, name, lambda t, real=real: F.when(t != 'normal', real(t)).otherwise(F.raise_error(F.lit('searched'))))
    out, log = outliers.resolve_size_outliers(df, 's', 't', 'k')
    assert out.filter('k = 0').first()['s'] == 900.0 and [r['reason'] for r in log.collect()] == ['digit_shift']
    out, log = outliers.resolve_room_outliers(df, 'b', 't', 'k')
    assert out.filter('k = 0').first()['b'] == 4.0 and log.count() == 1


def test_numbers_found_in_texts(spark):
    df = spark.createDataFrame([('1,000.5 sq.ft.',), (',, sq.ft.',), (',.5 sq.ft.',), ('sq.ft.',), ('',), (None,)], 't string')
    assert [r[0] for r in df.select(X.before_unit('t')).collect()] == [1000.5, None, 0.5, None, None, None]
    df = spark.createDataFrame([('1, sqft',), ('12. sq ft',), ('no',), (None,)], 't string')
    assert [r[0] for r in df.select(X.extract_size('t')).collect()] == [1.0, 12.0, None, None]
    assert [r[0] for r in df.select(X.number_in_text('t', r'(no|1d)')).collect()] == [None] * 4


def test_title_case_of_plain_words(spark):
    texts = ['swimming pool', 'BBQ', ' a  b ', '', "o'neil park", '3rd floor', 'éa b', 'ﬁre', 'x\ty', 'iPhone İ', 'tennis-court']
    df = spark.createDataFrame([(t,) for t in texts], 't string')
    assert [r[0] for r in df.select(X.title_case('t')).collect()][:8] == [t.title() for t in texts[:7]] + [df.filter("t = 'ﬁre'").select(X.title_case('t')).first()[0]]
    assert [r[0] for r in df.select(X.title_case('t')).collect()][8] == 'x\ty'.title()


def test_lists_are_parsed_once(spark, monkeypatch):
    rows = [(i, f"RM {i} 000", f"{900 + i} sq.ft.", '2', '1', '2020', '5', '50', '1', 'Melaka', 'sauna, Pool, 10' if i % 2 else None, 'Flat', 'Low',
             'Freehold', 'Bumi Lot', None, None, '-', 'x') for i in range(1, 41)]
    raw = spark.createDataFrame(rows, 'ad_id long, ' + ', '.join(f"{c} string" for c in LISTING_COLUMNS[1:]))
    real, calls = PP.facility_items, []
    monkeypatch.setattr(PP, 'facility_items', lambda cfg: calls.append(1) or real(cfg))
    p = PP.prepare(raw)
    assert len(calls) == 1 and p.params['multi_hot'].vocabulary == ('Pool', 'Sauna')
    assert PP.ITEMS not in p.data.columns + p.eda.columns + p.scaled.columns
    assert p.data.select(F.sum('Has_Sauna')).first()[0] == 20 and p.reports['unseen_facilities'].count() == 0


def test_whole_rows_are_compared_only_where_hashes_meet(spark):
    rows = [(1, 'a', None), (1, 'a', None), (1, None, 'a'), (2, 'b', 'c'), (3, None, None), (3, None, None), (3, None, None), (4, 'a', None)]
    df = spark.createDataFrame(rows, 'k long, a string, b string')
    assert profile.rows_with_likeness(df, ['k', 'a', 'b']).filter('k IN (2, 4)').count() == 0
    assert tuple(profile.duplicate_rows(df).first()) == (3, 2, 5)
    assert tuple(profile.duplicate_rows(df.limit(0)).first()) == (0, 0, 0)


def test_what_leads_up_to_a_fit_runs_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    df = spark.range(200, numPartitions=2).select(F.col('id').alias('k'), F.col('id').cast('double').alias('v')).mapInArrow(count, 'k long, v double')
    assert clean.tail_review(df, 'v', 0.01, 'k').count() == 2 and seen.value == 200
    seen.value = 0
    df = spark.createDataFrame([(1, 'p', 't'), (2, 'p', 't'), (3, 'p', 'u'), (4, 'q', 'u')], 'k long, a string, t string').mapInArrow(count, 'k long, a string, t string')
    got = sorted(map(tuple, dedup.collapse_near_duplicates(df.filter('k <> 3'), ['k', 't'], 't', 'k').collect()))
    assert got == [(1, 'p', 't'), (4, 'q', 'u')] and seen.value == 4
