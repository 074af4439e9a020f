"""Large tables go pass by pass over a key's values: the same rows, and no shuffle files left between passes."""

import os
import time
from datetime import datetime

import pytest

from tableprep import session
from tableprep.config import PrepareConfig
from tableprep.operators import dedup
from tableprep.plans import prepare as PP
from tableprep.registry import base
from tableprep.registry.base import round_doubles
from tableprep.registry.catalog import QUERIES
from tableprep.sources import fixtures, io
from tableprep.sources.fixtures import LISTING_COLUMNS


def rows(df) -> list:
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def shuffle_files(spark, but=frozenset()) -> set:
    """Those there after up to five seconds: they are removed in the background."""
    for _ in range(50):
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        names = {files.apply(i).getName() for i in range(files.size())}
        found = {x for x in names if x.startswith('shuffle_') and x.endswith('.data')} - but
        if not found:
            break
        time.sleep(0.1)
    return found


@pytest.fixture(scope='module')
def listings(spark):
    row = lambda i: (i // 2 if i != 7 else None, f"RM {i % 30} 000", f"{900 + i} sq.ft.", '2' if i % 3 else '-', '1', str(2000 + i % 9), '5' if i % 4 else '-',
                     '50', str(i % 6), 'Melaka' if i % 2 else 'x, Johor', 'sauna, Pool, 10' if i % 2 else None, 'Flat' if i % 9 else 'Others',
                     'Low' if i % 5 else 'Unknown', 'Freehold' if i % 2 else 'Leasehold', 'Bumi Lot', 'p' if i % 3 else None, None, 'm' if i % 2 else '-', f"x\n{i}")
    made = [row(i) for i in range(60)]
    made += made[:9] + [(1000 + r[0], *r[1:]) for r in made[20:30]] + [(2000 + r[0], *r[1:-1], 'other') for r in made[26:40]]
    df = spark.createDataFrame(made, 'ad_id long, ' + ', '.join(f"{c} string" for c in LISTING_COLUMNS[1:]))
    return session.materialize(df, 'listings-in-passes')


def test_equal_keys_are_in_one_pass(spark):
    df = spark.createDataFrame([(i % 40 if i % 11 else None, i) for i in range(300)], 'k long, v long')
    parts = [session.in_pass(df, ['k'], 4, i).collect() for i in range(4)]
    assert sorted(r['v'] for p in parts for r in p) == list(range(300)) and all(parts)
    keys = [{r['k'] for r in p} for p in parts]
    assert sum(map(len, keys)) == len(set().union(*keys)) == 41


def test_no_shuffle_files_stay(spark):
    df = session.materialize(spark.range(5000).selectExpr('id % 700 AS k', 'id AS v'))
    before = shuffle_files(spark)
    counted = session.materialize(df.groupBy('k').count())
    assert not shuffle_files(spark, before)
    left = []

    def make(part):
        left.append(shuffle_files(spark, before))
        return part.groupBy('k').count()
    out = session.in_passes(df, ['k'], make, 'counted', 4)
    assert left == [set()] * 4 and not shuffle_files(spark, before)
    assert rows(out) == rows(counted) and out.count() == 700
    names = os.listdir(out.inputFiles()[0].replace('file:', '').rsplit('/', 1)[0])
    assert '_SUCCESS' in names
    assert spark.conf.get('spark.sql.classic.shuffleDependency.fileCleanup.enabled', None) in (None, 'false')


def test_folder_is_complete_after_the_last_pass(spark, tmp_path):
    def make(i):
        if i == 2:
            raise ValueError('stopped')
        return spark.range(i, i + 1)
    with pytest.raises(ValueError):
        session.write_passes(f"{tmp_path}/t", 3, make)
    assert not os.path.exists(f"{tmp_path}/t/_SUCCESS")
    session.write_passes(f"{tmp_path}/t", 3, lambda i: spark.range(i, i + 1))
    assert os.path.exists(f"{tmp_path}/t/_SUCCESS") and spark.read.parquet(f"{tmp_path}/t").count() == 3


def test_listings_in_passes(spark, tmp_path, monkeypatch):
    made = {
        'lineitem': ([(o if o else None, o % 5, o % 7, n, 17.0, 36901.5, 'N', 'O', datetime(1995, 3, 1)) for o in range(40) for n in (1, 4, 4, 6)],
                     'l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, '
                     'l_returnflag string, l_linestatus string, l_shipdate timestamp'),
        'orders': ([(o, o % 3 or None) for o in range(38)] + [(None, 1), (5, 1)], 'o_orderkey long, o_custkey long'),
        'customer': ([(1, 3, 'AUTO'), (2, 4, None), (None, 3, 'x')], 'c_custkey long, c_nationkey int, c_mktsegment string'),
        'nation': ([(3, 'a'), (4, 'b')], 'n_nationkey int, n_name string'),
        'part': ([(p, 'name', 'Brand', 'LARGE', p) for p in range(4)], 'p_partkey long, p_name string, p_brand string, p_type string, p_size int'),
    }
    for name, (data, schema) in made.items():
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    monkeypatch.setattr(session, 'PASS_ROWS', 20)
    calls, plan = [], fixtures.listings_plan
    monkeypatch.setattr(fixtures, 'listings_plan', lambda *a: calls.append(a[2:]) or plan(*a))
    got = fixtures.listings(spark, str(tmp_path))
    assert calls == [(4, 0), (4, 1), (4, 2), (4, 3)]
    want = spark.sql(f"WITH {fixtures.LISTINGS_CTE} SELECT * FROM listings")
    assert rows(got) == rows(want) and want.count() > 50 and got.columns == LISTING_COLUMNS


@pytest.mark.parametrize('name', ['a4_write_evidence', 'd3_key_conflicts', 'd5_merge_by_key', 'a3_write_stage', 'h3_engineering_report'])
def test_query_in_passes(spark, listings, monkeypatch, name):
    monkeypatch.setattr(base, 'raw', lambda *a: listings)
    want = rows(QUERIES[name](spark, ''))
    monkeypatch.setattr(session, 'PASS_ROWS', 50)
    real, parts = session.in_pass, []
    monkeypatch.setattr(session, 'in_pass', lambda df, cols, n, i: parts.append((n, i)) or real(df, cols, n, i))
    assert rows(QUERIES[name](spark, '')) == want and want
    assert {(2, 0), (2, 1)} <= set(parts)


def test_near_duplicates_of_repeated_and_missing_keys(spark, monkeypatch):
    df = spark.createDataFrame([(1, 'p', 't'), (1, 'q', 'u'), (2, 'p', 't'), (3, 'q', 'u'), (None, 'r', 't'), (None, 'r', 't'), (4, None, None), (5, None, None),
                                (6, None, 'x'), (7, 's', 'a'), (8, 's', 'b'), (9, 'z', 'y')], 'k long, a string, t string')
    exempt = spark.createDataFrame([(7,)], 'k long')
    run = lambda: [rows(x) for x in (dedup.near_duplicate_groups(df, ['k', 't'], 't', 'k'),
                                     dedup.collapse_near_duplicates(df, ['k', 't'], 't', 'k', exempt), dedup.duplicate_impact(df, 'a', ['k', 't']))]
    want = run()
    monkeypatch.setattr(session, 'PASS_ROWS', 5)  # 3 passes over all rows, 2 over those alike
    assert run() == want and all(want)
    assert {(r['a'], r['rows'], r['surplus']) for r in dedup.duplicate_impact(df, 'a', ['k', 't']).collect()} \
        == {('p', 2, 1), ('q', 2, 1), ('r', 2, 1), (None, 3, 2), ('s', 2, 1), ('z', 1, 0)}


def test_prepare_in_passes(spark, listings, monkeypatch):
    cfg = PrepareConfig(exact_split=True)  # keys of all passes are split together
    want = PP.prepare(listings, cfg)
    monkeypatch.setattr(session, 'PASS_ROWS', 50)
    got = PP.prepare(listings, cfg)
    assert rows(got.data) == rows(want.data) and rows(got.eda) == rows(want.eda)
    for r in ('pass', 'features'):  # sums of doubles differ in their last bits
        assert rows(round_doubles(got.reports[r])) == rows(round_doubles(want.reports[r]))
    assert rows(got.reports['summary']) == rows(want.reports['summary'])


def test_featured_rows_are_a_table(spark, listings):
    cached = spark._jsparkSession.sharedState().cacheManager()
    spark.catalog.clearCache()
    PP.prepare(listings)
    assert cached.isEmpty()


def test_csv_is_compressed(spark, listings, tmp_path):
    io.write_csv(listings, f"{tmp_path}/csv")
    files = [x for x in os.listdir(f"{tmp_path}/csv") if x.startswith('part-')]
    assert files and all(x.endswith('.csv.gz') for x in files)
    back = io.read_table(spark, f"{tmp_path}/csv", listings.schema)
    assert back.count() == listings.count() and back.filter("description LIKE 'x\n%'").count() == listings.filter("description LIKE 'x\n%'").count()


@pytest.mark.parametrize('name', ['b10_indicator_totals', 'b16_identity_check', 'h3_engineering_report'])
def test_reports_carry_the_columns_they_read(spark, listings, monkeypatch, name):
    monkeypatch.setattr(base, 'raw', lambda *a: listings)
    written, real = [], session.materialize
    monkeypatch.setattr(base, 'materialize', lambda df, name: written.append(df) or real(df, name))
    QUERIES[name](spark, '').collect()
    assert 'floors' not in written[0].columns and set(PP.rule_columns()) < set(written[0].columns)
