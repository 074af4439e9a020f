"""Fitted stages carry the columns that are read on, and give the same rows."""

import pytest
from pyspark.errors import AnalysisException

from tableprep.plans import prepare as PP
from tableprep.registry import base
from tableprep.session import materialize
from tableprep.sources.fixtures import LISTING_COLUMNS


@pytest.fixture(scope='module')
def listings(spark):
    row = lambda i: (i // 2, f"RM {i} 000", f"{900 + i} sq.ft." if i < 38 else '90000 sq.ft.', '2' if i % 3 else '-', '1', str(2000 + i), '5' if i % 4 else '-',
                     '50', str(i % 6), 'Melaka' if i % 2 else 'x, Johor', 'sauna, Pool, 10' if i % 2 else None, 'Flat', 'Low' if i % 5 else 'Unknown',
                     'Freehold' if i % 2 else 'Leasehold', 'Bumi Lot', 'p' if i % 3 else None, None, 'm' if i % 2 else '-', 'x')
    return spark.createDataFrame([row(i) for i in range(40)], 'ad_id long, ' + ', '.join(f"{c} string" for c in LISTING_COLUMNS[1:]))


def test_carried_columns_give_the_whole_stage(spark, listings, monkeypatch):
    monkeypatch.setattr(base, 'raw', lambda *a: listings)
    whole = base.stage(spark, '', 'feat').cache()
    for cols in (PP.SCALE_COLS, ['state', 'Has_school', 'Has_mall', 'property_type', 'price', 'facilities', 'Is_Non_Bumi_Lot', 'Freehold_Indicator']):
        want = ['ad_id', 'split', *cols]
        got = base.stage(spark, '', 'feat', cols).select(*want).collect()
        assert sorted(map(str, got)) == sorted(map(str, whole.select(*want).collect())) and len(got) == 20
    whole.unpersist()


def test_only_carried_columns_are_merged_and_written(spark, listings, monkeypatch):
    written = []
    monkeypatch.setattr(base, 'raw', lambda *a: listings)
    monkeypatch.setattr(base, 'materialize', lambda df, name: written.append(df) or materialize(df, name))
    df = base.stage(spark, '', 'feat', ['Has_mall'])
    assert set(written[0].columns) == {*PP.rule_columns(), 'mall'}
    plan = written[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count('min_by') == len(PP.rule_columns())  # with the mall and the type that the scope asks for, without the key and the split
    assert all(f"{c}#" in plan for c in LISTING_COLUMNS)  # whole rows are ranked
    with pytest.raises(AnalysisException):
        df.select('floors')
