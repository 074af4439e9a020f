"""The listings come from one run of the join, with the rows of the SQL that DuckDB runs."""

import re
from datetime import datetime

from tableprep.sources import fixtures


def test_join_runs_once_and_gives_the_union(spark, tmp_path):
    day = datetime(1995, 3, 1)
    line = lambda o, n, p=1, s=1: (o, p, s, n, 17.0, 36901.5, 'N', 'O', day)
    rows = [line(o, n, p, s) for o, n, p, s in [(12, 4, 401, 2), (25, 0, 13, 25), (0, 1, 1, 40), (18, 6, 1, 1), (37, 3, 2, 3), (93, 2, 1, 5), (3, 2, None, 1)]]
    rows += [line(12, 4, 401, 2), line(None, 4), line(12, None), line(18, 6)]
    made = {
        'lineitem': (rows, 'l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, '
                           'l_returnflag string, l_linestatus string, l_shipdate timestamp'),
        'orders': ([(o, o % 2 or None) for o in (0, 12, 18, 25, 37, 93)] + [(37, 1), (12, 1), (18, 1)], 'o_orderkey long, o_custkey long'),
        'customer': ([(1, 3, 'AUTO'), (1, 4, None), (None, 3, 'x')], 'c_custkey long, c_nationkey int, c_mktsegment string'),
        'nation': ([(3, 'a'), (4, 'b')], 'n_nationkey int, n_name string'),
        'part': ([(p, 'name', 'Brand', 'LARGE', p % 50) for p in (1, 2, 13, 401)], 'p_partkey long, p_name string, p_brand string, p_type string, p_size int'),
    }
    for name, (data, schema) in made.items():
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    got = fixtures.listings_plan(spark, str(tmp_path))
    want = spark.sql(f"WITH {fixtures.LISTINGS_CTE} SELECT * FROM listings")
    assert got.dtypes == want.dtypes
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    kinds = [(r['ad_id'] >= 100000000, r['description'].endswith('NEGO')) for r in got.collect() if r['ad_id'] is not None]
    assert {(False, False), (True, True), (True, False)} <= set(kinds)
    assert len(re.findall(r'FileScan parquet \[l_orderkey', fixtures.listings_plan(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString())) == 1
