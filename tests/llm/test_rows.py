"""What happens to rows: repeated and null ids, helper columns that clash, hard
histograms for the packing planner."""

import collections
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tableprep.llm import mixing, packing, pii, simjoin
from tableprep.llm.common import fresh

LONG = " ".join(f"w{i}" for i in range(60))
OTHER = " ".join(f"v{i}" for i in range(60))


def rows_of(spark, rows, clash=""):
    kinds = "doc_id long, text string, source string" + clash
    return spark.createDataFrame([(i, t, "s", *["x"] * clash.count(",")) for i, t in rows], kinds)


def test_fresh_names(spark):
    assert fresh(spark.createDataFrame([(1, 2, 3)], "__Id int, ___id int, m int"), "__id", "m", "m", "q") == ["____id", "_m", "__m", "q"]


def test_rows_under_one_id_go_by_their_own_texts(spark):
    near = LONG + " tail"
    rows = [(3, LONG), (7, near), (7, OTHER), (8, LONG), (8, near), (None, LONG), (None, LONG + " end"), (None, "own words only here now"), (9, ""), (9, ""), (9, None), (None, " ")]
    kept = simjoin.keep_one(rows_of(spark, rows, ", __drop string, __at string, __hash string, __r string"))
    assert kept.columns == ["doc_id", "text", "source", "__drop", "__at", "__hash", "__r"]
    got = collections.Counter((r["doc_id"], r["text"]) for r in kept.collect())
    assert got == collections.Counter([(3, LONG), (7, OTHER), (None, "own words only here now"), (9, ""), (9, ""), (9, None), (None, " ")])
    # where ids are null alone, or near copies share one id, one row stays
    assert simjoin.keep_one(rows_of(spark, [(None, LONG), (None, near)])).count() == 1
    assert simjoin.keep_one(rows_of(spark, [(5, LONG), (5, near), (5, LONG)])).count() == 1
    assert simjoin.keep_one(rows_of(spark, [])).count() == 0


def test_mix_and_redaction_take_any_column_names(spark):
    clash = ", __id string, __key string, __n string, __m string, __copy string, __copies string, __doc string, __md5 string, __spans string, __order string"
    df = rows_of(spark, [(i % 5, f"a b c {i % 3}") for i in range(40)] + [(None, None), (1, "mail a@b.example.com")], clash)
    out = mixing.mixed(df)
    assert out.columns == df.columns
    takes = mixing.mix(df).agg(F.sum("copies")).first()[0]
    assert out.count() == takes
    cut = pii.redact(df)
    assert cut.columns == df.columns and cut.count() == df.count() and cut.where("text like '%[EMAIL]%'").count() == 1
    assert mixing.mixed(df.limit(0)).count() == 0 and pii.redact(df.limit(0)).count() == 0


def test_many_equal_rows_meet_by_number(spark):
    df = rows_of(spark, [(1, "a b c")] * 3000 + [(2, "d e")] * 5)
    assert mixing.mixed(df).count() == mixing.mix(df).agg(F.sum("copies")).first()[0]
    assert "__m" in mixing.mixed(df)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["400-899", "600-1000", "all", "one", "halves"])
def test_planner_work_is_bounded_on_hard_histograms(name):
    demand = {"400-899": dict.fromkeys(range(400, 900), 6), "600-1000": dict.fromkeys(range(600, 1001), 25),
              "all": dict.fromkeys(range(1, 2048), 50), "one": {1500: 7}, "halves": {1024: 9, 1025: 3, 1023: 2}}[name]
    began = time.process_time()
    out = packing.plan(demand, 2048)
    took = time.process_time() - began
    got = collections.Counter()
    for pattern, times in out:
        assert times > 0 and sum(s * c for s, c in pattern.items()) <= 2048
        for s, c in pattern.items():
            got[s] += c * times
    assert got == demand
    sizes = np.array(sorted(demand))
    need = np.array([float(demand[s]) for s in sizes])
    told = {}
    packing.solve(sizes, need, 2048, told=told)
    assert told["bound"] - 1e-6 <= sum(n for _, n in out) <= 1.04 * told["bound"] + 2
    assert took < 120  # of all threads; by itself 3 to 15 s


def test_cheaper_pivots_keep_the_inverse():
    rng = np.random.default_rng(4)
    basis = np.diag(rng.integers(1, 5, 120).astype(float))
    inverse = packing._Inverse(np.linalg.inv(basis))
    for _ in range(130):
        has = rng.choice(120, 4, replace=False)
        counts = rng.integers(1, 4, 4).astype(float)
        d = inverse.times(has, counts)
        r = int(np.abs(d).argmax())
        basis[:, r] = 0
        basis[has, r] = counts
        row = inverse.pivot(r, d)
        want = np.linalg.inv(basis)
        assert np.allclose(row, want[r], atol=1e-6) and np.allclose(inverse.sums(), want.sum(0), atol=1e-6)
    assert np.allclose(inverse.whole(), np.linalg.inv(basis), atol=1e-6)
