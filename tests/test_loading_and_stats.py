"""Load-time types, p-values as expressions, and distances over any number of columns."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tableprep.functions import beta
from tableprep.operators import outliers, stats
from tableprep.sources import types


def test_types_are_the_narrowest_that_hold_all(spark):
    rows = [("1", "1", "true", "2024-01-31", "2024-01-31", "NaN", "1e3", "NA", "x", " 7 ", "99999999999999999999"),
            ("-2", "2.5", "FALSE", "NULL", "2024-01-31 10:11:12", "nan", "nan", "5", "1", "+8", "1"),
            (None, "#N/A", "<NA>", "2020-02-29", "", "", "-.5", "0", "n/a", "null", "2")]
    df = spark.createDataFrame(rows, "i string, d string, b string, day string, ts string, none string, e string, z string, s string, sp string, big string")
    got = types.load(df)
    assert dict(got.dtypes) == {"i": "bigint", "d": "double", "b": "boolean", "day": "date", "ts": "timestamp_ntz", "none": "string",
                                "e": "double", "z": "bigint", "s": "string", "sp": "bigint", "big": "double"}
    out = got.collect()
    assert [r["i"] for r in out] == [1, -2, None] and [r["sp"] for r in out] == [7, 8, None] and [r["none"] for r in out] == [None] * 3
    assert [r["b"] for r in out] == [True, False, None] and [r["e"] for r in out] == [1000.0, None, -0.5] and out[2]["s"] is None


def test_types_refuse_what_only_looks_right(spark):
    df = spark.createDataFrame([("1d", "2023-02-30", "inf", "0x1"), ("1", "2023-02-28", "1", "1")], "a string, b string, c string, d string")
    assert set(types.infer(df).values()) == {"string"}
    assert types.infer(df.limit(0)) == dict.fromkeys("abcd", "string")
    assert types.load(df.select(F.lit(1).alias("n"))).dtypes == [("n", "int")]


def p_of(spark, rows, fn):
    cols = [F.col(f"c{i}") for i in range(len(rows[0]))]
    df = spark.createDataFrame([(k, *map(float, r)) for k, r in enumerate(rows)], "k int, " + ", ".join(f"c{i} double" for i in range(len(rows[0]))))
    return [r[1] for r in df.select("k", fn(*cols).alias("p")).orderBy("k").collect()]


def test_t_pvalues_against_closed_forms(spark):
    ts = [0.0, 1e-6, 0.3, -1.0, 2.5, 7.0, 30.0]
    close = lambda t: {1: 1 - 2 / math.pi * math.atan(abs(t)), 2: 1 - abs(t) / math.sqrt(2 + t * t),
                       4: 1 - abs(t) * (6 + t * t) / (4 + t * t) ** 1.5}
    rows = [(t, d) for t in ts for d in (1, 2, 4)]
    for (t, d), p in zip(rows, p_of(spark, rows, beta.t_pvalue)):
        assert p == pytest.approx(close(t)[d], abs=1e-12)
    # with ever more degrees of freedom t becomes normal
    for t, p in zip(ts, p_of(spark, [(t, 1e9) for t in ts], beta.t_pvalue)):
        assert p == pytest.approx(math.erfc(abs(t) / math.sqrt(2)), rel=1e-6, abs=1e-9)


def test_f_pvalues_against_closed_forms(spark):
    rows = [(f, 2, d) for f in (0.0, 0.01, 0.8, 3.0, 11.0) for d in (1, 3, 40, 1e4, 1e6)]
    for (f, _, d), p in zip(rows, p_of(spark, rows, beta.f_pvalue)):
        assert p == pytest.approx(math.exp(-d / 2 * math.log1p(2 * f / d)), rel=1e-9, abs=1e-13)
    # one F is the other side of its reciprocal
    rows = [(f, a, b) for f in (0.2, 0.9, 1.1, 3.0) for a, b in ((3, 8), (40, 1000), (2500, 90_000), (1, 1))]
    over = p_of(spark, rows, beta.f_pvalue)
    under = p_of(spark, [(1 / f, b, a) for f, a, b in rows], beta.f_pvalue)
    assert all(x + y == pytest.approx(1, abs=1e-9) for x, y in zip(over, under))


def test_pvalues_without_an_answer(spark):
    df = spark.createDataFrame([(None, 5.0), (float("nan"), 5.0), (1.0, 0.0), (1.0, None), (float("inf"), 5.0)], "t double, d double")
    got = [r[0] for r in df.select(beta.t_pvalue(F.col("t"), F.col("d"))).collect()]
    assert got[:4] == [None] * 4 and (got[4] is None or got[4] == 0.0 or math.isnan(got[4]))
    assert stats.pearson(spark.createDataFrame([(1.0, 1.0)], "x double, y double"), ["x"], "y").first()["p_value"] is None


@pytest.mark.parametrize("dof, want", [(1, 5.023886187314888), (2, 7.377758908227871), (3, 9.348403604496148), (10, 20.483177350807388), (100, 129.56119718583659)])
def test_chi2_cutoffs(dof, want):
    assert outliers.chi2_cutoff(0.975, dof) == pytest.approx(want, rel=1e-10)


def test_distances_of_five_columns(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 5)) @ rng.normal(size=(5, 5)) * [1, 10, 1e4, 1e-3, 5] + 7
    df = spark.createDataFrame([tuple(map(float, r)) for r in x] + [(None, 1.0, 1.0, 1.0, 1.0)], "a double, b double, c double, d double, e double")
    p = outliers.fit_distance(df, "abcde")
    got = np.array([r[0] for r in df.filter("a IS NOT NULL").select(outliers.distance_sq(p)).collect()])
    diff = x - x.mean(0)
    want = np.einsum("ij,jk,ik->i", diff, np.linalg.inv(np.cov(x, rowvar=False)), diff)
    assert np.allclose(np.sort(got), np.sort(want), rtol=1e-6) and p.n == 400
    assert outliers.distance_table(df, "abcde").first()["outliers"] == (want > p.cutoff).sum()


def test_distances_without_an_inverse(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, 3.0) for i in range(9)], "a double, b double, c double")
    for cols in (["a", "b"], ["a", "c"], ["c"]):
        assert outliers.fit_distance(df, cols).factor is None
        assert outliers.distance_table(df, cols).first()["outliers"] == 0
    assert outliers.distance_table(df.limit(0), ["a", "b"]).first()["rows"] == 0
    assert outliers.distance_table(df.limit(1), ["a", "b"]).first()["outliers"] == 0


def test_density_without_copies_of_values(spark):
    rng = np.random.default_rng(9)
    x = np.concatenate([rng.normal(size=3000), rng.normal(6, 0.3, size=500)]).round(3)
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "v double")
    exact = {r["point"]: r for r in stats.kde(df, "v").collect()}
    h = x.std(ddof=1) * len(x) ** -0.2
    at = np.linspace(x.min(), x.max(), 200)
    want = np.exp(-((at[:, None] - x) ** 2) / (2 * h * h)).sum(1) / (len(x) * h * math.sqrt(2 * math.pi))
    got = np.array([exact[i]["density"] for i in range(200)])
    assert np.allclose(got, want, rtol=1e-9) and np.allclose([exact[i]["x"] for i in range(200)], at)
    binned = np.array([r["density"] for r in stats.kde(df, "v", mode="binned").orderBy("point").collect()])
    assert abs(binned - want).max() < 1e-5 * want.max()
    coarse = np.array([r["density"] for r in stats.kde(df, "v", mode="binned", bins=64).orderBy("point").collect()])
    assert 1e-5 * want.max() < abs(coarse - want).max() < 0.05 * want.max()
    plan = stats.kde(df, "v")._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence" not in plan and stats.kde(df.limit(0), "v").count() == 0
