
import math

import pytest
from pyspark.sql import functions as F

from tableprep import config as C
from tableprep.functions import text as X
from tableprep.operators import clean, dedup, encode, extract, features, impute, outliers, profile, split, stats
from tableprep.operators.quantile import exact_quantiles, quantile_table


def test_merge_by_key_golden(spark):
    df = spark.createDataFrame([(1, None, "y"), (1, "x", "w"), (2, None, "z"), (None, "q", "q")],
                               "k long, a string, b string")
    out = sorted(tuple(r) for r in dedup.merge_by_key(df, "k").collect())
    assert out == [(1, "x", "w"), (2, None, "z")]


def test_merge_is_columnwise_and_prefers_complete_rows(spark):
    df = spark.createDataFrame([(7, "a", None, None), (7, None, "b", "c"), (7, "z", None, "d")],
                               "k long, x string, y string, w string")
    r = dedup.merge_by_key(df, "k").first()
    # rows 2 and 3 are the most complete: x comes from row 3, y from row 2,
    # and their tie on w is settled by the row fingerprint
    assert r["y"] == "b" and r["w"] in ("c", "d") and r["x"] == "z"


def test_merge_properties(spark):
    rows = [(i % 50, f"v{i % 7}" if i % 3 else None, str(i)) for i in range(500)]
    df = spark.createDataFrame(rows, "k long, a string, b string")
    merged = dedup.merge_by_key(df, "k")
    assert merged.count() == merged.select("k").distinct().count() == 50
    one_part = sorted(map(tuple, dedup.merge_by_key(df.repartition(1), "k").collect()))
    many = sorted(map(tuple, dedup.merge_by_key(df.repartition(17), "k").collect()))
    assert one_part == many


def test_duplicate_counts(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (2, None), (3, "c")], "k long, v string")
    r = profile.duplicate_rows(df).first()
    assert (r["duplicate_rows"], r["groups"], r["rows_in_groups"]) == (2, 2, 4)
    assert dedup.drop_exact(df).count() == 3


def test_near_duplicate_groups(spark):
    df = spark.createDataFrame([(1, "t", "x"), (2, "t", "x"), (3, "u", "x"), (4, None, "y")],
                               "k long, d string, v string")
    g = dedup.near_duplicate_groups(df, ["k", "d"], "d", "k")
    rows = sorted((r["k"], r["group_id"], r["description_identical"]) for r in g.collect())
    assert rows == [(1, 1, False), (2, 1, False), (3, 1, False)]


def test_key_conflicts_long_form(spark):
    df = spark.createDataFrame([(1, "a", "s"), (1, "b", "s"), (2, "c", "t")], "k long, x string, y string")
    out = sorted((r["k"], r["column"], r["value"]) for r in dedup.key_conflicts(df, "k").collect())
    assert out == [(1, "x", "a"), (1, "x", "b")]


def test_sentinels_and_null_safe_filter(spark):
    df = spark.createDataFrame([(1, " - ", "Others"), (2, "ok", None), (3, "N/A", "Flat")],
                               "k long, a string, t string")
    cleaned = clean.clean_missing(df, C.CANDIDATE_SENTINELS)
    assert [r["a"] for r in cleaned.orderBy("k").collect()] == [None, "ok", None]
    kept = clean.remove_category(cleaned, "t", "Others")
    assert sorted(r["k"] for r in kept.collect()) == [2, 3]
    found = {r["sentinel"] for r in clean.find_sentinels(clean.trim_strings(df), C.CANDIDATE_SENTINELS).collect()}
    assert found == {"-", "N/A"}


def test_rounding_half_even(spark):
    df = spark.createDataFrame([(2.5,), (3.5,)], "v double")
    assert [r[0] for r in df.select(F.bround("v", 0)).collect()] == [2.0, 4.0]


def test_size_correction_golden(spark):
    df = spark.createDataFrame([(1, 9.0, "unit of 991 sqft"), (2, 1.0, "850 sq ft"), (3, 1200.0, "x")],
                               "k long, s double, d string")
    out, log = extract.correct_from_text(df, "s", X.extract_size(F.col("d")), F.col("s") < 100, "k")
    assert [r["s"] for r in out.orderBy("k").collect()] == [991.0, 850.0, 1200.0]
    assert log.count() == 2


def test_size_outlier_rule_golden(spark):
    rows = [(i, 1000.0, "1000 sqft", "train") for i in range(60)]
    rows += [(100, 122774.0, "1227.74 sqft", "train"), (101, 980000.0, "Built Up: 9800 sq.ft, Land Area: 6800 sq.ft",
                                                        "train"),
             (102, 500000.0, "For sale", "train"), (103, 937600.0, "937600 sqft", "train")]
    df = spark.createDataFrame(rows, "k long, s double, d string, split string")
    # frozen training parameters: every row far from 1000 is flagged
    zp = outliers.ZParams({"s": 1000.0}, {"s": 1.0})
    out, log = outliers.resolve_size_outliers(df, "s", "d", "k", "split", 3, zp)
    got = {r["k"]: r["s"] for r in out.filter("k >= 100").collect()}
    assert got[100] == 1228.0          # digit shift, half-even rounding
    assert got[101] == 6800.0          # Land Area preferred
    assert got[102] is None            # no evidence → missing
    assert got[103] == 937600.0        # confirmed
    reasons = {r["key"]: r["reason"] for r in log.collect()}
    assert reasons[100] == "digit_shift" and reasons[101] == "land_area"


def test_bedroom_rule(spark):
    df = spark.createDataFrame([(1, 9.0, "SQFT : 3000\nBEDROOMS : 6"), (2, 9.0, "3 Bed-rooms"), (3, 2.0, "5 bedrooms")],
                               "k long, b double, d string")
    out, log = outliers.resolve_room_outliers(df, "b", "d", "k")
    assert [r["b"] for r in out.orderBy("k").collect()] == [9.0, 3.0, 2.0]
    assert log.count() == 2


def test_age_and_floors(spark):
    df = spark.createDataFrame([(2010.0, 135.0), (2025.0, 63.0), (None, None)], "y double, f double")
    ages = [r[0] for r in df.select(features.age("y")).collect()]
    assert ages == [13.0, None, None]
    fixed, log = clean.invalidate_above(df.withColumn("k", F.lit(1)), "f", C.FLOOR_MAX, "k")
    assert [r["f"] for r in fixed.collect()] == [None, 63.0, None]
    assert log.count() == 1


def test_mode_tie_takes_smallest(spark):
    df = spark.createDataFrame([(3.0,), (1.0,), (3.0,), (1.0,)], "v double")
    r = stats.central(df, "v").first()
    assert (r["mode"], r["mode_rows"]) == (1.0, 2)


def test_one_hot_drop_first_and_unseen(spark):
    train = spark.createDataFrame([("a",), ("b",), ("c",)], "t string")
    p = encode.fit_one_hot(train, "t", "T")
    assert p.columns() == ["T_b", "T_c"]
    test = spark.createDataFrame([("d",), ("b",)], "t string")
    out = [tuple(r) for r in encode.apply_one_hot(test, p).select("T_b", "T_c").collect()]
    assert out == [(0, 0), (1, 0)]


def test_binary_map_keeps_missing(spark):
    df = spark.createDataFrame([("Freehold",), ("Leasehold",), (None,), ("odd",)], "t string")
    assert [r[0] for r in df.select(encode.binary_map("t", C.TENURE_MAP)).collect()] == [1, 0, None, None]


def test_rare_merge_fit_on_train_only(spark):
    train = spark.createDataFrame([("x",)] * 5 + [("y",)], "s string")
    p = encode.fit_rare(train, "s", 3)
    assert p.rare == ("y",)
    test = spark.createDataFrame([("y",), ("z",)], "s string")
    assert [r[0] for r in encode.apply_rare(test, p).collect()] == ["Other", "z"]


def test_median_fit_ignores_test_rows(spark):
    df = spark.createDataFrame([(1.0, "train"), (3.0, "train"), (None, "train"), (100.0, "test"), (None, "test")],
                               "v double, split string")
    p = impute.fit_median(df.filter("split = 'train'"), {"v": "v_missing"})
    assert p.medians["v"] == 2.0
    changed = df.withColumn("v", F.when(F.col("split") == "test", F.lit(-5.0)).otherwise(F.col("v")))
    assert impute.fit_median(changed.filter("split = 'train'"), {"v": None}).medians["v"] == 2.0
    out = impute.apply_median(df, p).orderBy("split", "v").collect()
    assert all(r["v"] is not None for r in out)
    assert sum(r["v_missing"] for r in out) == 2


def test_chi2_cutoff():
    assert outliers.chi2_cutoff_df2(0.975) == pytest.approx(7.3778, abs=1e-4)


def test_mahalanobis_against_numpy(spark):
    import numpy as np
    rng = np.random.default_rng(1)
    xy = rng.multivariate_normal([0, 0], [[2, 0.8], [0.8, 1]], 400)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in xy], "x double, y double")
    p = outliers.fit_mahalanobis(df, "x", "y")
    d2 = [r[0] for r in df.select(outliers.mahalanobis_sq(p)).collect()]
    cov = np.cov(xy, rowvar=False)
    diff = xy - xy.mean(axis=0)
    ref = np.einsum("ij,jk,ik->i", diff, np.linalg.inv(cov), diff)
    assert np.allclose(d2, ref)


def test_split_is_partition_independent_and_grouped_never_tears(spark):
    df = spark.range(0, 2000).withColumn("g", F.col("id") % 37)
    a = {r["id"]: r["split"] for r in split.split_random(df.repartition(1), "id").collect()}
    b = {r["id"]: r["split"] for r in split.split_random(df.repartition(13), "id").collect()}
    assert a == b
    share = sum(v == "test" for v in a.values()) / len(a)
    assert 0.15 < share < 0.25
    g = split.split_grouped(df, ["g"])
    assert g.groupBy("g").agg(F.count_distinct("split").alias("n")).filter("n > 1").count() == 0


@pytest.mark.parametrize("accuracy", [100_000, 50])
@pytest.mark.parametrize("shape", ["distinct", "heavy", "two", "one", "few", "wide"])
def test_quantiles_equal_sparks_percentile(spark, shape, accuracy):
    """The fit keeps no map of values, even where all 60,000 are distinct and the sketch is coarse."""
    x = {"distinct": F.expr("id * 7919 % 60013 / 3.0"), "heavy": F.expr("if(id % 3 = 0, 5.0, id * 31 % 1009)"),
         "two": F.expr("if(id % 2 = 0, 1.0, 2.0)"), "one": F.lit(4.0), "few": F.expr("if(id < 3, id * id * 1.0, null)"),
         "wide": F.expr("if(id % 5000 = 0, -1e300, id * id * 1.0)")}[shape]
    df = spark.range(60_000, numPartitions=5).select(x.cast("double").alias("v"), F.expr("if(id % 3 = 0, null, id % 2)").alias("g"), F.lit(None).cast("double").alias("none"))
    probs = [0.0, 0.01, 0.25, 1 / 3, 0.5, 0.9, 1.0]
    got = exact_quantiles(df, ["v", "none"], probs, accuracy)
    assert got["none"] == [None] * len(probs)
    assert got["v"] == list(df.agg(F.percentile("v", probs)).first()[0])
    table = quantile_table(df, ["g"], ["v"], probs, accuracy)
    assert "percentile(" not in table._jdf.queryExecution().optimizedPlan().toString()
    want = {r["g"]: list(r["q"]) for r in df.groupBy("g").agg(F.percentile("v", probs).alias("q")).collect() if r["q"]}
    assert {r["g"]: list(r["q"]) for r in table.collect()} == want


def test_quantiles_of_more_groups_than_are_broadcast(spark):
    df = spark.range(6_000).select((F.col("id") % 1500).alias("g"), F.col("id").cast("double").alias("v"))
    got = {r["g"]: list(r["q"]) for r in quantile_table(df, ["g"], ["v"], [0.25, 0.5]).collect()}
    assert got == {g: [g + 1125.0, g + 2250.0] for g in range(1500)}


def test_histogram_and_kde(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)], "v double")
    h = stats.histogram(df, "v", 10).orderBy("bin").collect()
    assert len(h) == 10 and sum(r["count"] for r in h) == 101 and h[-1]["count"] == 11
    k = stats.kde(df, "v", 50).collect()
    xs = sorted((r["x"], r["density"]) for r in k)
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(xs, xs[1:]))
    assert 0.8 < area < 1.01


def test_anova_and_pvalues(spark):
    rows = [("a", 1.0), ("a", 2.0), ("a", 3.0), ("b", 4.0), ("b", 5.0), ("b", 6.0)]
    r = stats.anova(spark.createDataFrame(rows, "g string, y double"), "g", "y").first()
    assert r["f"] == pytest.approx(13.5)
    assert r["p_value"] == pytest.approx(0.02131, abs=1e-4)


def test_skewness_is_population_g1(spark):
    vals = [1.0, 2.0, 2.0, 3.0, 10.0]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    m = sum(vals) / len(vals)
    m2 = sum((v - m) ** 2 for v in vals) / len(vals)
    m3 = sum((v - m) ** 3 for v in vals) / len(vals)
    assert stats.skew(df, "v").first()["skewness"] == pytest.approx(m3 / m2 ** 1.5)


def test_describe_table_shape(spark):
    df = spark.createDataFrame([("RM 1 000", "2"), ("RM 3 000", "x4.5")], "p string, b string")
    out = profile.describe_table(df, {"Price": ("p", "digits"), "Bed": ("b", "first_decimal")})
    rows = {r["statistic"]: (r["Price"], r["Bed"]) for r in out.collect()}
    assert rows["Count"] == (2.0, 2.0)
    assert rows["Median"] == (2000.0, 3.25)
    assert not math.isnan(rows["Standard deviation"][0])


def test_hot_key_merge_is_partially_aggregated(spark):
    """A third of all rows under one key: the merge must combine them map-side
    (partial aggregation before the shuffle) and still give the exact result."""
    n = 3000
    rows = [(0 if i % 3 == 0 else i, f"a{i % 11}" if i % 5 else None, f"b{i}") for i in range(n)]
    df = spark.createDataFrame(rows, "k long, a string, b string").repartition(12)
    merged = dedup.merge_by_key(df, "k")
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan
    assert merged.count() == len({r[0] for r in rows})
    hot = merged.filter("k = 0").first()
    ref = dedup.merge_by_key(df.filter("k = 0").coalesce(1), "k").first()
    assert tuple(hot) == tuple(ref)


def test_key_conflicts_never_collects_a_group(spark):
    df = spark.createDataFrame([(0, f"v{i}") for i in range(200)], "k long, x string")
    plan = dedup.key_conflicts(df, "k")._jdf.queryExecution().executedPlan().toString()
    assert "collect_set" not in plan and "collect_list" not in plan
    assert dedup.key_conflicts(df, "k").count() == 200


def test_categories_with_one_safe_name_keep_a_column_each(spark):
    df = spark.createDataFrame([(["A B", "A_B"],), (["A_B"],), (["a b", "Gym"],)], "items array<string>")
    p = encode.MultiHotParams(encode.fit_multi_hot(df, F.col("items")).vocabulary, taken=("has_gym",))
    assert dict(zip(p.vocabulary, p.columns())) == {"A B": "Has_A_B", "A_B": "Has_A_B_2", "Gym": "Has_Gym_2", "a b": "Has_a_b_3"}
    out = encode.apply_multi_hot(df, F.col("items"), p).agg(*[F.sum(c).alias(c) for c in p.columns()]).first()
    assert out.asDict() == {"Has_A_B": 1, "Has_A_B_2": 2, "Has_Gym_2": 1, "Has_a_b_3": 1}
    one = encode.fit_one_hot(spark.createDataFrame([("0",), ("x y",), ("x_y",)], "v string"), "v", "V")
    assert one.columns() == ["V_x_y", "V_x_y_2"]


def test_rare_merge_has_no_cap_on_categories(spark):
    df = spark.range(5000).selectExpr("if(id < 2000, 'big', cast(id as string)) AS s").unionByName(
        spark.createDataFrame([(None,)], "s string"))
    out = encode.merge_rare(df, encode.rare_table(df, "s", 3), "s").groupBy("s").count().collect()
    assert {r["s"]: r["count"] for r in out} == {"big": 2000, "Other": 3000, None: 1}
