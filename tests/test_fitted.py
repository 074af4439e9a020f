"""Vocabularies of any length, exact splits, stored parameters, reports of the job's own
pass and the check for missing cells."""

import math
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tableprep import config as C
from tableprep.operators import encode, observed, profile, split, vocabulary
from tableprep.plans import apply as AP
from tableprep.plans import prepare as PP
from tableprep.plans import store
from tableprep.session import scratch_dir
from tableprep.sources import fixtures


# --- vocabularies ---------------------------------------------------------------------

def test_ordered_index_is_gapless_in_order(spark):
    names = [f"n{(i * 7919) % 5003}" for i in range(5003)] + ["", "é", "Z z"]
    df = spark.createDataFrame([(n,) for n in names], "v string").repartition(13)
    got = sorted((r["index"], r["v"]) for r in vocabulary.ordered_index(df, "v").collect())
    assert [i for i, _ in got] == list(range(len(names)))
    assert [v for _, v in got] == sorted(names, key=lambda s: s.encode())
    assert vocabulary.ordered_index(df.limit(0), "v").count() == 0


def test_five_thousand_categories(spark):
    rows = [(i, f"c{i % 5000:04d}", [f"c{i % 5000:04d}", f"c{(i * 3) % 5000:04d}", f"c{i % 5000:04d}"]) for i in range(6000)] + [(6000, None, None), (6001, "new", ["new"])]
    df = spark.createDataFrame(rows, "k long, c string, items array<string>")
    train = df.filter("k < 6000")
    p = encode.fit_items(train, F.col("items"))
    assert isinstance(p, vocabulary.SparseParams) and p.size == 5000
    out = {r["k"]: r["Has_sparse"] for r in encode.apply_items(df, "k", F.col("items"), p).collect()}
    assert len(out) == 6002 and out[6000] == [] and out[6001] == []
    assert all(out[k] == sorted({k % 5000, (k * 3) % 5000}) for k in range(6000))
    assert [r["item"] for r in encode.unseen_items(df, F.col("items"), p).collect()] == ["new"]
    # one-hot: 1,000 categories occur twice, the others are rare; both lists are long
    merged, one = encode.fit_rare_one_hot(train, {"c": (2, "C")}, max_categories=500)["c"]
    assert merged.table is not None and merged.table.count() == 4000
    assert isinstance(one, vocabulary.SparseParams) and one.size == 1001 and one.width == 1000
    got = {r["k"]: r["C_sparse"] for r in encode.apply_one_hot(encode.apply_rare(df, merged), one).collect()}
    cats = sorted([f"c{i:04d}" for i in range(1000)] + ["Other"])
    for k in (0, 1, 999, 1000, 4999, 5000, 6000, 6001):
        value = {6000: None, 6001: "new"}.get(k, f"c{k % 5000:04d}")
        value = "Other" if value and value != "new" and int(value[1:]) >= 1000 else value
        want = cats.index(value) - 1 if value in cats else -1
        assert (got[k] or []) == ([want] if want >= 0 else [])
    # nearly all rare: the table stays narrow, whatever the raw vocabulary
    merged, one = encode.fit_rare_one_hot(train, {"c": (3, "C")})["c"]
    assert one.categories == ("Other",) and merged.table.count() == 5000


def test_sparse_and_wide_encoders_agree(spark):
    df = spark.createDataFrame([(1, ["b", "a"], "x"), (2, [], None), (3, ["c", "c"], "y"), (4, ["zz"], "zz"), (5, None, "w")], "k long, items array<string>, c string")
    train = df.filter("k < 4")
    wide, thin = encode.fit_items(train, F.col("items")), encode.fit_items(train, F.col("items"), max_categories=1)
    a = {r["k"]: [i for i, n in enumerate(wide.columns()) if r[n]] for r in encode.apply_items(df, "k", F.col("items"), wide).collect()}
    b = {r["k"]: r["Has_sparse"] for r in encode.apply_items(df, "k", F.col("items"), thin).collect()}
    assert a == b
    long = sorted((r["k"], r["column"]) for r in vocabulary.sparse_rows(df, "k", F.col("items"), thin).join(thin.names(), "index").collect())
    assert long == [(1, "Has_a"), (1, "Has_b"), (3, "Has_c")]


def test_prepare_with_a_sparse_encoder(spark):
    """A limit of one column: every encoder of the job is sparse, and new rows agree."""
    raw = fixtures.listings(spark, SF_SMALL)
    wide, thin = PP.prepare(raw), PP.prepare(raw, PP.PrepareConfig(max_columns=1))
    assert isinstance(thin.params["multi_hot"], vocabulary.SparseParams)
    a = {r["ad_id"]: r for r in wide.data.collect()}
    b = {r["ad_id"]: r for r in thin.data.collect()}
    names = wide.params["multi_hot"].columns()
    types = wide.params["one_hot_type"].columns()
    assert a.keys() == b.keys()
    for k in a:
        assert [i for i, n in enumerate(names) if a[k][n]] == b[k]["Has_sparse"]
        assert [i for i, n in enumerate(types) if a[k][n]] == (b[k]["PropertyType_sparse"] or [])
    same = ["final_features", "state_one_hot_columns", "property_type_one_hot_columns", "engineered_features", "torn_groups"]
    counts = [{r["item"]: r["result"] for r in p.reports["summary"].collect()} for p in (wide, thin)]
    assert [counts[0][x] for x in same] == [counts[1][x] for x in same]


# --- split ----------------------------------------------------------------------------

@pytest.mark.parametrize("n, frac", [(0, 0.2), (1, 0.2), (7, 0.5), (9001, 0.2), (9001, 0.0), (9001, 1.0), (10, 0.3)])
def test_exact_split(spark, n, frac):
    df = spark.range(n).select(F.concat(F.lit("k"), "id").alias("k"))
    one = {r["k"]: r["split"] for r in split.split_exact(df, "k", frac, 7).collect()}
    two = {r["k"]: r["split"] for r in split.split_exact(df.repartition(11), "k", frac, 7).collect()}
    assert one == two and sum(v == "test" for v in one.values()) == math.ceil(round(frac * n, 9))


def test_exact_split_of_one_bucket_and_repeated_keys(spark):
    digests = spark.createDataFrame([(f"abc{i:029x}",) for i in range(50)] * 2, "h string")
    for k in (1, 2, 51, 100):
        assert split.kth_digest(digests, "h", k, ranked=3) == f"abc{(k - 1) // 2:029x}"
    df = spark.createDataFrame([("a",)] * 30 + [("b",)] * 70 + [(None,)] * 5, "k string")
    got = split.split_exact(df, "k", 0.5).groupBy("k").agg(F.count_distinct("split").alias("s")).collect()
    assert all(r["s"] == 1 for r in got)


def test_job_with_an_exact_split(spark):
    p = PP.prepare(fixtures.listings(spark, SF_SMALL), PP.PrepareConfig(exact_split=True))
    n = {r["item"]: r["result"] for r in p.reports["summary"].collect()}
    assert n["test_rows"] == math.ceil(0.2 * n["rows_entering_split"])


# --- store ----------------------------------------------------------------------------

def test_stored_parameters_come_back_bit_equal(spark):
    raw = fixtures.listings(spark, SF_SMALL)
    p = PP.prepare(raw)
    root = scratch_dir(spark, f"store-{uuid.uuid4().hex[:8]}")
    store.save(spark, p.params, root, 1)
    store.save(spark, {**p.params, "parking_price_threshold": 0.1 + 0.2}, root, 2)
    assert store.load(spark, root, 1) == p.params
    assert store.load(spark, root)["parking_price_threshold"] == 0.1 + 0.2
    with pytest.raises(Exception):
        store.save(spark, p.params, root, 2)
    with pytest.raises(ValueError):
        store.load(spark, root, 3)
    with pytest.raises(TypeError):
        store.save(spark, {"x": profile_like()}, root, 4)
    a, b = (sorted(map(repr, AP.transform(raw, q).collect())) for q in (p.params, store.load(spark, root, 1)))
    assert a == b


def profile_like():
    from dataclasses import dataclass

    @dataclass
    class Own:
        x: int = 1
    return Own()


def test_stored_tables_come_back(spark):
    raw = fixtures.listings(spark, SF_SMALL)
    p = PP.prepare(raw, PP.PrepareConfig(max_columns=1))
    root = scratch_dir(spark, f"store-{uuid.uuid4().hex[:8]}")
    store.save(spark, p.params, root, 1)
    a, b = (sorted(map(repr, AP.transform(raw, q).collect())) for q in (p.params, store.load(spark, root)))
    assert a == b


# --- reports --------------------------------------------------------------------------

def test_missing_per_row_equals_the_aggregate(spark):
    df = spark.createDataFrame([(1, None, "a"), (None, None, None), (2, "x", None), (3, "x", "y"), (None, "q", None)], "a int, b string, c string")
    found = df.agg(*observed.missing_exprs(df.columns)).first().asDict()
    want = profile.missing_per_row(df).first().asDict()
    got = observed.missing_per_row(found, df.columns)
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k]) for k in want)
    assert observed.missing_per_row(df.limit(0).agg(*observed.missing_exprs(df.columns)).first().asDict(), df.columns) == {"count": 0.0}


def test_rows_taken_twice_are_counted_again(spark):
    df = spark.createDataFrame([(1,), (None,)], "a int")
    watch = observed.Watch()
    twice = df.union(df)  # as if the tasks had run twice
    passed = watch.rows(twice, "x", *observed.missing_exprs(["a"]))
    passed.write.format("noop").mode("overwrite").save()
    o, _, exprs = watch.seen["x"]
    watch.seen["x"] = (o, df, exprs)
    assert watch.get("x")["rows"] == 4
    assert watch.get("x", 2)["rows"] == 2 and watch.get("x", 2)["missing__0"] == 1


def test_reports_take_no_pass_of_their_own(spark):
    raw = fixtures.listings(spark, SF_SMALL)
    p = PP.prepare(raw)
    assert "Scan" not in p.reports["pass"]._jdf.queryExecution().executedPlan().toString().replace("LocalTableScan", "").replace("Scan ExistingRDD", "")
    got = {(r["report"], r["item"], r["metric"]): r["value"] for r in p.reports["pass"].collect()}
    assert got["missing_per_row", "raw", "count"] == raw.count()
    assert got["split", "train", "rows"] + got["split", "test", "rows"] == got["scope", "property_type", "kept"]


# --- missing cells --------------------------------------------------------------------

def test_missing_cells_fail_the_job_that_writes(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    checked = profile.require_no_missing(df, ["k", "v"])
    with pytest.raises(Exception, match="missing cells remain in: v"):
        checked.select("k").collect()
    assert profile.require_no_missing(df, ["k"]).count() == 2
    assert profile.require_no_missing(df.filter("k = 1"), ["k", "v"]).collect() == [(1, "a")]
    assert profile.require_no_missing(df, []).count() == 2


def test_prepare_is_strict_by_default(spark):
    raw = fixtures.listings(spark, SF_SMALL)
    with pytest.raises(Exception, match="missing cells remain in"):
        PP.prepare(raw, PP.PrepareConfig(may_miss=())).data.write.format("noop").mode("overwrite").save()
    PP.prepare(raw, PP.PrepareConfig(may_miss=()), strict=False).data.write.format("noop").mode("overwrite").save()


def test_prepare_without_a_training_price(spark):
    raw = fixtures.listings(spark, SF_SMALL).withColumn("price", F.lit(None).cast("string"))
    p = PP.prepare(raw)
    assert p.params["parking_price_threshold"] is None and p.data.count() > 0
    assert C.PARKING_LIMIT > 0
