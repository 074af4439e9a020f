import numpy as np
import pytest

from tableprep.llm import topk


def brute_top(rows, ask, k):
    out = set()
    for q, v in ask:
        best = sorted((-sum(a * b for a, b in zip(v, u, strict=True)), i) for i, u in rows if i != q)[:k]
        out |= {(q, n, i, -s) for n, (s, i) in enumerate(best, 1)}
    return out


def test_top_k_scores_wider_than_longs_on_the_way(spark):
    """Bounds and sums that pass 64 bits on the way don't change the answer."""
    rng = np.random.default_rng(5)
    for _ in range(40):
        v = np.floor(rng.normal(size=(120, 6)) * 2.0**31).astype(np.int64)
        v[:, 3:] = rng.integers(-3, 4, (120, 3))
        v[0, 0], v[0, 1], v[0, 2] = 2**31, 2**31, 2**31 + 7
        exact = [sum(int(a) * int(b) for a, b in zip(v[0], u, strict=True)) for u in v]
        s, ids, _ = topk.SortedLists(np.arange(120), v).search(v[0], 5, 0, first_depth=4)
        assert list(zip((-int(x) for x in s), ids.tolist(), strict=True)) == sorted((-x, i) for i, x in enumerate(exact) if i)[:5]
    big = [(0, [2.0**23, 2.0**23, 2.0**23]), (1, [2.0**23, 2.0**23, -(2.0**23)]), (2, [1.0, 0.0, 0.0]), (3, [-(2.0**23)] * 3)]
    df = topk.integer_vectors(spark.createDataFrame(big, "vec_id long, embedding array<float>"))
    rows = [(r["vec_id"], r["v"]) for r in df.collect()]
    got = {tuple(r) for r in topk.top_k(df, df.where("vec_id % 50 = 0"), 2).collect()}
    assert got == brute_top(rows, [rows[0]], 2)
    with pytest.raises(Exception, match="below the smallest long"):
        topk.top_k(df, df.where("vec_id % 50 = 0"), 3).collect()


def test_top_k_repeated_query_asks_once(spark):
    rows = [(50, [1.0, 0.0]), (50, [1.0, 0.0]), *[(i, [i / 64.0, 1.0]) for i in range(1, 9)], (100, [0.0, 1.0]), (100, [0.0, -1.0])]
    df = topk.integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    fine = [(r["vec_id"], r["v"]) for r in df.collect()]
    out = [tuple(r) for r in topk.top_k(df, df.where("vec_id % 50 = 0"), 5).collect()]
    want = [r for q in {(i, tuple(v)) for i, v in fine if i % 50 == 0} for r in brute_top(fine, [q], 5)]
    assert sorted(out) == sorted(want) and len([r for r in out if r[0] == 50]) == 5 and len([r for r in out if r[0] == 100]) == 10
