"""Exact top-k by inner product with Fagin's threshold algorithm (operator 2).

Candidates are dealt into blocks. A block keeps, for each dimension, its vectors
sorted by that component. For a query the lists are read side by side (from the top
where the query's component is positive, from the bottom where it is negative);
vectors met for the first time are scored whole, and reading stops when the sum of
the products at the lists' current depth, which no unseen vector can exceed, is
below the k-th best score. Blocks' best are merged by a window over k rows a block.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tableprep.llm.common import stage


def integer_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """(vec_id, v): v = floor(scale * component), component as double. Rows whose
    vector is null or holds a null or non-finite component are left out, and so are
    rows with a null id."""
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (df.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & fine)
            .select(F.col(id_col).cast("long").alias("vec_id"), F.transform(v, lambda x: F.floor(x * scale).cast("long")).alias("v")))


class SortedLists:
    """A block of vectors with its per-dimension sorted lists."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.v = ids[order], vectors[order]
        self.lists = np.ascontiguousarray(np.argsort(self.v, axis=0, kind="stable")[::-1].T)
        self.sorted = np.take_along_axis(self.v.T, self.lists, axis=1)
        #: per dimension the largest size of a component, as a Python number
        self.most = [max(abs(int(c[0])), abs(int(c[-1]))) for c in self.sorted]

    def search(self, query: np.ndarray, k: int, own: int | None, first_depth: int = 32) -> tuple[np.ndarray, np.ndarray, int]:
        """The k best (scores, ids), ties to the smaller id, without ``own``; and how
        many vectors were scored. Where a sum of products may pass 64 bits, scores and
        bounds are Python integers; a score among the best that is no long raises."""
        n, dims = self.v.shape
        used = np.flatnonzero(query)
        wide = sum(abs(int(query[d])) * self.most[d] for d in used) >= 2**63
        if wide:
            query = query.astype(object)
        kind = object if wide else np.int64
        best_of = lambda s, i: sorted(range(len(s)), key=lambda j: (-s[j], i[j])) if wide else np.lexsort((i, -s))
        seen = np.zeros(n, bool)
        if own is not None:
            seen[np.searchsorted(self.ids, own, "left"):np.searchsorted(self.ids, own, "right")] = True
        scores, found, scored = np.empty(0, kind), np.empty(0, np.int64), 0
        up = query[used] > 0
        at, depth = 0, min(first_depth, n)
        while True:
            if len(used) == 0:
                met = np.flatnonzero(~seen)
            else:
                fresh = np.zeros(n, bool)
                fresh[self.lists[used[up], at:depth].ravel()] = True
                fresh[self.lists[used[~up], n - depth:n - at].ravel()] = True
                met = np.flatnonzero(fresh & ~seen)
            seen[met] = True
            scored += len(met)
            scores, found = np.concatenate([scores, self.v[met].astype(kind, copy=False) @ query]), np.concatenate([found, self.ids[met]])
            if len(scores) > k:
                best = best_of(scores, found)[:k]
                scores, found = scores[best], found[best]
            if depth == n or len(used) == 0 or seen.all():
                break
            bound = int((query[used] * np.where(up, self.sorted[used, depth - 1], self.sorted[used, n - depth]).astype(kind, copy=False)).sum())
            if len(scores) == k and scores.min() > bound:
                break
            at, depth = depth, min(2 * depth, n)
        best = best_of(scores, found)
        return scores[best], found[best], scored


def longs(scores: np.ndarray) -> pd.Series:
    """Scores as longs. One above the largest long is in the result whatever the other
    blocks hold, and raises; one below the smallest is null and comes last."""
    if scores.dtype != object:
        return pd.Series(scores)
    if any(s >= 2**63 for s in scores):
        raise OverflowError("a score is above the largest long")
    return pd.Series([s if s >= -(2**63) else None for s in scores], dtype="Int64")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, block_rows: int = 8192, query_rows: int = 2048) -> DataFrame:
    """(query_id, rank, vec_id, score) for each row of ``queries`` against every row of
    ``vectors`` but those with the query's own id; both as integer_vectors(). Vectors
    whose length differs from the query's are no candidates. Repeated ids count as
    candidates of their own; rows of ``queries`` that are equal ask once, and queries
    that share an id but not the vector are ranked apart. Blocks of queries meet blocks
    of vectors, so a task holds one block of each whatever the tables' sizes; an empty
    side gives no rows."""
    vectors = stage(vectors, "topk-vectors")
    queries = stage(queries.dropDuplicates(["vec_id", "v"]).withColumn("ask", F.monotonically_increasing_id()), "topk-queries")
    many, asked = vectors.count(), queries.count()
    nb, nq = max(1, -(-many // block_rows)), max(1, -(-asked // query_rows))
    deal = lambda df, n: F.pmod(F.xxhash64("vec_id", "v"), F.lit(n))
    right = vectors.withColumn("b", deal(vectors, nb)).withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(nq - 1))))
    left = queries.withColumn("q", deal(queries, nq)).withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(nb - 1))))

    def search(asking: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        out = []
        lengths = block["v"].map(len)
        for size, part in block.groupby(lengths):
            here = SortedLists(part["vec_id"].to_numpy(np.int64), np.stack(part["v"].to_list()).astype(np.int64) if size else np.zeros((len(part), 0), np.int64))
            for ask, own, q in zip(asking["ask"], asking["vec_id"], asking["v"], strict=True):
                if len(q) == size:
                    s, ids, _ = here.search(np.asarray(q, np.int64), k, own)
                    out.append(pd.DataFrame({"ask": ask, "query_id": own, "vec_id": ids, "score": longs(s)}))
        return pd.concat(out) if out else pd.DataFrame({"ask": [], "query_id": [], "vec_id": [], "score": []}, dtype="int64")

    best = (left.groupBy("q", "b").cogroup(right.groupBy("q", "b"))
            .applyInPandas(search, "ask long, query_id long, vec_id long, score long"))
    w = Window.partitionBy("ask").orderBy(F.desc_nulls_last("score"), "vec_id")
    score = F.coalesce("score", F.raise_error(F.lit("a score is below the smallest long")).cast("long"))
    return best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", score.alias("score"))
