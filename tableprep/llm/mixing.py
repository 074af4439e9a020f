"""Mixing sources to target weights by entropy balancing (operator 1).

Each document's rate is the one nearest to 1 (in relative entropy) under which
every source gives its target of words: rate = min(cap, exp(lambda_source * size)).
Newton steps on the convex dual run as Spark aggregates over the table of distinct
(source, size); the parameters stay a table. Rates are rounded into copies along
each source's documents in order of size, so the words taken differ from the target
by about one document at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableprep.llm.common import fresh, stage, with_rank

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """totals: (source, source_size), one row per source. Sources by code point, null
    last, have ``weights`` in turn and share ``share`` of all sizes; none gets more
    than ``cap`` times its size, the excess goes to the others by weight. The level t
    with target = min(cap * size, weight * t) is found from running sums over the
    sources in order of cap * size / weight. Both windows are over the sources."""
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(weights))) + 1).cast("int"))
    t = totals.withColumn("weight", w).withColumn("most", F.col("source_size") * F.lit(float(cap)))
    up = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    t = (t.withColumn("below", F.coalesce(F.sum("most").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
         .withColumn("open", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
         .withColumn("level", (F.sum("source_size").over(every) * F.lit(float(share)) - F.col("below")) / F.col("open")))
    level = F.min(F.when(F.col("level") * F.col("weight") <= F.col("most"), F.struct(F.col("most") / F.col("weight"), "level"))).over(every)["level"]
    return t.withColumn("target", F.least(F.col("most"), F.coalesce(F.greatest(level, F.lit(0.0)) * F.col("weight"), F.col("most")))).select("source", "source_size", "target")


def balance(hist: DataFrame, goals: DataFrame, cap: float = 2.0, tolerance: float = 1e-9, steps: int = 60) -> DataFrame:
    """Solves for each source's lambda. hist: (source, size, n); goals: targets().
    Each step aggregates the gradient and the curvature of the dual by source and
    takes a Newton step, or halves the bracket where Newton would leave it. A source
    whose target is its whole capped size has lambda = +inf (every rate at the cap).
    Returns (source, source_size, target, unit, lam); unit scales sizes."""
    state = goals.select("source", "source_size", "target",
                     F.when(F.col("target") >= F.col("source_size") * cap, F.lit(float("inf"))).otherwise(F.lit(0.0)).alias("lam"),
                     F.lit(float("-inf")).alias("lo"), F.lit(float("inf")).alias("hi"))
    means = hist.groupBy("source").agg((F.sum(F.col("n") * F.col("size") * F.col("size")) / F.greatest(F.sum(F.col("n") * F.col("size")), F.lit(1))).alias("mean"))
    state = state.join(means, state["source"].eqNullSafe(means["source"]), "left").select(
        state["source"], "source_size", "target", F.greatest(F.coalesce("mean", F.lit(1.0)), F.lit(1.0)).alias("unit"), "lam", "lo", "hi")
    state = stage(state, "mix-state")
    for _ in range(steps):
        x = F.col("size") / F.col("unit")
        raw = F.exp(F.least(F.col("lam") * x, F.lit(700.0)))
        part = hist.join(state, hist["source"].eqNullSafe(state["source"])).where(F.col("lam") < float("inf"))
        exact = lambda c: F.sum(c.cast("decimal(38,6)")).cast("double")  # noqa: E731  in any order the same sum
        sums = part.groupBy(state["source"].alias("s")).agg(
            exact(F.col("n") * F.col("size") * F.least(raw, F.lit(cap))).alias("got"),
            exact(F.when(raw < cap, F.col("n") * F.col("size") * x * raw).otherwise(0.0)).alias("slope"))
        gap = F.col("got") - F.col("target")
        lo, hi = F.when(gap < 0, F.col("lam")).otherwise(F.col("lo")), F.when(gap > 0, F.col("lam")).otherwise(F.col("hi"))
        newton = F.col("lam") - F.when(F.col("slope") > 0, gap / F.col("slope"))
        inside = newton.isNotNull() & (newton > F.col("lo2")) & (newton < F.col("hi2"))
        beyond = F.when(F.col("lo2") == float("-inf"), F.least(F.col("hi2") * 2, F.col("hi2") - 1)).when(
            F.col("hi2") == float("inf"), F.greatest(F.col("lo2") * 2, F.col("lo2") + 1)).otherwise((F.col("lo2") + F.col("hi2")) / 2)
        done = F.col("got").isNull() | (F.abs(gap) <= F.greatest(F.col("target") * tolerance, F.lit(1e-4))) | (F.col("hi2") - F.col("lo2") <= F.abs(F.col("lam")) * 1e-15)
        state = stage(state.join(sums, state["source"].eqNullSafe(sums["s"]), "left")
                      .withColumn("lo2", lo).withColumn("hi2", hi).withColumn("done", done)
                      .select("source", "source_size", "target", "unit",
                              F.when(F.col("done"), F.col("lam")).when(inside, newton).otherwise(beyond).alias("lam"),
                              F.col("lo2").alias("lo"), F.col("hi2").alias("hi"), "done"), "mix-state")
        if not state.where("not done").limit(1).count():
            break
    return state.select("source", "source_size", "target", "unit", "lam")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, cap: float = 2.0,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, text_key, source, size, source_size, target, rate, copies, taken), a row
    per row of ``docs``; text_key is the text's 64-bit hash. Null texts have size 0; documents of size 0 have rate 1 or the cap,
    and take no words. Null sources are a source of their own. Copies are 0 to
    ``cap`` (rounded up); runs agree, as ties in size go by a hash of id and size
    and equal rows are interchangeable. An empty table gives none."""
    sized = stage(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                              F.xxhash64(text_col).alias("text_key"), word_count(F.col(text_col)).alias("size")), "mix-sized")
    hist = stage(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-sizes")
    goals = targets(hist.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size")), weights, share, cap)
    lam = balance(hist, goals, cap)
    rate = F.when(F.col("lam") == float("inf"), F.lit(cap)).otherwise(
        F.least(F.exp(F.least(F.col("lam") * F.col("size") / F.col("unit"), F.lit(700.0))), F.lit(cap)))
    by_size = Window.partitionBy("source").orderBy("size")
    cells = (hist.join(lam, hist["source"].eqNullSafe(lam["source"]))
             .select(hist["source"], "size", "n", "source_size", "target", rate.alias("rate"))
             .withColumn("part", F.col("rate") - F.floor("rate"))
             .withColumn("before", F.sum(F.col("n") * F.col("part")).over(by_size) - F.col("n") * F.col("part")))
    cells = stage(cells, "mix-cells")
    ranked = with_rank(sized, ["source", "size"], [F.xxhash64("doc_id", "text_key"), F.col("doc_id"), F.col("text_key")], F.struct("doc_id", "text_key"), "__r")
    at = F.col("before") + F.col("__r") * F.col("part") + 0.5
    copies = (F.floor("rate") + F.floor(at + F.col("part")) - F.floor(at)).cast("int")
    return (ranked.join(cells, ranked["source"].eqNullSafe(cells["source"]) & (ranked["size"] == cells["size"]))
            .select("doc_id", "text_key", ranked["source"], ranked["size"], "source_size", "target", "rate", "__r", "part", "before")
            .select("doc_id", "text_key", "source", "size", "source_size", "target", "rate",
                    F.least(copies, F.ceil(F.lit(cap)).cast("int")).alias("copies"))
            .withColumn("taken", F.col("copies") * F.col("size")))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as its copies say, columns as
    they are, whatever their names. Rows that agree in id and text are numbered, so each
    gets its own. Null ids, texts and sources are values like others; no rows give none."""
    i, key, order, m, copies, copy, i2, key2, n = fresh(docs, "__id", "__key", "__order", "__m", "__copies", "__copy", "__id2", "__key2", "__n")
    taken = (mix(docs, id_col=id_col, text_col=text_col, source_col=source_col, **how)
             .select(F.col("doc_id").alias(i2), F.col("text_key").alias(key2), F.col("copies").alias(copies), F.struct("source", "copies").alias(order))
             .withColumn(n, F.row_number().over(Window.partitionBy(i2, key2).orderBy(order))).drop(order))
    rows = docs.withColumns({i: F.col(id_col), key: F.xxhash64(text_col), order: F.struct(F.col(source_col).cast("string"))})
    rows = rows.withColumn(m, F.row_number().over(Window.partitionBy(i, key).orderBy(order)))
    on = F.col(i).eqNullSafe(F.col(i2)) & (F.col(key) == F.col(key2)) & (F.col(m) == F.col(n))
    out = rows.join(taken, on).where(F.col(copies) > 0).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies))))
    return out.select(*docs.columns)
