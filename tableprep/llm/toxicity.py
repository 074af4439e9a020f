"""Toxicity by a classifier chain (operator 8).

The categories are 'toxic in language L' for each language that has a toxic document
among all labelled ones, and 'toxic' itself, last. They are predicted one
after another by linear models over words and word stems; a later model also sees the earlier
categories' probabilities, which for its training come from models that did not see
the row (out-of-fold). Language and label are read for training only.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableprep.llm.common import slices, stage, with_rank

#: Bounds of the training sample (toxic rows by turns of the languages, clean ones by
#: least hashes of ids), the vocabulary, and the folds.
TOXIC_ROWS, CLEAN_ROWS, WORDS, FOLDS = 2500, 5000, 512, 3

_WORD = re.compile(r"\w+")
STEMS = (4, 5, 6, 7)


def terms(text: str) -> set[str]:
    """The distinct lower-case words, and as 'stem*' the first letters of longer ones."""
    words = set(_WORD.findall(text.lower()))
    return words | {w[:k] + "*" for w in words for k in STEMS if len(w) > k}


@dataclass
class Chain:
    words: list[str]
    categories: list[str]
    weights: list[np.ndarray]  # of category j: words, then the j earlier probabilities
    biases: list[float]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """A column per category. x: a row per text, a column per word (0 or 1)."""
        out = np.zeros((len(x), len(self.categories)))
        for j, (w, b) in enumerate(zip(self.weights, self.biases, strict=True)):
            out[:, j] = _sigmoid(x @ w[:x.shape[1]] + out[:, :j] @ w[x.shape[1]:] + b)
        return out


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def _fit_linear(x: np.ndarray, y: np.ndarray, weight: np.ndarray, l2: float = 0.3, steps: int = 12) -> np.ndarray:
    """Weighted ridge logistic regression by Newton steps; the last weight is the bias.
    Without both outcomes the model is the constant of their (smoothed) share."""
    if y.min(initial=1) == y.max(initial=0):
        share = (weight[y == 1].sum() + 0.01) / (weight.sum() + 1)
        return np.append(np.zeros(x.shape[1]), np.log(share / (1 - share)))
    x = np.concatenate([x, np.ones((len(x), 1))], 1)
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], l2)
    ridge[-1] = 1e-6
    for _ in range(steps):
        p = _sigmoid(x @ w)
        g = x.T @ (weight * (p - y)) + ridge * w
        h = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(ridge)
        d = np.linalg.solve(h, g)
        w -= d
        if np.abs(d).max() < 1e-6:
            break
    return w


def fit_chain(x: np.ndarray, ys: np.ndarray, weight: np.ndarray, fold: np.ndarray, words: list[str], categories: list[str]) -> Chain:
    """x: rows by words; ys: rows by categories; weight: rows' weights (undo the uneven
    sampling); fold: rows' folds."""
    earlier = np.zeros((len(x), 0))
    weights, biases = [], []
    for j in range(len(categories)):
        full = np.concatenate([x, earlier], 1)
        w = _fit_linear(full, ys[:, j], weight)
        weights.append(w[:-1])
        biases.append(float(w[-1]))
        own = np.zeros(len(x))
        for k in range(FOLDS):
            out = fold == k
            if out.any():
                v = _fit_linear(full[~out], ys[~out, j], weight[~out])
                own[out] = _sigmoid(full[out] @ v[:-1] + v[-1])
        earlier = np.concatenate([earlier, own[:, None]], 1)
    return Chain(words, categories, weights, biases)


def _word_sets(rows: DataFrame, keep: list[str]) -> DataFrame:
    """(keep..., words): the terms of each text."""
    types = dict(rows.dtypes)

    def run(batches):
        for batch, texts in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in keep], pa.array([sorted(terms(t)) for t in texts], pa.list_(pa.string()))],
                                             names=[*keep, "words"])
    return rows.mapInArrow(run, ", ".join(f"{k} {types[k]}" for k in keep) + ", words array<string>")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        label_col: str = "toxic", toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS, words: int = WORDS) -> Chain:
    """Trains on at most ``toxic_rows`` and ``clean_rows`` labelled documents, weighted
    back to the labels' shares (toxic ones by language); an id labelled twice is toxic if
    any label is, and the least of an id's rows by language and text stands for it. The
    categories come from a count over all labels. The toxic rows are taken in turns, one
    of each language (one row of each at least, if that is more than ``toxic_rows``). The
    vocabulary is the ``words`` words with the largest chi-square for toxic, with at
    least 5 documents; counts are Spark aggregates over the sample. Without labelled
    documents of both kinds the chain rejects nothing."""
    lab = (labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y")).where(F.col("id").isNotNull() & F.col("y").isNotNull())
           .groupBy("id").agg(F.max("y").cast("int").alias("y")))
    lab = lab.join(docs.select(F.col(id_col).alias("id")).distinct(), "id", "left_semi")
    lab = stage(lab, "tox-labels")
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("")) if lang_col in docs.columns else F.lit("")
    clean = lab.where("y = 0")
    toxic = docs.select(F.col(id_col).alias("id"), lang.alias("lang")).join(lab.where("y = 1"), "id").groupBy("id").agg(F.min("lang").alias("lang"))
    toxic = stage(toxic, "tox-toxic")
    totals = {r["lang"]: r["n"] for r in toxic.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    own = sorted(totals)
    order = [F.xxhash64("id"), F.col("id")]
    turns = with_rank(toxic, ["lang"], order, F.col("id"), "turn").orderBy("turn", *order).limit(max(toxic_rows, len(own)))
    chosen = turns.select("id", F.lit(1).alias("y")).unionByName(clean.orderBy(*order).limit(clean_rows)).collect()
    if not any(r["y"] for r in chosen) or all(r["y"] for r in chosen):
        return Chain([], [*[f"toxic_{v}" for v in own], "toxic"], [np.zeros(j) for j in range(len(own) + 1)], [-10.0] * (len(own) + 1))
    spark = docs.sparkSession
    sample = spark.createDataFrame([(r["id"], r["y"]) for r in chosen], "id long, y int")  # bounded as above
    rows = (docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), lang.alias("lang"))
            .join(F.broadcast(sample), "id").groupBy("id", "y").agg(F.min(F.struct("lang", "text")).alias("t"))
            .select("id", "y", F.col("t.lang").alias("lang"), F.col("t.text").alias("text")))
    sets = stage(_word_sets(rows, ["id", "y", "lang"]), "tox-words")
    n1, n0 = sum(r["y"] for r in chosen), sum(1 - r["y"] for r in chosen)
    counts = sets.select("y", F.explode("words").alias("w")).groupBy("w").agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b")).where("a + b >= 5")
    a, b = F.col("a"), F.col("b")
    chi = (n1 + n0) * (a * (n0 - b) - b * (n1 - a)) ** 2 / (n1 * n0 * (a + b) * F.greatest(n1 + n0 - a - b, F.lit(1)))
    vocabulary = [r["w"] for r in counts.withColumn("chi", chi).orderBy(F.desc("chi"), "w").limit(words).collect()]
    at = spark.createDataFrame([(w, i) for i, w in enumerate(vocabulary)] or [("", 0)], "w string, i int")
    hits = (sets.select("id", "y", "lang", F.explode_outer("words").alias("w")).join(F.broadcast(at), "w", "left")
            .groupBy("id", "y", "lang").agg(F.sort_array(F.collect_list("i")).alias("at")).orderBy("id").collect())
    x = np.zeros((len(hits), len(vocabulary)))
    for r, h in enumerate(hits):
        x[r, h["at"]] = 1
    y = np.array([h["y"] for h in hits])
    langs = [h["lang"] for h in hits]
    ys = np.stack([*[y * np.array([a == v for a in langs]) for v in own], y], 1)
    taken = {v: sum(1 for a, t in zip(langs, y, strict=True) if t and a == v) for v in own}
    of_clean = clean.count() / n0
    weight = np.array([totals[a] / taken[a] if t else of_clean for a, t in zip(langs, y, strict=True)])
    weight *= len(y) / weight.sum()
    fold = np.array([int.from_bytes(str(h["id"]).encode(), "little") % 1_000_003 % FOLDS for h in hits])
    return fit_chain(x, ys, weight, fold, vocabulary, [*[f"toxic_{v}" for v in own], "toxic"])


def score_texts(chain: Chain, texts: list[str]) -> np.ndarray:
    index = {w: i for i, w in enumerate(chain.words)}
    x = np.zeros((len(texts), len(chain.words)))
    for r, t in enumerate(texts):
        for w in index.keys() & terms(t):
            x[r, index[w]] = 1
    return chain.probabilities(x)


def score(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, categories map<string, double>, score double, toxic int), a row per row
    of ``docs``, over whole texts; null texts are empty. score is the last category's
    probability, toxic is 1 where it is at least one half."""
    def run(batches):
        for batch, texts in slices(batches, "text"):
            p = score_texts(chain, texts)
            maps = pa.array([list(zip(chain.categories, map(float, r), strict=True)) for r in p], pa.map_(pa.string(), pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), maps, pa.array(p[:, -1], pa.float64()), pa.array((p[:, -1] >= 0.5).astype(np.int32), pa.int32())],
                                             names=["doc_id", "categories", "score", "toxic"])
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, categories map<string,double>, score double, toxic int")


def keep_clean(docs: DataFrame, chain: Chain, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text the chain rejects; all columns as they are."""
    names = docs.columns

    def run(batches):
        for batch, texts in slices(batches, text_col):
            yield batch.filter(pa.array(score_texts(chain, texts)[:, -1] < 0.5))
    return docs.select(*names).mapInArrow(run, docs.schema)
