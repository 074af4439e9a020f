"""Quality classifier from positive and unlabelled documents (operator 6).

Trusted positives are labelled rows of quality 1; every other document is taken as
unlabelled. The class prior is estimated from a first positive-against-unlabelled
model by best-bin estimation (Garg et al. 2021). A linear model then minimises the
non-negative unbiased risk (Kiryo et al. 2017): prior * E_p[l(g)] +
max(0, E_u[l(-g)] - prior * E_p[l(-g)]).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableprep.llm.common import slices

#: Bounds of the training sample: least hashes of their ids.
POSITIVES, UNLABELLED = 4000, 8000

CLASSES = 16
UNIGRAM = CLASSES
DIM = CLASSES + CLASSES * CLASSES + 5


def _classes() -> np.ndarray:
    t = np.full(256, 12, np.uint8)  # other control bytes
    t[128:] = 11
    for k, chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n",
                               b"\t\r\x0b\x0c", b".", b",", b"!?;:", b"'\"`", b"|")):
        t[list(chars)] = k
    for k, chars in ((13, b"#$%&*@=+<>^~_/\\"), (14, b"()[]{}"), (15, b"-")):
        t[list(chars)] = k
    return t


BYTE_CLASS = _classes()


def features(texts: list[str]) -> np.ndarray:
    """A row per text, from the whole text: square roots of the frequencies of byte
    classes and of pairs of them, log size, mean word length, shares of distinct
    words and of distinct lines, and a flag of emptiness."""
    raw = [t.encode("utf-8", "replace") for t in texts]
    sizes = np.array([len(r) for r in raw], np.int64)
    out = np.zeros((len(texts), DIM), np.float32)
    joined = BYTE_CLASS[np.frombuffer(b"".join(raw), np.uint8)].astype(np.int64)
    row = np.repeat(np.arange(len(texts)), sizes)
    one = np.bincount(row * CLASSES + joined, minlength=len(texts) * CLASSES).reshape(len(texts), CLASSES)
    if len(joined) > 1:
        inside = row[1:] == row[:-1]
        two = np.bincount((row[1:] * CLASSES * CLASSES + joined[:-1] * CLASSES + joined[1:])[inside], minlength=len(texts) * CLASSES * CLASSES)
    else:
        two = np.zeros(len(texts) * CLASSES * CLASSES, np.int64)
    n = np.maximum(sizes, 1)[:, None]
    out[:, :UNIGRAM] = np.sqrt(one / n)
    out[:, UNIGRAM:UNIGRAM + CLASSES * CLASSES] = np.sqrt(two.reshape(len(texts), -1) / n)
    for i, t in enumerate(texts):
        words, lines = t.split(), t.split("\n")
        out[i, -5:] = (np.log1p(len(t)), np.log1p(len(t) / max(1, len(words))), len(set(words)) / max(1, len(words)), len(set(lines)) / len(lines), not t)
    return out


def with_features(rows: DataFrame, keep: str, schema: str) -> DataFrame:
    """(keep, x): the text's features as little-endian 32-bit floats."""
    def run(batches):
        for batch, texts in slices(batches, "text"):
            x = features(texts).astype("<f4")
            yield pa.RecordBatch.from_arrays([batch.column(keep), pa.array([r.tobytes() for r in x], pa.binary())], names=[keep, "x"])
    return rows.mapInArrow(run, f"{keep} {schema}, x binary")


def held_out(id_col: str = "doc_id"):
    """crc32 of the id as text, modulo 3, is 1; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


@dataclass
class LinearModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        z = ((x - self.mean) / self.scale) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -60, 60)))


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _fit(p: np.ndarray, u: np.ndarray, prior: float | None, steps: int = 300, rate: float = 0.05, l2: float = 1e-3):
    """Adam on the whole sample. prior None: plain positive-against-unlabelled logistic
    loss; else the non-negative risk, whose step turns around while the negative
    part is below zero."""
    w, b = np.zeros(p.shape[1]), 0.0
    m, v = np.zeros(p.shape[1] + 1), np.zeros(p.shape[1] + 1)
    for t in range(1, steps + 1):
        zp, zu = p @ w + b, u @ w + b
        dp_pos, dp_neg, du_neg = _sigmoid(zp) - 1, _sigmoid(zp), _sigmoid(zu)  # derivatives of l(g) and l(-g)
        if prior is None:
            cp, cu = dp_pos / len(p), du_neg / len(u)
        else:
            negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
            if negative >= 0:
                cp, cu = (prior * dp_pos - prior * dp_neg) / len(p), du_neg / len(u)
            else:
                cp, cu = prior * dp_neg / len(p), -du_neg / len(u)
        g = np.append(p.T @ cp + u.T @ cu + l2 * w, cp.sum() + cu.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w, b


def estimate_prior(p_scores: np.ndarray, u_scores: np.ndarray, delta: float = 0.1, gamma: float = 0.01) -> float:
    """Best-bin estimate of the share of positives among the unlabelled: the least,
    over thresholds c, of (share of u at c or above) / (share of p at c or above) at
    the threshold where its upper confidence bound is least."""
    c = np.sort(p_scores)
    qp = 1 - np.arange(len(c)) / len(c)
    qu = 1 - np.searchsorted(np.sort(u_scores), c, side="left") / len(u_scores)
    slack = np.sqrt(np.log(4 / delta) / (2 * len(u_scores))) + np.sqrt(np.log(4 / delta) / (2 * len(p_scores)))
    bound = (qu + (1 + gamma) * slack) / qp
    best = int(np.argmin(bound))
    return float(np.clip(qu[best] / qp[best], 0.01, 0.99))


def fit(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED,
        id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> LinearModel:
    """Trains on at most ``positives`` labelled rows and ``unlabelled`` documents, those
    whose ids have the least hashes; the rows of held_out() take no part. An id that
    is labelled twice counts as positive when all its labels are 1. Without positives
    or unlabelled documents every score is one half."""
    lab = (labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y")).where(~held_out("id") & F.col("id").isNotNull() & F.col("y").isNotNull())
           .groupBy("id").agg(F.min("y").alias("y")).where("y = 1"))
    ids = docs.select(F.col(id_col).alias("id")).where(~held_out("id") & F.col("id").isNotNull())
    order = [F.xxhash64("id"), F.col("id")]
    pos = lab.join(ids.distinct(), "id", "left_semi").orderBy(*order).limit(positives).select("id", F.lit(1).alias("g"))
    unl = ids.distinct().join(pos, "id", "left_anti").orderBy(*order).limit(unlabelled).select("id", F.lit(0).alias("g"))
    chosen = [(r["id"], r["g"]) for r in pos.unionByName(unl).collect()]
    spark = docs.sparkSession
    sample = spark.createDataFrame(chosen, "id long, g int")  # at most positives + unlabelled rows
    rows = (docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
            .join(F.broadcast(sample), "id").groupBy("id", "g").agg(F.min("text").alias("text")).select("g", "text"))
    got = with_features(rows, "g", "int").collect()
    x = {g: np.stack([np.frombuffer(r["x"], "<f4") for r in got if r["g"] == g]) if any(r["g"] == g for r in got) else np.zeros((0, DIM), np.float32) for g in (0, 1)}
    return fit_arrays(x[1], x[0])


def fit_arrays(p: np.ndarray, u: np.ndarray) -> LinearModel:
    if not len(p) or not len(u):
        return LinearModel(np.zeros(DIM), np.ones(DIM), np.zeros(DIM), 0.0, 0.5)
    p, u = p[np.lexsort(p.T[::-1])].astype(np.float64), u[np.lexsort(u.T[::-1])].astype(np.float64)
    both = np.concatenate([p, u])
    mean, scale = both.mean(0), np.maximum(both.std(0), 1e-3)
    p, u = np.clip((p - mean) / scale, -8, 8), np.clip((u - mean) / scale, -8, 8)
    fold_p, fold_u = np.arange(len(p)) % 2 == 0, np.arange(len(u)) % 2 == 0
    if len(p) > 1 and len(u) > 1:
        w, b = _fit(p[fold_p], u[fold_u], None)
        prior = estimate_prior(_sigmoid(p[~fold_p] @ w + b), _sigmoid(u[~fold_u] @ w + b))
    else:
        prior = 0.5
    w, b = _fit(p, u, prior)
    return LinearModel(mean, scale, w, float(b), prior)


def score(docs: DataFrame, model: LinearModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted), a row per row of ``docs``; null texts are empty."""
    def run(batches):
        for batch, texts in slices(batches, "text"):
            x = features(texts).astype(np.float64)
            s = model.score(model.mean + np.clip((x - model.mean) / model.scale, -8, 8) * model.scale)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(s, pa.float64()),
                                              pa.array((s >= 0.5).astype(np.int32), pa.int32())], names=["doc_id", "held_out", "score", "predicted"])
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.withColumn("held_out", held_out()).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
