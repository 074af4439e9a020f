"""Packing documents into sequences by cutting-stock column generation (operator 9).

A document's ids are cut into full sequences and a rest. The rests' true lengths are
a histogram of bounded size; a linear program over patterns (how many rests of each length share a sequence) is solved by the simplex
method, with columns priced by knapsack dynamic programming. Rounded-down patterns,
and first-fit patterns for the few rests that rounding leaves, are given to the
rests by their rank within their length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tableprep.llm.common import Encoder, slices, stage, with_rank

LENGTH = 2048


def _price(value: np.ndarray, sizes: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded knapsack over integer sizes: for each room up to ``room`` the largest
    value, and the item to take first (-1: leave one place free)."""
    best, item = np.zeros(room + 1), np.full(room + 1, -1)
    use = np.flatnonzero(value > 1e-12)
    own, worth = sizes[use], value[use]
    ends = np.searchsorted(own, np.arange(room + 1), side="right")
    for c in range(1, room + 1):
        best[c] = best[c - 1]
        k = ends[c]
        if k:
            v = best[c - own[:k]] + worth[:k]
            j = v.argmax()
            if v[j] > best[c] + 1e-12:
                best[c], item[c] = v[j], use[j]
    return best, item


def _pattern(item: np.ndarray, sizes: np.ndarray, room: int, first: int) -> np.ndarray:
    """The counts of the best knapsack that holds size ``first``."""
    counts, c = np.zeros(len(sizes)), room - int(sizes[first])
    counts[first] = 1
    while c > 0:
        if item[c] < 0:
            c -= 1
        else:
            counts[item[c]] += 1
            c -= int(sizes[item[c]])
    return counts


def _first_fit(sizes: np.ndarray, left: np.ndarray, room: int):
    """(pattern, times) that hold ``left``, largest rests first: each pattern is as full
    as the rests still left allow, and is taken until one of its sizes is used up."""
    left = left.copy()
    open_ = [int(i) for i in np.flatnonzero(left)[::-1]]
    while open_:
        pattern, free = {}, room
        for i in open_:
            if free < sizes[open_[-1]]:
                break
            if k := min(int(left[i]), free // int(sizes[i])):
                pattern[i], free = k, free - k * int(sizes[i])
        n = min(int(left[i]) // k for i, k in pattern.items())
        for i, k in pattern.items():
            left[i] -= n * k
        yield pattern, n
        open_ = [i for i in open_ if left[i]]


def _shares(sizes: np.ndarray, demand: np.ndarray, room: int) -> np.ndarray:
    """Values that sum to at most 1 in any pattern, with the largest sum over ``demand``:
    sizes below some k count nothing, those that leave less than k count 1 and others
    their share of ``room``; or those above the half count 1 and the half itself 0.5."""
    halves = np.where(2 * sizes > room, 1.0, np.where(2 * sizes == room, 0.5, 0.0))
    each = (np.where(sizes > room - k, 1.0, np.where(sizes < k, 0.0, sizes / room)) for k in range(room // 2 + 1))
    return max([halves, *each], key=lambda v: float(v @ demand))


class _Inverse:
    """The basis' inverse as a dense matrix less a product of HELD rank-one updates, which
    are multiplied in together: a pivot costs HELD * m steps in place of m * m."""

    HELD = 48

    def __init__(self, matrix: np.ndarray):
        self.matrix, m = matrix, len(matrix)
        self.left, self.right, self.k = np.empty((m, self.HELD)), np.empty((self.HELD, m)), 0

    def times(self, has: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The inverse times a pattern."""
        out = self.matrix[:, has] @ counts
        return out - self.left[:, :self.k] @ (self.right[:self.k, has] @ counts) if self.k else out

    def pivot(self, r: int, d: np.ndarray) -> np.ndarray:
        """Puts the pattern with times() ``d`` in place ``r``; the new row ``r``."""
        row = (self.matrix[r] - self.left[r, :self.k] @ self.right[:self.k]) / d[r]
        self.left[:, self.k], self.right[self.k] = d, row
        self.left[r, self.k] -= 1
        self.k += 1
        if self.k == self.HELD:
            self.whole()
        return row

    def sums(self) -> np.ndarray:
        """The columns' sums."""
        out = self.matrix.sum(0)
        return out - self.left[:, :self.k].sum(0) @ self.right[:self.k] if self.k else out

    def whole(self) -> np.ndarray:
        if self.k:
            self.matrix -= self.left[:, :self.k] @ self.right[:self.k]
            self.k = 0
        return self.matrix


#: Knapsacks of one plan at most, which bounds its pivots too. After them the basis so far
#: is rounded, as it may be at any time: the plan holds every rest, only its padding may
#: be more than ``gap`` above the least.
KNAPSACKS = 600


def solve(sizes: np.ndarray, demand: np.ndarray, room: int, tolerance: float = 1e-7, gap: float = 1e-4, columns: int = 64,
          most: int = KNAPSACKS, told: dict | None = None) -> list[tuple[np.ndarray, float]]:
    """Column generation for: least number of patterns that cover ``demand``. The basis
    starts with one pattern per size (as many of it as fit), then takes first-fit
    patterns that are worth more than 1. Each knapsack, whose values lean towards the
    best lower bound's (first that of _shares()), gives up to ``columns``
    patterns; the inverse is updated at each pivot and worked out anew every 2,000. It
    ends when no pattern is worth more than 1, or when the value is within ``gap`` of a
    proven lower bound, or within half a sequence of the whole number that the ids fill,
    or after ``most`` knapsacks. Returns (pattern, times) of the basis; ``told`` gets the
    proven lower bound."""
    m = len(sizes)
    basis = np.diag((room // sizes).astype(float))
    inverse = _Inverse(np.diag(1 / (room // sizes)))
    # a little more of each size, in uneven steps, so that pivots don't tie and go round
    uneven = demand + 0.1 * (1 + np.arange(m) * 0.6180339887 % 1)
    x = uneven / (room // sizes)
    dual, pivots = inverse.sums(), 0

    def enter(has: np.ndarray, counts: np.ndarray) -> bool:
        nonlocal inverse, x, dual, pivots
        gain = dual[has] @ counts
        if gain <= 1 + tolerance:
            return False
        d = inverse.times(has, counts)
        ok = d > 1e-9 * max(1.0, float(np.abs(d).max()))
        ratio = np.where(ok, x / np.where(ok, d, 1), np.inf)
        r = int(np.where(ratio <= ratio.min() * (1 + 1e-9) + 1e-12, d, -np.inf).argmax())
        theta = ratio[r]
        x = np.maximum(x - theta * d, 0)
        x[r] = theta
        basis[:, r] = 0
        basis[has, r] = counts
        pivots += 1
        row = inverse.pivot(r, d)
        if pivots % 2000 == 0:
            inverse = _Inverse(np.linalg.inv(basis))
            x = np.maximum(inverse.matrix @ uneven, 0)
            dual = inverse.matrix.sum(0)
        else:
            dual = dual - (gain - 1) * row
        return True

    for pattern, _ in _first_fit(sizes, demand.astype(np.int64), room):
        enter(np.array(list(pattern)), np.array(list(pattern.values()), float))
    enough, even, lean = np.ceil(float(sizes @ demand) / room - 1e-9), _shares(sizes, demand, room), 0.5
    bound = float(even @ demand)
    for _ in range(most):
        if (dual := inverse.sums()) @ demand <= max(enough + max(gap * enough, 0.5), bound * (1 + gap)):
            break
        value = lean * even + (1 - lean) * dual
        best, item = _price(value, sizes, room)
        gains = value + best[room - sizes]
        if (proven := value @ demand / max(best[room], 1)) > bound:
            bound, even = proven, value / max(best[room], 1)
        moved = False
        for first in np.argsort(-gains, kind="stable")[:columns]:
            a = _pattern(item, sizes, room, first)
            has = np.flatnonzero(a)
            moved |= enter(has, a[has])
        if not moved:
            if not lean:
                break
            lean = lean / 2 if lean > 0.1 else 0.0
    if told is not None:
        told["bound"] = max(bound, float(sizes @ demand) / room)
    x = inverse.whole() @ demand
    return [(basis[:, j].astype(np.int64), float(x[j])) for j in range(m) if x[j] > 1e-9]


def plan(demand: dict[int, int], room: int) -> list[tuple[dict[int, int], int]]:
    """(pattern, times) with whole numbers that hold each of ``demand`` (size: rests)
    exactly once; patterns are size: count."""
    sizes = np.array(sorted(demand), np.int64)
    if not len(sizes):
        return []
    left = np.array([demand[int(s)] for s in sizes], np.int64)
    out = []
    for pattern, times in sorted(solve(sizes, left.astype(float), room), key=lambda p: (-p[1], p[0].tolist())):
        has = np.flatnonzero(pattern)
        if n := min(int(np.floor(times + 1e-6)), int((left[has] // pattern[has]).min())):
            out.append(({int(sizes[i]): int(pattern[i]) for i in has}, n))
            left[has] -= n * pattern[has]
    # what rounding leaves
    out.extend(({int(sizes[i]): k for i, k in pattern.items()}, n) for pattern, n in _first_fit(sizes, left, room))
    return out


def id_width(tokenizer: str, end_id: int) -> int:
    """Bytes that hold any id of the vocabulary: 2 or 4."""
    tok = Encoder.of(tokenizer).tok
    return 2 if max(tok.get_vocab_size(with_added_tokens=True), end_id + 1) <= 65_536 else 4


def widened(df: DataFrame, width: int) -> DataFrame:
    """``df`` with its binary ``ids`` as 32-bit integers."""
    def run(batches):
        for batch in batches:
            wide = [np.frombuffer(x, f"<u{width}").astype("<u4").tobytes() for x in batch.column("ids").to_pylist()]
            yield batch.set_column(batch.schema.get_field_index("ids"), "ids", pa.array(wide, pa.binary()))
    return df if width == 4 else df.mapInArrow(run, df.schema)


def tokenised_pieces(docs: DataFrame, tokenizer: str, end_id: int, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, doc_key, start, length, doc_tokens, ids): each document's ids with
    ``end_id``, cut into pieces of ``length`` and a rest. ids is binary: little-endian
    unsigned integers of id_width() bytes; doc_key tells rows that repeat an id apart."""
    kind = f"<u{id_width(tokenizer, end_id)}"

    def run(batches):
        enc = Encoder.of(tokenizer)
        for batch, texts in slices(batches, "text", 1_000_000):
            ids, ends = enc.encode(texts)
            cols = ([], [], [], [], [], [])
            for i, (doc, key) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("doc_key").to_pylist(), strict=True)):
                own = np.append(ids[ends[i]:ends[i + 1]], np.uint32(end_id)).astype(kind)
                for s in range(0, len(own), length):
                    part = own[s:s + length]
                    for c, v in zip(cols, (doc, key, s, len(part), len(own), part.tobytes()), strict=True):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in cols[:5]], pa.array(cols[5], pa.binary())],
                                             names=["doc_id", "doc_key", "start", "length", "doc_tokens", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("doc_key"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, doc_key long, start long, length long, doc_tokens long, ids binary")


def pack(pieces: DataFrame, length: int = LENGTH) -> DataFrame:
    """``pieces`` (written already, as by stage()) with sequence_id and offset. Full
    pieces stand alone; sequence
    ids of the patterns' sequences are from 0, the others follow. Patterns are planned
    on the driver from the histogram (length - 1 rows at most) and joined to the
    rests as a table whose size the histogram bounds as well."""
    spark = pieces.sparkSession
    narrow = pieces.select("doc_key", "start", "length", F.col("length").cast("int").alias("__size"))
    demand = {r["__size"]: r["n"] for r in narrow.where(F.col("__size") < length).groupBy("__size").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows, used, sequence = [], dict.fromkeys(demand, 0), 0
    for pattern, times in plan(demand, length):
        slot = 0
        for size, count in pattern.items():
            rows.append((size, used[size], used[size] + count * times, count, sequence, slot))
            used[size] += count * times
            slot += count
        sequence += times
    ranges = spark.createDataFrame(rows or [(-1, 0, 0, 1, 0, 0)], "__s int, __from long, __to long, __count int, __first long, __slot int")
    alone = F.col("__size") == length
    ranked = with_rank(narrow, ["__size"], [F.col("doc_key"), F.col("start")], F.struct("doc_key", "start"), "__rank")
    on = (F.col("__size") == F.col("__s")) & (F.col("__rank") >= F.col("__from")) & (F.col("__rank") < F.col("__to"))
    placed = ranked.where(~alone).join(F.broadcast(ranges), on)
    j = F.col("__rank") - F.col("__from")
    placed = placed.select("doc_key", "start", "length", (F.col("__first") + F.floor(j / F.col("__count"))).alias("sequence_id"),
                           (F.col("__slot") + j % F.col("__count")).alias("__slot"))
    w = Window.partitionBy("sequence_id").orderBy("__slot")
    shared = placed.withColumn("offset", F.sum("length").over(w) - F.col("length")).select("doc_key", "start", "sequence_id", "offset")
    single = ranked.where(alone).select("doc_key", "start", (F.lit(sequence) + F.col("__rank")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return pieces.join(shared.unionByName(single), ["doc_key", "start"])


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, length: int = LENGTH,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset), a row per piece.
    Null texts are empty documents of the end id alone; rows that repeat an id are
    documents of their own; an empty table gives no rows. ids is binary, little-endian
    unsigned 32-bit. Lengths need room for
    ``length`` ids in a sequence; a sequence may be left unpadded where it is full."""
    pieces = stage(tokenised_pieces(docs, tokenizer, end_id, length, id_col, text_col), "pack-pieces")
    placed = pack(pieces, length).select("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")
    return widened(placed, id_width(tokenizer, end_id))
