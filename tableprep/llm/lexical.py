"""Ranked lexical search by pipelined term partitioning (operator 13).

Postings are kept by block of documents and by term; a term's owner follows from its
rarity. A bundle of items meets the owners one after another, the rarest terms' first:
at each one, a cogroup on (bundle, block) brings the bundle's sparse accumulators
together with the owner's postings for the block, and adds integer contributions. An
accumulator goes no further once the block alone has k documents that it can't reach.
The last owner's accumulators are cut to k for each item and block, then to k overall.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tableprep.llm.common import stage

#: Terms, as bytes with A-Z as a-z: digits, letters and everything beyond ASCII.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")

#: Most documents of a block, and most characters of their texts beside the last one's.
BLOCK_DOCS, BLOCK_CHARS = 8192, 16_000_000

#: Most items of a bundle.
BUNDLE = 64

#: Owner k has the terms that fewer than one document in BANDS[k] holds; the last owner all others.
BANDS = (512, 64, 8)

#: Bits of the filter of the items' terms: its size doesn't follow the items. The more
#: terms they have the more postings pass that no item asks for; the join drops those.
FILTER_BITS = 1 << 22

#: Terms that a task remembers the filter's answer for.
CACHE = 1_000_000


def terms(text: str | None) -> list[bytes]:
    """All terms of a text; bytes.lower() changes A-Z alone."""
    return TERM.findall(text.encode("utf-8", "surrogatepass").lower()) if text else []


def _small(values: np.ndarray) -> bytes:
    """Little-endian unsigned integers in the least width that holds them all."""
    top = int(values.max()) if len(values) else 0
    return values.astype("<u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4" if top < 1 << 32 else "<u8").tobytes()


def _wide(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, f"<u{len(data) // n}").astype(np.int64) if n else np.empty(0, np.int64)


class _Known(dict):
    """Terms that may be asked for."""

    def __init__(self, bits: np.ndarray):
        super().__init__()
        self.bits = bits

    def __missing__(self, term: bytes) -> bool:
        answer = bool(self.bits[zlib.crc32(term) % FILTER_BITS])
        if len(self) < CACHE:
            self[term] = answer
        return answer


POSTINGS = ("block long, term binary, df long, max_tf long, places binary, tfs binary, sizes binary, "
            "ids array<long>, docs long, words long")


def index(docs: DataFrame, bits: bytes, id_col: str, text_col: str) -> DataFrame:
    """Rows (block, term, df, max_tf, places, tfs, sizes) of the terms that ``bits`` lets
    pass, and a row without a term for each block: ids of its documents (with at least
    one term), ascending, null last, docs and words. A block's places are numbers in
    ids; sizes are the documents' numbers of terms."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def made(block: int, held: list):
        held.sort(key=lambda d: (d[0] is None, d[0] or 0))
        lists: dict[bytes, tuple[list, list]] = {}
        for place, (_, _, own) in enumerate(held):
            for term, tf in own:
                x = lists.get(term)
                if x is None:
                    x = lists[term] = ([], [])
                x[0].append(place)
                x[1].append(tf)
        size = np.array([n for _, n, _ in held], np.int64)
        cols = {c.split()[0]: [] for c in POSTINGS.replace("array<long>", "ids").split(", ")}

        def put(**x):
            for k, v in cols.items():
                v.append(x.get(k))

        put(block=block, ids=[d for d, _, _ in held], docs=len(held), words=int(size.sum()))
        for term in sorted(lists):
            at, tf = (np.array(v, np.int64) for v in lists[term])
            put(block=block, term=term, df=len(at), max_tf=int(tf.max()), places=_small(at), tfs=_small(tf), sizes=_small(size[at]))
        kinds = {"term": pa.binary(), "places": pa.binary(), "tfs": pa.binary(), "sizes": pa.binary(), "ids": pa.list_(pa.int64())}
        whole = pa.RecordBatch.from_arrays([pa.array(v, kinds.get(k, pa.int64())) for k, v in cols.items()], names=list(cols))
        for i in range(0, whole.num_rows, 4096):
            yield whole.slice(i, 4096)

    def run(batches):
        from pyspark import TaskContext
        known = _Known(np.unpackbits(np.frombuffer(zlib.decompress(bits), np.uint8)))
        block, held, total = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                text = text.as_py()
                found = terms(text)
                if not found:
                    continue
                held.append((doc_id, len(found), [(t, n) for t, n in Counter(found).items() if known[t]]))
                total += len(text)
                if len(held) == BLOCK_DOCS or total > BLOCK_CHARS:
                    yield from made(block, held)
                    block, held, total = block + 1, [], 0
        if held:
            yield from made(block, held)

    return rows.mapInArrow(run, POSTINGS)


def asked(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, item_id, term, times): each item's distinct terms; item tells rows apart."""
    rows = items.select(F.monotonically_increasing_id().alias("item"), F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            out = [(i, d, t, n) for i, d, text in zip(*(batch.column(c).to_pylist() for c in ("item", "item_id", "text")), strict=True)
                   for t, n in sorted(Counter(terms(text)).items())]
            cols = list(zip(*out, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(cols, (pa.int64(), pa.int64(), pa.binary(), pa.int64()), strict=True)],
                                             names=["item", "item_id", "term", "times"])

    return rows.mapInArrow(run, "item long, item_id long, term binary, times long")


STATE = "bundle long, block long, item long, places binary, scores binary"


def visit(state: DataFrame, owned: DataFrame, n_docs: int, n_words: int, k: int) -> DataFrame:
    """``state`` (STATE) after an owner: ``owned`` has (bundle, block, df, places, tfs,
    sizes, needs) of its terms, needs: array of (item, weight, rest), where weight has
    the item's repeats in it and rest is the most that later owners can add."""
    def add(left: pa.Table, right: pa.Table) -> pa.Table:
        found: dict[int, list] = {}  # item: accumulators by place, rest
        bundle, block = next((t.column(0)[0].as_py(), t.column(1)[0].as_py()) for t in (left, right) if t.num_rows)
        room = 0
        held = {}
        for item, places, scores in zip(*(left.column(c).to_pylist() for c in ("item", "places", "scores")), strict=True):
            score = np.frombuffer(scores, "<i8")
            held[item] = (_wide(places, len(score)), score)
            room = max(room, int(held[item][0].max(initial=-1)) + 1)
        rows = []
        for df, places, tfs, sizes, needs in zip(*(right.column(c).to_pylist() for c in ("df", "places", "tfs", "sizes", "needs")), strict=True):
            at, tf, size = _wide(places, df), _wide(tfs, df), _wide(sizes, df)
            m = 75 + (25 * size * n_docs) // n_words
            rows.append((at, (1_000_000_000 * tf) // (1000 * tf + 12 * m), needs))
            room = max(room, int(at.max(initial=-1)) + 1)
        for at, part, needs in rows:
            for need in needs:
                own = found.get(need["item"])
                if own is None:
                    own = found[need["item"]] = [np.zeros(room, np.int64), need["rest"]]
                    if need["item"] in held:
                        own[0][held[need["item"]][0]] = held[need["item"]][1]
                own[0][at] += need["weight"] * part
        out = ([], [], [])
        for item in sorted({*found, *held}):
            if item in found:
                every, rest = found[item]
                at = np.flatnonzero(every)
                score = every[at]
                if len(at) > k:
                    keep = score + rest >= np.partition(score, -k)[-k]
                    at, score = at[keep], score[keep]
            else:
                at, score = held[item]
            if len(at):
                for c, v in zip(out, (item, _small(at), score.astype("<i8").tobytes()), strict=True):
                    c.append(v)
        n = len(out[0])
        return pa.Table.from_arrays([pa.array([bundle] * n, pa.int64()), pa.array([block] * n, pa.int64()), pa.array(out[0], pa.int64()),
                                     pa.array(out[1], pa.binary()), pa.array(out[2], pa.binary())], names=["bundle", "block", "item", "places", "scores"])

    return state.groupBy("bundle", "block").cogroup(owned.groupBy("bundle", "block")).applyInArrow(add, STATE)


def _best(state: DataFrame, k: int) -> DataFrame:
    """(item, block, place, score): each row's k highest scores, equal ones by place."""
    def run(batches):
        for batch in batches:
            out = ([], [], [], [])
            for item, block, places, scores in zip(*(batch.column(c).to_pylist() for c in ("item", "block", "places", "scores")), strict=True):
                score = np.frombuffer(scores, "<i8")
                at = _wide(places, len(score))
                first = np.lexsort((at, -score))[:k]
                for c, v in zip(out, ([item] * len(first), [block] * len(first), at[first].tolist(), score[first].tolist()), strict=True):
                    c.extend(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["item", "block", "place", "score"])

    return state.mapInArrow(run, "item long, block long, place long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 20, item_col: str = "item_id", item_text: str = "text",
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): for each row of ``items`` the ``k`` documents with
    the highest scores above 0, equal scores by ascending id, null last.

    Null texts have no terms; documents without terms take no part, items without any
    give no rows. Documents that repeat an id are documents of their own, items that
    repeat an id are ranked apart under one id; null ids stay null. Empty tables give
    no rows. Whole numbers throughout but for the logarithm in a term's weight."""
    spark: SparkSession = docs.sparkSession
    out = "item_id long, rank int, doc_id long, score long"
    want = stage(asked(items, item_col, item_text), "rank-items")
    # at most FILTER_BITS numbers come to the driver, whatever the items
    on = [r[0] for r in want.select((F.crc32("term") % FILTER_BITS).cast("int")).distinct().toLocalIterator()]
    bits = np.zeros(FILTER_BITS, np.uint8)
    bits[on] = 1
    rows = stage(index(docs, zlib.compress(np.packbits(bits).tobytes()), id_col, text_col), "rank-postings")
    total = rows.where("term is null").agg(F.sum("docs").alias("n"), F.sum("words").alias("l")).first()
    if not total["n"] or not on:
        return spark.createDataFrame([], out)
    n_docs, n_words = int(total["n"]), int(total["l"])
    postings = rows.where("term is not null")

    # a term's weight, its owner and the most that it adds to a score
    df = postings.groupBy("term").agg(F.sum("df").alias("n"), F.max("max_tf").alias("tf"))
    weight = F.floor(1000 * F.log((F.lit(2.0 * n_docs + 2)) / (2 * F.col("n") + 1)))
    owner = F.lit(len(BANDS))
    for b in reversed(range(len(BANDS))):
        owner = F.when(F.col("n") * BANDS[b] < n_docs, b).otherwise(owner)
    part = F.expr("(1000000000 * tf) div (1000 * tf + 900)")
    number = want.groupBy("item").agg(F.first("item_id").alias("item_id"))
    bundle = F.pmod(F.xxhash64("item"), F.lit(max(1, -(-number.count() // BUNDLE))))
    needs = (want.join(df, "term").withColumn("weight", weight.cast("long") * F.col("times")).where("weight > 0")
             .select("item", bundle.alias("bundle"), "term", "weight", owner.alias("owner"), (F.col("weight") * part).alias("most")))
    sums = needs.groupBy("item", "owner").agg(F.sum("most").alias("most"))
    behind = Window.partitionBy("item").orderBy(F.col("owner").desc()).rowsBetween(Window.unboundedPreceding, -1)
    rest = sums.select("item", "owner", F.coalesce(F.sum("most").over(behind), F.lit(0)).alias("rest"))
    needs = stage(needs.join(rest, ["item", "owner"]).groupBy("owner", "term", "bundle")
                  .agg(F.collect_list(F.struct("item", "weight", "rest")).alias("needs")), "rank-needs")

    state = spark.createDataFrame([], STATE)
    for o in range(len(BANDS) + 1):
        owned = (postings.select("block", "term", "df", "places", "tfs", "sizes").join(needs.where(F.col("owner") == o), "term")
                 .select("bundle", "block", "df", "places", "tfs", "sizes", "needs"))
        state = visit(state, owned, n_docs, n_words, k)
    best = _best(state, k)

    ids = rows.where("term is null").select("block", F.posexplode("ids").alias("place", "doc_id"))
    named = best.join(ids.withColumn("place", F.col("place").cast("long")), ["block", "place"])
    first = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "block", "place")
    top = named.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
    return top.join(number, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
