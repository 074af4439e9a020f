"""N-gram Jaccard join with set-relation skipping (operator 10).

Sets are the distinct word shingles of whole texts. Equal sets are one class.

1.  Counts. Every task deals its shingles by hash into parts, a binary row per slice of
    texts and part; parts are counted group by group of slices, then whole, and what
    more than one row holds goes back to the slices. No row per shingle is shuffled.
2.  Prefix index. A set's shingles are ordered by rising count (shingles that no other
    row has come first and need no entry). Two sets that link share one of their
    first n - ceil(t * n) + 1 shingles in this order.
3.  Block skipping by position. Index lists are cut into blocks by set size. Where x
    and y meet first at positions i and j, they share at most min(n_x - i, n_y - j)
    shingles, so an entry enters a block only where its position leaves enough for the
    smallest partner there. What distinguishes the members of a family stands at the
    front of their orders, so those that can't link don't meet.
4.  Hubs. In each block the class whose shingles are the most widely shared, as those
    of the text that others were copied from are, is compared exactly with all others
    that are not yet in its component. What links is joined into components, and
    blocks of one component drop out. Rounds go on, with twice as many hubs in each,
    until the pairs of what is outside a block's largest component with the block's
    entries are no more than FEW for each entry of the index.
5.  Answers from a similar set. The pairs left are answered from those of their block's
    first hub h where these suffice: |x & h| + |y & h| - |h| <= |x & y|, and |x & y| <=
    |y & h| + |x - h|, and the same with x and y changed. Only what both bounds leave
    open is compared exactly.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableprep.llm.common import components, fresh, slices, stage

N, NUM, DEN = 4, 85, 100

#: Bytes of text of a slice, shingles of a part of the hash space and slices of a group:
#: the memory of the tasks that count. They change no results.
SLICE, PART, GROUP = 8_000_000, 4_000_000, 64

#: Pairs of entries for each entry of the index from which on they are looked at one by
#: one instead of hub by hub. It moves pairs from one exact way to the other, no results.
FEW = 100

#: Size blocks for each factor NUM / DEN of size.
BLOCKS = 4

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def _mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(n - 1, 0), _BASE, np.uint64)]), dtype=np.uint64)


def shingle_set(text: str, n: int = N) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's ``n``-word shingles; the whole run of
    words as one where there are fewer; empty without words. A-Z count as a-z; words
    are separated by blanks and 09-0D. A word's hash is a polynomial in its bytes,
    taken from running sums, then mixed; a shingle's is one over its words' hashes."""
    raw = _LOWER[np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)]
    if not len(raw):
        return np.empty(0, np.uint64)
    blank = _BLANK[raw]
    edge = np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8))
    begin, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(begin):
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        # each word's bytes from its last to its first by rising powers: sum of byte * base^(end - 1 - i)
        back = np.repeat(end, end - begin) - 1 - np.flatnonzero(~blank)
        longest = int((end - begin).max())
        terms = (raw[~blank].astype(np.uint64) + np.uint64(1)) * _powers(longest)[back]
        sums = np.concatenate([[np.uint64(0)], np.cumsum(terms, dtype=np.uint64)])
        at = np.concatenate([[0], np.cumsum(end - begin)])
        words = _mix(sums[at[1:]] - sums[at[:-1]] + (end - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        k = min(n, len(words))
        out = np.full(len(words) - k + 1, np.uint64(k), np.uint64)
        for j in range(k):
            out = _mix(out * _BASE + words[j:len(words) - k + 1 + j])
    return np.unique(out)


def least_overlap(n: int | np.ndarray, num: int = NUM, den: int = DEN):
    """Least overlap of a set of ``n`` with any set it links with."""
    return -(-num * n // den)


def signatures(docs: DataFrame, n: int, parts: int, id_col: str, text_col: str) -> DataFrame:
    """A row per row of ``docs``: (row_id, doc_id, text_hash, n, key) with the set's size and
    16-byte key and no part. A row per slice of them and part of the hash space, with
    the slice's first row_id: the low halves of its shingles' hashes (tokens) and the
    places in the slice of the rows that hold them (rows), both 32-bit, by row and
    hash. A row per slice with part -1, whose tokens are the sizes of its sets."""
    schema = "row_id long, doc_id long, text_hash long, n long, key binary, part long, rows binary, tokens binary"
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.binary()]
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches):
        for batch, texts in slices(batches, "text", SLICE):
            sets = [shingle_set(t, n) for t in texts]
            sizes = np.array([len(s) for s in sets])
            ids = batch.column("row_id").to_numpy()
            assert ids[-1] - ids[0] == len(ids) - 1
            none = pa.nulls(len(ids), pa.binary())
            yield pa.RecordBatch.from_arrays([*[batch.column(c).cast(pa.int64()) for c in ("row_id", "doc_id", "text_hash")], pa.array(sizes, pa.int64()),
                                              pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                                              pa.nulls(len(ids), pa.int64()), none, none], names=names)
            flat, row = np.concatenate(sets), np.repeat(np.arange(len(sets), dtype=np.uint32), sizes)
            part = ((flat >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
            order = np.argsort(part, kind="stable")
            which, begin = np.unique(part[order], return_index=True)
            low, row = flat[order].astype(np.uint32), row[order]
            out = [(-1, b"", sizes.astype(np.uint32).tobytes())]
            out += [(int(p), row[a:b].tobytes(), low[a:b].tobytes()) for p, a, b in zip(which, begin, np.append(begin, len(flat))[1:], strict=True)]
            k = len(out)
            columns = [[int(ids[0])] * k, *[[None] * k] * 4, *map(list, zip(*out, strict=True))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    return rows.withColumn("text_hash", F.xxhash64("text")).mapInArrow(run, schema)


def _numbers(table: pa.Table, column: str, dtype) -> list[np.ndarray]:
    return [np.frombuffer(b, dtype) for b in table.column(column).to_pylist()]


def _joined(arrays: list[np.ndarray], dtype) -> np.ndarray:
    return np.concatenate([np.empty(0, dtype), *arrays])


def prefix_index(blobs: DataFrame, groups: int, num: int, den: int) -> DataFrame:
    """(token, cid, n, pos, central) from the slices' rows of ``signatures``: the shingles
    that more rows than one hold, as far as they are in their set's prefix, with their
    position in the set's order; central: the mean count of the set's shingles. A token
    is a part and 32 bits of a hash; sets that share a shingle share its token."""
    counted = "part long, g long, tokens binary, counts binary"

    def packed(part, g, tokens, counts):
        return {"part": part, "g": g, "tokens": tokens.tobytes(), "counts": counts.astype(np.int64).tobytes()}

    def table(rows, schema):
        return pa.Table.from_pylist(rows, schema=pa.schema([(f.split()[0], pa.int64() if f.endswith("long") else pa.float64() if f.endswith("double") else pa.binary()) for f in schema.split(", ")]))

    def count(t: pa.Table) -> pa.Table:
        tokens, counts = np.unique(_joined(_numbers(t, "tokens", np.uint32), np.uint32), return_counts=True)
        return table([packed(t["part"][0].as_py(), t["g"][0].as_py(), tokens, counts)], counted)

    def total(t: pa.Table) -> pa.Table:
        tokens, counts = _numbers(t, "tokens", np.uint32), _numbers(t, "counts", np.int64)
        every, back = np.unique(_joined(tokens, np.uint32), return_inverse=True)
        sums = np.zeros(len(every), np.int64)
        np.add.at(sums, back, _joined(counts, np.int64))
        out, at = [], 0
        for g, own in zip(t["g"].to_pylist(), tokens, strict=True):
            mine = sums[back[at:at + len(own)]]
            at += len(own)
            out.append(packed(t["part"][0].as_py(), g, own[mine > 1], mine[mine > 1]))
        return table(out, counted)

    found = "row_id long, part long, rows binary, tokens binary, counts binary"

    def pick(left: pa.Table, right: pa.Table) -> pa.Table:
        tokens, counts = _joined(_numbers(right, "tokens", np.uint32), np.uint32), _joined(_numbers(right, "counts", np.int64), np.int64)
        out = []
        if len(tokens):
            for s, p, rows, own in zip(left["row_id"].to_pylist(), left["part"].to_pylist(), _numbers(left, "rows", np.uint32), _numbers(left, "tokens", np.uint32), strict=True):
                at = np.minimum(np.searchsorted(tokens, own), len(tokens) - 1)
                hit = tokens[at] == own
                out.append({"row_id": s, "part": p, "rows": rows[hit].tobytes(), "tokens": own[hit].tobytes(), "counts": counts[at[hit]].tobytes()})
        return table(out, found)

    entry = "token long, cid long, n long, pos long, central double"

    def place(t: pa.Table) -> pa.Table:
        t = t.sort_by("part")  # the slice's sizes come first
        parts, tokens = t["part"].to_pylist(), _numbers(t, "tokens", np.uint32)
        sizes = tokens[0].astype(np.int64)
        row = _joined(_numbers(t, "rows", np.uint32)[1:], np.uint32).astype(np.int64)
        token = _joined([(np.int64(p) << 32) | own.astype(np.int64) for p, own in zip(parts[1:], tokens[1:], strict=True)], np.int64)
        counts = _joined(_numbers(t, "counts", np.int64)[1:], np.int64)
        order = np.lexsort((token, counts, row))  # stable: tokens that meet stay by their whole hash
        row, token, counts = row[order], token[order], counts[order]
        shared = np.bincount(row, minlength=len(sizes))
        first = np.concatenate([[0], np.cumsum(shared)])
        pos = sizes[row] - shared[row] + np.arange(len(row)) - first[row]
        central = (sizes - shared + np.bincount(row, weights=counts, minlength=len(sizes))) / np.maximum(sizes, 1)
        keep = pos < (sizes - least_overlap(sizes, num, den) + 1)[row]
        row = row[keep]
        return pa.table([token[keep], t["row_id"][0].as_py() + row, sizes[row], pos[keep], central[row]], names=["token", "cid", "n", "pos", "central"])

    dealt = blobs.where("part >= 0").select("row_id", "part", "rows", "tokens", F.pmod(F.xxhash64("row_id"), F.lit(groups)).alias("g"))
    counts = dealt.select("part", "g", "tokens").groupBy("part", "g").applyInArrow(count, counted)
    shared = stage(counts.groupBy("part").applyInArrow(total, counted), "join-counts")
    hits = dealt.groupBy("part", "g").cogroup(shared.groupBy("part", "g")).applyInArrow(pick, found)
    sizes = blobs.where("part = -1").select("row_id", "part", "rows", "tokens", F.lit(b"").alias("counts"))
    return hits.unionByName(sizes).groupBy("row_id").applyInArrow(place, entry)


def compare(pairs: DataFrame, texts: DataFrame, n: int) -> DataFrame:
    """(x, y, nx, ny, overlap) of each pair of classes, from their whole texts (texts: cid,
    text). A pair's texts meet in one row; neighbours that share x have its set worked
    out once."""
    t = pairs.join(texts.select(F.col("cid").alias("y"), F.col("text").alias("ty")), "y")
    t = t.join(texts.select(F.col("cid").alias("x"), F.col("text").alias("tx")), "x")

    def run(batches):
        last, left = None, None
        for batch, tx in slices(batches, "tx"):
            xs, ys, ty = batch.column("x").to_pylist(), batch.column("y").to_pylist(), batch.column("ty").to_pylist()
            nx, ny, both = [], [], []
            for x, a, b in zip(xs, tx, ty, strict=True):
                if x != last:
                    last, left = x, shingle_set(a, n)
                right = shingle_set(b or "", n)
                nx.append(len(left))
                ny.append(len(right))
                both.append(len(np.intersect1d(left, right, assume_unique=True)))
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in (xs, ys, nx, ny, both)], names=["x", "y", "nx", "ny", "overlap"])

    return t.select("x", "y", "tx", "ty").mapInArrow(run, "x long, y long, nx long, ny long, overlap long")


def links(num: int, den: int) -> Column:
    return F.col("overlap") * den >= (F.col("nx") + F.col("ny") - F.col("overlap")) * num


def similar_groups(docs: DataFrame, n: int = N, num: int = NUM, den: int = DEN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id), a row per row of ``docs``: documents link when
    den * intersection >= num * union of their shingle sets; component_id is the
    smallest id that links reach, the row's own included. Null texts and texts without
    words have no shingles and link with nothing; a null id is no component's name (a
    component of null ids only has a null one). Rows with equal texts always link, so
    rows that repeat an id are rows of their own. An empty table gives no rows."""
    sig, full, named = _components(docs, n, num, den, id_col, text_col)
    out = full.join(named, ["key", "n"]).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return out.unionByName(sig.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def _blocks(entries: DataFrame, num: int, den: int) -> DataFrame:
    """Index entries once for each size block in which they may meet a partner: the block
    of the smaller one of a pair. low marks an entry in its own block. An entry stays
    away where its position leaves less than it must share with the smallest partner."""
    step = math.log(den / num) / BLOCKS
    own = F.floor(F.log(F.col("n").cast("double")) / step + 1e-9).cast("int")
    e = entries.withColumn("down", F.explode(F.array(*[F.lit(k) for k in range(BLOCKS + 2)]))).withColumn("block", own - F.col("down"))
    floor, ceiling = F.floor(F.exp(F.col("block") * step)) - 1, F.ceil(F.exp((F.col("block") + 1) * step)) + 1
    least = F.ceil(F.col("n") * num / den)
    partner = F.greatest(least, floor)
    e = e.where((ceiling >= least) & ((F.col("n") - F.col("pos")) * (num + den) >= (F.col("n") + partner) * num))
    return e.select("token", "block", (F.col("down") == 0).alias("low"), "cid", "n", "pos", "central")


def _may_link(x: str, y: str, num: int, den: int) -> Column:
    """What two entries of a block tell by themselves: one of them in its own block, sizes,
    and what follows their positions."""
    nx, ny = F.col(f"{x}n"), F.col(f"{y}n")
    after = F.least(nx - F.col(f"{x}pos"), ny - F.col(f"{y}pos"))
    return ((F.col(f"{x}low") | F.col(f"{y}low")) & (F.least(nx, ny) * den >= F.greatest(nx, ny) * num)
            & (after * (num + den) >= (nx + ny) * num) & (F.col(f"{x}root") != F.col(f"{y}root")))


def _alive(entries: DataFrame, roots: DataFrame | None) -> DataFrame:
    """Entries, with their roots, of the blocks in which components still meet."""
    if roots is None:
        e = entries.withColumn("root", F.col("cid"))
    else:
        e = entries.join(roots.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    whole = e.groupBy("token", "block").agg(F.min("root").alias("a"), F.max("root").alias("b"), F.max("low").alias("any_low"))
    return e.join(whole.where("a < b and any_low").select("token", "block"), ["token", "block"])


def _components(docs: DataFrame, n: int, num: int, den: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The documents' rows of signatures(), those of them with shingles, and each class's
    (key, n, root, component_id)."""
    size = docs.agg(F.sum(F.octet_length(F.col(f"`{text_col}`").cast("string")))).first()[0] or 0
    made = stage(signatures(docs, n, 1 + size // (5 * PART), id_col, text_col), "join-sets")
    sig = made.where("part is null").select("row_id", "doc_id", "text_hash", "n", "key")
    full = sig.where("n > 0")
    # one class for equal sets; its text is that of one of its rows
    classes = stage(full.groupBy("key", "n").agg(F.min("doc_id").alias("least"), F.min("row_id").alias("cid")), "join-classes")

    index = prefix_index(made.where("part is not null"), 1 + size // (SLICE * GROUP), num, den)
    index = index.join(classes.select("cid"), "cid", "left_semi")
    entries = stage(_alive(_blocks(index, num, den), None).drop("root"), "join-index")
    budget = FEW * entries.count()
    texts = stage(_texts(docs, sig, entries.select("cid").distinct(), id_col, text_col), "join-texts")

    # hubs against the others of their blocks, until few pairs are left
    roots = docs.sparkSession.createDataFrame([], "node long, root long")
    tested, centre, hubs = None, None, 1
    while True:
        alive = stage(_alive(entries, roots), "join-alive")
        sizes = alive.groupBy("token", "block", "root").count()
        whole = sizes.groupBy("token", "block").agg(F.sum("count").alias("all"), F.max(F.struct("count", "root")).alias("most"))
        left = whole.agg(F.sum((F.col("all") - F.col("most.count")) * F.col("all"))).first()[0]
        if tested is not None and (left or 0) <= budget:
            break
        slot = F.pmod(F.xxhash64("cid"), F.lit(hubs)).alias("slot")
        hub = (alive.groupBy("token", "block", slot).agg(F.max(F.struct("central", (-F.col("cid")).alias("c"), "n", "pos", "low", "root")).alias("h"))
               .select("token", "block", (-F.col("h.c")).alias("h_cid"), *[F.col(f"h.{c}").alias(f"h_{c}") for c in ("n", "pos", "low", "root")]))
        hub = stage(hub, "join-hubs")
        pairs = (alive.join(hub, ["token", "block"]).withColumnsRenamed({c: f"y_{c}" for c in ("n", "pos", "low", "root")})
                 .where(_may_link("h_", "y_", num, den)).select(F.col("h_cid").alias("x"), F.col("cid").alias("y")).distinct())
        if tested is not None:
            pairs = pairs.join(tested, ["x", "y"], "left_anti").join(tested.select(F.col("x").alias("y"), F.col("y").alias("x")), ["x", "y"], "left_anti")
        now = stage(compare(pairs, texts, n), "join-tested")
        roots = _linked(roots, now.where(links(num, den)))
        if tested is None:
            centre = hub.select("token", "block", F.col("h_cid").alias("h"))
        tested = now if tested is None else tested.unionByName(now)
        entries = alive.drop("root").join(hub.select("token", "block", F.col("h_cid").alias("cid")), ["token", "block", "cid"], "left_anti")
        hubs *= 2

    # the rest, what is outside its block's largest component against all: answers from
    # those of the first hub of the block, else compared
    side = (alive.join(whole.select("token", "block", F.col("most.root").alias("main")), ["token", "block"])
            .withColumn("outside", F.col("root") != F.col("main")).drop("main").join(centre, ["token", "block"])
            .join(tested.select(F.col("x").alias("h"), F.col("y").alias("cid"), F.col("nx").alias("hn"), F.col("overlap").alias("o")), ["h", "cid"], "left")
            .select("token", "block", "cid", "n", "pos", "low", "root", "hn", "o", "outside"))
    side = stage(side, "join-rest")
    a, b = (side.withColumnsRenamed({c: f"{p}{c}" for c in ("cid", "n", "pos", "low", "root", "hn", "o", "outside")}) for p in ("a_", "b_"))
    most = F.least(F.col("b_o") + F.col("a_n") - F.col("a_o"), F.col("a_o") + F.col("b_n") - F.col("b_o"))
    sure = F.col("a_o") + F.col("b_o") - F.col("a_hn")
    enough = lambda o: o * (num + den) >= (F.col("a_n") + F.col("b_n")) * num
    once = ~F.col("b_outside") | (F.col("a_cid") < F.col("b_cid"))
    met = a.where("a_outside").join(b, ["token", "block"]).where(once & _may_link("a_", "b_", num, den) & F.coalesce(enough(most), F.lit(True)))
    met = stage(met.groupBy(F.col("a_cid").alias("x"), F.col("b_cid").alias("y")).agg(F.max(F.coalesce(enough(sure), F.lit(False))).alias("sure")), "join-pairs")
    known = stage(compare(met.where("not sure").select("x", "y"), texts, n), "join-tested").where(links(num, den)).select("x", "y")
    roots = _linked(roots, known.unionByName(met.where("sure").select("x", "y")))

    # classes to components, components to their smallest id
    c = classes.join(roots.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    names = c.groupBy("root").agg(F.min("least").alias("component_id"))
    return sig, full, c.join(names, "root").select("key", "n", "root", "component_id")


def _linked(roots: DataFrame, found: DataFrame) -> DataFrame:
    """(node, root) with the links (x, y) that were found."""
    return stage(components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(found.select(F.col("x").alias("a"), F.col("y").alias("b")))), "join-roots")


def _texts(docs: DataFrame, sig: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(cid, text) for the wanted classes: the text of the class's own row, found by its
    id and the hash of its text."""
    ids = sig.join(wanted.select(F.col("cid").alias("row_id")), "row_id", "left_semi").select(
        F.col("row_id").alias("cid"), F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
    rows = docs.select(F.col(id_col).cast("long").alias("__doc"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    found = rows.join(ids, rows["__doc"].eqNullSafe(ids["__id"]) & (F.xxhash64("text") == ids["__hash"]))
    return found.select("cid", "text").dropDuplicates(["cid"])


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N, num: int = NUM, den: int = DEN) -> DataFrame:
    """``docs`` with one row of each group of similar_groups(): the one with the smallest
    id, null after all others, equal ids by a hash of the text. Rows that repeat both id
    and text count as one; a row whose id another row has as well stays or goes by its
    own text. Rows without words are in no group and all stay. Columns are as in
    ``docs``, whatever their names; an empty table stays empty."""
    _, full, named = _components(docs, n, num, den, id_col, text_col)
    rows = full.join(named.select("key", "n", "root"), ["key", "n"]).select("root", "doc_id", "text_hash").distinct()
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    best = rows.groupBy("root").agg(F.min(order).alias("best"))
    at, h, drop_id, drop_h = fresh(docs, "__at", "__hash", "__drop_id", "__drop_hash")
    dropped = stage(rows.join(best, "root").where(order != F.col("best")).select(F.col("doc_id").alias(drop_id), F.col("text_hash").alias(drop_h)), "join-dropped")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    worded = text.rlike(r"[^\x20\x09-\x0D]")
    mine = docs.where(worded).withColumns({at: F.col(f"`{id_col}`").cast("long"), h: F.xxhash64(text)})
    left = mine.join(dropped, mine[at].eqNullSafe(dropped[drop_id]) & (mine[h] == dropped[drop_h]), "left_anti")
    once = left.dropDuplicates([at, h])
    return once.select(*[F.col(f"`{c}`") for c in docs.columns]).unionByName(docs.where(~worded))
