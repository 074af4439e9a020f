"""Document fingerprints from closed syncmers (operator 7), in DataFrame functions only.

A k-mer is ``k`` neighbouring words; its inner substrings are runs of ``s`` words.
It is chosen when its least inner hash stands at its first or last place. The choice
looks at the k-mer alone, so a passage gives the same anchors wherever it stands,
with their positions in words. A fingerprint is all anchors in order of their hashes,
each as hash@position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K, S = 5, 2


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def anchors(text: Column, k: int = K, s: int = S, m: int | None = None) -> Column:
    """array<struct<h long, p int>>: the anchors by hash (with ``m`` the ``m`` least), each
    hash with its first position. A text of 1 to k-1 words is one anchor (its whole run of words);
    one without words, or null, has none."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    inner = k - s + 1

    def of_words(w: Column) -> Column:
        n = F.size(w)
        # run hashes: xxhash64 over s neighbouring words
        runs = F.when(n >= k, F.transform(F.sequence(F.lit(0), n - s), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(s)])))

        def chosen(r: Column) -> Column:
            def edge(i: Column) -> Column:
                a, b = F.get(r, i), F.get(r, i + (inner - 1))
                mid = [F.get(r, i + j) for j in range(1, inner - 1)]
                first, last = a <= b, b <= a
                for x in mid:
                    first, last = first & (a <= x), last & (b <= x)
                return first | last
            at = F.filter(F.sequence(F.lit(0), n - k), edge)
            return F.transform(at, lambda i: F.struct(F.xxhash64(F.get(r, i), *[F.get(r, i + j) for j in range(s, k - s, s)], F.get(r, i + (k - s))).alias("h"), i.alias("p")))

        return F.when(n >= k, let(runs, chosen)).when(n > 0, F.array(F.struct(F.xxhash64(F.array_join(w, " ")).alias("h"), F.lit(0).alias("p"))))

    def least(found: Column) -> Column:
        # sorted by hash, then position; the first of equal hashes stays
        kept = let(F.sort_array(found), lambda a: F.filter(a, lambda x, i: (i == 0) | (F.get(a, i - 1)["h"] != x["h"])))
        return kept if m is None else F.slice(kept, 1, m)

    none = F.array().cast("array<struct<h:bigint,p:int>>")
    return F.coalesce(least(let(words, of_words)), none)


def fingerprint(found: Column) -> Column:
    """Anchors as text: 16 hex digits @ position, in order of hash, comma-joined."""
    return F.array_join(F.transform(found, lambda x: F.concat(F.lpad(F.lower(F.hex(x["h"])), 16, "0"), F.lit("@"), x["p"].cast("string"))), ",")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of two texts' anchors. Two texts without anchors are alike (1);
    one without and one with are not (0)."""
    both = F.size(F.array_intersect(F.transform(a, lambda x: x["h"]), F.transform(b, lambda x: x["h"])))
    return let(both, lambda n: F.when(F.size(a) + F.size(b) == 0, F.lit(1.0)).otherwise(n / F.greatest(F.size(a) + F.size(b) - n, F.lit(1))))


def shift(a: Column, b: Column) -> Column:
    """Most common move in position of the anchors that both have (ties: the least),
    null without any. Sorted together, an anchor of both stands beside itself."""
    marked = lambda c, t: F.transform(c, lambda x: F.struct(x["h"].alias("h"), F.lit(t).alias("t"), x["p"].alias("p")))
    beside = F.sort_array(F.concat(marked(a, 0), marked(b, 1)))
    moves = let(beside, lambda z: F.array_compact(F.transform(z, lambda x, i: F.when(F.get(z, i + 1)["h"] == x["h"], F.get(z, i + 1)["p"] - x["p"]))))

    def most(m: Column) -> Column:
        firsts = F.filter(F.sequence(F.lit(0), F.size(m) - 1), lambda i: (i == 0) | (F.get(m, i - 1) != F.get(m, i)))
        counted = let(firsts, lambda f: F.transform(f, lambda i, j: F.struct((i - F.coalesce(F.get(f, j + 1), F.size(m))).alias("c"), F.get(m, i).alias("d"))))
        return F.when(F.size(m) > 0, F.array_min(counted)["d"])
    return let(F.sort_array(moves), most)


def with_next(df: DataFrame, id_col: str, cols: list[str], ranges: int) -> tuple[DataFrame, list, Column]:
    """``df`` dealt into ranges of ``id_col`` whose borders are ids of the table (null
    ids first). The row at each border is also sent to the range before it, and the
    first row of all to the last range, so the next row is at hand in every range
    without a window over all. Returns the rows with __range and __own, and the
    window's keys and order."""
    borders = df.agg(F.percentile_approx(id_col, [i / ranges for i in range(1, ranges)], 100 * ranges),
                     F.min(id_col), F.max(F.col(id_col).isNull())).first()
    inner = sorted({b for b in borders[0] or [] if borders[1] is not None and b > borders[1]})
    first = None if borders[2] else borders[1]
    step = max(1, int(len(inner) ** 0.5))
    coarse, groups = inner[::step], [inner[i:i + step] for i in range(0, len(inner), step)]
    longs = lambda xs: F.array(*[F.lit(int(x)).cast("long") for x in xs]) if xs else F.array().cast("array<bigint>")
    x = F.col(id_col)
    # a border's range is the number of borders at or below it: groups that are wholly below, and those of the last group
    g = F.size(F.filter(longs(coarse), lambda b: b <= x))
    fine = F.array(*[longs(v) for v in [[], *groups]])
    place = F.when(g > 0, (g - 1) * step + F.size(F.filter(F.get(fine, g), lambda b: b <= x))).otherwise(0)
    last = len(inner)
    own = df.withColumn("__range", F.when(x.isNull(), 0).otherwise(place)).withColumn("__copy", F.lit(0))
    at_border = F.array_contains(longs(inner), x) if inner else F.lit(False)
    before = F.when(at_border, F.array(F.struct((F.col("__range") - 1).alias("r"), F.lit(1).alias("c")))).otherwise(F.array().cast("array<struct<r:int,c:int>>"))
    wrap = F.when(x.eqNullSafe(F.lit(first)), F.array(F.struct(F.lit(last).alias("r"), F.lit(2).alias("c")))).otherwise(F.array().cast("array<struct<r:int,c:int>>"))
    placed = own.withColumn("__to", F.concat(F.array(F.struct(F.col("__range").alias("r"), F.lit(0).alias("c"))), before, wrap))
    placed = placed.select(*cols, F.explode("__to").alias("__to")).select(*cols, F.col("__to.r").alias("__range"), F.col("__to.c").alias("__copy"))
    order = [F.col("__copy").eqNullSafe(F.lit(2)), F.col(id_col).asc_nulls_first()]
    return placed, ["__range"], order


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", partitions: int | None = None) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, n_anchors, edited_shift), a row per row of ``docs``. The next document
    is the next by ascending id (null ids first, rows that repeat an id by their
    text), after the last the first; a single document is its own. Null texts are
    empty. An empty table gives no rows."""
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    placed, keys, order = with_next(rows, "doc_id", ["doc_id", "text"], 4 * n)
    w = Window.partitionBy(*keys).orderBy(*order, F.col("text"))
    size, cut = F.length("text"), F.floor(F.length("text") / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), size - cut), F.substring("next_text", F.lit(1), cut))
    found = (placed.withColumn("next_text", F.coalesce(F.lead("text").over(w), F.lit("")))
             .select("doc_id", *keys, "__copy", "text", size.cast("long").alias("n_chars"), edited.alias("edited"))
             .select("doc_id", *keys, "__copy", "text", "n_chars", F.sha2(F.col("edited"), 256).alias("edited_sha256"),
                     anchors(F.col("text")).alias("a"), F.when(F.col("__copy") == 0, anchors(F.col("edited"))).alias("e")))
    out = found.withColumn("next_a", F.lead("a").over(w)).where("__copy = 0")
    return out.select("doc_id", "n_chars", "edited_sha256", fingerprint(F.col("a")).alias("fingerprint"),
                      fingerprint(F.col("e")).alias("edited_fingerprint"), likeness(F.col("a"), F.col("e")).alias("near_edited"),
                      likeness(F.col("a"), F.col("next_a")).alias("near_next"), F.size("a").alias("n_anchors"),
                      shift(F.col("a"), F.col("e")).alias("edited_shift"))
