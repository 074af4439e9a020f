"""Helpers shared by the training-data operators: stage tables, tokenising with
a per-process word cache, exact ranks without a one-task group, and components."""

from __future__ import annotations

import re
from array import array
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tableprep.session import materialize

#: Characters of one slice of texts that a task works on at a time.
SLICE_CHARS = 2_000_000


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under spark.checkpoint.dir and read it back."""
    return materialize(df, f"llm-{name}")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns beside ``df``'s own, which are compared without case:
    those given, with as many underscores in front as it takes."""
    used, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in used:
            n = f"_{n}"
        used.add(n.lower())
        out.append(n)
    return out


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches, text_col: str, limit: int = SLICE_CHARS):
    """Arrow batches cut into pieces of at most ``limit`` bytes of text (one row
    at least), each with its texts as Python strings, null as ''."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(text_col))
        sizes = np.diff(np.frombuffer(col.buffers()[1], dtype=np.int32 if pa.types.is_string(col.type) else np.int64,
                                      count=len(col) + 1 + col.offset)[col.offset:]) if len(col) else []
        start, total = 0, 0
        for i, n in enumerate(sizes):
            if i > start and total + n > limit:
                yield batch.slice(start, i - start), [t or "" for t in col.slice(start, i - start).to_pylist()]
                start, total = i, 0
            total += int(n)
        if len(col) > start:
            yield batch.slice(start), [t or "" for t in col.slice(start).to_pylist()]


# White space as the tokenizers' patterns see it (Python's \s also has 1C-1F).
# A run of plain letters before a blank or a sign of ASCII other than the apostrophe
# is a word in either pattern.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
_PLAIN = re.compile(f" [{_LETTERS}]+")
_CHUNK = re.compile(rf" ?[{_LETTERS}]++(?=[ \n!-&(-/:-@\[-`{{-~])|" r" ?[\S\x1c-\x1f]+|[^\S\x1c-\x1f]+(?![\S\x1c-\x1f])|[^\S\x1c-\x1f]+")
_ENCODERS: dict[str, "Encoder"] = {}


class Encoder:
    """Ids of whole texts. Neither public tokenizer file forms a token across the
    start of a blank-led word, so each distinct word is encoded once by the
    library and its ids are looked up after that. A text that holds the string of
    a special token is encoded by the library in one piece. The cache is emptied
    when it has CACHE words or ids, so its size doesn't follow the data."""

    CACHE = 800_000
    JOINED = 200

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        vocab = self.tok.get_vocab(with_added_tokens=True)
        suffix = self.tok.model.end_of_word_suffix
        self.plain = Tokenizer.from_file(path)
        self.word_end, self.size = None, np.zeros(max(vocab.values()) + 1, np.int64)
        if suffix:
            self.word_end = np.zeros(len(self.size), bool)
            self.word_end[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
            self.plain.normalizer = None  # it lowers case only, in plain words; _learn does that
        else:  # byte-level: a character of a token is a byte
            self.size[list(vocab.values())] = [len(t) for t in vocab]
        self.clear()

    @classmethod
    def of(cls, path: str) -> "Encoder":
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if path not in _ENCODERS:
            _ENCODERS[path] = cls(path)
        return _ENCODERS[path]

    def clear(self):
        self.index: dict[str, int] = {}
        self.flat, self.starts = array("I"), array("q", [0])

    def _learn(self, new: list[str]):
        """Encodes new words; plain ones many in one call, cut apart again at the ids that
        end a word, or by the bytes that the ids stand for."""
        plain, whole = [], []
        for c in new:
            (plain if _PLAIN.fullmatch(c) else whole).append(c)
        cased = {}
        if self.word_end is not None:
            cased = {c: low for c in plain if (low := c.lower()) != c}
            plain = [c for c in dict.fromkeys(cased.get(c, c) for c in plain) if c not in self.index]
        for i in range(0, len(plain), self.JOINED):
            some = plain[i:i + self.JOINED]
            ids = np.array(self.plain.encode_batch_fast(["".join(some)], add_special_tokens=False)[0].ids, np.uint32)
            if self.word_end is not None:
                ends = np.flatnonzero(self.word_end[ids]) + 1
            else:
                ends = np.searchsorted(np.cumsum(self.size[ids]), np.cumsum([len(c.encode()) for c in some])) + 1
            assert len(ends) == len(some) and ends[-1] == len(ids)
            base = len(self.flat)
            self.flat.frombytes(ids.tobytes())
            self.index.update(zip(some, range(len(self.starts) - 1, len(self.starts) - 1 + len(some)), strict=True))
            self.starts.extend((base + ends).tolist())
        self.index.update((c, self.index[low]) for c, low in cased.items())
        for c, e in zip(whole, self.tok.encode_batch_fast(whole, add_special_tokens=False), strict=True):
            self.index[c] = len(self.starts) - 1
            self.flat.extend(e.ids)
            self.starts.append(len(self.flat))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and the texts' offsets in them."""
        if len(self.index) > self.CACHE or len(self.flat) > 6 * self.CACHE:
            self.clear()
        chunks = [[t] if any(s in t for s in self.special) else _CHUNK.findall(t) for t in texts]
        counts = np.fromiter(map(len, chunks), np.int64, len(chunks))
        every = list(chain.from_iterable(chunks))
        at = np.fromiter(map(self.index.get, every, repeat(-1)), np.int64, len(every))
        unknown = np.flatnonzero(at < 0)
        if len(unknown):
            self._learn(list({every[i] for i in unknown}))
            at[unknown] = [self.index[every[i]] for i in unknown]
        starts = np.frombuffer(self.starts, np.int64)  # views, gone when this call ends
        begin, size = starts[at], starts[at + 1] - starts[at]
        ends = np.concatenate([[0], np.cumsum(size)])
        ids = np.frombuffer(self.flat, np.uint32)[np.repeat(begin - ends[:-1], size) + np.arange(ends[-1])]
        return ids, ends[np.concatenate([[0], np.cumsum(counts)])]


def with_rank(df: DataFrame, keys: list[str], order: list[Column], salt: Column, out: str,
              buckets: int = 256) -> DataFrame:
    """Adds ``out``: the row's number from 0 within its ``keys`` group, gapless.

    A group is cut into ``buckets`` by ``salt`` and numbered bucket by bucket, so
    no group is sorted in one task; buckets' starting numbers come from a table of
    counts. Rows that tie in ``order`` are numbered in either way."""
    b = df.withColumn("__b", F.pmod(F.xxhash64(salt), F.lit(buckets)))
    starts = (b.groupBy(*keys, "__b").agg(F.count(F.lit(1)).alias("__n"))
              .withColumn("__start", F.sum("__n").over(Window.partitionBy(*keys).orderBy("__b")) - F.col("__n")))
    on = [b[k].eqNullSafe(starts[k]) for k in [*keys, "__b"]]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    w = Window.partitionBy(*[b[k] for k in [*keys, "__b"]]).orderBy(*order)
    return (b.join(starts, cond).select(*[b[c] for c in df.columns],
                                        (F.row_number().over(w) - 1 + starts["__start"]).alias(out)))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``edges``; root is the least node that links
    reach. Alternating large-star and small-star steps (Kiveris et al. 2014), each
    written to a stage table; a hub's neighbours meet only in a minimum and a
    join, never in one list."""
    e = stage(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct(), "edges")
    while True:
        both = e.select("u", "v").union(e.select(F.col("v"), F.col("u")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = stage(large, "large-star")
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        e = stage(small, "small-star")
        # done where every node has one edge, to a root: no node is a neighbour's root and has one itself
        nodes = e.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(e.select("v", F.lit(0), F.lit(1)))
        if nodes.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or up = 1 and down = 1").isEmpty():
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
