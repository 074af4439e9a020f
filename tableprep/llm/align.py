"""Cross-tokenizer alignment with an identity map (operator 12).

Tokenizer A is a byte-level file of the ``tokenizers`` library, B a ``sentencepiece``
model that puts a blank before a text. Where tokens of both end at one byte, the text
is cut; between two cuts lies a group. A group's last tokens are linked. An array from
each A id to the B id of the same bytes is made once: groups of one token each that it
knows are counted in vectors as long as A's vocabulary. All other links are counted by
pair through a shuffle, each slice of texts sending a pair once.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableprep.llm.common import slices, stage

_BLANK = r"[^\S\x1c-\x1f]"
_SIGN = r"[\S\x1c-\x1f]"


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level token stands for: printable ones
    of Latin-1 for themselves, the others' bytes in order from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(hidden)}}


class Pair:
    """Both tokenizers, and what is known of chunks of text met before. A chunk ends
    before a blank or a new line that follows another sign; where no token of either
    vocabulary can reach across such a place both encode chunks as they would the whole
    text. Otherwise the whole text is one chunk. The cache is emptied when it has
    CACHE chunks or CACHE_LINKS links, so its size doesn't follow the data; LEARN new
    chunks at most are encoded at a time."""

    CACHE, CACHE_LINKS, LEARN = 400_000, 3_000_000, 8192
    _known: dict[tuple[str, str], "Pair"] = {}

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        alphabet = byte_alphabet()
        vocab = self.a.get_vocab(with_added_tokens=True)
        added = self.a.get_added_tokens_decoder()
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for t, i in vocab.items():
            self.bytes_a[i] = t.encode() if i in added else bytes(alphabet[c] for c in t)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        plain = [not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i) or self.b.is_unused(i)) for i in range(len(pieces))]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.n_a, self.n_b = len(self.bytes_a), len(pieces)
        self.size_a, self.size_b = (np.array([len(x) for x in v], np.int64) for v in (self.bytes_a, self.bytes_b))
        # A id to the B id of the same bytes, byte tokens only where there is no other; -1: none
        same = {x: i for i, x in enumerate(self.bytes_b) if self.b.is_byte(i)} | {x: i for i, x in enumerate(self.bytes_b) if plain[i]}
        self.identity = np.array([-1 if i in added else same.get(x, -1) for i, x in enumerate(self.bytes_a)], np.int64)
        self.blank = self.b.piece_to_id("▁")
        pre = self.a.pre_tokenizer.pre_tokenize_str("a b\nc") if self.a.pre_tokenizer else []
        apart = [w for w, _ in pre] == ["a", "Ġb", "Ċ", "c"] and not self.a.normalizer
        cut = apart and not any(re.search(r"[^▁]▁|\n", p) for p, own in zip(pieces, plain, strict=True) if own)
        self.chunk = re.compile(rf"{_BLANK}*{_SIGN}+(?:(?![ \n]){_BLANK}+{_SIGN}+)*(?:(?![ \n]){_BLANK}+\Z)?|{_BLANK}+" if cut else r"(?s:.+)")
        self.clear()

    @classmethod
    def of(cls, path_a: str, path_b: str) -> "Pair":
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        return cls._known.get((path_a, path_b)) or cls._known.setdefault((path_a, path_b), cls(path_a, path_b))

    def clear(self):
        self.index: dict[str, int] = {}
        self.text: list[str | None] = []  # groups as written; None: no tokens
        self.counts = np.empty((0, 3), np.int64)  # tokens of A, of B, groups
        self.start, self.links = np.zeros(1, np.int64), np.empty(0, np.int64)

    def _pieces(self, chunks: list[str]) -> list[list[int]]:
        """B's ids; a chunk has its leading blank already. Before another first sign,
        which is a new line, the blank that B adds is a token of its own: it goes."""
        ids = self.b.encode([c[1:] if c[0] == " " else c for c in chunks], num_threads=1)
        return [(x or [self.blank]) if c[0] == " " else x[1:] for c, x in zip(chunks, ids, strict=True)]

    def _learn(self, new: list[str]):
        ids_a = [e.ids for e in self.a.encode_batch_fast(new, add_special_tokens=False)]
        ids_b = self._pieces(new)
        bytes_a, bytes_b = self.bytes_a, self.bytes_b
        good = []
        for i, c in enumerate(new):
            raw = c.encode("utf-8", "surrogatepass")
            if b"".join([bytes_a[x] for x in ids_a[i]]) == raw and b"".join([bytes_b[x] for x in ids_b[i]]) == raw:
                good.append(i)
        counts = np.zeros((len(new), 3), np.int64)
        text: list[str | None] = [None] * len(new)
        links, ends = np.empty(0, np.int64), np.zeros(len(new), np.int64)
        if good:
            a, b = (np.fromiter((x for i in good for x in ids[i]), np.int64) for ids in (ids_a, ids_b))
            end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
            both = np.intersect1d(end_a, end_b, assume_unique=True)
            at_a, at_b = np.searchsorted(end_a, both), np.searchsorted(end_b, both)
            links = a[at_a] * self.n_b + b[at_b]
            counts[good, 0] = [len(ids_a[i]) for i in good]
            counts[good, 1] = [len(ids_b[i]) for i in good]
            last = np.searchsorted(at_a, np.cumsum(counts[good, 0]) - 1) + 1  # groups up to each chunk's end
            counts[good, 2] = np.diff(last, prepend=0)
            name_a, name_b = list(map(str, a.tolist())), list(map(str, b.tolist()))
            to_a, to_b, g, i_a, i_b = (at_a + 1).tolist(), (at_b + 1).tolist(), 0, 0, 0
            for i, stop in zip(good, last.tolist(), strict=True):
                out = []
                while g < stop:
                    j_a, j_b = to_a[g], to_b[g]
                    out.append(f"{name_a[i_a] if j_a == i_a + 1 else ','.join(name_a[i_a:j_a])}|{name_b[i_b] if j_b == i_b + 1 else ','.join(name_b[i_b:j_b])}")
                    g, i_a, i_b = g + 1, j_a, j_b
                text[i] = ";".join(out)
            ends = counts[:, 2]
        base = len(self.text)
        self.index.update(zip(new, range(base, base + len(new)), strict=True))
        self.text.extend(text)
        self.counts = np.concatenate([self.counts, counts])
        self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(ends)])
        self.links = np.concatenate([self.links, links])

    def align(self, texts: list[str]) -> tuple[list[np.ndarray], np.ndarray, list[str]]:
        """Of each text: its links (A id * n_b + B id, in order), its counts (tokens of
        A and B, groups) and its groups as written; nothing where the bytes differ."""
        if len(self.text) > self.CACHE or len(self.links) > self.CACHE_LINKS:
            self.clear()
        chunks = [self.chunk.findall(" " + t) if t else [] for t in texts]
        new = dict.fromkeys(c for own in chunks for c in own if c not in self.index)
        new = list(new)
        for i in range(0, len(new), self.LEARN):
            self._learn(new[i:i + self.LEARN])
        links, counts, written = [], np.zeros((len(texts), 3), np.int64), []
        for k, own in enumerate(chunks):
            at = list(map(self.index.__getitem__, own))
            parts = [self.text[i] for i in at]
            if not at or None in parts:
                links.append(np.empty(0, np.int64))
                written.append("")
                continue
            at = np.array(at)
            begin, size = self.start[at], self.start[at + 1] - self.start[at]
            ends = np.cumsum(size)
            links.append(self.links[np.repeat(begin - ends + size, size) + np.arange(ends[-1])])
            counts[k] = self.counts[at].sum(0)
            written.append(";".join(parts))
        return links, counts, written


SLICES = ("slice long, ids array<long>, counts array<long>, groups array<string>, ones binary, n_ones array<long>, "
          "pairs array<long>, times array<long>, at binary, n_pairs array<long>")


def aligned(docs: DataFrame, path_a: str, path_b: str, id_col: str, text_col: str) -> DataFrame:
    """A row per slice of texts (SLICES): its documents' ids, counts (three each) and
    sha256 of groups; ones: A ids of the links that the identity map knows, n_ones by
    document; pairs: the other links' distinct codes, times they occur in the slice; at:
    each such link's number in pairs, n_pairs by document."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        from pyspark import TaskContext
        pair, slice_ = Pair.of(path_a, path_b), TaskContext.get().partitionId() << 32
        kind = "<u2" if pair.n_a <= 1 << 16 else "<u4"
        for batch, texts in slices(batches, "text", 700_000):
            links, counts, written = pair.align(texts)
            code = np.concatenate(links)
            known = pair.identity[code // pair.n_b] == code % pair.n_b
            of = np.repeat(np.arange(len(links)), [len(x) for x in links])
            n_ones, n_pairs = (np.bincount(of[x], minlength=len(links)) for x in (known, ~known))
            pairs, at, times = np.unique(code[~known], return_inverse=True, return_counts=True)
            row = {"slice": slice_, "ids": batch.column("doc_id").to_pylist(), "counts": counts.ravel(),
                   "groups": [hashlib.sha256(w.encode()).hexdigest() if w else "" for w in written],
                   "ones": (code[known] // pair.n_b).astype(kind).tobytes(), "n_ones": n_ones, "pairs": pairs, "times": times,
                   "at": at.astype("<u4").tobytes(), "n_pairs": n_pairs}
            kinds = {"slice": pa.int64(), "groups": pa.list_(pa.string()), "ones": pa.binary(), "at": pa.binary()}
            yield pa.RecordBatch.from_arrays([pa.array([v], kinds.get(c, pa.list_(pa.int64()))) for c, v in row.items()], names=list(row))
            slice_ += 1

    return rows.mapInArrow(run, SLICES)


def vectors(cut: DataFrame, n_a: int) -> DataFrame:
    """(a, n): links by A id that the identity map knows, counted in one vector a task."""
    kind = "<u2" if n_a <= 1 << 16 else "<u4"

    def run(batches):
        total = np.zeros(n_a, np.int64)
        for batch in batches:
            for ones in batch.column("ones").to_pylist():
                total += np.bincount(np.frombuffer(ones, kind), minlength=n_a)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["a", "n"])

    return cut.select("ones").mapInArrow(run, "a long, n long").groupBy("a").agg(F.sum("n").alias("n"))


def pair_counts(cut: DataFrame, path_a: str, path_b: str) -> tuple[np.ndarray, DataFrame, np.ndarray]:
    """How many links hold each id pair: a vector by A id for the pairs of the identity
    map, a table (code, n) for the others, and each B id's highest count. The two
    vectors are as long as the vocabularies, whatever the input."""
    pair = Pair.of(path_a, path_b)
    one, best = np.zeros(pair.n_a, np.int64), np.zeros(pair.n_b, np.int64)
    for r in vectors(cut, pair.n_a).toLocalIterator():
        one[r["a"]] = r["n"]
    own = cut.select(F.explode(F.arrays_zip("pairs", "times")).alias("p")).select(F.col("p.pairs").alias("code"), F.col("p.times").alias("n"))
    table = stage(own.groupBy("code").agg(F.sum("n").alias("n")), "align-pairs")
    for r in table.groupBy((F.col("code") % pair.n_b).alias("b")).agg(F.max("n").alias("n")).toLocalIterator():
        best[r["b"]] = r["n"]
    known = np.flatnonzero(pair.identity >= 0)
    np.maximum.at(best, pair.identity[known], one[known])
    return one, table, best


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), a row per
    row of ``docs``. Links are pairs of an A and a B token that end at one byte; a link's
    count is how many links of all documents hold the same two ids; n_best are a
    document's links whose count is the highest of their B id, count_sum their counts'
    sum. Texts that are null or empty, or whose tokens' bytes differ from a blank and
    the text, have zeros and ''. Null and repeated ids are rows of their own; an empty
    table gives no rows."""
    cut = stage(aligned(docs, path_a, path_b, id_col, text_col), "align-slices")
    one, table, best = pair_counts(cut, path_a, path_b)
    pair = Pair.of(path_a, path_b)
    n_b, kind = pair.n_b, "<u2" if pair.n_a <= 1 << 16 else "<u4"
    good = np.zeros(pair.n_a, bool)
    known = np.flatnonzero(pair.identity >= 0)
    good[known] = one[known] == best[pair.identity[known]]

    # each slice's pairs in their order, with their counts; a slice's texts bound its list
    asked = cut.select("slice", F.posexplode("pairs").alias("i", "code"))
    told = asked.join(table, "code").groupBy("slice").agg(F.array_sort(F.collect_list(F.struct("i", "code", "n"))).alias("told"))
    told = told.select("slice", F.transform("told", lambda t: t["code"]).alias("codes"), F.transform("told", lambda t: t["n"]).alias("ns"))
    rows = cut.select("slice", "ids", "counts", "groups", "ones", "n_ones", "at", "n_pairs").join(told, "slice", "left")

    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                get = lambda c: batch.column(c)[r]
                array = lambda c: get(c).values.to_numpy(zero_copy_only=False).astype(np.int64) if get(c).is_valid else np.empty(0, np.int64)
                counts, n_ones, n_pairs = array("counts").reshape(-1, 3), array("n_ones"), array("n_pairs")
                ones, at = np.frombuffer(get("ones").as_py(), kind), np.frombuffer(get("at").as_py(), "<u4")
                codes, ns = array("codes"), array("ns")
                top = ns == best[codes % n_b]
                docs_of = np.arange(len(counts))
                sums, tops = (np.zeros(len(counts), np.int64) for _ in range(2))
                for of, n, is_top in ((np.repeat(docs_of, n_ones), one[ones], good[ones]), (np.repeat(docs_of, n_pairs), ns[at], top[at])):
                    np.add.at(sums, of, n)
                    tops += np.bincount(of[is_top], minlength=len(counts))
                yield pa.RecordBatch.from_arrays(
                    [get("ids").values, *[pa.array(c, pa.int64()) for c in (*counts.T, counts[:, 2], tops, sums)], get("groups").values],
                    names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return rows.mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
