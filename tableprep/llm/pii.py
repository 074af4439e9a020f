"""Personal data: fixed patterns, and bootstrapped contextual extraction (operator 5).

The fixed patterns give the base spans, which are also the seeds. Every other token
that looks like an identifier (it has a digit or an @) is an instance; the words
around an occurrence are its lexical patterns. Spark scores the graph of patterns
and instances in turns: a pattern's confidence is the share of its instances that
are known to be of a kind, an instance's score joins its patterns' confidences.
Tokens in patterns of high confidence become spans of the kinds 'context_<kind>'.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableprep.llm.common import fresh, slices, stage

KINDS = ("email", "ip", "card", "phone")
# Fixed patterns (the contract's own).
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
TOKEN = re.compile(r"[0-9@]")

#: A pattern needs this many distinct known instances, this confidence; an instance this score.
SUPPORT, CONFIDENCE, SCORE = 3, 0.6, 0.8
#: Longest context word.
WORD = 40


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) in code points, by start, then kind as listed.

    An e-mail is found from its @: the leftmost match that the pattern can give
    begins where the run of local characters before the @ (after the last match)
    begins, so no run is scanned more than once."""
    found = []
    at, last = text.find("@"), 0
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            found.append((start, 0, m.end()))
            last = m.end()
        else:
            last = max(last, at + 1)
        at = text.find("@", max(at + 1, last))
    if TOKEN.search(text):
        for m in IP.finditer(text):
            parts = [p.lstrip("0") for p in m[0].split(".")]
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                found.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            if 12 <= len(d := _digits(m[0])) <= 19 and _luhn(d):
                found.append((m.start(), 2, m.end()))
        for m in PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                found.append((m.start(), 3, m.end()))
    return [(s, KINDS[k], e) for s, k, e in sorted(found)]


def _before(text: str, pos: int) -> tuple[str, int]:
    """The word that ends at ``pos`` or before the blanks there, and its start; of a word
    longer than WORD its last WORD + 1 characters."""
    while pos > 0 and text[pos - 1].isspace():
        pos -= 1
    start = pos
    while start > 0 and pos - start <= WORD and not text[start - 1].isspace():
        start -= 1
    return text[start:pos], start


def _after(text: str, pos: int) -> str:
    """The word that begins at ``pos`` or after the blanks there, cut as in _before()."""
    while pos < len(text) and text[pos].isspace():
        pos += 1
    end = pos
    while end < len(text) and end - pos <= WORD and not text[end].isspace():
        end += 1
    return text[pos:end]


def _patterns(text: str, start: int, end: int) -> list[str]:
    """The word on the left, the two words on the left, the word on the right, and the
    words on both sides; lower case, digits as 0. A word longer than WORD is in none."""
    near, at = _before(text, start)
    far = _before(text, at)[0] if len(near) <= WORD else ""
    near, far, right = (re.sub(r"[0-9]", "0", w.lower()) if len(w) <= WORD else "" for w in (near, far, _after(text, end)))
    out = []
    if near:
        out.append(f"L {near}")
    if near and far:
        out.append(f"L2 {far} {near}")
    if right:
        out.append(f"R {right}")
    if near and right:
        out.append(f"LR {near} _ {right}")
    return out


def _instance(text: str) -> str:
    return text if len(text) <= 128 else hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def mentions(text: str, base: list[tuple[int, str, int]]) -> list[tuple[int, int, str, str | None, list[str]]]:
    """(start, end, instance, kind or None, patterns): the base spans, and the other
    blank-separated tokens with a digit or @, less the punctuation at their ends."""
    out = [(s, e, _instance(text[s:e]), k, _patterns(text, s, e)) for s, k, e in base]
    pos, i, n = 0, 0, len(text)
    while (m := TOKEN.search(text, pos)) is not None:
        left = m.start()
        while left > pos and not text[left - 1].isspace():
            left -= 1
        right = m.end()
        while right < n and not text[right].isspace():
            right += 1
        pos = right
        start, end = left, right
        while start < end and not text[start].isalnum():
            start += 1
        while end > start and not text[end - 1].isalnum():
            end -= 1
        while i < len(base) and base[i][2] <= start:
            i += 1
        if end > start and not any(s < end and e > start for s, _, e in base[i:i + 4]) and TOKEN.search(text, start, end):
            out.append((start, end, _instance(text[start:end]), None, _patterns(text, start, end)))
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_md5, base, mentions) of every whole text; null texts are empty."""
    span = pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32())])
    hit = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("instance", pa.string()), ("kind", pa.string()), ("patterns", pa.list_(pa.string()))])

    def run(batches):
        for batch, texts in slices(batches, "text"):
            base = [base_spans(t) for t in texts]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("text_md5"),
                pa.array([[dict(zip(("start", "kind", "end"), s, strict=True)) for s in b] for b in base], pa.list_(span)),
                pa.array([[dict(zip(("start", "end", "instance", "kind", "patterns"), m, strict=True)) for m in mentions(t, b)] if TOKEN.search(t) else []
                          for t, b in zip(texts, base, strict=True)], pa.list_(hit))], names=["doc_id", "text_md5", "base", "mentions"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.withColumn("text_md5", F.md5("text")).mapInArrow(run, """doc_id long, text_md5 string,
        base array<struct<start:int,kind:string,end:int>>,
        mentions array<struct<start:int,end:int,instance:string,kind:string,patterns:array<string>>>""")


def bootstrap(scanned: DataFrame, support: int = SUPPORT, confidence: float = CONFIDENCE, score: float = SCORE) -> tuple[DataFrame, DataFrame]:
    """Scores the graph of patterns and instances until nothing changes; returns the
    accepted patterns (pattern, kind, confidence) and instances (instance, kind, score).

    An edge counts once however often it occurs, so copies of a text don't lend
    weight. A pattern's confidence for a kind is the sum of its instances' scores
    over one more than their number; an instance that isn't a seed scores
    1 - product(1 - confidence) over its accepted patterns. Both are aggregates with
    partial sums, so a pattern that a third of all instances share is no hot group.
    Confidences and scores are whole percent and summed as integers: they never fall
    from one turn to the next, so the turns end, at the same values in every run. Patterns
    of fewer than ``support`` instances can't be accepted and are left out at once."""
    m = scanned.select(F.explode("mentions").alias("m")).select("m.instance", "m.kind", F.explode("m.patterns").alias("pattern"))
    every = stage(m.groupBy("pattern", "instance").agg(F.min("kind").alias("seed")), "pii-edges")
    sizes = every.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= support)
    seeds = stage(every.where("seed is not null").select("instance", F.col("seed").alias("kind")).distinct(), "pii-seeds")
    edges = every.join(sizes, "pattern").select("pattern", "instance", "n")
    held = edges.join(seeds, "instance").groupBy("pattern", "n", "kind").agg((100 * F.count(F.lit(1))).alias("weight"), F.count(F.lit(1)).alias("support"))
    seeded = stage(held, "pii-seeded")  # what the seeds give each pattern, the same in every turn
    edges = stage(edges.join(seeds.select("instance").distinct(), "instance", "left_anti"), "pii-open")

    def accepted(more: DataFrame | None) -> DataFrame:
        every = seeded if more is None else seeded.unionByName(more)
        return (every.groupBy("pattern", "kind").agg(F.sum("weight").alias("weight"), F.sum("support").alias("support"), F.first("n").alias("n"))
                .withColumn("percent", F.expr("weight div (n + 1)"))
                .where((F.col("support") >= support) & (F.col("percent") >= round(100 * confidence))).select("pattern", "kind", "percent"))

    more, before = None, (0, 0)
    while True:
        patterns = stage(accepted(more), "pii-patterns")
        odds = F.sum(F.round(-F.log(1 - F.col("percent") / 100) * 1e6).cast("long"))
        known = stage(edges.join(patterns, "pattern").groupBy("instance", "kind").agg(odds.alias("odds"))
                      .select("instance", "kind", F.round(100 * (1 - F.exp(F.col("odds") / -1e6))).cast("long").alias("percent")), "pii-known")
        now = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("percent"), F.lit(0))).first()
        if tuple(now) == before:  # no row and no score is ever lost, so equal sums are equal tables
            break
        before = tuple(now)
        more = edges.join(known, "instance").groupBy("pattern", "n", "kind").agg(
            F.sum("percent").alias("weight"), F.count(F.when(F.col("percent") >= round(100 * score), 1)).alias("support"))
    best = known.groupBy("instance").agg(F.min(F.struct((-F.col("percent")).alias("down"), F.col("kind"))).alias("b"))
    found = best.where(F.col("b.down") <= -round(100 * score)).select("instance", "b.kind", (F.col("b.down") / -100).alias("score"))
    return patterns.select("pattern", "kind", (F.col("percent") / 100).alias("confidence")), found


def found_spans(scanned: DataFrame, patterns: DataFrame, found: DataFrame) -> DataFrame:
    """(doc_id, text_md5, extra): spans of found instances that stand in an accepted
    pattern of their kind; a row for each distinct document that has any."""
    m = scanned.select("doc_id", "text_md5", F.explode("mentions").alias("m")).where("m.kind is null").select(
        "doc_id", "text_md5", "m.start", "m.end", "m.instance", F.explode("m.patterns").alias("pattern"))
    hits = m.join(patterns.select("pattern", "kind"), "pattern").join(found.select("instance", "kind"), ["instance", "kind"])
    return hits.groupBy("doc_id", "text_md5").agg(F.sort_array(F.collect_set(F.struct(
        F.col("start"), F.concat(F.lit("context_"), F.col("kind")).alias("kind"), F.col("end")))).alias("extra"))


def extract(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base, extra), a row per row of ``docs``: base and found spans, each
    array<struct<start, kind, end>> by start, then kind as listed. An empty table
    gives no rows; equal rows give equal results."""
    scanned = stage(scan(docs, id_col, text_col), "pii-scan")
    extra = found_spans(scanned, *bootstrap(scanned))
    s = scanned.select("doc_id", "text_md5", "base")
    on = s["doc_id"].eqNullSafe(extra["doc_id"]) & (s["text_md5"] == extra["text_md5"])
    none = F.array().cast("array<struct<start:int,kind:string,end:int>>")
    return s.join(extra, on, "left").select(s["doc_id"], "base", F.coalesce("extra", none).alias("extra"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every span of base and found kinds in ``text_col`` replaced by
    [KIND]; where spans overlap, one mark stands for their union, named after the
    first. Other columns, whatever their names, rows without spans and null texts stay as
    they are; an empty table stays empty."""
    doc, md5, cuts = fresh(docs, "__doc", "__md5", "__spans")
    scanned = stage(scan(docs, id_col, text_col), "pii-scan")
    extra = found_spans(scanned, *bootstrap(scanned))
    spans = (scanned.where(F.size("base") > 0).select("doc_id", "text_md5", "base").distinct()
             .join(extra.withColumnRenamed("doc_id", "__d").withColumnRenamed("text_md5", "__m"),
                   F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("text_md5") == F.col("__m")), "full")
             .select(F.coalesce("doc_id", "__d").alias(doc), F.coalesce("text_md5", "__m").alias(md5),
                     F.sort_array(F.concat(*[F.coalesce(F.col(c), F.array().cast("array<struct<start:int,kind:string,end:int>>")) for c in ("base", "extra")])).alias(cuts)))

    @F.pandas_udf("string")
    def cut(text: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([_cut(t, s) for t, s in zip(text, spans, strict=True)], dtype=object)

    on = docs[id_col].eqNullSafe(spans[doc]) & (F.md5(F.coalesce(docs[text_col].cast("string"), F.lit(""))) == spans[md5])
    new = cut(docs[text_col].cast("string"), F.col(cuts))
    return docs.join(spans, on, "left").select(*[new.alias(c) if c == text_col else docs[c] for c in docs.columns])


def _cut(text, spans):
    if text is None or spans is None:
        return text
    out, last = [], 0
    for s in spans:
        if s["start"] >= last:
            out += [text[last:s["start"]], f"[{s['kind'].removeprefix('context_').upper()}]"]
        last = max(last, s["end"])
    return "".join(out) + text[last:]
