"""Each operator against a brute-force version, on the small tables and on rows made of
the hard cases: nulls, empty and long texts, ties, repeated rows, no rows, extra columns."""

import binascii
import collections
import hashlib
import io
import math
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tableprep.llm import chat, mixing, packing, pii, quality, queries, simjoin, syncmers, tokens, topk, toxicity
from tableprep.llm.common import Encoder, components, with_rank

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, score double, component_id string"


def made(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(i, t, "en", s, 0, 7, 0.5, "x") for i, t, s in rows], schema)


WORDS = [f"w{i}" for i in range(400)]
HARD = [(5, None, "b"), (1, "", "b"), (2, " \n\t ", None), (3, " ".join(WORDS), "a"), (4, " ".join(WORDS), "a"),
        (4, " ".join(WORDS), "a"), (None, "one two", "a"), (9, "One  two", None), (7, "x" * 50_000, "c"), (8, "y z " * 30_000, "c"),
        (10, "mail me a.b@c.example.com, 10.0.0.256 or 1.2.3.4.5.6.7.8 <|endoftext|> 日本語 ok", "b")]


@pytest.fixture(scope="module")
def hard(spark):
    return made(spark, HARD).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return made(spark, [])


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


def texts(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


def size_of(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


# --- general helpers ----------------------------------------------------------------

def test_with_rank_numbers_each_group_without_gaps(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") < 2500, "hot").when(F.col("id") < 2990, "mid").alias("k"))
    got = collections.defaultdict(list)
    for r in with_rank(df, ["k"], [F.col("id")], F.col("id"), "r", 16).collect():
        got[r["k"]].append(r["r"])
    assert all(sorted(v) == list(range(len(v))) for v in got.values()) and len(got) == 3


def test_components(spark):
    pairs = [(i, i + 1) for i in range(0, 30)] + [(100, 50), (50, 70), (200, 201), (5, 5)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(31), 0), 50: 50, 70: 50, 100: 50, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- 1 mixing -----------------------------------------------------------------------

def water(totals, weights=(5, 2, 1), share=1.5, cap=2.0):
    names = sorted(totals, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, target = share * sum(totals.values()), set(names), {}
    while open_:
        level = left / sum(w[s] for s in open_)
        full = {s for s in open_ if w[s] * level > cap * totals[s]}
        if not full:
            return target | {s: w[s] * level for s in open_}
        for s in full:
            target[s] = cap * totals[s]
            left -= target[s]
        open_ -= full
    return target


@pytest.mark.parametrize("which", ["docs", "hard"])
def test_mixing_meets_its_targets(which, request):
    df = request.getfixturevalue(which)
    out = mixing.mix(df).collect()
    want = collections.Counter()
    for r in df.select("source", "text").collect():
        want[r["source"]] += size_of(r["text"])
    targets = water(want)
    assert len(out) == df.count()
    taken, longest = collections.Counter(), collections.Counter()
    for r in out:
        assert r["source_size"] == want[r["source"]]
        assert r["target"] == pytest.approx(targets[r["source"]], rel=1e-9)
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] += r["taken"]
        longest[r["source"]] = max(longest[r["source"]], r["size"])
    for s, t in targets.items():
        assert abs(taken[s] - t) <= longest[s] + 1
    key = lambda rows: sorted(map(str, rows))
    assert key(out) == key(mixing.mix(df.repartition(5)).collect())


def test_mixing_tilts_exponentially_to_the_entropy_optimum(docs):
    rows = [r for r in mixing.mix(docs).collect() if r["size"] and r["target"] < 1.999 * r["source_size"]]
    by = collections.defaultdict(list)
    for r in rows:
        by[r["source"]].append(r)
    for part in by.values():
        slopes = [math.log(r["rate"]) / r["size"] for r in part if r["rate"] < 2]
        assert max(slopes) - min(slopes) < 1e-9
        assert sum(r["rate"] * r["size"] for r in part) == pytest.approx(part[0]["target"], rel=1e-6, abs=1e-3)


def test_mixed_repeats_rows_and_keeps_columns(spark, hard, empty):
    out = mixing.mixed(hard)
    assert out.columns == hard.columns
    assert out.count() == sum(r["copies"] for r in mixing.mix(hard).collect())
    assert mixing.mix(empty).count() == 0 and mixing.mixed(empty).count() == 0


# --- 2 exact top-k ------------------------------------------------------------------

def brute_top(rows, ask, k):
    out = set()
    for q, v in ask:
        best = sorted(((-sum(a * b for a, b in zip(v, u, strict=True)), i) for i, u in rows if i != q and len(u) == len(v)))[:k]
        out |= {(q, n, i, -s) for n, (s, i) in enumerate(best, 1)}
    return out


def test_top_k_matches_brute_force(spark):
    v = topk.integer_vectors(spark.read.parquet(f"{SF}/embeddings.parquet"))
    rows = [(r["vec_id"], r["v"]) for r in v.collect()]
    got = {tuple(r) for r in topk.top_k(v, v.where("vec_id % 50 = 0"), 5, block_rows=64, query_rows=4).collect()}
    assert got == brute_top(rows, [r for r in rows if r[0] % 50 == 0], 5)


def test_top_k_hard_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.5], 1) for i in range(20)] + [(50, [nan, 1.0], 1), (51, None, 1), (52, [inf, 0.0], 1), (53, [None, 1.0], 1), (54, [-1.0, 0.1], 1),
                                                      (100, [0.0, 0.0], 1), (None, [1.0, 1.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    v = topk.integer_vectors(df)
    fine = [(r["vec_id"], r["v"]) for r in v.collect()]
    assert len(fine) == 22
    got = {tuple(r) for r in topk.top_k(v, v.where("vec_id % 50 = 0"), 5, block_rows=6).collect()}
    assert got == brute_top(fine, [r for r in fine if r[0] % 50 == 0], 5)
    assert topk.top_k(v.limit(0), v.limit(0), 5).count() == 0


def test_threshold_stops_early_where_lists_decide():
    v = np.zeros((1000, 2), np.int64)
    v[:, 0] = np.arange(1000)
    lists = topk.SortedLists(np.arange(1000), v)
    scores, ids, scored = lists.search(np.array([3, 0]), 5, None)
    assert ids.tolist() == [999, 998, 997, 996, 995] and scored < 100


# --- 3 preferences ------------------------------------------------------------------

def test_preferences(spark):
    t = [(1, 0, "user", "hi <|user|>"), (1, 1, "assistant", "yes"), (1, 2, "user", "more"), (1, 3, "assistant", "é日"),
         (2, 0, "user", "hi <|user|>"), (2, 1, "assistant", "no"), (3, 0, "user", "hi <|user|>"), (4, 0, "user", "hi <|user|>"), (None, 0, "user", "x"),
         (5, 0, None, None), (5, 0, None, None)]
    convs = chat.conversations(spark.createDataFrame(t, "conv_id long, turn long, role string, text string"))
    pairs = spark.createDataFrame([(1, 2), (1, 3), (3, 1), (3, 4), (5, 1), (1, 99)], "chosen_id long, rejected_id long")
    got = {(r["chosen_id"], r["rejected_id"]): r for r in chat.format_preferences(convs, pairs).collect()}
    assert set(got) == {(1, 2), (1, 3), (3, 1), (3, 4), (5, 1)}
    r = got[1, 2]
    assert r["prompt"] == "<|user|>\nhi <\\|user|><|end|>\n" and r["prefix_turns"] == 1 and r["status"] == "ok"
    assert [r["chosen"][s["start"]:s["end"]] for s in r["chosen_mask"]] == ["yes<|end|>\n", "é日<|end|>\n"]
    assert [r["rejected"][s["start"]:s["end"]] for s in r["rejected_mask"]] == ["no<|end|>\n"]
    assert (got[1, 3]["status"], got[3, 1]["status"], got[3, 4]["status"]) == ("rejected_empty", "chosen_empty", "identical")
    assert got[3, 4]["chosen"] == "" and got[3, 4]["chosen_mask"] == [] and got[5, 1]["prefix_turns"] == 0
    assert chat.format_preferences(convs.limit(0), pairs).count() == 0


def test_preference_query_pairs_every_conversation(spark):
    rows = queries.op3_format_preferences(spark, SF).collect()
    convs = spark.read.parquet(f"{SF}/conversations.parquet")
    assert len(rows) == convs.select("conv_id").distinct().count()
    turns = collections.Counter(r["conv_id"] for r in convs.collect())
    assert all(r["prefix_turns"] == turns[r["chosen_id"]] - 1 for r in rows if r["status"] == "ok")


# --- 4 token files ------------------------------------------------------------------

@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_cached_encoder_equals_the_library(docs, name):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path(name))
    odd = ["", "a  b", " a\n\n b \t c", "x <|endoftext|> y", "it's  I'll", "tail ", "\x1c a\x1d!", "é Å", "　 x\u0085y", "日本 語 1234 ok!!  "]
    some = odd + [t for _, t in texts(docs)] + [t or "" for _, t, _ in HARD]
    ids, ends = Encoder(public_tokenizers.path(name)).encode(some)
    for i, e in enumerate(tok.encode_batch(some, add_special_tokens=False)):
        assert e.ids == ids[ends[i]:ends[i + 1]].tolist(), some[i][:80]


@pytest.mark.parametrize("which", ["docs", "hard", "empty"])
def test_token_files_round_trip(spark, which, request, tmp_path):
    from tokenizers import Tokenizer
    df = request.getfixturevalue(which)
    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    out = str(tmp_path / "tok")
    tokens.write_token_files(df, path, out, 2, frame_ids=500)
    got = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["start"], r["n_tokens"], bytes(r["ids"])) for r in tokens.read_tokens(spark, out).collect()))
    start, want = 0, []
    for doc, t in sorted(texts(df), key=lambda x: (x[0] is not None, x[0] or 0, x[1])):
        ids = np.array([*tok.encode(t, add_special_tokens=False).ids, 2], "<u4")
        want.append((doc is not None, doc or 0, start, len(ids), ids.tobytes()))
        start += len(ids)
    assert got == want


def test_reader_opens_only_the_frames_it_needs_and_sees_damage(spark, docs, tmp_path):
    import zstandard
    out = io.BytesIO()
    w = tokens.FrameWriter(out, 100)
    rng = np.random.default_rng(1)
    own = [rng.integers(0, 50_000, n).astype(np.uint32) for n in (30, 0, 90, 450, 10, 20)]
    for i, ids in enumerate(own):
        w.add(None if i == 1 else i, ids)
    assert w.close() == 600
    r = tokens.FrameReader(io.BytesIO(out.getvalue()))
    assert r.ids(2) == own[2].tobytes() and r.frames_read == 1
    assert [r.ids(i) for i in range(6)] == [x.tobytes() for x in own]
    stream = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(out.getvalue()), read_across_frames=True)
    assert stream.read().startswith(b"".join(x.tobytes() for x in own))
    bad = bytearray(out.getvalue())
    bad[int(r.place[1]) + 12] ^= 255
    with pytest.raises(Exception):
        tokens.FrameReader(io.BytesIO(bytes(bad))).ids(2)
    folder = str(tmp_path / "some")
    tokens.write_token_files(docs, public_tokenizers.path("word_bpe_49k.json"), folder, 2)
    assert sorted(x["doc_id"] for x in tokens.read_tokens(spark, folder, [3, 150]).collect()) == [3, 150]


# --- 5 personal data ----------------------------------------------------------------

def plain_spans(t):
    def luhn(d):
        s = 0
        for i, c in enumerate(reversed(d)):
            v = int(c) * (1 + i % 2)
            s += v // 10 + v % 10
        return s % 10 == 0
    out = []
    digits = lambda x: re.sub("[^0-9]", "", x)
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        if 12 <= len(digits(m[0])) <= 19 and luhn(digits(m[0])):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= len(digits(m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return [(s, pii.KINDS[k], e) for s, k, e in sorted(out)]


def test_base_spans_equal_the_patterns(docs):
    import random
    rnd = random.Random(3)
    odd = ["a@b.c_x@d.e", "a@b@c.d", "@x.y", "a.b@c", "1.2.3.4.5.6.7.8", "1.2.3.4.5.6.7", "0001.002.3.4", "4111 1111-1111 1111", "+1 (22) 333-4444-", "x@y.z@w.q.r", "a@b..c@d.e"]
    odd += ["".join(rnd.choice("a1.@+- (") for _ in range(60)) for _ in range(2000)]
    for t in odd + [t for _, t in texts(docs)] + [t or "" for _, t, _ in HARD]:
        assert pii.base_spans(t) == plain_spans(t), t[:100]


def test_context_finds_unseen_identifiers_and_leaves_others(spark):
    known = [f"then write to box user{i}@mail.example.com for help" for i in range(8)]
    rows = [(i, t, "a") for i, t in enumerate(known)] + [(50, "please write to box user-77#mail for help now", "a"), (51, "the year 2024 was in room 12b here", "a")]
    rows += [(100 + i, f"it was in room {i}c here", "a") for i in range(9)]
    got = {r["doc_id"]: r for r in pii.extract(made(spark, rows)).collect()}
    assert [(s["kind"], s["start"], s["end"]) for s in got[50]["extra"]] == [("context_email", 20, 32)]
    assert all(not r["extra"] for k, r in got.items() if k != 50)
    cut = {r["doc_id"]: r["text"] for r in pii.redact(made(spark, rows)).collect()}
    assert cut[50] == "please write to box [EMAIL] for help now" and cut[0] == "then write to box [EMAIL] for help" and cut[51] == rows[9][1]


def test_one_cue_word_with_varying_neighbours_is_enough(spark):
    rows = [(i, f"w{'abcdefgh'[i]}x phone: +1 555 010 77{i}{i} {'stuvwxyz'[i]}end", "a") for i in range(8)]
    rows += [(20, "new one phone: 555-0199 tomorrow", "a"), (21, "room 555-0199 tomorrow", "a")]
    got = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["extra"]] for r in pii.extract(made(spark, rows)).collect()}
    assert got.pop(20) == [("context_phone", 15, 23)] and not any(got.values())


def brute_bootstrap(rows, support=3, confidence=60, score=80):
    """The same fixed point over Python sets."""
    edges, seeds = {}, {}
    for t in rows:
        for _, _, inst, kind, pats in pii.mentions(t, pii.base_spans(t)):
            for p in pats:
                edges.setdefault(p, set()).add(inst)
                if kind:
                    seeds.setdefault(inst, set()).add(kind)
    known = {}
    while True:
        got = {}
        for p, insts in edges.items():
            for kind in pii.KINDS:
                s = [100 if kind in seeds.get(i, ()) else known.get((i, kind), 0) for i in insts]
                if sum(x >= score for x in s) >= support and (c := sum(s) // (len(insts) + 1)) >= confidence:
                    got[p, kind] = c
        odds = {}
        for (p, kind), c in got.items():
            for i in edges[p] - set(seeds):
                odds[i, kind] = odds.get((i, kind), 0) + round(-math.log(1 - c / 100) * 1e6)
        new = {k: round(100 * (1 - math.exp(o / -1e6))) for k, o in odds.items()}
        if new == known:
            return {k: c / 100 for k, c in got.items()}, known
        known = new


def test_bootstrap_reaches_the_fixed_point(spark):
    # each family's cue is learnt from instances that the family before it gave
    rows = [f"z{i} cue m{i}@mail.example.com" for i in range(300)]
    sizes = [30, 10, 4]
    for f, n in enumerate(sizes):
        cue = ["cue", "cuea", "cueb"]
        rows += [f"z{i} {cue[f]} id{f}x{i}" for i in range(n)] + [f"z{i} {c} id{f}x{i}" for c in cue[f + 1:f + 2] for i in range(n)]
    rows += ["nothing 12 here", "", "seen 2024 twice 2024"]
    patterns, found = pii.bootstrap(pii.scan(made(spark, [(i, t, "a") for i, t in enumerate(rows)])))
    want, known = brute_bootstrap(rows)
    assert {(r["pattern"], r["kind"]): r["confidence"] for r in patterns.collect()} == pytest.approx(want) and want
    best = {}
    for (i, kind), s in known.items():
        if s >= 80:
            best[i] = min(best.get(i, (0, "")), (-s, kind))
    assert {r["instance"]: (r["kind"], r["score"]) for r in found.collect()} == {i: (k, -s / 100) for i, (s, k) in best.items()} and best


def test_context_words_are_found_whole():
    t = "cue" + " " * 500 + "id7" + " " * 500 + "next"
    assert pii._patterns(t, 503, 506) == ["L cue", "R next", "LR cue _ next"]
    assert pii._patterns("far " + "x" * 41 + " id7 " + "y" * 41, 46, 49) == []
    assert pii._patterns("x" * 41 + " near id7", 47, 50) == ["L near"]


def test_redaction_keeps_rows_and_columns(spark, hard, empty):
    out = pii.redact(hard)
    assert out.columns == hard.columns and out.count() == len(HARD)
    got = sorted(out.select("doc_id", "text").collect(), key=str)
    assert [r for r in got if r["doc_id"] == 5][0]["text"] is None
    assert "a.b@c" not in [r for r in got if r["doc_id"] == 10][0]["text"]
    assert pii.redact(empty).count() == 0 and pii.extract(empty).count() == 0


def test_personal_data_query(spark, docs):
    rows = {r["doc_id"]: r for r in queries.op5_personal_data(spark, SF).collect()}
    for doc, t in texts(docs):
        base = plain_spans(t)
        text = ",".join(f"{k}:{s}:{e}" for s, k, e in base)
        r = rows[doc]
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(b[1] == k for b in base) for k in pii.KINDS]
        assert set(filter(None, text.split(","))) <= set(r["spans"].split(","))


# --- 6 quality ----------------------------------------------------------------------

def auc(scores, labels):
    order = np.argsort(scores, kind="stable")
    ranks = np.empty(len(scores))
    ranks[order] = np.arange(1, len(scores) + 1)
    n1 = labels.sum()
    return (ranks[labels == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(labels) - n1))


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r["doc_id"]: r for r in queries.op6_quality(spark, sf).collect()}
    assert all(r["held_out"] == (binascii.crc32(str(k).encode()) % 3 == 1) for k, r in rows.items())
    lab = [r for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if rows[r["doc_id"]]["held_out"]]
    y = np.array([r["quality"] for r in lab])
    assert auc(np.array([rows[r["doc_id"]]["score"] for r in lab]), y) > 0.95
    assert all(r["predicted"] == (r["score"] >= 0.5) for r in rows.values())


def test_quality_ignores_held_out_labels(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    flipped = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.fit(docs, labels), quality.fit(docs, flipped)
    assert np.array_equal(a.weights, b.weights) and a.bias == b.bias


def test_quality_hard_cases(spark, hard, empty):
    labels = spark.createDataFrame([(3, 1), (4, 1), (None, 1), (5, None), (1, 0)], "doc_id long, quality int")
    out = quality.score(hard, quality.fit(hard, labels)).collect()
    assert len(out) == len(HARD) and all(0 <= r["score"] <= 1 for r in out)
    assert quality.score(empty, quality.fit(empty, labels.limit(0))).count() == 0


# --- 7 syncmers ---------------------------------------------------------------------

def test_syncmers_edit_and_next(spark, docs):
    rows = {r["doc_id"]: r for r in queries.op7_syncmers(spark, SF).collect()}
    order = sorted(texts(docs))
    for (doc, t), (_, nxt) in zip(order, [*order[1:], order[0]], strict=True):
        cut = len(t) // 4
        r = rows[doc]
        assert r["n_chars"] == len(t)
        assert r["edited_sha256"] == hashlib.sha256((t[:len(t) - cut] + nxt[:cut]).encode()).hexdigest()
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    long = [r for r in rows.values() if r["n_anchors"] == 64]
    assert np.mean([r["near_edited"] for r in long]) > 0.4 and np.median([r["near_next"] for r in long]) < 0.1


def test_syncmers_are_chosen_by_the_k_mer_alone(spark):
    a, b = " ".join(WORDS[:60]), " ".join(WORDS[:60])
    rows = spark.createDataFrame([(a,), ("q r s " + b,)], "text string")
    x, y = [{r["h"]: r["p"] for r in v["a"]} for v in rows.select(syncmers.anchors(F.col("text"), m=1000).alias("a")).collect()]
    assert set(x) <= set(y) and {y[h] - p for h, p in x.items()} == {3} and 10 < len(x) < 50


def test_syncmers_hard_cases(spark, hard, empty):
    rows = syncmers.fingerprints(hard, partitions=3).collect()
    assert len(rows) == len(HARD) and syncmers.fingerprints(empty).count() == 0
    by = collections.defaultdict(set)
    order = sorted(texts(hard), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    want = collections.Counter()
    for (doc, t), (_, nxt) in zip(order, [*order[1:], order[0]], strict=True):
        want[doc, hashlib.sha256((t[:len(t) - len(t) // 4] + nxt[:len(t) // 4]).encode()).hexdigest()] += 1
    assert collections.Counter((r["doc_id"], r["edited_sha256"]) for r in rows) == want
    for r in rows:
        by[r["doc_id"]].add(r["fingerprint"])
    assert by[3] == by[4] and by[1] == {""} and len(by[9].pop().split(",")) == 1
    one = syncmers.fingerprints(made(spark, [(1, "a b c d", "x")])).collect()[0]
    assert one["near_next"] == 1.0 and one["edited_sha256"] == hashlib.sha256(b"a b c a").hexdigest()


def test_syncmers_keep_every_anchor_of_long_texts(spark):
    far = [f"{c}{i}" for c in "ab" for i in range(3000)]
    shared = [f"s{i}" for i in range(60)]
    one, two = far[:2000] + shared + far[2000:3000], far[3000:4000] + shared + far[4000:]
    cols = spark.createDataFrame([(" ".join(one), " ".join(two))], "x string, y string").select(
        syncmers.anchors(F.col("x")).alias("a"), syncmers.anchors(F.col("y")).alias("b"))
    r = cols.select("a", "b", syncmers.likeness(F.col("a"), F.col("b")).alias("like"), syncmers.shift(F.col("a"), F.col("b")).alias("move")).first()
    a, b = ({v["h"]: v["p"] for v in r[c]} for c in "ab")
    moves = collections.Counter(b[h] - p for h, p in a.items() if h in b)
    assert len(a) > 1000 and 10 < len(a.keys() & b.keys()) and r["like"] == len(a.keys() & b.keys()) / len(a.keys() | b.keys())
    assert r["move"] == -1000 == min(moves, key=lambda d: (-moves[d], d))
    n = {v["doc_id"]: v for v in syncmers.fingerprints(made(spark, [(1, " ".join(one), "x"), (2, " ".join(two), "x")])).collect()}
    assert n[1]["n_anchors"] == len(a) == len(n[1]["fingerprint"].split(","))


# --- 8 toxicity ---------------------------------------------------------------------

def test_toxicity(spark):
    sf = "/root/testdata/sf0.1"
    lab = spark.read.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    train, test = lab.where(~quality.held_out()), lab.where(quality.held_out())
    chain = toxicity.fit(docs, train)
    got = {r["doc_id"]: r["toxic"] for r in toxicity.score(docs, chain).collect()}
    hits = collections.Counter((r["toxic"], got[r["doc_id"]]) for r in test.collect())
    assert hits[1, 1] >= 0.75 * (hits[1, 1] + hits[1, 0]) and hits[0, 1] <= 0.01 * (hits[0, 0] + hits[0, 1])
    assert chain.categories[-1] == "toxic" and len(chain.weights[-1]) == len(chain.words) + len(chain.categories) - 1
    kept = toxicity.keep_clean(docs, chain)
    assert kept.columns == docs.columns and kept.count() == sum(1 - v for v in got.values())


def test_chain_passes_probabilities_on():
    rng = np.random.default_rng(0)
    x = (rng.random((600, 4)) < 0.3).astype(float)
    a = x[:, 0].astype(int)
    y = np.maximum(a, x[:, 1].astype(int))
    chain = toxicity.fit_chain(x, np.stack([a, y], 1), np.ones(600), np.arange(600) % 3, list("abcd"), ["a", "toxic"])
    p = chain.probabilities(x)
    assert ((p[:, 1] > 0.5) == y).mean() > 0.98 and len(chain.weights[1]) == 5


def test_toxicity_hard_cases(spark, hard, empty):
    labels = spark.createDataFrame([(3, 0), (4, 1), (None, 1), (5, None), (99, 1)], "doc_id long, toxic int")
    assert toxicity.score(hard, toxicity.fit(hard, labels)).count() == len(HARD)
    none = toxicity.fit(empty, labels.limit(0))
    assert toxicity.score(empty, none).count() == 0 and toxicity.keep_clean(hard, none).count() == len(HARD)


def test_every_language_with_a_toxic_row_is_a_category(spark):
    sf = "/root/testdata/sf0.01"
    docs, lab = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    chain = toxicity.fit(docs, lab)
    langs = [r["lang"] for r in docs.join(lab.where("toxic = 1"), "doc_id", "left_semi").select("lang").distinct().orderBy("lang").collect()]
    assert len(langs) > 1 and chain.categories == [*[f"toxic_{v}" for v in langs], "toxic"]
    assert [len(w) for w in chain.weights] == [len(chain.words) + j for j in range(len(chain.categories))]


def test_toxic_rows_are_taken_from_every_language(spark):
    rows = [(i, ("bad" if i % 2 else "good") + f" w{i % 7}", "xx" if i in (1, 3) else "en") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    chain = toxicity.fit(docs, docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as toxic"), toxic_rows=20)
    assert chain.categories == ["toxic_en", "toxic_xx", "toxic"] and chain.biases[1] != chain.biases[0]
    p = dict(zip(chain.categories, toxicity.score_texts(chain, ["bad w1"])[0], strict=True))
    assert p["toxic"] > 0.5 and p["toxic_xx"] > 1e-3


# --- 9 packing ----------------------------------------------------------------------

def test_column_generation_reaches_the_optimum():
    # 44 sheets' worth: the linear program's bound is met by the best patterns
    demand = {45: 97, 36: 610, 31: 395, 14: 211}
    patterns = packing.plan(demand, 100)
    got = collections.Counter()
    for p, n in patterns:
        assert sum(s * c for s, c in p.items()) <= 100 and n > 0
        for s, c in p.items():
            got[s] += c * n
    assert got == demand and sum(n for _, n in patterns) <= 454
    sizes = np.array(sorted(demand))
    assert sum(t for _, t in packing.solve(sizes, np.array([float(demand[s]) for s in sizes]), 100)) == pytest.approx(452.25)


@pytest.mark.parametrize("which", ["docs", "hard", "empty"])
def test_packing(which, request):
    from tokenizers import Tokenizer
    df = request.getfixturevalue(which)
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    rows = packing.pack_documents(df, path, 1).collect()
    want = collections.Counter()
    total = 0
    for doc, t in texts(df):
        ids = np.array([*tok.encode(t, add_special_tokens=False).ids, 1], "<u4")
        total += len(ids)
        for s in range(0, len(ids), 2048):
            want[doc, s, len(ids), ids[s:s + 2048].tobytes()] += 1
    assert collections.Counter((r["doc_id"], r["start"], r["doc_tokens"], bytes(r["ids"])) for r in rows) == want
    by = collections.defaultdict(list)
    for r in rows:
        assert len(r["ids"]) == 4 * r["length"]
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 2048
    if which == "docs":
        assert len(by) <= 1.03 * total / 2048 + 2


def test_short_documents_are_packed_by_their_true_lengths(spark):
    rows = [(i, None if i % 3 else " a" * (i % 20), "s") for i in range(9000)] + [(20_000 + i, " a" * (2039 + i % 8), "s") for i in range(16)]
    out = packing.pack_documents(made(spark, rows), public_tokenizers.path("byte_bpe_50k.json"), 1)
    ids, sequences = out.agg(F.sum("length"), F.countDistinct("sequence_id")).first()
    assert sequences <= math.ceil(ids / 2048) + 1


# --- 10 n-gram join -----------------------------------------------------------------

def brute_groups(rows, n=4, num=85, den=100):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and den * len(a & b) >= num * len(a | b):
                root[find(i)] = find(j)
    least = collections.defaultdict(lambda: None)
    for i, (d, _) in enumerate(rows):
        r = find(i)
        if d is not None:
            least[r] = d if least[r] is None else min(least[r], d)
    return collections.Counter((d, len(sets[i]), least[find(i)] if sets[i] else d) for i, (d, _) in enumerate(rows))


@pytest.mark.parametrize("which", ["docs", "hard", "empty"])
def test_join_matches_brute_force(which, request):
    df = request.getfixturevalue(which)
    got = collections.Counter(tuple(r) for r in simjoin.similar_groups(df).collect())
    assert got == brute_groups(texts(df))


@pytest.mark.parametrize(("n", "num"), [(4, 85), (5, 80), (2, 60)])
def test_join_of_families_and_shared_passages(spark, n, num):
    """Chains of near copies (some far from their hub), a passage that all share, and short texts."""
    import random
    rnd = random.Random(7)
    passage = " ".join(f"p{i}" for i in range(30))
    rows, k = [], 0
    for f in range(6):
        words = [f"f{f}v{rnd.randrange(60)}" for _ in range(rnd.choice([6, 40, 120]))]
        for _ in range(14):
            words = list(words)
            for _ in range(rnd.choice([0, 1, 2, 3])):
                words[rnd.randrange(len(words))] = f"z{rnd.randrange(10_000)}"
            if rnd.random() < 0.3:
                words.insert(rnd.randrange(len(words)), f"y{rnd.randrange(99)}")
            rows.append((1000 - k, " ".join(words) + (" " + passage if rnd.random() < 0.5 else ""), "a"))
            k += 1
    rows += [(2000 + i, t, "a") for i, t in enumerate(["a b", "A  b", "a b c", "a", "a", ""])]
    df = made(spark, rows)
    got = collections.Counter(tuple(r) for r in simjoin.similar_groups(df, n=n, num=num).collect())
    assert got == brute_groups([(i, t) for i, t, _ in rows], n, num)


def test_keep_one(spark, hard):
    kept = simjoin.keep_one(hard)
    assert kept.columns == hard.columns
    # the row without an id has the words of row 9, so it goes
    assert sorted((r["doc_id"] or -1) for r in kept.collect()) == [1, 2, 3, 5, 7, 8, 9, 10]


# --- pipeline -----------------------------------------------------------------------

def test_pipeline_stages(spark, docs):
    import corpus_pipeline as p
    assert [n for n, _ in p.STAGES] == ["toxicity", "ngram_jaccard_join", "pii", "mixing", "packing"]
    at = docs
    for name, stage in p.STAGES:
        out = stage(spark, at, SF).cache()
        if name == "ngram_jaccard_join":
            groups = brute_groups(texts(at), 5, 80)
            assert sorted(r["doc_id"] for r in out.select("doc_id").collect()) == sorted({c for _, _, c in groups})
        if name == "pii":
            assert out.count() == at.count() and not any(plain_spans(t) for _, t in texts(out))
        if name != "packing":
            assert out.dtypes == docs.dtypes
            at = out
    pieces = out.groupBy("doc_id", "start").count()
    assert {r["doc_id"] for r in pieces.collect()} == {r["doc_id"] for r in at.select("doc_id").collect()}
