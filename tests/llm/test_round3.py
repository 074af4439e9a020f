"""Licence scan, alignment of two tokenizers and ranked search against brute force, on
the small tables and on rows made of the hard cases."""

import collections
import hashlib
import math
import random
import re

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tableprep.llm import align, lexical, licenses, queries

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, bundle long, block long, item long, score double, term string, places string, slice long"
A, B = (public_tokenizers.path(x) for x in (queries.BYTE_BPE, queries.PIECE_BPE))


def made(spark, rows):
    return spark.createDataFrame([(i, t, "en", 1, 2, 3, 0.5, "x", "y", 4) for i, t in rows], SCHEMA)


NOTICE = "x Licensed under the Apache License, Version 2.0. Under-the MIT license;CC BY-NC 4.0 under the MIT License under the mit license"
HARD = [(5, None), (1, ""), (2, " \n\t "), (3, "one two THREE three"), (4, "one two THREE three"), (4, "one two THREE three"),
        (None, "One  two É é"), (9, "One  two"), (7, "x" * 50_000), (8, "y z\n\n " * 20_000), (10, NOTICE),
        (11, "<|endoftext|> 日本語\r\n\ttab </s> ▁"), (12, "a\nb \n c  \n\n  d  "), (13, "tail \x00\x1c\x85 　 😀 é\r"),
        (14, "// SPDX-License-Identifier: (MIT OR GPL-2.0-only WITH Classpath-exception-2.0) AND CC-BY-NC-4.0 */ rest")]


@pytest.fixture(scope="module")
def hard(spark):
    return made(spark, HARD).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return made(spark, [])


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


# --- 11 licences --------------------------------------------------------------------

def brute_places(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))
    found = []
    for phrase, label in {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}.items():
        p = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i:i + len(p)] == p]
    return len(words), found


@pytest.mark.parametrize("which", ["hard", "docs", "empty"])
def test_licence_places_match_brute_force(which, request):
    df = request.getfixturevalue(which)
    want = []
    for i, t in rows_of(df):
        n, found = brute_places(t)
        at = [a for a, _ in found]
        want.append((i, n, len(found), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found}))))
    got = licenses.digest(licenses.scan(df)).collect()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)[:6]) for r in got)
    for r in got:
        assert 0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert r["labels"].split(",") == sorted(set(r["labels"].split(",")))
        assert (r["score"] > 0) == (r["labels"] != "") == (r["permitted"] is not None)


@pytest.mark.parametrize("text, want, ok", [
    ("MIT", "MIT", True), ("mit or gpl-3.0", "(mit OR gpl-3.0)", True), ("MIT AND GPL-3.0+", "(MIT AND GPL-3.0+)", False),
    ("MIT OR GPL-2.0 AND GPL-3.0", "(MIT OR (GPL-2.0 AND GPL-3.0))", True), ("(MIT OR GPL-2.0) AND GPL-3.0 */", "((MIT OR GPL-2.0) AND GPL-3.0)", False),
    ("GPL-2.0 WITH Classpath-exception-2.0 AND ISC", "((GPL-2.0 WITH Classpath-exception-2.0) AND ISC)", True),
    ("GPL-2.0 with Other-exception", "(GPL-2.0 WITH Other-exception)", False), ("MIT OR ISC and", "(MIT OR ISC)", True),
    ("((MIT))", "MIT", True), ("MIT\nOR ISC", "MIT", True), ("MIT.", "MIT", True), ("MIT) AND x", "MIT", True),
    ("(MIT OR ISC", None, None), ("", None, None), ("OR MIT", None, None), ("(MIT) WITH x", None, None), ("MIT WITH (x)", None, None)])
def test_expressions(text, want, ok):
    got = licenses.parse(text)
    assert (got and licenses.infix(got[0])) == want
    if got:
        assert licenses.evaluate(got[0], licenses.Policy())[0] is ok


def test_expressions_agree_with_python():
    """Random expressions against Python's own and/or, which bind the same way."""
    draw = random.Random(7)
    allowed = licenses.Policy(allowed=frozenset({"t"}))

    def some(depth):
        if not depth or draw.random() < 0.3:
            return draw.choice(["t", "f"])
        text = f"{some(depth - 1)} {draw.choice(['and', 'or'])} {some(depth - 1)}"
        return f"({text})" if draw.random() < 0.5 else text

    for _ in range(300):
        text = some(5)
        postfix, end = licenses.parse(text)
        assert end == len(text) and licenses.evaluate(postfix, allowed)[0] == eval(text, {"t": True, "f": False})


def test_tags_and_notices_add_labels(spark):
    got = {r["doc_id"]: r for r in licenses.digest(licenses.scan(made(spark, [*HARD, (20, "GNU General Public License, version 3"), (21, "spdx license identifier MIT"), (22, "SPDX-License-Identifier: ISC AND\nSPDX-License-Identifier: Zlib")]))).collect()}
    assert got[14]["labels"] == "cc-by-nc,gpl-2,mit" and got[14]["base_labels"] == "cc-by-nc"
    assert got[14]["expressions"] == "((MIT OR (GPL-2.0-only WITH Classpath-exception-2.0)) AND CC-BY-NC-4.0)" and got[14]["permitted"] is False
    assert got[20]["labels"] == "gpl,gpl-3" and got[20]["n_base"] == 0 and got[20]["permitted"] is False
    assert got[21]["labels"] == "" and got[22]["expressions"] == "ISC; Zlib" and got[22]["permitted"] is True
    assert got[10]["labels"] == "apache-2,cc-by-nc,mit" and got[10]["n_base"] == 5


# --- 12 alignment -------------------------------------------------------------------

def brute_alignment(rows):
    pair = align.Pair(A, B)
    docs, count = [], collections.Counter()
    for i, text in rows:
        a, b = (pair.a.encode(" " + text, add_special_tokens=False).ids, pair.b.encode(text)) if text else ([], [])
        raw = (" " + (text or "")).encode()
        if not text or b"".join(pair.bytes_a[x] for x in a) != raw or b"".join(pair.bytes_b[x] for x in b) != raw:
            docs.append((i, 0, 0, [], ""))
            continue
        ends = []
        for ids, size in ((a, pair.bytes_a), (b, pair.bytes_b)):
            at, own = 0, {}
            for k, x in enumerate(ids):
                own[at := at + len(size[x])] = k
            ends.append(own)
        links, groups, p, q = [], [], 0, 0
        for e in sorted(ends[0].keys() & ends[1].keys()):
            ka, kb = ends[0][e], ends[1][e]
            links.append((a[ka], b[kb]))
            groups.append(",".join(map(str, a[p:ka + 1])) + "|" + ",".join(map(str, b[q:kb + 1])))
            p, q = ka + 1, kb + 1
        count.update(links)
        docs.append((i, len(a), len(b), links, ";".join(groups)))
    best = collections.Counter()
    for (_, y), n in count.items():
        best[y] = max(best[y], n)
    return [(i, na, nb, len(ls), len(ls), sum(count[x] == best[x[1]] for x in ls), sum(count[x] for x in ls),
             hashlib.sha256(g.encode()).hexdigest() if g else "") for i, na, nb, ls, g in docs]


@pytest.mark.parametrize("which", ["hard", "docs", "empty"])
def test_alignment_matches_brute_force(which, request):
    df = request.getfixturevalue(which)
    got = align.align(df, A, B)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(repr, brute_alignment(rows_of(df)))) == sorted(repr(tuple(r)) for r in got.collect())


def test_chunks_align_like_whole_texts(spark):
    """Random texts of blanks, line ends, marks and letters, by the caches and whole."""
    draw = random.Random(3)
    signs = [" ", "  ", "\n", "\r", "\r\n", "\t", "\x0b", "\x1c", "\x85", " ", " ", "　", ".", ");", "'s", "▁", "<0x41>", "</s>", "12", "the", "Wort", "É", "é", "日本", "😀", "<|endoftext|>"]
    rows = [(k, "".join(draw.choices(signs, k=draw.randint(1, 12)))) for k in range(1500)]
    got = {r["doc_id"]: tuple(r) for r in align.align(made(spark, rows).repartition(5), A, B).collect()}
    assert [got[k] for k in range(1500)] == brute_alignment(rows)


def test_identity_map_and_emptied_cache(docs):
    pair = align.Pair(A, B)
    for a, b in enumerate(pair.identity):
        assert b < 0 or pair.bytes_a[a] == pair.bytes_b[b]
    rest = {x for i, x in enumerate(pair.bytes_b) if not pair.b.is_control(i)}
    assert sum(pair.bytes_a[a] in rest for a in range(pair.n_a)) - (pair.identity >= 0).sum() <= 1  # the special token
    texts = [t for _, t in rows_of(docs)][:40]
    whole = pair.align(texts)
    pair.CACHE = 50  # emptied before each call
    for k in range(0, 40, 8):
        links, counts, written = pair.align(texts[k:k + 8])
        assert all((x == y).all() for x, y in zip(links, whole[0][k:k + 8], strict=True)) and written == whole[2][k:k + 8] and (counts == whole[1][k:k + 8]).all()


# --- 13 search ----------------------------------------------------------------------

def brute_search(docs, items, k=20):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(t or ""))
    bags = [(i, collections.Counter(split(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n_docs, n_words = len(bags), sum(b.total() for _, b in bags)
    df = collections.Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for i, b in bags:
            m = 100 - 25 + (25 * b.total() * n_docs) // n_words
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * b[t]) // (1000 * b[t] + 12 * m)) for t in split(text) if t in b)
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, r, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scores)[:k], 1)]
    return out


ITEMS = [(1, "one three three X"), (1, "one three three X"), (2, None), (3, ""), (4, "nothing-here"), (None, "TWO é É 日本語"), (6, "y z one"), (7, "mit LICENSE the under 2 0")]


def items_of(spark, rows=ITEMS):
    return spark.createDataFrame([(i, t, 1, 1, b"x") for i, t in rows], "item_id long, text string, doc_id long, bundle long, term binary")


@pytest.mark.parametrize("k", [1, 3, 20])
def test_search_hard_cases(spark, hard, empty, k):
    got = sorted(map(repr, map(tuple, lexical.search(hard, items_of(spark), k).collect())))
    assert got == sorted(map(repr, brute_search(HARD, ITEMS, k)))
    assert lexical.search(empty, items_of(spark)).count() == 0 and lexical.search(hard, items_of(spark, [])).count() == 0
    assert lexical.search(hard, items_of(spark, [(1, None)])).columns == ["item_id", "rank", "doc_id", "score"]


def test_search_matches_brute_force(spark, docs):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = queries.op13_ranked_search(spark, SF).collect()
    assert sorted(map(tuple, got)) == sorted(brute_search(rows_of(docs), items))


def test_small_blocks_bundles_and_bands_change_nothing(spark, docs, monkeypatch):
    """Many blocks and bundles, and every other order of owners, prune differently."""
    items = spark.read.parquet(f"{SF}/benchmark.parquet").limit(9)
    whole = sorted(map(tuple, lexical.search(docs, items, 5).collect()))
    monkeypatch.setattr(lexical, "BUNDLE", 2)
    monkeypatch.setattr(lexical, "BANDS", (50, 10, 3))
    rows = docs.repartition(9).sortWithinPartitions(F.rand(1))
    assert sorted(map(tuple, lexical.search(rows, items, 5).collect())) == whole


def test_pruning_keeps_all_that_can_still_win(spark):
    """One block; every document has the frequent term, few the rare ones, with ties."""
    draw = random.Random(5)
    rows = [(i, " ".join(["all"] * draw.randint(1, 4) + draw.choices(["pad", "mid", "more"], k=draw.randint(0, 5)) + ["rare"] * (i % 97 == 0))) for i in range(1500)]
    items = [(1, "rare all mid"), (2, "all all all"), (3, "mid more all rare")]
    got = lexical.search(made(spark, rows).coalesce(1), items_of(spark, items), 20).collect()
    assert sorted(map(tuple, got)) == sorted(brute_search(rows, items))
