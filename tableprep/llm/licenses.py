"""Licence scan (operator 11): an Aho-Corasick automaton over a text's words finds
identifier tags and notice phrases; the expression after a tag is read by a
shunting-yard parser and evaluated against a policy.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableprep.llm.common import slices

# --- fixed values -------------------------------------------------------------------
#: Phrases whose places are always reported, and their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Further notice phrases: (label, weight). Whole notices weigh more than names.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy": ("mit", 0.9),
    "redistribution and use in source and binary forms": ("bsd", 0.9),
    "this is free and unencumbered software released into the public domain": ("unlicense", 0.9),
    "permission to use copy modify and or distribute this software": ("isc", 0.9),
    "gnu general public license": ("gpl", 0.6),
    "gnu general public license version 2": ("gpl-2", 0.8),
    "gnu general public license version 3": ("gpl-3", 0.8),
    "gnu lesser general public license": ("lgpl", 0.8),
    "gnu affero general public license": ("agpl-3", 0.8),
    "mozilla public license": ("mpl-2", 0.7),
    "eclipse public license": ("epl", 0.7),
    "boost software license": ("bsl-1", 0.7),
    "bsd 2 clause": ("bsd-2", 0.7),
    "bsd 3 clause": ("bsd-3", 0.7),
    "cc by sa": ("cc-by-sa", 0.7),
    "cc by nd": ("cc-by-nd", 0.7),
    "cc by nc sa": ("cc-by-nc-sa", 0.7),
    "cc by nc nd": ("cc-by-nc-nd", 0.7),
    "cc by 4 0": ("cc-by", 0.7),
    "cc0 1 0": ("cc0", 0.7),
    "all rights reserved": ("proprietary", 0.4),
}

#: A tag before an expression, as words.
TAG = "spdx license identifier"
BASE_WEIGHT, TAG_WEIGHT = 0.8, 1.0

#: Labels of identifiers in expressions whose lower-case form isn't the label already.
IDENTIFIERS = {
    "apache-2.0": "apache-2", "agpl-3.0": "agpl-3", "agpl-3.0-only": "agpl-3", "agpl-3.0-or-later": "agpl-3",
    "bsd-2-clause": "bsd-2", "bsd-3-clause": "bsd-3", "bsl-1.0": "bsl-1", "cc-by-4.0": "cc-by", "cc-by-nc-4.0": "cc-by-nc",
    "cc-by-sa-4.0": "cc-by-sa", "cc0-1.0": "cc0", "epl-2.0": "epl", "gpl-2.0": "gpl-2", "gpl-2.0-only": "gpl-2",
    "gpl-2.0-or-later": "gpl-2", "gpl-3.0": "gpl-3", "gpl-3.0-only": "gpl-3", "gpl-3.0-or-later": "gpl-3", "mpl-2.0": "mpl-2",
}
# --- end of fixed values ------------------------------------------------------------


@dataclass(frozen=True)
class Policy:
    """Labels that may be used, and exceptions that make a licence usable by WITH."""
    allowed: frozenset = frozenset({"mit", "apache-2", "bsd", "bsd-2", "bsd-3", "isc", "unlicense", "cc0", "cc-by", "bsl-1", "0bsd", "zlib"})
    exceptions: frozenset = field(default_factory=lambda: frozenset({"classpath-exception-2.0", "gcc-exception-3.1"}))


_TOKEN = re.compile(r"[ \t]*([()]|[A-Za-z0-9.+:-]+)")
_PRECEDENCE = {"or": 1, "and": 2, "with": 3}


def label_of(identifier: str) -> str:
    name = identifier.lower().rstrip("+")
    return IDENTIFIERS.get(name, name)


def parse(text: str, at: int = 0) -> tuple[list[tuple[str, str]], int] | None:
    """The expression at ``at`` as (kind, value) in postfix order and where it ends;
    kinds are "id" and "op". Reads as many tokens as continue the expression on one
    line; WITH binds before AND before OR, whatever their case; a binary operator
    without a right side ends the expression before it. None for no expression, one
    with an open bracket, or a WITH that doesn't stand between two identifiers."""
    out: list[tuple[str, str]] = []
    held: list[tuple[str, int, int]] = []  # operator, its end, tokens of out so far
    need, depth, end = True, 0, at
    while m := _TOKEN.match(text, at):
        word, at = m[1], m.end()
        low = word.lower()
        if need:
            if word == "(":
                if held and held[-1][0] == "with":
                    return None
                held.append(("(", end, len(out)))
                depth += 1
            elif word == ")" or low in _PRECEDENCE:
                break
            else:
                out.append(("id", word.rstrip(".:")))
                need, end = False, at
        elif word == ")" and depth:
            while held[-1][0] != "(":
                out.append(("op", held.pop()[0]))
            held.pop()
            depth, end = depth - 1, at
        elif low in _PRECEDENCE:
            if low == "with" and (out[-1][0] != "id" or text[:end].endswith(")")):
                return None
            while held and held[-1][0] != "(" and _PRECEDENCE[held[-1][0]] >= _PRECEDENCE[low]:
                out.append(("op", held.pop()[0]))
            held.append((low, at, len(out)))
            need = True
        else:
            break
    if need and held and held[-1][0] != "(" and out:  # "MIT or" before other text
        held.pop()
    if not out or depth:
        return None
    while held:
        out.append(("op", held.pop()[0]))
    return out, end


def evaluate(postfix: list[tuple[str, str]], policy: Policy) -> tuple[bool, set[str]]:
    """Whether the policy permits the expression, and the labels in it."""
    stack, labels = [], set()
    for kind, value in postfix:
        if kind == "id":
            stack.append((label_of(value) in policy.allowed, value))
            continue
        (b, right), (a, left) = stack.pop(), stack.pop()
        if value == "with":
            labels.add(label_of(left))
            stack.append((a or right.lower() in policy.exceptions, ""))
        else:
            labels.update(label_of(x) for x in (left, right) if x)
            stack.append((a and b if value == "and" else a or b, ""))
    ok, last = stack.pop()
    if last:
        labels.add(label_of(last))
    return ok, labels


def infix(postfix: list[tuple[str, str]]) -> str:
    """The expression with all brackets written out."""
    stack = []
    for kind, value in postfix:
        if kind == "id":
            stack.append(value)
        else:
            b, a = stack.pop(), stack.pop()
            stack.append(f"({a} {value.upper()} {b})")
    return stack.pop()


_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_PLAIN = np.full(256, 0x20, np.uint8)
_PLAIN[_WORD] = np.flatnonzero(_WORD)
_PLAIN[65:91] += 32


class Scanner:
    """The automaton, and what it finds in one text."""

    def __init__(self, base: dict[str, str], notices: dict[str, tuple[str, float]], policy: Policy):
        import ahocorasick
        self.policy, self.machine = policy, ahocorasick.Automaton()
        told: dict[str, list] = {}
        for phrase, label in base.items():
            told.setdefault(phrase, []).append(("base", label, BASE_WEIGHT))
        for phrase, (label, weight) in notices.items():
            told.setdefault(phrase, []).append(("notice", label, weight))
        told.setdefault(TAG, []).append(("tag", "", TAG_WEIGHT))
        for phrase, what in told.items():
            self.machine.add_word(f" {phrase} ", (len(phrase) + 2, what))
        self.machine.make_automaton()

    def scan(self, text: str):
        """(n_words, [(word, kind, label, weight)], [(word, expression, permitted)])."""
        data = text.encode("utf-8", "surrogatepass")
        raw = np.frombuffer(data, np.uint8)
        word = _WORD[raw]
        after = np.concatenate([[False], word[:-1]]) if len(word) else word
        n_words = int(np.count_nonzero(word & ~after))
        kept = word | after
        norm = b" " + _PLAIN[raw[kept]].tobytes() + (b" " if len(word) and word[-1] else b"")
        places, expressions, spaces, back = [], [], None, None
        # one character a byte, so places are byte places; phrases are ASCII
        for end, (length, what) in self.machine.iter(norm.decode("latin-1")):
            if spaces is None:
                spaces = np.flatnonzero(np.frombuffer(norm, np.uint8) == 0x20)
            at = int(np.searchsorted(spaces, end - length + 1))
            for kind, label, weight in what:
                if kind != "tag":
                    places.append((at, kind, label, weight))
                    continue
                back = np.flatnonzero(kept) if back is None else back
                start = int(back[end - 2]) + 1  # behind the tag's last letter
                line = data[start:start + 1 + next((i for i, c in enumerate(data[start:]) if c in b"\r\n"), len(data))].decode("utf-8", "replace")
                if (m := re.match(r"[ \t]*:[ \t\"']*", line)) and (got := parse(line, m.end())):
                    ok, labels = evaluate(got[0], self.policy)
                    expressions.append((at, infix(got[0]), ok))
                    places.extend((at, "tag", x, weight) for x in sorted(labels))
        return n_words, places, expressions


OUT = ("doc_id long, n_words long, places array<struct<word:long,kind:string,label:string,weight:double>>, "
       "expressions array<struct<word:long,expression:string,permitted:boolean>>, permitted boolean, score double")


def scan(docs: DataFrame, policy: Policy = Policy(), base: dict[str, str] = BASE, notices: dict[str, tuple[str, float]] = NOTICES,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per row of ``docs``: n_words; places (starting word, from 0, kind base, notice
    or tag, label, weight), overlapping ones included, in order; expressions behind
    tags with their brackets; permitted: whether ``policy`` permits every label of a
    base or notice phrase and every expression (null where nothing was found); score:
    one minus the product of one minus the weight over the distinct kinds and labels.

    Words are runs of digits, letters and all characters beyond ASCII, A-Z as a-z.
    Null texts count as empty: no words, no places, score 0. Null and repeated ids are
    rows of their own; an empty table gives no rows; other columns don't matter."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        scanner = Scanner(base, notices, policy)
        for batch, texts in slices(batches, "text"):
            n_words, places, expressions, permitted, scores = [], [], [], [], []
            for text in texts:
                n, found, said = scanner.scan(text)
                found = sorted(set(found))
                told = [*(label in policy.allowed for _, kind, label, _ in found if kind != "tag"), *(ok for *_, ok in said)]
                left = 1.0
                for _, _, weight in sorted({x[1:] for x in found}):
                    left *= 1 - weight
                n_words.append(n)
                places.append([dict(zip(("word", "kind", "label", "weight"), x, strict=True)) for x in found])
                expressions.append([dict(zip(("word", "expression", "permitted"), x, strict=True)) for x in said])
                permitted.append(all(told) if told else None)
                scores.append(1 - left)
            place = pa.struct([("word", pa.int64()), ("kind", pa.string()), ("label", pa.string()), ("weight", pa.float64())])
            said = pa.struct([("word", pa.int64()), ("expression", pa.string()), ("permitted", pa.bool_())])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(places, pa.list_(place)), pa.array(expressions, pa.list_(said)),
                 pa.array(permitted, pa.bool_()), pa.array(scores, pa.float64())],
                names=["doc_id", "n_words", "places", "expressions", "permitted", "score"])

    return rows.mapInArrow(run, OUT)


def digest(found: DataFrame) -> DataFrame:
    """scan()'s rows as plain columns: places of base phrases counted, labels joined."""
    base = F.filter("places", lambda p: p["kind"] == "base")
    names = lambda x: F.array_join(F.array_sort(F.array_distinct(F.transform(x, lambda p: p["label"]))), ",")
    words = F.transform(base, lambda p: p["word"])
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(words).alias("first_word"), F.array_max(words).alias("last_word"),
        names(base).alias("base_labels"), names(F.col("places")).alias("labels"), "score",
        F.size("expressions").cast("long").alias("n_expressions"),
        F.array_join(F.transform("expressions", lambda e: e["expression"]), "; ").alias("expressions"), "permitted")
