"""License scan: Aho-Corasick over words for notice phrases and identifier tags, and a
shunting-yard evaluator of and/or/with license expressions.

Texts are cut into words once; the automaton runs over the words joined by single
spaces, so a phrase matches where its words stand consecutively, at all places. Tags
(``SPDX-License-Identifier:``) are found in the same way on the lower-cased text, and
the expression that follows is evaluated.
"""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.llm.common import binary_texts, map_arrow, tune

# Base phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Further notice phrases and their labels.
NOTICES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "bsd 3 clause": "bsd",
    "bsd 2 clause": "bsd",
    "isc license": "isc",
    "creative commons attribution": "cc-by",
    "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc0": "cc0",
    "public domain": "public-domain",
    "all rights reserved": "proprietary",
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
}
# How freely text under a label may be used, 0 to 1.
FREEDOM = {
    "public-domain": 1.0, "cc0": 1.0, "unlicense": 1.0, "mit": 0.95, "isc": 0.95, "bsd": 0.95, "apache": 0.9,
    "cc-by": 0.85, "mpl": 0.6, "epl": 0.6, "lgpl": 0.55, "cc-by-sa": 0.5, "gpl": 0.4, "agpl": 0.3,
    "cc-by-nd": 0.2, "cc-by-nc": 0.2, "proprietary": 0.0,
}
UNKNOWN = 0.3           # a license that is named but not listed
EXCEPTION = 0.15        # what a "with" exception adds
TAG = b"spdx-license-identifier:"
_IDENTIFIER = re.compile(rb"[a-z0-9][a-z0-9.+-]*|[()]|[^\s]")
_SEPARATE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
                  for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Runs of a-z, 0-9 and bytes from 0x80, with A-Z lower-cased."""
    return text.translate(_SEPARATE).split()


def label_of(identifier: str) -> str:
    """Label of a license identifier: versions and suffixes are left out."""
    name = identifier.lower().rstrip("+")
    name = re.sub(r"-(only|or-later)$", "", name)
    for known in sorted(FREEDOM, key=len, reverse=True):
        if name == known or name.startswith(known + "-") or (known == "cc0" and name.startswith("cc0")):
            return known
    return {"0bsd": "bsd", "x11": "mit"}.get(name, re.sub(r"-v?\d[\d.]*$", "", name))


class ExpressionError(ValueError):
    pass


def parse_expression(tokens: list[str]) -> list[str]:
    """Postfix form of an infix license expression (shunting-yard).

    ``with`` binds tighter than ``and``, and ``and`` tighter than ``or``.
    """
    rank = {"or": 1, "and": 2, "with": 3}
    out, ops, operand = [], [], False       # operand: the last token ended one
    for t in tokens:
        if t in rank:
            if not operand:
                raise ExpressionError(t)
            while ops and ops[-1] != "(" and rank[ops[-1]] >= rank[t]:
                out.append(ops.pop())
            ops.append(t)
            operand = False
        elif t == "(":
            if operand:
                raise ExpressionError(t)
            ops.append(t)
        elif t == ")":
            if not operand:
                raise ExpressionError(t)
            while ops and ops[-1] != "(":
                out.append(ops.pop())
            if not ops:
                raise ExpressionError(t)
            ops.pop()
        else:
            if operand:
                raise ExpressionError(t)
            out.append(t)
            operand = True
    if not operand or "(" in ops:
        raise ExpressionError("end")
    return out + ops[::-1]


def evaluate(postfix: list[str]) -> tuple[float, set[str]]:
    """(freedom, labels): ``and`` binds to the stricter side, ``or`` leaves the freer choice,
    ``with`` adds an exception to its license."""
    stack, labels = [], set()
    for t in postfix:
        if t in ("and", "or", "with"):
            (b, lb), (a, la) = stack.pop(), stack.pop()
            if t == "with":         # the exception's name is no license
                stack.append((min(1.0, a + EXCEPTION), la))
            else:
                labels.update(x for x in (la, lb) if x)
                stack.append(((min if t == "and" else max)(a, b), None))
        else:
            label = label_of(t)
            stack.append((FREEDOM.get(label, UNKNOWN), label))
    freedom, last = stack[0]
    return freedom, labels | ({last} if last else set())


def longest_expression(line: bytes) -> tuple[float, set[str]] | None:
    """The expression at the start of a line: the longest prefix that parses, in linear time.

    The tokens taken are well formed so far, so a prefix parses where all brackets are
    closed and its last token ends an operand."""
    tokens, rank = [], {"and", "or", "with"}
    depth = whole = 0
    for m in _IDENTIFIER.finditer(line):
        t = m[0].decode("utf-8", "replace")
        ends = bool(tokens) and (tokens[-1] == ")" or tokens[-1] not in rank | {"("})
        if t == "(":
            depth += 1
            if ends:
                break
        elif t == ")":
            depth -= 1
            if not ends or depth < 0:
                break
        elif t in rank:
            if not ends:
                break
        elif ends or not re.fullmatch(r"[a-z0-9][a-z0-9.+-]*", t):
            break
        tokens.append(t.rstrip(".") if t not in rank else t)
        if depth == 0 and t not in rank:
            whole = len(tokens)
    return evaluate(parse_expression(tokens[:whole])) if whole else None


class Scanner:
    """The automaton of all phrases, over latin-1 text of space-joined words."""

    def __init__(self):
        self.phrases = ahocorasick.Automaton()
        for phrase, label in {**NOTICES, **BASE}.items():
            self.phrases.add_word(f" {phrase} ", (phrase, label, phrase in BASE))
        self.phrases.make_automaton()
        self.tags = ahocorasick.Automaton()
        self.tags.add_word(TAG.decode(), len(TAG))
        self.tags.make_automaton()

    def scan(self, text: bytes) -> tuple:
        """n_words, n_base, first_word, last_word, base_labels, labels, score of a text."""
        words = words_of(text)
        joined = " " + b" ".join(words).decode("latin-1") + " "
        base, found, places, scores = set(), set(), [], []
        for end, (phrase, label, is_base) in self.phrases.iter(joined):
            found.add(label)
            scores.append(FREEDOM[label])
            if is_base:
                base.add(label)
                # words before the match are as many as spaces before it
                places.append((end - len(phrase) - 1, phrase))
        starts, seen, to = [], 0, 0         # spaces are counted once, from place to place
        for at, _ in sorted(places):
            seen, to = seen + joined.count(" ", to, at), at
            starts.append(seen)
        low = text.lower().decode("latin-1")
        for end, _ in self.tags.iter(low):
            stop = low.find("\n", end + 1)
            value = longest_expression(low[end + 1:stop if stop >= 0 else len(low)].encode("latin-1"))
            if value is not None:
                scores.append(value[0])
                found |= value[1]
        return (len(words), len(starts), min(starts, default=None), max(starts, default=None),
                ",".join(sorted(base)), ",".join(sorted(found)), min(scores, default=0.0))


_COLUMNS = [("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
            ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())]


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, n_words, base places and labels, all labels, score.

    score is the freedom of the strictest license that the text names (0 where it names
    none, and for reserved rights). Null texts count as empty: no words, no labels.
    Repeated rows are reported each; an empty table gives no rows.
    """
    tune(docs.sparkSession)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        scanner = _scanner()
        rows = list(zip(*(scanner.scan(t) for t in binary_texts(batch.column("text")))))
        return pa.record_batch([batch.column("doc_id")] + [pa.array(c, t) for c, (_, t) in zip(rows, _COLUMNS)],
                               ["doc_id"] + [n for n, _ in _COLUMNS])
    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")),
                     run, "doc_id long, n_words long, n_base long, first_word long, last_word long, "
                          "base_labels string, labels string, score double")


_made: list[Scanner] = []


def _scanner() -> Scanner:
    """One automaton per Python worker."""
    if not _made:
        _made.append(Scanner())
    return _made[0]
