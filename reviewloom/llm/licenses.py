"""License scans: Aho-Corasick for identifier tags and notice phrases, shunting-yard for license expressions.

One automaton runs over the normalised words of a text and finds all phrases, overlapping
ones too; another runs over the raw text and finds the tags that an expression follows.
Expressions are read to the end of their line, put in postfix order and evaluated on a
stack: ``or`` leaves the choice of the lighter side, ``and`` binds to the heavier one,
``with`` an exception lightens the license before it.  A row is scanned where it lies;
there is no shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.llm.text import fresh, in_small_batches, others

# The phrases every scan looks for, with their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Further notice phrases with their labels.
NOTICES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "boost software license": "bsl",
    "isc license": "isc",
    "bsd license": "bsd",
    "2 clause bsd": "bsd",
    "3 clause bsd": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "permission to use copy modify and or distribute this software": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "all rights reserved": "reserved",
}
# What stands before an expression (lower case).
TAGS = ("spdx-license-identifier:", "license-expression:")
# How heavily a family of licenses binds (0 permissive, 1 its own files, 2 the whole work, 3 further still).
BURDENS = {
    "0bsd": 0, "apache": 0, "bsd": 0, "bsl": 0, "cc-by": 0, "cc0": 0, "isc": 0, "mit": 0, "unlicense": 0, "zlib": 0,
    "cddl": 1, "epl": 1, "lgpl": 1, "mpl": 1,
    "cc-by-sa": 2, "eupl": 2, "gpl": 2,
    "agpl": 3, "cc-by-nc": 3, "cc-by-nc-nd": 3, "cc-by-nc-sa": 3, "cc-by-nd": 3, "reserved": 3,
}
UNKNOWN_BURDEN = 3
PRECEDENCE = {"or": 1, "and": 2, "with": 3}
BASE_WEIGHT, NOTICE_WEIGHT, TAG_WEIGHT = 0.6, 0.7, 0.95  # how much one label found in this way adds to the score

_TOKEN = re.compile(r"[ \t]*(?:([A-Za-z0-9][A-Za-z0-9.+:_-]*)|([()]))")
_VERSION = re.compile(r"(?:-v?\d.*|\+)$")
# Lower-case letters and digits stay, other ASCII characters part words, bytes of other characters stay.
_NORMAL = bytes(b if b >= 128 or chr(b).islower() or chr(b).isdigit() else ord(chr(b).lower()) if chr(b).isupper() else 32
                for b in range(256))
MADE = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "expressions", "score")


class Expression(NamedTuple):
    text: str
    postfix: str
    valid: bool
    burden: int | None
    labels: tuple[str, ...]


def family(identifier: str) -> str:
    """Identifier without version: ``GPL-2.0-or-later`` is ``gpl``."""
    return _VERSION.sub("", identifier.lower())


def to_postfix(tokens: list[str]) -> list[str] | None:
    """Operands and operators in postfix order; None for what is no expression."""
    out, waiting, after_operand = [], [], False
    for token in tokens:
        word = token.lower()
        if word in PRECEDENCE:
            if not after_operand:
                return None
            # What binds at least as tightly comes first: operators group to the left.
            while waiting and waiting[-1] != "(" and PRECEDENCE[waiting[-1]] >= PRECEDENCE[word]:
                out.append(waiting.pop())
            waiting.append(word)
            after_operand = False
        elif token == ")":
            if not after_operand:
                return None
            while waiting and waiting[-1] != "(":
                out.append(waiting.pop())
            if not waiting:
                return None
            waiting.pop()
        else:
            if after_operand:
                return None
            if token == "(":
                waiting.append(token)
            else:
                out.append(token)
                after_operand = True
    if not after_operand or "(" in waiting:
        return None
    return out + waiting[::-1]


def evaluate(postfix: list[str]) -> int | None:
    """How heavily the expression binds; None where ``with`` does not join a license and an exception."""
    stack: list[tuple[int, bool, str | None]] = []  # burden, whether it is one license, the exception's name
    for token in postfix:
        if token not in PRECEDENCE:
            exception = "exception" in token.lower()
            stack.append((BURDENS.get(family(token), UNKNOWN_BURDEN), not exception, token if exception else None))
            continue
        right, left = stack.pop(), stack.pop()
        if token == "with":
            if not left[1] or right[2] is None:
                return None
            stack.append((min(left[0], 1), False, None))
        elif left[2] is not None or right[2] is not None:
            return None
        else:
            stack.append(((min if token == "or" else max)(left[0], right[0]), False, None))
    return None if stack[0][2] is not None else stack[0][0]


def read_expression(line: str) -> Expression:
    """The expression at the start of ``line``: up to the first character that belongs to none."""
    tokens, at = [], 0
    while found := _TOKEN.match(line, at):
        tokens.append((found[1] or found[2]).rstrip(".:") or ".")
        at = found.end()
    text = line[:at].strip()
    postfix = to_postfix(tokens)
    burden = None if postfix is None else evaluate(postfix)
    if burden is None:
        return Expression(text, "", False, None, ())
    known = sorted({family(t) for t in postfix if t not in PRECEDENCE} & BURDENS.keys())
    return Expression(text, " ".join(postfix), True, burden, tuple(known))


class Found(NamedTuple):
    n_words: int
    starts: list[int]
    base_labels: list[str]
    labels: list[str]
    expressions: list[Expression]
    score: float


class Scanner:
    """Automata over normalised words and over raw text; texts are UTF-8 bytes, read as one character each."""

    def __init__(self) -> None:
        self.phrases = ahocorasick.Automaton()
        for phrase, label in {**NOTICES, **BASE_PHRASES}.items():
            self.phrases.add_word(f" {phrase} ", (label, len(phrase) + 2, phrase in BASE_PHRASES))
        self.phrases.make_automaton()
        self.tags = ahocorasick.Automaton()
        for tag in TAGS:
            self.tags.add_word(tag, tag)
        self.tags.make_automaton()

    def scan(self, text: bytes | None) -> Found:
        raw = text or b""
        words = raw.translate(_NORMAL).split(b" ")
        words = [w for w in words if w]
        joined = b" %s " % b" ".join(words)
        base, others_, begins = set(), set(), []
        for end, (label, length, is_base) in self.phrases.iter(joined.decode("latin-1")):
            if is_base:
                base.add(label)
                begins.append(end - length + 1)
            else:
                others_.add(label)
        starts = []
        if begins:
            blanks = np.flatnonzero(np.frombuffer(joined, dtype=np.uint8) == 32)
            starts = np.searchsorted(blanks, np.array(begins)).tolist()
        expressions = []
        for end, _ in self.tags.iter(raw.lower().decode("latin-1")):
            stop = raw.find(b"\n", end)
            line = raw[end + 1:stop if stop >= 0 else len(raw)]
            expressions.append(read_expression(line.decode("utf-8", "replace")))
        tagged = {label for e in expressions for label in e.labels}
        doubt = (1 - BASE_WEIGHT) ** len(base) * (1 - NOTICE_WEIGHT) ** len(others_) * (1 - TAG_WEIGHT) ** len(tagged)
        return Found(len(words), starts, sorted(base), sorted(base | others_ | tagged), expressions, 1 - doubt)


@lru_cache(maxsize=1)
def scanner() -> Scanner:
    return Scanner()


_EXPRESSION = T.StructType([T.StructField("text", T.StringType()), T.StructField("postfix", T.StringType()), T.StructField("valid", T.BooleanType()),
                            T.StructField("burden", T.IntegerType()), T.StructField("labels", T.ArrayType(T.StringType()))])
_ARROW_EXPRESSION = pa.struct([("text", pa.string()), ("postfix", pa.string()), ("valid", pa.bool_()), ("burden", pa.int32()),
                               ("labels", pa.list_(pa.string()))])


def scan_licenses(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with what license phrases and tags its texts hold.

    ``n_words``: normalised words; ``n_base``: places of base phrases, overlapping ones
    each, ``first_word`` and ``last_word`` their smallest and largest start (words from 0,
    null without any); ``base_labels`` and ``labels`` (arrays, distinct and sorted; base
    labels are in both); ``expressions``: per tag its text, postfix form, whether it is
    valid, how heavily it binds and its known families; ``score``: 0 without any label,
    nearer to 1 with every label found.

    Whole texts are scanned, however long.  Null and empty texts have no words, no labels
    and a score of 0.  Every row is scanned by itself, repeated ones too; an empty table
    gives an empty result.  Columns with a made name, in any case, are replaced; others stay.
    """
    in_small_batches(docs.sparkSession)
    kept = others(docs, *MADE)
    source = docs.select(*kept, F.col(text).cast("binary").alias(fresh(docs, "_scanned")))
    strings, long = T.ArrayType(T.StringType()), T.LongType()
    schema = T.StructType([*[source.schema[c] for c in kept],
                           *[T.StructField(n, long) for n in MADE[:4]], T.StructField("base_labels", strings), T.StructField("labels", strings),
                           T.StructField("expressions", T.ArrayType(_EXPRESSION)), T.StructField("score", T.DoubleType())])

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner().scan
        for batch in batches:
            rows = [scan(raw.as_py()) for raw in batch.column(len(kept))]
            made = [pa.array([r.n_words for r in rows], pa.int64()), pa.array([len(r.starts) for r in rows], pa.int64()),
                    pa.array([min(r.starts, default=None) for r in rows], pa.int64()), pa.array([max(r.starts, default=None) for r in rows], pa.int64()),
                    pa.array([r.base_labels for r in rows], pa.list_(pa.string())), pa.array([r.labels for r in rows], pa.list_(pa.string())),
                    pa.array([[e._asdict() for e in r.expressions] for r in rows], pa.list_(_ARROW_EXPRESSION)),
                    pa.array([r.score for r in rows], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], *made], names=[*kept, *MADE])

    return source.mapInArrow(scanned, schema)
