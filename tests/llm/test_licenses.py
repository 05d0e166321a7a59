import random

import brute
import pytest

from reviewloom.llm import licenses
from reviewloom.llm.licenses import evaluate, read_expression, scan_licenses, to_postfix

FIRST = "doc_id long, text string, N_Words string, _scanned int"


def plain(text):
    """Every phrase at every word, without an automaton."""
    words = brute.normal_words(text)
    starts, base, labels = [], set(), set()
    for phrase, label in [*licenses.NOTICES.items(), *licenses.BASE_PHRASES.items()]:
        parts = phrase.split()
        for s in range(len(words) - len(parts) + 1):
            if words[s:s + len(parts)] == parts:
                labels.add(label)
                if phrase in licenses.BASE_PHRASES:
                    base.add(label)
                    starts.append(s)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), sorted(base), sorted(labels)


def texts():
    rng = random.Random(3)
    parts = [*licenses.BASE_PHRASES, *licenses.NOTICES, "mit", "license", "Cc", "BY", "gnu", "ß漢", "licenseé", "the apache", "commit license", "\x85x"]
    gaps = [" ", "  ", "-", "\n", ", ", "_", "\t", "\x00", ""]
    out = ["".join(rng.choice(parts).title() + rng.choice(gaps) for _ in range(rng.randrange(14))) for _ in range(400)]
    return [*out, None, "", "---", "mit license " * 20_000, "mit license mit license", "MİT License", "CC BY-NC-SA 4.0", "word " * 50_000 + "apache license"]


def test_agrees_with_every_phrase_at_every_word(spark):
    rows = [(i, t, "x", i) for i, t in enumerate(texts())]
    got = {r["doc_id"]: r for r in scan_licenses(spark.createDataFrame(rows, FIRST)).collect()}
    for i, t, *_ in rows:
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"]) == plain(t), t
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["labels"]) and r["_scanned"] == i
    assert any(r["n_base"] > 2 for r in got.values())


def by_recursion(tokens):
    """Recursive descent over a valid expression: burden."""
    def either():
        value = both()
        while tokens and tokens[0].lower() == "or":
            tokens.pop(0)
            value = min(value, both())
        return value

    def both():
        value = one()
        while tokens and tokens[0].lower() == "and":
            tokens.pop(0)
            value = max(value, one())
        return value

    def one():
        token = tokens.pop(0)
        if token == "(":
            value = either()
            assert tokens.pop(0) == ")"
            return value
        value = licenses.BURDENS.get(licenses.family(token), licenses.UNKNOWN_BURDEN)
        if tokens and tokens[0].lower() == "with":
            assert "exception" in tokens[1]
            del tokens[:2]
            value = min(value, 1)
        return value

    return either()


def test_expressions_agree_with_recursive_descent():
    rng = random.Random(5)
    names = ["MIT", "GPL-2.0-only", "GPL-3.0+", "Apache-2.0", "AGPL-3.0-or-later", "MPL-2.0", "CC-BY-SA-4.0", "LicenseRef-x", "0BSD"]

    def grown(depth):
        if depth == 0 or rng.random() < 0.3:
            return rng.choice(names) + (" WITH Classpath-exception-2.0" if rng.random() < 0.2 else "")
        inner = f"{grown(depth - 1)} {rng.choice(['AND', 'OR', 'and', 'or'])} {grown(depth - 1)}"
        return f"({inner})" if rng.random() < 0.5 else inner

    for _ in range(500):
        text = grown(4)
        tokens = text.replace("(", " ( ").replace(")", " ) ").split()
        read = read_expression(" " + text + " */")
        assert read.valid and read.text == text and read.burden == by_recursion(list(tokens))
        assert evaluate(to_postfix(tokens)) == read.burden


@pytest.mark.parametrize("text", ["", "AND MIT", "MIT OR", "(MIT", "MIT)", "MIT Apache-2.0", "()", "MIT WITH Apache-2.0", "(MIT OR ISC) WITH x-exception",
                                  "LLVM-exception", "MIT AND LLVM-exception", "MIT (", "OR", "MIT WITH x-exception WITH y-exception"])
def test_what_is_no_expression(text):
    assert read_expression(text) == (text, "", False, None, ())


def test_precedence():
    assert to_postfix("MIT OR ISC AND GPL-2.0 WITH x-exception".split()) == ["MIT", "ISC", "GPL-2.0", "x-exception", "with", "and", "or"]
    assert to_postfix("( MIT OR ISC ) AND Zlib".split()) == ["MIT", "ISC", "or", "Zlib", "and"]
    deep = ["("] * 20_000 + ["MIT"] + [")"] * 20_000
    assert to_postfix(deep) == ["MIT"]


def test_tags_in_texts(spark):
    rows = [(1, "/* SPDX-License-Identifier: (GPL-2.0-only WITH Linux-syscall-note-exception) OR BSD-3-Clause */\nx", "", 0),
            (2, "é spdx-license-identifier:MIT AND LGPL-2.1+\r\nSPDX-License-Identifier: AND", "", 0),
            (2, "license-expression: LicenseRef-own", "", 0), (None, "SPDX-License-Identifier:", "", 0)]
    got = sorted((r["doc_id"] or 0, r["labels"], [(e["valid"], e["burden"]) for e in r["expressions"]], round(r["score"], 4))
                 for r in scan_licenses(spark.createDataFrame(rows, FIRST)).collect())
    assert got == [(0, [], [(False, None)], 0.0), (1, ["bsd", "gpl"], [(True, 0)], 0.9975), (2, [], [(True, 3)], 0.0),
                   (2, ["lgpl", "mit"], [(True, 1), (False, None)], 0.9975)]
    assert scan_licenses(spark.createDataFrame([], FIRST)).collect() == []
