"""Licence scan against a plain word search; the expression parser."""

import random
import re

import pytest

from dialstat.llm import licenses as L
from odd import odd_documents, rows_of


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def places(text, phrases):
    w, out, labels = words(text), [], set()
    for phrase, label in phrases.items():
        p = phrase.split()
        found = [i for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
        out += found
        labels |= {label} if found else set()
    return len(w), out, labels


def scan(text):
    return L.scan_text(text.encode(), L.phrase_automaton(L.BASE_PHRASES, L.NOTICE_PHRASES), L._automaton((t, t) for t in L.TAGS))


def test_places_match_a_plain_search():
    rng = random.Random(3)
    pieces = ["under the MIT License", "Apache License, Version 2.0", "cc-by-nc", "CC BY", "NC", "é", "word", "the", "under", "version2", "cc by nc 4", "GNU General Public License, version 3", "\n", "under the mit licensee", "xcc by nc"]
    for _ in range(400):
        text = rng.choice([" ", ". ", "-"]).join(rng.choice(pieces) for _ in range(rng.randrange(25)))
        got = scan(text)
        n, base, labels = places(text, L.BASE_PHRASES)
        assert (got["n_words"], got["n_base"]) == (n, len(base))
        assert (got["first_word"], got["last_word"]) == ((min(base), max(base)) if base else (None, None))
        assert got["base_labels"] == ",".join(sorted(labels))
        assert got["labels"] == ",".join(sorted(labels | places(text, L.NOTICE_PHRASES)[2]))
        assert 0 <= got["score"] <= 1 and (got["score"] > 0) == bool(got["labels"])


@pytest.mark.parametrize(
    "line,postfix,labels,permissive",
    [
        (" mit", "mit", {"mit"}, True),
        (" mit or gpl-3.0-only", "mit gpl-3.0-only or", {"mit", "gpl-3.0-only"}, True),
        (" mit and gpl-3.0-only", "mit gpl-3.0-only and", {"mit", "gpl-3.0-only"}, False),
        ("gpl-2.0 or mit and gpl-3.0", "gpl-2.0 mit gpl-3.0 and or", {"gpl-2.0", "mit", "gpl-3.0"}, False),
        ("(gpl-2.0 or mit) and apache-2.0", "gpl-2.0 mit or apache-2.0 and", {"gpl-2.0", "mit", "apache-2"}, True),
        ("gpl-2.0 with classpath-exception-2.0 and mit", "gpl-2.0 classpath-exception-2.0 with mit and", {"gpl-2.0-with-classpath-exception-2.0", "mit"}, True),
        ("gpl-2.0 with font-note", "gpl-2.0 font-note with", {"gpl-2.0-with-font-note"}, False),
        ("mit */ and so on", "mit", {"mit"}, True),
        ("mit or", "mit", {"mit"}, True),
        ("mit or (gpl-2.0", "mit", {"mit"}, True),
        ("((mit))", "mit", {"mit"}, True),
    ],
)
def test_expressions(line, postfix, labels, permissive):
    assert L.parse_expression(line) == postfix.split()
    assert L.evaluate(postfix.split()) == (labels, permissive)


@pytest.mark.parametrize("line", ["", "or mit", "(mit", ")", "and", "()", "*"])
def test_no_expression(line):
    assert L.parse_expression(line) == []


def test_tags_and_evidence():
    got = scan("x\n# SPDX-License-Identifier: MIT OR GPL-3.0-only\r\n// SPDX-License-Identifier: (broken\nCC-BY-NC")
    assert got["labels"] == "cc-by-nc,gpl-3.0-only,mit" and got["base_labels"] == "cc-by-nc"
    assert got["expressions"] == ["mit gpl-3.0-only or"] and got["score"] == 1.0 and got["permissive"] is False
    assert scan("all rights reserved")["score"] == 0.7 and scan("plain")["permissive"] is None


@pytest.mark.parametrize("line", ["SPDX-License-Identifier: hello", "the license-expression: field is optional"])
def test_unknown_identifiers_are_weak_evidence_and_no_licence(line):
    got = scan(line)
    assert got["labels"] == "" and got["score"] == 0.3 and got["permissive"] is None and got["expressions"]


def test_known_and_unknown_identifiers_in_one_expression():
    got = scan("SPDX-License-Identifier: mit or hello\nSPDX-License-Identifier: LicenseRef-own-terms and AGPL-3.0-only")
    assert got["labels"] == "agpl-3.0-only,licenseref-own-terms,mit" and got["score"] == 1.0 and got["permissive"] is False
    assert L.evaluate("mit hello and".split()) == ({"mit"}, False) and L.evaluate("mit hello or".split()) == ({"mit"}, True)
    assert L.evaluate("hello classpath-exception-2.0 with".split()) == (set(), False)
    assert {"gpl-3.0-or-later", "lgpl-2.1+", "cc-by-nd-4.0", "mpl-2.0", "gpl-2"} <= L.KNOWN and "hello" not in L.KNOWN


def test_odd_rows(spark, odd, nothing):
    got = rows_of(L.scan_licenses(odd))
    want = [(r[0], *places(r[1], L.BASE_PHRASES)[:2]) for r in odd_documents()]
    assert sorted(((r["doc_id"], r["n_words"], r["n_base"]) for r in got), key=str) == sorted(((i, n, len(p)) for i, n, p in want), key=str)
    assert L.scan_licenses(nothing).count() == 0
