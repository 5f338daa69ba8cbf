"""Licence scan (operator 4): Aho-Corasick over whole texts, shunting-yard for expressions.

Two automata run over every text.  One reads the text's words (A-Z lower-cased, words
``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` joined by single blanks) and finds notice phrases as
consecutive whole words.  The other reads the lower-cased text itself and finds identifier tags;
what follows a tag on its line is read as a licence expression: a shunting-yard pass orders ids,
``and``, ``or`` and ``with`` (``with`` binds closest, then ``and``), and the postfix form is
evaluated twice, to labels and to whether the terms are permissive.  Identifiers that are no known
licence (:func:`known_identifiers`) and no reference of a document's own (``licenseref-...``) give no
label and are not permissive.

Labels: those of the base phrases, those of further notice phrases, and the known licences of every
expression.  Score: the strongest evidence (1.0 tag with a known licence, 0.9 base phrase, 0.7 other
notice, 0.3 tag with unknown identifiers only, 0 none).
``permissive`` is null without a label; otherwise every expression and every phrase must be
permissive.

Defined results for odd rows: a null text is an empty text (no words, no labels, score 0); an
expression is read as far as it is well formed, an unbalanced or empty one gives no label; ids
may be null or repeated, every input row gives one row.  Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The base phrases and their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Further notice phrases of common licences and the labels they give.
NOTICE_PHRASES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "the mit license": "mit",
    "licensed under the apache license": "apache",
    "redistribution and use in source and binary forms": "bsd",
    "bsd 2 clause license": "bsd-2-clause",
    "bsd 3 clause license": "bsd-3-clause",
    "permission to use copy modify and or distribute this software": "isc",
    "gnu general public license": "gpl",
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "gnu free documentation license": "gfdl",
    "mozilla public license": "mpl",
    "mozilla public license version 2": "mpl-2",
    "eclipse public license": "epl",
    "boost software license": "bsl-1.0",
    "the unlicense": "unlicense",
    "released into the public domain": "public-domain",
    "dedicated to the public domain": "public-domain",
    "creative commons zero": "cc0",
    "creative commons attribution": "cc-by",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution share alike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution non commercial": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "gnu general public license v2": "gpl-2",
    "gnu general public license v3": "gpl-3",
    "gnu library general public license": "lgpl",
    "bsd license": "bsd",
    "bsd style license": "bsd",
    "isc license": "isc",
    "zlib license": "zlib",
    "python software foundation license": "psf",
    "artistic license": "artistic",
    "academic free license": "afl",
    "common development and distribution license": "cddl",
    "common public license": "cpl",
    "european union public licence": "eupl",
    "open software license": "osl",
    "microsoft public license": "ms-pl",
    "sil open font license": "ofl",
    "open database license": "odbl",
    "do what the fuck you want to public license": "wtfpl",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "creative commons attribution noderivatives": "cc-by-nd",
    "creative commons attribution no derivatives": "cc-by-nd",
    "creative commons legal code cc0 1 0 universal": "cc0",
    "server side public license": "sspl",
    "business source license": "busl",
    "all rights reserved": "all-rights-reserved",
}

# Tags before an expression; ids whose label is another; terms that are not permissive.
TAGS = ("spdx-license-identifier:", "license-expression:")
ID_LABELS = {"apache-2.0": "apache-2", "cc-by-nc-4.0": "cc-by-nc", "cc0-1.0": "cc0", "mpl-2.0": "mpl-2"}
RESTRICTED = ("agpl", "all-rights-reserved", "cc-by-nc", "cc-by-nd", "cc-by-sa", "epl", "gfdl", "gpl", "lgpl", "mpl")
LIFTING = ("autoconf-exception", "classpath-exception", "gcc-exception", "llvm-exception", "openssl-exception")

# Identifiers of the public list of licences, those that go by a rule as family and
# versions.
SINGLE_IDS = (
    "0bsd aal adsl afl-1.1 afl-1.2 afl-2.0 afl-2.1 afl-3.0 apache-1.0 apache-1.1 apache-2.0 apsl-1.0 apsl-1.1 apsl-1.2 "
    "apsl-2.0 artistic-1.0 artistic-1.0-perl artistic-2.0 beerware blueoak-1.0.0 bsd-1-clause bsd-2-clause "
    "bsd-2-clause-patent bsd-2-clause-views bsd-3-clause bsd-3-clause-clear bsd-3-clause-lbnl bsd-4-clause bsd-4-clause-uc "
    "bsl-1.0 busl-1.1 bzip2-1.0.6 cc0-1.0 cddl-1.0 cddl-1.1 cecill-2.0 cecill-2.1 cecill-b cecill-c cpal-1.0 cpl-1.0 curl "
    "ecl-2.0 efl-2.0 epl-1.0 epl-2.0 eupl-1.1 eupl-1.2 fsfap fsful ftl hpnd icu ijg imagemagick ipl-1.0 isc json libpng "
    "libpng-2.0 libtiff lpl-1.02 lppl-1.3c mit mit-0 mit-cmu mit-modern-variant mpl-1.0 mpl-1.1 mpl-2.0 "
    "mpl-2.0-no-copyleft-exception ms-pl ms-rl mulanpsl-2.0 ncsa nlod-1.0 odbl-1.0 odc-by-1.0 ofl-1.0 ofl-1.1 oldap-2.8 "
    "openssl osl-2.0 osl-2.1 osl-3.0 pddl-1.0 php-3.0 php-3.01 postgresql psf-2.0 python-2.0 qpl-1.0 ruby sgi-b-2.0 sspl-1.0 "
    "tcl unicode-dfs-2016 unlicense upl-1.0 vim w3c wtfpl x11 zlib zpl-2.0 zpl-2.1"
).split()
GNU_VERSIONS = {"gpl": "1.0 2.0 3.0", "lgpl": "2.0 2.1 3.0", "agpl": "1.0 3.0", "gfdl": "1.1 1.2 1.3"}
GNU_ENDINGS = ("", "+", "-only", "-or-later")
CC_KINDS = ("by", "by-sa", "by-nc", "by-nd", "by-nc-sa", "by-nc-nd")
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")
OWN_REFERENCE = "licenseref-"

TAG_SCORE, BASE_SCORE, NOTICE_SCORE, UNKNOWN_TAG_SCORE = 1.0, 0.9, 0.7, 0.3
BINDING = {"or": 1, "and": 2, "with": 3}

_TOKEN = re.compile(r"[ \t]*(?:([()])|([a-z0-9][a-z0-9.+\-]*))")
_ASCII = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def parse_expression(line: str) -> list[str]:
    """Postfix form of the longest well-formed expression at the start of a lower-cased line.

    Returns an empty list where there is none.
    """
    output: list[str] = []
    held: list[str] = []
    best: list[str] = []
    operand_next, opened, at = True, 0, 0
    while (m := _TOKEN.match(line, at)) is not None:
        at = m.end()
        token = m[1] or m[2]
        if operand_next:
            if token == "(":
                held.append(token)
                opened += 1
                continue
            if token == ")" or token in BINDING:
                break
            output.append(token)
            operand_next = False
        elif token in BINDING:
            while held and held[-1] != "(" and BINDING[held[-1]] >= BINDING[token]:
                output.append(held.pop())
            held.append(token)
            operand_next = True
        elif token == ")" and opened:
            while held[-1] != "(":
                output.append(held.pop())
            held.pop()
            opened -= 1
        else:
            break
        if not operand_next and not opened:
            best = output + held[::-1]
    return best


def label_of(identifier: str) -> str:
    return ID_LABELS.get(identifier, identifier)


def known_identifiers() -> frozenset[str]:
    """Identifiers of licences, and the labels of all phrases, which are used as identifiers too."""
    gnu = {f"{name}-{v}{end}" for name, versions in GNU_VERSIONS.items() for v in versions.split() for end in GNU_ENDINGS}
    cc = {f"cc-{kind}-{v}" for kind in CC_KINDS for v in CC_VERSIONS}
    short = {f"{name}-{v.split('.')[0]}" for name, versions in GNU_VERSIONS.items() for v in versions.split()}
    return frozenset({*SINGLE_IDS, *gnu, *cc, *short, *BASE_PHRASES.values(), *NOTICE_PHRASES.values()})


KNOWN = known_identifiers()


def is_known(identifier: str) -> bool:
    return identifier in KNOWN or identifier.startswith(OWN_REFERENCE)


def is_permissive(label: str) -> bool:
    return not label.startswith(RESTRICTED)


def evaluate(postfix: list[str]) -> tuple[set[str], bool]:
    """(labels, permissive) of a postfix expression; identifiers that are not known give no label and
    are not permissive.

    ``or`` leaves the choice, ``and`` binds to both, ``with`` names an exception that lifts a
    restriction if it is one of the linking exceptions.
    """
    stack: list[tuple[set[str], bool, str]] = []  # the last: what stands there, as an exception's name
    for token in postfix:
        if token not in BINDING:
            label, known = label_of(token), is_known(token)
            stack.append(({label} if known else set(), known and is_permissive(label), token))
            continue
        (right, right_ok, name), (left, left_ok, first) = stack.pop(), stack.pop()
        if token == "or":
            stack.append((left | right, left_ok or right_ok, f"{first}-{name}"))
        elif token == "and":
            stack.append((left | right, left_ok and right_ok, f"{first}-{name}"))
        else:
            lifted = bool(left) and name.startswith(LIFTING)
            stack.append(({f"{x}-with-{name}" for x in left}, left_ok or lifted, first))
    return stack.pop()[:2]


def _automaton(keys) -> ahocorasick.Automaton:
    machine = ahocorasick.Automaton()
    for key, value in keys:
        machine.add_word(key, value)
    machine.make_automaton()
    return machine


def phrase_automaton(base: dict[str, str], notices: dict[str, str]) -> ahocorasick.Automaton:
    """Over blank-separated words with a blank on either end; values (is base, label, length)."""
    own = {f" {p} ": (False, label) for p, label in notices.items()} | {f" {p} ": (True, label) for p, label in base.items()}
    return _automaton((key, (*value, len(key))) for key, value in own.items())


def scan_text(text: bytes, phrases: ahocorasick.Automaton, tags: ahocorasick.Automaton) -> dict:
    """Everything the scan says about one text in UTF-8."""
    words = text.translate(_ASCII).split()
    joined = f" {b' '.join(words).decode('latin-1')} " if words else ""
    starts: list[int] = []
    base: set[str] = set()
    notices: set[str] = set()
    at = seen = 0  # blanks in joined[:at]
    for end, (is_base, label, length) in phrases.iter(joined):
        (base if is_base else notices).add(label)
        if is_base:
            # The blank that ends a phrase is counted once per place, from where the last stood.
            seen += joined.count(" ", at, end + 1)
            at = end + 1
            starts.append(seen - length_in_words(length, joined, end) - 1)
    lower = text.translate(_LOWER).decode("latin-1")
    expressions, tagged, allowed = [], set(), True
    for end, _ in tags.iter(lower):
        stop = min((i for i in (lower.find("\n", end), lower.find("\r", end)) if i >= 0), default=len(lower))
        postfix = parse_expression(lower[end + 1 : stop])
        if postfix:
            labels, ok = evaluate(postfix)
            tagged |= labels
            allowed &= ok
            expressions.append(" ".join(postfix))
    labels = base | notices | tagged
    return {
        "n_words": len(words),
        "n_base": len(starts),
        "first_word": min(starts, default=None),
        "last_word": max(starts, default=None),
        "base_labels": ",".join(sorted(base)),
        "labels": ",".join(sorted(labels)),
        "score": max(
            [0.0]
            + [UNKNOWN_TAG_SCORE] * bool(expressions)
            + [TAG_SCORE] * bool(tagged)
            + [BASE_SCORE] * bool(base)
            + [NOTICE_SCORE] * bool(notices)
        ),
        "permissive": allowed and all(map(is_permissive, base | notices)) if labels else None,
        "expressions": expressions,
    }


def length_in_words(length: int, joined: str, end: int) -> int:
    return joined.count(" ", end - length + 2, end + 1)


FIELDS = [
    ("n_words", pa.int64()),
    ("n_base", pa.int64()),
    ("first_word", pa.int64()),
    ("last_word", pa.int64()),
    ("base_labels", pa.string()),
    ("labels", pa.string()),
    ("score", pa.float64()),
    ("permissive", pa.bool_()),
    ("expressions", pa.list_(pa.string())),
]
_DDL = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
    "labels string, score double, permissive boolean, expressions array<string>"
)


def _scan(base: dict[str, str], notices: dict[str, str], tags: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases, marks = phrase_automaton(base, notices), _automaton((t, t) for t in tags)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                rows = [scan_text(t.as_buffer().to_pybytes() if t.is_valid else b"", phrases, marks) for t in part.column(1)]
                yield pa.record_batch(
                    [part.column(0), *(pa.array([r[name] for r in rows], kind) for name, kind in FIELDS)],
                    names=["doc_id", *(name for name, _ in FIELDS)],
                )

    return run


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    base: dict[str, str] = BASE_PHRASES,
    notices: dict[str, str] = NOTICE_PHRASES,
    tags: tuple[str, ...] = TAGS,
) -> DataFrame:
    """One row per document; phrases are lower-case words separated by one blank."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(_scan(base, notices, tags), _DDL).withColumnRenamed("doc_id", id_col)


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence scan of every document."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    return scan_licenses(docs).withColumn("expressions", F.array_join("expressions", "; "))
