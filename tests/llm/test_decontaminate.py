"""Winnowing against a plain search for every window."""

import hashlib
import random
import re

import pytest

from dialstat.llm import decontaminate as D
from odd import odd_documents, rows_of


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower())


def expected(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 12)) if w else ():
            windows.setdefault(tuple(w[i : i + 13]), set()).add(item)
    out = []
    for _, text in docs:
        w, hit, met = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if (found := windows.get(tuple(w[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    met |= found
        out.append((len(w), len(hit), sorted(str(m) for m in met if m is not None), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def case():
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(60)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    shared = text(40)
    items = [(i, " ".join(text(5) + shared[:20] + text(3))) for i in range(6)]
    items += [(20, "w1 w2"), (21, " ".join(shared[:13])), (22, ""), (23, None), (24, " ".join(shared[5:30])), (24, "W3, w4!"), (None, " ".join(text(20)))]
    docs = []
    for i in range(60):
        body = text(rng.randint(0, 200))
        if rng.random() < 0.6:
            a, n = rng.randrange(10), rng.choice([8, 12, 13, 14, 25])
            at = rng.randrange(len(body) + 1)
            body[at:at] = shared[a : a + n]
        docs.append((i, " ".join(body)))
    docs += [(100, items[-1][1]), (101, None), (102, ""), (103, " ".join(shared[:13]).upper())]
    return docs, items


@pytest.mark.parametrize("most", [4_000_000, 0])
def test_both_paths_match_a_plain_search(spark, most):
    docs, items = case()
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in rows_of(D.decontaminate(d, b, broadcast_windows=most))}
    assert got == {i: w for (i, _), w in zip(docs, expected(docs, items))}


def test_every_long_shared_span_keeps_a_common_fingerprint():
    import numpy as np

    from dialstat.llm import bytescan as B

    rng = np.random.default_rng(2)
    for _ in range(100):
        shared = rng.integers(0, 2**62, 13, dtype=np.uint64)
        kept = []
        for _ in range(2):
            around = rng.integers(0, 2**62, (2, rng.integers(0, 30)), dtype=np.uint64)
            doc = np.concatenate([around[0], shared, around[1]])
            _, marks, grams = D.window_minima(doc, np.array([0, len(doc)]))
            kept.append(set(grams[np.unique(marks)].tolist()))
        assert kept[0] & kept[1] & set(B.gram_hashes(shared, D.GRAM).tolist())


def test_odd_rows(spark, odd, nothing):
    items = [(1, "two words"), (2, None), (3, odd_documents()[0][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in rows_of(D.decontaminate(odd, bench))), key=str)
    rows = [(r[0], r[1]) for r in odd_documents()]
    assert got == sorted(((i, *w) for (i, _), w in zip(rows, expected(rows, items))), key=str)
    assert D.decontaminate(nothing, bench).count() == 0
    none = spark.createDataFrame([], "item_id long, text string")
    assert {(r["n_hit"], r["contaminated"]) for r in rows_of(D.decontaminate(odd, none))} == {(0, False)}
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
