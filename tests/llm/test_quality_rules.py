"""Base statistics against plain Python, the robust distances against numpy."""

import collections
import math
import random
import re

import numpy as np
import pytest

from dialstat.llm import quality as Q
from odd import odd_documents, rows_of


def statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many = collections.Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if many[w] > 1 for k in range(3)}
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_lines": len(lines),
        "n_repeat_words": len(covered),
    }


def base_failed(s):
    return s["n_words"] < 50 or 100 * s["n_repeat_words"] > 50 * s["n_words"]


def features(s):
    return [
        math.log(s["n_words"]),
        s["word_chars"] / s["n_words"],
        math.log(1 + 100 * s["n_symbols"] / s["word_chars"]),
        s["n_dup_lines"] / s["n_lines"],
        s["n_repeat_words"] / s["n_words"],
    ]


def estimate(x, whole):
    shares, factors = zip(*Q.CONSISTENCY_OF_SHARE)
    mean = x.mean(0)
    cov = np.interp(len(x) / whole, shares, factors) * ((x.T @ x) / len(x) - np.outer(mean, mean)) + np.diag(np.square(Q.FLOORS))
    return mean, cov


def distances(x, mean, cov):
    away = x - mean
    return np.einsum("ij,jk,ik->i", away, np.linalg.inv(cov), away)


def robust_distances(x, known):
    """Distances by the minimum covariance determinant of the first ``known`` rows, in numpy."""
    every, x = x, x[:known]
    quarter = np.array(Q.FLOORS) / 4
    bins = np.sort(np.floor(x / quarter), axis=0)
    median = (bins[(len(x) + 1) // 2 - 1] + 0.5) * quarter
    best = None
    for mean, cov in ((median, np.diag(np.square(Q.FLOORS))), estimate(x, len(x))):
        for _ in range(Q.STEPS):
            bin_of = np.floor(np.log2(distances(x, mean, cov) + 1e-6) * Q._BINS_PER_OCTAVE)
            values, counts = np.unique(bin_of, return_counts=True)
            before = np.cumsum(counts) - counts
            mean, cov = estimate(x[np.isin(bin_of, values[before < (len(x) + x.shape[1] + 1) / 2])], len(x))
        found = (np.linalg.slogdet(cov)[1], mean, cov)
        best = found if best is None or found[0] < best[0] else best
    return distances(every, best[1], best[2])


def random_texts(count):
    rng = random.Random(6)
    out = []
    for _ in range(count):
        vocabulary = [f"w{i}" for i in range(rng.choice([3, 8, 40, 4000]))]
        words = [rng.choice(vocabulary) + rng.choice(["", "", "#", "é", "|"]) for _ in range(rng.randrange(120))]
        out.append("".join(w + rng.choice([" ", " ", "\n", "\t ", "\r\n", "\x0b"]) for w in words))
    return out


def test_statistics_match_plain_python(spark):
    texts = random_texts(400) + [r[1] for r in odd_documents()]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string").repartition(4)
    got = {r.pop("i"): r for r in rows_of(Q.text_statistics(df))}
    assert got == {i: statistics(t) for i, t in enumerate(texts)}


def test_hash_collisions_cannot_count(spark, monkeypatch):
    """With every window hashed alike the exact comparison decides alone."""
    monkeypatch.setattr(Q, "_WINDOWS", Q._WINDOWS.replace("xxhash64(words[i], words[i + 1], words[i + 2])", "7L"))
    texts = random_texts(60)
    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    got = {r["i"]: r["n_repeat_words"] for r in rows_of(Q.text_statistics(df))}
    assert got == {i: statistics(t)["n_repeat_words"] for i, t in enumerate(texts)}


def test_distances_match_numpy(spark, documents):
    df = spark.createDataFrame([d[:4] for d in documents], "doc_id long, text string, lang string, source string")
    df = df.withColumn("source", Q.F.expr("if(doc_id % 5 > 0, 'x', source)")).repartition(3)
    rows = {r["doc_id"]: r for r in rows_of(Q.judge_quality(df))}
    stats = {d[0]: statistics(d[1]) for d in documents}
    passed = [d for d in documents if not base_failed(stats[d[0]])]
    own = {d[0]: (d[2], "x" if d[0] % 5 > 0 else d[3]) for d in passed}
    vector = {i: tuple(features(stats[i])) for i in own}
    different = lambda ids: sorted({vector[i] for i in ids})
    levels = collections.Counter()
    for g in set(own.values()):
        ids = [i for i in own if own[i] == g]
        judges = [ids, [i for i in own if own[i][0] == g[0]], list(own)]
        level = next(k for k, j in enumerate(judges) if len(different(j)) >= Q.LEAST_ROWS)
        levels[level] += 1
        x = np.array(different(judges[level]) + [vector[i] for i in ids])
        want = robust_distances(x, len(different(judges[level])))[-len(ids) :]
        assert [rows[i]["distance"] for i in ids] == pytest.approx(want.tolist(), rel=1e-6, abs=1e-9)
        assert [rows[i]["kept"] for i in ids] == [d <= Q.BOUND for d in want]
    assert set(levels) == {0, 1, 2}
    for i, s in stats.items():
        assert rows[i]["base_failed"] == base_failed(s) and not (rows[i]["kept"] and base_failed(s))
    # documents full of symbols go, others stay
    for i in own:
        junk = stats[i]["n_symbols"] > 0.05 * stats[i]["word_chars"]
        assert rows[i]["kept"] == (not junk)


def clean_text(rng, count):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(count))


@pytest.mark.parametrize("junk", [0.0, 0.26, 0.35, 0.45])
def test_junk_beyond_a_quarter_is_rejected(spark, junk):
    """Texts with symbols at 10 % of their characters go, whatever share of the group they fill."""
    rng = random.Random(1)
    rows = []
    for k in range(300):
        text = clean_text(rng, rng.randrange(100, 400))
        bad = k < junk * 300
        rows.append((k, text + " " + "#" * (len(text) // 8) if bad else text, "en", "a"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    got = {r["doc_id"] for r in rows_of(Q.judge_quality(docs)) if r["kept"]}
    assert got == {k for k in range(300) if k >= junk * 300}


def test_copies_count_once(spark):
    """Copies of one text fill 90 % of a group: its other texts stay, its junk goes."""
    rng = random.Random(2)
    copy = clean_text(rng, 60)
    others = [clean_text(rng, round(60 * 60 ** rng.random())) for _ in range(96)] + [clean_text(rng, 60 * 60)]
    rubbish = [t + " " + "#" * (len(t) // 2) for t in others[:3]]
    rows = [(k, t, "en", "a") for k, t in enumerate([copy] * 900 + others + rubbish)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    got = {r["doc_id"] for r in rows_of(Q.judge_quality(docs)) if r["kept"]}
    assert got == set(range(997))


def test_odd_rows(spark, odd, nothing):
    got = rows_of(Q.judge_quality(odd))
    want = [(r[0], statistics(r[1])) for r in odd_documents()]
    short = lambda i, s: (i, s["n_words"], s["word_chars"], s["n_repeat_words"], s["n_symbols"], s["n_dup_lines"])
    assert sorted((short(r["doc_id"], r) for r in got), key=str) == sorted((short(i, s) for i, s in want), key=str)
    assert all(r["kept"] != r["base_failed"] for r in got)  # too few rows for any estimate
    assert Q.judge_quality(nothing).count() == 0


def test_main_path_is_native(spark, odd):
    plan = Q.text_statistics(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
