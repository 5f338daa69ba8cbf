"""The Merkle manifest: trees, minimal multiproofs and single proofs against plain Python."""

import random
import zlib

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dialstat.llm import merkle as M
from odd import odd_documents, rows_of

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_of(row):
    parts = []
    for c in FIELDS:
        v = row[c]
        parts.append("-" if v is None else f"{len(str(v).encode())}:{v}")
    return M.digest_of("".join(parts))


def levels_of(digests):
    out = [digests]
    while len(out[-1]) > 1:
        out.append([M.digest_of("".join(out[-1][i : i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def siblings_of(levels, index):
    out = []
    for level in levels[:-1]:
        first = index // 3 * 3
        out += [level[i] for i in range(first, min(first + 3, len(level))) if i != index]
        index //= 3
    return out


def brute(rows):
    """{(doc_id, leaf): sorted (subroot, root, proof digest)} of all rows."""
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        ordered = sorted(groups[name], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
        trees[name] = (ordered, levels_of([leaf_of(r) for r in ordered]))
    top = levels_of([trees[n][1][-1][0] for n in names])
    out = []
    for at, name in enumerate(names):
        ordered, levels = trees[name]
        for i, r in enumerate(ordered):
            proof = siblings_of(levels, i) + siblings_of(top, at)
            path = M.path_of(i, len(ordered)) + M.path_of(at, len(names))
            assert M.fold(leaf_of(r), path, proof) == top[-1][0]
            out.append((r["doc_id"], leaf_of(r), levels[-1][0], M.digest_of("".join(proof)), top[-1][0], tuple(proof)))
    return out, (top[-1][0] if names else None)


def as_rows(tuples):
    return [dict(zip(("doc_id", "text", "lang", "source", "n_chars"), t)) for t in tuples]


def key(t):
    return tuple((v is not None, v if v is not None else 0) for v in t[:1]) + tuple(t[1:4])


def check(spark, df, rows):
    manifest = M.build_manifest(df)
    got = rows_of(M.prove(manifest, keep_proof=True))
    want, root = brute(rows)
    assert manifest.root == root
    mine = [(r["id"], r["leaf"], r["subroot"], r["proof_sha256"], r["derived_root"], tuple(r["proof"])) for r in got]
    assert sorted(mine, key=key) == sorted(want, key=key)
    assert all(r["folded_root"] == root for r in got)
    return manifest


def test_odd_rows(spark, odd, nothing):
    check(spark, odd, as_rows([r[:5] for r in odd_documents()]))
    manifest = M.build_manifest(nothing)
    assert manifest.root is None and M.prove(manifest).count() == 0
    one = check(spark, odd.filter("doc_id = 7"), as_rows([r[:5] for r in odd_documents() if r[0] == 7]))
    assert one.root == one.leaves.first()["leaf"]  # a lone leaf is the root


@pytest.mark.parametrize("levels", [1, 2])
def test_a_hot_group_in_many_blocks(spark, monkeypatch, levels):
    """Blocks of 3 and 9 leaves, so that trees take several passes and fetch from other blocks."""
    monkeypatch.setattr(M, "LEVELS", levels)
    monkeypatch.setattr(M, "BLOCK", 3**levels)
    monkeypatch.setattr(M, "SEGMENT", 16)
    rng = random.Random(levels)
    rows = [(i, f"text {i % 7}\nline", rng.choice(["en", None]), "hot" if i % 3 else f"s{i % 40}", i) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    check(spark, df, as_rows(rows))


def test_proofs_of_some_leaves_fetch_the_rest(spark, monkeypatch):
    monkeypatch.setattr(M, "LEVELS", 1)
    monkeypatch.setattr(M, "BLOCK", 3)
    rows = [(i, f"t{i}", "en", "ab"[i % 2], 2) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    manifest = M.build_manifest(df)
    wanted = manifest.leaves.filter("id % 7 = 0")
    got = {r["id"]: tuple(r["proof"]) for r in rows_of(M.prove(manifest, wanted, keep_proof=True))}
    want = {t[0]: t[5] for t in brute(as_rows(rows))[0] if t[0] % 7 == 0}
    assert got == want


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 400).flatmap(lambda n: st.tuples(st.just(n), st.sets(st.integers(0, n - 1), min_size=1))))
def test_missing_coordinates_are_enough_and_minimal(case):
    size, known = case
    levels = levels_of([M.digest_of(str(i)) for i in range(size)])
    asked = list(M.missing(sorted(known), size))
    assert len(asked) == len(set(asked))
    have = {(0, i) for i in known} | set(asked)
    given_by = {(0, i) for i in known}
    for level, nodes in enumerate(levels[:-1]):
        for p in range(len(levels[level + 1])):
            run = [(level, i) for i in range(3 * p, min(3 * p + 3, len(nodes)))]
            if any(c in given_by for c in run):
                assert all(c in have for c in run)  # enough
                given_by.add((level + 1, p))
                have.add((level + 1, p))
    assert not set(asked) & given_by  # nothing that the leaves give


def test_tampered_leaves_do_not_verify(spark, tmp_path):
    rows = [(i, "a\nb" if i % 3 else "ab", None, f"s{i % 4}", None if i % 5 else i) for i in range(90)] + [(90, None, "en", None, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in rows_of(M.op11_merkle_manifest(spark, str(tmp_path)))}
    want, root = brute(as_rows(rows))
    assert len(got) == 91
    for r in rows:
        tampered = zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[1] is not None and "\n" in r[1]
        assert got[r[0]]["verified"] == (not tampered) == (got[r[0]]["folded_root"] == root)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    result = con.execute(M.OP11_SQL)
    names = [c[0] for c in result.description]
    for row in result.fetchall():
        row = dict(zip(names, row))
        assert row == got[row["doc_id"]]


def test_texts_stay_where_they_are_read(spark, documents, odd):
    plan = M._in_blocks(M.build_manifest(odd).leaves.withColumn("block", F.lit(0)), "index")
    assert "text" not in plan.columns
