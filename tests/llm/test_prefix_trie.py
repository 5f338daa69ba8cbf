"""The prefix trie of rebuilt conversations against a plain Python trie."""

import hashlib
import random
import zlib

import duckdb
import pytest

from dialstat.llm import prefix_trie as P
from odd import rows_of

SCHEMA = "conv_id long, turn long, role string, text string, depth string, chunk int, q0 long, n_convs string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    own = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            ref = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own.setdefault(conv, []).append((turn is not None, turn or 0, ref, role, text))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    members = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = own.get(c - int(abs(c) % 100) * (1 if c >= 0 else -1), [])
        seq = tuple(base[:h] + ts[h:])
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append((c, len(seq)))
    kids = {}
    for seq in members:
        if seq:
            kids.setdefault(seq[:-1], []).append(seq)
    leaves, saved = {}, {}
    for seq in sorted(members, key=len, reverse=True):
        below = kids.get(seq, [])
        leaves[seq] = sum(leaves[k] for k in below) or 1
        weight = (len(members[seq]) - 1) * (len(seq[-1][1]) if seq else 0)
        saved[seq] = weight + sum(saved[k] for k in below)
    out = []
    for seq, who in members.items():
        ends = ",".join(str(c) for c in sorted(c for c, n in who if n == len(seq)))
        out.append(
            (
                min(c for c, _ in who),
                len(seq),
                min(c for c, _ in members[seq[:-1]]) if seq else None,
                len(who),
                len(kids.get(seq, [])),
                leaves[seq],
                saved[seq],
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(out, key=lambda r: r[:2])


def run(spark, rows, partitions=4):
    df = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    return sorted((tuple(r[c] for c in COLUMNS) for r in rows_of(P.prefix_trie(df))), key=lambda r: r[:2])


def made(seed, convs=60, turns=6, texts=3):
    rng = random.Random(seed)
    rows = []
    for i in range(convs):
        conv = rng.choice([i, 100 + i % 7, 200, -i, 1000 * i + 3])
        for t in range(rng.randrange(0, turns)):
            role, text = rng.choice(["user", "assistant", None]), rng.choice(["", "a", "bb😀", None][: texts + 1])
            rows.append((conv, t, role, text, "x", 1, 2, "y"))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_random_tables(spark, seed):
    rows = made(seed)
    rows = list({r[:2]: r for r in rows}.values())
    assert run(spark, rows) == brute(rows)


def odd_turns():
    rows = [
        (0, 0, "user", "hello"),
        (0, 1, "assistant", "hi"),
        (1, None, "user", "no turn number"),
        (1, 0, "user", None),
        (2, 0, None, "x"),
        (2, 0, None, "x"),  # a repeated row
        (2, 0, "user", "another row of that turn"),
        (None, 0, "user", "of no conversation"),
        (105, 0, "user", "its base is absent"),
        (-7, 0, "user", "hello"),
        (-7, 1, "assistant", "hi"),
        (9_000_000_000, 0, "user", "y" * 50_000),
    ]
    return [(*r, "x", 1, 2, "y") for r in rows]


def test_odd_rows(spark, tmp_path):
    rows = odd_turns()
    assert run(spark, rows) == brute(rows)
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    got = sorted((tuple(r[c] for c in COLUMNS) for r in rows_of(P.op12_prefix_trie(spark, str(tmp_path)))), key=lambda r: r[:2])
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    result = con.execute(P.OP12_SQL)
    names = [c[0] for c in result.description]
    assert sorted((tuple(row[names.index(c)] for c in COLUMNS) for row in result.fetchall()), key=lambda r: r[:2]) == got


def test_empty_table(spark):
    assert run(spark, [(None, 0, "user", "x", "", 1, 1, "")], 1) == []
    assert P.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0


def test_long_conversations_are_scanned_in_chunks(spark, monkeypatch):
    """Chunks of 4 turns: totals are scanned over three levels, and totals of paths join by chunk."""
    for name, value in (("CHUNK", 4), ("SPAN", 3), ("DEPTHS", 2)):
        monkeypatch.setattr(P, name, value)
    monkeypatch.setattr("dialstat.llm.streams.SEGMENT", 8)
    rng = random.Random(5)
    common = [(t, rng.choice(["user", "assistant"]), f"text {rng.randrange(4)}") for t in range(90)]
    rows = []
    for conv, cut in ((0, 90), (100, 90), (7, 70), (107, 33), (200, 90), (300, 12), (301, 5), (400, 90)):
        rows += [(conv, t, r, x) for t, r, x in common[:cut]]
    rows += [(300, 12, "user", "another"), (107, 33, "user", "another"), (400, 90, "user", "one more")]
    rows = [(*r, "x", 1, 2, "y") for r in rows]
    assert run(spark, rows) == brute(rows)


def test_colliding_fingerprints_are_found_and_drawn_anew(spark, monkeypatch):
    true = P._element
    seeds = []

    def poor(i, seed):
        seeds.append(seed)
        return (P.F.lit(1 << 31) + P.F.col("q0") * 0) if seed == 0 else true(i, seed)  # x -> x for every turn

    monkeypatch.setattr(P, "_element", poor)
    rows = list({r[:2]: r for r in made(9, convs=20)}.values())
    assert run(spark, rows) == brute(rows)
    assert max(seeds) == 1
