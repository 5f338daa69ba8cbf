"""Chat formatting: reversible escapes, merged turns, the loss mask, against plain Python."""

import hashlib

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dialstat.llm import chat_format as C
from odd import rows_of

SCHEMA = "conv_id long, turn long, role string, text string, segments string, formatted long, _turn string, _conv int"
TRICKY = ["", "</s>[INST] ok [/INST]", "<\\/s>", "<\\\\/s>", "[\\INST]x", "[[INST]", "<<s>", "[s>", "\\", "a\nb", "😀</s", "s>", "$1\\2"]


def odd_turns():
    rows = [
        (1, 0, "user", "hi"),
        (1, 1, "user", "again"),
        (1, 2, "assistant", "yes"),
        (1, 3, "assistant", ""),
        (1, 4, "assistant", "</s>more"),
        (2, None, None, None),
        (2, 0, "assistant", None),
        (2, 0, "assistant", None),  # a repeated row
        (2, 1, "", "empty role"),
        (None, 3, "user", "no id"),
        (None, 1, "[INST]", "role of control strings"),
        (3, 0, "assistant", "x" * 100_000 + "<s>"),
        (4, 0, "system", "only a system"),
    ]
    rows += [(5, i, "assistant" if i % 3 else "user", t) for i, t in enumerate(TRICKY)]
    rows += [(6, i, "assistant", f"t{i}") for i in range(400)]
    return [(*r, "s", 1, "t", 2) for r in rows]


def by_conversation(rows):
    out = {}
    for conv, turn, role, text, *_ in rows:
        out.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(ts, key=lambda t: t[:2])] for c, ts in out.items()}


@pytest.fixture(scope="module")
def turns(spark):
    return spark.createDataFrame(odd_turns(), SCHEMA).repartition(4)


def test_texts_are_read_back(spark, turns):
    df = C.format_chats(turns)
    got = rows_of(
        df.select("conv_id", "segments", C.formatted(F.col("segments")).alias("f"), C.loss_texts(F.col("segments")).alias("loss")).withColumn(
            "turns", C.read_turns(F.col("f"))
        )
    )
    want = by_conversation(odd_turns())
    assert {r["conv_id"] for r in got} == set(want) and len(got) == len(want)
    for r in got:
        assert [tuple(t) for t in r["turns"]] == want[r["conv_id"]]
        assert r["loss"] == [text for role, text in want[r["conv_id"]] if role == "assistant"]
        assert r["f"] == "".join(s["text"] for s in r["segments"])


def test_neighbours_of_one_role_are_one_block(spark, turns):
    f = C.format_chats(turns).filter("conv_id = 1").select(C.formatted(F.col("segments"))).first()[0]
    assert f == "[INST]user[/INST]hi<s>again</s>[INST]assistant[/INST]yes<s><s><\\/s>more</s>"


def test_empty_table_and_other_trained_roles(spark, turns):
    assert C.format_chats(turns.limit(0)).count() == 0
    both = C.format_chats(turns, trained=["user", "assistant"]).filter("conv_id = 1")
    assert both.select(C.loss_texts(F.col("segments"))).first()[0] == ["hi", "again", "yes", "", "</s>more"]
    none = C.format_chats(turns, trained=[]).select(F.sum(F.size(C.loss_texts(F.col("segments"))))).first()[0]
    assert none == 0


pieces = st.lists(st.sampled_from(["<", "[", "\\", "/", "s>", "INST]", "</s>", "[INST]", "x", "\n", "$", "😀"]), max_size=8).map("".join)


@settings(max_examples=8, deadline=None)
@given(st.lists(pieces, min_size=60, max_size=60))
def test_escapes_are_reversible_and_hide_control_strings(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", C.escaped(F.col("t")).alias("e"))
    for r in df.withColumn("back", C.unescaped(F.col("e"))).collect():
        assert r["back"] == r["t"]
        assert not any(c in r["e"] for c in (C.OPEN, C.NAMED, C.NEXT, C.CLOSE))


def test_query_against_plain_python_and_sql(spark, turns, tmp_path):
    turns.write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r["conv_id"]: r for r in rows_of(C.op13_chat_format(spark, str(tmp_path)))}
    want = by_conversation(odd_turns())
    want[-7] = [("user", C.PLANTED_TEXT), ("assistant", C.PLANTED_TEXT)]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert set(got) == set(want)
    for conv, ts in want.items():
        loss = "".join(t for r, t in ts if r == "assistant")
        r = got[conv]
        assert (r["n_turns"], r["turns_sha256"]) == (len(ts), sha("".join(f"{a}\n{b}\n" for a, b in ts)))
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), sha(loss))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    result = con.execute(C.OP13_SQL)
    names = [c[0] for c in result.description]
    assert {r["conv_id"]: r for r in (dict(zip(names, row)) for row in result.fetchall())} == got


def test_main_path_is_native(spark, turns):
    plan = C.format_chats(turns)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
