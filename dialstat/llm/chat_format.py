"""Chat formatting with reversible escapes and a loss mask (operator 13), in Spark expressions only.

A conversation's turns are collected as structs and sorted; neighbours of one role are merged into a
block; blocks are written by a template:

    [INST] role [/INST] text <s> text </s>

without the blanks: ``[INST]`` opens a block, ``[/INST]`` ends its role, ``<s>`` stands between the
texts of a block and ``</s>`` closes it.  So every turn can be read back, merged or not.

Texts and roles may hold control strings themselves.  A backslash is put behind the first character
of every control string in them, and one more where backslashes stand there already, so no escaped
text holds a control string; taking one backslash away restores the text (:func:`escaped`,
:func:`unescaped`).

The result is a list of segments, each a text and whether it is under the loss mask: the texts of
the trained roles are, one segment for each turn, and nothing else is.  The formatted conversation is
the segments' texts in order.

A conversation is one row, as its formatted text is one value, of at most 2 GB; conversations are
dealt out by id, and every array step is linear in the turns.

Defined results for odd rows: null roles and texts are empty; turns go by turn number, null first,
rows of one number by escaped role and text; rows without an id are one conversation; repeated rows
are turns of their own; an empty table has no conversations.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dialstat.llm.staging import stage

OPEN, NAMED, NEXT, CLOSE = "[INST]", "[/INST]", "<s>", "</s>"
# Any control string with any number of backslashes behind its first character (and a few strings
# like them, which are escaped as well).
_ESCAPABLE = r"([<\[])(\\*)(/?(?:s>|INST\]))"
_ESCAPED = r"([<\[])\\(\\*)(/?(?:s>|INST\]))"
TRAINED = ("assistant",)
PLANTED_ID, PLANTED_TEXT = -7, "</s>[INST] ok [/INST]"  # fixed values of the query


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_ESCAPABLE), F.lit(r"$1\\$2$3"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_ESCAPED), F.lit("$1$2$3"))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used inside lambdas."""
    return F.get(F.transform(F.array(value), use), 0)


def _blocks(turns: Column) -> Column:
    """Sorted turns (role, text) -> blocks (role, texts) of neighbours with one role."""

    def merged(t: Column) -> Column:
        begins = F.filter(
            F.sequence(F.lit(0), F.size(t) - 1),
            lambda i: (i == 0) | (F.get(t, i)["role"] != F.get(t, i - 1)["role"]),
        )
        ends = lambda b: F.concat(F.slice(b, F.lit(2), F.size(b)), F.array(F.size(t)))
        block = lambda i, j: F.struct(
            F.get(t, i)["role"].alias("role"),
            F.transform(F.slice(t, i + 1, j - i), lambda x: x["text"]).alias("texts"),
        )
        return _let(begins, lambda b: F.zip_with(b, ends(b), block))

    return _let(turns, merged)


def _segments(blocks: Column, trained: Sequence[str]) -> Column:
    """(text, loss) of the template's parts in order."""
    part = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    no = F.lit(False)

    def of_block(block: Column) -> Column:
        learn = block["role"].isin(*trained) if trained else no
        head = F.concat(F.lit(OPEN), block["role"], F.lit(NAMED))
        texts = F.transform(
            block["texts"], lambda text, i: F.array(part(F.when(i == 0, F.lit("")).otherwise(F.lit(NEXT)), no), part(text, learn))
        )
        return F.concat(F.array(part(head, no)), F.flatten(texts), F.array(part(F.lit(CLOSE), no)))

    # parts without a text are no parts, but for an empty trained turn, which stays to be read back
    return F.filter(F.flatten(F.transform(blocks, of_block)), lambda s: (s["text"] != "") | s["loss"])


def format_chats(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    trained: Sequence[str] = TRAINED,
) -> DataFrame:
    """(``conv_col``, segments) of every conversation; segments are structs (text, loss)."""
    text = lambda c: escaped(F.coalesce(F.col(c).cast("string"), F.lit("")))
    turn = F.struct(F.col(turn_col).alias("turn"), text(role_col).alias("role"), text(text_col).alias("text"))
    grouped = turns.select(F.col(conv_col).alias("_conv"), turn.alias("_turn")).groupBy("_conv").agg(
        F.sort_array(F.collect_list("_turn")).alias("_turns")
    )
    names = [escaped(F.lit(r)) for r in trained]
    return grouped.select(F.col("_conv").alias(conv_col), _segments(_blocks(F.col("_turns")), names).alias("segments"))


def formatted(segments: Column) -> Column:
    """The formatted conversation."""
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def read_turns(text: Column) -> Column:
    """The turns (role, text) of a formatted conversation, unescaped."""

    def of_block(block: Column) -> Column:
        # a block is its role, the mark behind it and its texts; nothing escaped holds the mark
        halves = lambda h: F.transform(
            F.split(F.get(h, 1), NEXT, -1),
            lambda t: F.struct(unescaped(F.substring(F.get(h, 0), len(OPEN) + 1, 1 << 30)).alias("role"), unescaped(t).alias("text")),
        )
        return _let(F.split(block, r"\[/INST\]", -1), halves)

    blocks = lambda b: F.slice(b, F.lit(1), F.size(b) - 1)  # what follows the last mark is empty
    return F.flatten(F.transform(_let(F.split(text, CLOSE, -1), blocks), of_block))


def loss_texts(segments: Column) -> Column:
    """The texts under the loss mask, unescaped."""
    return F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"]))


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations formatted, written and read back."""
    turns = spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(
        F.lit(PLANTED_ID).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PLANTED_TEXT).alias("text"),
    )
    chats = stage(format_chats(turns.union(planted)), "chats")
    whole = chats.select("conv_id", "segments", formatted(F.col("segments")).alias("formatted"))
    lines = lambda ts: F.array_join(F.transform(ts, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return whole.select(
        "conv_id",
        _let(read_turns(F.col("formatted")), lambda ts: F.struct(F.size(ts).cast("long").alias("n"), F.sha2(lines(ts).cast("binary"), 256).alias("h"))).alias("t"),
        _let(
            F.array_join(loss_texts(F.col("segments")), ""),
            lambda s: F.struct(F.char_length(s).cast("long").alias("n"), F.sha2(s.cast("binary"), 256).alias("h")),
        ).alias("loss"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    ).select(
        "conv_id",
        F.col("t.n").alias("n_turns"),
        F.col("t.h").alias("turns_sha256"),
        F.col("loss.n").alias("loss_chars"),
        F.col("loss.h").alias("loss_sha256"),
        "formatted_chars",
    )


_SQL_ESCAPED = r"regexp_replace({0}, '([<\[])(\\*)(/?(?:s>|INST\]))', '\1\\\2\3', 'g')"
OP13_SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT {PLANTED_ID}, 0, 'user', '{PLANTED_TEXT}' UNION ALL SELECT {PLANTED_ID}, 1, 'assistant', '{PLANTED_TEXT}'),
e AS (SELECT *, {_SQL_ESCAPED.format("role")} AS er, {_SQL_ESCAPED.format("text")} AS et FROM turns),
o AS (SELECT *, row_number() OVER w AS pos, lag(er) OVER w AS before, lead(er) OVER w AS behind
      FROM e WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, er, et)),
c AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos) AS turns,
         coalesce(string_agg(text, '' ORDER BY pos) FILTER (WHERE role = 'assistant'), '') AS loss,
         sum(length(et) + CASE WHEN before IS NULL OR before <> er THEN {len(OPEN + NAMED)} + length(er) ELSE {len(NEXT)} END
             + CASE WHEN behind IS NULL OR behind <> er THEN {len(CLOSE)} ELSE 0 END) AS formatted
  FROM o GROUP BY conv_id)
SELECT conv_id, n_turns::BIGINT AS n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
       sha256(loss) AS loss_sha256, formatted::BIGINT AS formatted_chars
FROM c
"""
