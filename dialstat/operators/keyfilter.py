"""Key filters: which rows of one table may have a key of another, before anything is shuffled.

The keys' hashes set bits of a map of ``2 ** BITS`` bits, kept as rows (word, 64 bits) of the words
that have any bit set.  So a filter has at most ``2 ** (BITS - 6)`` rows, 262,144, however many keys
there are: that bound is what allows its broadcast, and no counting job is needed.  Building it is
one aggregation with map-side partial maps; probing is a semi join by word with a test of one bit.

No row whose key is among the keys is lost.  Others may stay, the more the fuller the map (6 % of
them with a million keys); beyond some ten million keys the filter lets nearly all rows pass and
costs only its probe.  So a filter goes before a join or a limit that decides exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 24


def _bit_of(keys: Sequence[str]) -> str:
    return f"(xxhash64({', '.join(f'`{k}`' for k in keys)}) & {(1 << BITS) - 1}L)"


def _as_list(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def key_filter(keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """The map of ``keys``' key columns: (key_word, key_bits), at most ``2 ** (BITS - 6)`` rows.

    A null key has a bit like any other; it makes no row match, it only lets null keys pass.
    """
    bit = _bit_of(_as_list(on))
    words = keys.selectExpr(f"shiftright({bit}, 6) AS key_word", f"shiftleft(1L, CAST({bit} & 63 AS INT)) AS one")
    return words.groupBy("key_word").agg(F.expr("bit_or(one) AS key_bits"))


def may_match(rows: DataFrame, keys: DataFrame, on: str | Sequence[str], keys_on: str | Sequence[str] | None = None) -> DataFrame:
    """The rows whose key columns ``on`` may be among ``keys``' columns ``keys_on`` (default: ``on``).

    Key columns that meet must have the same type, or their hashes differ.
    """
    mine, theirs = _as_list(on), _as_list(keys_on if keys_on is not None else on)
    have, want = keys.schema, rows.schema
    if any(want[m].dataType != have[t].dataType for m, t in zip(mine, theirs, strict=True)):
        keys = keys.select(*[F.col(t).cast(want[m].dataType).alias(t) for m, t in zip(mine, theirs)])
    bit = _bit_of(mine)
    meets = F.expr(f"shiftright({bit}, 6) = key_word AND (shiftright(key_bits, CAST({bit} & 63 AS INT)) & 1L) = 1L")
    return rows.join(F.broadcast(key_filter(keys, theirs)), meets, "left_semi")
