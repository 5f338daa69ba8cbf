"""The Feistel shuffle: a permutation, balanced shards, both directions."""

import collections
import zlib

import pytest

from dialstat.llm import sharding as S
from odd import odd_documents, rows_of


@pytest.mark.parametrize("rows", [1, 2, 3, 4, 5, 9, 10, 17, 100, 1001])
def test_a_permutation_with_an_inverse(rows):
    places = [S.locate(r, rows, 8, 20) for r in range(rows)]
    assert sorted(slot * 8 + shard for shard, slot in places) == list(range(rows))
    assert [S.row_at(*p, rows, 8, 20) for p in places] == list(range(rows))


def test_seeds_differ_and_the_order_is_mixed():
    first = [S.locate(r, 1000, 8, 1) for r in range(1000)]
    assert first != [S.locate(r, 1000, 8, 2) for r in range(1000)]
    moved = sum(abs(slot * 8 + shard - r) for r, (shard, slot) in enumerate(first)) / 1000
    assert 280 < moved < 390  # a random order moves a row by a third of the length


@pytest.mark.parametrize("rows", [1, 2, 7, 1000, 65_537])
def test_columns_agree_with_the_driver_functions(spark, rows):
    from pyspark.sql import functions as F

    got = spark.range(rows).select("id", S.feistel_numbers(F.col("id"), rows, 20).alias("v")).collect()
    for r in got[:: max(1, rows // 500)]:
        assert divmod(r["v"], 8)[::-1] == S.locate(r["id"], rows, 8, 20)
    assert len({r["v"] for r in got}) == rows


def test_large_domains_stay_exact(spark):
    from pyspark.sql import functions as F

    rows = 3_000_000_000_000_000_000
    ids = [0, 1, 2**53 + 1, rows // 2 + 7, rows - 1]
    df = spark.createDataFrame([(i,) for i in ids], "id long").select("id", S.feistel_numbers(F.col("id"), rows, 5).alias("v"))
    for r in df.collect():
        assert divmod(r["v"], 64)[::-1] == S.locate(r["id"], rows, 64, 5)
        assert S.row_at(*S.locate(r["id"], rows, 64, 5), rows, 64, 5) == r["id"]


def test_odd_rows(spark, odd, nothing):
    got = rows_of(S.shard_rows(odd))
    docs = odd_documents()
    want = sorted(
        ((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in docs),
        key=lambda r: (r[0] is not None, r[0] or 0, r[2], r[1]),
    )
    ordered = sorted(got, key=lambda r: r["row_number"])
    assert [(r["doc_id"], r["size"], r["text_crc32"]) for r in ordered] == want
    assert [(r["shard"], r["slot"]) for r in ordered] == [S.locate(i, len(docs), 8, 20) for i in range(len(docs))]
    counts = collections.Counter(r["shard"] for r in got)
    assert max(counts.values()) - min(counts.get(s, 0) for s in range(8)) <= 1
    for shard, n in counts.items():
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(n))
    assert S.shard_rows(nothing).count() == 0
    assert S.shard_rows(odd.limit(1)).first()["slot"] == 0


def test_main_path_is_native(spark, odd):
    plan = S.shard_rows(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
