"""Key filters, cut-offs of large top-n and salted lookups, against brute force and by their plans."""

import os
import random

import pytest
from pyspark.sql import functions as F

from dialstat.operators import key_filter, lookup, may_match, top_n_per_group
from dialstat.operators import keyfilter as K
from dialstat.operators import lookup as L_module  # noqa: F401  (the function; the module is below)
from dialstat.operators import ranking as R

import dialstat.operators.lookup  # noqa: F401
import sys

L = sys.modules["dialstat.operators.lookup"]
SF = "/root/testdata/sf0.1"


def test_a_filter_loses_no_row_and_drops_nearly_all_others(spark):
    keys = spark.range(0, 5000, 5).selectExpr("id AS k")
    rows = spark.range(0, 100_000).selectExpr("id AS k", "id % 7 AS v")
    kept = {r["k"] for r in may_match(rows, keys, "k").collect()}
    assert kept >= set(range(0, 5000, 5)) and len(kept) < 1100
    assert key_filter(keys, "k").count() <= 1000


def test_a_full_filter_and_one_of_other_types_and_several_keys(spark, monkeypatch):
    rows = spark.range(0, 500).selectExpr("id AS a", "CAST(id % 3 AS STRING) AS b")
    keys = spark.range(0, 500, 2).selectExpr("CAST(id AS INT) AS x", "CAST(id % 3 AS STRING) AS y")
    got = may_match(rows, keys, ["a", "b"], ["x", "y"])
    assert {r["a"] for r in got.collect()} >= set(range(0, 500, 2)) and got.count() < 300
    monkeypatch.setattr(K, "BITS", 7)  # two words: nearly everything passes, nothing is lost
    assert {r["a"] for r in may_match(rows, keys, ["a", "b"], ["x", "y"]).collect()} >= set(range(0, 500, 2))
    assert key_filter(keys, "x").count() <= 2
    assert may_match(rows, keys.limit(0), ["a", "b"], ["x", "y"]).count() == 0


def values(kind):
    rng = random.Random(kind)
    if kind == "double":
        special = [None, float("nan"), float("inf"), float("-inf"), 0.0, -0.0, 1e-9, -1e-9, 1e308, -1e308]
        return [rng.choice(special) if rng.random() < 0.1 else rng.choice([-1, 1]) * 10 ** rng.uniform(-3, 9) for _ in range(600)]
    if kind == "bigint":
        return [rng.choice([None, 0, -(2**63), 2**63 - 1, rng.randrange(-1000, 1000), rng.randrange(2**62)]) for _ in range(600)]
    return [rng.choice([None, rng.randrange(20_000)]) for _ in range(600)]


@pytest.mark.parametrize("kind", ["double", "bigint", "date"])
@pytest.mark.parametrize("order", ["-v", "v"])
def test_cutoffs_keep_the_first_n_exactly(spark, monkeypatch, kind, order):
    rows = [(random.Random(i).choice(["a", "b", None]), v, i) for i, v in enumerate(values(kind))]
    source = "bigint" if kind == "date" else kind
    df = spark.createDataFrame(rows, f"g string, v {source}, i long").repartition(3)
    if kind == "date":
        df = df.withColumn("v", F.expr("date_from_unix_date(CAST(v AS INT))"))
    want = sorted(map(str, top_n_per_group(df, "g", [order], 40, ["i"]).collect()))
    for cells in (R.CUTOFF_CELLS, 1):  # also when all groups share one cell
        monkeypatch.setattr(R, "CUTOFF_CELLS", cells)
        kept = R.within_cutoffs(df, ["g"], [order], 40)
        assert kept.count() < 600
        old = spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")
        spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "10")
        try:
            assert sorted(map(str, top_n_per_group(df, "g", [order], 40, ["i"]).collect())) == want
        finally:
            spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", old)


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_rows_behind_the_cutoff_leave_before_the_shuffle(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet").select("o_orderkey", "o_orderstatus", "o_totalprice")
    kept = R.within_cutoffs(orders, ["o_orderstatus"], ["-o_totalprice"], 1200)
    per_group = {r[0]: r[1] for r in kept.groupBy("o_orderstatus").count().collect()}
    assert len(per_group) == 3 and all(1200 <= n < 1400 for n in per_group.values())  # of 50,000 each
    plan = top_n_per_group(orders, "o_orderstatus", ["-o_totalprice"], 1200)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.rindex("Window [row_number()") : plan.index("LeftSemi")]
    assert below.count("Exchange hashpartitioning") == 1  # the first shuffle comes above the filter


def test_text_keys_and_equal_keys_are_not_cut(spark):
    df = spark.range(100).selectExpr("id % 2 AS g", "CAST(id AS STRING) AS s", "7 AS v", "id")
    assert R.within_cutoffs(df, ["g"], ["-s"], 5) is df
    assert R.within_cutoffs(df, ["g"], ["v"], 5).count() == 100


@pytest.fixture()
def large_sides(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def hot_tables(spark):
    staff = spark.range(0, 20_000).selectExpr("id", "'IT' AS area")
    people = spark.range(0, 300_000).selectExpr("IF(id < 200000, 7, id) AS id", "concat('street ', id) AS address")
    return staff, people


def test_heavy_keys_are_found_and_salted(spark, large_sides):
    staff, people = hot_tables(spark)
    pieces = L.heavy_keys(people, "id")
    assert set(pieces) == {7} and 10 <= pieces[7] <= 11  # two thirds of the rows in 16 tasks
    salted = lookup(staff, people, "id", salt_hot_keys=True)
    assert salted.columns == ["id", "area", "address"]
    plain = lookup(staff, people, "id")
    assert sorted(map(str, salted.collect())) == sorted(map(str, plain.collect()))
    per_task = [r["n"] for r in salted.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert max(per_task) < 80_000 and sum(per_task) == 219_999  # not 200,000 in one


def test_no_heavy_key_is_a_plain_join(spark, large_sides):
    staff, people = hot_tables(spark)
    out = lookup(staff, people.filter("id <> 7"), "id", salt_hot_keys=True)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 2 and "LeftOuter" in plan and "__salt" not in plan
    assert out.count() == 20_000


def test_salted_lookup_of_other_names_nulls_and_missing_keys(spark, large_sides, monkeypatch):
    monkeypatch.setattr(L, "LEAST_HEAVY", 5)
    staff = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (9, "e")], "caller long, x string")
    people = spark.createDataFrame([(1, f"p{i}") for i in range(40)] + [(2, "q"), (3, "r"), (None, "n")], "id long, name string")
    assert set(L.heavy_keys(people, "id")) == {1}
    for keep in (False, True):
        salted = lookup(staff, people, "caller", right_on="id", keep_right_key=keep, salt_hot_keys=True)
        plain = lookup(staff, people, "caller", right_on="id", keep_right_key=keep)
        assert salted.columns == plain.columns
        assert sorted(map(str, salted.collect())) == sorted(map(str, plain.collect()))
    assert lookup(staff, people.limit(0), "caller", right_on="id", salt_hot_keys=True).count() == 5
