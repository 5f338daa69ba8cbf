import pytest
from pyspark.sql import functions as F

from dialstat.functions import money_sum
from dialstat.operators import (
    distinct_values,
    join_aggregates,
    lookup,
    ratio_of_sums,
    row_counts,
    sums_by,
    top_k,
    top_n_per_group,
)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def people(frames):
    return frames(
        [(1, "Ann", 10.0), (2, "Bob", None), (3, "Cy", 30.0)],
        "id int, name string, sales_amount double",
    )


def test_left_lookup_keeps_unmatched_rows(frames, people):
    calls = frames([(1, "IT"), (4, "IT")], "id int, area string")
    out = lookup(calls, people, "id", how="left")
    assert out.columns == ["id", "area", "name", "sales_amount"]
    assert sorted(out.collect()) == [(1, "IT", "Ann", 10.0), (4, "IT", None, None)]


def test_lookup_with_differently_named_keys(frames, people):
    sales = frames([(3, 5), (9, 1)], "caller_id int, quantity int")
    out = lookup(sales, people, "caller_id", right_on="id", how="left", columns=["name"])
    assert out.columns == ["caller_id", "quantity", "name"]
    assert sorted(out.collect(), key=lambda r: r[0]) == [(3, 5, "Cy"), (9, 1, None)]


def test_lookup_inner_and_keep_right_key(frames, people):
    sums = frames([(1, 7)], "caller_id int, units int")
    out = lookup(people, sums, "id", right_on="caller_id", how="left", keep_right_key=True)
    assert out.columns == ["id", "name", "sales_amount", "caller_id", "units"]
    rows = {r["id"]: (r["caller_id"], r["units"]) for r in out.collect()}
    assert rows == {1: (1, 7), 2: (None, None), 3: (None, None)}
    inner = lookup(people, sums, "id", right_on="caller_id", how="inner")
    assert [r["id"] for r in inner.collect()] == [1]


def test_lookup_rejects_clashing_columns(people):
    with pytest.raises(ValueError):
        lookup(people, people.select("id", "name"), "id")


def test_sums_and_counts(frames):
    df = frames(
        [("a", "x", 1, 2.5), ("a", "y", 2, 0.5), ("b", "x", 3, None)],
        "k1 string, k2 string, n int, amount double",
    )
    one = {r["k1"]: (r["n"], r["amount"]) for r in sums_by(df, "k1", {"n": "n", "amount": money_sum("amount")}).collect()}
    assert one["a"][0] == 3 and one["a"][1] == 3
    assert one["b"] == (3, None)
    two = sums_by(df, ["k1", "k2"], {"n": "n"})
    assert two.count() == 3
    counts = {r["k1"]: r["count"] for r in row_counts(df, ["k1"]).collect()}
    assert counts == {"a": 2, "b": 1}


def test_ratio_of_sums_is_not_mean_of_ratios(frames):
    df = frames([("a", 1, 1), ("a", 1, 3), ("z", 0, 0)], "area string, s int, m int")
    out = {
        r["area"]: r["rate"]
        for r in ratio_of_sums(df, "area", "s", "m", "rate", "s_total", "m_total").collect()
    }
    assert out == {"a": 50.0, "z": None}


def test_join_aggregates_null_key_gets_no_partner(frames):
    left = frames([("a", 1), (None, 2)], "area string, calls int")
    right = frames([("a", 10.0), (None, 20.0)], "area string, amount double")
    out = sorted(join_aggregates(left, right, "area").collect(), key=lambda r: (r[0] is None, r[0] or ""))
    assert out == [("a", 1, 10.0), (None, 2, None)]


def test_distinct_values(frames):
    df = frames([("NL",), ("BE",), ("NL",)], "country string")
    assert sorted(r[0] for r in distinct_values(df, ["country"]).collect()) == ["BE", "NL"]


def test_top_k_orders_nulls_last_and_breaks_ties(frames):
    df = frames(
        [(1, 5.0), (2, None), (3, 7.0), (4, 5.0), (5, 1.0)], "id int, sales_amount double"
    )
    out = top_k(df, ["-sales_amount"], 3)
    assert [r["id"] for r in out.collect()] == [3, 1, 4]
    assert [r["id"] for r in top_k(df, ["-sales_amount"], 10).collect()] == [3, 1, 4, 5, 2]
    assert "TakeOrderedAndProject" in _plan(out)


def test_top_n_per_group_with_null_group_and_ties(frames):
    df = frames(
        [("IT", 1, 9.0), ("IT", 2, 9.0), ("IT", 3, 8.0), (None, 4, 1.0), ("HR", 5, 3.0)],
        "area string, id int, amount double",
    )
    out = top_n_per_group(df, "area", ["-amount"], 2, tie_break=["id"], rank_column="rank")
    got = sorted((r["area"] or "", r["id"], r["rank"]) for r in out.collect())
    assert got == [("", 4, 1), ("HR", 5, 1), ("IT", 1, 1), ("IT", 2, 2)]


def test_top_n_two_keys_second_ascending(frames):
    df = frames(
        [("IT", 1, 9.0, 80.0), ("IT", 2, 9.0, 76.0), ("IT", 3, 9.0, 76.0)],
        "area string, id int, amount double, rate double",
    )
    out = top_n_per_group(df, "area", ["-amount", "rate"], 2, tie_break=["id"])
    assert [r["id"] for r in out.orderBy("id").collect()] == [2, 3]


def test_top_n_plan_has_partial_group_limit(frames):
    df = frames([("a", i, float(i)) for i in range(50)], "g string, id int, v double")
    out = top_n_per_group(df, "g", ["-v"], 3, tie_break=["id"])
    out.collect()
    plan = _plan(out)
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert "CartesianProduct" not in plan


def test_top_n_above_group_limit_threshold_is_exact(spark, frames):
    rows = [("hot" if i % 3 else "cold", i, float((i * 37) % 101)) for i in range(3000)]
    df = frames(rows, "g string, id int, v double")
    expected = top_n_per_group(df, "g", ["-v"], 40, tie_break=["id"])
    want = sorted(tuple(r) for r in expected.collect())
    old = spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "10")
    try:
        salted = top_n_per_group(df, "g", ["-v"], 40, tie_break=["id"])
        got = sorted(tuple(r) for r in salted.collect())
    finally:
        spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", old)
    assert got == want and len(got) == 80


def test_top_n_rejects_bad_n(frames):
    df = frames([("a", 1)], "g string, v int")
    with pytest.raises(ValueError):
        top_n_per_group(df, "g", ["-v"], 0)
    with pytest.raises(ValueError):
        top_k(df, ["-v"], -1)


def test_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.range(100).select(F.col("id"), (F.col("id") % 5).cast("string").alias("area")).write.parquet(path)
    df = spark.read.parquet(path).filter(F.col("area") == "3").select("id")
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(area), EqualTo(area,3)]" in plan


def test_split_hot_keys_equals_left_join(frames):
    left = frames([(1, "a"), (2, "b"), (None, "c"), (4, "d"), (1, "e")], "id int, tag string")
    right = frames([(1, 10.0)] * 50 + [(2, None), (3, 30.0)], "id int, amount double")
    plain = lookup(left, right, "id", how="left")
    split = lookup(left, right, "id", how="left", split_hot_keys=True)
    assert split.columns == plain.columns
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(map(tuple, split.collect()), key=key) == sorted(map(tuple, plain.collect()), key=key)
    assert split.count() == 103


def test_split_hot_keys_with_renamed_keys(frames):
    sales = frames([(7, 1), (8, 2)], "caller_id int, units int")
    calls = frames([(7, "IT"), (7, "IT"), (9, "HR")], "id int, area string")
    out = lookup(sales, calls, "caller_id", right_on="id", how="left", columns=["area"], split_hot_keys=True)
    assert out.columns == ["caller_id", "units", "area"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(7, 1, "IT"), (7, 1, "IT"), (8, 2, None)], key=str)


def test_split_hot_keys_with_kept_right_key(frames):
    people = frames([(1, "A"), (2, "B")], "id int, name string")
    units = frames([(1, 5), (1, 6)], "caller_id int, units int")
    plain = lookup(people, units, "id", right_on="caller_id", how="left", keep_right_key=True)
    split = lookup(people, units, "id", right_on="caller_id", how="left", keep_right_key=True, split_hot_keys=True)
    assert split.columns == plain.columns == ["id", "name", "caller_id", "units"]
    assert sorted(map(tuple, split.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_semi_and_anti_lookups(frames, people):
    calls = frames([(1, "IT"), (4, "IT")], "id int, area string")
    assert [r["id"] for r in lookup(calls, people, "id", how="left_semi").collect()] == [1]
    assert [r["id"] for r in lookup(calls, people, "id", how="left_anti").collect()] == [4]


def test_salted_top_n_with_identical_rows_in_hot_group(spark, frames):
    rows = [("hot", 1.0)] * 1500 + [("hot", float(i)) for i in range(30)] + [("cold", 2.0)] * 5
    df = frames(rows, "g string, v double").repartition(6)
    want = sorted(tuple(r) for r in top_n_per_group(df, "g", ["-v"], 12).collect())
    old = spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "5")
    try:
        got = sorted(tuple(r) for r in top_n_per_group(df, "g", ["-v"], 12).collect())
    finally:
        spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", old)
    assert got == want
    assert len(got) == 17


def test_broadcast_if_small_checks_size(frames):
    from dialstat.operators import broadcast_if_small

    small = frames([(i,) for i in range(5)], "k int")
    big = frames([(i,) for i in range(50)], "k int")
    fact = frames([(i % 5, i) for i in range(100)], "k int, v int")
    hinted = fact.join(broadcast_if_small(small, 10), "k")
    assert "BroadcastHashJoin" in _plan(hinted)
    assert broadcast_if_small(big, 10) is big
