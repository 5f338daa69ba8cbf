"""Property tests: operators against brute force in plain Python on random small inputs."""

from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from dialstat.functions import percentage
from dialstat.operators import lookup, top_k, top_n_per_group

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

groups = st.sampled_from(["a", "b", "c", None])
values = st.one_of(st.none(), st.integers(min_value=-3, max_value=3))
rows = st.lists(st.tuples(groups, values), min_size=0, max_size=25)


def _key_desc_nulls_last(v):
    return (v is None, -(v or 0))


@SETTINGS
@given(data=rows, n=st.integers(min_value=1, max_value=4))
def test_top_n_per_group_matches_brute_force(frames, data, n):
    with_ids = [(g, v, i) for i, (g, v) in enumerate(data)]
    df = frames(with_ids, "g string, v int, id int")
    got = sorted(
        (tuple(r) for r in top_n_per_group(df, "g", ["-v"], n, tie_break=["id"]).collect()), key=str
    )
    want = []
    for g in {r[0] for r in with_ids}:
        members = sorted((r for r in with_ids if r[0] == g), key=lambda r: (_key_desc_nulls_last(r[1]), r[2]))
        want.extend(members[:n])
    assert got == sorted(want, key=str)


@SETTINGS
@given(data=rows, k=st.integers(min_value=0, max_value=30))
def test_top_k_matches_brute_force(frames, data, k):
    with_ids = [(g, v, i) for i, (g, v) in enumerate(data)]
    df = frames(with_ids, "g string, v int, id int")
    got = [tuple(r) for r in top_k(df, ["-v"], k, tie_break=["id"]).collect()]
    want = sorted(with_ids, key=lambda r: (_key_desc_nulls_last(r[1]), r[2]))[:k]
    assert got == want


keys = st.one_of(st.none(), st.integers(min_value=0, max_value=4))


@SETTINGS
@given(
    left=st.lists(keys, max_size=12),
    right=st.lists(st.tuples(keys, st.integers(min_value=0, max_value=9)), max_size=30),
)
def test_split_left_lookup_matches_nested_loop(frames, left, right):
    ldf = frames([(k, i) for i, k in enumerate(left)], "id int, pos int")
    rdf = frames(right, "id int, amount int")
    got = sorted((tuple(r) for r in lookup(ldf, rdf, "id", how="left", split_hot_keys=True).collect()), key=str)
    want = []
    for pos, k in enumerate(left):
        hits = [a for rk, a in right if k is not None and rk == k]
        want.extend((k, pos, a) for a in hits) if hits else want.append((k, pos, None))
    assert got == sorted(want, key=str)


@SETTINGS
@given(
    pairs=st.lists(
        st.tuples(st.integers(min_value=0, max_value=100_000), st.integers(min_value=0, max_value=100_000)),
        min_size=1,
        max_size=20,
    )
)
def test_percentage_rounds_half_up_like_exact_arithmetic(frames, pairs):
    data = [(min(s, m), m) for s, m in pairs]
    df = frames(data, "s int, m int")
    got = [r[0] for r in df.select(percentage("s", "m")).collect()]
    for (s, m), value in zip(data, got):
        if m == 0:
            assert value is None
            continue
        exact = Fraction(100 * s, m)
        rounded = Decimal(exact.numerator) / Decimal(exact.denominator)
        assert value == float(rounded.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))


@SETTINGS
@given(
    calls=st.lists(
        st.tuples(
            st.integers(min_value=0, max_value=6),
            st.sampled_from(["IT", "HR", None]),
            st.integers(min_value=0, max_value=9),
            st.integers(min_value=0, max_value=9),
        ),
        max_size=15,
    ),
    people=st.lists(
        st.tuples(st.integers(min_value=0, max_value=6), st.one_of(st.none(), st.sampled_from([-3.5, 0.25, 10.0]))),
        max_size=15,
    ),
)
def test_one_pass_breakdown_equals_join_of_two_aggregates(frames, calls, people):
    from pyspark.sql import functions as F

    from dialstat.functions import money_sum
    from dialstat.operators import join_aggregates, ratio_of_sums
    from dialstat.plans import segment_breakdown

    calls_df = frames([(i, a, max(m, s), min(m, s)) for i, a, m, s in calls], "id int, area string, calls_made int, calls_successful int")
    people_df = frames(people, "id int, sales_amount double")
    one_pass = segment_breakdown(calls_df, people_df.withColumn("name", F.lit("n")).withColumn("address", F.lit("a")))
    per_area_calls = ratio_of_sums(
        calls_df, "area", "calls_successful", "calls_made", "percentage_of_successful_calls",
        "total_calls_successful", "total_calls_made",
    )
    per_area_sales = (
        calls_df.select("id", "area").join(people_df, "id", "left").drop("id")
        .groupBy("area").agg(money_sum("sales_amount").alias("total_sales_amount"))
    )
    two_aggregates = join_aggregates(per_area_calls, per_area_sales, "area")
    cols = sorted(one_pass.columns)
    assert cols == sorted(two_aggregates.columns)
    norm = lambda df: sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)
    assert norm(one_pass) == norm(two_aggregates)


@SETTINGS
@given(
    calls=st.lists(st.tuples(st.integers(min_value=0, max_value=5), st.sampled_from(["IT", "HR", None])), max_size=12),
    sales=st.lists(
        st.tuples(
            st.integers(min_value=0, max_value=7),
            st.sampled_from(["NL", "BE"]),
            st.sampled_from(["p1", "p2", "p3"]),
            st.integers(min_value=0, max_value=9),
        ),
        max_size=20,
    ),
)
def test_copy_weighted_products_equal_plain_left_join(frames, calls, sales):
    from pyspark.sql import functions as F

    from dialstat.plans import top_products_in_country

    calls_df = frames([(i, a, 1, 1) for i, a in calls], "id int, area string, calls_made int, calls_successful int")
    sales_df = frames(sales, "caller_id int, country string, product_sold string, quantity int")
    got = top_products_in_country(calls_df, sales_df, country="NL", n=100)
    plain = (
        sales_df.filter(F.col("country") == "NL")
        .join(calls_df.select(F.col("id").alias("caller_id"), "area"), "caller_id", "left")
        .groupBy("area", "product_sold")
        .agg(F.sum("quantity").alias("total_products_sold"))
    )
    norm = lambda df: sorted((tuple(r) for r in df.select("area", "product_sold", "total_products_sold").collect()), key=str)
    assert norm(got) == norm(plain)


@SETTINGS
@given(
    calls=st.lists(
        st.tuples(st.integers(min_value=0, max_value=6), st.sampled_from(["IT", "HR", None]),
                  st.integers(min_value=0, max_value=8), st.integers(min_value=0, max_value=8)),
        max_size=12,
    ),
    people=st.lists(st.tuples(st.integers(min_value=0, max_value=6), st.sampled_from([1.0, 5.0, 9.5, None])), max_size=12),
    sales=st.lists(st.tuples(st.integers(min_value=0, max_value=8), st.integers(min_value=0, max_value=5)), max_size=15),
    n=st.integers(min_value=1, max_value=3),
)
def test_rank_then_units_equals_units_for_everyone(frames, calls, people, sales, n):
    from pyspark.sql import functions as F

    from dialstat.operators import lookup, sums_by, top_n_per_group
    from dialstat.plans import top_performers, with_success_rate

    calls_df = frames([(i, a, max(m, s), min(m, s)) for i, a, m, s in calls], "id int, area string, calls_made int, calls_successful int")
    people_df = frames([(i, f"p{i}", "addr", v) for i, v in people], "id int, name string, address string, sales_amount double")
    sales_df = frames([(c, "NL", "p", q) for c, q in sales], "caller_id int, country string, product_sold string, quantity int")
    got = top_performers(calls_df, people_df, sales_df, n=n, threshold=50)

    eligible = lookup(
        people_df.select("id", "name", "sales_amount"),
        with_success_rate(calls_df).filter(F.col("percentage_of_successful_calls") > 50),
        "id",
        how="inner",
    )
    ranked = top_n_per_group(eligible, "area", ["-sales_amount", "percentage_of_successful_calls"], n)
    units = sums_by(sales_df, "caller_id", {"count_products_sold": "quantity"})
    want = lookup(ranked, units, "id", right_on="caller_id", how="left", keep_right_key=True)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


@SETTINGS
@given(
    left=st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(min_value=0, max_value=9)), max_size=10),
    right=st.lists(st.tuples(st.sampled_from(["a", "c", None]), st.integers(min_value=0, max_value=9)), max_size=10),
)
def test_join_aggregates_matches_brute_force(frames, left, right):
    from dialstat.operators import join_aggregates, sums_by

    lsum = sums_by(frames(left, "k string, v int"), "k", {"lv": "v"})
    rsum = sums_by(frames(right, "k string, v int"), "k", {"rv": "v"})
    got = sorted(map(tuple, join_aggregates(lsum, rsum, "k").collect()), key=str)
    ltot, rtot = {}, {}
    for k, v in left:
        ltot[k] = ltot.get(k, 0) + v
    for k, v in right:
        rtot[k] = rtot.get(k, 0) + v
    want = sorted(((k, v, rtot.get(k) if k is not None else None) for k, v in ltot.items()), key=str)
    assert got == want
