"""Reports on hand-made rows covering the edge cases of FIXTURES.md §4."""

import pytest

from dialstat.plans import (
    best_seller_by_country,
    format_breakdown,
    postcodes,
    segment_breakdown,
    segment_top_k,
    top_performers,
    top_products_in_country,
)

CALLS = "id int, area string, calls_made int, calls_successful int"
PEOPLE = "id int, name string, address string, sales_amount double"
SALES = "caller_id int, country string, product_sold string, quantity int"


@pytest.fixture()
def calls(frames):
    return frames(
        [
            (1, "IT", 0, 0),  # zero calls: null rate
            (2, "IT", 100, 75),  # exactly 75: out
            (3, "IT", 80000, 60003),  # 75.00375 rounds to 75.0: out
            (4, "IT", 64, 50),  # 78.125 -> 78.13: in
            (5, "IT", 10, 9),  # 90: in
            (6, "IT", 10, 8),  # 80: in, same amount as 5
            (7, "HR", 10, 10),  # in, no person row
            (8, None, 5, 1),  # null area
            (9, "HR", 10, 9),
        ],
        CALLS,
    )


@pytest.fixture()
def people(frames):
    return frames(
        [
            (1, "A", "Jetlaan 1, 8779 EM, X", 100.0),
            (2, "B", "8779EM", 200.0),
            (3, "C", "8779 em", 300.0),
            (4, "D", "no code", 50.0),
            (5, "E", None, 500.0),
            (6, "F", "Weg 2, 1234 AB, Y", 500.0),
            (8, "H", "Pad 3, 4321 XZ, Z", 80.0),
            (9, "I", "Laan 4, 1111 AA, Q", 90.0),
            (9, "I2", "Laan 5, 2222 BB, Q", 10.0),  # duplicate person id
        ],
        PEOPLE,
    )


@pytest.fixture()
def sales(frames):
    return frames(
        [
            (5, "NL", "p1", 10),
            (5, "NL", "p2", 3),
            (6, "NL", "p1", 4),
            (4, "NL", "p3", 20),
            (99, "NL", "p1", 7),  # unknown caller: null-area group
            (7, "BE", "p1", 50),  # best seller of BE has no person row
            (5, "BE", "p2", 1),
            (9, "DE", "p4", 2),
        ],
        SALES,
    )


def test_segment_top_k_keeps_callers_without_person_last(calls, people):
    out = segment_top_k(calls, people, area="HR", k=10).collect()
    assert [r["id"] for r in out] == [9, 9, 7]
    assert out[-1]["name"] is None and out[-1]["sales_amount"] is None
    assert segment_top_k(calls, people, area="IT", k=3).columns == ["id", "area", "name", "address", "sales_amount"]


def test_segment_top_k_tie_on_amount_breaks_by_id(calls, people):
    top = segment_top_k(calls, people, area="IT", k=2).collect()
    assert [r["id"] for r in top] == [5, 6]


def test_postcodes(calls, people):
    out = {r["id"]: (r["address"], r["zip_code"]) for r in postcodes(calls, people, area="IT").collect()}
    assert out[1][1] == "8779 EM"
    assert out[2][1] == "8779EM"
    assert out[3][1] == ""
    assert out[4][1] == ""
    assert out[5] == (None, None)


def test_segment_breakdown_null_area_and_duplicate_person(calls, people):
    rows = {r["area"]: r for r in segment_breakdown(calls, people).collect()}
    hr = rows["HR"]
    # id 9 has two person rows: its calls count once, its amounts twice.
    assert (hr["total_calls_made"], hr["total_calls_successful"]) == (20, 19)
    assert hr["percentage_of_successful_calls"] == 95.0
    assert hr["total_sales_amount"] == 100
    assert rows[None]["total_calls_made"] == 5 and rows[None]["total_sales_amount"] is None
    text = {r["area"]: r["total_sales_amount"] for r in format_breakdown(segment_breakdown(calls, people)).collect()}
    assert text["IT"] == "1,650.00" and text[None] is None


def test_top_performers_threshold_ties_and_units(calls, people, sales):
    out = top_performers(calls, people, sales, n=3, threshold=75).collect()
    got = [(r["area"], r["id"], r["percentage_of_successful_calls"], r["count_products_sold"]) for r in out]
    it = sorted((g for g in got if g[0] == "IT"), key=lambda g: g[1])
    # 1 (null rate), 2 (75.0) and 3 (75.00375 -> 75.0) are out; 5 and 6 tie on amount.
    assert [g[1] for g in it] == [4, 5, 6]
    assert {g[1]: g[3] for g in it} == {4: 20, 5: 14, 6: 4}
    # 7 has no person row (inner join), 9 has two person rows (one per name).
    hr = sorted(g[1] for g in got if g[0] == "HR")
    assert hr == [9, 9]


def test_top_performers_order_within_department(calls, people, sales):
    ranked = top_performers(calls, people, sales, n=1, threshold=75).collect()
    it = [r for r in ranked if r["area"] == "IT"]
    # 5 and 6 share the top amount: the lower rate (6, 80.0) wins.
    assert [r["id"] for r in it] == [6]


def test_top_products_in_country_unknown_caller_group(calls, sales):
    out = top_products_in_country(calls, sales, country="NL", n=3).collect()
    got = sorted((r["area"] or "", r["product_sold"], r["total_products_sold"]) for r in out)
    assert got == [("", "p1", 7), ("IT", "p1", 14), ("IT", "p2", 3), ("IT", "p3", 20)]


def test_best_seller_without_person_removes_country(people, sales):
    out = {r["country"]: (r["caller_id"], r["total_products_sold"], r["name"]) for r in best_seller_by_country(people, sales).collect()}
    assert "BE" not in out
    assert out["NL"] == (4, 20, "D")
    assert out["DE"][0] == 9


def test_report_columns(calls, people, sales):
    assert top_performers(calls, people, sales).columns == [
        "id",
        "name",
        "sales_amount",
        "area",
        "calls_made",
        "calls_successful",
        "percentage_of_successful_calls",
        "caller_id",
        "count_products_sold",
    ]
    assert best_seller_by_country(people, sales).columns == [
        "caller_id",
        "country",
        "total_products_sold",
        "name",
        "sales_amount",
    ]
    assert top_products_in_country(calls, sales, "NL").columns == ["area", "product_sold", "total_products_sold"]
    assert postcodes(calls, people, "IT").columns == ["id", "address", "zip_code"]


def test_top_products_counts_every_copy_of_a_caller(frames, sales):
    calls = frames([(5, "IT", 1, 1), (5, "IT", 1, 1), (5, "HR", 1, 1), (6, "IT", 1, 1)], CALLS)
    out = {
        (r["area"], r["product_sold"]): r["total_products_sold"]
        for r in top_products_in_country(calls, sales, country="NL", n=5).collect()
    }
    # Caller 5 appears twice in IT and once in HR: its units count twice in IT, once in HR.
    assert out[("IT", "p1")] == 2 * 10 + 4
    assert out[("IT", "p2")] == 2 * 3
    assert out[("HR", "p1")] == 10
    assert out[(None, "p1")] == 7 and out[(None, "p3")] == 20


def test_whole_frames_with_assert_dataframe_equal(spark, calls, people, sales):
    from pyspark.testing import assertDataFrameEqual

    expected_r6 = spark.createDataFrame(
        [(4, "NL", 20, "D", 50.0), (9, "DE", 2, "I", 90.0), (9, "DE", 2, "I2", 10.0)],
        "caller_id int, country string, total_products_sold bigint, name string, sales_amount double",
    )
    assertDataFrameEqual(best_seller_by_country(people, sales), expected_r6)

    expected_r5 = spark.createDataFrame(
        [(None, "p1", 7), ("IT", "p3", 20), ("IT", "p1", 14), ("IT", "p2", 3)],
        "area string, product_sold string, total_products_sold bigint",
    )
    assertDataFrameEqual(top_products_in_country(calls, sales, country="NL"), expected_r5)

    expected_r2 = spark.createDataFrame(
        [(7, None, None), (9, "Laan 4, 1111 AA, Q", "1111 AA"), (9, "Laan 5, 2222 BB, Q", "2222 BB")],
        "id int, address string, zip_code string",
    )
    assertDataFrameEqual(postcodes(calls, people, area="HR"), expected_r2)


def test_top_performer_without_sales_keeps_null_units(frames, people):
    calls = frames([(1, "IT", 10, 9), (2, "IT", 10, 9)], CALLS)
    sales = frames([(2, "NL", "p1", 5)], SALES)
    out = {r["id"]: (r["caller_id"], r["count_products_sold"]) for r in top_performers(calls, people, sales).collect()}
    assert out == {1: (None, None), 2: (2, 5)}


def test_amounts_are_rounded_once(frames):
    calls = frames([(1, "IT", 1, 1), (2, "IT", 1, 1), (3, "HR", 1, 1)], CALLS)
    people = frames([(1, "A", "x", 0.125), (2, "B", "x", 0.125), (3, "C", "x", 1e17)], PEOPLE)
    text = {r["area"]: r["total_sales_amount"] for r in format_breakdown(segment_breakdown(calls, people)).collect()}
    assert text == {"IT": "0.25", "HR": "100,000,000,000,000,000.00"}


@pytest.mark.parametrize("amount", [float("nan"), float("inf"), 1e18])
def test_what_is_no_amount_raises(frames, amount):
    calls = frames([(1, "IT", 1, 1)], CALLS)
    people = frames([(1, "A", "x", amount)], PEOPLE)
    with pytest.raises(Exception, match="not an amount"):
        segment_breakdown(calls, people).collect()


def test_top_k_counts_every_copy_on_either_side(frames):
    calls = frames([(1, "IT", 1, 1)] * 3 + [(2, "IT", 1, 1), (None, "IT", 1, 1)], CALLS)
    people = frames([(1, "A", "x", 5.0), (1, "A", "x", 5.0), (1, "B", "x", None), (2, "C", "y", 7.0)], PEOPLE)
    for k in (0, 1, 3, 5, 20):
        got = [(r["id"], r["name"], r["sales_amount"]) for r in segment_top_k(calls, people, k=k).collect()]
        want = [(2, "C", 7.0)] + [(1, "A", 5.0)] * 6 + [(None, None, None)] + [(1, "B", None)] * 3
        assert got == want[:k]
