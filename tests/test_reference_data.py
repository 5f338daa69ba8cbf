"""Golden results that depend on the calls table alone (calls, rates and ids).

The calls table is built here by a rule: the fifteen golden top performers as they are, and the other
callers of every department with even shares of what its golden totals leave.  Point
``DIALSTAT_CALLS_CSV`` at the whole calls table that comes with the original reports to run the
same tests on it."""

import os

import pytest
from pyspark.sql import functions as F

from dialstat.plans import segment_breakdown, with_success_rate
from dialstat.sources import CALLS_COLUMNS, PEOPLE_COLUMNS, read_table

CALLS_CSV = os.environ.get("DIALSTAT_CALLS_CSV", "")

# Golden department totals (calls made, successful calls, rate).
GOLDEN_BREAKDOWN = {
    "HR": (9768, 6901, 70.65),
    "Finance": (10584, 7632, 72.11),
    "Games": (10716, 7647, 71.36),
    "Marketing": (9852, 6911, 70.15),
    "IT": (9117, 6561, 71.96),
}


# Callers of each department, 1,000 in all.
CALLERS = {"HR": 204, "Finance": 204, "Games": 209, "Marketing": 198, "IT": 185}


def calls_by_rule():
    rows = [r[:4] for r in GOLDEN_TOP_PERFORMERS]
    free = iter(sorted(set(range(1, 1001)) - {r[0] for r in rows}))
    for area, (made, good, _) in GOLDEN_BREAKDOWN.items():
        own = [r for r in rows if r[1] == area]
        many = CALLERS[area] - len(own)
        left = made - sum(r[2] for r in own), good - sum(r[3] for r in own)
        share = lambda total, k: total // many + (k < total % many)  # noqa: B023, E731
        rows += [(next(free), area, share(left[0], k), share(left[1], k)) for k in range(many)]
    return rows


@pytest.fixture(scope="module")
def calls(spark, tmp_path_factory):
    if CALLS_CSV:
        return read_table(spark, CALLS_CSV, CALLS_COLUMNS)
    path = tmp_path_factory.mktemp("calls") / "calls.csv"
    lines = ["id,area,calls_made,calls_successful", *(",".join(map(str, r)) for r in calls_by_rule())]
    path.write_text("\n".join(lines) + "\n")
    return read_table(spark, str(path), CALLS_COLUMNS)


def test_declared_types(calls):
    assert [f.dataType.simpleString() for f in calls.schema] == ["bigint", "string", "bigint", "bigint"]
    assert calls.count() == 1000


def test_breakdown_matches_golden_calls_and_rates(spark, calls):
    people = spark.createDataFrame([], ", ".join(f"{c} {t}" for c, t in PEOPLE_COLUMNS.items()))
    got = {
        r["area"]: (r["total_calls_made"], r["total_calls_successful"], r["percentage_of_successful_calls"])
        for r in segment_breakdown(calls, people).collect()
    }
    assert got == GOLDEN_BREAKDOWN


# The golden top-performer rows as far as the calls table decides them
# (id, area, calls made, successful calls, rate).
GOLDEN_TOP_PERFORMERS = [
    (103, "Finance", 91, 85, 93.41),
    (777, "Finance", 14, 11, 78.57),
    (357, "Finance", 71, 55, 77.46),
    (168, "Games", 10, 9, 90.0),
    (912, "Games", 78, 74, 94.87),
    (183, "Games", 5, 4, 80.0),
    (290, "HR", 85, 73, 85.88),
    (701, "HR", 61, 50, 81.97),
    (92, "HR", 83, 63, 75.9),
    (39, "IT", 70, 54, 77.14),
    (982, "IT", 60, 57, 95.0),
    (194, "IT", 64, 50, 78.13),
    (798, "Marketing", 79, 68, 86.08),
    (410, "Marketing", 68, 61, 89.71),
    (651, "Marketing", 98, 91, 92.86),
]


def test_marketing_has_198_callers(calls):
    assert calls.filter(F.col("area") == "Marketing").count() == 198


def test_golden_top_performers_pass_the_threshold_with_their_rates(calls):
    eligible = with_success_rate(calls).filter(F.col("percentage_of_successful_calls") > 75)
    rows = {r["id"]: tuple(r) for r in eligible.collect()}
    for row in GOLDEN_TOP_PERFORMERS:
        assert rows[row[0]] == row


def test_golden_rates_and_departments_from_the_golden_rows(spark):
    """The golden rows themselves: their rates, and all of them pass the threshold."""
    calls = spark.createDataFrame([r[:4] for r in GOLDEN_TOP_PERFORMERS], "id bigint, area string, calls_made bigint, calls_successful bigint")
    eligible = with_success_rate(calls).filter(F.col("percentage_of_successful_calls") > 75)
    assert {r["id"]: tuple(r) for r in eligible.collect()} == {r[0]: r for r in GOLDEN_TOP_PERFORMERS}


def test_golden_rows_are_the_top_three_of_each_department(spark):
    """Three rows per department in order of their amounts, which fall down the golden list."""
    from dialstat.plans import top_performers

    calls = spark.createDataFrame([r[:4] for r in GOLDEN_TOP_PERFORMERS], "id bigint, area string, calls_made bigint, calls_successful bigint")
    people = spark.createDataFrame([(r[0], f"p{r[0]}", 100.0 - i) for i, r in enumerate(GOLDEN_TOP_PERFORMERS)], "id bigint, name string, sales_amount double")
    sales = spark.createDataFrame([(103, "Netherlands", "x", 4)], "caller_id bigint, country string, product_sold string, quantity bigint")
    got = top_performers(calls, people, sales).collect()
    assert sorted((r["id"], r["area"], r["calls_made"], r["calls_successful"], r["percentage_of_successful_calls"]) for r in got) == sorted(GOLDEN_TOP_PERFORMERS)


def test_golden_rates_of_the_breakdown(spark):
    """Department totals as one row each give the golden rates."""
    rows = [(i, area, made, good) for i, (area, (made, good, _)) in enumerate(GOLDEN_BREAKDOWN.items())]
    calls = spark.createDataFrame(rows, "id bigint, area string, calls_made bigint, calls_successful bigint")
    people = spark.createDataFrame([], ", ".join(f"{c} {t}" for c, t in PEOPLE_COLUMNS.items()))
    got = {r["area"]: r["percentage_of_successful_calls"] for r in segment_breakdown(calls, people).collect()}
    assert got == {area: rate for area, (_, _, rate) in GOLDEN_BREAKDOWN.items()}
