"""The six reports (R1-R6) as compositions of the operators, plus their registry.

Inputs are the three report tables:

* ``calls``  (id, area, calls_made, calls_successful)
* ``people`` (id, name, address, sales_amount)
* ``sales``  (caller_id, country, product_sold, quantity)

Each builder returns a lazy DataFrame; nothing is computed until an action.  Builders return
numbers; presentation (money as text) is a separate step so gates can test the numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialstat.functions.scalars import money_sum, money_text, percentage, postcode
from dialstat.operators.aggregate import sums_by
from dialstat.operators.keyfilter import may_match
from dialstat.operators.lookup import lookup
from dialstat.operators.quality import Gate
from dialstat.operators.ranking import top_k, top_n_per_group

RATE = "percentage_of_successful_calls"


def with_success_rate(calls: DataFrame, digits: int = 2) -> DataFrame:
    """Add the rounded success rate of each caller (X1, X2, P4); null for zero calls."""
    return calls.withColumn(RATE, percentage("calls_successful", "calls_made", digits))


def segment_top_k(calls: DataFrame, people: DataFrame, area: str = "IT", k: int = 100) -> DataFrame:
    """The ``k`` best sellers of one department, with their person data.

    Callers without a person row stay, with nulls, and sort last.  Rows of one id differ only
    in their person data, so an id's ``k`` best person rows and ``k`` copies of a caller are all
    that can reach the result: both sides are cut to that before the join (where they are read,
    for any ``k`` under the group limit threshold), and no id is hot.  Person rows of other
    departments leave where they are read, by a filter of the department's ids.
    Columns: id, area, name, address, sales_amount.
    """
    staff = (
        calls.filter(F.col("area") == area)
        .groupBy("id")
        .agg(F.lit(area).alias("area"), F.least(F.count(F.lit(1)), F.lit(k).cast("long")).cast("int").alias("copies"))
    )
    # The condition holds for every row; it makes the filter read the counts that the lookup reads.
    wanted = may_match(people.select("id", "name", "address", "sales_amount"), staff.filter("copies >= 0"), "id")
    persons = top_n_per_group(wanted, "id", ["-sales_amount"], max(k, 1), ["name", "address"])
    enriched = lookup(staff, persons, "id", how="left")
    # The first k of the joined rows hold the first k of their copies.
    best = top_k(enriched, ["-sales_amount"], k, tie_break=["id", "name", "address"])
    copied = best.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copies", "copy")
    return top_k(copied, ["-sales_amount"], k, tie_break=["id", "name", "address"])


def postcodes(calls: DataFrame, people: DataFrame, area: str = "Marketing") -> DataFrame:
    """R2: address and postcode of everyone in one department.

    Columns: id, address, zip_code (``''`` when the address has no postcode, null when there
    is no address).  Where the people table is not small, its heavy ids are looked for when the
    report is built (see ``lookup``).
    """
    staff = calls.filter(F.col("area") == area).select("id")
    enriched = lookup(staff, people, "id", how="left", columns=["address"], salt_hot_keys=True)
    return enriched.withColumn("zip_code", postcode("address"))


def segment_breakdown(calls: DataFrame, people: DataFrame) -> DataFrame:
    """Per department the calls, the successful calls, their rate and the sales total.

    Calls are counted from ``calls`` alone; a person id that occurs twice adds its amount
    twice but never repeats a caller's calls: people are summed per id first, so the join
    cannot fan out.  One pass over ``calls``, one join on ``id``, one aggregate.  A null
    department keeps its own row but gets no sales total (it matches no department).
    Columns: area, total_calls_made, total_calls_successful, percentage_of_successful_calls,
    total_sales_amount (exact decimal with ten decimals; see ``format_breakdown``).
    """
    per_person = sums_by(people, "id", {"person_sales": money_sum("sales_amount")})
    rows = lookup(
        calls.select("id", "area", "calls_made", "calls_successful"), per_person, "id", how="left"
    )
    per_area = rows.groupBy("area").agg(
        F.sum("calls_made").alias("total_calls_made"),
        F.sum("calls_successful").alias("total_calls_successful"),
        F.sum("person_sales").alias("person_sales"),
    )
    return per_area.select(
        "area",
        "total_calls_made",
        "total_calls_successful",
        percentage("total_calls_successful", "total_calls_made").alias(RATE),
        F.when(F.col("area").isNotNull(), F.col("person_sales")).alias("total_sales_amount"),
    )


def format_breakdown(df: DataFrame) -> DataFrame:
    """R3 presentation: the sales total, rounded here for the first time (half to even), as text
    with thousands separators (X3)."""
    return df.withColumn("total_sales_amount", money_text("total_sales_amount", 2))


def top_performers(
    calls: DataFrame,
    people: DataFrame,
    sales: DataFrame,
    n: int = 3,
    threshold: float = 75,
) -> DataFrame:
    """Per department the ``n`` best sellers among callers whose rounded success rate is
    above ``threshold``, with the units they sold.

    Order: sales amount descending, then rate ascending, then id (and the remaining columns).
    Units do not affect the ranking, so they are summed only for the ranked callers: the
    sales table first goes through a filter of their ids (Catalyst pushes it below the sales
    joins) instead of aggregating every caller's units.  Whoever passes it without being ranked is
    dropped by the lookup.
    Columns: id, name, sales_amount, area, calls_made, calls_successful,
    percentage_of_successful_calls, caller_id, count_products_sold.
    """
    eligible_calls = with_success_rate(calls).filter(F.col(RATE) > threshold)
    eligible = lookup(people.select("id", "name", "sales_amount"), eligible_calls, "id", how="inner")
    # Tie-break on every remaining column: both uses of ``ranked`` below then need the same
    # columns under the window, so Spark reuses its shuffle instead of running it twice.
    ranked = top_n_per_group(eligible, "area", ["-sales_amount", RATE], n)
    of_ranked = may_match(sales.select("caller_id", "quantity"), ranked, "caller_id", "id")
    units = sums_by(of_ranked, "caller_id", {"count_products_sold": "quantity"})
    return lookup(ranked, units, "id", right_on="caller_id", how="left", keep_right_key=True)


def top_products_in_country(calls: DataFrame, sales: DataFrame, country: str = "Netherlands", n: int = 3) -> DataFrame:
    """Per department the ``n`` products sold most (in units) in one country.

    Sales by callers without a department land in a null department with its own top n.
    Sales are summed per (caller, product) before the join with ``calls``, so the join sees
    one row per pair instead of one per sale.  ``calls`` is reduced to one row per (id, area)
    with the number of copies, and units are weighted by it: the same totals as joining
    every copy, but a caller id repeated many times in ``calls`` cannot fan out in one task.
    Columns: area, product_sold, total_products_sold.
    """
    local = sums_by(
        sales.filter(F.col("country") == country), ["caller_id", "product_sold"], {"units": "quantity"}
    )
    copies = calls.groupBy("id", "area").agg(F.count(F.lit(1)).alias("copies"))
    with_area = lookup(local, copies, "caller_id", right_on="id", how="left")
    weighted = F.col("units") * F.coalesce(F.col("copies"), F.lit(1))
    per_area = sums_by(with_area, ["area", "product_sold"], {"total_products_sold": F.sum(weighted)})
    return top_n_per_group(per_area, "area", ["-total_products_sold"], n, tie_break=["product_sold"])


def best_seller_by_country(people: DataFrame, sales: DataFrame, n: int = 1) -> DataFrame:
    """Per country the ``n`` callers with the most units sold, with name and amount.

    Ranking comes first and the person lookup after (an inner join): a best seller without a
    person row removes its country rather than promoting the runner-up.  No side is hinted for
    broadcast: adaptive execution decides after it has measured the ranked rows.
    Columns: caller_id, country, total_products_sold, name, sales_amount.
    """
    per_caller = sums_by(sales, ["caller_id", "country"], {"total_products_sold": "quantity"})
    best = top_n_per_group(per_caller, "country", ["-total_products_sold"], n, tie_break=["caller_id"])
    return lookup(best, people, "caller_id", right_on="id", how="inner", columns=["name", "sales_amount"])


# Fixed values that must equal the reference's: each report's output folder and default
# parameters.
OUTPUT_FOLDERS = {
    "segment_top_k": "it_data",
    "postcodes": "marketing_address_info",
    "segment_breakdown": "department_breakdown",
    "top_performers": "top_3",
    "top_products_in_country": "top_3_most_sold_per_department_netherlands",
    "best_seller_by_country": "best_salesperson",
}
DEFAULT_PARAMS = {
    "segment_top_k": {"area": "IT", "k": 100},
    "postcodes": {"area": "Marketing"},
    "segment_breakdown": {},
    "top_performers": {"n": 3, "threshold": 75},
    "top_products_in_country": {"country": "Netherlands", "n": 3},
    "best_seller_by_country": {"n": 1},
}


@dataclass(frozen=True)
class Report:
    """How to build, check and write one report.

    ``single_file``: the report's parameters bound its rows (a top-k, or n rows per group).
    """

    name: str
    output: str
    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]
    gate: Callable[[Mapping[str, object]], Gate]
    defaults: Mapping[str, object] = field(default_factory=dict)
    present: Callable[[DataFrame], DataFrame] | None = None
    order: tuple[str, ...] = ()
    single_file: bool = True


REPORTS: dict[str, Report] = {
    r.name: r
    for r in [
        Report(
            "segment_top_k",
            OUTPUT_FOLDERS["segment_top_k"],
            ("calls", "people"),
            segment_top_k,
            lambda p: Gate(bad={"negative sales_amount": "sales_amount < 0"}, unique=[["id"]]),
            DEFAULT_PARAMS["segment_top_k"],
            order=("-sales_amount", "id"),
        ),
        Report(
            "postcodes",
            OUTPUT_FOLDERS["postcodes"],
            ("calls", "people"),
            postcodes,
            lambda p: Gate(unique=[["id"]]),
            DEFAULT_PARAMS["postcodes"],
            single_file=False,
        ),
        Report(
            "segment_breakdown",
            OUTPUT_FOLDERS["segment_breakdown"],
            ("calls", "people"),
            segment_breakdown,
            lambda p: Gate(bad={"negative total_sales_amount": "total_sales_amount < 0"}, unique=[["area"]]),
            DEFAULT_PARAMS["segment_breakdown"],
            present=format_breakdown,
        ),
        Report(
            "top_performers",
            OUTPUT_FOLDERS["top_performers"],
            ("calls", "people", "sales"),
            top_performers,
            lambda p: Gate(
                bad={"rate under threshold": F.col(RATE) < F.lit(p["threshold"])},
                unique=[["id", "area"]],
            ),
            DEFAULT_PARAMS["top_performers"],
        ),
        Report(
            "top_products_in_country",
            OUTPUT_FOLDERS["top_products_in_country"],
            ("calls", "sales"),
            top_products_in_country,
            lambda p: Gate(
                bad={"negative total_products_sold": "total_products_sold < 0"},
                unique=[["area", "product_sold"]],
            ),
            DEFAULT_PARAMS["top_products_in_country"],
        ),
        Report(
            "best_seller_by_country",
            OUTPUT_FOLDERS["best_seller_by_country"],
            ("people", "sales"),
            best_seller_by_country,
            lambda p: Gate(bad={"negative sales_amount": "sales_amount < 0"}, unique=[["caller_id", "country"]]),
            DEFAULT_PARAMS["best_seller_by_country"],
        ),
    ]
}
