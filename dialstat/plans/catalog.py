"""The driver's query catalogue: every operator and report as a query over the driver tables,
each with the equivalent SQL for the DuckDB oracle.

A query is ``(spark, sf_dir) -> DataFrame`` and reads whole tables.  Report parameters are
mapped onto the driver data: departments are market segments, countries are nation names.
Every ordering used by a limit ends in a tie-break, in Spark and in SQL alike, so both sides
keep the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialstat.functions.scalars import MONEY_TYPE, POSTCODE_PATTERN, money_sum, money_text
from dialstat.operators.aggregate import distinct_values, join_aggregates, ratio_of_sums, sums_by
from dialstat.operators.lookup import lookup
from dialstat.operators.quality import duplicate_keys, violation_counts
from dialstat.operators.ranking import top_n_per_group
from dialstat.plans import reports as R
from dialstat.plans.job import run_report
from dialstat.session import shared_scratch_path
from dialstat.sources.analogues import (
    CALLS_SQL,
    PEOPLE_SQL,
    SALES_SQL,
    calls_table,
    driver_table,
    people_table,
    sales_table,
)
from dialstat.sources.export import write_result
from dialstat.sources.tables import SALES_COLUMNS, read_table

# Report parameters on the driver data.
TOP_K_AREA = "MACHINERY"
POSTCODE_AREA = "BUILDING"
COUNTRY = "NATION_3"
LOOKUP_SEGMENTS = ("AUTOMOBILE", "BUILDING", "MACHINERY")

Query = Callable[[SparkSession, str], DataFrame]

_WITH = f"WITH calls AS ({CALLS_SQL}), people AS ({PEOPLE_SQL}), sales AS ({SALES_SQL})\n"


def _rate_sql(made: str, successful: str) -> str:
    return f"ROUND(100.0e0 * {successful} / NULLIF({made}, 0), 2)"


# --- reports -------------------------------------------------------------------------------


def q_segment_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return R.segment_top_k(calls_table(spark, sf), people_table(spark, sf), area=TOP_K_AREA, k=100)


def _segment_top_k_sql(area: str, k: int) -> str:
    return _WITH + f"""
SELECT c.id, c.area, p.name, p.address, p.sales_amount
FROM calls c LEFT JOIN people p ON c.id = p.id
WHERE c.area = '{area}'
ORDER BY p.sales_amount DESC NULLS LAST, c.id ASC NULLS FIRST, p.name ASC NULLS FIRST,
         p.address ASC NULLS FIRST
LIMIT {k}
"""


SQL_SEGMENT_TOP_K = _segment_top_k_sql(TOP_K_AREA, 100)


def q_postcode_extract(spark: SparkSession, sf: str) -> DataFrame:
    return R.postcodes(calls_table(spark, sf), people_table(spark, sf), area=POSTCODE_AREA)


SQL_POSTCODE_EXTRACT = _WITH + rf"""
SELECT c.id, p.address, regexp_extract(p.address, '{POSTCODE_PATTERN}', 1) AS zip_code
FROM calls c LEFT JOIN people p ON c.id = p.id
WHERE c.area = '{POSTCODE_AREA}'
"""


def q_segment_breakdown(spark: SparkSession, sf: str) -> DataFrame:
    return R.format_breakdown(R.segment_breakdown(calls_table(spark, sf), people_table(spark, sf)))


SQL_SEGMENT_BREAKDOWN = _WITH + f"""
SELECT c.area,
       CAST(SUM(c.calls_made) AS BIGINT) AS total_calls_made,
       CAST(SUM(c.calls_successful) AS BIGINT) AS total_calls_successful,
       {_rate_sql('SUM(c.calls_made)', 'SUM(c.calls_successful)')} AS percentage_of_successful_calls,
       CASE WHEN c.area IS NULL THEN NULL
            ELSE format('{{:,.2f}}', CAST(SUM(p.person_sales) AS DOUBLE)) END AS total_sales_amount
FROM calls c
LEFT JOIN (SELECT id, SUM(CAST(sales_amount AS {MONEY_TYPE})) AS person_sales
           FROM people GROUP BY id) p ON c.id = p.id
GROUP BY c.area
"""


def q_top_performers(spark: SparkSession, sf: str) -> DataFrame:
    return R.top_performers(
        calls_table(spark, sf),
        people_table(spark, sf),
        sales_table(spark, sf),
        n=3,
        threshold=75,
    )


def _top_performers_sql(n: int, threshold: float) -> str:
    return _WITH + f"""
, eligible AS (
  SELECT p.id, p.name, p.sales_amount, c.area, c.calls_made, c.calls_successful,
         {_rate_sql('c.calls_made', 'c.calls_successful')} AS rate
  FROM people p JOIN calls c ON p.id = c.id
  WHERE {_rate_sql('c.calls_made', 'c.calls_successful')} > {threshold}
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY area ORDER BY sales_amount DESC NULLS LAST,
            rate ASC NULLS FIRST, id ASC NULLS FIRST, name ASC NULLS FIRST,
            calls_made ASC NULLS FIRST, calls_successful ASC NULLS FIRST) AS rn
  FROM eligible
), units AS (
  SELECT caller_id, SUM(quantity) AS count_products_sold FROM sales GROUP BY caller_id
)
SELECT r.id, r.name, r.sales_amount, r.area, r.calls_made, r.calls_successful,
       r.rate AS percentage_of_successful_calls, u.caller_id, u.count_products_sold
FROM ranked r LEFT JOIN units u ON r.id = u.caller_id
WHERE r.rn <= {n}
"""


SQL_TOP_PERFORMERS = _top_performers_sql(3, 75)


def q_top_products_in_country(spark: SparkSession, sf: str) -> DataFrame:
    return R.top_products_in_country(calls_table(spark, sf), sales_table(spark, sf), country=COUNTRY, n=3)


def _top_products_sql(country: str, n: int) -> str:
    return _WITH + f"""
, per_area AS (
  SELECT c.area, s.product_sold, SUM(s.quantity) AS total_products_sold
  FROM sales s LEFT JOIN calls c ON s.caller_id = c.id
  WHERE s.country = '{country}'
  GROUP BY c.area, s.product_sold
)
SELECT area, product_sold, total_products_sold FROM (
  SELECT *, row_number() OVER (PARTITION BY area ORDER BY total_products_sold DESC NULLS LAST,
            product_sold ASC NULLS FIRST) AS rn
  FROM per_area) t
WHERE rn <= {n}
"""


SQL_TOP_PRODUCTS_IN_COUNTRY = _top_products_sql(COUNTRY, 3)


def _best_seller_sql(people_filter: str, n: int = 1) -> str:
    return _WITH + f"""
, per_caller AS (
  SELECT caller_id, country, SUM(quantity) AS total_products_sold
  FROM sales GROUP BY caller_id, country
), best AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY country ORDER BY total_products_sold DESC NULLS LAST,
              caller_id ASC NULLS FIRST) AS rn
    FROM per_caller) t
  WHERE rn <= {n}
)
SELECT b.caller_id, b.country, b.total_products_sold, p.name, p.sales_amount
FROM best b JOIN (SELECT * FROM people WHERE {people_filter}) p ON b.caller_id = p.id
"""


def q_best_seller_by_country(spark: SparkSession, sf: str) -> DataFrame:
    return R.best_seller_by_country(people_table(spark, sf), sales_table(spark, sf), n=1)


SQL_BEST_SELLER_BY_COUNTRY = _best_seller_sql("TRUE")


# Report parameters other than the defaults, checked against the same SQL.
def q_segment_top_k_ten(spark: SparkSession, sf: str) -> DataFrame:
    return R.segment_top_k(calls_table(spark, sf), people_table(spark, sf), area="HOUSEHOLD", k=10)


def q_top_performer_each(spark: SparkSession, sf: str) -> DataFrame:
    return R.top_performers(
        calls_table(spark, sf),
        people_table(spark, sf),
        sales_table(spark, sf),
        n=1,
        threshold=80,
    )


def q_top_products_other_country(spark: SparkSession, sf: str) -> DataFrame:
    return R.top_products_in_country(calls_table(spark, sf), sales_table(spark, sf), country="NATION_7", n=2)


def q_best_sellers_top_three(spark: SparkSession, sf: str) -> DataFrame:
    return R.best_seller_by_country(people_table(spark, sf), sales_table(spark, sf), n=3)


# --- single operators ----------------------------------------------------------------------


def q_filter_equals(spark: SparkSession, sf: str) -> DataFrame:
    customer = driver_table(spark, sf, "customer")
    return customer.filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey", "c_name", "c_acctbal")


SQL_FILTER_EQUALS = """
SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING'
"""


def q_rate_over_threshold(spark: SparkSession, sf: str) -> DataFrame:
    return R.with_success_rate(calls_table(spark, sf)).filter(F.col(R.RATE) > 75)


SQL_RATE_OVER_THRESHOLD = _WITH + f"""
SELECT id, area, calls_made, calls_successful,
       {_rate_sql('calls_made', 'calls_successful')} AS percentage_of_successful_calls
FROM calls
WHERE {_rate_sql('calls_made', 'calls_successful')} > 75
"""


def q_sums_by_key(spark: SparkSession, sf: str) -> DataFrame:
    orders = driver_table(spark, sf, "orders")
    return sums_by(
        orders,
        "o_orderpriority",
        {
            "total_price": money_sum("o_totalprice").cast("double"),
            "order_count": F.count(F.lit(1)),
            "customer_key_sum": "o_custkey",
        },
    )


SQL_SUMS_BY_KEY = f"""
SELECT o_orderpriority,
       CAST(SUM(CAST(o_totalprice AS {MONEY_TYPE})) AS DOUBLE) AS total_price,
       COUNT(*) AS order_count,
       CAST(SUM(o_custkey) AS BIGINT) AS customer_key_sum
FROM orders GROUP BY o_orderpriority
"""


def q_sums_by_two_keys(spark: SparkSession, sf: str) -> DataFrame:
    return sums_by(sales_table(spark, sf), ["country", "product_sold"], {"total_quantity": "quantity"})


SQL_SUMS_BY_TWO_KEYS = _WITH + """
SELECT country, product_sold, SUM(quantity) AS total_quantity FROM sales GROUP BY country, product_sold
"""


def q_ratio_of_sums(spark: SparkSession, sf: str) -> DataFrame:
    return ratio_of_sums(
        calls_table(spark, sf),
        "area",
        part="calls_successful",
        whole="calls_made",
        name=R.RATE,
        part_total="total_calls_successful",
        whole_total="total_calls_made",
    )


SQL_RATIO_OF_SUMS = _WITH + f"""
SELECT area,
       CAST(SUM(calls_successful) AS BIGINT) AS total_calls_successful,
       CAST(SUM(calls_made) AS BIGINT) AS total_calls_made,
       {_rate_sql('SUM(calls_made)', 'SUM(calls_successful)')} AS percentage_of_successful_calls
FROM calls GROUP BY area
"""


def q_money_text(spark: SparkSession, sf: str) -> DataFrame:
    customer = driver_table(spark, sf, "customer")
    return customer.groupBy("c_nationkey").agg(money_text(money_sum("c_acctbal")).alias("total_balance"))


SQL_MONEY_TEXT = f"""
SELECT c_nationkey, format('{{:,.2f}}', CAST(SUM(CAST(c_acctbal AS {MONEY_TYPE})) AS DOUBLE)) AS total_balance
FROM customer GROUP BY c_nationkey
"""


def q_left_lookup_orphans(spark: SparkSession, sf: str) -> DataFrame:
    orders = driver_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    customer = driver_table(spark, sf, "customer").filter(F.col("c_mktsegment").isin(*LOOKUP_SEGMENTS))
    return lookup(
        orders,
        customer,
        "o_custkey",
        right_on="c_custkey",
        how="left",
        columns=["c_name", "c_mktsegment"],
        split_hot_keys=True,
    )


SQL_LEFT_LOOKUP_ORPHANS = f"""
SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, c.c_name, c.c_mktsegment
FROM orders o
LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment IN {LOOKUP_SEGMENTS!r}) c
  ON o.o_custkey = c.c_custkey
"""


def q_inner_filtered(spark: SparkSession, sf: str) -> DataFrame:
    customer = driver_table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), "c_name", "c_acctbal"
    )
    good = R.with_success_rate(calls_table(spark, sf)).filter(F.col(R.RATE) > 75)
    return lookup(customer, good, "id", how="inner", columns=[R.RATE])


SQL_INNER_FILTERED = _WITH + f"""
SELECT cu.c_custkey AS id, cu.c_name, cu.c_acctbal,
       {_rate_sql('c.calls_made', 'c.calls_successful')} AS percentage_of_successful_calls
FROM customer cu JOIN calls c ON cu.c_custkey = c.id
WHERE {_rate_sql('c.calls_made', 'c.calls_successful')} > 75
"""


def q_left_to_aggregate(spark: SparkSession, sf: str) -> DataFrame:
    """Every order with the totals of all its line items; some orders have none."""
    orders = driver_table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    per_order = sums_by(
        driver_table(spark, sf, "lineitem"),
        "l_orderkey",
        {"line_total": money_sum("l_extendedprice").cast("double"), "line_count": F.count(F.lit(1))},
    )
    return lookup(orders, per_order, "o_orderkey", right_on="l_orderkey", how="left", keep_right_key=True)


SQL_LEFT_TO_AGGREGATE = f"""
SELECT o.o_orderkey, o.o_custkey, m.l_orderkey, m.line_total, m.line_count
FROM orders o
LEFT JOIN (SELECT l_orderkey, CAST(SUM(CAST(l_extendedprice AS {MONEY_TYPE})) AS DOUBLE) AS line_total,
                  COUNT(*) AS line_count
           FROM lineitem GROUP BY l_orderkey) m
  ON o.o_orderkey = m.l_orderkey
"""


def q_join_of_aggregates(spark: SparkSession, sf: str) -> DataFrame:
    """Calls per department joined with sales per department; people are summed per id first,
    so the lookup behind the second aggregate has no hot id."""
    calls = calls_table(spark, sf)
    per_person = sums_by(people_table(spark, sf), "id", {"person_sales": money_sum("sales_amount")})
    counts = calls.groupBy("area").agg(
        F.count(F.lit(1)).alias("agents"), F.sum("calls_made").alias("calls")
    )
    staff = driver_table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("area"))
    amounts = (
        lookup(staff, per_person, "id", how="left")
        .groupBy("area")
        .agg(F.sum("person_sales").cast("double").alias("sales_total"))
    )
    return join_aggregates(counts, amounts, "area", "left")


SQL_JOIN_OF_AGGREGATES = _WITH + f"""
, counts AS (SELECT area, COUNT(*) AS agents, CAST(SUM(calls_made) AS BIGINT) AS calls
             FROM calls GROUP BY area),
  amounts AS (SELECT c.area, CAST(SUM(CAST(p.sales_amount AS {MONEY_TYPE})) AS DOUBLE) AS sales_total
              FROM calls c LEFT JOIN people p ON c.id = p.id GROUP BY c.area)
SELECT k.area, k.agents, k.calls, a.sales_total
FROM counts k LEFT JOIN amounts a ON k.area = a.area
"""


def q_rank_then_lookup(spark: SparkSession, sf: str) -> DataFrame:
    people = people_table(spark, sf).filter(F.col("sales_amount") >= 0)
    return R.best_seller_by_country(people, sales_table(spark, sf), n=1)


SQL_RANK_THEN_LOOKUP = _best_seller_sql("sales_amount >= 0")


def q_top_n_one_key(spark: SparkSession, sf: str) -> DataFrame:
    lines = driver_table(spark, sf, "lineitem").select(
        "l_suppkey", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"
    )
    return top_n_per_group(lines, "l_suppkey", ["-l_extendedprice"], 3)


SQL_TOP_N_ONE_KEY = """
SELECT l_suppkey, l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM (
  SELECT l_suppkey, l_orderkey, l_linenumber, l_quantity, l_extendedprice,
         row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC NULLS LAST,
           l_orderkey ASC NULLS FIRST, l_linenumber ASC NULLS FIRST, l_quantity ASC NULLS FIRST) AS rn
  FROM lineitem) t
WHERE rn <= 3
"""


def q_top_n_two_keys(spark: SparkSession, sf: str) -> DataFrame:
    rated = R.with_success_rate(calls_table(spark, sf))
    return top_n_per_group(rated, "area", ["-calls_made", R.RATE], 5, tie_break=["id"])


SQL_TOP_N_TWO_KEYS = _WITH + f"""
SELECT id, area, calls_made, calls_successful, rate AS percentage_of_successful_calls FROM (
  SELECT *, row_number() OVER (PARTITION BY area ORDER BY calls_made DESC NULLS LAST,
            rate ASC NULLS FIRST, id ASC NULLS FIRST) AS rn
  FROM (SELECT *, {_rate_sql('calls_made', 'calls_successful')} AS rate FROM calls) r) t
WHERE rn <= 5
"""


def q_top_n_large(spark: SparkSession, sf: str) -> DataFrame:
    """More rows per group than Spark's map-side group limit takes: level by level."""
    orders = driver_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return top_n_per_group(orders, "o_orderstatus", ["-o_totalprice"], 1200)


SQL_TOP_N_LARGE = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
         row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC NULLS LAST,
           o_orderkey ASC NULLS FIRST, o_custkey ASC NULLS FIRST) AS rn
  FROM orders) t
WHERE rn <= 1200
"""


def q_violations(spark: SparkSession, sf: str) -> DataFrame:
    customer = driver_table(spark, sf, "customer")
    return violation_counts(
        customer, {"negative_balance": "c_acctbal < 0", "missing_segment": "c_mktsegment IS NULL"}
    )


SQL_VIOLATIONS = """
SELECT COUNT(*) AS rows_checked, CAST(COUNT_IF(c_acctbal < 0) AS BIGINT) AS negative_balance,
       CAST(COUNT_IF(c_mktsegment IS NULL) AS BIGINT) AS missing_segment
FROM customer
"""


def q_duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    return duplicate_keys(driver_table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


SQL_DUPLICATE_KEYS = """
SELECT l_orderkey, l_linenumber, COUNT(*) AS count
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1
"""

GATED_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def q_row_gate(spark: SparkSession, sf: str) -> DataFrame:
    parts = [
        driver_table(spark, sf, name)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(name).alias("table_name"), "row_count", (F.col("row_count") > 0).alias("non_empty"))
        for name in GATED_TABLES
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


SQL_ROW_GATE = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS table_name, COUNT(*) AS row_count, COUNT(*) > 0 AS non_empty FROM {name}"
    for name in GATED_TABLES
)


def q_distinct_values(spark: SparkSession, sf: str) -> DataFrame:
    return distinct_values(sales_table(spark, sf), ["country"])


SQL_DISTINCT_VALUES = _WITH + "SELECT DISTINCT country FROM sales"

CUSTOMER_COLUMNS = {
    "c_custkey": "bigint",
    "c_name": "string",
    "c_nationkey": "int",
    "c_acctbal": "double",
    "c_mktsegment": "string",
}


def q_csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Write the customer table as CSV into a fresh folder on shared storage, read it back."""
    path = shared_scratch_path(spark, "csv_round_trip")
    customer = driver_table(spark, sf, "customer").select(*CUSTOMER_COLUMNS)
    write_result(customer, path)
    return read_table(spark, path, CUSTOMER_COLUMNS, fmt="csv")


SQL_CSV_ROUND_TRIP = """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
"""


def q_wide_values(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as a sales table in CSV, with ids beyond 32 bits, fractional quantities and a
    header in other letter case and order, read back by declared types and summed."""
    path = shared_scratch_path(spark, "wide_values")
    lines = driver_table(spark, sf, "lineitem").select(
        (F.col("l_quantity") + F.lit(0.5)).alias("Quantity"),
        F.lit("NL").alias("COUNTRY"),
        (F.col("l_orderkey") + F.lit(3_000_000_000)).alias("Caller_ID"),
        F.col("l_partkey").cast("string").alias("Product_Sold"),
        F.col("l_linenumber").alias("extra"),
    )
    write_result(lines, path)
    sales = read_table(spark, path, SALES_COLUMNS, fmt="csv")
    return sums_by(sales, ["caller_id", "country"], {"units": "quantity", "lines": F.count("product_sold")})


SQL_WIDE_VALUES = """
SELECT l_orderkey + 3000000000 AS caller_id, 'NL' AS country, SUM(l_quantity + 0.5e0) AS units, COUNT(*) AS lines
FROM lineitem GROUP BY l_orderkey
"""


def q_report_job(spark: SparkSession, sf: str) -> DataFrame:
    """R4 as a job (B1): built, staged, gated, written, and the written files read back."""
    inputs = {"calls": calls_table(spark, sf), "people": people_table(spark, sf), "sales": sales_table(spark, sf)}
    path = shared_scratch_path(spark, "report_job")
    return run_report(spark, "top_performers", inputs, path, {"n": 3, "threshold": 75}, write=True)


REPORT_R1_COLUMNS = {
    "id": "bigint",
    "area": "string",
    "name": "string",
    "address": "string",
    "sales_amount": "double",
}


def q_single_file_export(spark: SparkSession, sf: str) -> DataFrame:
    """R1 written as exactly one sorted CSV file in a fresh shared folder, read back."""
    path = shared_scratch_path(spark, "single_file_export")
    report = q_segment_top_k(spark, sf)
    write_result(report, path, single_file=True, order=["-sales_amount", "id"])
    return read_table(spark, path, REPORT_R1_COLUMNS, fmt="csv")


QUERIES: dict[str, tuple[Query, str | None]] = {
    "segment_top_k": (q_segment_top_k, SQL_SEGMENT_TOP_K),
    "postcode_extract": (q_postcode_extract, SQL_POSTCODE_EXTRACT),
    "segment_breakdown": (q_segment_breakdown, SQL_SEGMENT_BREAKDOWN),
    "top_performers": (q_top_performers, SQL_TOP_PERFORMERS),
    "top_products_in_country": (q_top_products_in_country, SQL_TOP_PRODUCTS_IN_COUNTRY),
    "best_seller_by_country": (q_best_seller_by_country, SQL_BEST_SELLER_BY_COUNTRY),
    "filter_equals": (q_filter_equals, SQL_FILTER_EQUALS),
    "rate_over_threshold": (q_rate_over_threshold, SQL_RATE_OVER_THRESHOLD),
    "sums_by_key": (q_sums_by_key, SQL_SUMS_BY_KEY),
    "sums_by_two_keys": (q_sums_by_two_keys, SQL_SUMS_BY_TWO_KEYS),
    "ratio_of_sums": (q_ratio_of_sums, SQL_RATIO_OF_SUMS),
    "money_text": (q_money_text, SQL_MONEY_TEXT),
    "left_lookup_orphans": (q_left_lookup_orphans, SQL_LEFT_LOOKUP_ORPHANS),
    "inner_filtered": (q_inner_filtered, SQL_INNER_FILTERED),
    "left_to_aggregate": (q_left_to_aggregate, SQL_LEFT_TO_AGGREGATE),
    "join_of_aggregates": (q_join_of_aggregates, SQL_JOIN_OF_AGGREGATES),
    "rank_then_lookup": (q_rank_then_lookup, SQL_RANK_THEN_LOOKUP),
    "top_n_one_key": (q_top_n_one_key, SQL_TOP_N_ONE_KEY),
    "top_n_two_keys": (q_top_n_two_keys, SQL_TOP_N_TWO_KEYS),
    "violations": (q_violations, SQL_VIOLATIONS),
    "duplicate_keys": (q_duplicate_keys, SQL_DUPLICATE_KEYS),
    "row_gate": (q_row_gate, SQL_ROW_GATE),
    "distinct_values": (q_distinct_values, SQL_DISTINCT_VALUES),
    "csv_round_trip": (q_csv_round_trip, SQL_CSV_ROUND_TRIP),
    "single_file_export": (q_single_file_export, SQL_SEGMENT_TOP_K),
    "top_n_large": (q_top_n_large, SQL_TOP_N_LARGE),
    "wide_values": (q_wide_values, SQL_WIDE_VALUES),
    "report_job": (q_report_job, SQL_TOP_PERFORMERS),
    "segment_top_k_ten": (q_segment_top_k_ten, _segment_top_k_sql("HOUSEHOLD", 10)),
    "top_performer_each": (q_top_performer_each, _top_performers_sql(1, 80)),
    "top_products_other_country": (q_top_products_other_country, _top_products_sql("NATION_7", 2)),
    "best_sellers_top_three": (q_best_sellers_top_three, _best_seller_sql("TRUE", 3)),
}

# The headline queries timed by bench.py: the six reports.
HEADLINE = (
    "segment_top_k",
    "postcode_extract",
    "segment_breakdown",
    "top_performers",
    "top_products_in_country",
    "best_seller_by_country",
)
