"""The three report inputs, derived by Spark from the TPC-H-like driver tables.

* calls  (id, area, calls_made, calls_successful)   <- customer LEFT JOIN orders
* people (id, name, address, sales_amount)          <- customer JOIN nation
* sales  (caller_id, country, product_sold, quantity) <- lineitem JOIN supplier JOIN nation
                                                       JOIN part JOIN orders

All three are lazy DataFrames: Catalyst prunes the columns a report does not read and pushes
report filters (a country, an area) down to the scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialstat.session import parquet_rows

# Nations are a fixed, tiny dimension; joined on a key of few values, a shuffle join would
# put all line items into as many tasks as there are nations, so it is broadcast once its
# row count, which its files' footers tell, is checked.
NATION_MAX_ROWS = 10_000

# The tables' declared columns: a declared table is read without a job that infers them.
TABLE_COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table as it is now: files are listed anew for every query."""
    return spark.read.schema(TABLE_COLUMNS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def nation_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nation table, marked for broadcast when its size check passes."""
    nation = driver_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    rows = parquet_rows(spark, f"{sf_dir.rstrip('/')}/nation.parquet")
    return F.broadcast(nation) if rows is not None and rows <= NATION_MAX_ROWS else nation


def calls_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer: orders count as calls, orders not in status F as successful calls.

    Orders are aggregated per customer *before* the join (map-side partial counts), so the
    join sees one row per customer instead of one per order.
    """
    customer = driver_table(spark, sf_dir, "customer")
    per_customer = (
        driver_table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.expr("count(o_orderkey) AS made"), F.expr("count_if(o_orderstatus <> 'F') AS successful"))
    )
    joined = customer.join(per_customer, F.expr("c_custkey = o_custkey"), "left")
    return joined.selectExpr(
        "c_custkey AS id",
        "c_mktsegment AS area",
        "coalesce(made, 0L) AS calls_made",
        "coalesce(successful, 0L) AS calls_successful",
    )


def people_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer with a made-up street address.

    Every seventh customer has an address without a postcode; the others carry a postcode of
    four digits, a blank and two capitals.
    """
    customer, nation = driver_table(spark, sf_dir, "customer"), nation_table(spark, sf_dir)
    postcode = "CAST(1000 + c_custkey % 9000 AS STRING) || ' ' || CASE WHEN c_custkey % 2 = 0 THEN 'AB' ELSE 'XZ' END"
    return customer.join(nation, F.expr("c_nationkey = n_nationkey")).selectExpr(
        "c_custkey AS id",
        "c_name AS name",
        f"CASE WHEN c_custkey % 7 = 0 THEN 'no code' ELSE concat(c_name, ', ', {postcode}, ', ', n_name) END AS address",
        "c_acctbal AS sales_amount",
    )


def sales_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item: who sold it (the order's customer), where (the supplier's
    nation), what (the part type) and how many.

    The supplier and nation joins come first, so a country filter (pushed into the nation
    scan) shrinks the line items before the large join with orders.
    """
    table = lambda name: driver_table(spark, sf_dir, name)
    # A left-deep chain: every right side is a base table, so the planner's size estimate of
    # each right side is its scan size, and only genuinely small tables get broadcast (a
    # joined subtree is estimated as the product of its inputs and would lose to lineitem).
    rows = (
        table("lineitem")
        .join(table("supplier"), F.expr("l_suppkey = s_suppkey"))
        .join(nation_table(spark, sf_dir), F.expr("s_nationkey = n_nationkey"))
        .join(table("part"), F.expr("l_partkey = p_partkey"))
        .join(table("orders"), F.expr("l_orderkey = o_orderkey"))
    )
    return rows.selectExpr("o_custkey AS caller_id", "n_name AS country", "p_type AS product_sold", "l_quantity AS quantity")


def report_inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "calls": calls_table(spark, sf_dir),
        "people": people_table(spark, sf_dir),
        "sales": sales_table(spark, sf_dir),
    }


# SQL text of the same three tables, for the DuckDB oracle (views over the driver tables).
CALLS_SQL = """
SELECT c.c_custkey AS id, c.c_mktsegment AS area,
       COALESCE(o.calls_made, 0) AS calls_made,
       COALESCE(o.calls_successful, 0) AS calls_successful
FROM customer c
LEFT JOIN (SELECT o_custkey, COUNT(o_orderkey) AS calls_made,
                  CAST(COUNT_IF(o_orderstatus <> 'F') AS BIGINT) AS calls_successful
           FROM orders GROUP BY o_custkey) o
  ON c.c_custkey = o.o_custkey
"""

PEOPLE_SQL = """
SELECT c.c_custkey AS id, c.c_name AS name,
       CASE WHEN c.c_custkey % 7 = 0 THEN 'no code'
            ELSE c.c_name || ', ' || CAST(1000 + c.c_custkey % 9000 AS VARCHAR) || ' '
                 || CASE WHEN c.c_custkey % 2 = 0 THEN 'AB' ELSE 'XZ' END || ', ' || n.n_name
       END AS address,
       c.c_acctbal AS sales_amount
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
"""

SALES_SQL = """
SELECT o.o_custkey AS caller_id, n.n_name AS country, p.p_type AS product_sold,
       l.l_quantity AS quantity
FROM lineitem l
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN part p ON l.l_partkey = p.p_partkey
JOIN orders o ON l.l_orderkey = o.o_orderkey
"""
