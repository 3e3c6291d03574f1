"""Registered queries over the driver tables, each with its DuckDB oracle.

Every query reads the whole driver tables (or files Spark writes from them) and returns a lazy DataFrame. The oracle
SQL states the same result independently, straight from the tables. Column names are aliased alike on both sides.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillgrid.functions import scalars
from tillgrid.operators import conform, ledger, marts
from tillgrid.operators.enrich import star_join
from tillgrid.operators.ranking import rank_desc
from tillgrid.session import scratch_path
from tillgrid.sinks import files as sinks
from tillgrid.sources import tables

Query = Callable[[SparkSession, str], DataFrame]


# ---------------------------------------------------------------------------------------------------------------
# Star and marts
# ---------------------------------------------------------------------------------------------------------------


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enriched sales frame of the driver tables (fact ⋈ customer ⋈ store ⋈ sales team)."""
    return star_join(
        tables.sales_fact(spark, sf_dir),
        tables.customers(spark, sf_dir),
        tables.stores(spark, sf_dir),
        tables.sales_team(spark, sf_dir),
    )


def q_star_join(spark, sf_dir):
    return enriched(spark, sf_dir)


def q_customer_mart_rows(spark, sf_dir):
    return marts.customer_mart_rows(enriched(spark, sf_dir))


def q_sales_mart_rows(spark, sf_dir):
    return marts.sales_mart_rows(enriched(spark, sf_dir))


def _fact_and_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, ...]:
    """The conformed fact and the three dimensions, for the forms that sum by key before attributes are joined."""
    return (
        tables.sales_fact(spark, sf_dir),
        tables.customers(spark, sf_dir),
        tables.stores(spark, sf_dir),
        tables.sales_team(spark, sf_dir),
    )


def q_customer_monthly_sales(spark, sf_dir):
    return marts.customer_monthly_by_key(*_fact_and_sides(spark, sf_dir))


def q_customer_monthly_sales_window(spark, sf_dir):
    return marts.customer_monthly_sales_window(enriched(spark, sf_dir))


def q_sales_person_monthly_sales(spark, sf_dir):
    return marts.sales_person_monthly_by_key(*_fact_and_sides(spark, sf_dir))


def q_sales_incentive(spark, sf_dir):
    return marts.sales_incentive_by_key(*_fact_and_sides(spark, sf_dir))


def q_incentive_ties(spark, sf_dir):
    """Rank of each sales person by number of sale lines within (store, month); ties share a rank.

    The monthly counts are written once, as the rank reads them twice: the sales are scanned and counted one time."""
    known = marts.known_sales(*_fact_and_sides(spark, sf_dir))
    counts = (
        known.select("store_id", "sales_person_id", scalars.month_key("sales_date").alias("sales_month"))
        .groupBy("store_id", "sales_month", "sales_person_id")
        .agg(F.count(F.lit(1)).alias("n_lines"))
    )
    path = scratch_path(spark, "line-counts")
    sinks.write_parquet(counts, path)
    return rank_desc(spark.read.schema(counts.schema).parquet(path), ["store_id", "sales_month"], "n_lines")


# ---------------------------------------------------------------------------------------------------------------
# Scalar functions
# ---------------------------------------------------------------------------------------------------------------


def q_month_key(spark, sf_dir):
    o = tables.table(spark, sf_dir, "orders")
    d = F.col("o_orderdate").cast("date")
    return o.select(
        "o_orderkey",
        scalars.month_key(d).alias("sales_month"),
        scalars.month_key_of_text(d.cast("string")).alias("sales_month_text"),
    )


def q_full_name(spark, sf_dir):
    c = tables.customers(spark, sf_dir)
    return c.select("customer_id", scalars.full_name("first_name", "last_name").alias("full_name"))


def q_run_stamp(spark, sf_dir):
    o = tables.table(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey",
        scalars.stamp_text("o_orderdate").alias("stamp"),
        scalars.epoch_millis("o_orderdate").alias("epoch_ms"),
    )


def q_event_stamp(spark, sf_dir):
    """Stamps of instants with a time of day and fractions of seconds (cut off)."""
    e = tables.table(spark, sf_dir, "events")
    return e.select("event_id", scalars.stamp_text("ts").alias("stamp"), scalars.epoch_millis("ts").alias("epoch_ms"))


def q_pack_extra_columns(spark, sf_dir):
    li = tables.table(spark, sf_dir, "lineitem")
    extras = [F.nullif(F.col("l_returnflag"), F.lit("N")), F.col("l_linestatus")]
    return li.select("l_orderkey", "l_linenumber", scalars.pack_columns(extras).alias("additional_column"))


def q_union_facts(spark, sf_dir):
    """Finished orders' lines with no extras UNION ALL the other lines with return flag and line status packed."""
    lines = tables.sales_lines(spark, sf_dir, with_product=True)
    fact_cols = [c for c in conform.SALES_FACT.fieldNames() if c != conform.EXTRA_COLUMN]
    done = lines.where(F.col("o_orderstatus") == "F").select(*fact_cols)
    other = lines.where(F.col("o_orderstatus") != "F")
    plain = conform.pack_extras(done, [])
    packed = conform.pack_extras(other, ["l_returnflag", "l_linestatus"]).select(*plain.columns)
    return conform.union_all([conform.empty_fact(spark), plain, packed])


# ---------------------------------------------------------------------------------------------------------------
# Ledger
# ---------------------------------------------------------------------------------------------------------------


def q_ledger_lookup(spark, sf_dir):
    o = tables.table(spark, sf_dir, "orders")
    return ledger.lookup(
        o.withColumnRenamed("o_custkey", "customer_id"),
        ["customer_id"],
        "o_orderpriority",
        ["1-URGENT", "2-HIGH"],
        "o_orderstatus",
        "O",
    )


def q_ledger_state(spark, sf_dir):
    ev = tables.table(spark, sf_dir, "events")
    return ledger.current_state(ev, ["user_id"], "event_type", ["ts", "event_id"], "status", "updated_ts")


def q_ledger_incomplete(spark, sf_dir):
    """Customers holding an order whose latest status is not final (F)."""
    c = tables.customers(spark, sf_dir).select("customer_id", "first_name")
    state = tables.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_id"), F.col("o_orderstatus").alias("status")
    )
    return ledger.incomplete(c, state, "customer_id", "status", "F")


def _order_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sales file per order, as a manifest would list it."""
    name = F.concat(F.lit("order-"), F.col("o_orderkey").cast("string"), F.lit(".csv"))
    orders = tables.table(spark, sf_dir, "orders")
    return orders.select(F.concat(F.lit("/drop/"), name).alias("path"), name.alias("file_name"), "o_orderstatus")


def _file_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger after a run that opened every order's file and broke off after the finished orders (F); a second run
    then took the partly shipped ones (P) to the end."""
    files = _order_files(spark, sf_dir)
    status = F.col("o_orderstatus")

    def at(minute: int) -> dt.datetime:
        return dt.datetime(2024, 1, 1, 0, minute, tzinfo=dt.timezone.utc)

    return conform.union_all(
        [
            ledger.ledger_rows(spark, "run-1", files, ledger.ACTIVE, at(0), 0),
            ledger.ledger_rows(spark, "run-1", files.where(status == "F"), ledger.FINISHED, at(1), 1),
            ledger.ledger_rows(spark, "run-2", files.where(status == "P"), ledger.ACTIVE, at(2), 0),
            ledger.ledger_rows(spark, "run-2", files.where(status == "P"), ledger.FINISHED, at(2), 1),
        ]
    )


def q_file_ledger_state(spark, sf_dir):
    """Current status per run and file of a ledger written by ``ledger_rows``."""
    rows = _file_ledger(spark, sf_dir)
    return ledger.current_state(rows, ["run_id", "file_name"], "status", ["event_ts", "seq"])


def q_file_restart_check(spark, sf_dir):
    """Files on hand that some run opened and that neither it nor a later one finished."""
    on_hand = _order_files(spark, sf_dir).select("path", "file_name")
    return ledger.incomplete(on_hand, ledger.file_state(_file_ledger(spark, sf_dir)), "path")


def q_file_valid_copies(spark, sf_dir):
    """(run, file) copies whose sales do not count for a third run, which takes the open orders (O) again."""
    files = _order_files(spark, sf_dir).where(F.col("o_orderstatus") == "O")
    start = dt.datetime(2024, 1, 1, 1, tzinfo=dt.timezone.utc)
    rows = _file_ledger(spark, sf_dir).union(ledger.ledger_rows(spark, "run-3", files, ledger.ACTIVE, start, 0))
    return ledger.superseded(rows, "run-3")


# ---------------------------------------------------------------------------------------------------------------
# Oracle SQL (DuckDB)
# ---------------------------------------------------------------------------------------------------------------

_DIMS = """
cust AS (
  SELECT c_custkey AS customer_id, c_name AS first_name, c_mktsegment AS last_name,
         'nation ' || CAST(c_nationkey AS VARCHAR) AS address,
         lpad(CAST(c_nationkey AS VARCHAR), 6, '0') AS pincode,
         'ph-' || CAST(c_custkey AS VARCHAR) AS phone_number
  FROM customer),
store AS (
  SELECT CAST(n_nationkey AS BIGINT) AS store_id, n_name AS store_address,
         'manager of ' || n_name AS store_manager_name
  FROM nation),
team AS (
  SELECT s_suppkey AS sales_person_id, s_name AS sales_person_first_name,
         CAST(s_nationkey AS VARCHAR) AS sales_person_last_name, CAST(s_nationkey AS BIGINT) AS manager_id,
         'N' AS is_manager, 'nation ' || CAST(s_nationkey AS VARCHAR) AS sales_person_address,
         lpad(CAST(s_nationkey AS VARCHAR), 6, '0') AS sales_person_pincode
  FROM supplier)"""

_LINES = """
lines AS (
  SELECT o.o_custkey AS customer_id, CAST(s.s_nationkey AS BIGINT) AS store_id,
         CAST(NULL AS VARCHAR) AS product_name, CAST(o.o_orderdate AS DATE) AS sales_date,
         l.l_suppkey AS sales_person_id, CAST(NULL AS DECIMAL(18,2)) AS price,
         CAST(l.l_quantity AS INTEGER) AS quantity, CAST(l.l_extendedprice AS DECIMAL(18,2)) AS total_cost,
         l.l_orderkey, l.l_linenumber, o.o_orderstatus, l.l_returnflag, l.l_linestatus
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN supplier s ON s.s_suppkey = l.l_suppkey)"""

# The same lines with the product's name and price.
_PRICED_LINES = (
    _LINES.replace("CAST(NULL AS VARCHAR)", "p.p_name")
    .replace("CAST(NULL AS DECIMAL(18,2))", "CAST(p.p_retailprice AS DECIMAL(18,2))")
    .replace("s.s_suppkey = l.l_suppkey)", "s.s_suppkey = l.l_suppkey LEFT JOIN part p ON p.p_partkey = l.l_partkey)")
)

_STAR_TAIL = """,
star AS (
  SELECT f.customer_id, f.store_id, f.sales_person_id, f.sales_date, f.total_cost,
         c.first_name, c.last_name, c.address, c.pincode, c.phone_number,
         st.store_address, st.store_manager_name,
         t.sales_person_first_name, t.sales_person_last_name, t.manager_id, t.is_manager,
         t.sales_person_address, t.sales_person_pincode
  FROM lines f JOIN cust c ON f.customer_id = c.customer_id
               JOIN store st ON f.store_id = st.store_id
               JOIN team t ON f.sales_person_id = t.sales_person_id)
"""


def star_sql(line_filter: str = "") -> str:
    """``WITH lines, cust, store, team, star``; ``line_filter`` is an extra condition on the sale lines."""
    lines = _LINES
    if line_filter:
        lines = lines.replace("s.s_suppkey = l.l_suppkey)", f"s.s_suppkey = l.l_suppkey WHERE {line_filter})")
    return "WITH" + lines + "," + _DIMS + _STAR_TAIL


_STAR = star_sql()

_CUSTOMER_MONTHLY = (
    _STAR
    + """
SELECT customer_id, first_name || ' ' || last_name AS full_name, address, phone_number,
       strftime(sales_date, '%Y-%m') AS sales_date_month, CAST(sum(total_cost) AS DECIMAL(18,2)) AS total_sales
FROM star GROUP BY ALL"""
)

PERSON_MONTHLY = """
monthly AS (
  SELECT store_id, sales_person_id, sales_person_first_name || ' ' || sales_person_last_name AS full_name,
         strftime(sales_date, '%Y-%m') AS sales_month, CAST(sum(total_cost) AS DECIMAL(18,2)) AS total_sales
  FROM star GROUP BY ALL)"""

INCENTIVE_SELECT = """
SELECT store_id, sales_person_id, full_name, sales_month, total_sales,
       CAST(CASE WHEN rank() OVER (PARTITION BY store_id, sales_month ORDER BY total_sales DESC NULLS LAST) = 1
                 THEN round(total_sales * CAST(0.01 AS DECIMAL(3,2)), 2) ELSE 0 END AS DECIMAL(18,2)) AS incentive
FROM monthly"""


def incentive_sql(line_filter: str = "") -> str:
    """The sales-team mart with incentive over the (optionally filtered) sale lines."""
    return star_sql(line_filter) + "," + PERSON_MONTHLY + INCENTIVE_SELECT


ORACLE_SQL: dict[str, str] = {
    "star_join": _STAR + "SELECT * FROM star",
    "customer_mart_rows": _STAR
    + "SELECT customer_id, first_name, last_name, address, pincode, phone_number, sales_date, total_cost FROM star",
    "sales_mart_rows": _STAR
    + """SELECT store_id, sales_person_id, sales_person_first_name, sales_person_last_name, store_manager_name,
       manager_id, is_manager, sales_person_address, sales_person_pincode, sales_date, total_cost,
       strftime(sales_date, '%Y-%m') AS sales_month FROM star""",
    "customer_monthly_sales": _CUSTOMER_MONTHLY,
    "customer_monthly_sales_window": _STAR
    + """
SELECT DISTINCT customer_id, first_name || ' ' || last_name AS full_name, address, phone_number,
       strftime(sales_date, '%Y-%m') AS sales_date_month,
       CAST(sum(total_cost) OVER (PARTITION BY customer_id, strftime(sales_date, '%Y-%m')) AS DECIMAL(18,2))
         AS total_sales
FROM star""",
    "sales_person_monthly_sales": _STAR + "," + PERSON_MONTHLY + " SELECT * FROM monthly",
    "sales_incentive": _STAR + "," + PERSON_MONTHLY + INCENTIVE_SELECT,
    "incentive_ties": _STAR
    + """
, counts AS (
  SELECT store_id, strftime(sales_date, '%Y-%m') AS sales_month, sales_person_id, count(*) AS n_lines
  FROM star GROUP BY store_id, strftime(sales_date, '%Y-%m'), sales_person_id)
SELECT store_id, sales_month, sales_person_id, n_lines,
       CAST(rank() OVER (PARTITION BY store_id, sales_month ORDER BY n_lines DESC) AS INTEGER) AS rnk
FROM counts""",
    "month_key": """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS sales_month,
       substr(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), 1, 7) AS sales_month_text
FROM orders""",
    "full_name": "SELECT c_custkey AS customer_id, c_name || ' ' || c_mktsegment AS full_name FROM customer",
    "run_stamp": """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS stamp, epoch(o_orderdate)::BIGINT * 1000 AS epoch_ms
FROM orders""",
    "pack_extra_columns": """
SELECT l_orderkey, l_linenumber, concat_ws(',', nullif(l_returnflag, 'N'), l_linestatus) AS additional_column
FROM lineitem""",
    "event_stamp": """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamp, CAST(floor(epoch(ts)) AS BIGINT) * 1000 AS epoch_ms
FROM events""",
    "file_ledger_state": """
SELECT 'run-1' AS run_id, 'order-' || o_orderkey || '.csv' AS file_name,
       CASE WHEN o_orderstatus = 'F' THEN 'I' ELSE 'A' END AS status FROM orders
UNION ALL SELECT 'run-2', 'order-' || o_orderkey || '.csv', 'I' FROM orders WHERE o_orderstatus = 'P'""",
    "file_restart_check": """
SELECT '/drop/order-' || o_orderkey || '.csv' AS path, 'order-' || o_orderkey || '.csv' AS file_name
FROM orders WHERE o_orderstatus NOT IN ('F', 'P')""",
    "file_valid_copies": """
SELECT 'run-1' AS run_id, '/drop/order-' || o_orderkey || '.csv' AS source_file
FROM orders WHERE o_orderstatus <> 'F'""",
    "union_facts": "WITH"
    + _PRICED_LINES
    + """
SELECT customer_id, store_id, product_name, sales_date, sales_person_id, price, quantity, total_cost,
       CAST(NULL AS VARCHAR) AS additional_column FROM lines WHERE o_orderstatus = 'F'
UNION ALL
SELECT customer_id, store_id, product_name, sales_date, sales_person_id, price, quantity, total_cost,
       concat_ws(',', l_returnflag, l_linestatus) AS additional_column FROM lines WHERE o_orderstatus <> 'F'""",
    "ledger_lookup": """
SELECT DISTINCT o_custkey AS customer_id FROM orders
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus = 'O'""",
    "ledger_state": """
SELECT user_id, arg_max(event_type, (ts, event_id)) AS status, max(ts) AS updated_ts FROM events GROUP BY user_id""",
    "ledger_incomplete": """
SELECT c_custkey AS customer_id, c_name AS first_name FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus <> 'F')""",
}

QUERIES: dict[str, Query] = {
    "star_join": q_star_join,
    "customer_mart_rows": q_customer_mart_rows,
    "sales_mart_rows": q_sales_mart_rows,
    "customer_monthly_sales": q_customer_monthly_sales,
    "customer_monthly_sales_window": q_customer_monthly_sales_window,
    "sales_person_monthly_sales": q_sales_person_monthly_sales,
    "sales_incentive": q_sales_incentive,
    "incentive_ties": q_incentive_ties,
    "month_key": q_month_key,
    "full_name": q_full_name,
    "run_stamp": q_run_stamp,
    "event_stamp": q_event_stamp,
    "pack_extra_columns": q_pack_extra_columns,
    "union_facts": q_union_facts,
    "ledger_lookup": q_ledger_lookup,
    "ledger_state": q_ledger_state,
    "ledger_incomplete": q_ledger_incomplete,
    "file_ledger_state": q_file_ledger_state,
    "file_restart_check": q_file_restart_check,
    "file_valid_copies": q_file_valid_copies,
}
