"""Marts built from the enriched sales frame.

Row marts are projections. The monthly totals are grouped aggregations (partial sums before the shuffle), not the
reference's ``sum() OVER (PARTITION BY …)`` + ``distinct``, which would ship and sort every fact row. The window form
is kept as ``customer_monthly_sales_window`` with the same result rules, but built from two pre-aggregated sides.

The top-seller incentive is the reference's ``rank() = 1`` rule expressed through the group maximum: a row ranks
first exactly when its total equals the maximum of its (store, month); when every total of the group is NULL every
row ranks first. The maximum is a grouped aggregate and the join back is on a small per-(store, month) table, so no
task ever holds a whole (store, month) group, however hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillgrid.functions.scalars import full_name, incentive_from_max, month_key, top_rank_incentive
from tillgrid.operators.enrich import customer_side, team_side
from tillgrid.operators.ranking import rank_desc
from tillgrid.operators.sizing import broadcast_each
from tillgrid.schemas import CUSTOMER_MART_COLUMNS, MONEY, SALES_MART_COLUMNS


def customer_mart_rows(enriched: DataFrame) -> DataFrame:
    """Row-level customer mart (8 columns)."""
    return enriched.select(*CUSTOMER_MART_COLUMNS)


def sales_mart_rows(enriched: DataFrame) -> DataFrame:
    """Row-level sales-team mart (12 columns) with the ``yyyy-MM`` month key."""
    return enriched.withColumn("sales_month", month_key("sales_date")).select(*SALES_MART_COLUMNS)


def customer_monthly_sales(enriched: DataFrame) -> DataFrame:
    """Total sales per customer and month: customer_id, full_name, address, phone_number, sales_date_month,
    total_sales. Grouped on the customer's attributes too, so a customer id with two attribute sets gives two rows."""
    return (
        enriched.select(
            "customer_id",
            full_name("first_name", "last_name").alias("full_name"),
            "address",
            "phone_number",
            month_key("sales_date").alias("sales_date_month"),
            "total_cost",
        )
        .groupBy("customer_id", "full_name", "address", "phone_number", "sales_date_month")
        .agg(F.sum("total_cost").cast(MONEY).alias("total_sales"))
    )


def customer_monthly_sales_window(enriched: DataFrame) -> DataFrame:
    """The reference's window form: the total is over (customer_id, month) only, and every distinct attribute set
    of that key gets the combined total. Built from one pass: sums per attribute set (combined map-side), then per key
    the sum of those sums with the list of its attribute sets, which is as long as the dimension has rows of one id."""
    rows = enriched.select(
        "customer_id",
        full_name("first_name", "last_name").alias("full_name"),
        "address",
        "phone_number",
        month_key("sales_date").alias("sales_date_month"),
        "total_cost",
    )
    attributes = ["full_name", "address", "phone_number"]
    sums = rows.groupBy("customer_id", "sales_date_month", *attributes).agg(F.sum("total_cost").alias("_sum"))
    totals = sums.groupBy("customer_id", "sales_date_month").agg(
        F.sum("_sum").cast(MONEY).alias("total_sales"), F.collect_list(F.struct(*attributes)).alias("_sets")
    )
    return totals.withColumn("_set", F.explode("_sets")).select(
        "customer_id", *[F.col(f"_set.{a}") for a in attributes], "sales_date_month", "total_sales"
    )


def sales_person_monthly_sales(enriched: DataFrame) -> DataFrame:
    """Total sales per store, sales person and month."""
    return (
        enriched.select(
            "store_id",
            "sales_person_id",
            full_name("sales_person_first_name", "sales_person_last_name").alias("full_name"),
            month_key("sales_date").alias("sales_month"),
            "total_cost",
        )
        .groupBy("store_id", "sales_person_id", "full_name", "sales_month")
        .agg(F.sum("total_cost").cast(MONEY).alias("total_sales"))
    )


def with_incentive(monthly: DataFrame) -> DataFrame:
    """Add ``incentive``: 1 % of the total (rounded half-up to cents) for every top seller of a (store, month),
    0 for the rest, NULL when the whole group has no total.

    ``tops`` has one row per (store, month). It is not hinted: proving its size would run the whole aggregation a
    second time. AQE measures its shuffle output and turns the join into a broadcast when it is small; otherwise it
    stays a shuffle join in which every monthly row meets exactly one ``tops`` row (AQE splits a hot key).
    """
    tops = monthly.groupBy(F.col("store_id").alias("_store"), F.col("sales_month").alias("_month")).agg(
        F.max("total_sales").alias("_top")
    )
    # Null-safe: sales with no valid date form a (store, NULL) group of their own, as in the rank window.
    same_group = F.col("store_id").eqNullSafe(F.col("_store")) & F.col("sales_month").eqNullSafe(F.col("_month"))
    return monthly.join(tops, same_group).select(
        "store_id",
        "sales_person_id",
        "full_name",
        "sales_month",
        "total_sales",
        incentive_from_max("total_sales", "_top").alias("incentive"),
    )


def sales_incentive(enriched: DataFrame) -> DataFrame:
    """Sales-team data mart: store_id, sales_person_id, full_name, sales_month, total_sales, incentive."""
    return with_incentive(sales_person_monthly_sales(enriched))


def _keys(dimension: DataFrame, id_col: str, key: str) -> DataFrame:
    """The dimension's keys. A semi join on them keeps the sales with a known key and never multiplies a sale."""
    return dimension.select(F.col(id_col).alias(key))


def customer_monthly_by_key(fact: DataFrame, customer: DataFrame, store: DataFrame, team: DataFrame) -> DataFrame:
    """The columns of ``customer_monthly_sales``, summed by (customer, month) before any attribute is joined.

    Sales pass slim semi joins on the keys, partial sums are shuffled, and the attributes meet one row per (customer,
    month). The total belongs to the customer id, so attributes that changed between loads never split it; an id
    with two dimension rows gives two rows with the whole total."""
    stores, people, attributes = broadcast_each(
        [_keys(store, "id", "store_id"), _keys(team, "id", "sales_person_id"), customer_side(customer)]
    )
    keyed = fact.join(stores, "store_id", "left_semi").join(people, "sales_person_id", "left_semi")
    totals = keyed.groupBy("customer_id", month_key("sales_date").alias("sales_date_month")).agg(
        F.sum("total_cost").cast(MONEY).alias("total_sales")
    )
    return totals.join(attributes, "customer_id").select(
        "customer_id",
        full_name("first_name", "last_name").alias("full_name"),
        "address",
        "phone_number",
        "sales_date_month",
        "total_sales",
    )


def sales_person_monthly_by_key(fact: DataFrame, customer: DataFrame, store: DataFrame, team: DataFrame) -> DataFrame:
    """The columns of ``sales_person_monthly_sales``, summed by (store, sales person, month) before names are joined, so
    a renamed sales person keeps one total."""
    stores, customers, attributes = broadcast_each(
        [_keys(store, "id", "store_id"), _keys(customer, "customer_id", "customer_id"), team_side(team)]
    )
    keyed = fact.join(stores, "store_id", "left_semi").join(customers, "customer_id", "left_semi")
    totals = keyed.groupBy("store_id", "sales_person_id", month_key("sales_date").alias("sales_month")).agg(
        F.sum("total_cost").cast(MONEY).alias("total_sales")
    )
    return totals.join(attributes, "sales_person_id").select(
        "store_id",
        "sales_person_id",
        full_name("sales_person_first_name", "sales_person_last_name").alias("full_name"),
        "sales_month",
        "total_sales",
    )


def sales_incentive_by_key(fact: DataFrame, customer: DataFrame, store: DataFrame, team: DataFrame) -> DataFrame:
    """The columns of ``sales_incentive`` from totals by key: a renamed sales person keeps one place in the ranking."""
    return with_incentive(sales_person_monthly_by_key(fact, customer, store, team))


def known_sales(fact: DataFrame, customer: DataFrame, store: DataFrame, team: DataFrame) -> DataFrame:
    """Sales whose customer, store and sales person are all known: the star's rows, without its attributes."""
    stores, customers, people = broadcast_each(
        [_keys(store, "id", "store_id"), _keys(customer, "customer_id", "customer_id"), _keys(team, "id", "sales_person_id")]
    )
    keyed = fact.join(stores, "store_id", "left_semi").join(customers, "customer_id", "left_semi")
    return keyed.join(people, "sales_person_id", "left_semi")


def rank_within(df: DataFrame, group: list[str], value: str, name: str = "rnk") -> DataFrame:
    """``rank() OVER (PARTITION BY group ORDER BY value DESC NULLS LAST)``: ties share a rank.

    A window puts each group in one task: use it only where a group is known to be small. ``rank_desc`` gives the
    same ranks without that limit, and ``with_incentive`` needs only "is first" and avoids ranking entirely.
    """
    w = Window.partitionBy(*group).orderBy(F.col(value).desc_nulls_last())
    return df.withColumn(name, F.rank().over(w))


def incentive_by_rank(monthly: DataFrame) -> DataFrame:
    """The incentive through an explicit rank, for callers that also want the rank column."""
    ranked = rank_desc(monthly, ["store_id", "sales_month"], "total_sales")
    return ranked.withColumn("incentive", top_rank_incentive("rnk", "total_sales"))
