"""Star join: the conformed sales fact enriched with customer, store and sales-team attributes.

Inner joins throughout, so a sale with an unknown or NULL customer, store or sales-person key drops out (as in the
reference). Dimension columns are renamed *before* the join, so the result has no duplicate names and every column
can be addressed without a qualifier. The fact's product, price, quantity and extra columns are not carried into
the enriched frame (no mart uses them).

Each dimension goes through ``broadcast_if_small``: an exact row count proves it small before it is broadcast;
a dimension beyond the bound is left to a shuffle join (with AQE's skew split on the fact side).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillgrid.operators.sizing import broadcast_each

ENRICHED_COLUMNS = (
    "customer_id",
    "store_id",
    "sales_person_id",
    "sales_date",
    "total_cost",
    "first_name",
    "last_name",
    "address",
    "pincode",
    "phone_number",
    "store_address",
    "store_manager_name",
    "sales_person_first_name",
    "sales_person_last_name",
    "manager_id",
    "is_manager",
    "sales_person_address",
    "sales_person_pincode",
)


def customer_side(customer: DataFrame) -> DataFrame:
    return customer.select("customer_id", "first_name", "last_name", "address", "pincode", "phone_number")


def store_side(store: DataFrame) -> DataFrame:
    return store.select(
        F.col("id").alias("store_id"),
        F.col("address").alias("store_address"),
        "store_manager_name",
    )


def team_side(team: DataFrame) -> DataFrame:
    return team.select(
        F.col("id").alias("sales_person_id"),
        F.col("first_name").alias("sales_person_first_name"),
        F.col("last_name").alias("sales_person_last_name"),
        "manager_id",
        "is_manager",
        F.col("address").alias("sales_person_address"),
        F.col("pincode").alias("sales_person_pincode"),
    )


def star_join(
    fact: DataFrame,
    customer: DataFrame,
    store: DataFrame,
    team: DataFrame,
    max_broadcast_rows: int | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``fact ⋈ customer ⋈ store ⋈ sales_team`` (inner), columns as in ``ENRICHED_COLUMNS`` plus ``carry`` (fact
    columns passed through, such as the source file)."""
    facts = fact.select("customer_id", "store_id", "sales_person_id", "sales_date", "total_cost", *carry)
    # Inner joins commute; the sales team goes first so that, when neither side is broadcast, a fact already
    # partitioned on the sales-person key (as the driver tables' fact is, by its supplier lookup) is not shuffled
    # again for it. Beyond the broadcast bound each join is a sort-merge join on its own key.
    people, stores, customers = broadcast_each(
        [team_side(team), store_side(store), customer_side(customer)], max_broadcast_rows
    )
    joined = facts.join(people, "sales_person_id").join(stores, "store_id").join(customers, "customer_id")
    return joined.select(*ENRICHED_COLUMNS, *carry)
