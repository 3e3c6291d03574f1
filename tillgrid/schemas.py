"""Declared schemas of the sales fact, the dimensions and the marts.

Money is DECIMAL(18,2) inside the library (exact, order-independent sums) and the month key is ``yyyy-MM`` text.
Keys are LONG so that a fact with billions of customers or sales people still fits.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The mandatory header of a sales file, in the order of the conformed fact.
MANDATORY_COLUMNS = (
    "customer_id",
    "store_id",
    "product_name",
    "sales_date",
    "sales_person_id",
    "price",
    "quantity",
    "total_cost",
)

EXTRA_COLUMN = "additional_column"
MONEY = T.DecimalType(18, 2)
# Rate of the top seller's incentive (1 %), kept as an exact decimal.
INCENTIVE_RATE = "0.01"

SALES_FACT = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("store_id", T.LongType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("sales_date", T.DateType()),
        T.StructField("sales_person_id", T.LongType()),
        T.StructField("price", MONEY),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("total_cost", MONEY),
        T.StructField(EXTRA_COLUMN, T.StringType()),
    ]
)

CUSTOMER = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("first_name", T.StringType()),
        T.StructField("last_name", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("pincode", T.StringType()),
        T.StructField("phone_number", T.StringType()),
        T.StructField("customer_joining_date", T.DateType()),
    ]
)

STORE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("address", T.StringType()),
        T.StructField("store_pincode", T.StringType()),
        T.StructField("store_manager_name", T.StringType()),
        T.StructField("store_opening_date", T.DateType()),
        T.StructField("reviews", T.StringType()),
    ]
)

SALES_TEAM = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("first_name", T.StringType()),
        T.StructField("last_name", T.StringType()),
        T.StructField("manager_id", T.LongType()),
        T.StructField("is_manager", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("pincode", T.StringType()),
        T.StructField("joining_date", T.DateType()),
    ]
)

# File ledger: one row per (run, file, status change); the current state is the latest row per key.
LEDGER = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("file_location", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("event_ts", T.TimestampType()),
        T.StructField("seq", T.LongType()),
    ]
)

# Output column lists of the row-level marts.
CUSTOMER_MART_COLUMNS = (
    "customer_id",
    "first_name",
    "last_name",
    "address",
    "pincode",
    "phone_number",
    "sales_date",
    "total_cost",
)

SALES_MART_COLUMNS = (
    "store_id",
    "sales_person_id",
    "sales_person_first_name",
    "sales_person_last_name",
    "store_manager_name",
    "manager_id",
    "is_manager",
    "sales_person_address",
    "sales_person_pincode",
    "sales_date",
    "total_cost",
    "sales_month",
)

# The customers' data mart (monthly totals).
CUSTOMERS_DATA_MART = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("full_name", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("phone_number", T.StringType()),
        T.StructField("sales_date_month", T.StringType()),
        T.StructField("total_sales", MONEY),
    ]
)

# The sales-team data mart (monthly totals with incentive).
SALES_TEAM_MART = T.StructType(
    [
        T.StructField("store_id", T.LongType()),
        T.StructField("sales_person_id", T.LongType()),
        T.StructField("full_name", T.StringType()),
        T.StructField("sales_month", T.StringType()),
        T.StructField("total_sales", MONEY),
        T.StructField("incentive", MONEY),
    ]
)
