"""JDBC mart sink.

``append`` is the reference's load mode (a rerun adds a second copy). ``replace`` overwrites the table with
``truncate`` so its definition (types, keys, grants) survives. Errors are raised, never swallowed: a failed load must
fail the job. ``num_partitions`` caps the number of concurrent connections; ``batch_size`` sets rows per insert
batch.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: money type of the mart tables in the database (DECIMAL(10,2)).
TABLE_MONEY = "decimal(10,2)"


def write_table(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str],
    mode: str = "append",
    num_partitions: int | None = None,
    batch_size: int = 10_000,
) -> None:
    """Write ``df`` to a database table: ``mode`` is ``append`` or ``replace``."""
    if mode not in ("append", "replace"):
        raise ValueError(f"unknown JDBC load mode {mode!r}")
    props = dict(properties)
    props.setdefault("batchsize", str(batch_size))
    if num_partitions:
        props["numPartitions"] = str(num_partitions)
    if mode == "replace":
        props["truncate"] = "true"
        df.write.jdbc(url, table, mode="overwrite", properties=props)
    else:
        df.write.jdbc(url, table, mode="append", properties=props)


def customers_table_rows(mart: DataFrame) -> DataFrame:
    """The customer month mart in the table's types: the ``yyyy-MM`` month becomes the DATE of its first day and
    the total a DECIMAL(10,2). A total too large for the column raises under ANSI instead of loading a wrong value."""
    return mart.select(
        "customer_id",
        "full_name",
        "address",
        "phone_number",
        F.to_date(F.concat(F.col("sales_date_month"), F.lit("-01"))).alias("sales_date_month"),
        F.col("total_sales").cast(TABLE_MONEY).alias("total_sales"),
    )


def sales_team_table_rows(mart: DataFrame) -> DataFrame:
    """The sales-team mart in the table's types (money as DECIMAL(10,2); the month stays ``yyyy-MM`` text)."""
    return mart.select(
        "store_id",
        "sales_person_id",
        "full_name",
        "sales_month",
        F.col("total_sales").cast(TABLE_MONEY).alias("total_sales"),
        F.col("incentive").cast(TABLE_MONEY).alias("incentive"),
    )
