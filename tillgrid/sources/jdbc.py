"""JDBC dimension source.

The reference reads each dimension in one JDBC partition. Here a numeric key and its bounds split the read into
``num_partitions`` range queries, filters and column pruning are pushed into the database's SQL, and the driver
class, user and password come from the caller's properties (never from source code).

A JDBC relation has no size statistics (Spark assumes it is huge), so joins against it are not broadcast unless
``tillgrid.operators.sizing.broadcast_if_small`` proves the side small.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """``spark.read.jdbc`` with optional range partitioning on ``partition_column``."""
    props = dict(properties)
    props.setdefault("fetchsize", str(fetch_size))
    if partition_column is None:
        return spark.read.jdbc(url, table, properties=props)
    if lower_bound is None or upper_bound is None or not num_partitions:
        raise ValueError("a partitioned JDBC read needs lower_bound, upper_bound and num_partitions")
    return spark.read.jdbc(
        url,
        table,
        column=partition_column,
        lowerBound=lower_bound,
        upperBound=upper_bound,
        numPartitions=num_partitions,
        properties=props,
    )


def read_dimension(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    key: str,
    num_partitions: int = 8,
) -> DataFrame:
    """A dimension table read in ``num_partitions`` key ranges; the bounds come from one ``min``/``max`` query
    (pushed to the database as an aggregate where the dialect allows it)."""
    props = {**dict(properties), "pushDownAggregate": "true"}
    bounds = spark.read.jdbc(url, table, properties=props).agg(F.min(key), F.max(key)).first()
    if bounds is None or bounds[0] is None:
        return read_table(spark, url, table, properties)
    return read_table(spark, url, table, properties, key, int(bounds[0]), int(bounds[1]), num_partitions)
