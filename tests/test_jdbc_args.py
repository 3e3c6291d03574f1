"""JDBC adapters: argument checks only. No database is started in this environment, so no round trip is run."""

from __future__ import annotations

import pytest

from tillgrid.sinks import jdbc as jdbc_sink
from tillgrid.sources import jdbc as jdbc_source


def test_partitioned_read_needs_bounds_and_count(spark):
    with pytest.raises(ValueError):
        jdbc_source.read_table(spark, "jdbc:none", "t", {}, partition_column="id", lower_bound=1)


def test_unknown_load_mode_is_refused(spark):
    with pytest.raises(ValueError):
        jdbc_sink.write_table(spark.range(1), "jdbc:none", "t", {}, mode="upsert")


def test_table_types_of_the_marts(spark):
    import datetime as dt
    from decimal import Decimal

    cust = spark.createDataFrame(
        [(1, "A B", "x", "1", "2023-03", Decimal("103.00"))],
        "customer_id long, full_name string, address string, phone_number string, sales_date_month string, "
        "total_sales decimal(18,2)",
    )
    r = jdbc_sink.customers_table_rows(cust).first()
    assert r.sales_date_month == dt.date(2023, 3, 1) and r.total_sales == Decimal("103.00")
    team = spark.createDataFrame(
        [(121, 1, "A B", "2023-03", Decimal("103.00"), Decimal("1.03"))],
        "store_id long, sales_person_id long, full_name string, sales_month string, total_sales decimal(18,2), "
        "incentive decimal(18,2)",
    )
    assert dict(jdbc_sink.sales_team_table_rows(team).dtypes)["incentive"] == "decimal(10,2)"
