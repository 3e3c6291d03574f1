"""Scalar expressions: month key, full name, packing of extras, incentive arithmetic, stamps."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tillgrid.functions import scalars


def test_month_key_of_date_and_text(spark):
    df = spark.createDataFrame([(dt.date(2023, 3, 3),), (None,)], "d date")
    got = df.select(
        scalars.month_key("d").alias("m"), scalars.month_key_of_text(F.col("d").cast("string")).alias("t")
    ).collect()
    assert [(r.m, r.t) for r in got] == [("2023-03", "2023-03"), (None, None)]


def test_full_name_is_null_when_a_part_is_null(spark):
    df = spark.createDataFrame([("Ines", "Marsh"), ("Otto", None), (None, "Holm")], "f string, l string")
    got = [r[0] for r in df.select(scalars.full_name("f", "l")).collect()]
    assert got == ["Ines Marsh", None, None]


def test_pack_columns_skips_nulls_and_keeps_order(spark):
    df = spark.createDataFrame([("cash", "x"), (None, "y"), (None, None)], "a string, b string")
    got = [r[0] for r in df.select(scalars.pack_columns(["a", "b"])).collect()]
    assert got == ["cash,x", "y", ""]
    none = df.select(scalars.pack_columns([]).alias("p"))
    assert {r.p for r in none.collect()} == {None}
    assert dict(none.dtypes)["p"] == "string"


def test_incentive_rounds_half_up_on_decimals(spark):
    df = spark.createDataFrame(
        [(Decimal("100.50"), 1), (Decimal("103.00"), 1), (Decimal("50.00"), 2), (None, 1)],
        "t decimal(18,2), r int",
    )
    got = [r[0] for r in df.select(scalars.top_rank_incentive("r", "t")).collect()]
    assert got == [Decimal("1.01"), Decimal("1.03"), Decimal("0.00"), None]


def test_incentive_from_max_matches_rank_rule(spark):
    df = spark.createDataFrame(
        [(Decimal("10.00"), Decimal("10.00")), (Decimal("5.00"), Decimal("10.00")), (None, Decimal("10.00")),
         (None, None)],
        "t decimal(18,2), m decimal(18,2)",
    )
    got = [r[0] for r in df.select(scalars.incentive_from_max("t", "m")).collect()]
    # NULL total under a non-NULL maximum ranks after it (NULLS LAST): incentive 0.
    assert got == [Decimal("0.10"), Decimal("0.00"), Decimal("0.00"), None]


def test_stamp_and_epoch_millis(spark):
    df = spark.createDataFrame([(dt.datetime(2023, 3, 3, 10, 20, 30),)], "ts timestamp_ntz")
    r = df.select(scalars.stamp_text("ts").alias("s"), scalars.epoch_millis("ts").alias("e")).first()
    assert r.s == "2023-03-03 10:20:30"
    assert r.e == int(dt.datetime(2023, 3, 3, 10, 20, 30, tzinfo=dt.timezone.utc).timestamp()) * 1000
