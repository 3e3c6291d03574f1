"""Size-checked broadcast: a proven-small side is hinted, a side over the bound is left to a shuffle join."""

from __future__ import annotations

from tillgrid.operators.sizing import broadcast_if_small, has_at_most


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bounded_count(spark):
    df = spark.range(10)
    assert has_at_most(df, 10) and not has_at_most(df, 9)


def test_broadcast_only_within_bound(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = spark.range(1000).withColumnRenamed("id", "k")
        dim = spark.range(50).withColumnRenamed("id", "k")
        small = fact.join(broadcast_if_small(dim, 100), "k")
        assert "BroadcastHashJoin" in _plan(small)
        big = fact.join(broadcast_if_small(dim, 10), "k")
        assert "BroadcastHashJoin" not in _plan(big)
        assert small.count() == big.count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_verdict_follows_new_files(spark, tmp_path):
    p = str(tmp_path / "dim")
    spark.range(5).write.parquet(p)
    assert has_at_most(spark.read.parquet(p), 5)
    assert has_at_most(spark.read.parquet(p), 5)  # cached verdict, same plan and files
    spark.range(5).write.mode("append").parquet(p)
    assert not has_at_most(spark.read.parquet(p), 5)


def test_bytes_are_bounded_too(spark):
    from pyspark.sql import functions as F

    wide = spark.range(10).withColumn("address", F.repeat(F.lit("x"), 1000)).withColumn("tags", F.array(F.lit("a")))
    assert has_at_most(wide, 10, 20_000) and not has_at_most(wide, 10, 9_000)
    assert has_at_most(spark.range(0), 0)
