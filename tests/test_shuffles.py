"""Rows are computed once for all files of a drop, and rows that stand together are written without a shuffle."""

from __future__ import annotations

import time
from collections import defaultdict
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tillgrid.plans import pipeline, roundtrips
from tillgrid.plans.intake import store_rejected_lines
from tillgrid.session import shuffles_freed
from tillgrid.sinks import files as sinks
from tillgrid.sources import tables


def test_a_drop_computes_its_lines_once(spark, sf_dir, tmp_path, monkeypatch):
    made, original = spark.sparkContext.accumulator(0), tables.sales_lines

    def counted(*args, **kw):
        lines = original(*args, **kw)

        def count(batches):
            for b in batches:
                made.add(b.num_rows)
                yield b

        return lines.mapInArrow(count, lines.schema)

    monkeypatch.setattr(tables, "sales_lines", counted)
    roundtrips.write_sales_drop(spark, sf_dir, str(tmp_path), parts=("F", "O", "P"))
    written = spark.read.text([str(tmp_path / p) for p in ("F", "O", "P")])
    header = F.col("value").contains("customer_id")
    assert made.value == written.where(~header).count() == tables.table(spark, sf_dir, "lineitem").count()


def test_lines_are_dealt_before_broadcast_lookups_only(spark, sf_dir):
    def dealt(df):
        return df.repartitionByRange("sales_date")

    plain = tables.sales_lines(spark, sf_dir, with_product=True)
    before = tables.sales_lines(spark, sf_dir, with_product=True, deal=dealt)
    plan = before._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join LeftOuter") < plan.index("RepartitionByExpression")
    spark.conf.set("tillgrid.broadcast.maxRows", "1")
    try:
        after = tables.sales_lines(spark, sf_dir, with_product=True, deal=dealt)
        plan = after._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("Join LeftOuter") > plan.index("RepartitionByExpression")
        assert rows(after) == rows(before) == rows(plain)
    finally:
        spark.conf.unset("tillgrid.broadcast.maxRows")


def test_rejected_lines_are_written_by_the_tasks_that_read_them(spark, tmp_path):
    lines = spark.range(30).repartition(3).selectExpr("'f' as path", "'f' as file_name", "'no' as reason", "string(id) as value")
    for _ in range(2):
        store_rejected_lines(lines, str(tmp_path / "store"), "r")
    assert len(list((tmp_path / "store" / "run_id=r").glob("*.parquet"))) == 3
    assert spark.read.parquet(str(tmp_path / "store")).count() == 30


def test_together_keeps_partitions_and_order(spark, tmp_path):
    months = F.format_string("2024-%02d", (F.col("id") / 100).cast("int") + 1)
    df = spark.range(0, 1200, 1, 4).select((F.col("id") % 7).alias("store_id"), "id", months.alias("m"))
    stands = sinks.written(df, str(tmp_path / "stands"))
    mixed = sinks.written(df.repartition(40), str(tmp_path / "mixed"))
    assert sinks.stand_together(stands, "m") and not sinks.stand_together(mixed, "m")
    assert sinks.stand_together(stands.limit(0), "m")
    target = str(tmp_path / "by_month")
    sinks.write_clustered(stands, target, ["m"], ["store_id"], together=True)
    assert rows(spark.read.parquet(target).select("store_id", "id", "m")) == rows(df)
    sinks.replace_partitions(stands.where("m >= '2024-11'"), target, ["m"], [("2024-10",), ("2024-11",)], together=True)
    left = {r[0] for r in spark.read.parquet(target).select("m").distinct().collect()}
    assert left == {f"2024-{k:02d}" for k in range(1, 13) if k != 10}


def _shuffle_files(spark):
    files = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (files.apply(k).getName() for k in range(files.size())) if n.startswith("shuffle_")}


def _left(spark, before):
    """Shuffle files that stay; they go a moment after an execution has ended."""
    for _ in range(50):
        if not (left := _shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    return left


def test_shuffle_files_go_with_their_write(spark, tmp_path):
    df, before = spark.range(1000).repartition(3, "id"), _shuffle_files(spark)
    with shuffles_freed(spark):
        df.write.parquet(str(tmp_path / "a"))
    assert not _left(spark, before)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    assert df.where("id < 10").count() == 10 and spark.read.parquet(str(tmp_path / "a")).count() == 1000


@pytest.fixture
def own_tables(spark, tmp_path):
    """Tables of 60 orders from late 1996 to 1998, one without a date and one of an unknown customer; (folder, sales)."""
    base = str(tmp_path / "tables")
    days = [date(1996 + k // 28, 1 + k % 12, 1 + k % 27) for k in range(58)] + [None, date(1998, 12, 31)]
    orders = [(k, 99 if k == 59 else k % 3, "F", 1.0, d and datetime(d.year, d.month, d.day), "x") for k, d in enumerate(days)]
    lines = [
        (k, k % 4, (k + n) % 5, n, float(n), 10.0 * k + n, "R", "O") for k in range(60) for n in range(1, 1 + k % 4)
    ]
    frames = {
        "orders": (orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                           "o_orderdate timestamp, o_orderpriority string"),
        "lineitem": (lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                            "l_extendedprice double, l_returnflag string, l_linestatus string"),
        "customer": ([(k, f"c{k}", 1, "m") for k in range(3)],
                     "c_custkey long, c_name string, c_nationkey int, c_mktsegment string"),
        "supplier": ([(k, f"s{k}", k % 2) for k in range(5)], "s_suppkey long, s_name string, s_nationkey int"),
        "part": ([(k, f"p, {k}", 1.5) for k in range(3)], "p_partkey long, p_name string, p_retailprice double"),
        "nation": ([(k, f"n{k}", 0) for k in range(2)], "n_nationkey int, n_name string, n_regionkey int"),
    }
    for name, (data, schema) in frames.items():
        spark.createDataFrame(data, schema).write.parquet(f"{base}/{name}.parquet")
    return base, [(days[k], person % 2, person, total) for k, _, person, _, _, total, *_ in lines if k != 59]


def test_a_corrected_file_is_written_from_lines_laid_aside(spark, own_tables, monkeypatch):
    sf_dir, sales = own_tables
    seen, real, before = [], pipeline.run, _shuffle_files(spark)

    def run(session, incoming, dims, out, *args, **kw):
        base = out.rsplit("/", 1)[0]
        found = {n for n in roundtrips.folders.names(spark, base) if n in ("early", "late", "corrected")}
        seen.append((found, _left(spark, before) if not seen else set(), roundtrips.folders.exists(spark, f"{base}/aside")))
        return real(session, incoming, dims, out, *args, **kw)

    monkeypatch.setattr(pipeline, "run", run)
    got = roundtrips.q_corrected_file(spark, sf_dir)
    # One copy of each file on disk, no shuffle files left from writing them, and the lines laid aside gone at the end.
    assert seen == [({"early", "late"}, set(), True), ({"early", "late"}, set(), False)]
    totals = defaultdict(float)
    for day, store, person, total in sales:
        if day is not None:
            totals[store, person, f"{day.year - (day.year == 1998)}-{day.month:02d}"] += total
    expected = sorted((*k, t, r) for k, t in totals.items() for r in ("folder", "snapshot"))
    found = rows(got, "store_id", "sales_person_id", "sales_month", F.col("total_sales").cast("double"), "read")
    assert found == expected


def test_named_files_hold_the_same_orders_however_often_they_are_written(spark, own_tables, tmp_path):
    sf_dir, sales = own_tables
    lines = roundtrips._lines_aside(spark, sf_dir, str(tmp_path / "aside"), lanes=6)
    for folder, part in (("all", lines), ("again", lines.withColumn("price", F.lit("x"))), ("two", lines)):
        roundtrips._named_csv(spark, part, str(tmp_path / folder), 2 if folder == "two" else 3)
    assert [p.name for p in sorted((tmp_path / "all").glob("*.csv"))] == ["sales-0.csv", "sales-1.csv", "sales-2.csv"]

    def totals(file):
        return rows(spark.read.option("header", "true").csv(str(file)), "total_cost", "sales_date")

    for k in range(3):
        assert totals(tmp_path / "all" / f"sales-{k}.csv") == totals(tmp_path / "again" / f"sales-{k}.csv")
    order = F.expr("l_orderkey")
    dealt = tables.sales_lines(spark, sf_dir, with_product=True).withColumn("k", F.pmod(F.hash(order), F.lit(2)))
    for k in range(2):
        want = dealt.where(F.col("k") == k).select(F.col("total_cost").cast("string"), F.col("sales_date").cast("string"))
        assert totals(tmp_path / "two" / f"sales-{k}.csv") == rows(want)
