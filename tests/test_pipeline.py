"""The whole run on a small drop: outputs, ledger states and an idempotent second run."""

from __future__ import annotations

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from conftest import rows
from tillgrid.operators import ledger
from tillgrid.plans import pipeline
from tillgrid.schemas import CUSTOMER, MANDATORY_COLUMNS, SALES_TEAM, STORE

HEADER = ",".join(MANDATORY_COLUMNS)


def _one_percent(total: Decimal) -> Decimal:
    """1 % of a total, rounded half-up to cents (Spark's ``round``)."""
    return (total * Decimal("0.01")).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)


def _dims(spark):
    return pipeline.Dimensions(
        customer=spark.createDataFrame(
            [(1, "Cora", "Lind", "Ahlen", "100001", "555-0101", None),
             (2, "Didier", "Moss", "Ahlen", "100002", "555-0102", None)],
            CUSTOMER,
        ),
        store=spark.createDataFrame([(121, "Ahlen", "100003", "Edda", None, "fine")], STORE),
        team=spark.createDataFrame(
            [(1, "Finn", "Oster", 10, "N", "Ahlen", "100004", None),
             (2, "Gita", "Pell", 10, "N", "Ahlen", "100005", None)],
            SALES_TEAM,
        ),
    )


def test_run_writes_marts_rejects_and_ledger(spark, tmp_path):
    drop = tmp_path / "in"
    drop.mkdir()
    (drop / "s1.csv").write_text(f"{HEADER}\n1,121,oats,2023-03-03,1,100,1,100\n2,121,oats,2023-03-05,2,60,1,60\n")
    (drop / "s2.csv").write_text(f"{HEADER},payment_mode\n1,121,oats,2023-03-20,1,3,1,3,cash\n")
    (drop / "bad.csv").write_text("customer_id,total_cost\n1,5\n")
    out = str(tmp_path / "out")

    result = pipeline.run(spark, str(drop), _dims(spark), out, run_id="run-1")
    team_mart = spark.read.parquet(result.outputs["sales_team_data_mart"])
    assert rows(team_mart, "sales_person_id", "total_sales", "incentive") == [
        (1, Decimal("103.00"), Decimal("1.03")),
        (2, Decimal("60.00"), Decimal("0.00")),
    ]
    cust_mart = spark.read.parquet(result.outputs["customers_data_mart"])
    assert rows(cust_mart, "customer_id", "total_sales") == [(1, Decimal("103.00")), (2, Decimal("60.00"))]
    assert spark.read.parquet(result.outputs["customer_mart"]).count() == 3
    assert spark.read.parquet(result.outputs["sales_mart_partitioned"]).where(F.col("store_id") == 121).count() == 3
    assert [r.file_name for r in spark.read.parquet(result.outputs["rejects"]).collect()] == ["bad.csv"]

    state = pipeline.ledger_state(spark, out)
    assert rows(state, "file_name", "status") == [("s1.csv", "I"), ("s2.csv", "I")]

    assert result.leftovers.count() == 0

    # A run that opened s1.csv and stopped: the next run reports it before doing its own work.
    files = result.intake.files.where(F.col("file_name") == "s1.csv").select("path", "file_name")
    ledger.ledger_rows(spark, "run-0", files, ledger.ACTIVE, dt.datetime(2020, 1, 1), 0).write.mode("append").parquet(
        result.outputs["ledger"]
    )
    # Opened before run-1 finished the file, so it is not left over; opened again after that, it is.
    assert pipeline.unfinished_files(spark, out, result.intake.files).count() == 0
    since = dt.datetime.now(dt.timezone.utc)
    ledger.ledger_rows(spark, "run-0", files, ledger.ACTIVE, since, 1).write.mode("append").parquet(result.outputs["ledger"])

    # Second run over the same files: the monthly marts are replaced, not doubled.
    second = pipeline.run(spark, str(drop), _dims(spark), out, run_id="run-2")
    assert [r.file_name for r in second.leftovers.collect()] == ["s1.csv"]
    again = spark.read.parquet(result.outputs["sales_team_data_mart"])
    assert rows(again, "sales_person_id", "total_sales") == [(1, Decimal("103.00")), (2, Decimal("60.00"))]
    assert pipeline.ledger_state(spark, out).count() == 5


def test_months_add_up_over_runs_and_reruns_change_nothing(spark, tmp_path):
    out = str(tmp_path / "out")
    first, second = tmp_path / "in1", tmp_path / "in2"
    first.mkdir()
    second.mkdir()
    (first / "day1.csv").write_text(f"{HEADER}\n1,121,oats,2023-03-03,1,100,1,100\n2,121,oats,2023-03-05,2,60,1,60\n")
    (second / "day2.csv").write_text(f"{HEADER}\n2,121,oats,2023-03-20,2,50,1,50\n1,121,oats,2023-04-01,1,7,1,7\n")

    pipeline.run(spark, str(first), _dims(spark), out)
    pipeline.run(spark, str(second), _dims(spark), out)
    result = pipeline.run(spark, str(second), _dims(spark), out)  # the same file again
    team = spark.read.parquet(result.outputs["sales_team_data_mart"])
    assert rows(team, "sales_month", "sales_person_id", "total_sales", "incentive") == [
        ("2023-03", 1, Decimal("100.00"), Decimal("0.00")),
        ("2023-03", 2, Decimal("110.00"), Decimal("1.10")),
        ("2023-04", 1, Decimal("7.00"), Decimal("0.07")),
    ]
    customers = spark.read.parquet(result.outputs["customers_data_mart"])
    assert rows(customers, "sales_date_month", "customer_id", "total_sales") == [
        ("2023-03", 1, Decimal("100.00")),
        ("2023-03", 2, Decimal("110.00")),
        ("2023-04", 1, Decimal("7.00")),
    ]
    assert rows(result.enriched, "customer_id", "total_cost") == [(1, Decimal("7.00")), (2, Decimal("50.00"))]


def test_volume_file_of_one_date(spark, tmp_path):
    """The reference's volume case: 400,000 sales of one date, 3 stores x 3 persons. Every sale lands in one month,
    the hottest group possible; totals must equal a direct sum over the input."""
    drop = tmp_path / "in"
    n = 400_000
    lines = spark.range(n).select(
        (F.col("id") % 2 + 1).alias("customer_id"),
        F.lit(121).alias("store_id"),
        F.lit("oats").alias("product_name"),
        F.lit("2023-08-20").alias("sales_date"),
        (F.col("id") % 2 + 1).alias("sales_person_id"),
        F.lit("1.5").alias("price"),
        (F.col("id") % 10 + 1).alias("quantity"),
        ((F.col("id") % 10 + 1) * F.lit(1.5)).cast("decimal(18,2)").alias("total_cost"),
    )
    lines.coalesce(1).write.option("header", "true").csv(str(drop))
    out = str(tmp_path / "out")
    result = pipeline.run(spark, str(drop), _dims(spark), out)
    want = {
        r["sales_person_id"]: r["t"]
        for r in lines.groupBy("sales_person_id").agg(F.sum("total_cost").alias("t")).collect()
    }
    team = spark.read.parquet(result.outputs["sales_team_data_mart"])
    got = {r.sales_person_id: r.total_sales for r in team.collect()}
    assert got == want
    top = max(want.values())
    assert {r.sales_person_id: r.incentive for r in team.collect()} == {
        p: _one_percent(t) if t == top else Decimal("0.00") for p, t in want.items()
    }


def test_sale_with_a_bad_date_is_kept_under_a_null_month(spark, tmp_path):
    drop = tmp_path / "in"
    drop.mkdir()
    (drop / "d.csv").write_text(f"{HEADER}\n1,121,oats,2023-03-03,1,100,1,100\n2,121,oats,2023-13-45,2,60,1,60\n")
    out = str(tmp_path / "out")
    result = pipeline.run(spark, str(drop), _dims(spark), out)
    pipeline.run(spark, str(drop), _dims(spark), out)  # rerun: still one row per group
    team = spark.read.parquet(result.outputs["sales_team_data_mart"])
    got = {(r.sales_month, r.sales_person_id): (r.total_sales, r.incentive) for r in team.collect()}
    assert got == {
        ("2023-03", 1): (Decimal("100.00"), Decimal("1.00")),
        (None, 2): (Decimal("60.00"), Decimal("0.60")),
    }


def test_run_with_no_accepted_file(spark, tmp_path):
    drop = tmp_path / "in"
    drop.mkdir()
    (drop / "bad.csv").write_text("customer_id\n1\n")
    (drop / "readme.txt").write_text("hello\n")
    out = str(tmp_path / "out")
    result = pipeline.run(spark, str(drop), _dims(spark), out)
    assert result.enriched.count() == 0
    assert spark.read.parquet(result.outputs["rejects"]).count() == 2
    assert pipeline.ledger_state(spark, out).count() == 0


def test_renamed_person_and_moved_customer_keep_one_total(spark, tmp_path):
    """Person 1 and customer 1 change between two runs of a month: totals stay by key, and person 1 wins with 120."""
    out = str(tmp_path / "out")
    first, second = tmp_path / "in1", tmp_path / "in2"
    first.mkdir()
    second.mkdir()
    (first / "a.csv").write_text(f"{HEADER}\n1,121,oats,2023-03-03,1,60,1,60\n2,121,oats,2023-03-04,2,100,1,100\n")
    (second / "b.csv").write_text(f"{HEADER}\n1,121,oats,2023-03-20,1,60,1,60\n")
    dims = _dims(spark)
    pipeline.run(spark, str(first), dims, out)
    dims.team = dims.team.withColumn(
        "last_name", F.when(F.col("id") == 1, "Quist").otherwise(F.col("last_name"))
    )
    dims.customer = dims.customer.withColumn(
        "address", F.when(F.col("customer_id") == 1, "Borg").otherwise(F.col("address"))
    )
    result = pipeline.run(spark, str(second), dims, out)
    team = spark.read.parquet(result.outputs["sales_team_data_mart"])
    assert rows(team, "sales_person_id", "full_name", "total_sales", "incentive") == [
        (1, "Finn Quist", Decimal("120.00"), Decimal("1.20")),
        (2, "Gita Pell", Decimal("100.00"), Decimal("0.00")),
    ]
    customers = spark.read.parquet(result.outputs["customers_data_mart"])
    assert rows(customers, "customer_id", "address", "total_sales") == [
        (1, "Borg", Decimal("120.00")),
        (2, "Ahlen", Decimal("100.00")),
    ]


def test_rows_with_bad_values_are_reported(spark, tmp_path):
    drop = tmp_path / "in"
    drop.mkdir()
    good, bad_id, bad_two = (
        "1,121,oats,2023-03-03,1,100,1,100",
        "abc,121,oats,2023-03-03,1,7,1,7",
        "1,121,oats,2023-13-45,1,5,x,5",
    )
    (drop / "d.csv").write_text("\n".join([HEADER, good, bad_id, bad_two]) + "\n")
    result = pipeline.run(spark, str(drop), _dims(spark), str(tmp_path / "out"), run_id="r")
    got = spark.read.parquet(result.outputs["bad_rows"]).select("run_id", "bad_columns", "line").collect()
    assert sorted((r.run_id, sorted(r.bad_columns), r.line) for r in got) == [
        ("r", ["customer_id"], bad_id),
        ("r", ["quantity", "sales_date"], bad_two),
    ]
    assert spark.read.parquet(result.outputs["customer_mart"]).count() == 2


def test_a_repeated_run_replaces_its_own_rows(spark, tmp_path):
    drop = tmp_path / "in"
    drop.mkdir()
    (drop / "a.csv").write_text(f"{HEADER}\n1,121,oats,2023-03-03,1,60,1,60\nabc,121,oats,2023-03-04,2,9,1,9\n")
    for folder in ("n", "s"):
        (drop / folder).mkdir()
        (drop / folder / "bad.csv").write_text(f"customer_id\n{folder}\n")
    out = str(tmp_path / "out")
    first = pipeline.run(spark, str(drop), _dims(spark), out, run_id="r")
    again = pipeline.run(spark, str(drop), _dims(spark), out, run_id="r")
    assert again.run_ts == first.run_ts
    counts = {n: spark.read.parquet(first.outputs[n]).count()
              for n in ("rejects", "rejected_lines", "bad_rows", "customer_mart", "sales_mart_partitioned", "runs")}
    assert counts == {"rejects": 2, "rejected_lines": 2, "bad_rows": 1, "customer_mart": 1,
                      "sales_mart_partitioned": 1, "runs": 1}
    lines = spark.read.parquet(first.outputs["rejected_lines"]).collect()
    assert sorted((r.path[-9:], r.value) for r in lines) == [("n/bad.csv", "n"), ("s/bad.csv", "s")]
    team = spark.read.parquet(first.outputs["sales_team_data_mart"])
    assert rows(team, "sales_person_id", "total_sales") == [(1, Decimal("60.00"))]


def test_new_files_only_and_closed_runs_only(spark, tmp_path):
    drop = tmp_path / "in"
    drop.mkdir()
    (drop / "a.csv").write_text(f"{HEADER}\n1,121,oats,2023-03-03,1,60,1,60\n")
    out = str(tmp_path / "out")
    first = pipeline.run(spark, str(drop), _dims(spark), out, only_new=True)
    nothing = pipeline.run(spark, str(drop), _dims(spark), out, only_new=True)
    assert nothing.enriched.count() == 0
    # A run that broke off after it wrote a row mart is not the latest one.
    spark.read.parquet(first.outputs["customer_mart"]).drop("run_ts").limit(0).write.parquet(
        f"{first.outputs['customer_mart']}/run_ts={first.run_ts + 10**9}"
    )
    for name in ("customer_mart", "sales_mart", "sales_mart_partitioned"):
        assert rows(pipeline.read_latest(spark, out, name), "total_cost") == [(Decimal("60.00"),)]
    (drop / "b.csv").write_text(f"{HEADER}\n2,121,oats,2023-03-04,2,7,1,7\n")
    pipeline.run(spark, str(drop), _dims(spark), out, only_new=True)
    assert rows(pipeline.read_latest(spark, out, "customer_mart"), "total_cost") == [(Decimal("7.00"),)]
    team = spark.read.parquet(first.outputs["sales_team_data_mart"])
    assert rows(team, "sales_person_id", "total_sales") == [(1, Decimal("60.00")), (2, Decimal("7.00"))]
    report = spark.read.option("header", "true").csv(first.outputs["monthly_report"])
    assert rows(report, "sales_person_id", "total_sales") == [("1", "60.00"), ("2", "7.00")]


def test_sales_of_a_run_that_broke_off_count_once_a_run_finishes_their_file(spark, tmp_path):
    drop = tmp_path / "in"
    drop.mkdir()
    (drop / "a.csv").write_text(f"{HEADER}\n1,121,oats,2023-03-03,1,60,1,60\n")
    out = str(tmp_path / "out")
    first = pipeline.run(spark, str(drop), _dims(spark), out, run_id="good")
    # As a broken-off run leaves it: an opened file and a copy of its sales under another run id.
    files = first.intake.files.select("path", "file_name")
    ledger.ledger_rows(spark, "broken", files, ledger.ACTIVE, dt.datetime(2090, 1, 1), 0).write.mode("append").parquet(
        first.outputs["ledger"]
    )
    facts = spark.read.parquet(first.outputs["sales_facts"]).where("run_id = 'good'").cache()
    facts.withColumn("run_id", F.lit("broken")).write.mode("append").partitionBy("run_id", "sales_month").parquet(
        first.outputs["sales_facts"]
    )
    other = tmp_path / "in2"
    other.mkdir()
    (other / "b.csv").write_text(f"{HEADER}\n2,121,oats,2023-03-04,2,7,1,7\n")
    pipeline.run(spark, str(other), _dims(spark), out)
    team = spark.read.parquet(first.outputs["sales_team_data_mart"])
    assert rows(team, "sales_person_id", "total_sales") == [(1, Decimal("60.00")), (2, Decimal("7.00"))]
