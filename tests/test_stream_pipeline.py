"""The pipeline as a stream: two drops, each taken once, months adding up across micro-batches, files archived."""

from __future__ import annotations

from decimal import Decimal
from pathlib import Path

from conftest import rows
from test_pipeline import HEADER, _dims
from tillgrid.streaming.pipeline import run_stream


def test_stream_runs_pipeline_per_batch(spark, tmp_path):
    drop, out, ckpt, archive = (tmp_path / n for n in ("in", "out", "ckpt", "archive"))
    (drop / "north").mkdir(parents=True)
    (drop / "north" / "day1.csv").write_text(f"{HEADER}\n1,121,oats,2023-03-03,1,100,1,100\n")
    (drop / "bad.csv").write_text("customer_id\n1\n")

    def drain():
        run_stream(spark, str(drop), _dims(spark), str(out), str(ckpt), str(archive))

    drain()
    (drop / "north" / "day2.csv").write_text(f"{HEADER}\n2,121,oats,2023-03-20,2,150,1,150\n")
    drain()
    drain()  # nothing new

    team = spark.read.parquet(str(out / "sales_team_data_mart"))
    assert rows(team, "sales_month", "sales_person_id", "total_sales", "incentive") == [
        ("2023-03", 1, Decimal("100.00"), Decimal("0.00")),
        ("2023-03", 2, Decimal("150.00"), Decimal("1.50")),
    ]
    rejects = spark.read.parquet(str(out / "rejects"))
    assert [r.file_name for r in rejects.collect()] == ["bad.csv"]
    archived = sorted(p.name for p in Path(archive).rglob("*.csv"))
    assert "day1.csv" in archived and "bad.csv" in archived


def test_dimensions_are_read_for_every_micro_batch(spark, tmp_path):
    drop, out, ckpt = (tmp_path / n for n in ("in", "out", "ckpt"))
    drop.mkdir()
    known = [1]

    def dims():
        d = _dims(spark)
        d.customer = d.customer.where(d.customer["customer_id"].isin(known))
        return d

    (drop / "day1.csv").write_text(f"{HEADER}\n1,121,oats,2023-03-03,1,100,1,100\n")
    run_stream(spark, str(drop), dims, str(out), str(ckpt))
    known.append(2)
    (drop / "day2.csv").write_text(f"{HEADER}\n2,121,oats,2023-03-20,2,150,1,150\n")
    run_stream(spark, str(drop), dims, str(out), str(ckpt))
    team = spark.read.parquet(str(out / "sales_team_data_mart"))
    assert rows(team, "sales_person_id", "total_sales") == [(1, Decimal("100.00")), (2, Decimal("150.00"))]
