"""Streaming intake: each file is taken once across runs, and consumed files are archived."""

from __future__ import annotations

from pathlib import Path

from tillgrid.streaming.intake import drain_to_parquet, drop_folder_stream

SCHEMA = "customer_id long, total_cost decimal(18,2)"


def _files(p: Path):
    return sorted(x for x in p.rglob("*.csv"))


def test_two_drops_each_taken_once_and_archived(spark, tmp_path):
    drop, archive, sink, ckpt = (str(tmp_path / n) for n in ("drop", "archive", "sink", "ckpt"))
    Path(drop).mkdir()
    (Path(drop) / "day1.csv").write_text("customer_id,total_cost\n1,10.00\n2,5.50\n")

    def run():
        stream = drop_folder_stream(
            spark, drop, SCHEMA, archive, fmt="csv", header="true", enforceSchema="false"
        )
        drain_to_parquet(stream, sink, ckpt)

    run()
    assert spark.read.parquet(sink).count() == 2
    (Path(drop) / "day2.csv").write_text("customer_id,total_cost\n3,1.25\n")
    run()
    run()  # nothing new: no row is read twice
    back = sorted((r.customer_id, str(r.total_cost)) for r in spark.read.parquet(sink).collect())
    assert back == [(1, "10.00"), (2, "5.50"), (3, "1.25")]
    # Files of finished batches have moved to the archive (day1 at least; day2 once its batch is committed).
    archived = [p.name for p in _files(Path(archive))]
    assert "day1.csv" in archived
    assert "day1.csv" not in [p.name for p in _files(Path(drop))]
