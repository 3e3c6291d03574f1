"""Loads that replace by key, and snapshots: what readers see before, during and after a run."""

from __future__ import annotations

from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import rows
from test_pipeline import HEADER, _dims
from tillgrid.plans import pipeline
from tillgrid.schemas import SALES_TEAM_MART
from tillgrid.sinks import files as sinks
from tillgrid.sinks import folders, snapshots

MART = "month string, total int"


def _mart(spark, *data):
    return spark.createDataFrame(list(data), MART)


def test_replaced_partitions_that_get_no_rows_are_emptied(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.replace_partitions(_mart(spark, ("a", 1), ("b", 2), ("c", 3), (None, 4)), path, ["month"], [("a",)])
    sinks.replace_partitions(_mart(spark, ("a", 10)), path, ["month"], [("a",), ("b",), (None,), ("never there",)])
    assert rows(spark.read.schema(MART).parquet(path), "month", "total") == [("a", 10), ("c", 3)]
    sinks.replace_partitions(_mart(spark), path, ["month"], [("a",)])
    assert rows(spark.read.schema(MART).parquet(path), "month", "total") == [("c", 3)]


def test_a_run_owns_all_its_months(spark, tmp_path):
    path, odd = str(tmp_path / "t"), "run 1/{x}=%"
    schema = "run string, month string, total int"
    first = spark.createDataFrame([(odd, "a", 1), (odd, "b", 2), ("other", "a", 3)], schema)
    sinks.replace_partitions(first, path, ["run", "month"], [])
    sinks.replace_partitions(spark.createDataFrame([(odd, "b", 5)], schema), path, ["run", "month"], [(odd,)])
    assert rows(spark.read.schema(schema).parquet(path), "run", "month", "total") == [("other", "a", 3), (odd, "b", 5)]


def test_a_report_month_without_rows_goes(spark, tmp_path):
    path = str(tmp_path / "report")
    data = [(1, 1, "A B", m, Decimal("5.00"), Decimal("0.05")) for m in ("2024-01", "2024-02")]
    sinks.replace_csv_report(spark.createDataFrame(data, SALES_TEAM_MART), path, ["2024-01", "2024-02"])
    sinks.replace_csv_report(spark.createDataFrame(data[:1], SALES_TEAM_MART), path, ["2024-02", "2024-01"])
    assert rows(sinks.read_csv_report(spark, path, SALES_TEAM_MART), "sales_month", "total_sales") == [("2024-01", Decimal("5.00"))]


class _Store:
    """A small set of outputs: a monthly mart and one table in the run's own folder."""

    def __init__(self, spark, base):
        self.spark, self.base = spark, str(base)
        self.schema = _mart(spark).schema

    def stage(self, run, data, keys):
        number = snapshots.next_number(self.spark, self.base)
        entries = snapshots.stage(_mart(self.spark, *data), self.base, "m", number, "month", keys, f"r{run}", run)
        _mart(self.spark, (f"rows of {run}", run)).write.mode("overwrite").parquet(f"{self.base}/own/run_ts={run}")
        return number, [*entries, snapshots.own_folder("own", f"own/run_ts={run}", f"r{run}", run)]

    def run(self, run, data, keys):
        number, entries = self.stage(run, data, keys)
        snapshots.commit(self.spark, self.base, number, snapshots.successor(snapshots.state(self.spark, self.base), {"m": keys}, entries))

    def seen(self):
        own = [r["month"] for r in snapshots.read(self.spark, self.base, "own").collect()]
        return rows(snapshots.read(self.spark, self.base, "m", self.schema, "month"), "month", "total"), own


def test_readers_see_closed_runs_only(spark, tmp_path):
    store = _Store(spark, tmp_path)
    with pytest.raises(FileNotFoundError):
        store.seen()
    store.run(1, [("a", 1), ("b", 2), ("c", 3)], ["a", "b", "c"])
    store.run(2, [("b", 20), ("d", 40)], ["b", "c", "d"])  # c lost its rows
    want = ([("a", 1), ("b", 20), ("d", 40)], ["rows of 2"])
    assert store.seen() == want
    store.stage(3, [("a", 99)], ["a", "b", "d"])  # breaks off before it commits
    assert store.seen() == want
    Path(store.base, "snapshots", f"seq={snapshots.next_number(spark, store.base)}").mkdir()  # file never appeared
    assert store.seen() == want


def test_a_repeated_run_is_out_of_sight_until_it_is_closed(spark, tmp_path):
    store = _Store(spark, tmp_path)
    store.run(1, [("a", 1)], ["a"])
    store.run(2, [("b", 2)], ["b"])
    snapshots.reopen(spark, store.base, "r2")
    assert store.seen() == ([("a", 1)], ["rows of 1"])
    # What another run builds on holds the months of the reopened run: versions never change.
    assert {e.part for e in snapshots.state(spark, store.base) if not e.own} == {"a", "b"}
    store.run(2, [("b", 5)], ["b"])
    assert store.seen() == ([("a", 1), ("b", 5)], ["rows of 2"])
    snapshots.reopen(spark, store.base, "r1")
    store.run(1, [], ["a"])  # an older run, repeated without rows: the row mart of run 2 stays the latest
    assert store.seen() == ([("b", 5)], ["rows of 2"])


def test_months_without_a_date_are_a_key_too(spark, tmp_path):
    store = _Store(spark, tmp_path)
    store.run(1, [(None, 1), ("a", 2)], [None, "a"])
    store.run(2, [(None, 3)], [None])
    got = snapshots.read(spark, store.base, "m", store.schema, "month").collect()
    assert {(r.month, r.total) for r in got} == {(None, 3), ("a", 2)}


def test_vacuum_keeps_what_the_newest_snapshots_name(spark, tmp_path):
    store = _Store(spark, tmp_path)
    for run in (1, 2, 3):
        store.run(run, [("a", run)], ["a"])
    removed = snapshots.vacuum(spark, store.base, keep=1)
    assert len([r for r in removed if r.startswith("versions/")]) == 2
    assert len(folders.names(spark, f"{store.base}/snapshots")) == 1
    assert store.seen() == ([("a", 3)], ["rows of 3"])
    assert snapshots.vacuum(spark, store.base, keep=1) == []


def _write(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([HEADER, *lines]) + "\n")


def _team(spark, out, months=("sales_month", "total_sales")):
    plain = rows(spark.read.schema(SALES_TEAM_MART).parquet(f"{out}/sales_team_data_mart"), *months)
    assert rows(pipeline.read_latest(spark, out, "sales_team_data_mart"), *months) == plain
    report = sinks.read_csv_report(spark, f"{out}/monthly_report", SALES_TEAM_MART)
    assert rows(report, *months) == plain
    return plain


def test_a_corrected_file_leaves_no_month_behind(spark, tmp_path):
    out, drop = str(tmp_path / "out"), tmp_path / "in"
    _write(drop, "a.csv", "1,121,oats,2024-01-03,1,100,1,100", "1,121,oats,2024-03-01,1,7,1,7")
    pipeline.run(spark, str(drop), _dims(spark), out)
    _write(drop, "a.csv", "1,121,oats,2024-02-03,1,100,1,100", "1,121,oats,2024-03-01,1,8,1,8")
    pipeline.run(spark, str(drop), _dims(spark), out)
    assert _team(spark, out) == [("2024-02", Decimal("100.00")), ("2024-03", Decimal("8.00"))]


def test_a_repeated_run_gives_back_what_it_no_longer_takes(spark, tmp_path):
    out, drop = str(tmp_path / "out"), tmp_path / "in"
    _write(drop, "a.csv", "1,121,oats,2024-01-03,1,100,1,100")
    pipeline.run(spark, str(drop), _dims(spark), out, run_id="first")
    _write(drop, "a.csv", "1,121,oats,2024-02-03,1,50,1,50", "x,121,oats,2024-02-03,1,50,1,50")
    _write(drop, "b.csv", "1,121,oats,2024-05-03,1,9,1,9")
    (drop / "bad.csv").write_text("customer_id\n1\n")
    again = pipeline.run(spark, str(drop), _dims(spark), out, run_id="second")
    assert _team(spark, out) == [("2024-02", Decimal("50.00")), ("2024-05", Decimal("9.00"))]
    # The second run again, without a.csv and the rejected file: the first run's copy of a.csv counts once more.
    pipeline.run(spark, [str(drop / "b.csv")], _dims(spark), out, run_id="second")
    assert _team(spark, out) == [("2024-01", Decimal("100.00")), ("2024-05", Decimal("9.00"))]
    for name, schema in (("rejects", "path string"), ("rejected_lines", "value string"), ("bad_rows", "line string")):
        assert spark.read.schema(schema).parquet(again.outputs[name]).count() == 0
    facts = spark.read.schema("run_id string, sales_month string").parquet(again.outputs["sales_facts"])
    assert rows(facts) == [("first", "2024-01"), ("second", "2024-05")]
    # And once more with nothing that it can take.
    pipeline.run(spark, [str(drop / "bad.csv")], _dims(spark), out, run_id="second")
    assert _team(spark, out) == [("2024-01", Decimal("100.00"))]
    # a.csv is finished by the first run, b.csv by none: it counts as new.
    result = pipeline.run(spark, str(drop), _dims(spark), out, run_id="third", only_new=True)
    assert _team(spark, out) == [("2024-01", Decimal("100.00")), ("2024-05", Decimal("9.00"))]
    assert result.leftovers.count() == 0


def test_a_run_that_broke_off_and_is_repeated_knows_its_old_months(spark, tmp_path, monkeypatch):
    out, drop = str(tmp_path / "out"), tmp_path / "in"
    _write(drop, "a.csv", "1,121,oats,2024-01-03,1,100,1,100")
    pipeline.run(spark, str(drop), _dims(spark), out, run_id="r")
    _write(drop, "a.csv", "1,121,oats,2024-02-03,1,100,1,100")

    def fail(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(pipeline.snapshots, "commit", fail)
        with pytest.raises(RuntimeError, match="lost"):
            pipeline.run(spark, str(drop), _dims(spark), out, run_id="r")
    pipeline.run(spark, str(drop), _dims(spark), out, run_id="r")
    assert _team(spark, out) == [("2024-02", Decimal("100.00"))]


def test_outputs_of_one_state(spark, tmp_path, monkeypatch):
    out, drop = str(tmp_path / "out"), tmp_path / "in"
    _write(drop, "a.csv", "1,121,oats,2024-01-03,1,100,1,100")
    pipeline.run(spark, str(drop), _dims(spark), out)

    def fail(*args, **kwargs):
        raise RuntimeError("lost")

    _write(tmp_path / "in2", "b.csv", "2,121,oats,2024-01-04,1,1,1,1")
    with monkeypatch.context() as patched:
        patched.setattr(pipeline.marts, "sales_incentive_by_key", fail)
        with pytest.raises(RuntimeError, match="lost"):
            pipeline.run(spark, str(tmp_path / "in2"), _dims(spark), out)
    for name, column in (("customer_mart", "total_cost"), ("customers_data_mart", "total_sales")):
        assert rows(pipeline.read_latest(spark, out, name), column) == [(Decimal("100.00"),)]
    total = pipeline.read_latest(spark, out, "sales_team_data_mart").agg(F.sum("total_sales")).first()[0]
    assert total == Decimal("100.00")
