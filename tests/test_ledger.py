"""File ledger: latest state per key with tie-breaking, IN / semi-join lookup, incomplete files."""

from __future__ import annotations

import datetime as dt

from conftest import rows
from tillgrid.operators import ledger

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def test_latest_status_breaks_equal_times_by_sequence(spark):
    events = spark.createDataFrame(
        [("r1", "a.csv", "A", T0, 0), ("r1", "a.csv", "I", T0, 1), ("r1", "b.csv", "A", T0, 0),
         ("r2", "a.csv", "A", T0 + dt.timedelta(hours=1), 0)],
        "run_id string, file_name string, status string, event_ts timestamp, seq long",
    )
    state = ledger.current_state(events, ["run_id", "file_name"], "status", ["event_ts", "seq"])
    assert rows(state) == [("r1", "a.csv", "I"), ("r1", "b.csv", "A"), ("r2", "a.csv", "A")]


def test_ledger_rows_and_incomplete(spark):
    files = spark.createDataFrame([("s3://x/a.csv", "a.csv"), ("s3://x/b.csv", "b.csv")], "path string, file_name string")
    opened = ledger.ledger_rows(spark, "run1", files, ledger.ACTIVE, T0, 0)
    closed = ledger.ledger_rows(spark, "run1", files.where("file_name = 'a.csv'"), ledger.FINISHED, T0, 1)
    assert opened.schema.simpleString() == ledger.empty_ledger(spark).schema.simpleString()
    state = ledger.current_state(opened.unionByName(closed), ["file_name"], "status", ["event_ts", "seq"])
    on_hand = spark.createDataFrame([("a.csv",), ("b.csv",), ("c.csv",)], "file_name string")
    assert rows(ledger.incomplete(on_hand, state, "file_name")) == [("b.csv",)]


def test_a_file_that_a_later_run_finished_is_not_left_over(spark):
    def rows_of(run, path, status, hours, seq):
        return (run, path, f"/{path}", status, T0 + dt.timedelta(hours=hours), seq)

    log = spark.createDataFrame(
        [
            rows_of("r1", "a", "A", 0, 0), rows_of("r2", "a", "A", 1, 0), rows_of("r2", "a", "I", 1, 1),
            rows_of("r1", "b", "A", 0, 0), rows_of("r1", "b", "I", 0, 1), rows_of("r2", "b", "A", 1, 0),
            rows_of("r1", "c", "I", 0, 1), rows_of("r2", "c", "I", 1, 1), rows_of("r2", "c", "W", 2, 0),
            rows_of("r1", "d", "I", 0, 1), rows_of("r1", "d", "W", 2, 0),
        ],
        ledger.empty_ledger(spark).schema,
    )
    assert rows(ledger.file_state(log)) == [("/a", "I"), ("/b", "A"), ("/c", "I")]
    on_hand = spark.createDataFrame([(f"/{x}",) for x in "abcd"], "path string")
    assert rows(ledger.incomplete(on_hand, ledger.file_state(log), "path")) == [("/b",)]
    assert rows(ledger.finished_files(log)) == [("/a",), ("/b",), ("/c",)]
    # The second run gave its copy of c back: the first run's counts again.
    assert rows(ledger.superseded(log, "r3")) == [("r1", "/a"), ("r1", "/d"), ("r2", "/b"), ("r2", "/c")]


def test_lookup_with_list_and_with_frame(spark):
    df = spark.createDataFrame(
        [("a.csv", "A"), ("a.csv", "A"), ("b.csv", "I"), ("c.csv", "A")], "file_name string, status string"
    )
    assert rows(ledger.lookup(df, ["file_name"], "file_name", ["a.csv", "b.csv"], "status", "A")) == [("a.csv",)]
    names = spark.createDataFrame([("c.csv",), ("c.csv",)], "n string")
    assert rows(ledger.lookup(df, ["file_name"], "file_name", names, "status", "A")) == [("c.csv",)]
