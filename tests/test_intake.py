"""Intake of a drop folder: manifest, header gate, header-by-name conform, rejects (cases of FIXTURES.md §1)."""

from __future__ import annotations

import datetime as dt
import io
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tillgrid.operators import conform
from tillgrid.plans.intake import rejected_lines, run_intake, store_rejected_lines
from tillgrid.schemas import MANDATORY_COLUMNS, SALES_FACT
from tillgrid.sources import files as file_source

HEADER = ",".join(MANDATORY_COLUMNS)


def _write(root: Path, name: str, text: str) -> str:
    p = root / name
    p.parent.mkdir(parents=True, exist_ok=True)
    p.write_text(text, encoding="utf-8")
    return p.as_uri()


@pytest.fixture(scope="module")
def drop(tmp_path_factory):
    root = tmp_path_factory.mktemp("drop")
    _write(root, "plain.csv", f"{HEADER}\n1,121,quaker oats,2023-03-03,1,212,1,212\n2,121,sugar,2023-13-45,2,50,2,100\n")
    _write(root, "extra.csv", f"{HEADER},payment_mode\n3,122,maggi,2023-04-01,4,1.5,2,3,cash\n")
    _write(
        root,
        "two_extras.csv",
        f"{HEADER},payment_mode,note\n4,122,dal,2023-04-02,5,10,1,10,,n1\n5,122,dal,2023-04-03,5,10,1,10,,\n",
    )
    _write(
        root,
        "missing.csv",
        "customer_id,product_name,sales_date,sales_person_id,price,quantity,total_cost,payment_mode\n"
        '6,sugar,2023-03-03,"[1, 2, 3]",50,1,50,UPI\n',
    )
    reordered = ["total_cost", *[c for c in MANDATORY_COLUMNS if c != "total_cost"]]
    _write(root, "reordered.csv", ",".join(reordered) + "\n99.50,7,123,rice,2023-05-05,6,99.50,1\n")
    quoted = ",".join(f'"{c}"' for c in MANDATORY_COLUMNS)
    _write(root, "bom.csv", f"﻿{quoted}\n8,121,salt,2023-06-06,1,20,1,20\n")
    _write(root, "empty.csv", "")
    _write(root, "a/none.csv", "")
    _write(root, "_started", "")
    _write(root, "a/.none.csv.crc", "")
    _write(root, "notes.txt", "not a sales file\nsecond line\n")
    _write(root, "blank_first.csv", f"\n  \n{HEADER}\n13,121,tea,2023-07-10,2,5,1,5\n")
    _write(root, "UPPER.CSV", f"{HEADER}\n12,121,tea,2023-07-09,2,5,1,5\n")
    _write(root, "a/sales.csv", f"{HEADER}\n9,121,tea,2023-07-07,2,5,2,10\n")
    _write(root, "b/sales.csv", f"{HEADER}\n10,121,tea,2023-07-08,2,5,4,20\n")
    _write(root, "odd dir/50% off.csv", f"{HEADER}\n11,121,tea,2023-07-09,2,5,1,5\n")
    return str(root)


@pytest.fixture(scope="module")
def intake(spark, drop):
    return run_intake(spark, drop)


def _rel(path: str, root: str) -> str:
    return path.split(Path(root).name + "/", 1)[1]


def test_manifest_lists_files_only(spark, drop):
    files = file_source.split_by_suffix(file_source.manifest(spark, drop)).collect()
    names = sorted(_rel(r.path, drop) for r in files)
    # Zero-byte files too, which Spark's file scan skips; names that Spark takes for hidden are left out.
    assert names == sorted(
        ["plain.csv", "extra.csv", "two_extras.csv", "missing.csv", "reordered.csv", "bom.csv", "empty.csv", "a/none.csv",
         "notes.txt", "UPPER.CSV", "blank_first.csv", "a/sales.csv", "b/sales.csv", "odd dir/50% off.csv"]
    )
    assert {_rel(r.path, drop): r.is_csv for r in files}["notes.txt"] is False


def test_empty_files_of_a_list_of_paths(spark, drop):
    listed = [f"{drop}/empty.csv", f"{drop}/plain.csv", f"{drop}/a"]
    got = file_source.manifest(spark, listed).where("length = 0").collect()
    assert sorted(_rel(r.path, drop) for r in got) == ["a/none.csv", "empty.csv"]
    assert all(r.path.startswith("file:/") and r.modificationTime is not None for r in got)
    it = run_intake(spark, [f"{drop}/empty.csv"])
    assert [(r.file_name, r.reason) for r in it.rejects.collect()] == [("empty.csv", conform.REASON_EMPTY)]
    assert rejected_lines(spark, it).count() == 0 and it.fact.count() == 0


def test_header_probe_strips_bom_and_quotes(spark, drop):
    heads = {_rel(r.file_key, drop): list(r.header) for r in file_source.file_headers(spark, drop).collect()}
    assert heads["bom.csv"] == list(MANDATORY_COLUMNS)
    assert "empty.csv" not in heads
    assert heads["reordered.csv"][0] == "total_cost"


def test_gate_verdicts(intake, drop):
    g = {_rel(r.path, drop): r for r in intake.gated.collect()}
    assert g["plain.csv"].accepted and list(g["plain.csv"].extra) == []
    assert list(g["extra.csv"].extra) == ["payment_mode"]
    assert list(g["two_extras.csv"].extra) == ["payment_mode", "note"]
    assert not g["missing.csv"].accepted
    assert list(g["missing.csv"].missing) == ["store_id"]
    assert g["missing.csv"].reason == conform.REASON_MISSING
    assert g["notes.txt"].reason == conform.REASON_NOT_CSV
    assert g["UPPER.CSV"].reason == conform.REASON_NOT_CSV  # the suffix test is case-sensitive
    assert g["empty.csv"].reason == g["a/none.csv"].reason == conform.REASON_EMPTY
    assert g["reordered.csv"].accepted and g["bom.csv"].accepted
    assert g["a/sales.csv"].accepted and g["b/sales.csv"].accepted
    assert g["blank_first.csv"].accepted  # leading blank lines are skipped, as the CSV reader does
    assert g["odd dir/50% off.csv"].accepted  # names that need URL encoding match their own lines


def test_fact_is_typed_and_matched_by_name(intake):
    fact = intake.fact
    assert [f.name for f in fact.schema.fields[: len(SALES_FACT.fields)]] == SALES_FACT.fieldNames()
    by_customer = {r.customer_id: r for r in fact.collect()}
    assert sorted(by_customer) == [1, 2, 3, 4, 5, 7, 8, 9, 10, 11, 13]
    r7 = by_customer[7]  # reordered header: values land in the right columns
    assert (r7.store_id, r7.product_name, r7.total_cost, r7.price, r7.quantity) == (
        123, "rice", Decimal("99.50"), Decimal("99.50"), 1,
    )
    assert by_customer[3].price == Decimal("1.50")
    assert by_customer[8].sales_date == dt.date(2023, 6, 6)


def test_bad_value_becomes_null_and_is_listed(intake):
    r = intake.fact.where(F.col("customer_id") == 2).first()
    assert r.sales_date is None
    assert list(r._bad_columns) == ["sales_date"]
    good = intake.fact.where(F.col("customer_id") == 1).first()
    assert list(good._bad_columns) == []


def test_extra_columns_packed_in_header_order(intake):
    packed = {r.customer_id: r.additional_column for r in intake.fact.collect()}
    assert packed[1] is None
    assert packed[3] == "cash"
    assert packed[4] == "n1"
    assert packed[5] == ""


def test_reject_table_and_lines(spark, intake, drop, tmp_path):
    rej = {_rel(r.path, drop): r.reason for r in intake.rejects.collect()}
    assert rej == {
        "empty.csv": conform.REASON_EMPTY,
        "a/none.csv": conform.REASON_EMPTY,
        "missing.csv": conform.REASON_MISSING,
        "notes.txt": conform.REASON_NOT_CSV,
        "UPPER.CSV": conform.REASON_NOT_CSV,
    }
    lines = rejected_lines(spark, intake)
    got = sorted((r.file_name, r.value) for r in lines.collect())
    assert got == sorted([
        ("missing.csv", '6,sugar,2023-03-03,"[1, 2, 3]",50,1,50,UPI'),
        ("UPPER.CSV", HEADER),
        ("UPPER.CSV", "12,121,tea,2023-07-09,2,5,1,5"),
        ("notes.txt", "not a sales file"),
        ("notes.txt", "second line"),
    ])
    out = str(tmp_path / "rejected")
    store_rejected_lines(lines, out, "r1")
    store_rejected_lines(lines, out, "r1")  # the same run again replaces its lines
    back = spark.read.parquet(out)
    assert back.count() == 5 and all(r.path.endswith(r.file_name) for r in back.collect())
    assert sorted(r.file_name for r in back.select("file_name").distinct().collect()) == [
        "UPPER.CSV", "missing.csv", "notes.txt",
    ]


def test_empty_drop_gives_empty_typed_fact(spark, tmp_path):
    d = tmp_path / "nothing"
    d.mkdir()
    _write(d, "readme.txt", "x\n")
    it = run_intake(spark, str(d))
    assert it.fact.count() == 0
    assert it.fact.schema.fieldNames()[: len(SALES_FACT.fields)] == SALES_FACT.fieldNames()


def test_union_all_keeps_duplicates(spark):
    one = conform.empty_fact(spark).union(
        spark.createDataFrame([(1, 121, "x", dt.date(2023, 1, 1), 1, None, 1, Decimal("1"), None)], SALES_FACT)
    )
    assert conform.union_all([one, one]).count() == 2


def test_conform_of_named_text_frame(spark):
    header = ["total_cost", *[c for c in MANDATORY_COLUMNS if c != "total_cost"], "payment_mode"]
    raw = spark.createDataFrame(
        [("5.00", "1", "121", "x", "2023-01-02", "1", "2.5", "2", "UPI")], ", ".join(f"`{c}` string" for c in header)
    )
    r = conform.conform(raw, header).first()
    assert (r.customer_id, r.total_cost, r.price, r.additional_column) == (1, Decimal("5.00"), Decimal("2.50"), "UPI")


def test_many_files_are_read_in_branches_without_moving_lines(spark, drop, intake, monkeypatch):
    monkeypatch.setattr(conform, "BRANCH_FILES", 3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        again = run_intake(spark, drop).fact
        plan = again._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan text") > 1
        assert "SortMergeJoin [_file" not in plan and "SortMergeJoin [_head" not in plan
        assert sorted(map(tuple, again.collect())) == sorted(map(tuple, intake.fact.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_each_line_is_parsed_once_whatever_is_filtered(intake):
    bad = intake.fact.where(F.size("_bad_columns") > 0).select("_bad_columns", "_bad_line")
    assert bad._jdf.queryExecution().optimizedPlan().toString().count("from_csv") == 1


@pytest.mark.parametrize(
    ("content", "want"),
    [
        (b"", None), (b"\n \r\n  \n", None), (b"a,b", "a,b"), (b"\xef\xbb\xbfa,b\r\n1,2", "a,b"), (b"\r\rx\ry", "x"),
        (b" " * 200_000 + b"\nafter a long blank line\n", "after a long blank line"), (b"h" * 300_000 + b"\nz", "h" * 300_000),
    ],
)
def test_first_line_stops_at_the_first_line_with_text(content, want):
    assert file_source.first_line(io.BytesIO(content)) == want


def test_probe_by_opening_files_equals_the_scan(spark, drop, monkeypatch):
    opened = sorted(map(tuple, file_source.file_headers(spark, drop).collect()))
    plan = file_source.file_headers(spark, drop)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "FileScan text" not in plan
    monkeypatch.setattr(file_source, "OPENED_SCHEMES", ())
    assert sorted(map(tuple, file_source.file_headers(spark, drop).collect())) == opened


def test_windows_line_endings_and_no_final_newline(spark, tmp_path):
    d = tmp_path / "crlf"
    d.mkdir()
    (d / "w.csv").write_bytes(f"{HEADER},payment_mode\r\n1,121,tea,2023-07-07,2,5,2,10,cash\r\n".encode())
    (d / "n.csv").write_text(f"{HEADER}\n2,121,tea,2023-07-08,2,5,1,5")
    fact = {r.customer_id: r for r in run_intake(spark, str(d)).fact.collect()}
    assert fact[1].additional_column == "cash" and fact[1].total_cost == Decimal("10.00")
    assert fact[2].total_cost == Decimal("5.00")


def test_repeated_header_lines_are_not_rows(spark, tmp_path):
    d = tmp_path / "joined"
    d.mkdir()
    (d / "j.csv").write_text(f"{HEADER}\n1,121,tea,2023-07-07,2,5,2,10\n{HEADER}\n2,121,tea,2023-07-08,2,5,1,5\n")
    fact = run_intake(spark, str(d)).fact.collect()
    assert sorted(r.customer_id for r in fact) == [1, 2]
    assert all(list(r._bad_columns) == [] for r in fact)


def test_same_named_and_blank_extras_and_glob_characters_in_names(spark, tmp_path):
    from tillgrid.plans.intake import run_intake
    from tillgrid.sources.files import text_lines

    head = "customer_id,store_id,product_name,sales_date,sales_person_id,price,quantity,total_cost"
    (tmp_path / "a.csv").write_text(f"{head},note,note,,\n1,2,p,2023-03-01,3,1.00,2,2.00,n1,n2,b1,b2\n")
    got = run_intake(spark, str(tmp_path)).fact.select("additional_column").collect()
    assert [r[0] for r in got] == ["n1,n2,b1,b2"]
    (tmp_path / "bad[1].csv").write_text("x\n1\n")
    (tmp_path / "bad1.csv").write_text("y\n2\n")
    lines = text_lines(spark, [str(tmp_path / "bad[1].csv")]).collect()
    assert [r.value for r in lines] == ["x", "1"]
