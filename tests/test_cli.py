"""Command line: one batch run over a drop with Parquet dimensions."""

from __future__ import annotations

from decimal import Decimal

import pytest

from test_pipeline import HEADER, _dims
from tillgrid.__main__ import main, parse_args


def test_cli_batch_run(spark, tmp_path):
    dims = _dims(spark)
    paths = {}
    for name in ("customer", "store", "team"):
        paths[name] = str(tmp_path / name)
        getattr(dims, name).write.parquet(paths[name])
    drop = tmp_path / "in"
    drop.mkdir()
    (drop / "s.csv").write_text(f"{HEADER}\n1,121,oats,2023-03-03,1,100,1,100\n")
    out = str(tmp_path / "out")
    argv = ["--incoming", str(drop), "--out", out, "--customer", paths["customer"], "--store", paths["store"],
            "--team", paths["team"]]
    assert main(argv, spark=spark) == 0
    team = spark.read.parquet(f"{out}/sales_team_data_mart").collect()
    assert [(r.sales_person_id, r.total_sales) for r in team] == [(1, Decimal("100.00"))]


    # A named run replaces its own rows when it is repeated; the plain run leaves finished files out.
    (drop / "s.csv").write_text(f"{HEADER}\n1,121,oats,2023-04-03,1,70,1,70\n")
    for argument in ([], ["--run-id", "april"], ["--run-id", "april"]):
        assert main([*argv, *argument], spark=spark) == 0
        month = "2023-04" if argument else "2023-03"
        team = spark.read.schema("sales_month string").parquet(f"{out}/sales_team_data_mart").collect()
        assert [r.sales_month for r in team] == [month]


def test_cli_streams_name_their_own_runs():
    argv = ["--incoming", "x", "--out", "y", "--customer", "c", "--store", "s", "--team", "t", "--stream", "--checkpoint", "k"]
    assert parse_args([*argv, "--max-files", "7"]).max_files == 7
    with pytest.raises(SystemExit):
        parse_args([*argv, "--run-id", "r"])


def test_cli_needs_dimensions():
    with pytest.raises(SystemExit):
        parse_args(["--incoming", "x", "--out", "y"])
