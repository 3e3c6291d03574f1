"""Intake of a drop folder of sales files: manifest → header gate → typed fact + rejects.

Spark jobs: one listing, one header pass over the CSV files (one row per file leaves the tasks), then the fact is one
lazy scan of all CSV lines parsed against their own file's header (no branch per header or per file, and no file
list on the driver). Rejected files' raw lines can be copied to a reject store, one row per line with the full path
of its file, so files of the same name in two folders stay apart.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillgrid.operators import conform
from tillgrid.sinks import files as sinks
from tillgrid.sources import files as file_source


@dataclass
class Intake:
    files: DataFrame  # manifest: path, file_key, length, modificationTime, file_name, is_csv
    gated: DataFrame  # one row per file with the gate verdict
    fact: DataFrame  # typed sales fact of the accepted files (+ _bad_columns, source_file, _bad_line)
    rejects: DataFrame  # path, file_name, reason, missing
    any_accepted: bool


def run_intake(spark: SparkSession, root: str | Sequence[str], skip: DataFrame | None = None) -> Intake:
    """Gate every file under ``root`` (a folder, or a list of folders or files) and conform the accepted ones.

    Files whose path is in ``skip`` (column ``path``) are left out, as if they were not there.
    """
    files = file_source.split_by_suffix(file_source.manifest(spark, root))
    if skip is not None:
        files = files.join(skip.select("path"), "path", "left_anti")
    headers = file_source.file_headers(spark, root)
    # One row per file; reused by the width, the line conform and the reject table.
    gated = conform.gate(files, headers).cache()
    # Widest accepted header: the number of positional fields each line is parsed into (one small aggregate).
    width = gated.where("accepted").agg(F.max(F.size("header"))).first()[0] or 0
    lines = file_source.csv_lines(spark, root)
    if width:
        fact = conform.conform_lines(lines, gated, width)
    else:
        fact = conform.empty_fact(spark).withColumns(
            {
                "_bad_columns": F.array().cast("array<string>"),
                "source_file": F.lit(None).cast("string"),
                "_bad_line": F.lit(None).cast("string"),
            }
        )
    return Intake(files=files, gated=gated, fact=fact, rejects=conform.rejects(gated), any_accepted=width > 0)


def rejected_lines(spark: SparkSession, intake: Intake) -> DataFrame:
    """Raw data lines of every rejected file (its header line excluded): path, file_name, reason, value."""
    bad = intake.gated.where(~F.col("accepted")).select("path", "file_key", "file_name", "reason", "header_line")
    # File paths only (metadata): the text source needs them to plan the scan of the rejected files.
    paths = [r["path"] for r in bad.select("path").collect()]
    lines = file_source.text_lines(spark, paths)
    # One row per rejected file; the count of paths just taken bounds its size.
    joined = lines.join(F.broadcast(bad) if len(paths) <= 100_000 else bad, "file_key")
    is_header = F.col("header_line").isNotNull() & (F.col("value") == F.col("header_line"))
    return joined.where(~is_header).select("path", "file_name", "reason", "value")


def store_rejected_lines(lines: DataFrame, path: str, run_id: str) -> None:
    """Write rejected raw lines (path, file_name, reason, value) as the partition ``run_id`` of the Parquet table at
    ``path``; the same run again replaces its lines. All lines are of one partition, so the tasks that read them write it."""
    rows = lines.select("path", "file_name", "reason", "value", F.lit(run_id).alias("run_id"))
    sinks.replace_partitions(rows, path, ["run_id"], [(run_id,)], together=True)
