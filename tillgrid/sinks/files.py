"""File sinks for the marts: Parquet, hive-partitioned Parquet, CSV reports and run-stamped publishing.

All writes go through the DataFrame writer, whose commit protocol makes a lost executor's half-written task
invisible (the retried task commits instead). Partitioned writes use the ``rebalance`` hint on the partition
columns: AQE then splits a hot partition value over several tasks and merges small ones, so one busy (month, store)
does not end up in a single task or a single huge file. Rows that already stand together by partition (files sorted by
it, or all of one partition) are written by the tasks that read them (``together``), without that shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillgrid.sinks import folders
from tillgrid.sources.files import plain_path

RUN_COLUMN = "run_ts"
_RUN_IN_PATH = re.compile(rf"/{RUN_COLUMN}=(\d+)/")


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Plain Parquet write (the row-level marts)."""
    df.write.mode(mode).parquet(path)


def written(df: DataFrame, path: str) -> DataFrame:
    """``df`` written as Parquet at ``path`` and read back: later steps start from these files."""
    write_parquet(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_cols: Sequence[str],
    mode: str = "overwrite",
    fmt: str = "parquet",
    max_records_per_file: int | None = None,
    together: bool = False,
    **options: str,
) -> None:
    """Hive-partitioned write (``<path>/col=value/...``) with skew-aware task layout, or as the rows stand (``together``)."""
    layout = df if together else df.hint("rebalance", *partition_cols)
    writer = layout.write.mode(mode).format(fmt).partitionBy(*partition_cols)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
    for k, v in options.items():
        writer = writer.option(k, v)
    writer.save(path)


def write_clustered(
    df: DataFrame,
    path: str,
    partition_cols: Sequence[str],
    sort_cols: Sequence[str],
    mode: str = "overwrite",
    together: bool = False,
    **options: str,
) -> None:
    """Folders for ``partition_cols`` only; inside them rows are sorted by ``sort_cols``.

    A folder per combination of two columns costs a file each (2,000 for 80 months of 25 stores, however few rows). Sorted
    rows give the same pruning from the row-group statistics of far fewer files, and a busy store has no folder of its own.
    """
    dealt = df if together else df.hint("rebalance", *partition_cols)
    layout = dealt.sortWithinPartitions(*partition_cols, *sort_cols)
    layout.write.mode(mode).options(**options).partitionBy(*partition_cols).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_cols: Sequence[str], fmt: str = "parquet") -> None:
    """Idempotent load: replace exactly the partitions present in ``df`` and leave all others alone.

    A rerun of a month rewrites that month instead of appending a second copy of it.
    """
    write_partitioned(df, path, partition_cols, mode="overwrite", fmt=fmt, partitionOverwriteMode="dynamic")


def replace_partitions(
    df: DataFrame,
    path: str,
    partition_cols: Sequence[str],
    owned: Sequence[Sequence[str | None]],
    fmt: str = "parquet",
    together: bool = False,
    **options: str,
) -> None:
    """Load ``df`` as the whole content of the ``owned`` partitions: those that it does not fill are emptied.

    ``owned`` lists values of the first partition columns, such as ``[("2024-01",)]`` for a month or ``[("run-7",)]`` for all
    of a run's months. Partitions that are filled are replaced by the dynamic overwrite; of the others, one file each was
    noted before the write, and where that file still stands the folder was not filled and goes. A load that broke off
    in between is put right by the same load again.
    """
    spark = df.sparkSession
    base = path.rstrip("/")
    roots = ["/".join([base, *(folders.partition_name(spark, c, v) for c, v in zip(partition_cols, values))]) for values in owned]
    before = _file_of_each_folder(spark, [r for r in roots if folders.exists(spark, r)])
    write_partitioned(
        df, path, partition_cols, mode="overwrite", fmt=fmt, together=together, partitionOverwriteMode="dynamic", **options
    )
    for folder, file in before:
        if folders.exists(spark, file):
            folders.remove(spark, folder)


def _file_of_each_folder(spark: SparkSession, roots: Sequence[str]) -> list[tuple[str, str]]:
    """(folder, one of its files) for every folder with files under ``roots``: one row per folder, from the listing."""
    if not roots:
        return []
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load([plain_path(r) for r in roots]).select("path")
    )
    first = files.groupBy(F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("folder")).agg(F.min("path").alias("file"))
    return [(r["folder"], r["file"]) for r in first.collect()]


def write_csv_report(df: DataFrame, path: str, partition_cols: Sequence[str] = ("sales_month",)) -> None:
    """CSV report with a header line, one folder per month; months not in ``df`` keep their folders."""
    write_partitioned(
        df, path, list(partition_cols), mode="overwrite", fmt="csv", header="true", partitionOverwriteMode="dynamic"
    )


def replace_csv_report(
    df: DataFrame, path: str, months: Sequence[str | None], column: str = "sales_month", together: bool = False
) -> None:
    """The CSV report of exactly ``months``: a month without rows loses its folder, other months keep theirs."""
    replace_partitions(df, path, [column], [(m,) for m in months], fmt="csv", together=together, header="true")


def stand_together(written: DataFrame, column: str) -> bool:
    """True if the files of ``written`` hold few values of ``column`` each, or each value in few files: tasks that read
    them then write about as many files as a shuffle by that column would. Counts (file, value) pairs of one column."""
    pairs = written.select(F.input_file_name().alias("_file"), column).distinct()
    found = pairs.groupBy(column).agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n"), F.count(F.lit(1))).first()
    return (found[0] or 0) <= 2 * (found[1] + len(written.inputFiles()))


def read_csv_report(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Read a CSV report back with its declared types (partition columns come from the folder names)."""
    return spark.read.schema(schema).option("header", "true").csv(path)


def publish_run(
    df: DataFrame,
    base: str,
    run_ts: int,
    mode: str = "errorifexists",
    partition_cols: Sequence[str] = (),
    sort_cols: Sequence[str] = (),
    together: bool = False,
    **options: str,
) -> str:
    """Write one run of a mart under ``<base>/run_ts=<epoch ms>/`` (optionally hive-partitioned below that, and sorted
    inside the partitions); earlier runs stay readable. With mode ``overwrite`` a repeated run replaces its own folder as a whole."""
    target = f"{base.rstrip('/')}/{RUN_COLUMN}={int(run_ts)}"
    if sort_cols:
        write_clustered(
            df, target, partition_cols, sort_cols, mode=mode, together=together, partitionOverwriteMode="static", **options
        )
    elif partition_cols:
        write_partitioned(df, target, partition_cols, mode=mode, together=together, partitionOverwriteMode="static", **options)
    else:
        df.write.mode(mode).options(**options).parquet(target)
    return target


def run_stamps(spark: SparkSession, base: str) -> list[int]:
    """Run stamps present under ``base``, from the file listing alone (no data is read)."""
    found = {int(m.group(1)) for m in map(_RUN_IN_PATH.search, spark.read.parquet(base).inputFiles()) if m}
    return sorted(found)


def read_latest_run(spark: SparkSession, base: str) -> DataFrame:
    """Rows of the newest run under ``base``.

    The newest stamp comes from the file index's listing (metadata only); the filter on the partition column then
    prunes every other run's folder, so old runs are listed but never read.
    """
    stamps = run_stamps(spark, base)
    if not stamps:
        raise FileNotFoundError(f"no run under {base}")
    runs = spark.read.parquet(base)
    return runs.where(F.col(RUN_COLUMN) == F.lit(stamps[-1])).drop(RUN_COLUMN)
