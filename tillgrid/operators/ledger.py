"""File ledger as an append-only status table.

The reference inserts one row per accepted file with status ``A`` and later updates it to ``I``. Here an update is
another appended row; the current state of a key is its latest row, found with ``max_by`` over an ordering struct
(time, then a sequence number to break equal times). ``max_by`` is an ordinary aggregate, so it is combined
map-side and never gathers a key's history into one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillgrid.schemas import LEDGER

# Ledger status codes of the reference (A = active / in progress, I = finished).
ACTIVE = "A"
FINISHED = "I"
# Own code, written only when a run is repeated under its id without a file it took before: its copy is given up.
WITHDRAWN = "W"


def ledger_rows(
    spark: SparkSession, run_id: str, files: DataFrame, status: str, ts: datetime, seq: int
) -> DataFrame:
    """Ledger rows for every file of ``files`` (columns ``path``, ``file_name``) with one status."""
    return files.select(
        F.lit(run_id).alias("run_id"),
        F.col("file_name"),
        F.col("path").alias("file_location"),
        F.lit(status).alias("status"),
        F.lit(ts).cast("timestamp").alias("event_ts"),
        F.lit(seq).cast("long").alias("seq"),
    )


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LEDGER)


def current_state(
    events: DataFrame,
    keys: Sequence[str],
    status: str,
    order: Sequence[str],
    status_alias: str = "status",
    ts_alias: str | None = None,
) -> DataFrame:
    """Latest ``status`` per key, ordered by the ``order`` columns (later wins)."""
    by: Column = F.struct(*[F.col(c) for c in order])
    aggs = [F.max_by(F.col(status), by).alias(status_alias)]
    if ts_alias:
        aggs.append(F.max(F.col(order[0])).alias(ts_alias))
    return events.groupBy(*keys).agg(*aggs)


def lookup(
    df: DataFrame,
    select: Sequence[str],
    in_col: str,
    values: Sequence | DataFrame,
    status_col: str,
    status: str,
) -> DataFrame:
    """``SELECT DISTINCT select FROM df WHERE in_col IN values AND status_col = status``.

    A literal list becomes an ``IN`` predicate pushed into the scan; a DataFrame of values becomes a left-semi join
    (no size limit on the list).
    """
    base = df.where(F.col(status_col) == F.lit(status))
    if isinstance(values, DataFrame):
        vals = values.select(F.col(values.columns[0]).alias(in_col)).distinct()
        base = base.join(vals, in_col, "left_semi")
    else:
        base = base.where(F.col(in_col).isin(list(values)))
    return base.select(*select).distinct()


def incomplete(on_hand: DataFrame, state: DataFrame, key: str, status_col: str = "status", final: str = FINISHED):
    """Rows of ``on_hand`` whose key the ledger knows and whose latest status is neither ``final`` nor withdrawn."""
    open_keys = state.where(~F.col(status_col).isin(final, WITHDRAWN)).select(key)
    return on_hand.join(open_keys, key, "left_semi")


def file_state(rows: DataFrame) -> DataFrame:
    """(path, status): the latest status of every file over all runs, withdrawn copies left out.

    A file that one run opened and left, and that a later run finished, is finished.
    """
    state = current_state(held_copies(rows), ["file_location"], "status", ["event_ts", "seq"])
    return state.withColumnRenamed("file_location", "path")


def finished_files(rows: DataFrame) -> DataFrame:
    """``path`` of every file that some run finished and did not withdraw."""
    return held_copies(rows).where(F.col("status") == FINISHED).select(F.col("file_location").alias("path")).distinct()


def held_copies(rows: DataFrame) -> DataFrame:
    """Ledger rows without those of (run, file) pairs whose latest row withdraws the file."""
    pairs = current_state(rows, ["run_id", "file_location"], "status", ["event_ts", "seq"], status_alias="_now")
    gone = pairs.where(F.col("_now") == WITHDRAWN).select("run_id", "file_location")
    return rows.join(gone, ["run_id", "file_location"], "left_anti")


def withdrawals(spark: SparkSession, rows: DataFrame, run_id: str, accepted: DataFrame, ts: datetime, seq: int) -> DataFrame:
    """Ledger rows that withdraw the files which ``run_id`` took before and that are not among ``accepted`` now."""
    taken = rows.where(F.col("run_id") == run_id).select(F.col("file_location").alias("path"), "file_name").distinct()
    return ledger_rows(spark, run_id, taken.join(accepted.select("path"), "path", "left_anti"), WITHDRAWN, ts, seq)


def superseded(rows: DataFrame, run_id: str) -> DataFrame:
    """(run_id, source_file) pairs whose sales do not count: another run holds the file's valid copy, or none does yet.

    The valid copy of a file is that of the current run ``run_id``, else of the last run that finished the file.
    """
    valid = held_copies(rows).where((F.col("run_id") == run_id) | (F.col("status") == FINISHED))
    order = F.struct(F.col("run_id") == run_id, F.col("event_ts"), F.col("seq"))
    winners = valid.groupBy("file_location").agg(F.max_by("run_id", order).alias("_winner"))
    pairs = rows.select("run_id", "file_location").distinct().join(winners, "file_location", "left")
    return pairs.where(~F.col("run_id").eqNullSafe(F.col("_winner"))).select(
        "run_id", F.col("file_location").alias("source_file")
    )
