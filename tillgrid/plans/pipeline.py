"""One run of the sales-mart job: drop folder → gate → ledger → typed fact → star → marts → ledger.

Steps and the Spark work behind each:

1. ``run_intake``: the manifest, one header pass, one lazy scan of all CSV lines conformed against their headers. With
   ``only_new``, files that an earlier run finished are left out.
2. Rejects: the reject table (path, reason, missing columns) and the raw lines of rejected files. If no file is
   accepted the run ends here, and the outputs of earlier runs stay the latest ones.
3. Ledger open: one ``A`` row per accepted file, appended before any data work (a crash leaves ``A`` rows with no
   ``I``, which ``ledger.incomplete`` reports on the next run).
4. The conformed fact (keys and values, no attributes) goes into a sales history partitioned by (run, month). The write
   cuts lineage: the outputs read those files (only the columns each needs), which survive the loss of any executor.
   Of a file taken by several runs one copy counts: this run's, else that of the last run that finished it. The ledger
   says which, so no list of files is collected.
5. Change set: the months to recompute. They are those of this run's sales, those of every earlier copy of its files
   (a corrected file may have moved its sales to other months), and those the run held before it was repeated. They come
   from a small table of (run, file, month), not from the history, and are written down before anything is replaced.
6. Outputs: rows with values that did not cast (with the raw line), customer rows and sales rows (plain and
   in folders by month, sorted by store) published under ``run_ts=<epoch ms>``; both monthly marts and the CSV
   report recomputed from the whole history of every month of the change set, summed by key before attributes are
   joined. A month of the change set that has no sales left is emptied.
7. Close: the snapshot that names every output's folders (``sinks.snapshots``), then the plain folders of the monthly marts
   and the report, one ``I`` row per accepted file with the real end time, and the run's stamp in ``runs``. Readers of
   ``read_latest`` start from the snapshot, so they see closed runs only and all outputs of one state.

``run_id`` names one set of files. A run repeated under its id keeps its stamp and replaces its own rows in every
output, also where it has fewer rows or none now; the ledger, a log of events, keeps both openings and closings, and
a file that the repeated run no longer takes is withdrawn, so that the copy of an earlier run counts again.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillgrid.operators import ledger, marts
from tillgrid.operators.enrich import star_join
from tillgrid.operators.sizing import broadcast_if_small
from tillgrid.plans.intake import Intake, rejected_lines, run_intake, store_rejected_lines
from tillgrid.functions.scalars import month_key
from tillgrid.schemas import CUSTOMERS_DATA_MART, LEDGER, SALES_TEAM_MART
from tillgrid.session import shuffles_freed
from tillgrid.sinks import files as sinks
from tillgrid.sinks import snapshots
from tillgrid.sources import jdbc

RUNS = "run_id string, run_ts long"
LEFTOVERS = "path string, file_name string, run_id string"
FILE_MONTHS = "source_file string, sales_month string, run_id string"
CHANGE_SETS = "sales_month string, run_id string"
# The history and the row marts are as long as the sales, and one of each run stays: smaller files than by the default codec.
COMPACT = {"compression": "zstd"}
# Outputs kept as versions by month: the schema and the month column.
MONTHLY = {
    "customers_data_mart": (CUSTOMERS_DATA_MART, "sales_date_month"),
    "sales_team_data_mart": (SALES_TEAM_MART, "sales_month"),
}


@dataclass
class Dimensions:
    """Dimension frames in the reference's column names (see ``tillgrid.schemas``)."""

    customer: DataFrame
    store: DataFrame
    team: DataFrame


def dimensions_from_jdbc(
    spark: SparkSession,
    url: str,
    properties: dict[str, str],
    customer_table: str = "customer",
    store_table: str = "store",
    team_table: str = "sales_team",
    num_partitions: int = 8,
) -> Dimensions:
    """The three dimensions read from database tables that carry the reference's column names."""
    return Dimensions(
        customer=jdbc.read_dimension(spark, url, customer_table, properties, "customer_id", num_partitions),
        store=jdbc.read_dimension(spark, url, store_table, properties, "id", num_partitions),
        team=jdbc.read_dimension(spark, url, team_table, properties, "id", num_partitions),
    )


@dataclass
class RunResult:
    run_id: str
    run_ts: int
    intake: Intake
    enriched: DataFrame
    leftovers: DataFrame  # files on hand left unfinished (A without I) by an earlier run, found before this run
    outputs: dict[str, str] = field(default_factory=dict)


def output_paths(out: str) -> dict[str, str]:
    """Where each output of a run lives under ``out``."""
    base = out.rstrip("/")
    return {
        name: f"{base}/{name}"
        for name in (
            "ledger",
            "leftovers",
            "rejects",
            "rejected_lines",
            "sales_facts",
            "file_months",
            "change_sets",
            "bad_rows",
            "customer_mart",
            "sales_mart",
            "sales_mart_partitioned",
            "customers_data_mart",
            "sales_team_data_mart",
            "monthly_report",
            "runs",
        )
    }


def _now() -> datetime:
    return datetime.now(timezone.utc)


def _table(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The Parquet table at ``path``, empty if nothing was written there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def run(
    spark: SparkSession,
    incoming: str | Sequence[str],
    dims: Dimensions,
    out: str,
    run_id: str | None = None,
    only_new: bool = False,
) -> RunResult:
    """Process the files under ``incoming`` (a folder, or a list of folders or files) and write all outputs under
    ``out``; with ``only_new``, those that no earlier run under ``out`` finished."""
    run_id = run_id or uuid.uuid4().hex
    paths = output_paths(out)
    done = ledger.finished_files(_table(spark, paths["ledger"], LEDGER)) if only_new else None
    intake = run_intake(spark, incoming, skip=done)
    try:
        with shuffles_freed(spark):
            return _run(spark, intake, dims, out, run_id)
    finally:
        # Release the cached per-file table: a long-running stream comes here once per micro-batch.
        intake.gated.unpersist()


def _replace_own(df: DataFrame, path: str, run_id: str, *more: str) -> None:
    """Load ``df`` as all that ``run_id`` holds in the table at ``path``, partitioned by run (and ``more``)."""
    sinks.replace_partitions(df.withColumn("run_id", F.lit(run_id)), path, ["run_id", *more], [(run_id,)])


def _months(rows: DataFrame) -> set[str | None]:
    """Distinct months of ``rows``: a handful of values, as partition filters and keys of the monthly outputs."""
    return {r[0] for r in rows.select("sales_month").distinct().collect()}


def together(*steps: Callable[[], Any]) -> list[Any]:
    """Results of steps that do not depend on each other, submitted at once: one's last tasks leave cores to the next one's
    first. All have ended when this returns; the first error is raised."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return [f.result() for f in [pool.submit(step) for step in steps]]


def _in_months(months: set[str | None]) -> Column:
    found = F.col("sales_month").isin(sorted(m for m in months if m is not None))
    return found | F.col("sales_month").isNull() if None in months else found


def _run(spark: SparkSession, intake: Intake, dims: Dimensions, out: str, run_id: str) -> RunResult:
    paths = output_paths(out)
    mine = F.col("run_id") == run_id
    earlier = _table(spark, paths["runs"], RUNS).where(mine).first()
    run_ts = earlier["run_ts"] if earlier else time.time_ns() // 1_000_000
    number = snapshots.next_number(spark, out)
    if earlier:
        # The run is about to replace its own folders: readers go back to the state before it until it is closed again.
        snapshots.reopen(spark, out, run_id)

    accepted = intake.gated.where("accepted").select("path", "file_name")
    # Restart check, reported as data: files on hand that an earlier run opened and never finished. Written before
    # this run touches the ledger, so the answer is fixed.
    _, _, _, repeated = together(
        lambda: _replace_own(unfinished_files(spark, out, intake.files), paths["leftovers"], run_id),
        lambda: _replace_own(intake.rejects, paths["rejects"], run_id),
        lambda: store_rejected_lines(rejected_lines(spark, intake), paths["rejected_lines"], run_id),
        lambda: not _table(spark, paths["ledger"], LEDGER).where(mine).isEmpty(),
    )
    opened = _table(spark, paths["ledger"], LEDGER)
    leftovers = _table(spark, paths["leftovers"], LEFTOVERS).where(mine).drop("run_id")

    def result(fact: DataFrame) -> RunResult:
        enriched = star_join(fact, dims.customer, dims.store, dims.team)
        return RunResult(run_id=run_id, run_ts=run_ts, intake=intake, enriched=enriched, leftovers=leftovers, outputs=paths)

    # A run that takes nothing ends here, unless it took files before under its id: those it now gives back.
    if not intake.any_accepted and not repeated:
        return result(intake.fact)

    # The change set so far: months of all copies of the files that this run takes or took before, and those it was
    # changing before. Written before the ledger and the history change, so a run that breaks off and is repeated
    # knows its old months.
    held = _table(spark, paths["file_months"], FILE_MONTHS)
    files = accepted.select(F.col("path").alias("source_file")).union(held.where(mine).select("source_file"))
    pending = _table(spark, paths["change_sets"], CHANGE_SETS).where(mine)
    months = _months(held.join(files, "source_file", "left_semi")) | _months(pending)
    _replace_own(spark.createDataFrame([(m,) for m in months], "sales_month string"), paths["change_sets"], run_id)

    if repeated:
        ledger.withdrawals(spark, opened, run_id, accepted, _now(), 0).write.mode("append").parquet(paths["ledger"])
    ledger.ledger_rows(spark, run_id, accepted, ledger.ACTIVE, _now(), 1).write.mode("append").parquet(
        paths["ledger"]
    )

    # The conformed sales of this run go into the sales history, one partition per (run, month); the run repeated
    # under its id replaces them. The write also cuts lineage: everything below reads these files, pruned to its columns.
    # They are dealt by month alone; the run, which all rows share, is added after the shuffle.
    dealt = intake.fact.withColumn("sales_month", month_key("sales_date")).hint("rebalance", "sales_month")
    history_rows = dealt.withColumn("run_id", F.lit(run_id))
    sinks.replace_partitions(
        history_rows, paths["sales_facts"], ["run_id", "sales_month"], [(run_id,)], together=True, **COMPACT
    )
    history = _table(spark, paths["sales_facts"], history_rows.schema)
    facts = history.where(mine)
    _replace_own(facts.select("source_file", "sales_month").distinct(), paths["file_months"], run_id)
    months |= _months(_table(spark, paths["file_months"], FILE_MONTHS).where(mine))
    keys = sorted(months, key=lambda m: m or "")

    # Rows in which a value did not cast: they keep their other values, and are reported here with the raw line.
    bad_rows = facts.where(F.size("_bad_columns") > 0).select(
        "run_id",
        "source_file",
        F.col("_bad_columns").alias("bad_columns"),
        F.col("_bad_line").alias("line"),
    )
    done = result(facts)
    sales_rows = marts.sales_mart_rows(done.enriched)

    # Monthly marts: every month of the change set is recomputed from the whole history of that month, so files of one
    # month arriving over several runs add up, and a rerun changes nothing. Totals are by key; names and addresses are
    # joined afterwards, as the dimensions hold them now. As a partition filter the months keep all others unread.
    # Copies that do not count: none unless a file came twice or a run broke off, so the pairs are few and the sales
    # pass them in a broadcast; beyond its bound they meet in a shuffle join.
    void = ledger.superseded(_table(spark, paths["ledger"], LEDGER), run_id)
    touched = (
        history.where(_in_months(months))
        .select("run_id", "source_file", "customer_id", "store_id", "sales_person_id", "sales_date", "total_cost")
        .join(broadcast_if_small(void), ["run_id", "source_file"], "left_anti")
    )
    sides = (dims.customer, dims.store, dims.team)
    recomputed = {
        "customers_data_mart": lambda: marts.customer_monthly_by_key(touched, *sides),
        "sales_team_data_mart": lambda: marts.sales_incentive_by_key(touched, *sides),
    }

    def publish(name: str, rows: DataFrame, **layout) -> str:
        return sinks.publish_run(rows, paths[name], run_ts, mode="overwrite", **layout, **COMPACT)

    def publish_sales() -> None:
        plain = spark.read.schema(sales_rows.schema).parquet(publish("sales_mart", sales_rows))
        # The history stands by month, and so do rows that met broadcast dimensions only: then no shuffle deals them again.
        together = sinks.stand_together(plain, "sales_month")
        publish("sales_mart_partitioned", plain, partition_cols=["sales_month"], sort_cols=["store_id"], together=together)

    def stage(name: str) -> list[snapshots.Entry]:
        schema, key = MONTHLY[name]
        rows = recomputed[name]().select(*schema.fieldNames())
        return snapshots.stage(rows, out, name, number, key, keys, run_id, run_ts)

    staged = together(
        lambda: stage("customers_data_mart"),
        lambda: stage("sales_team_data_mart"),
        publish_sales,
        lambda: publish("customer_mart", marts.customer_mart_rows(done.enriched)),
        lambda: publish("bad_rows", bad_rows),
    )
    entries = [*staged[0], *staged[1]]
    for name in ("customer_mart", "sales_mart", "sales_mart_partitioned", "bad_rows"):
        entries.append(snapshots.own_folder(name, f"{name}/{sinks.RUN_COLUMN}={run_ts}", run_id, run_ts))
    snapshots.commit(spark, out, number, snapshots.successor(snapshots.state(spark, out), dict.fromkeys(MONTHLY, keys), entries))

    # The plain folders of the monthly marts and the report, for readers that take a folder as it is.
    def version(name: str) -> DataFrame:
        return spark.read.schema(MONTHLY[name][0]).parquet(f"{out.rstrip('/')}/versions/{name}/seq={number}")

    # The files of a version are sorted by month, so the tasks that read them write the folders.
    def refresh(name: str) -> None:
        sinks.replace_partitions(version(name), paths[name], [MONTHLY[name][1]], [(m,) for m in keys], together=True)

    together(
        lambda: refresh("customers_data_mart"),
        lambda: refresh("sales_team_data_mart"),
        lambda: sinks.replace_csv_report(version("sales_team_data_mart"), paths["monthly_report"], keys, together=True),
    )
    ledger.ledger_rows(spark, run_id, accepted, ledger.FINISHED, _now(), 2).write.mode("append").parquet(
        paths["ledger"]
    )
    if earlier is None:
        spark.createDataFrame([(run_id, run_ts)], RUNS).write.mode("append").parquet(paths["runs"])
    return done


def read_latest(spark: SparkSession, out: str, name: str) -> DataFrame:
    """Rows of an output as of the latest closed state under ``out``: of a row mart (or ``bad_rows``) those of the last
    closed run, of a monthly mart all months.

    The folders come from the newest snapshot, so a run that broke off, that is at work, or that had nothing to do is
    never seen, and reads of several outputs are of one state.
    """
    if name in MONTHLY:
        return snapshots.read(spark, out, name, *MONTHLY[name])
    if name != "sales_mart_partitioned":
        return snapshots.read(spark, out, name)
    # A run without known sales leaves no partition, so the columns are those of the plain form.
    return snapshots.read(spark, out, name, snapshots.read(spark, out, "sales_mart").schema)


def ledger_state(spark: SparkSession, out: str) -> DataFrame:
    """Current status per (run, file) of the ledger under ``out``."""
    rows = _table(spark, output_paths(out)["ledger"], LEDGER)
    return ledger.current_state(rows, ["run_id", "file_name", "file_location"], "status", ["event_ts", "seq"])


def unfinished_files(spark: SparkSession, out: str, on_hand: DataFrame) -> DataFrame:
    """Files of ``on_hand`` (a manifest) that a run under ``out`` opened and that no run has finished since (lazy)."""
    rows = _table(spark, output_paths(out)["ledger"], LEDGER)
    return ledger.incomplete(on_hand.select("path", "file_name"), ledger.file_state(rows), "path")
