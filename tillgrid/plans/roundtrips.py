"""Registered queries that exercise sources and sinks: Spark writes files derived from the driver tables into the
session's shared scratch folder (under ``spark.checkpoint.dir``), then reads them back through the operator under
test. Each result must equal the same rows computed straight from the tables (the oracle SQL).

The sales drop used by the intake queries is written once per session and scale directory:

* ``F/`` - finished orders' lines, the plain mandatory header;
* ``O/`` - open orders' lines, header reordered (``total_cost`` first) plus ``payment_mode`` and ``ship_status``;
* ``P/`` - partly shipped orders' lines with ``store_id`` missing (rejected);
* ``notes/`` - one text line per order (not a CSV file, rejected).

``stream_pipeline`` writes its own copy of the drop, in two parts, because the stream archives (moves) its files.
"""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillgrid.operators import marts
from tillgrid.plans import pipeline
from tillgrid.plans.contract import INCENTIVE_SELECT, PERSON_MONTHLY, enriched, incentive_sql, star_sql
from tillgrid.plans.intake import rejected_lines, run_intake, store_rejected_lines
from tillgrid.schemas import MANDATORY_COLUMNS, SALES_FACT, SALES_TEAM_MART
from tillgrid.session import scratch_path, shuffles_freed
from tillgrid.sinks import files as sinks
from tillgrid.sinks import folders, snapshots
from tillgrid.sources import files as file_source
from tillgrid.sources import tables
from tillgrid.streaming.intake import drain_to_parquet, drop_folder_stream
from tillgrid.streaming.pipeline import run_stream

_drops: dict[tuple[str, str], str] = {}
_lock = threading.Lock()

# Extra columns written into the open-order files, and the reordered header of those files.
EXTRA_FILE_COLUMNS = ("payment_mode", "ship_status")
_MERGE_KEPT = "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning"
REORDERED_HEADER = ("total_cost", *[c for c in MANDATORY_COLUMNS if c != "total_cost"], *EXTRA_FILE_COLUMNS)


def _text(c: str) -> F.Column:
    return F.col(c).cast("string").alias(c)


@contextmanager
def _held(lines: DataFrame) -> Iterator[DataFrame]:
    """``lines`` computed once for all writes inside: kept by the executors (on their disks beyond memory) until the end.

    The setting holds while the plan is made: AQE merges small partitions as it does for a write, so files stay as few."""
    conf = lines.sparkSession.conf
    before = conf.get(_MERGE_KEPT, None)
    conf.set(_MERGE_KEPT, "true")
    try:
        lines = lines.persist()
    finally:
        conf.unset(_MERGE_KEPT) if before is None else conf.set(_MERGE_KEPT, before)
    try:
        yield lines
    finally:
        lines.unpersist()


def _drop_lines(spark: SparkSession, sf_dir: str, by_date: bool = True) -> DataFrame:
    """The lines of a sales drop, dealt to its files. With ``by_date`` each file covers one stretch of sale dates, else every
    file has sales of any date."""

    def deal(lines: DataFrame) -> DataFrame:
        return lines.repartitionByRange("sales_date") if by_date else lines.repartition("l_orderkey")

    lines = tables.sales_lines(spark, sf_dir, with_product=True, deal=deal).withColumns(
        {"payment_mode": F.col("l_returnflag"), "ship_status": F.col("l_linestatus")}
    )
    return lines.select(*MANDATORY_COLUMNS, *EXTRA_FILE_COLUMNS, "o_orderstatus")


def write_sales_drop(
    spark: SparkSession,
    sf_dir: str,
    root: str,
    parts: tuple[str, ...] = ("F", "O", "P", "notes"),
    by_date: bool = True,
) -> None:
    """Write the sales drop described in the module docstring (the folders named in ``parts``)."""
    with _held(_drop_lines(spark, sf_dir, by_date)) as lines:
        _write_parts(spark, sf_dir, lines, root, parts)


def _write_parts(spark: SparkSession, sf_dir: str, lines: DataFrame, root: str, parts: tuple[str, ...]) -> None:
    status = F.col("o_orderstatus")
    csv = {"header": "true"}
    if "F" in parts:
        lines.where(status == "F").select(*[_text(c) for c in MANDATORY_COLUMNS]).write.options(**csv).csv(f"{root}/F")
    if "O" in parts:
        lines.where(status == "O").select(*[_text(c) for c in REORDERED_HEADER]).write.options(**csv).csv(f"{root}/O")
    if "P" in parts:
        lines.where(status == "P").select(
            *[_text(c) for c in MANDATORY_COLUMNS if c != "store_id"], _text("payment_mode")
        ).write.options(**csv).csv(f"{root}/P")
    if "notes" in parts:
        tables.table(spark, sf_dir, "orders").select(
            F.concat_ws(" ", F.col("o_orderkey").cast("string"), F.col("o_orderpriority")).alias("value")
        ).write.text(f"{root}/notes")


def sales_drop(spark: SparkSession, sf_dir: str) -> str:
    """Root of this session's sales drop for ``sf_dir`` (written on first use)."""
    key = (spark.sparkContext.applicationId, sf_dir)
    with _lock:
        if key not in _drops:
            root = scratch_path(spark, "sales-drop")
            write_sales_drop(spark, sf_dir, root)
            _drops[key] = root
        return _drops[key]


def _source(path_col: str = "path") -> F.Column:
    """Name of the folder a file sits in (``F``, ``O``, ``P``, ``notes``)."""
    return F.regexp_extract(F.col(path_col), r"/([^/]+)/[^/]+$", 1)


# ---------------------------------------------------------------------------------------------------------------
# Intake
# ---------------------------------------------------------------------------------------------------------------


def q_file_manifest(spark, sf_dir):
    files = file_source.split_by_suffix(file_source.manifest(spark, sales_drop(spark, sf_dir)))
    return files.select(_source().alias("source"), "is_csv").distinct()


def q_header_gate(spark, sf_dir):
    gated = run_intake(spark, sales_drop(spark, sf_dir)).gated
    return gated.select(
        _source().alias("source"),
        "accepted",
        "reason",
        F.concat_ws(",", "missing").alias("missing"),
        F.concat_ws(",", "extra").alias("extra"),
    ).distinct()


def q_csv_fact_scan(spark, sf_dir):
    return run_intake(spark, sales_drop(spark, sf_dir)).fact.select(*SALES_FACT.fieldNames())


def q_rejected_rows(spark, sf_dir):
    intake = run_intake(spark, sales_drop(spark, sf_dir))
    lines = rejected_lines(spark, intake)
    return lines.groupBy(_source().alias("source"), "reason").agg(F.count(F.lit(1)).alias("n_lines"))


def q_rejected_line_texts(spark, sf_dir):
    """Every raw line of the rejected files, read back from the reject store."""
    intake = run_intake(spark, sales_drop(spark, sf_dir))
    store = scratch_path(spark, "rejected-lines")
    store_rejected_lines(rejected_lines(spark, intake), store, "run")
    return spark.read.parquet(store).select(_source().alias("source"), "reason", "value")


def _text_drop(spark: SparkSession, df: DataFrame, header: tuple[str, ...], name: str) -> str:
    """CSV files of ``df`` with the columns named ``header``: names that differ in blanks only are the same name."""
    root = scratch_path(spark, name)
    df.toDF(*header).write.options(header="true", emptyValue="").csv(f"{root}/in")
    return root


def q_bad_rows(spark, sf_dir):
    """Rows of CSV files with a broken customer id, date or amount: their raw line and the columns that did not cast."""
    lines = tables.sales_lines(spark, sf_dir, with_product=True)
    broken = {
        "customer_id": F.col("l_linenumber") == 1,
        "sales_date": F.col("l_returnflag") == "R",
        "total_cost": (F.col("l_linenumber") == 2) & (F.col("l_returnflag") != "N"),
    }

    def cell(c: str) -> F.Column:
        text = F.col(c).cast("string")
        return F.when(broken[c], F.concat(F.lit("x"), text)).otherwise(text) if c in broken else text

    cells = [cell(c).alias(c) for c in MANDATORY_COLUMNS]
    root = _text_drop(spark, lines.select(*cells, _text("l_orderkey")), (*MANDATORY_COLUMNS, "order_key"), "bad-drop")
    fact = run_intake(spark, root).fact.where(F.size("_bad_columns") > 0)
    bad = F.concat_ws(",", F.array_sort("_bad_columns")).alias("bad_columns")
    return fact.select(bad, F.col("_bad_line").alias("line"))


def q_extra_columns_in_files(spark, sf_dir):
    """Extra columns with the same name twice and with blank names: all four are packed, in header order."""
    lines = tables.sales_lines(spark, sf_dir, with_product=True)
    extras = ["l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus"]
    cells = [_text(c) for c in (*MANDATORY_COLUMNS, *extras)]
    root = _text_drop(spark, lines.select(*cells), (*MANDATORY_COLUMNS, "note", "note ", " ", "  "), "extras-drop")
    return run_intake(spark, root).fact.select(*SALES_FACT.fieldNames())


# ---------------------------------------------------------------------------------------------------------------
# Sinks
# ---------------------------------------------------------------------------------------------------------------


def q_parquet_roundtrip(spark, sf_dir):
    rows = marts.customer_mart_rows(enriched(spark, sf_dir))
    path = scratch_path(spark, "customer-mart")
    sinks.write_parquet(rows, path)
    return spark.read.schema(rows.schema).parquet(path)


def q_partition_pruned_read(spark, sf_dir):
    """Months are folders; inside them rows stand by store, so files and row groups of other stores are passed over."""
    rows = marts.sales_mart_rows(enriched(spark, sf_dir))
    path = scratch_path(spark, "sales-mart-by-month")
    sinks.write_clustered(rows, path, ["sales_month"], ["store_id"])
    back = spark.read.schema(rows.schema).parquet(path)
    return back.where(
        F.col("sales_month").between("1996-01", "1996-06") & F.col("store_id").isin(1, 2, 3)
    ).select(*rows.columns)


def q_mart_rerun(spark, sf_dir):
    mart = marts.sales_incentive(enriched(spark, sf_dir))
    path = scratch_path(spark, "sales-team-mart")
    sinks.overwrite_partitions(mart, path, ["sales_month"])
    # Rerun of the later months: their partitions are replaced, earlier months stay as written.
    sinks.overwrite_partitions(mart.where(F.col("sales_month") >= "1998-01"), path, ["sales_month"])
    return spark.read.schema(mart.schema).parquet(path).select(*mart.columns)


def q_latest_run_read(spark, sf_dir):
    """The customers' monthly mart through snapshots: a first run publishes all months, with totals from before 1997 only,
    a second one recomputes the later months, and a third one breaks off after it wrote its version."""
    base = scratch_path(spark, "customer-mart-runs")
    mart = sinks.written(marts.customer_monthly_sales(enriched(spark, sf_dir)), f"{base}/mart")
    name, (schema, key) = "customers_data_mart", pipeline.MONTHLY["customers_data_mart"]
    late = F.col(key) >= "1997-01"
    months = [r[0] for r in mart.select(key).distinct().collect()]
    stale = mart.withColumn("total_sales", F.when(late, F.lit(0)).otherwise(F.col("total_sales")).cast(schema["total_sales"].dataType))

    def staged(run: int, rows: DataFrame, keys: list) -> tuple[int, list[snapshots.Entry]]:
        number = snapshots.next_number(spark, base)
        return number, snapshots.stage(rows, base, name, number, key, keys, f"run-{run}", run)

    for run, rows, keys in ((1, stale, months), (2, mart.where(late), [m for m in months if m >= "1997-01"])):
        number, entries = staged(run, rows, keys)
        snapshots.commit(spark, base, number, snapshots.successor(snapshots.state(spark, base), {name: keys}, entries))
    staged(3, mart.limit(0), months)
    return snapshots.read(spark, base, name, schema, key)


def q_monthly_report_csv(spark, sf_dir):
    mart = marts.sales_incentive(enriched(spark, sf_dir))
    path = scratch_path(spark, "monthly-report")
    sinks.write_csv_report(mart, path, ["sales_month"])
    return sinks.read_csv_report(spark, path, mart.schema).select(*mart.columns)


def _driver_dims(spark: SparkSession, sf_dir: str) -> pipeline.Dimensions:
    return pipeline.Dimensions(
        customer=tables.customers(spark, sf_dir),
        store=tables.stores(spark, sf_dir),
        team=tables.sales_team(spark, sf_dir),
    )


def q_pipeline_run(spark, sf_dir):
    """The whole job over the sales drop with the driver tables as dimensions; the sales-team mart it loaded."""
    out = scratch_path(spark, "pipeline-run")
    result = pipeline.run(spark, sales_drop(spark, sf_dir), _driver_dims(spark, sf_dir), out)
    return _read_team_mart(spark, result.outputs["sales_team_data_mart"])


def q_pipeline_incremental(spark, sf_dir):
    """Two runs of the same months over files with mixed dates; between them sales people are renamed and customers
    move. A person keeps one total and one place in the ranking; months that the second run touches show the new name."""
    base = scratch_path(spark, "pipeline-incremental")
    out, dims = f"{base}/out", _driver_dims(spark, sf_dir)
    with _held(_drop_lines(spark, sf_dir, by_date=False)) as lines:
        _write_parts(spark, sf_dir, lines, f"{base}/first", ("F",))
        _write_parts(spark, sf_dir, lines, f"{base}/second", ("O", "P"))
    pipeline.run(spark, f"{base}/first", dims, out)
    renamed = F.when(F.col("id") % 7 == 0, F.concat("last_name", F.lit(" new"))).otherwise(F.col("last_name"))
    moved = F.when(F.col("customer_id") % 7 == 0, F.lit("moved")).otherwise(F.col("address"))
    dims = pipeline.Dimensions(
        dims.customer.withColumn("address", moved), dims.store, dims.team.withColumn("last_name", renamed)
    )
    result = pipeline.run(spark, f"{base}/second", dims, out)
    return _read_team_mart(spark, result.outputs["sales_team_data_mart"])


def _lines_aside(spark: SparkSession, sf_dir: str, path: str, lanes: int) -> DataFrame:
    """The sale lines, computed once and written at ``path`` as compact folders by ``part`` (``early``, or ``late`` from 1998 on;
    null without a date) and ``lane`` (of the order): a set of files is written from its folders, without a shuffle."""
    late = F.col("sales_date") >= F.lit("1998-01-01").cast("date")
    part = F.when(late, "late").when(~late, "early").alias("part")
    lane = F.pmod(F.hash("l_orderkey"), F.lit(lanes)).alias("lane")
    with shuffles_freed(spark):
        lines = tables.sales_lines(spark, sf_dir, with_product=True).select(*MANDATORY_COLUMNS, "l_linenumber", part, lane)
        lines.write.partitionBy("part", "lane").option("compression", "zstd").parquet(path)
    return spark.read.schema(lines.schema).parquet(path)


def _named_csv(spark: SparkSession, lines: DataFrame, folder: str, files: int) -> None:
    """``files`` CSV files of sale lines whose names are the same whenever they are written: ``sales-<k>.csv``. File k has the
    lanes k, k + ``files``, ... of ``_lines_aside``; one task reads their folders and writes it."""

    def write(k: int) -> None:
        scratch = scratch_path(spark, "named-csv")
        share = lines.where(F.col("lane") % files == k).coalesce(1).select(*[_text(c) for c in MANDATORY_COLUMNS])
        share.write.option("header", "true").csv(scratch)
        (name,) = [n for n in folders.names(spark, scratch) if n.startswith("part-")]
        folders.move(spark, f"{scratch}/{name}", f"{folder}/sales-{k}.csv")

    folders.make(spark, folder)
    pipeline.together(*[partial(write, k) for k in range(files)])


def q_corrected_file(spark, sf_dir):
    """Files of 1998 are taken, found to be wrong by a year, and taken again under their names: the months of 1998 are
    emptied, those of 1997 hold the corrected sales as well. Read through the snapshot and from the plain folder."""
    base, dims = scratch_path(spark, "corrected-file"), _driver_dims(spark, sf_dir)
    out, aside = f"{base}/out", f"{base}/aside"
    lines = _lines_aside(spark, sf_dir, aside, lanes=2)
    early, late = (lines.where(F.col("part") == part) for part in ("early", "late"))
    pipeline.together(lambda: _named_csv(spark, early, f"{base}/early", 2), lambda: _named_csv(spark, late, f"{base}/late", 2))
    folders.remove(spark, f"{aside}/part=early")
    pipeline.run(spark, [f"{base}/early", f"{base}/late"], dims, out)
    # Only now are the corrected files written, from the lines laid aside: the wrong ones are on disk until they are replaced.
    _named_csv(spark, late.withColumn("sales_date", F.add_months("sales_date", -12)), f"{base}/late", 2)
    folders.remove(spark, aside)
    result = pipeline.run(spark, f"{base}/late", dims, out)
    plain = _read_team_mart(spark, result.outputs["sales_team_data_mart"])
    both = pipeline.read_latest(spark, out, "sales_team_data_mart").withColumn("read", F.lit("snapshot"))
    return both.unionByName(plain.withColumn("read", F.lit("folder")))


def q_run_repeated(spark, sf_dir):
    """A run with accepted and rejected files and rows that do not cast is repeated under its id with fewer months, and with
    neither rejects nor bad rows: rows and totals of each output, by month."""
    base, dims = scratch_path(spark, "run-repeated"), _driver_dims(spark, sf_dir)
    out, aside = f"{base}/out", f"{base}/aside"
    broken = F.when(F.col("l_linenumber") == 1, F.lit("none")).otherwise(F.col("quantity").cast("string"))
    lines = _lines_aside(spark, sf_dir, aside, lanes=6)
    pipeline.together(
        lambda: _named_csv(spark, lines.withColumn("quantity", broken), f"{base}/all", 3),
        lambda: _named_csv(spark, lines.where(F.col("part") == "early"), f"{base}/again", 2),
        lambda: lines.select(_text("product_name")).write.option("header", "true").csv(f"{base}/all/rejected"),
    )
    folders.remove(spark, aside)
    pipeline.run(spark, f"{base}/all", dims, out, run_id="r1")
    paths = pipeline.run(spark, f"{base}/again", dims, out, run_id="r1").outputs

    def counted(name: str, rows: DataFrame, month: str | None, amount: str | None) -> DataFrame:
        total = F.sum(amount) if amount else F.lit(None)
        rows = rows.withColumn("_m", F.col(month) if month else F.lit(None).cast("string"))
        by_month = rows.groupBy("_m").agg(F.count(F.lit(1)).alias("n_rows"), total.cast("decimal(18,2)").alias("total"))
        return by_month.select(F.lit(name).alias("output"), F.col("_m").alias("sales_month"), "n_rows", "total")

    def table(name: str, schema: str) -> DataFrame:
        return spark.read.schema(schema).parquet(paths[name])

    money = "decimal(18,2)"
    parts = [
        counted("sales_facts", table("sales_facts", f"sales_month string, total_cost {money}"), "sales_month", "total_cost"),
        counted("sales_mart", table("sales_mart", f"sales_month string, total_cost {money}"), "sales_month", "total_cost"),
        counted("customers_data_mart", table("customers_data_mart", f"sales_date_month string, total_sales {money}"),
                "sales_date_month", "total_sales"),
        counted("sales_team_data_mart", table("sales_team_data_mart", f"sales_month string, total_sales {money}"),
                "sales_month", "total_sales"),
        counted("monthly_report", sinks.read_csv_report(spark, paths["monthly_report"], SALES_TEAM_MART), "sales_month", "total_sales"),
        counted("rejects", table("rejects", "file_name string"), None, None),
        counted("rejected_lines", table("rejected_lines", "value string"), None, None),
        counted("bad_rows", table("bad_rows", "line string"), None, None),
    ]
    return reduce(DataFrame.unionByName, parts)


def _read_team_mart(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SALES_TEAM_MART).parquet(path).select(*SALES_TEAM_MART.fieldNames())


def q_stream_pipeline(spark, sf_dir):
    """The job as a stream over a drop that arrives in two parts (finished orders and rejects first, open orders
    later); each availableNow run processes and archives only the new files, and months add up across runs."""
    base = scratch_path(spark, "stream-pipeline")
    drop, out, ckpt, archive = (f"{base}/{p}" for p in ("drop", "out", "checkpoint", "archive"))
    dims = _driver_dims(spark, sf_dir)
    with _held(_drop_lines(spark, sf_dir)) as lines:
        _write_parts(spark, sf_dir, lines, drop, ("F", "P"))
        _write_parts(spark, sf_dir, lines, f"{base}/later", ("O", "notes"))
    run_stream(spark, drop, dims, out, ckpt, archive)
    for part in ("O", "notes"):
        folders.move(spark, f"{base}/later/{part}", f"{drop}/{part}")
    run_stream(spark, drop, dims, out, ckpt, archive)
    return _read_team_mart(spark, pipeline.output_paths(out)["sales_team_data_mart"])


def q_stream_intake(spark, sf_dir):
    """Two drops of sales lines drained by two availableNow runs of one stream: every line lands once."""
    lines = tables.sales_lines(spark, sf_dir, with_product=True).select(*SALES_FACT.fieldNames()[:-1], "l_orderkey", "l_linenumber")
    base = scratch_path(spark, "stream-intake")
    drop, archive, sink, ckpt = (f"{base}/{p}" for p in ("drop", "archive", "sink", "checkpoint"))
    done = F.col("sales_date") < F.lit("1998-01-01").cast("date")
    lines.where(done).write.mode("append").parquet(drop)
    drain_to_parquet(drop_folder_stream(spark, drop, lines.schema, archive), sink, ckpt)
    lines.where(~done).write.mode("append").parquet(drop)
    drain_to_parquet(drop_folder_stream(spark, drop, lines.schema, archive), sink, ckpt)
    return spark.read.schema(lines.schema).parquet(sink)


# ---------------------------------------------------------------------------------------------------------------
# Oracle SQL
# ---------------------------------------------------------------------------------------------------------------

_PRODUCT_LINES = """
WITH lines AS (
  SELECT o.o_custkey AS customer_id, CAST(s.s_nationkey AS BIGINT) AS store_id, p.p_name AS product_name,
         CAST(o.o_orderdate AS DATE) AS sales_date, l.l_suppkey AS sales_person_id,
         CAST(p.p_retailprice AS DECIMAL(18,2)) AS price, CAST(l.l_quantity AS INTEGER) AS quantity,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS total_cost, o.o_orderstatus, l.l_returnflag, l.l_linestatus,
         l.l_orderkey, l.l_linenumber
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN supplier s ON s.s_suppkey = l.l_suppkey
       LEFT JOIN part p ON p.p_partkey = l.l_partkey)
"""


_CORRECTED_DATE = """CAST(CASE WHEN CAST(o.o_orderdate AS DATE) >= DATE '1998-01-01'
       THEN CAST(o.o_orderdate AS DATE) - INTERVAL 12 MONTH ELSE o.o_orderdate END AS DATE) AS sales_date"""


def oracle_sql() -> dict[str, str]:
    from tillgrid.plans.contract import ORACLE_SQL

    return {
        "file_manifest": """
SELECT DISTINCT o_orderstatus AS source, true AS is_csv FROM orders
UNION ALL SELECT 'notes' AS source, false AS is_csv""",
        "header_gate": """
SELECT DISTINCT o_orderstatus AS source, o_orderstatus <> 'P' AS accepted,
       CASE WHEN o_orderstatus = 'P' THEN 'missing mandatory columns' END AS reason,
       CASE WHEN o_orderstatus = 'P' THEN 'store_id' ELSE '' END AS missing,
       CASE o_orderstatus WHEN 'O' THEN 'payment_mode,ship_status' WHEN 'P' THEN 'payment_mode' ELSE '' END AS extra
FROM orders
UNION ALL SELECT 'notes', false, 'not a csv file', '', ''""",
        "csv_fact_scan": _PRODUCT_LINES
        + """
SELECT customer_id, store_id, product_name, sales_date, sales_person_id, price, quantity, total_cost,
       CASE WHEN o_orderstatus = 'O' THEN concat_ws(',', l_returnflag, l_linestatus) END AS additional_column
FROM lines WHERE o_orderstatus IN ('F', 'O')""",
        "rejected_rows": _PRODUCT_LINES
        + """
SELECT 'P' AS source, 'missing mandatory columns' AS reason, count(*) AS n_lines FROM lines WHERE o_orderstatus = 'P'
UNION ALL SELECT 'notes', 'not a csv file', count(*) FROM orders""",
        "rejected_line_texts": _PRODUCT_LINES
        + """
SELECT 'P' AS source, 'missing mandatory columns' AS reason,
       concat(customer_id, ',', product_name, ',', sales_date, ',', sales_person_id, ',', price, ',', quantity, ',',
              total_cost, ',', l_returnflag) AS value
FROM lines WHERE o_orderstatus = 'P'
UNION ALL SELECT 'notes', 'not a csv file', concat(o_orderkey, ' ', o_orderpriority) FROM orders""",
        "bad_rows": _PRODUCT_LINES
        + """
, marked AS (
  SELECT *, l_linenumber = 1 AS bad_id, l_returnflag = 'R' AS bad_date,
         l_linenumber = 2 AND l_returnflag <> 'N' AS bad_total FROM lines)
SELECT concat_ws(',', CASE WHEN bad_id THEN 'customer_id' END, CASE WHEN bad_date THEN 'sales_date' END,
                 CASE WHEN bad_total THEN 'total_cost' END) AS bad_columns,
       concat(CASE WHEN bad_id THEN 'x' END, customer_id, ',', store_id, ',', product_name, ',',
              CASE WHEN bad_date THEN 'x' END, sales_date, ',', sales_person_id, ',', price, ',', quantity, ',',
              CASE WHEN bad_total THEN 'x' END, total_cost, ',', l_orderkey) AS line
FROM marked WHERE bad_id OR bad_date OR bad_total""",
        "extra_columns_in_files": _PRODUCT_LINES
        + """
SELECT customer_id, store_id, product_name, sales_date, sales_person_id, price, quantity, total_cost,
       concat_ws(',', l_orderkey, l_linenumber, l_returnflag, l_linestatus) AS additional_column
FROM lines""",
        "parquet_roundtrip": ORACLE_SQL["customer_mart_rows"],
        "partition_pruned_read": "SELECT * FROM ("
        + ORACLE_SQL["sales_mart_rows"]
        + ") WHERE sales_month BETWEEN '1996-01' AND '1996-06' AND store_id IN (1, 2, 3)",
        "mart_rerun": ORACLE_SQL["sales_incentive"],
        "latest_run_read": ORACLE_SQL["customer_monthly_sales"],
        "monthly_report_csv": ORACLE_SQL["sales_incentive"],
        "pipeline_run": incentive_sql("o.o_orderstatus IN ('F', 'O')"),
        "pipeline_incremental": star_sql("o.o_orderstatus IN ('F', 'O')")
        + """,
touched AS (SELECT DISTINCT strftime(sales_date, '%Y-%m') AS m FROM lines WHERE o_orderstatus = 'O'),
totals AS (
  SELECT store_id, sales_person_id, sales_person_first_name || ' ' || sales_person_last_name AS old_name,
         strftime(sales_date, '%Y-%m') AS sales_month, CAST(sum(total_cost) AS DECIMAL(18,2)) AS total_sales
  FROM star GROUP BY ALL),
monthly AS (
  SELECT store_id, sales_person_id, sales_month, total_sales,
         CASE WHEN sales_person_id % 7 = 0 AND m IS NOT NULL THEN old_name || ' new' ELSE old_name END AS full_name
  FROM totals LEFT JOIN touched ON m = sales_month)
"""
        + INCENTIVE_SELECT,
        "corrected_file": star_sql().replace("CAST(o.o_orderdate AS DATE) AS sales_date", _CORRECTED_DATE)
        + ","
        + PERSON_MONTHLY
        + ", mart AS ("
        + INCENTIVE_SELECT
        + """)
SELECT mart.*, r.read FROM mart, (VALUES ('snapshot'), ('folder')) AS r(read)""",
        "run_repeated": star_sql("CAST(o.o_orderdate AS DATE) < DATE '1998-01-01'")
        + """,
facts AS (SELECT strftime(sales_date, '%Y-%m') AS m, total_cost AS t FROM lines),
rows_known AS (SELECT strftime(sales_date, '%Y-%m') AS m, total_cost AS t FROM star),
by_customer AS (SELECT strftime(sales_date, '%Y-%m') AS m, sum(total_cost) AS t FROM star GROUP BY customer_id, 1),
by_person AS (SELECT strftime(sales_date, '%Y-%m') AS m, sum(total_cost) AS t FROM star GROUP BY store_id, sales_person_id, 1),
every AS (
  SELECT 'sales_facts' AS output, * FROM facts UNION ALL SELECT 'sales_mart', * FROM rows_known
  UNION ALL SELECT 'customers_data_mart', * FROM by_customer UNION ALL SELECT 'sales_team_data_mart', * FROM by_person
  UNION ALL SELECT 'monthly_report', * FROM by_person)
SELECT output, m AS sales_month, count(*) AS n_rows, CAST(sum(t) AS DECIMAL(18,2)) AS total FROM every GROUP BY output, m""",
        "stream_pipeline": incentive_sql("o.o_orderstatus IN ('F', 'O')"),
        "stream_intake": _PRODUCT_LINES
        + """
SELECT customer_id, store_id, product_name, sales_date, sales_person_id, price, quantity, total_cost, l_orderkey,
       l_linenumber
FROM lines""",
    }


QUERIES = {
    "file_manifest": q_file_manifest,
    "header_gate": q_header_gate,
    "csv_fact_scan": q_csv_fact_scan,
    "rejected_rows": q_rejected_rows,
    "rejected_line_texts": q_rejected_line_texts,
    "bad_rows": q_bad_rows,
    "extra_columns_in_files": q_extra_columns_in_files,
    "parquet_roundtrip": q_parquet_roundtrip,
    "partition_pruned_read": q_partition_pruned_read,
    "mart_rerun": q_mart_rerun,
    "latest_run_read": q_latest_run_read,
    "monthly_report_csv": q_monthly_report_csv,
    "pipeline_run": q_pipeline_run,
    "pipeline_incremental": q_pipeline_incremental,
    "corrected_file": q_corrected_file,
    "run_repeated": q_run_repeated,
    "stream_pipeline": q_stream_pipeline,
    "stream_intake": q_stream_intake,
}
