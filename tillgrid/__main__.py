"""Command line: run the sales-mart job once over a drop folder, or as a stream.

    python -m tillgrid --incoming DIR --out DIR --customer P --store P --team P
    python -m tillgrid ... --stream --checkpoint DIR [--archive DIR]

Dimensions are Parquet tables with the reference's column names (``--customer`` and friends), or database tables
(``--jdbc-url`` with ``--jdbc-properties FILE``, one ``key=value`` per line, for user, password and driver). The
session comes from ``spark-submit`` (or a local one when run by hand); its settings are used as they are.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession

from tillgrid.plans import pipeline
from tillgrid.session import ensure_checkpoint_dir
from tillgrid.streaming.pipeline import run_stream


def _properties(path: str) -> dict[str, str]:
    props: dict[str, str] = {}
    with open(path, encoding="utf-8") as fh:
        for line in fh:
            line = line.strip()
            if line and not line.startswith("#") and "=" in line:
                key, value = line.split("=", 1)
                props[key.strip()] = value.strip()
    return props


def parse_args(argv: Sequence[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="tillgrid", description="Run the sales-mart job.")
    p.add_argument("--incoming", required=True, help="drop folder of sales files")
    p.add_argument("--out", required=True, help="folder for marts, history, ledger and rejects")
    p.add_argument("--customer", help="Parquet customer dimension")
    p.add_argument("--store", help="Parquet store dimension")
    p.add_argument("--team", help="Parquet sales-team dimension")
    p.add_argument("--jdbc-url", help="read the dimensions from this database instead")
    p.add_argument("--jdbc-properties", help="file of key=value JDBC properties (user, password, driver)")
    p.add_argument("--all-files", action="store_true", help="take files again that an earlier run finished")
    p.add_argument("--run-id", help="name of this run; a run repeated under its name replaces its own rows (not with --stream)")
    p.add_argument("--stream", action="store_true", help="take only new files and archive them")
    p.add_argument("--checkpoint", help="stream checkpoint folder (with --stream)")
    p.add_argument("--archive", help="folder for processed files (with --stream)")
    p.add_argument("--max-files", type=int, default=1000, help="most files of one micro-batch (with --stream)")
    args = p.parse_args(list(argv))
    if not args.jdbc_url and not (args.customer and args.store and args.team):
        p.error("give --customer, --store and --team, or --jdbc-url")
    if args.stream and not args.checkpoint:
        p.error("--stream needs --checkpoint")
    if args.stream and args.run_id:
        p.error("--run-id names a single run; a stream names its micro-batches by itself")
    return args


def dimensions(spark: SparkSession, args: argparse.Namespace) -> pipeline.Dimensions:
    if args.jdbc_url:
        props = _properties(args.jdbc_properties) if args.jdbc_properties else {}
        return pipeline.dimensions_from_jdbc(spark, args.jdbc_url, props)
    return pipeline.Dimensions(
        customer=spark.read.parquet(args.customer),
        store=spark.read.parquet(args.store),
        team=spark.read.parquet(args.team),
    )


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parse_args(sys.argv[1:] if argv is None else argv)
    spark = spark or SparkSession.builder.appName("tillgrid").getOrCreate()
    ensure_checkpoint_dir(spark)
    if args.stream:
        run_stream(
            spark,
            args.incoming,
            lambda: dimensions(spark, args),
            args.out,
            args.checkpoint,
            args.archive,
            max_files_per_trigger=args.max_files,
        )
    else:
        result = pipeline.run(
            spark,
            args.incoming,
            dimensions(spark, args),
            args.out,
            run_id=args.run_id,
            # A run repeated under its name takes its own files again.
            only_new=not args.all_files and not args.run_id,
        )
        print(f"run {result.run_id}: outputs under {args.out}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
