"""The whole job as a stream: every trigger takes the files that arrived since the last one, runs the pipeline on
exactly those files, and archives them.

The file source (``binaryFile``, content never read: only ``path`` is selected) remembers in its checkpoint which
files it has handed out, so a file is processed by one micro-batch only; ``cleanSource=archive`` moves a file once
its batch has committed. Each micro-batch calls ``tillgrid.plans.pipeline.run`` on its own file list, which is
named by the stream's id and the batch number, so a micro-batch replayed after a failure replaces its own rows. With
``trigger(availableNow=True)`` the stream drains the folder and stops, like a scheduled batch job; with a
processing-time trigger it keeps running. Every micro-batch publishes its own run of the row marts, so the interval
should follow the cadence of the drops (hourly or daily files), not fire every few seconds.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tillgrid.plans import pipeline

# The binaryFile source's fixed columns (a streaming source needs its schema stated).
BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def new_files(
    spark: SparkSession, incoming: str, archive_dir: str | None = None, max_files_per_trigger: int = 1000
) -> DataFrame:
    """A stream of the paths of files arriving under ``incoming`` (recursively)."""
    reader = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE_SCHEMA)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", str(max_files_per_trigger))
    )
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return reader.load(incoming).select("path")


def run_stream(
    spark: SparkSession,
    incoming: str,
    dims: pipeline.Dimensions | Callable[[], pipeline.Dimensions],
    out: str,
    checkpoint_dir: str,
    archive_dir: str | None = None,
    available_now: bool = True,
    max_files_per_trigger: int = 1000,
    interval: str = "1 minute",
) -> StreamingQuery:
    """Run the pipeline on each micro-batch of new files; blocks until drained when ``available_now``, else runs
    every ``interval`` until stopped.

    A function as ``dims`` is called once per micro-batch, so dimension rows added while the stream runs are seen.
    """

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        # The micro-batch is a list of file paths (metadata): the pipeline plans its scans from them.
        paths = [r["path"] for r in batch.collect()]
        if paths:
            session = batch.sparkSession
            # The stream's id as its checkpoint holds it: another stream into the same ``out`` has other run ids.
            meta = session.read.text(f"{checkpoint_dir}/metadata").first()["value"]
            run_id = f"{json.loads(meta)['id']}-batch-{batch_id}"
            pipeline.run(session, paths, dims() if callable(dims) else dims, out, run_id=run_id)

    writer = (
        new_files(spark, incoming, archive_dir, max_files_per_trigger)
        .writeStream.foreachBatch(each_batch)
        .option("checkpointLocation", checkpoint_dir)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    query = writer.start()
    if available_now:
        query.awaitTermination()
        if query.exception() is not None:
            raise RuntimeError(f"streaming pipeline failed: {query.exception()}")
    return query
