"""Streaming intake: take each new file of a drop folder exactly once, then archive it.

This is the Structured Streaming form of the reference's "process the files on hand, then move them to the
processed folder". The file source remembers what it has read in its checkpoint (so a rerun reads only new files),
``cleanSource=archive`` moves every consumed file to the archive folder once its batch is committed (files of one
run are moved at the start of the next), and the file sink's commit log gives exactly-once output even when
executors are lost mid-batch. ``trigger(availableNow=True)`` drains what is there and stops, so the same code runs
as a scheduled batch job or, with a processing-time trigger, as a long-running stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def drop_folder_stream(
    spark: SparkSession,
    source_dir: str,
    schema: StructType | str,
    archive_dir: str | None = None,
    fmt: str = "parquet",
    max_files_per_trigger: int = 1000,
    **options: str,
) -> DataFrame:
    """A streaming DataFrame over new files in ``source_dir``.

    For CSV pass ``header="true"`` and ``enforceSchema="false"``: a file whose header differs from the declared
    schema then fails loudly instead of being read by position.
    """
    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", str(max_files_per_trigger))
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(source_dir)


def drain_to_parquet(
    stream: DataFrame,
    sink_dir: str,
    checkpoint_dir: str,
    partition_cols: list[str] | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    """Write everything available now to a Parquet file sink and stop (blocks until done)."""
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint_dir).outputMode("append")
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    if query_name:
        writer = writer.queryName(query_name)
    query = writer.trigger(availableNow=True).start(sink_dir)
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"stream intake failed: {query.exception()}")
    return query
