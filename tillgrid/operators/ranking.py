"""``rank() OVER (PARTITION BY group ORDER BY value DESC NULLS LAST)`` without holding a group in one task.

A window ranks a group inside one task, so a group with a third of all rows would sit in one task. Here the rank
of a row is 1 + the number of rows of its group with a strictly greater value (NULLS LAST: a NULL ranks after
every value), computed as a distributed prefix sum over the distinct (group, value) pairs:

1. ``counts``: rows per (group, value), combined map-side (a hot value becomes one row).
2. The counts are range-partitioned on (group, value DESC). Equal keys always share a range partition, and the
   partitions follow the sort order, so a hot group is spread over consecutive partitions. The numbered counts
   are written once as a table in the shared checkpoint folder, so both uses below see the same numbering.
3. Per (group, partition): the rows it holds. A running sum over those totals, ordered by partition, gives the rows
   of the group in all earlier partitions (a window over at most one row per partition).
4. Inside a (group, partition) a running sum over the ordered counts gives the rows before each value there (a
   window bounded by one range partition).
5. rank = 1 + earlier partitions + earlier values in the partition; the ranks are joined back to the rows on
   (group, value), null-safe. That join is one-to-many from a table with one row per key, so AQE can split a hot
   key on the row side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillgrid.session import scratch_path


def rank_desc(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    name: str = "rnk",
    num_partitions: int | None = None,
) -> DataFrame:
    """``df`` with ``name`` = rank of ``value`` (descending, NULLS LAST, ties share a rank) within ``group``."""
    group = list(group)
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    before = Window.unboundedPreceding

    counts = df.groupBy(*group, value).agg(F.count(F.lit(1)).alias("_n"))
    ranged = counts.repartitionByRange(n, *[F.col(g).asc_nulls_first() for g in group], F.col(value).desc_nulls_last())
    # The partition numbers are read by two branches below. A recomputed range shuffle could draw other bounds
    # (its sample depends on row order), so the numbered counts are written once as a table in the shared
    # checkpoint folder and both branches read the same files.
    numbered = ranged.withColumn("_pid", F.spark_partition_id())
    path = scratch_path(df.sparkSession, "rank-counts")
    numbered.write.parquet(path)
    ranged = df.sparkSession.read.schema(numbered.schema).parquet(path)

    per_part = ranged.groupBy(*group, "_pid").agg(F.sum("_n").alias("_t"))
    offsets = per_part.select(
        *[F.col(g).alias(f"_og{i}") for i, g in enumerate(group)],
        F.col("_pid").alias("_opid"),
        F.coalesce(F.sum("_t").over(Window.partitionBy(*group).orderBy("_pid").rowsBetween(before, -1)), F.lit(0))
        .alias("_off"),
    )
    local = ranged.select(
        *group,
        value,
        "_pid",
        F.coalesce(
            F.sum("_n").over(
                Window.partitionBy(*group, "_pid").orderBy(F.col(value).desc_nulls_last()).rowsBetween(before, -1)
            ),
            F.lit(0),
        ).alias("_loc"),
    )
    same_part = [F.col(g).eqNullSafe(F.col(f"_og{i}")) for i, g in enumerate(group)]
    same_part.append(F.col("_pid") == F.col("_opid"))
    ranks = local.join(offsets, same_part).select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)],
        F.col(value).alias("_v"),
        (F.col("_off") + F.col("_loc") + F.lit(1)).cast("int").alias(name),
    )
    on = [df[g].eqNullSafe(ranks[f"_g{i}"]) for i, g in enumerate(group)] + [df[value].eqNullSafe(ranks["_v"])]
    return df.join(ranks, on).select(*df.columns, name)
