"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillgrid.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(v, label) for every id in ``links`` (x, y): label is the smallest id reachable from v.

    Each step groups by id with a minimum, combined before the shuffle, and joins back, so a hub's links are split
    over tasks. Steps double the reach of a label; each writes its links to the shared folder. Needs no driver memory.
    """
    edges = (
        links.where("x <> y")
        .select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v"))
        .distinct()
    )
    edges = written(edges, "cc")
    state = _state(edges)
    while True:
        both = edges.union(edges.select(F.col("v"), F.col("u"))).toDF("u", "v")
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        pairs = small.select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        edges = written(
            pairs.select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).where("u <> v").distinct(), "cc"
        )
        last, state = state, _state(edges)
        if state == last:
            break
    roots = edges.select(F.col("v")).distinct()
    return edges.select(F.col("u").alias("v"), F.col("v").alias("label")).union(roots.select("v", F.col("v")))


def _state(edges: DataFrame) -> tuple:
    # Sums of halves of hashes: never overflow, and equal only for equal sets but for chance.
    h = F.xxhash64("u", "v")
    row = edges.agg(
        F.count("*"), F.sum(F.shiftrightunsigned(h, 40)), F.sum(h.bitwiseAND(F.lit((1 << 40) - 1)))
    ).first()
    return tuple(row)
