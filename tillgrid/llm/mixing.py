"""Mixing sources to target weights by fitting subset sums.

Every source's target is its weighted share of all sizes, held at ``cap`` times its own size; what is held back is
shared again by weight until no target is above its cap. A source first takes all its documents as often as they fit
whole (at most ``cap`` times). The rest of its budget is fitted over its histogram of exact lengths: every length gives
the same share of its documents, and bounded-knapsack dynamic programming over the lengths fills what then remains,
to the word where the lengths allow it. Only a histogram and a bounded table of sums are held by a task. Documents of
each length are then chosen by a seeded hash. Hot lengths are spread over lanes of that hash, so no task orders more
than one lane.

Defined results: a null or empty text has size 0 and is never taken; a null source is one source, the last; a source
without words has target and taken 0; equal rows (same id, source and size) are taken in either order; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillgrid.llm.common import word_count, written

CAP = 3
SEED = 17
#: Largest budget, in words, that the table of sums covers; more is shared out by length beforehand.
TABLE_WORDS = 1 << 16
LANES = 1024
_KEY = ["has_source", "source"]


def source_targets(sources: DataFrame, cap: int = CAP, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Adds ``target`` to one row per source (has_source, source, source_size).

    Sources are ordered by code point, null last, by a range sort, and take the weights in turn. Rounds of two sums
    each find the sources at their cap; every round but the last holds at least one more source there.
    """
    spark = sources.sparkSession
    ordered = sources.orderBy(F.desc("has_source"), F.col("source").asc())
    schema = "has_source boolean, source string, source_size long, weight long"
    ranked = ordered.select("has_source", "source", "source_size").rdd.zipWithIndex()
    weighed = written(
        spark.createDataFrame(ranked.map(lambda x: (*x[0], weights[x[1] % len(weights)])), schema), "mix-sources"
    )
    total = weighed.agg(F.sum("source_size").alias("t")).first()["t"] or 0
    rate = 0.0
    held = -1
    while True:
        # A source is at its cap once the common rate per weight would give it more; the rate only rises.
        at_cap = F.lit(rate) * F.col("weight") >= cap * F.col("source_size")
        if held < 0:
            at_cap = F.col("source_size") <= 0
        row = weighed.agg(
            F.sum(F.when(at_cap, cap * F.col("source_size")).otherwise(0)).alias("given"),
            F.sum(F.when(at_cap, 0).otherwise(F.col("weight"))).alias("weight"),
            F.sum(F.when(at_cap, 1).otherwise(0)).alias("held"),
        ).first()
        if row["held"] is None or row["held"] == held or not row["weight"]:
            break
        held = row["held"]
        rate = (total - row["given"]) / row["weight"]
    target = F.least(F.lit(rate) * F.col("weight"), (cap * F.col("source_size")).cast("double"))
    return weighed.withColumn("target", F.when(F.col("source_size") > 0, target).otherwise(F.lit(0.0)))


def fit_lengths(lengths: np.ndarray, counts: np.ndarray, budget: int, table: int = TABLE_WORDS) -> np.ndarray:
    """How many documents of each length to take so that the lengths sum to ``budget``, or as near below as found.

    Every length first gives the same share of its documents. The budget that is left, at least ``table`` words
    (or twice the longest document) if there are as many, is filled by dynamic programming over the documents that remain.
    """
    order = np.argsort(lengths)
    lengths, counts = lengths[order].astype(np.int64), counts[order].astype(np.int64)
    taken = np.zeros(len(lengths), dtype=np.int64)
    total = int((lengths * counts).sum())
    if budget <= 0 or total <= 0:
        return taken
    if budget >= total:
        out = np.zeros(len(lengths), dtype=np.int64)
        out[order] = counts
        return out
    table = max(table, 2 * int(lengths[counts > 0].max()))  # room to choose among documents longer than the table
    share = max(0, budget - table) / total
    taken = np.floor(counts * share).astype(np.int64)
    rest = budget - int((lengths * taken).sum())
    # More than the table covers: long documents first, one more of each length while it stays above the table.
    for i in range(len(lengths) - 1, -1, -1):
        if rest <= table:
            break
        more = min(int(counts[i] - taken[i]), max(0, (rest - table) // int(lengths[i])))
        taken[i] += more
        rest -= more * int(lengths[i])
    # What is left exceeds the table by less than the shortest document that remains.
    taken += _knapsack(lengths, counts - taken, rest)
    out = np.empty(len(lengths), dtype=np.int64)
    out[order] = taken
    return out


def _knapsack(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Bounded knapsack: counts per length whose sum is the largest that fits ``budget``."""
    chosen = np.zeros(len(lengths), dtype=np.int64)
    if budget <= 0:
        return chosen
    reached = np.zeros(budget + 1, dtype=bool)
    reached[0] = True
    item = np.full(budget + 1, -1, dtype=np.int64)  # the parcel that first reached a sum
    parcels: list[tuple[int, int]] = []
    for i in range(len(lengths) - 1, -1, -1):
        left = min(int(counts[i]), budget // int(lengths[i]))
        many = 1
        while left > 0:  # parcels of 1, 2, 4 ... documents reach every count
            n = min(many, left)
            left, many = left - n, many * 2
            weight = n * int(lengths[i])
            fresh = np.zeros(budget + 1, dtype=bool)
            fresh[weight:] = reached[:-weight]
            fresh &= ~reached
            item[fresh] = len(parcels)
            reached |= fresh
            parcels.append((i, n))
        if reached[budget]:
            break
    at = int(np.flatnonzero(reached)[-1])
    while at > 0:  # a sum's parcel came after all parcels of the sum before it
        i, n = parcels[item[at]]
        chosen[i] += n
        at -= n * int(lengths[i])
    return chosen


def _fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for group in batches:
        for row in group.itertuples(index=False):
            size, target = int(row.source_size), float(row.target)
            passes = int(min(CAP, (target + 0.5) // size)) if size else 0
            budget = int(round(target)) - passes * size if size and passes < CAP else 0
            lengths, counts = np.asarray(row.lengths), np.asarray(row.counts)
            extra = fit_lengths(lengths, counts, budget) if len(lengths) else np.zeros(0, dtype=np.int64)
            yield pd.DataFrame(
                {
                    "has_source": row.has_source,
                    "source": row.source,
                    "passes": passes,
                    "size": lengths.astype(np.int64),
                    "extra": extra,
                }
            )


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, source, size, source_size, target and taken (words that the mix takes of it) of every row."""
    docs = written(
        df.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).cast("string").alias("source"),
            word_count(F.col(text_col)).alias("size"),
        )
        .withColumn("has_source", F.col("source").isNotNull())
        .withColumn("source", F.coalesce("source", F.lit("")))
        .withColumn("lot", F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(SEED)))
        .withColumn("lane", F.pmod("lot", F.lit(LANES)).cast("int")),
        "mix-docs",
    )
    lanes = docs.groupBy(*_KEY, "size", "lane").agg(F.count("*").alias("n"))
    histogram = lanes.groupBy(*_KEY, "size").agg(F.sum("n").alias("n"))
    sources = histogram.groupBy(*_KEY).agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = written(source_targets(sources), "mix-targets")
    # One row per source: distinct lengths and their counts, never documents. Lengths that sum to a source's words
    # are few: fewer than the root of twice the words.
    packed = (
        histogram.where("size > 0")
        .groupBy(*_KEY)
        .agg(F.sort_array(F.collect_list(F.struct("size", "n"))).alias("h"))
        .join(targets.select(*_KEY, "source_size", "target"), _KEY)
        .select(*_KEY, "source_size", "target", F.col("h.size").alias("lengths"), F.col("h.n").alias("counts"))
    )
    schema = "has_source boolean, source string, passes int, size long, extra long"
    plan = written(packed.mapInPandas(_fit, schema), "mix-plan")
    # Lanes are taken whole in order until a length's extra documents are reached; one lane is cut within.
    before = Window.partitionBy(*_KEY, "size").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    cuts = (
        lanes.join(plan, [*_KEY, "size"])
        .withColumn("left", F.col("extra") - F.coalesce(F.sum("n").over(before), F.lit(0)))
        .select(*_KEY, "size", "lane", "passes", F.greatest(F.least("left", "n"), F.lit(0)).alias("take"), "n")
    )
    marked = docs.join(cuts, [*_KEY, "size", "lane"], "left")
    within = Window.partitionBy(*_KEY, "size", "lane").orderBy("lot", "doc_id")
    rows = marked.withColumn("_place", F.row_number().over(within))
    times = F.coalesce("passes", F.lit(0)) + F.when(F.col("_place") <= F.col("take"), 1).otherwise(0)
    return rows.join(targets.select(*_KEY, "source_size", "target"), _KEY).select(
        "doc_id",
        F.when(F.col("has_source"), F.col("source")).alias("source"),
        "size",
        "source_size",
        "target",
        (F.col("size") * times).cast("long").alias("taken"),
    )


def taken_copies(df: DataFrame, mixed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``df`` that a mix takes, each as often as it is taken, with the columns of ``df`` alone.

    Rows that share an id also share how often they are taken: the largest count among them.
    """
    times = F.when(F.col("size") > 0, (F.col("taken") / F.col("size")).cast("int")).otherwise(0)
    counts = mixed.select(F.col("doc_id").alias("__mix_id"), times.alias("__mix_n")).where("__mix_n > 0")
    counts = counts.groupBy("__mix_id").agg(F.max("__mix_n").alias("__mix_n"))
    names = [F.col(f"`{n}`") for n in df.columns]
    joined = df.join(counts, df[id_col].eqNullSafe(F.col("__mix_id")))
    return joined.select(*names, F.explode(F.array_repeat(F.lit(0), F.col("__mix_n"))).alias("__mix_copy")).select(
        *names
    )
