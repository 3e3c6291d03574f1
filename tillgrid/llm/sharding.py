"""Sharding by jump consistent hashing, as DataFrame expressions.

A stable key jumps from shard to larger shard along a pseudo-random sequence that only the key decides; its shard is
the last stop below the number of shards. One more shard therefore takes a key only into itself. No ring table exists.
Slots number a shard's rows without gaps: rows are counted per (shard, lane), lanes get offsets by a short running
sum, and rows are numbered within their lane, so no task ever holds a whole shard.

Defined results: a null id hashes as the id -1; a null text has 16 bytes and the checksum of the empty text; equal
rows take neighbouring slots in either order; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Multiplier of the 64-bit congruential sequence that jump consistent hashing uses, and its modulus.
MULTIPLIER = "2862933555777941757"
MODULUS = "18446744073709551616"
#: Bytes that a stored row takes beside its text.
ROW_BYTES = 16


def _unsigned(key: Column) -> Column:
    """A 64-bit id as a decimal from 0 to 2^64 - 1."""
    wide = F.coalesce(key.cast("long"), F.lit(-1)).cast("decimal(20,0)")
    return F.when(wide < 0, wide + F.lit(MODULUS).cast("decimal(20,0)")).otherwise(wide).cast("decimal(20,0)")


def _next(state: Column) -> Column:
    """The next number of a key's sequence: (state * multiplier + 1) modulo 2^64."""
    product = (state * F.lit(MULTIPLIER).cast("decimal(19,0)")).cast("decimal(38,0)") + F.lit(1).cast("decimal(1,0)")
    return (product.cast("decimal(38,0)") % F.lit(MODULUS).cast("decimal(20,0)")).cast("decimal(20,0)")


def jump_shards(key: Column, shards: int, grown: int) -> Column:
    """Struct (shard, grown): the key's places among ``shards`` and among ``grown`` (not fewer) shards."""
    if not 0 < shards <= grown:
        raise ValueError("shards must be positive and not more than grown")

    def step(acc: Column, _: Column) -> Column:
        state = _next(acc["state"])
        # The upper 31 bits: an exact difference first, as a decimal quotient would be rounded.
        low = state % F.lit(2**33).cast("decimal(11,0)")
        upper = F.round((state - low).cast("double") / float(2**33)) + 1.0
        to = F.floor((acc["at"] + 1).cast("double") * (F.lit(float(2**31)) / upper)).cast("long")
        moved = F.struct(
            state.alias("state"),
            to.alias("at"),
            F.when(to < shards, to).otherwise(acc["shard"]).alias("shard"),
            F.when(to < grown, to).otherwise(acc["grown"]).alias("grown"),
        )
        return F.when(acc["at"] >= grown, acc).otherwise(moved)

    # Every key starts at 0, and its place strictly rises with each jump, so ``grown`` steps always reach the end.
    start = F.struct(
        _unsigned(key).alias("state"),
        F.lit(0).cast("long").alias("at"),
        F.lit(0).cast("long").alias("shard"),
        F.lit(0).cast("long").alias("grown"),
    )
    end = F.aggregate(F.sequence(F.lit(1), F.lit(grown)), start, step)
    return F.struct(end["shard"].cast("int").alias("shard"), end["grown"].cast("int").alias("grown"))


def shard_rows(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 40, lanes: int = 4096
) -> DataFrame:
    """Every row's shard, slot, size and checksum, and its shard after one more shard is appended.

    ``lanes`` bounds the rows numbered together: about rows / (shards * lanes) each.
    """
    placed = (
        df.select(
            F.col(id_col).cast("long").alias("doc_id"),
            (F.octet_length(F.coalesce(F.col(text_col), F.lit(""))) + ROW_BYTES).cast("long").alias("size"),
            F.crc32(F.coalesce(F.col(text_col), F.lit(""))).alias("text_crc32"),
        )
        .withColumn("_place", jump_shards(F.col("doc_id"), shards, shards + 1))
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.col("_place.shard").alias("shard"),
            F.col("_place.grown").alias("grown_shard"),
            F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(-1)), "text_crc32", "size"), F.lit(lanes)).alias("lane"),
        )
    )
    counts = placed.groupBy("shard", "lane").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "lane", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("shard", "lane").orderBy("doc_id", "text_crc32", "size")
    numbered = placed.withColumn("_n", F.row_number().over(within))
    return numbered.join(offsets, ["shard", "lane"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("offset") + F.col("_n") - 1).cast("long").alias("slot"),
        "grown_shard",
    )
