"""Helpers shared by the text operators: table reads, word expressions, hashing inside tasks, tables written once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillgrid.session import scratch_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``<sf_dir>/<name>.parquet``, read by Spark only."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared checkpoint folder and read back.

    Cuts lineage with a table that every executor sees and that survives the loss of any of them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written_lean(df: DataFrame, name: str) -> DataFrame:
    """``written``, after which the shuffle files behind it, or at least those behind the tables before, leave the disk.

    Spark removes the files of a shuffle once the driver's JVM has collected the plan that made it; with a roomy heap
    that may be long after the table is written. The last plan may be held until another one has run.
    """
    out = written(df, name)
    df.sparkSession.sparkContext._jvm.System.gc()
    return out


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as an array; null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", -1), "")


def word_count(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+`` (null: 0), as long."""
    return F.size(words(text)).cast("long")


def text_id(column: Column) -> Column:
    """crc32 of an id written as text (null: as the empty text)."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")))


def slices(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring items whose sizes sum to about ``limit`` (a larger item stands alone)."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def _byte_table(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 2**64, size=256, dtype=np.uint64) | np.uint64(1)


#: Random odd value per byte; a span's hash is a polynomial in these values modulo 2^64.
BYTE_VALUES = _byte_table(20240607)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)


def _powers(base: int, n: int) -> np.ndarray:
    """base^0 ... base^(n-1) modulo 2^64, by doubling."""
    out = np.ones(max(n, 1), dtype=np.uint64)
    have, factor = 1, base % 2**64
    while have < n:
        take = min(have, n - have)
        out[have : have + take] = out[:take] * np.uint64(factor)
        have += take
        factor = factor * factor % 2**64
    return out[:n]


class SpanHasher:
    """64-bit hashes of byte spans of one buffer, equal for equal spans whatever their place."""

    def __init__(self) -> None:
        self._up = self._down = np.ones(1, dtype=np.uint64)

    def __call__(self, buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        n = len(buffer) + 1
        if len(self._up) < n:
            self._up, self._down = _powers(_BASE, n), _powers(_INVERSE, n)
        prefix = np.zeros(n, dtype=np.uint64)
        np.cumsum(BYTE_VALUES[buffer] * self._up[: n - 1], out=prefix[1:])
        return mixed((prefix[ends] - prefix[starts]) * self._down[starts])


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser: spreads all 64 bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_spans(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased (A-Z) words of several texts laid out in one buffer, one space after each word.

    Returns (buffer, word starts, word ends, number of words of each text).
    """
    split = [t.lower().split() for t in texts]
    counts = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
    flat = [w for ws in split for w in ws]
    buffer = np.frombuffer(b" ".join(flat) + b" ", dtype=np.uint8)
    lengths = np.fromiter(map(len, flat), dtype=np.int64, count=len(flat))
    ends = np.cumsum(lengths + 1) - 1
    return buffer, ends - lengths, ends, counts


def parts(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Arrow batches in short runs of rows, so that few long texts are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
