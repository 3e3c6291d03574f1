"""Size-checked broadcast.

A side is broadcast only after one aggregate proves it has at most ``max_rows`` rows and ``DEFAULT_BROADCAST_BYTES``
bytes of values; otherwise the join is left to Spark (sort-merge with AQE, which can still switch to a broadcast at
run time from measured shuffle sizes, and splits a hot key of the fact side).

The check is an ordinary distributed aggregate: every task counts its own split and sends one row, so it never
funnels rows into one task (``limit(n).count()`` would gather up to n rows from every partition into a single task).
"""

from __future__ import annotations

import hashlib
import threading
from collections import OrderedDict
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_BROADCAST_ROWS = 2_000_000
# Bytes of values; a row's own overhead (some 100 bytes) is bounded by the rows above.
DEFAULT_BROADCAST_BYTES = 256 << 20


def _row_limit(df: DataFrame, max_rows: int | None) -> int:
    if max_rows is not None:
        return max_rows
    conf = df.sparkSession.conf.get("tillgrid.broadcast.maxRows", None)
    return int(conf) if conf else DEFAULT_BROADCAST_ROWS


# Verdicts of earlier checks in this process, keyed by application, plan and the exact set of input files.
_VERDICTS: OrderedDict[tuple, bool] = OrderedDict()
_MAX_VERDICTS = 256
_LOCK = threading.Lock()


def _verdict_key(df: DataFrame, max_rows: int, max_bytes: int) -> tuple | None:
    """A key that changes whenever the plan or any input file changes; None for sources without files."""
    files = df.inputFiles()
    if not files:
        return None
    digest = hashlib.sha1("\n".join(sorted(files)).encode("utf-8")).hexdigest()
    return (df.sparkSession.sparkContext.applicationId, df.semanticHash(), max_rows, max_bytes, digest)


def _row_bytes(df: DataFrame) -> Column:
    """Bytes of a row's values: lengths of texts (nested values as JSON), 16 for anything of fixed size."""
    sizes = [F.lit(16)]
    for f in df.schema.fields:
        value = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            sizes.append(F.octet_length(F.to_json(F.struct(value))))
        elif isinstance(f.dataType, (T.StringType, T.BinaryType)):
            sizes.append(F.octet_length(value))
        else:
            sizes.append(F.lit(16))
    return sum((F.coalesce(s, F.lit(0)).cast("long") for s in sizes[1:]), sizes[0].cast("long"))


def has_at_most(df: DataFrame, max_rows: int, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """True when ``df`` has no more than ``max_rows`` rows and ``max_bytes`` bytes (exact, one distributed aggregate).

    A file-based side whose plan and file list were already counted in this application reuses that verdict
    (Spark's writers never rewrite a file under the same name, so new data means a new file list). Sources without
    files (JDBC) are counted every time. The verdict only chooses between a broadcast and a shuffle join; it never
    changes a result.
    """
    key = _verdict_key(df, max_rows, max_bytes)
    if key is not None:
        with _LOCK:
            if key in _VERDICTS:
                _VERDICTS.move_to_end(key)
                return _VERDICTS[key]
    rows, size = df.agg(F.count(F.lit(1)), F.sum(_row_bytes(df))).first()
    verdict = rows <= max_rows and (size or 0) <= max_bytes
    if key is not None:
        with _LOCK:
            _VERDICTS[key] = verdict
            if len(_VERDICTS) > _MAX_VERDICTS:
                _VERDICTS.popitem(last=False)
    return verdict


def is_small(df: DataFrame, max_rows: int | None = None) -> bool:
    """Whether ``broadcast_if_small`` broadcasts ``df``."""
    bound = _row_limit(df, max_rows)
    return bound > 0 and has_at_most(df, bound)


def broadcast_if_small(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """``F.broadcast(df)`` when its rows and bytes prove small, else ``df`` unchanged."""
    return F.broadcast(df) if is_small(df, max_rows) else df


def broadcast_each(sides: Sequence[DataFrame], max_rows: int | None = None) -> list[DataFrame]:
    """``broadcast_if_small`` of several sides of one plan, their checks submitted at once."""
    with ThreadPoolExecutor(len(sides)) as pool:
        return list(pool.map(lambda side: broadcast_if_small(side, max_rows), sides))


def forget_verdicts() -> None:
    """Drop all remembered checks (a benchmark times each query with its own)."""
    with _LOCK:
        _VERDICTS.clear()
