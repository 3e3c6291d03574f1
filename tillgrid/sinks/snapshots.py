"""Snapshots: which folders hold the outputs as of the last closed run.

A run's outputs are several tables, written one after the other. A reader that takes folders as it finds them can see
half a run, or tables of two runs. So a run ends by writing one small file that names every output's folders, and readers
start from the newest such file:

* ``stage`` writes new rows of a keyed output (a monthly mart) into a fresh folder ``versions/<output>/seq=<n>`` that no
  reader knows yet. It is written once and never changed.
* ``commit`` writes the snapshot ``snapshots/seq=<n>``: for each output and key the folder that holds it. Keys that a run
  recomputed and that have no rows left are simply not in it. The file appears as a whole or not at all.
* ``read`` takes the newest snapshot and reads exactly its folders: one scan per output, filtered to the keys that each
  folder still holds.
* Outputs that a run keeps in a folder of its own (row marts, rejects) are named, not copied. A run repeated under its id
  replaces that folder, so ``reopen`` first voids the snapshots that name it; until the run is closed again, readers
  see the snapshot before it, as a whole.

Snapshots hold one row per output and key (month), so the driver handles metadata only. One writer at a time.
"""

from __future__ import annotations

import time
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import astuple, dataclass
from functools import reduce
from itertools import islice

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillgrid.sinks import folders

_ENTRIES = "output string, part string, folder string, run_id string, run_ts long, own boolean"
_REOPENED = "run_id string, seq long"
_SEQ = "seq"


@dataclass(frozen=True)
class Entry:
    """Where one key (``part``) of an output is; ``own`` folders belong to a run, the others are versions."""

    output: str
    part: str | None
    folder: str
    run_id: str
    run_ts: int
    own: bool


def _base(path: str) -> str:
    return path.rstrip("/")


def _numbers(spark: SparkSession, base: str) -> list[int]:
    """Numbers of the snapshots on hand, newest first; a folder whose file never appeared is none."""
    found = [n for n in folders.names(spark, f"{base}/snapshots") if n.startswith(f"{_SEQ}=")]
    return sorted((int(n.split("=")[1]) for n in found), reverse=True)


def next_number(spark: SparkSession, out: str) -> int:
    """A number above those of all snapshots (milliseconds, so that folders of runs that broke off are not met again)."""
    return max([time.time_ns() // 1_000_000, *(n + 1 for n in _numbers(spark, _base(out))[:1])])


def _small(spark: SparkSession, path: str, schema: str) -> list:
    try:
        return spark.read.schema(schema).parquet(path).collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def _entries(spark: SparkSession, base: str, number: int) -> list[Entry]:
    return [Entry(*r) for r in _small(spark, f"{base}/snapshots/{_SEQ}={number}", _ENTRIES)]


def _reopened(spark: SparkSession, base: str) -> dict[str, int]:
    """Per run that was repeated, the newest snapshot from before that."""
    found: dict[str, int] = {}
    for r in _small(spark, f"{base}/reopened", _REOPENED):
        found[r["run_id"]] = max(r["seq"], found.get(r["run_id"], 0))
    return found


def _valid(spark: SparkSession, base: str) -> Iterator[tuple[int, list[Entry]]]:
    """(number, entries) of the snapshots whose folders all hold what they held when it was written, newest first."""
    reopened = _reopened(spark, base)
    for number in _numbers(spark, base):
        entries = _entries(spark, base, number)
        if entries and not any(e.own and reopened.get(e.run_id, -1) >= number for e in entries):
            yield number, entries


def latest(spark: SparkSession, out: str) -> list[Entry]:
    """Entries of the newest valid snapshot, from which readers start; none if there is none."""
    return next((entries for _, entries in _valid(spark, _base(out))), [])


def state(spark: SparkSession, out: str) -> list[Entry]:
    """Entries that the next snapshot succeeds: versions as of the newest snapshot, valid or not (they never change),
    and own folders as of the newest valid one."""
    base = _base(out)
    newest = next((found for found in (_entries(spark, base, n) for n in _numbers(spark, base)) if found), [])
    return [*(e for e in newest if not e.own), *(e for e in latest(spark, out) if e.own)]


def reopen(spark: SparkSession, out: str, run_id: str) -> None:
    """Void the snapshots so far that name folders of ``run_id``, which is about to replace them."""
    base = _base(out)
    numbers = _numbers(spark, base)
    if numbers:
        rows = spark.createDataFrame([(run_id, numbers[0])], _REOPENED)
        rows.coalesce(1).write.mode("append").parquet(f"{base}/reopened")


def stage(
    df: DataFrame, out: str, output: str, number: int, key: str, keys: Sequence[str | None], run_id: str, run_ts: int
) -> list[Entry]:
    """Write ``df``, the rows of ``keys``, as a version of ``output``; one entry for each key that has rows.

    Rows are ranged by the key, so files hold neighbouring keys and a read of one key skips the others' row groups.
    """
    folder = f"versions/{output}/{_SEQ}={number}"
    df.hint("rebalance", key).sortWithinPartitions(key).write.mode("overwrite").parquet(f"{_base(out)}/{folder}")
    written = df.sparkSession.read.schema(df.schema).parquet(f"{_base(out)}/{folder}")
    filled = {r[0] for r in written.select(key).distinct().collect()}
    return [Entry(output, k, folder, run_id, run_ts, False) for k in keys if k in filled]


def own_folder(output: str, folder: str, run_id: str, run_ts: int) -> Entry:
    """The entry of an output that the run keeps in its own folder (a path below the outputs' base)."""
    return Entry(output, None, folder, run_id, run_ts, True)


def commit(spark: SparkSession, out: str, number: int, entries: Iterable[Entry]) -> None:
    """Write the snapshot ``number``; from here on readers see these entries."""
    rows = spark.createDataFrame([astuple(e) for e in entries], _ENTRIES)
    rows.coalesce(1).write.parquet(f"{_base(out)}/snapshots/{_SEQ}={number}")


def successor(previous: Sequence[Entry], replaced: dict[str, Sequence[str | None]], entries: Sequence[Entry]) -> list[Entry]:
    """The entries after a run: ``previous`` without the ``replaced`` keys of each output, and the new ``entries``.

    An output that runs keep in own folders shows the run with the largest stamp.
    """
    gone = {(output, key) for output, keys in replaced.items() for key in keys}
    own = {e.output: e for e in previous if e.own}
    for e in entries:
        if e.own and (e.output not in own or own[e.output].run_ts <= e.run_ts):
            own[e.output] = e
    kept = [e for e in previous if not e.own and (e.output, e.part) not in gone]
    return [*kept, *(e for e in entries if not e.own), *own.values()]


def _held(entries: Sequence[Entry], key: str) -> Column:
    """Rows of the keys that each version still holds."""

    def one(folder: str) -> Column:
        keys = [e.part for e in entries if e.folder == folder]
        in_keys = F.col(key).isin([k for k in keys if k is not None])
        if None in keys:
            in_keys = in_keys | F.col(key).isNull()
        return (F.col(_SEQ) == int(folder.rsplit("=", 1)[1])) & in_keys

    return reduce(lambda a, b: a | b, (one(f) for f in sorted({e.folder for e in entries})))


def read(spark: SparkSession, out: str, output: str, schema: T.StructType | None = None, key: str | None = None) -> DataFrame:
    """Rows of ``output`` as of the newest snapshot. Keyed outputs need their ``schema`` and ``key`` column."""
    entries = [e for e in latest(spark, out) if e.output == output]
    base = _base(out)
    if key is not None:
        if not entries:
            return spark.createDataFrame([], schema)
        paths = [f"{base}/{f}" for f in sorted({e.folder for e in entries})]
        versioned = T.StructType([*schema.fields, T.StructField(_SEQ, T.LongType())])
        rows = spark.read.schema(versioned).option("basePath", f"{base}/versions/{output}").parquet(*paths)
        return rows.where(_held(entries, key)).select(*schema.fieldNames())
    if not entries:
        raise FileNotFoundError(f"no closed run under {out}")
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{base}/{entries[0].folder}")


def vacuum(spark: SparkSession, out: str, keep: int = 2) -> list[str]:
    """Remove all snapshots older than the newest ``keep`` valid ones, and the versions that none of these names; the
    removed folders.

    Readers that planned on an older snapshot lose their files, so keep as many as the longest read needs.
    """
    base = _base(out)
    numbers = _numbers(spark, base)
    valid = list(islice(_valid(spark, base), keep))
    if not valid:
        return []
    kept = {e.folder for _, entries in valid for e in entries}
    stale = [f"snapshots/{_SEQ}={n}" for n in numbers if n < valid[-1][0]]
    # Versions above the newest snapshot may belong to a run that is at work.
    for output in folders.names(spark, f"{base}/versions"):
        for name in folders.names(spark, f"{base}/versions/{output}"):
            folder = f"versions/{output}/{name}"
            if folder not in kept and int(name.split("=")[1]) <= numbers[0]:
                stale.append(folder)
    for folder in stale:
        folders.remove(spark, f"{base}/{folder}")
    return stale
