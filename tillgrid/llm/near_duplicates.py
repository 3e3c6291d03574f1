"""Near-duplicate documents: banded MinHash candidates, sequential Bayesian verification, exact confirmation.

1. Every text becomes its set of word shingles (64-bit hashes), a fingerprint of the set, and a signature. Documents
   with equal sets are one class; the class with its smallest id goes on alone.
2. Signatures are cut into bands; classes that agree on a band share a bucket. Every member is a candidate with its
   bucket's smallest id, so a bucket of n gives n - 1 pairs.
3. Pairs compare their signatures in batches. After each batch a pair is dropped if, given the agreements so far, the
   posterior probability of reaching the threshold (uniform prior) is under ``miss``.
4. Survivors are confirmed on the full shingle sets of their whole texts; confirmed links make components.
5. Buckets that still hold several components compare the members of different ones, block against block inside
   tasks, by steps 3 and 4; only confirmed links leave a task.

So every pair in a shared bucket is compared unless its ends are already in one component; no bucket is capped.

Defined results: an empty or null text has no shingles and is linked with nothing; a text with fewer words than a
shingle is one shingle; rows that share an id are one document, linked if any of its texts is; a row with a null id is
linked with nothing, its component is null, and it is kept; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillgrid.llm.common import SpanHasher, parts, slices, word_spans, written
from tillgrid.llm.components import components

HASHES = 196
BATCH = 28
MISS = 1e-4
BLOCK = 256
_MULTIPLIERS = np.random.default_rng(20240611).integers(1, 2**64, size=HASHES, dtype=np.uint64) | np.uint64(1)


def bands_for(percent: int, miss: float = MISS) -> tuple[int, int]:
    """(bands, rows): the most selective banding that misses a pair at the threshold with at most ``miss``."""
    t = percent / 100
    for rows in range(12, 0, -1):
        bands = HASHES // rows
        if (1 - t**rows) ** bands <= miss:
            return bands, rows
    return HASHES, 1


def fewest_matches(percent: int, miss: float = MISS) -> list[int]:
    """By batch: the fewest agreements with which a pair's posterior of reaching the threshold is at least ``miss``.

    With a uniform prior the posterior after m of n is Beta(m + 1, n - m + 1); its tail over t is the chance of at
    most m successes in n + 1 draws of probability t.
    """
    t = percent / 100
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append(m)
    return out


def shingle_sets(texts: list[str | None], width: int, limit: int = 1 << 20) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    hasher = SpanHasher()
    raw = [b"" if t is None else t.encode("utf-8", "ignore") for t in texts]
    for a, b in slices([len(t) for t in raw], limit):
        buffer, starts, ends, counts = word_spans(raw[a:b])
        firsts = np.cumsum(counts) - counts
        n = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
        owner = np.repeat(np.arange(len(counts)), n)
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        first = firsts[owner] + place
        last = first + np.minimum(width, counts[owner]) - 1
        hashes = hasher(buffer, starts[first], ends[last]) if len(first) else np.zeros(0, dtype=np.uint64)
        for part in np.split(hashes, np.cumsum(n)[:-1]):
            yield np.unique(part)


def signature(shingles: np.ndarray) -> bytes:
    """16 bits of each of HASHES minima."""
    low = np.full(HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for a in range(0, len(shingles), 1024):
        np.minimum(low, (shingles[a : a + 1024, None] * _MULTIPLIERS).min(axis=0), out=low)
    low *= np.uint64(0xFF51AFD7ED558CCD)  # the minima's high bits are all small: spread what tells them apart
    return (low >> np.uint64(48)).astype("<u2").tobytes()


def features(df: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n_shingles, fp, sig): set size, fingerprint of the set and signature (null for an empty set)."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches):
            sizes, fps, sigs = [], [], []
            for s in shingle_sets(part["text"].to_pylist(), width):
                full = len(s) > 0
                sizes.append(len(s))
                fps.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if full else None)
                sigs.append(signature(s) if full else None)
            columns = [part["doc_id"], pa.array(sizes, pa.int64()), pa.array(fps, pa.binary()), pa.array(sigs, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "fp", "sig"])

    texts = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = df.schema[id_col].dataType.simpleString()
    return texts.mapInArrow(of, f"doc_id {kind}, n_shingles long, fp binary, sig binary")


def _band_keys(sig: Column, bands: int, rows: int) -> Column:
    return F.array(*[F.xxhash64(F.lit(b), F.substring(sig, 2 * rows * b + 1, 2 * rows)) for b in range(bands)])


def _matrix(sigs) -> np.ndarray:
    return np.frombuffer(b"".join(sigs), dtype="<u2").reshape(-1, HASHES)


def _survivors(left: np.ndarray, right: np.ndarray, fewest: list[int]) -> np.ndarray:
    """Rows (aligned pairs of signatures) that no batch drops."""
    alive = np.arange(len(left))
    matches = np.zeros(len(left), dtype=np.int64)
    for k, least in enumerate(fewest):
        part = slice(k * BATCH, (k + 1) * BATCH)
        matches = matches + (left[alive, part] == right[alive, part]).sum(axis=1)
        good = matches >= least
        alive, matches = alive[good], matches[good]
    return alive


def _likely(pairs: DataFrame, classes: DataFrame, fewest: list[int]) -> DataFrame:
    """Candidate pairs (x, y) that pass the sequential test."""

    def test(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for a, b in batches:
            passed = np.zeros(len(a), dtype=bool)
            if len(a):
                passed[_survivors(_matrix(a), _matrix(b), fewest)] = True
            yield pd.Series(passed)

    sigs = classes.select("doc_id", "sig")
    joined = pairs.join(sigs.toDF("x", "sx"), "x").join(sigs.toDF("y", "sy"), "y")
    return joined.where(F.pandas_udf(test, "boolean")("sx", "sy")).select("x", "y").distinct()


def _confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs whose full sets reach the threshold. ``texts``: (doc_id, text) of whole documents."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[tuple, np.ndarray] = {}
        for part in parts(batches, 64):
            ys, centres = part["y"].to_pylist(), part["ty"].to_pylist()
            # A star's centre stands in many rows, one after the other; a text is known by its id and hash.
            keys = [(y, hash(t)) for y, t in zip(ys, centres, strict=True)]
            kept = {k: kept[k] for k in dict.fromkeys(keys) if k in kept}
            fresh = {k: t for k, t in zip(keys, centres, strict=True) if k not in kept}
            kept.update(zip(fresh, shingle_sets(list(fresh.values()), width), strict=True))
            good = []
            for s, k in zip(shingle_sets(part["tx"].to_pylist(), width), keys, strict=True):
                common = len(np.intersect1d(s, kept[k], assume_unique=True))
                good.append(100 * common >= percent * (len(s) + len(kept[k]) - common))
            yield part.select(["x", "y"]).filter(pa.array(good, pa.bool_()))

    joined = pairs.join(texts.toDF("x", "tx"), "x").join(texts.toDF("y", "ty"), "y")
    kind = pairs.schema["x"].dataType.simpleString()
    return joined.select("x", "y", "tx", "ty").mapInArrow(check, f"x {kind}, y {kind}").distinct()


def _across(
    mixed: DataFrame, classes: DataFrame, texts: DataFrame, fewest: list[int], rows: int, width: int, percent: int
) -> DataFrame:
    """Links (x, y) between different components in one bucket; at most one per two components and cell.

    ``mixed`` has (key, band, doc_id, label). Members outside their bucket's commonest component (the minor ones) meet
    all members. Both sides are dealt to blocks of about BLOCK rows; a cell, one task's work, is a block of all members
    against a block of minor ones. A bucket whose members are nearly all in one component has few minor ones, so few
    cells. A cell tests its pairs by signature, confirms survivors on full sets, and leaves pairs that share an earlier
    band to that band's bucket; pairs never leave the task, only links do.
    """
    counts = mixed.groupBy("key", "label").agg(F.count("*").alias("n"))
    sizes = counts.groupBy("key").agg(
        F.max(F.struct("n", "label"))["label"].alias("major"),
        F.ceil(F.sum("n") / BLOCK).cast("int").alias("all_blocks"),
        F.ceil((F.sum("n") - F.max("n")) / BLOCK).cast("int").alias("minor_blocks"),
    )
    dealt = mixed.join(sizes, "key")

    def cells(side: DataFrame, mine: str, other: str, my_blocks: str, other_blocks: str, minor: bool) -> DataFrame:
        block = F.pmod(F.xxhash64("doc_id"), F.col(my_blocks)).cast("int").alias(mine)
        across = F.explode(F.sequence(F.lit(0), F.col(other_blocks) - 1)).alias(other)
        cols = ["key", "i", "j", "band", "doc_id", "label", "minor"]
        return side.select("key", "band", block, across, "doc_id", "label", F.lit(minor).alias("minor")).select(*cols)

    all_rows = cells(dealt, "i", "j", "all_blocks", "minor_blocks", False)
    minor_rows = cells(dealt.where("label <> major"), "j", "i", "minor_blocks", "all_blocks", True)

    def compare(cell: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple] = []
        first, second = cell[cell["minor"]], cell[~cell["minor"]]
        if len(first) and len(second):
            band = int(cell["band"].iloc[0])
            left, right = _matrix(first["sig"]), _matrix(second["sig"])
            ids, labels = second["doc_id"].to_numpy(), second["label"].to_numpy()
            earlier = right[:, : band * rows].reshape(len(right), band, rows)
            sets: dict[int, np.ndarray] = {}
            linked = set()
            texts_of = list(second["text"])
            for k, (ident, label) in enumerate(zip(first["doc_id"], first["label"], strict=True)):
                other = np.flatnonzero(labels != label)
                other = other[_survivors(np.broadcast_to(left[k], (len(other), HASHES)), right[other], fewest)]
                seen = (earlier[other] == left[k, : band * rows].reshape(1, band, rows)).all(axis=2).any(axis=1)
                other = other[~seen]
                if not len(other):
                    continue
                fresh = [o for o in other if o not in sets]
                sets.update(zip(fresh, shingle_sets([texts_of[o] for o in fresh], width), strict=True))
                mine = next(shingle_sets([first["text"].iloc[k]], width))
                for o in other:
                    if (label, labels[o]) in linked:
                        continue
                    common = len(np.intersect1d(mine, sets[o], assume_unique=True))
                    if 100 * common >= percent * (len(mine) + len(sets[o]) - common):
                        linked |= {(label, labels[o]), (labels[o], label)}
                        found.append((max(ident, ids[o]), min(ident, ids[o])))
        return pd.DataFrame(found, columns=["x", "y"])

    kind = mixed.schema["doc_id"].dataType.simpleString()
    full = all_rows.union(minor_rows).join(classes.select("doc_id", "sig"), "doc_id").join(texts, "doc_id")
    met = full.groupBy("key", "i", "j").applyInPandas(compare, f"x {kind}, y {kind}")
    return met.distinct()


def _shared(made: DataFrame, classes: DataFrame) -> DataFrame:
    """(x, y): links between the classes that an id with several texts is in."""
    rows = made.where("fp is not null and doc_id is not null").select("doc_id", "fp")
    several = rows.groupBy("doc_id").agg(F.min("fp").alias("a"), F.max("fp").alias("b")).where("a < b").select("doc_id")
    reps = rows.join(several, "doc_id", "left_semi").join(classes.select("fp", F.col("doc_id").alias("x")), "fp")
    low = reps.groupBy("doc_id").agg(F.min("x").alias("y"))
    return reps.join(low, "doc_id").where("x > y").select("x", "y").distinct()


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80, miss: float = MISS
) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable) and kept of every row.

    Documents are linked if 100 * |A and B| >= percent * |A or B| on their sets of ``width``-word shingles.
    """
    bands, rows = bands_for(percent, miss)
    fewest = fewest_matches(percent, miss)
    made = written(features(df, width, id_col, text_col), "dup-features")
    classes = written(
        made.where("fp is not null and doc_id is not null")
        .groupBy("fp")
        .agg(F.min("doc_id").alias("doc_id"), F.first("sig").alias("sig")),
        "dup-classes",
    )
    keyed = classes.select("doc_id", F.posexplode(_band_keys(F.col("sig"), bands, rows)).alias("band", "key"))
    heads = keyed.groupBy("key").agg(F.min("doc_id").alias("y"), F.max("doc_id").alias("top")).where("y < top")
    members = written(keyed.join(heads.select("key", "y"), "key"), "dup-members")
    stars = members.where("doc_id > y").select(F.col("doc_id").alias("x"), "y").distinct()
    # Texts are moved by id once, and only those that share a bucket are kept for the steps below.
    texts = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    texts = texts.where("text is not null").join(members.select("doc_id").distinct(), "doc_id", "left_semi")
    texts = written(texts.dropDuplicates(["doc_id", "text"]), "dup-texts")
    likely = written(_likely(stars, classes, fewest), "dup-likely")
    links = written(_confirmed(likely, texts, width, percent), "dup-links")
    labels = written(components(links.union(_shared(made, classes))), "dup-labels")

    # What the stars left apart: buckets that hold more than one component.
    named = members.join(labels.toDF("doc_id", "label"), "doc_id", "left").select(
        "key", "band", "doc_id", F.coalesce("label", "doc_id").alias("label")
    )
    spread = named.groupBy("key").agg(F.min("label").alias("a"), F.max("label").alias("b"), F.count("*").alias("n"))
    # A bucket of two was compared in full by its star.
    apart = spread.where("a < b and n > 2").select("key")
    mixed = written(named.join(apart, "key", "left_semi"), "dup-mixed")
    more = written(_across(mixed, classes, texts, fewest, rows, width, percent), "dup-more")
    if not more.isEmpty():
        labels = written(components(labels.select(F.col("v").alias("x"), F.col("label").alias("y")).union(more)), "dup-labels")

    by_fp = classes.select("fp", F.col("doc_id").alias("rep")).join(labels.toDF("rep", "label"), "rep", "left")
    by_fp = by_fp.select("fp", F.coalesce("label", "rep").alias("label"))
    # A row without shingles has the label of the other rows of its id.
    bare = made.where("fp is null and doc_id is not null").select("doc_id").distinct()
    twins = made.where("fp is not null").select("doc_id", "fp").join(bare, "doc_id", "left_semi").join(by_fp, "fp")
    twins = twins.groupBy("doc_id").agg(F.min("label").alias("twin"))
    placed = made.select("doc_id", "n_shingles", "fp").join(by_fp, "fp", "left").join(twins, "doc_id", "left")
    placed = placed.withColumn("label", F.coalesce("label", "twin"))
    component = F.when(F.col("doc_id").isNotNull(), F.least(F.coalesce("label", "doc_id"), "doc_id"))
    return placed.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def keep_one_each(df: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group of near-duplicates, the one with the smallest doc_id; columns of ``df`` alone.

    Of rows that share a kept doc_id one stays; rows with a null doc_id all stay.
    """
    kept = near_duplicates(df, width=width, percent=percent).where("kept and doc_id is not null")
    chosen = df.join(kept.select("doc_id").distinct(), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return chosen.select(*[F.col(f"`{c}`") for c in df.columns]).union(df.where("doc_id is null"))
