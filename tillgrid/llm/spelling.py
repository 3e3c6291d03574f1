"""Spelling variants: every word's near words (one edit away), its form among them, and the root that forms lead to.

Method: *sorted-list dynamic programming*. The words of a group stand in sorted order; a query word is compared with the
words after it, row by row of a banded edit matrix (the diagonal and one cell on each side). The rows of a prefix that
two neighbours of the list share are kept, so a word costs only the letters after the longest common prefix (LCP) with
the word before it, and once a row holds nothing below two edits, all words that share that prefix are passed over.

Groups: one edit of two words, the shorter one of m code points cut into three parts, leaves two of the parts as they
are. So each word is dealt under three keys for m = its length and three for m = its length less one (as the longer word
of a pair), and a pair is reported only under the key of the part where the two first differ: once, with no table
of pairs to make distinct. Where the last two parts are shared the words are read backwards, so the list is always sorted by
what is shared. Groups of more than ``HOT_GROUP`` words are dealt anew by the word without one code point, which
bounds a group by the letters that one place can hold (see ``_finer_keys``); the counting combines inside map tasks.

Defined cases: null text has no words and a null id counts as the empty text in ``<doc_id>:<run>``; repeated rows count each time;
an empty table gives an empty result; columns other than ``doc_id`` and ``text`` are not looked at. Ties for the
form go to the smallest word in code-point order. A text and a word are held whole by the task that works on them.
"""

from __future__ import annotations

import zlib
from collections import _count_elements as count_into
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillgrid.llm.common import parts, written
from tillgrid.operators.sizing import broadcast_if_small

MIN_CHARS = 5
MIN_COUNT = 3
#: A run is misspelt (loses one code point) where this divides the crc32 of ``<doc_id>:<run>``.
MISSPELL = 97
#: Distinct words a task counts before it passes the counts on.
COUNTED_WORDS = 1 << 18
#: Most words of a group that is scanned as it is.
HOT_GROUP = 4096

#: Latin-1 bytes: lower-cased letters stay, everything else becomes a space.
_LETTERS = bytes(b if 97 <= b <= 122 or b >= 0xC0 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def _runs(text: str) -> list[bytes]:
    """Maximal runs ``[A-Za-z\\u00C0-\\u00FF]+`` with A-Z lower-cased, in Latin-1."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split()


def _misspell(runs: list[bytes], prefix: int) -> Iterator[tuple[bytes, bytes]]:
    """(run, run without one code point) for the distinct runs that the rule hits."""
    for run in set(runs):
        crc = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), prefix)
        if crc % MISSPELL == 0:
            at = crc % len(run)
            yield run, run[:at] + run[at + 1 :]


def _count_runs(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    counts: dict[bytes, int] = {}

    def out() -> pa.RecordBatch:
        kept = [(w, n) for w, n in counts.items() if len(w) >= min_chars and n]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([w.decode("latin-1") for w, _ in kept], type=pa.string()),
                pa.array([n for _, n in kept], type=pa.int64()),
            ],
            names=["word", "n"],
        )

    for batch in parts(batches):
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            runs = _runs(text)
            count_into(counts, runs)
            often: dict[bytes, int] = {}
            for run, short in _misspell(runs, zlib.crc32(f"{doc_id}:".encode())):
                if not often:
                    count_into(often, runs)
                counts[run] -= often[run]
                counts[short] = counts.get(short, 0) + often[run]
            if len(counts) >= COUNTED_WORDS:
                yield out()
                counts.clear()
    if counts:
        yield out()


def vocabulary(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): distinct words of ``min_chars`` code points and ``min_count`` occurrences at least in all texts."""
    rows = docs.where(F.col("text").isNotNull()).select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text")
    counted = rows.mapInArrow(lambda it: _count_runs(it, min_chars), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _cuts(m: Column) -> tuple[Column, Column]:
    """Ends of the first and the second of three parts of m code points."""
    return F.floor((m + 1) / 3).cast("int"), F.floor((2 * m + 1) / 3).cast("int")


def _keyed(words: DataFrame, min_chars: int) -> DataFrame:
    """(key, part, m, word, n): each word under the shared two thirds of it, per part that may hold the edit."""
    length = F.length("word")
    sizes = words.withColumn("m", F.explode(F.array(length, length - 1))).where(F.col("m") >= min_chars)
    i, j = _cuts(F.col("m"))
    left, right = (lambda k: F.left("word", k)), (lambda k: F.right("word", F.col("m") - k))
    shared = F.array(
        F.struct(F.lit(0).alias("part"), right(i).alias("rest")),
        F.struct(F.lit(1).alias("part"), F.concat(left(i), F.lit("\0"), right(j)).alias("rest")),
        F.struct(F.lit(2).alias("part"), left(j).alias("rest")),
    )
    rows = sizes.select("word", "n", "m", F.explode(shared).alias("s"))
    return rows.select(F.xxhash64("s.part", "m", "s.rest").alias("key"), "s.part", "m", "word", "n", F.lit(-1).alias("at"))


def _finer_keys(rows: DataFrame) -> DataFrame:
    """Rows of hot groups under finer keys: the place ``at`` of the edit and the word without what stands there.

    Two words of m code points that differ at one place are equal without it, and a word of m + 1 code points without the one
    at that place is the shorter word. A group then holds at most one word for each code point that a place can hold.
    """
    i, j = _cuts(F.col("m"))
    first = F.when(F.col("part") == 0, 0).when(F.col("part") == 1, i).otherwise(j)
    last = F.when(F.col("part") == 0, i - 1).when(F.col("part") == 1, j - 1).otherwise(F.col("m"))
    placed = rows.withColumn("at", F.explode(F.sequence(first, last)))
    without = F.concat(F.left("word", F.col("at")), F.substring("word", F.col("at") + 2, F.length("word")))
    same = F.struct(F.lit("same").alias("kind"), without.alias("rest"))
    longer = F.struct(F.lit("longer").alias("kind"), F.when(F.length("word") == F.col("m"), F.col("word")).otherwise(without).alias("rest"))
    kinds = F.when(F.length("word") == F.col("m"), F.array(same, longer)).otherwise(F.array(longer))
    return placed.select("part", "m", "word", "n", "at", F.explode(kinds).alias("s")).select(
        F.xxhash64("part", "m", "at", "s.kind", "s.rest").alias("key"), "part", "m", "word", "n", "at"
    )


def common_prefix(a: str, b: str) -> int:
    """Number of leading code points that two words share."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return next(k for k in range(n) if a[k] != b[k])


def near_pairs(words: list[str]) -> Iterator[tuple[int, int]]:
    """Places (x < y) of all pairs of a sorted list of distinct words that are one edit apart."""
    n = len(words)
    shared = [0, *(common_prefix(words[k - 1], words[k]) for k in range(1, n))]
    deepest = max(map(len, words)) + 2
    low, mid, high = [0] * deepest, [0] * deepest, [0] * deepest
    for x in range(n - 1):
        query = words[x]
        size = len(query)
        q = query + "\0\0"
        # Rows of the query's own prefixes: the diagonal is 0, its neighbours 1; kept rows reach down to ``depth``.
        low[: size + 1], mid[: size + 1], high[: size + 1] = [1] * (size + 1), [0] * (size + 1), [1] * (size + 1)
        y = x + 1
        depth = shared[y]
        while y < n:
            word = words[y]
            length = len(word)
            d = depth
            a, b, c = low[d], mid[d], high[d]
            while d < length:
                letter = word[d]
                # Cells (d + 1, d), (d + 1, d + 1), (d + 1, d + 2) from row d; column 0 has none to its left.
                na = a + (letter != q[d - 1]) if d else 1
                if b < na:
                    na = b + 1 if b + 1 < na else na
                nb = b + (letter != q[d])
                if c + 1 < nb:
                    nb = c + 1
                if na + 1 < nb:
                    nb = na + 1
                nc = c + (letter != q[d + 1]) if d + 1 < size else 9
                if nb + 1 < nc:
                    nc = nb + 1
                d += 1
                if na > 1 and nb > 1 and nc > 1:
                    break
                a, b, c = low[d], mid[d], high[d] = na, nb, nc
            else:
                gap = size - length
                if (gap == 0 and b == 1) or (gap == -1 and a == 1) or (gap == 1 and c == 1):
                    yield x, y
                d += 1
            # The prefix of d code points is out of reach (or the word is done): pass over all words that share it.
            y += 1
            if y < n:
                depth = shared[y]
                while depth >= d:
                    y += 1
                    if y == n:
                        break
                    depth = shared[y]


def _differ_in(x: str, y: str, m: int, part: int, at: int) -> bool:
    """The pair belongs under this key: its shorter word has m code points, and it first differs there."""
    if min(len(x), len(y)) != m:
        return False
    k = common_prefix(x, y)
    if at >= 0:
        return k == at
    return part == (0 if k < (m + 1) // 3 else 1 if k < (2 * m + 1) // 3 else 2)


class _Near:
    """Near words of each word found so far: how many, and the one of largest n (ties: the smallest)."""

    def __init__(self) -> None:
        self.found: dict[str, tuple[int, int, str]] = {}

    def add(self, word: str, other: str, n: int) -> None:
        count, best_n, best = self.found.get(word, (0, -1, ""))
        if n > best_n or (n == best_n and other < best):
            best_n, best = n, other
        self.found[word] = (count + 1, best_n, best)

    def batch(self) -> pa.RecordBatch:
        rows = [(w, *v) for w, v in self.found.items()]
        self.found = {}
        columns = list(zip(*rows)) if rows else [()] * 4
        types = [pa.string(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, type=t) for c, t in zip(columns, types)], names=["word", "n_near", "form_n", "form"]
        )


def _scan_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, list) → partial (word, n_near, form_n, form)."""
    near = _Near()

    def scan(rows: pa.Table) -> None:
        m, part, at = (rows.column(c)[0].as_py() for c in ("m", "part", "at"))
        listed, n = rows.column("listed").to_pylist(), rows.column("n").to_pylist()
        for x, y in near_pairs(listed):
            a, b = (listed[x][::-1], listed[y][::-1]) if part == 0 else (listed[x], listed[y])
            if _differ_in(a, b, m, part, at):
                near.add(a, b, n[y])
                near.add(b, a, n[x])

    held: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if held is not None:
            rows = pa.concat_tables([held, rows])
        keys = rows.column("key").to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        sizes = np.diff(np.append(starts, len(keys)))
        # The last group may go on in the next batch.
        for k in np.flatnonzero(sizes[:-1] > 1).tolist():
            scan(rows.slice(starts[k], sizes[k]))
        held = rows.slice(starts[-1])
        if len(near.found) >= COUNTED_WORDS:
            yield near.batch()
    if held is not None and held.num_rows > 1:
        scan(held)
    yield near.batch()


def near_words(words: DataFrame, min_chars: int = MIN_CHARS, hot_group: int = HOT_GROUP) -> DataFrame:
    """Partial rows (word, n_near, form_n, form) of distinct ``words`` (word, n); sum and pick the largest per word."""
    keyed = _keyed(words, min_chars)
    hot = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > hot_group).select("key")
    hot = broadcast_if_small(written(hot, "spelling-hot"))
    fine = _finer_keys(keyed.join(hot, "key", "left_semi"))
    rows = keyed.join(hot, "key", "left_anti").unionByName(fine)
    listed = rows.withColumn("listed", F.when(F.col("part") == 0, F.reverse("word")).otherwise(F.col("word"))).drop("word")
    grouped = listed.repartition("key").sortWithinPartitions("key", "listed")
    return grouped.mapInArrow(_scan_groups, "word string, n_near long, form_n long, form string")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word that has a form (word, form): forms followed to the last one.

    Each step doubles the reach; a form has at least twice its word's count, so chains are short and have no rings.
    """
    reach = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = reach.select(F.col("word").alias("root"), F.col("root").alias("next"))
        steps = reach.join(onward, "root", "left")
        further = written(steps.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        reach = further.select("word", "root")
        if further.where("moved").isEmpty():
            return reach


def variant_groups(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of the vocabulary of ``docs``.

    The form is the near word of largest n, if that is twice the word's n or more; the root is the last form reached.
    """
    words = written(vocabulary(docs, min_chars, min_count), "spelling-words")
    near = near_words(words, min_chars)
    none = [F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("form_n"), F.lit(None).cast("string").alias("form")]
    both = words.select("word", "n", *none).unionByName(near.withColumn("n", F.lit(0).cast("long")))
    best = F.struct((-F.col("form_n")).alias("minus_n"), "form")
    joined = both.groupBy("word").agg(
        F.sum("n").alias("n"),
        F.sum("n_near").alias("n_near"),
        F.min(F.when(F.col("form").isNotNull(), best)).alias("best"),
    )
    takes = -F.col("best.minus_n") >= 2 * F.col("n")
    found = joined.select(
        "word",
        "n",
        "n_near",
        F.when(takes, F.col("best.form")).alias("form"),
        F.when(takes, -F.col("best.minus_n")).alias("form_n"),
    )
    found = written(found, "spelling-forms")
    ends = roots(found.where(F.col("form").isNotNull()))
    return found.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
