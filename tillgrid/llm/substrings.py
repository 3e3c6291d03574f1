"""Substring dedup: words inside passages of ``width`` words or more that occur elsewhere in the corpus are removed.

Method: *suffix automata of reference shards*, through which contexts of the documents stream for their matching
statistics; maximal spans at or above the length threshold go. The reference of a corpus that is its own reference
has no size bound, so it is not sent whole to every task. Only what can match meets:

1. Anchors. Every window of ``width`` words picks the run of ``ANCHOR_WORDS`` words in it whose hash is lowest (ties: the
   first). Equal windows pick equal anchors, so a window that occurs elsewhere has an anchor that does. The neighbouring
   windows that pick one anchor make up its context; each window lies in one context. An anchor leaves the task as
   five numbers, not as text.
2. Anchors that occur once are done. Where all contexts of an anchor are the same words, all their windows are repeated.
   The same holds for a context that occurs twice among others; one of each kind stays as reference. What is left are
   contexts that occur once, at the ends of copied passages and around edits: their windows may or may not be repeated.
3. Reference shards: the distinct contexts of neighbouring anchor hashes, ``SHARD_WORDS`` words or so. A task builds
   the shard's suffix automaton, every state with its number of occurrences, and streams the contexts in question
   through it: a window is repeated if the state of its words occurs twice.
4. An anchor with more than ``HOT_CONTEXTS`` distinct contexts (a notice in a third of all documents, say) has no shard of
   bounded size. Its windows are counted by two 64-bit hashes instead, combined inside map tasks before any shuffle.
5. Spans go back to their documents, where covered words are removed.

Contexts and windows are held equal if two 64-bit hashes are (xxh3 of the words and the anchor's, or two of the window).
Documents are known by two hashes of id and text, so rows need no number and repeated rows share their spans.

Defined cases: null and empty texts have no words and come out as empty texts; texts under ``width`` words stay whole;
repeated rows (null ids too) are separate documents, so all windows of a repeated text go; an empty table gives an empty
result; other columns than ``doc_id`` and ``text`` are not looked at. A text is held whole by a task, and its windows
are found in pieces of ``PIECE_WORDS`` words.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillgrid.llm.common import SpanHasher, parts, slices, written
from tillgrid.operators.sizing import broadcast_if_small

WIDTH = 35
ANCHOR_WORDS = 8
SHARD_WORDS = 1 << 15
HOT_CONTEXTS = 512
PIECE_WORDS = 1 << 17
#: Bytes of text whose words are Python objects at a time.
LOT_BYTES = 1 << 20

_ANCHORS = "h long, c long, k1 long, k2 long, place long"
_CONTEXTS = "h long, c long, m long, k1 long, k2 long, at long, words binary"
_SPANS = "k1 long, k2 long, at long, n long"


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id and text with the two hashes that name the document."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.xxhash64("doc_id", text).alias("k1"), F.crc32(text).alias("k2"), "doc_id", text.alias("text"))


def first_lowest(values: np.ndarray, span: int) -> np.ndarray:
    """Place of the first lowest value in every run of ``span`` neighbours, by doubling."""
    at = np.arange(len(values))
    width = 1
    while width < span:
        step = min(width, span - width)
        a, b = at[: len(at) - step], at[step:]
        at = np.where(values[b] < values[a], b, a)
        width += step
    return at


class _Words:
    """Words of several texts in one buffer, one space after each; ``owner`` and ``index`` of every word.

    A text longer than a piece is laid out in pieces that overlap by ``width`` - 1 words, so no window is lost or doubled.
    """

    def __init__(self, texts: Sequence[bytes], width: int) -> None:
        flat: list[bytes] = []
        sizes, owners, offsets = [], [], []
        for k, text in enumerate(texts):
            words = text.split()
            step = PIECE_WORDS - width + 1
            for at in range(0, max(len(words) - width + 1, 0), step):
                piece = words[at : at + PIECE_WORDS]
                flat += piece
                sizes.append(len(piece))
                owners.append(k)
                offsets.append(at)
        self.buffer = b" ".join(flat) + b" "
        lengths = np.fromiter(map(len, flat), dtype=np.int64, count=len(flat))
        self.ends = np.cumsum(lengths + 1) - 1
        self.starts = self.ends - lengths
        n = np.asarray(sizes, dtype=np.int64)
        first = np.cumsum(n) - n
        self.owner = np.repeat(np.asarray(owners, dtype=np.int64), n)
        self.index = np.arange(len(flat)) - np.repeat(first - np.asarray(offsets, dtype=np.int64), n)
        self.stop = np.repeat(first + n, n)

    def cut(self, first: np.ndarray, last: np.ndarray) -> Iterator[bytes]:
        """The words from ``first`` to ``last`` (included), joined by spaces."""
        for i, j in zip(self.starts[first].tolist(), self.ends[last].tolist()):
            yield self.buffer[i:j]


def _signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64).view(np.int64)


def contexts(words: _Words, hasher: SpanHasher, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, first window, last window) of every context; windows are numbered by their first word."""
    k = ANCHOR_WORDS if width > ANCHOR_WORDS else max(width // 2, 1)
    n = len(words.starts)
    if n < width:
        none = np.empty(0, dtype=np.int64)
        return none.astype(np.uint64), none, none
    hashes = hasher(np.frombuffer(words.buffer, dtype=np.uint8), words.starts[: n - k + 1], words.ends[k - 1 :])
    lowest = first_lowest(hashes, width - k + 1)
    windows = np.flatnonzero(np.arange(len(lowest)) + width <= words.stop[: len(lowest)])
    anchors = lowest[windows]
    new = np.ones(len(windows), dtype=bool)
    new[1:] = (anchors[1:] != anchors[:-1]) | (windows[1:] != windows[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(windows))[: len(first)] - 1
    return hashes[anchors[first]], windows[first], windows[last]


def _find_anchors(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """(k1, k2, text) → (h, c, k1, k2, place): place holds the first window times 2^16 and the number of windows."""
    hasher = SpanHasher()
    for batch in parts(batches, 1024):
        texts = batch.column(2)
        sizes = [len(t) for t in texts.cast(pa.binary()).to_pylist()]
        for i, j in slices(sizes, LOT_BYTES):
            lot = batch.slice(i, j - i)
            words = _Words([t.encode() for t in lot.column(2).to_pylist()], width)
            h, first, last = contexts(words, hasher, width)
            digest = xxhash.xxh3_64_intdigest
            c = np.fromiter(map(digest, words.cut(first, last + width - 1)), dtype=np.uint64, count=len(first))
            k1, k2 = (lot.column(x).to_numpy(zero_copy_only=False)[words.owner[first]] for x in (0, 1))
            place = (words.index[first] << 16) | (last - first + 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, type=pa.int64()) for x in (_signed(h), _signed(c), k1, k2, place)],
                names=["h", "c", "k1", "k2", "place"],
            )


def _cut_contexts(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """(k1, k2, text, wanted) → the wanted contexts' words; those of hot anchors as windows with two hashes instead."""
    seen: set[tuple[int, int]] = set()  # repeated rows would give the same contexts again
    names = ["h", "c", "m", "k1", "k2", "at", "words"]
    for batch in parts(batches, 64):
        out: list[tuple] = []
        for k1, k2, text, wanted in zip(*(c.to_pylist() for c in batch.columns)):
            if (k1, k2) in seen:
                continue
            if len(seen) >= 1 << 16:
                seen.clear()
            seen.add((k1, k2))
            words = text.encode().split()
            for w in wanted:
                at, n = w["place"] >> 16, w["place"] & 0xFFFF
                if not w["hot"]:
                    out.append((w["h"], w["c"], w["m"], k1, k2, at, b" ".join(words[at : at + n + width - 1])))
                    continue
                for t in range(at, at + n):
                    digest = xxhash.xxh3_128_intdigest(b" ".join(words[t : t + width]))
                    two = np.array([digest >> 64, digest & (2**64 - 1)], dtype=np.uint64).view(np.int64)
                    out.append((int(two[0]), int(two[1]), w["m"], k1, k2, t, None))
        if out:
            columns = list(zip(*out))
            types = [pa.int64()] * 6 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types)], names=names)


class SuffixAutomaton:
    """All runs of words of several texts; every state knows how often its runs occur (texts count by weight)."""

    def __init__(self, texts: Sequence[Sequence], weights: Sequence[int]) -> None:
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.count = [0]
        for text, weight in zip(texts, weights):
            last = 0
            for word in text:
                last = self._extend(last, word)
                self.count[last] += weight
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            self.count[self.link[state]] += self.count[state]

    def _state(self, length: int, link: int, onward: dict) -> int:
        self.next.append(onward)
        self.link.append(link)
        self.length.append(length)
        self.count.append(0)
        return len(self.link) - 1

    def _split(self, p: int, q: int, word) -> int:
        """The state of exactly p's longest run and ``word``, taken out of q."""
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, word) -> int:
        q = self.next[last].get(word)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, word)
        new = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, word)
        return new

    def statistics(self, text: Sequence, most: int) -> Iterator[tuple[int, int]]:
        """(state, length) per word: the longest run ending there that occurs in the reference, up to ``most`` words."""
        state = length = 0
        for word in text:
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state = self.next[state][word]
                length += 1
            if length > most:
                length = most
            while self.length[self.link[state]] >= length > 0 and state:
                state = self.link[state]
            yield state, length

    def repeated(self, text: Sequence, width: int, least: int = 2) -> list[int]:
        """First words of the windows of ``width`` words of ``text`` that occur ``least`` times or more."""
        found = enumerate(self.statistics(text, width))
        return [k - width + 1 for k, (state, length) in found if length >= width and self.count[state] >= least]


def _match_shards(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Contexts sorted by anchor → spans (k1, k2, at, n) of repeated windows of the contexts that occur once."""
    shard: list[tuple] = []
    size = 0

    def spans() -> pa.RecordBatch:
        texts = [row[6].split() for row in shard]
        automaton = SuffixAutomaton(texts, [row[2] for row in shard])
        out: list[tuple[int, int, int, int]] = []
        for row, text in zip(shard, texts):
            if row[2] > 1:
                continue
            runs: list[list[int]] = []
            for t in automaton.repeated(text, width):
                if runs and runs[-1][0] + runs[-1][1] == t:
                    runs[-1][1] += 1
                else:
                    runs.append([t, 1])
            out += [(row[3], row[4], row[5] + t, n) for t, n in runs]
        columns = list(zip(*out)) if out else [()] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(c, type=pa.int64()) for c in columns], names=["k1", "k2", "at", "n"]
        )

    for batch in parts(batches, 1024):
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if size >= SHARD_WORDS and row[0] != shard[-1][0]:
                yield spans()
                shard, size = [], 0
            shard.append(row)
            size += row[6].count(b" ") + 1
    if shard:
        yield spans()


def repeated_spans(docs: DataFrame, width: int = WIDTH, hot_contexts: int = HOT_CONTEXTS) -> DataFrame:
    """(k1, k2, at, n): runs of n neighbouring windows, the first at word ``at``, that occur elsewhere in ``docs`` as well.

    ``docs`` holds k1, k2 and text; see the module text for the steps.
    """
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select("k1", "k2", "text")
    anchors = written(texts.mapInArrow(lambda it: _find_anchors(it, width), _ANCHORS), "substring-anchors")
    # Anchors that occur twice, and whether their contexts differ (which only some texts or edits cause).
    twice = anchors.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("lo"), F.max("c").alias("hi"))
    twice = twice.where("n > 1").select("h", (F.col("lo") != F.col("hi")).alias("mixed"))
    # Tables that are joined are written first: a join of plain exchanges has its hot keys split (a passage in a third of
    # all documents makes hot anchors), one whose side is still being summed up in the same stage has not.
    marked = written(anchors.join(written(twice, "substring-twice"), "h"), "substring-hits")

    # The distinct contexts of anchors whose contexts differ, with their number and one place where each stands.
    mixed = marked.where("mixed")
    kinds = written(
        mixed.groupBy("h", "c").agg(F.count(F.lit(1)).alias("m"), F.min(F.struct("k1", "k2", "place")).alias("one")),
        "substring-contexts",
    )
    hot = kinds.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_contexts).select("h", F.lit(True).alias("hot"))
    hot = broadcast_if_small(written(hot, "substring-hot"))
    wanted = kinds.join(hot, "h", "left").select("one.*", "h", "c", "m", F.coalesce("hot", F.lit(False)).alias("hot"))
    lists = wanted.groupBy("k1", "k2").agg(F.collect_list(F.struct("place", "h", "c", "m", "hot")).alias("wanted"))
    cut = texts.join(written(lists, "substring-wanted"), ["k1", "k2"]).mapInArrow(lambda it: _cut_contexts(it, width), _CONTEXTS)
    cut = written(cut, "substring-words")

    shards = cut.where("words IS NOT NULL").repartition(tasks, "h").sortWithinPartitions("h", "c")
    matched = shards.mapInArrow(lambda it: _match_shards(it, width), _SPANS)
    windows = cut.where("words IS NULL")
    often = windows.groupBy("h", "c").agg(F.sum("m").alias("n")).where("n > 1").select("h", "c")
    often = written(often, "substring-windows")
    counted = windows.where("m = 1").join(often, ["h", "c"], "left_semi").select("k1", "k2", "at", F.lit(1).cast("long").alias("n"))
    copies = mixed.join(kinds.where("m > 1").select("h", "c"), ["h", "c"], "left_semi")
    whole = marked.where("NOT mixed").select("k1", "k2", "place").unionByName(copies.select("k1", "k2", "place"))
    whole = whole.select(
        "k1", "k2", F.shiftright("place", 16).alias("at"), F.col("place").bitwiseAND(F.lit(0xFFFF)).alias("n")
    )
    return whole.unionByName(matched).unionByName(counted)


def _remove(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, spans) → (doc_id, n_words, n_removed, kept, removed)."""
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    for batch in parts(batches, 64):
        n_words, n_removed, kept, removed = [], [], [], []
        for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            words = text.encode().split()
            edges = np.zeros(len(words) + 1, dtype=np.int64)
            for s in spans or ():
                edges[s["at"]] += 1
                edges[s["at"] + s["n"] + width - 1] -= 1
            covered = np.cumsum(edges[:-1]) > 0
            turns = np.flatnonzero(np.diff(np.concatenate([[0], covered.view(np.int8), [0]])))
            runs = turns.reshape(-1, 2).tolist()
            left, at = [], 0
            for i, j in runs:
                left += words[at:i]
                at = j
            left += words[at:]
            n_words.append(len(words))
            n_removed.append(len(words) - len(left))
            kept.append(b" ".join(left).decode())
            removed.append([{"start": i, "stop": j} for i, j in runs])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(n_words, type=pa.int64()),
                pa.array(n_removed, type=pa.int64()),
                pa.array(kept, type=pa.string()),
                pa.array(removed, type=spans_type),
            ],
            names=["doc_id", "n_words", "n_removed", "kept", "removed"],
        )


def remove_repeats(docs: DataFrame, width: int = WIDTH, hot_contexts: int = HOT_CONTEXTS) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words that stay, joined by one space) and removed (spans of words)."""
    keyed = _keyed(docs)
    spans = repeated_spans(keyed, width, hot_contexts)
    # A set: repeated rows bring equal spans. It is no longer than the text has words.
    lists = spans.groupBy("k1", "k2").agg(F.collect_set(F.struct("at", "n")).alias("spans"))
    lists = written(lists, "substring-lists")
    joined = keyed.join(lists, ["k1", "k2"], "left").select("doc_id", "text", "spans")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    result = f"doc_id {id_type}, n_words long, n_removed long, kept string, removed array<struct<start: long, stop: long>>"
    return joined.mapInArrow(lambda it: _remove(it, width), result)
