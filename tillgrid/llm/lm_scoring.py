"""Language-model scores by a probabilistic suffix tree over bytes, beside a word unigram baseline.

A text is read as its lower-cased (A-Z) words, a space after each, then an end symbol. The tree learns the counts
of every byte after every context of up to ``depth`` bytes over all training texts. A context becomes a state if it
occurs at least ``least`` times and its next-byte distribution diverges from that of the context one byte
shorter by more than describing it costs (occurrences times Kullback-Leibler divergence against half a log of the
occurrences per distinct next byte). At each place the states of all its suffixes are used, shortest first: a state
gives a next byte (n + kinds * shorter) / (occurrences + kinds), where shorter is the probability by the next shorter
state (1/256 before the root), so a state's probabilities sum to 1.

``text_score`` is the text's log10 probability: the sum over all its bytes, unknown words spelled like any others.
``score`` uses the baseline's symbols, so that the two compare: the known tokens and one class of unknown ones. The
class has the training tokens' share of words seen once (Good and Turing's estimate of what is still unseen); a known
token has the rest times the tree's probability of its bytes and closing space, given the bytes before. The counts of
words enter ``base_score`` alone.

The states and their next bytes grow with the corpus, as do the word counts, and neither is gathered. Texts are dealt to
batches of bounded bytes. Each batch sends its distinct words and its distinct places (a byte and the ``depth`` before
it) to buckets, and gets corpus counts and log probabilities back. A place's bucket follows from the last ``TAIL`` bytes
before it, so all longer states it may use are in that bucket; the shorter ones (at most 256^TAIL entries, whatever the
corpus) are broadcast. There are as many buckets as states need, and a bucket's places are answered for a bounded number
of batches at a time. Codes are sent as keys that sort by bucket (``_keys``). The batches are scored in ``ROUNDS`` runs,
each over its own share of the texts, so that the exchanged places and answers of one run are on disk at a time.

Defined results: a null or empty text has the end symbol alone; repeated rows are scored alike (and all train);
without training rows every count is 0; an empty table gives no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillgrid.llm.common import SpanHasher, parts, slices, text_id, written_lean
from tillgrid.llm.ngrams import END, Lookup, low_bytes, segments

DEPTH = 7
#: Occurrences that a context needs, whatever the corpus.
LEAST = 8
#: Gains this close to the bound count as equal to it, in whatever order they were summed.
TIE = 1e-9
#: Longer contexts are counted where those meet that share their last bytes.
STEM = 4
#: States of fewer bytes are broadcast; longer ones are dealt by so many last bytes of their context.
TAIL = 3
#: States' entries per bucket, on average.
BUCKET_ENTRIES = 100_000
BATCH_BYTES = 4 << 20
#: Places that a task sorts and counts at once.
SORTED = 8 << 20
#: Bytes of text whose codes are made at once, so that they stay in the processor's cache.
PIECE = 1 << 18
#: Batches whose words share a bucket, on average.
WORD_BATCHES = 8
#: Runs that score the batches one after another.
ROUNDS = 3
#: Hash that stands for the end token in word counts.
_END_WORD = np.uint64(0)
_DEPTH_SHIFT = np.uint64(56)
_SPREAD = 2654435761


def _stream(text: str | None) -> bytes:
    words = [] if text is None else text.encode("utf-8", "ignore").lower().split()
    return b" ".join([*words, bytes([END])])


_ZSTD = pa.Codec("zstd", compression_level=1)


def _packed(numbers: np.ndarray) -> bytes:
    """Unsigned numbers as compressed byte planes, after their count: sorted codes share their first bytes."""
    planes = np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, numbers.itemsize).T)
    return len(numbers).to_bytes(8, "little") + _ZSTD.compress(planes, asbytes=True)


def _unpacked(packed: bytes, kind: type = np.uint64) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = _ZSTD.decompress(packed[8:], int.from_bytes(packed[:8], "little") * size, asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, dtype=np.uint8).reshape(size, -1).T).view(kind).ravel()


def _keys(codes: np.ndarray, last: int) -> np.ndarray:
    """Codes with the ``last`` bytes before the place, hashed one to one, in front: they sort by bucket."""
    width = np.uint64(8 * last)
    spread = (((codes >> np.uint64(8)) & low_bytes(last)) * np.uint64(_SPREAD)) & low_bytes(last)
    older = codes >> (width + np.uint64(8))
    return (spread << (np.uint64(64) - width)) | (older << np.uint64(8)) | (codes & np.uint64(255))


def _codes(keys: np.ndarray, last: int) -> np.ndarray:
    """The codes that ``_keys`` was given."""
    width = np.uint64(8 * last)
    tail = ((keys >> (np.uint64(64) - width)) * np.uint64(pow(_SPREAD, -1, 1 << 8 * last))) & low_bytes(last)
    rest = keys & ((np.uint64(1) << (np.uint64(64) - width)) - np.uint64(1))
    older = rest >> np.uint64(8)
    return (older << (width + np.uint64(8))) | (tail << np.uint64(8)) | (keys & np.uint64(255))


def _shares(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, start, end) of the sorted keys' parts in each of ``buckets`` equal ranges of their first 24 bits."""
    firsts = np.asarray([-(-(b << 24) // buckets) << 40 for b in range(1, buckets)], dtype=np.uint64)
    edges = [0, *np.searchsorted(keys, firsts).tolist(), len(keys)]
    return ((b, lo, hi) for b, (lo, hi) in enumerate(zip(edges, edges[1:])) if lo < hi)


def _fresh(numbers: np.ndarray) -> np.ndarray:
    """Whether each of the sorted numbers differs from the one before."""
    fresh = np.ones(len(numbers), dtype=bool)
    np.not_equal(numbers[1:], numbers[:-1], out=fresh[1:])
    return fresh


def _distinct(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct numbers and how often each occurs."""
    numbers = np.sort(numbers)  # several times as fast as np.unique, which hashes first
    first = np.flatnonzero(_fresh(numbers))
    return numbers[first], np.diff(np.append(first, len(numbers)))


def _sorted(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct numbers, the order that sorts all, and in that order each one's place among the distinct."""
    order = np.argsort(numbers)
    numbers = numbers[order]
    fresh = _fresh(numbers)
    return numbers[fresh], order, np.cumsum(fresh, dtype=np.int32) - 1


def _ranked(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct numbers and each number's place among them."""
    seen, order, ranks = _sorted(numbers)
    at = np.empty(len(order), dtype=np.int32)
    at[order] = ranks
    return seen, at


_GRAMS = pa.schema([("bucket", pa.int32()), ("codes", pa.binary()), ("counts", pa.binary())])


def _sent_grams(texts: DataFrame, depth: int, buckets: int) -> DataFrame:
    """(bucket, codes, counts): the texts' grams, counted per task and dealt by the last bytes of their context."""
    last = min(STEM, depth)

    def sent(held: list[np.ndarray]) -> pa.RecordBatch:
        keys, n = _distinct(np.concatenate(held))
        n = n.astype(np.uint32)
        out = [(b, _packed(keys[lo:hi]), _packed(n[lo:hi])) for b, lo, hi in _shares(keys, buckets)]
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), _GRAMS)], schema=_GRAMS)

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for part in parts(batches):
            for piece, _, _ in segments([_stream(t) for t in part["text"].to_pylist()], depth, PIECE):
                held.append(_keys(piece, last) if last else piece)
                size += len(piece)
                if size >= SORTED:
                    yield sent(held)
                    held, size = [], 0
        if held:
            yield sent(held)

    return texts.select("text").mapInArrow(grams, "bucket int, codes binary, counts binary")


def _summed(group: pd.DataFrame, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """A bucket's distinct codes and their counts."""
    keys = np.concatenate([_unpacked(x) for x in group["codes"]])
    counts = np.concatenate([_unpacked(x, np.uint32) for x in group["counts"]]).astype(np.int64)
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(_fresh(keys))
    last = min(STEM, depth)
    return _codes(keys[first], last) if last else keys[first], np.add.reduceat(counts, first)


def byte_counts(texts: DataFrame, depth: int, buckets: int = 1) -> DataFrame:
    """(code, n): how often each byte follows each ``depth`` bytes, over whole texts (column ``text``)."""

    def summed(_: tuple, group: pd.DataFrame) -> pd.DataFrame:
        codes, n = _summed(group, depth)
        return pd.DataFrame({"code": codes.astype(np.int64), "n": n})

    return _sent_grams(texts, depth, buckets).groupBy("bucket").applyInPandas(summed, "code long, n long")


def _rolled(codes: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """Sorted grams of ``k`` context bytes and, for each, its count, its context's occurrences and distinct next bytes."""
    codes = codes & low_bytes(k + 1)
    order = np.argsort(codes)
    codes = codes[order]
    start = np.flatnonzero(np.diff(codes, prepend=~codes[:1]))
    grams, n = codes[start], np.add.reduceat(counts[order], start)
    context = grams >> np.uint64(8)
    first = np.flatnonzero(np.diff(context, prepend=~context[:1]))
    kinds = np.diff(np.append(first, len(grams)))
    return grams, n, np.repeat(np.add.reduceat(n, first), kinds), np.repeat(kinds, kinds)


def _entries(codes: np.ndarray, counts: np.ndarray, depth: int, least: float) -> pd.DataFrame:
    """The entries of the retained contexts of more than ``STEM`` bytes, and of all contexts of ``STEM`` bytes.

    All grams that end in the same ``STEM`` bytes and a next byte are given together, so every context meets the one a
    byte shorter here.
    """
    longer = _rolled(codes, counts, depth)
    out = []
    for k in range(depth - 1, STEM - 1, -1):
        level = _rolled(*longer[:2], k)
        frequent = longer[2] >= least
        grams, n, total, kinds = (x[frequent] for x in longer)
        if len(grams):
            at = np.searchsorted(level[0], grams & low_bytes(k + 1))
            gains = n * np.log(n / total / (level[1][at] / level[2][at]))
            first = np.flatnonzero(np.diff(grams >> np.uint64(8), prepend=~(grams[:1] >> np.uint64(8))))
            gain = np.repeat(np.add.reduceat(gains, first), kinds[first])
            kept = gain >= 0.5 * kinds * np.log(total) - TIE
            out.append((k + 1, *(x[kept] for x in (grams, n, total, kinds))))
        longer = level
    out.append((STEM, *longer))
    return pd.concat(
        [pd.DataFrame({"k": k, "gram": g.astype(np.int64), "n": n, "total": t, "kinds": d}) for k, g, n, t, d in out]
    )


_ENTRIES = "k int, gram long, n long, total long, kinds long"


def text_states(texts: DataFrame, depth: int, least: float, buckets: int) -> DataFrame:
    """``states`` of the texts' counts; grams are counted where the contexts meet that share their last bytes."""
    if depth <= STEM:
        return states(byte_counts(texts, depth, buckets), depth, least, buckets)
    dealt = _sent_grams(texts, depth, buckets).groupBy("bucket")
    return _joined(dealt.applyInPandas(lambda _, g: _entries(*_summed(g, depth), depth, least), _ENTRIES), least)


def _joined(entries: DataFrame, least: float) -> DataFrame:
    long = written_lean(entries, "lm-long")
    stems = long.where(F.col("k") == STEM).select(F.col("gram").alias("code"), "n")
    return states(stems, STEM, least).union(long.where(F.col("k") > STEM))


def states(counts: DataFrame, depth: int, least: float = LEAST, buckets: int = 1) -> DataFrame:
    """(k, gram, n, total, kinds): all next bytes of the retained contexts of k bytes; gram is context and next byte."""
    if depth > STEM:

        def entries(_: tuple, group: pd.DataFrame) -> pd.DataFrame:
            return _entries(group["code"].to_numpy(np.int64).astype(np.uint64), group["n"].to_numpy(), depth, least)

        tail = F.shiftrightunsigned("code", 8).bitwiseAND(F.lit((1 << 8 * STEM) - 1))
        dealt = counts.withColumn("bucket", F.pmod(F.xxhash64(tail), F.lit(buckets)))
        return _joined(dealt.groupBy("bucket").applyInPandas(entries, _ENTRIES), least)
    level = written_lean(counts.withColumnRenamed("code", "gram"), "lm-grams")
    context = Window.partitionBy("k", "context")  # at most 256 rows each
    levels = []
    for k in range(depth, -1, -1):
        if k < depth:
            level = level.groupBy(F.col("gram").bitwiseAND(F.lit((1 << 8 * (k + 1)) - 1)).alias("gram"))
            level = level.agg(F.sum("n").alias("n"))
        keyed = level.select(F.lit(k).alias("k"), F.shiftrightunsigned("gram", 8).alias("context"), "gram", "n")
        seen = keyed.withColumn("total", F.sum("n").over(context)).withColumn("kinds", F.count("*").over(context))
        # The root (k = 0) always stays; rare contexts go before any pair of contexts is compared.
        levels.append(seen.where(F.col("total") >= least) if k else seen)
    own = written_lean(functools.reduce(DataFrame.unionByName, levels), "lm-frequent")
    # mask of the last k bytes, so that (k - 1, gram & mask) is the same next byte one context byte shorter
    mask = F.expr("shiftleft(1L, 8 * k) - 1")
    keyed = own.withColumn("up_k", F.col("k") - 1).withColumn("up_gram", F.col("gram").bitwiseAND(mask))
    share = F.col("n") / F.col("total")
    shorter = own.select(F.col("k").alias("up_k"), F.col("gram").alias("up_gram"), share.alias("up_share"))
    compared = keyed.where("k > 0").join(shorter, ["up_k", "up_gram"])
    gain = F.sum(F.col("n") * F.log(share / F.col("up_share"))).over(context)
    kept = compared.withColumn("gain", gain).where(F.col("gain") >= 0.5 * F.col("kinds") * F.log(F.col("total")) - TIE)
    columns = ["k", "gram", "n", "total", "kinds"]
    return own.where("k = 0").select(columns).union(kept.select(columns))


class SuffixTree:
    """Log10 probabilities of next bytes by state; a context's top byte is its length."""

    def __init__(self, table: pd.DataFrame, depth: int) -> None:
        self.depth = depth
        k = table["k"].to_numpy(np.uint64)
        gram = table["gram"].to_numpy(np.int64).astype(np.uint64)
        n = table["n"].to_numpy(float)
        self.contexts, of = np.unique((gram >> np.uint64(8)) | (k << _DEPTH_SHIFT), return_inverse=True)
        self.grams = (of.astype(np.uint64) << np.uint64(8)) | (gram & np.uint64(255))
        self.kinds = np.bincount(of, minlength=len(self.contexts)).astype(float)
        self.tops = np.bincount(of, weights=n, minlength=len(self.contexts)) + self.kinds
        self.n = n

    def ready(self) -> SuffixTree:
        if not hasattr(self, "_gram_at"):
            self._gram_at, self._context_at = Lookup(self.grams), Lookup(self.contexts)
        return self

    def _places(self, codes: np.ndarray) -> np.ndarray:
        chance = np.full(len(codes), 1 / 256)  # without any training place
        for k in range(self.depth + 1):
            tag = np.uint64(k) << _DEPTH_SHIFT
            context = self._context_at(((codes & low_bytes(k + 1)) >> np.uint64(8)) | tag)
            state = np.flatnonzero(context >= 0)
            context = context[state]
            at = self._gram_at((context.astype(np.uint64) << np.uint64(8)) | (codes[state] & np.uint64(255)))
            n = np.zeros(len(state))
            n[at >= 0] = self.n[at[at >= 0]]
            chance[state] = (n + self.kinds[context] * chance[state]) / self.tops[context]
        return np.log10(chance)


def _places(raw: list[bytes], depth: int) -> np.ndarray:
    """The codes of all places of the streams, in order."""
    return np.concatenate([codes for codes, _, _ in segments(raw, depth)])


def _by_token(raw: list[bytes], logs: np.ndarray) -> np.ndarray:
    """Sums of every token of the streams, in order: its bytes and its closing space, or the end."""
    buffer = np.frombuffer(b"".join(raw), dtype=np.uint8)
    closing = np.flatnonzero((buffer == 0x20) | (buffer == END))
    return np.add.reduceat(logs, np.concatenate([[0], closing[:-1] + 1]))


def _place_keys(raw: list[bytes], depth: int) -> np.ndarray:
    """The keys of all places of the streams, in order."""
    return np.concatenate([_keys(codes, TAIL) for codes, _, _ in segments(raw, depth, PIECE)])


def _word_hashes(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens (words, then the end) of the streams, and the number of tokens of each."""
    hasher, hashes, tokens = SpanHasher(), [], []
    for lo, hi in slices([len(x) for x in raw], 1 << 20):
        buffer = np.frombuffer(b"".join(raw[lo:hi]), dtype=np.uint8)
        closing = np.flatnonzero((buffer == 0x20) | (buffer == END))
        words = hasher(buffer, np.append(0, closing[:-1] + 1), closing) | np.uint64(1)  # never the end's hash
        last = buffer[closing] == END
        words[last] = _END_WORD
        hashes.append(words)
        tokens.append(np.diff(np.flatnonzero(last), prepend=-1))
    return np.concatenate(hashes), np.concatenate(tokens)


def _batched(df: DataFrame, id_col: str, text_col: str, folds: int, fold: int) -> tuple[DataFrame, int]:
    rows = df.select(
        F.col(id_col).alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        (F.pmod(text_id(F.col(id_col)), F.lit(folds)) == fold).alias("held_out"),
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    batches = max(1, -(-size // BATCH_BYTES))
    lot = F.xxhash64(F.col("doc_id").cast("string"), F.length("text"))
    return rows.withColumn("batch", F.pmod(lot, F.lit(batches)).cast("int")), batches


def word_counts(rows: DataFrame, batches: int) -> DataFrame:
    """(batch, bucket, counts, vocabulary, tokens, singles): corpus counts of the words of each batch, packed.

    ``counts`` holds, for the sorted distinct hashes of a batch that fall in a bucket, their counts over all training
    rows. Vocabulary, tokens and singles (words seen once) are the bucket's own, repeated on each of its rows.
    """

    buckets = max(1, -(-batches // WORD_BATCHES))

    def distinct(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        hashes, tokens = _word_hashes([_stream(t) for t in group["text"]])
        trains = np.repeat(~group["held_out"].to_numpy(bool), tokens)
        seen, at = _ranked(hashes)
        n = np.bincount(at, weights=trains, minlength=len(seen)).astype(np.int64)
        out = [(key[0], b, seen[lo:hi].tobytes(), n[lo:hi].tobytes()) for b, lo, hi in _shares(seen, buckets)]
        return pd.DataFrame(out, columns=["batch", "bucket", "hashes", "counts"])

    def summed(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        hashes = [np.frombuffer(x, dtype=np.uint64) for x in group["hashes"]]
        counts = np.concatenate([np.frombuffer(x, dtype=np.int64) for x in group["counts"]])
        seen, at = _ranked(np.concatenate(hashes))
        total = np.bincount(at, weights=counts, minlength=len(seen)).astype(np.int64)
        cuts = np.cumsum([len(x) for x in hashes])[:-1]
        return pd.DataFrame(
            {
                "batch": group["batch"],
                "bucket": key[0],
                "counts": [_packed(x.view(np.uint64)) for x in np.split(total[at], cuts)],
                "vocabulary": int((total > 0).sum()),
                "tokens": int(total.sum()),
                "singles": int((total == 1).sum()),
            }
        )

    sent = rows.groupBy("batch").applyInPandas(distinct, "batch int, bucket int, hashes binary, counts binary")
    return sent.groupBy("bucket").applyInPandas(
        summed, "batch int, bucket int, counts binary, vocabulary long, tokens long, singles long"
    )


def short_states(table: DataFrame):
    """The entries of contexts of fewer than ``TAIL`` bytes, for all tasks."""
    return table.sparkSession.sparkContext.broadcast(table.where(F.col("k") < TAIL).select("k", "gram", "n").toPandas())


def place_logs(rows: DataFrame, batches: int, table: DataFrame, low, buckets: int, depth: int) -> DataFrame:
    """(batch, bucket, logs): log10 probabilities of the distinct places of each batch that fall in a bucket, by key."""
    long = table.where(F.col("k") >= TAIL).select("k", "gram", "n")
    span = 4 * buckets  # batches answered together, so that a bucket's share of their places is bounded
    tail = F.shiftrightunsigned("gram", 8).bitwiseAND(F.lit((1 << 8 * TAIL) - 1))
    spread = (tail * F.lit(_SPREAD)).bitwiseAND(F.lit((1 << 8 * TAIL) - 1))
    own = F.shiftright(spread * F.lit(buckets), 8 * TAIL).cast("int")
    spans = F.explode(F.sequence(F.lit(0), F.lit((batches - 1) // span)))
    dealt = long.withColumn("bucket", own).withColumn("part", spans)

    def distinct(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        seen, _ = _distinct(_place_keys([_stream(t) for t in group["text"]], depth))
        out = [(key[0], b, key[0] // span, _packed(seen[lo:hi])) for b, lo, hi in _shares(seen, buckets)]
        return pd.DataFrame(out, columns=["batch", "bucket", "part", "codes"])

    def answered(_: tuple, asked: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        logs = []
        if len(asked):
            tree = SuffixTree(pd.concat([low.value, entries[["k", "gram", "n"]]]), depth).ready()
            # Most places are asked for by many batches and looked up once.
            keys = [_unpacked(x) for x in asked["codes"]]
            seen, _ = _distinct(np.concatenate(keys))
            found = tree._places(_codes(seen, TAIL)).astype(np.float32)
            logs = [found[np.searchsorted(seen, x)].tobytes() for x in keys]
        return pd.DataFrame({"batch": asked["batch"], "bucket": asked["bucket"], "logs": logs})

    asked = rows.groupBy("batch").applyInPandas(distinct, "batch int, bucket int, part int, codes binary")
    both = asked.groupBy("bucket", "part").cogroup(dealt.groupBy("bucket", "part"))
    return both.applyInPandas(answered, "batch int, bucket int, logs binary")


def score(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    folds: int = 7,
    fold: int = 2,
    depth: int = DEPTH,
    least: float = LEAST,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and text_score of every row.

    Rows whose crc32 modulo ``folds`` is ``fold`` are held out; all others train both models.
    """
    if not 0 < depth <= 7:
        raise ValueError("depth must be 1 to 7: a code holds a context and its next byte in 64 bits")
    rows, batches = _batched(df, id_col, text_col, folds, fold)
    trained = rows.where(~F.col("held_out"))
    table = written_lean(text_states(trained, depth, least, batches), "lm-states")
    buckets = max(1, -(-table.count() // BUCKET_ENTRIES))
    low = short_states(table)

    counts = written_lean(word_counts(rows, batches), "lm-words")
    each = counts.groupBy("bucket").agg(*[F.max(c).alias(c) for c in ("vocabulary", "tokens", "singles")])
    row = each.agg(F.sum("vocabulary"), F.sum("tokens"), F.sum("singles")).first()
    vocabulary, tokens, singles = (x or 0 for x in row)
    novel = min(0.5, max(singles, 1) / (tokens + 1))

    def judged(_: tuple, docs: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        raw = [_stream(t) for t in docs["text"]]
        hashes, lengths = _word_hashes(raw)
        _, at = _ranked(hashes)
        places, order, ranks = _sorted(_place_keys(raw, depth))
        known = known.sort_values("bucket")
        mine = known["counts"].notna()
        # Buckets are ranges of the sorted hashes and places.
        c = np.concatenate([_unpacked(x).view(np.int64) for x in known["counts"][mine]])
        chances = np.concatenate([np.frombuffer(x, dtype=np.float32) for x in known["logs"][~mine]]).astype(float)
        assert len(c) == at.max() + 1 and len(chances) == len(places)
        logs = np.log10((c + 1) / (tokens + vocabulary + 1))[at]
        first = np.cumsum(lengths) - lengths
        spots = np.empty(len(order))
        spots[order] = chances[ranks]
        spelled = _by_token(raw, spots)
        if tokens:
            classed = np.where((c > 0)[at], spelled + np.log10(1 - novel), np.log10(novel))
        else:
            classed = np.zeros(len(at))  # all is unknown, and surely so
        return pd.DataFrame(
            {
                "doc_id": docs["doc_id"],
                "held_out": docs["held_out"],
                "n_tokens": lengths,
                "n_known": np.add.reduceat((c > 0)[at].astype(np.int64), first),
                "train_tokens": tokens,
                "base_score": np.add.reduceat(logs, first),
                "score": np.add.reduceat(classed, first),
                "text_score": np.add.reduceat(spelled, first),
            }
        )

    kind = df.schema[id_col].dataType.simpleString()
    schema = (
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long,"
        " base_score double, score double, text_score double"
    )
    nothing = F.lit(None).cast("binary")
    scored = []
    for lot in range(min(ROUNDS, batches)):
        mine = F.pmod(F.col("batch"), F.lit(ROUNDS)) == lot
        some = rows.where(mine)
        logs = place_logs(some, batches, table, low, buckets, depth)
        answers = counts.where(mine).select("batch", "bucket", "counts", nothing.alias("logs")).union(
            logs.select("batch", "bucket", nothing, "logs")
        )
        both = some.groupBy("batch").cogroup(answers.groupBy("batch"))
        scored.append(written_lean(both.applyInPandas(judged, schema), "lm-scores"))
    return functools.reduce(DataFrame.union, scored)
