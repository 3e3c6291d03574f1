"""SentencePiece encoding and decoding by a max-plus parallel scan.

An encoding is a best path through the lattice of pieces that match the text. In a unigram model a step is worth its
piece's score. In a BPE model a step from piece t to piece u is worth 0 if merging the text t + u gives back t and u,
else it is forbidden: merges never cross the seam of such a pair, so exactly the encoding's path has no forbidden step,
and at every place at most one path arrives. Both are path problems over (max, +).

A giant text is cut into chunks anywhere. A boundary's states are the pieces that may cover the character before it.
Every chunk gives, by itself, the matrix of best values from the states of its left boundary to those of its right one.
Matrices are combined in groups of FAN, groups of groups, and so on, associatively; then the best state at every
boundary is passed down again, and every chunk is traced back by itself between its two states. Three levels hold the
longest string Spark has. Where no piece can cross a place (before a space, next to a line end), all paths meet there:
the lattice between two such places is a word, and words are encoded once and kept in a bounded table.

The model file is a parameter and read on the driver; models with an identity normaliser and without user-defined
pieces are supported, others are refused.

Defined results: a null or empty text has no ids and decodes to the empty text; U+2581 decodes to a space, as the
library does; repeated rows are encoded alike; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
import math
import operator
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tillgrid.llm.common import parts, written

#: The space's mark inside pieces.
SPACE = "▁"
CHUNK = 1 << 14
FAN = 64
#: Words and pairs of pieces that a worker remembers, at most twice as many (see ``Recent``): some 60 and 70 MB. Half as
#: many words or pairs take 1.2 to 1.7 times the time on texts with 1,000,000 distinct words.
WORDS = 1 << 17
PAIRS = 3 << 16
#: Chunks that a worker holds as Python objects at a time.
SOME = 16
START = (0, "")
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6
_UNIGRAM, _BPE = 1, 2
_LETTER = re.compile("[A-Za-z\u00c0-\u024f]")
State = tuple[int, str]


#: Setting that names the model file.
MODEL_KEY = "tillgrid.sentencepiece.model"


def default_model(spark: SparkSession | None = None) -> str:
    """The model file that the session names, else the public one that the package ``public_tokenizers`` installs."""
    named = spark.conf.get(MODEL_KEY, "") if spark else ""
    if named:
        return named
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Recent(dict):
    """Answers asked for lately, at most twice ``limit``: a full table becomes the old one, and what is asked for again
    moves to the new one. Forgetting changes no result."""

    def __init__(self, limit: int) -> None:
        super().__init__()
        self.limit, self.old = limit, {}

    def keep(self, key, value):
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value

    def __missing__(self, key):
        value = self.old.get(key)
        return value if value is None else self.keep(key, value)


class Pieces:
    """The vocabulary of a model, with steps, words and their encoding."""

    def __init__(self, model: bytes, kind: int | None = None) -> None:
        from sentencepiece import sentencepiece_model_pb2 as proto

        spec = proto.ModelProto()
        spec.ParseFromString(model)
        self.kind = kind or spec.trainer_spec.model_type
        norm = spec.normalizer_spec
        if self.kind not in (_UNIGRAM, _BPE) or norm.precompiled_charsmap or norm.remove_extra_whitespaces:
            raise ValueError("only unigram and BPE models with an identity normaliser are supported")
        if any(p.type == _USER for p in spec.pieces) or spec.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("models with user-defined pieces or trailing spaces are not supported")
        self.prefix = SPACE if norm.add_dummy_prefix else ""
        self.ids = {p.piece: i for i, p in enumerate(spec.pieces) if p.type == _NORMAL}
        self.scores = {p.piece: p.score for p in spec.pieces if p.type == _NORMAL}
        self.unknown = next(i for i, p in enumerate(spec.pieces) if p.type == _UNKNOWN)
        self.unknown_score = min(self.scores.values()) - 10.0
        self.bytes = [None] * 256
        self.raw = [p.piece.replace(SPACE, " ").encode() if p.type == _NORMAL else b"" for p in spec.pieces]
        for i, p in enumerate(spec.pieces):
            if p.type == _BYTE:
                value = int(p.piece[3:5], 16)
                self.bytes[value], self.raw[i] = i, bytes([value])
        self.raw[self.unknown] = " ⁇ ".encode()
        self._raw_array = pa.array(self.raw, pa.large_binary())
        self._raw_sizes = np.fromiter(map(len, self.raw), dtype=np.int64, count=len(self.raw))
        self.longest = max(map(len, self.ids))
        self._by_length = sorted({len(p) for p in self.ids} | {1}, reverse=True)
        self._tails = {p[i:] for p in self.ids for i in range(len(p))}
        self.joins_spaces = any(SPACE in p.lstrip(SPACE) for p in self.ids)
        # Places that no piece crosses, as far as a pattern finds them: before a space, around a line end, and between
        # a letter and a sign that follows no letter in any piece.
        chars = set("".join(self.ids))
        self._lone = "".join(c for c in "\n\t\r" if c not in chars)
        after_letter = {p[i] for p in self.ids for i in range(1, len(p)) if _LETTER.match(p[i - 1])}
        self._signs = "".join(c for c in "!#$%&()*+,-./:;<=>?@[]_{|}~" if c not in after_letter)
        signs = rf"(?!(?<={_LETTER.pattern})[{re.escape(self._signs)}])" if self._signs else ""
        inside = f"(?:{signs}[^{SPACE}{self._lone}])"
        lone = f"[{self._lone}]|" if self._lone else ""
        self._word = re.compile(f"{lone}{SPACE}+{inside}*|[^{SPACE}{self._lone}]{inside}*")
        self.pairs = Recent(PAIRS)
        self.words = Recent(WORDS)

    def normal(self, text: str) -> str:
        return self.prefix + text.replace(" ", SPACE) if text else ""

    def merged(self, text: str) -> list[str]:
        """BPE of a short text: the adjacent pair whose piece scores best is merged first, the leftmost of ties."""
        parts = list(text)
        get, none = self.scores.get, -math.inf
        worth = list(map(get, map(operator.add, parts, text[1:]), itertools.repeat(none)))
        while worth:
            best = max(worth)
            if best == none:
                break
            at = worth.index(best)
            parts[at] = piece = parts[at] + parts.pop(at + 1)
            del worth[at]
            # Only the pairs on either side of the merged piece change.
            if at:
                worth[at - 1] = get(parts[at - 1] + piece, none)
            if at < len(worth):
                worth[at] = get(piece + parts[at + 1], none)
        return parts

    def step(self, last: str, piece: str) -> float | None:
        """What ``piece`` after ``last`` is worth ('' : after a place that no piece crosses); None if forbidden."""
        if self.kind == _UNIGRAM:
            return self.scores.get(piece, self.unknown_score)
        key = (last, piece)
        good = self.pairs[key]
        if good is None:
            good = self.pairs.keep(key, self.merged(last + piece) == ([last, piece] if last else [piece]))
        return 0.0 if good else None

    def paths(self, text: str, start: int, last: str, end: int) -> dict[int, tuple[float, str]]:
        """Best (value, last piece) at each place from ``start`` to ``end`` that a path from ``start`` reaches."""
        best = {start: (0.0, last)}
        ids, tails, exact, get, pairs = self.ids, self._tails, self.kind == _BPE, best.get, self.pairs
        for place in range(start + 1, end + 1):
            matches = [text[place - 1]]
            for first in range(place - 2, start - 1, -1):
                piece = text[first:place]
                if piece not in tails:
                    break  # no piece ends like this
                if piece in ids:
                    matches.append(piece)
            found = None
            while matches:  # long pieces first: in BPE one path arrives at most, and mostly by a long piece
                piece = matches.pop()
                before = get(place - len(piece))
                if before is None:
                    continue
                if exact:
                    good = pairs.get((before[1], piece))
                    if good or (good is None and self.step(before[1], piece) is not None):
                        found = (0.0, piece)
                        break
                else:
                    value = before[0] + self.step(before[1], piece)
                    if found is None or value > found[0]:
                        found = (value, piece)
            if found is not None:
                best[place] = found
        return best

    @staticmethod
    def traced(best: dict[int, tuple[float, str]], start: int, end: int) -> list[str]:
        out = []
        while end > start:
            piece = best[end][1]
            out.append(piece)
            end -= len(piece)
        return out[::-1]

    def pack(self, pieces: list[str]) -> bytes:
        out = list(map(self.ids.get, pieces))
        if None in out:
            spelled = None not in self.bytes
            found = zip(out, pieces)
            out = []
            for i, p in found:
                out += [i] if i is not None else [self.bytes[b] for b in p.encode()] if spelled else [self.unknown]
        return array("i", out).tobytes()

    def word(self, word: str) -> bytes:
        """Packed ids of a text between two places that no piece crosses."""
        kept = self.words[word]
        if kept is None:
            if self.kind == _BPE and len(word) <= 64:
                # The one path without a forbidden step, found by the merges themselves: quicker for a short word.
                best = self.merged(word)
            else:
                best = self.traced(self.paths(word, 0, "", len(word)), 0, len(word))
            kept = self.pack(best)
            if len(word) <= 64:
                self.words.keep(word, kept)
        return kept

    def value(self, text: str) -> float:
        """Value of the best path over a text between two places that no piece crosses."""
        if self.kind == _BPE:
            return 0.0
        return sum(self.paths(w, 0, "", len(w))[len(w)][0] for w in self.split(text))

    def split(self, text: str) -> list[str]:
        return [text] if self.joins_spaces else self._word.findall(text)

    def encode(self, text: str) -> bytes:
        """Packed ids of a whole normal text that is one chunk."""
        kept, word = self.words, self.word
        return b"".join([kept.get(w) or word(w) for w in self.split(text)])

    def decode(self, ids: Sequence[int]) -> str:
        return self.decoded(np.asarray(ids, dtype=np.int32), [0, len(ids)])[0]

    def decoded(self, flat: np.ndarray, ends: Sequence[int]) -> list[str]:
        """The texts of neighbouring runs of ids: run i is ``flat[ends[i] : ends[i + 1]]``."""
        if len(flat) and (flat.min() < 0 or flat.max() >= len(self.raw)):
            raise IndexError("ids beyond the model's pieces")
        stops = np.append(0, np.cumsum(self._raw_sizes[flat]))[np.asarray(ends)].tolist()
        joined = self._raw_array.take(pa.array(flat)).buffers()[2]  # the bytes of all ids, one after the other
        view = memoryview(joined or b"")
        texts = [str(view[a:b], "utf-8", "replace") for a, b in zip(stops, stops[1:])]
        return [t[1:] if t[:1] == " " else t for t in texts] if self.prefix else texts

    # Chunks: ``text`` is the chunk with the characters around it, [start, end) the chunk inside.

    def states(self, text: str, place: int) -> list[State]:
        """Pieces that may cover the character before ``place``, by the characters that they reach beyond it."""
        out = []
        for over in range(0, min(self.longest, len(text) - place + 1)):
            for n in self._by_length:
                if over < n <= place + over and (n == 1 or text[place + over - n : place + over] in self.ids):
                    out.append((over, text[place + over - n : place + over]))
        return out

    def cuts(self, text: str, low: int, high: int) -> tuple[int, int] | None:
        """The first and the last place from ``low`` to ``high`` that no piece crosses."""
        if self.joins_spaces:
            return None

        def is_cut(i: int) -> bool:
            a, b = text[i - 1], text[i]
            if a in self._lone or b in self._lone or (b == SPACE and a != SPACE):
                return True
            return b in self._signs and bool(_LETTER.match(a))

        limit = min(high, len(text) - 1)
        first = next((i for i in range(max(low, 1), limit + 1) if is_cut(i)), None)
        if first is None:
            return None
        return first, next(i for i in range(limit, first - 1, -1) if is_cut(i))

    def _exits(self, text: str, best: dict[int, tuple[float, str]], end: int, final: bool) -> list[tuple[State, float]]:
        out = []
        for over, piece in self.states(text, end):
            before = best.get(end + over - len(piece))
            if before is None or (final and over):
                continue
            worth = self.step(before[1], piece)
            if worth is not None:
                out.append(((over, piece), before[0] + worth))
        return out

    def entries(self, text: str, start: int) -> list[State]:
        """The states that a path can have at the chunk's left boundary, from the characters before it.

        Behind a place that no piece crosses all paths are alike, so only what is reached from there remains.
        """
        cut = self.cuts(text, 1, start - 1) if start > 1 else None
        if cut is None:
            return self.states(text, start)
        return [s for s, _ in self._exits(text, self.paths(text, cut[1], "", start), start, False)]

    def transfer(self, text: str, start: int, end: int, final: bool) -> list[tuple[State, State, float]]:
        """The chunk's matrix: (state before, state after, best value); missing entries are forbidden."""
        entries = self.entries(text, start) if start else [START]
        reach = start + max(o for o, _ in entries)
        # The cut stays before the end: a state names the piece that covers the last character.
        cut = self.cuts(text, reach, end - 1)
        if cut is None:
            return [
                (s, t, v)
                for s in entries
                for t, v in self._exits(text, self.paths(text, start + s[0], s[1], end), end, final)
            ]
        first, last = cut
        into = [(s, self.paths(text, start + s[0], s[1], first).get(first)) for s in entries]
        between = self.value(text[first:last])
        out = self._exits(text, self.paths(text, last, "", end), end, final)
        return [(s, t, a[0] + between + v) for s, a in into if a is not None for t, v in out]

    def inside(self, text: str, start: int, end: int) -> tuple[str, bytes | None, str | None]:
        """The chunk's text before the places that no piece crosses, the packed ids between the first and the last of
        them, and the text after the last: what ``trace`` needs. Without such places, the chunk's text alone."""
        reach = start + (max(o for o, _ in self.entries(text, start)) if start else 0)
        cut = self.cuts(text, reach, end - 1)
        if cut is None:
            return text[start:end], None, None
        first, last = cut
        return text[start:first], self.encode(text[first:last]), text[last:end]

    def trace(self, head: str, inside: bytes | None, tail: str | None, before: State, after: State) -> bytes:
        """Packed ids of the pieces after the one of ``before`` up to that of ``after``, from what ``inside`` gave."""
        at, back = before[0], after[0] - len(after[1])  # where the first piece starts, and the last one, from the end
        if inside is None:
            stop = len(head) + back
            return self.pack([*self.traced(self.paths(head, at, before[1], stop), at, stop), after[1]])
        stop = len(tail) + back
        first = self.traced(self.paths(head, at, before[1], len(head)), at, len(head))
        last = self.traced(self.paths(tail, 0, "", stop), 0, stop)
        return self.pack(first) + inside + self.pack([*last, after[1]])


def combined(left: list[tuple], right: list[tuple]) -> list[tuple]:
    """The (max, +) product of two matrices."""
    by: dict[State, list[tuple[State, float]]] = {}
    for s, t, v in right:
        by.setdefault(s, []).append((t, v))
    best: dict[tuple[State, State], float] = {}
    for s, m, v in left:
        for t, w in by.get(m, ()):
            if best.get((s, t), -np.inf) < v + w:
                best[s, t] = v + w
    return [(s, t, v) for (s, t), v in best.items()]


def best_states(matrices: list[list[tuple]], before: State, after: State) -> list[State]:
    """The states at all boundaries of neighbouring matrices on the best path from ``before`` to ``after``."""
    value, back = {before: 0.0}, []
    for m in matrices:
        nxt: dict[State, float] = {}
        via: dict[State, State] = {}
        for s, t, v in m:
            if s in value and nxt.get(t, -np.inf) < value[s] + v:
                nxt[t], via[t] = value[s] + v, s
        value = nxt
        back.append(via)
    out = [after]
    for via in reversed(back):
        out.append(via[out[-1]])
    return out[::-1]


_STATE = "struct<over:int,piece:string>"
_MATRIX = f"array<struct<s:{_STATE},t:{_STATE},v:double>>"
_STATE_TYPE = pa.struct([("over", pa.int32()), ("piece", pa.string())])
_MATRIX_TYPE = pa.list_(pa.struct([("s", _STATE_TYPE), ("t", _STATE_TYPE), ("v", pa.float64())]))


def _plain(matrix) -> list[tuple]:
    state = lambda x: (int(x["over"]), x["piece"])
    return [(state(e["s"]), state(e["t"]), float(e["v"])) for e in matrix]


def _nested(matrix: list[tuple]) -> list[dict]:
    state = lambda x: {"over": x[0], "piece": x[1]}
    return [{"s": state(s), "t": state(t), "v": v} for s, t, v in matrix]


class _Shared:
    """The model for tasks: parsed once per worker."""

    def __init__(self, spark, model_file: str, kind: int | None) -> None:
        self.model = spark.sparkContext.broadcast(Path(model_file).read_bytes())  # a vocabulary file: a few MB at most
        self.kind = kind

    def pieces(self) -> Pieces:
        key = (id(self.model.value), self.kind)
        if key not in _PARSED:
            _PARSED.clear()
            _PARSED[key] = Pieces(self.model.value, self.kind)
        return _PARSED[key]


_PARSED: dict[tuple, Pieces] = {}


def _shrunk(packed: bytes | None) -> bytes | None:
    """Packed ids as compressed byte planes: most vocabularies leave two of the four empty."""
    return None if packed is None else zlib.compress(np.frombuffer(packed, np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unshrunk(shrunk: bytes | None) -> bytes | None:
    return None if shrunk is None else np.frombuffer(zlib.decompress(shrunk), np.uint8).reshape(4, -1).T.tobytes()


def _groups(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[list[dict]]:
    """Neighbouring rows that agree in ``keys``, across batches."""
    rows = (r for part in parts(batches, FAN) for r in part.to_pylist())
    return (list(group) for _, group in itertools.groupby(rows, key=operator.itemgetter(*keys)))


def _in_batches(rows: Iterable[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for some in itertools.batched(rows, FAN):
        yield pa.RecordBatch.from_pylist(list(some), schema)


def _id_lists(packed: list[bytes]) -> pa.Array:
    ends = np.cumsum([0] + [len(p) // 4 for p in packed])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(packed), np.int32)))


def encode(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    model_file: str | None = None,
    chunk: int = CHUNK,
    kind: int | None = None,
) -> DataFrame:
    """(doc_id, ids) of every row. ``kind`` overrides the model's type (1: unigram, 2: BPE)."""
    spark = df.sparkSession
    shared = _Shared(spark, model_file or default_model(spark), kind)
    rows = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    long = F.length("text") > chunk - 1

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared.pieces()
        for part in parts(batches):
            packed = [pieces.encode(pieces.normal(t)) for t in part["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([part["doc_id"], _id_lists(packed)], ["doc_id", "ids"])

    kind_of_id = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind_of_id}, ids array<int>"
    return rows.where(~long).mapInArrow(whole, schema).union(_scanned(rows.where(long), shared, chunk, kind_of_id))


def _scanned(rows: DataFrame, shared: _Shared, chunk: int, kind_of_id: str) -> DataFrame:
    """The rows' ids by chunks, as told at the top."""
    keyed = rows.withColumn("row", F.monotonically_increasing_id())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared.pieces()
        around = pieces.longest
        names = ["row", "doc_id", "chunk", "first", "last", "final", "text"]
        for part in parts(batches, 1):
            text = pieces.normal(part["text"][0].as_py())
            starts = range(0, len(text), chunk) if len(text) % chunk > around else range(0, len(text) - around, chunk)
            edges = [*starts, len(text)]
            for at in range(0, len(edges) - 1, SOME):
                rows_of = []
                for i in range(at, min(at + SOME, len(edges) - 1)):
                    a, b = edges[i], edges[i + 1]
                    low = max(0, a - around)
                    rows_of.append((i, a - low, b - low, b == len(text), text[low : b + around]))
                place, first, last, final, inside = zip(*rows_of)
                same = pa.array(np.zeros(len(rows_of), np.int64))
                ints = [pa.array(x, pa.int32()) for x in (place, first, last)]
                yield pa.RecordBatch.from_arrays(
                    [part["row"].take(same), part["doc_id"].take(same), *ints, pa.array(final), pa.array(inside)], names
                )

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared.pieces()
        for part in parts(batches, SOME):
            each = list(zip(*(part[c].to_pylist() for c in ("text", "first", "last", "final"))))
            made = pa.array([_nested(pieces.transfer(*r)) for r in each], _MATRIX_TYPE)
            head, inside, tail = zip(*(pieces.inside(*r[:3]) for r in each))
            texts = [pa.array(head, pa.string()), pa.array(map(_shrunk, inside), pa.binary()), pa.array(tail, pa.string())]
            names = ["row", "doc_id", "place", "matrix", "head", "inside", "tail"]
            yield pa.RecordBatch.from_arrays([part["row"], part["doc_id"], part["chunk"], made, *texts], names)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def product(group: list[dict]) -> dict:
            out = _plain(group[0]["matrix"])
            for r in group[1:]:
                out = combined(out, _plain(r["matrix"]))
            return {"row": group[0]["row"], "place": group[0]["up"], "matrix": _nested(out)}

        return _in_batches(map(product, _groups(batches, "row", "up")), matrix_schema)

    def passed_down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[dict]:
            for above, *below in _groups(batches, "row", "up"):
                ends = ((x["over"], x["piece"]) for x in (above["before"], above["after"]))
                states = [{"over": o, "piece": p} for o, p in best_states([_plain(r["matrix"]) for r in below], *ends)]
                for r, before, after in zip(below, states, states[1:]):
                    yield {"row": r["row"], "place": r["place"], "before": before, "after": after}

        return _in_batches(each(), states_schema)

    # Only here texts are shuffled: a chunk's ids between its outermost places that no piece crosses do not depend on
    # its states, so they are found with its matrix, and what is left of its text at both ends is short.
    chunks = keyed.select("row", "doc_id", "text").mapInArrow(
        cut, f"row long, doc_id {kind_of_id}, chunk int, first int, last int, final boolean, text string"
    )
    traces = written(
        chunks.repartition("row", "chunk").mapInArrow(
            matrices,
            f"row long, doc_id {kind_of_id}, place int, matrix {_MATRIX}, head string, inside binary, tail string",
        ),
        "sp-chunks",
    )
    # A fixed number of partitions: the groups hold few bytes, which would be merged into one task, but take time.
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    matrix_schema = pa.schema([("row", pa.int64()), ("place", pa.int32()), ("matrix", _MATRIX_TYPE)])
    states_schema = pa.schema([("row", pa.int64()), ("place", pa.int32()), ("before", _STATE_TYPE), ("after", _STATE_TYPE)])
    none = F.lit(None)
    up = F.floor(F.col("place") / FAN).cast("int").alias("up")

    def dealt(level: DataFrame) -> DataFrame:
        return level.repartition(tasks, "row", "up").sortWithinPartitions("row", "up", "place")

    levels = [traces.select("row", "place", "matrix")]
    count = (traces.agg(F.max("place")).first()[0] or 0) + 1
    while count > 1:
        grouped = dealt(levels[-1].select("row", "place", "matrix", up))
        levels.append(written(grouped.mapInArrow(products, f"row long, place int, matrix {_MATRIX}"), "sp-matrix"))
        count = -(-count // FAN)
    # The top holds one matrix per text, from the start to its last pieces.
    best = F.array_max(F.transform("matrix", lambda e: F.struct(e["v"].alias("v"), e["t"].alias("t"))))["t"]
    start = F.struct(F.lit(0).alias("over"), F.lit("").alias("piece"))
    found = levels[-1].select("row", "place", start.cast(_STATE).alias("before"), best.alias("after"))
    for level in reversed(levels[:-1]):
        below = level.select(
            "row", up, "place", "matrix", none.cast(_STATE).alias("before"), none.cast(_STATE).alias("after")
        )
        # A group's own states come first in it.
        above = found.select(
            "row", F.col("place").alias("up"), F.lit(-1).alias("place"), none.cast(_MATRIX).alias("matrix"), "before", "after"
        )
        grouped = dealt(below.union(above))
        ends = f"row long, place int, before {_STATE}, after {_STATE}"
        found = written(grouped.mapInArrow(passed_down, ends), "sp-states")

    def traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared.pieces()
        for part in parts(batches, 1):
            by_place: dict[int, dict] = {}
            for p in part["parts"][0].as_py():
                by_place.setdefault(p["place"], {}).update({k: v for k, v in p.items() if v is not None})
            packed = []
            for _, p in sorted(by_place.items()):
                before, after = ((x["over"], x["piece"]) for x in (p["before"], p["after"]))
                packed.append(pieces.trace(p["head"], _unshrunk(p.get("inside")), p.get("tail"), before, after))
            yield pa.RecordBatch.from_arrays([part["doc_id"], _id_lists([b"".join(packed)])], ["doc_id", "ids"])

    own = ["place", "head", "inside", "tail", none.cast(_STATE).alias("before"), none.cast(_STATE).alias("after")]
    named = ["place", *(none.cast(t).alias(c) for c, t in (("head", "string"), ("inside", "binary"), ("tail", "string")))]
    # The chunks and their states meet where the text's ids are put together.
    together = traces.select("row", "doc_id", F.struct(*own).alias("part")).union(
        found.select("row", none.cast(kind_of_id).alias("doc_id"), F.struct(*named, "before", "after").alias("part"))
    )
    whole = together.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.collect_list("part").alias("parts"))
    return whole.select("doc_id", "parts").mapInArrow(traced, f"doc_id {kind_of_id}, ids array<int>")


def decode(df: DataFrame, ids_col: str = "ids", model_file: str | None = None, out: str = "decoded") -> DataFrame:
    """``df`` with the text that the ids of ``ids_col`` stand for (null ids: the empty text)."""
    shared = _Shared(df.sparkSession, model_file or default_model(df.sparkSession), None)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared.pieces()
        for part in parts(batches):
            lists = part.column(part.schema.get_field_index(ids_col))
            ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            known = lists.is_valid().to_pylist()
            texts = pieces.decoded(flat[ends[0] : ends[-1]], ends - ends[0])
            decoded = [t if k else "" for t, k in zip(texts, known)]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(decoded, pa.string())], [*part.schema.names, out])

    return df.mapInArrow(texts, StructType([*df.schema.fields, StructField(out, StringType())]))
