"""Prefix trie of conversations: every distinct run of first turns with its members, children, leaves and savings.

Method: *ternary search trees over dictionary-encoded turn ids, one per range shard*.

1. A turn becomes a code of 16 bytes: 12 of the MD5 of (role, text) and 4 of the text's length, so texts travel in no
   shuffle. A conversation is the codes of its turns in one binary value; equal conversations are combined before the sort.
2. The distinct sequences are range-partitioned in the order of their codes; each task streams its sorted range in lots of
   ``LOT_TURNS`` turns. A lot numbers its codes by a dictionary and inserts its sequences, the median first, into a ternary
   search tree, whose depth over one turn's children is then logarithmic.
3. One pass from the last node made back to the first (children come after parents; nothing recurses) sums members, leaves
   and savings into the parents. Every lot knows the sequences just before and after it, so it counts a node as new, and a
   sequence as a leaf, only where that is so in the whole table: sums over lots are right without corrections.
4. Only nodes on the path of a lot's first or last sequence can have members in another lot. These boundary nodes are
   merged by their prefix; all others are final as they leave the lot.
5. Ids of the conversations that end at a node are sorted over range partitions, joined to pieces of text there, and hashed
   piece by piece, so a node where a third of all conversations end gathers text in order, never its rows in memory.

Defined cases: rows without conv_id belong to no conversation and are left out; turns of equal number stand by role, then
text; null role or text is the empty text; repeated rows are turns of their own; an empty table has no nodes, not even a root;
other columns are not looked at. A conversation's codes (16 bytes a turn) are held by one task; prefixes are known by 128-bit
hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillgrid.llm.common import parts, text_id, written
from tillgrid.operators.sizing import broadcast_if_small

CODE = 16
LOT_TURNS = 1 << 16
#: Bytes of decimal ids joined to one piece of text.
PIECE_BYTES = 1 << 16

ROOT_KEY = b"\0" * CODE
_NODES = (
    "depth long, key binary, parent binary, conv_id long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, gross long, net long, boundary boolean, ends boolean"
)


def _code(role: Column, text: Column) -> Column:
    size = F.octet_length(text)
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    return F.concat(F.left(digest, F.lit(24)), F.lpad(F.hex(size.cast("long")), 8, "0"))


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, seq): the codes of every conversation's turns, by turn (null first), role and text."""
    empty = F.lit("")
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        "conv_id", "turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text")
    )
    # Role and text travel only for turns whose number does not order them.
    tied = rows.groupBy("conv_id", "turn").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    tied = broadcast_if_small(written(tied.select(F.col("conv_id").alias("_c"), F.col("turn").alias("_t")), "trie-ties"))
    same = (F.col("conv_id") == F.col("_c")) & F.col("turn").eqNullSafe(F.col("_t"))
    is_tied = F.col("_c").isNotNull()
    turns = rows.join(tied, same, "left").select(
        "conv_id",
        F.struct(
            "turn",
            F.when(is_tied, F.col("role")).alias("role"),
            F.when(is_tied, F.col("text")).alias("text"),
            _code(F.col("role"), F.col("text")).alias("code"),
        ).alias("t"),
    )
    joined = F.array_join(F.transform(F.sort_array("ts"), lambda t: t["code"]), "")
    return turns.groupBy("conv_id").agg(F.collect_list("t").alias("ts")).select("conv_id", F.unhex(joined).alias("seq"))


def rebuilt(seqs: DataFrame, family: int = 5, heads: int = 9) -> DataFrame:
    """(conv_id, seq): the first h turns of conversation c - c % ``family``, then the own turns after the first h.

    h is the unsigned crc32 of the decimal id modulo ``heads``; a base that is absent gives no turns.
    """
    h = (text_id(F.col("conv_id")) % heads).cast("int")
    most = F.substring("seq", 1, CODE * (heads - 1))
    base = seqs.where(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("base"), most.alias("head"))
    own = seqs.withColumn("base", F.col("conv_id") - F.col("conv_id") % family)
    none = F.lit(b"")
    head = F.coalesce(F.substring(F.col("head"), F.lit(1), h * CODE), none)
    rest = F.substring(F.col("seq"), h * CODE + 1, F.length("seq"))
    return own.join(base, "base", "left").select("conv_id", F.concat(head, rest).alias("seq"))


def prefix_key(seq: bytes) -> bytes:
    """The 128-bit key of a whole sequence, chained turn by turn."""
    key = ROOT_KEY
    for at in range(0, len(seq), CODE):
        key = xxhash.xxh3_128_digest(key + seq[at : at + CODE])
    return key


class TernaryTree:
    """A ternary search tree over numbered turns; node 0 is the textless root and every node stands for one prefix."""

    def __init__(self) -> None:
        self.turn, self.below, self.above, self.child, self.parent = [-1], [0], [0], [0], [0]

    def insert(self, path: list[int]) -> list[int]:
        """Nodes of all prefixes of ``path``, root first; missing ones are made."""
        turn, below, above, child = self.turn, self.below, self.above, self.child
        nodes, at = [0], 0
        for t in path:
            link, slot, node = child, at, child[at]
            while node and turn[node] != t:
                link, slot = (below, node) if t < turn[node] else (above, node)
                node = link[slot]
            if not node:
                node = link[slot] = len(turn)
                turn.append(t)
                below.append(0)
                above.append(0)
                child.append(0)
                self.parent.append(at)
            at = node
            nodes.append(node)
        return nodes


def median_order(n: int) -> Iterator[int]:
    """0 ... n - 1, the middle of every range before its halves."""
    todo = [(0, n)]
    while todo:
        lo, hi = todo.pop()
        if lo < hi:
            mid = (lo + hi) // 2
            yield mid
            todo += [(mid + 1, hi), (lo, mid)]


def _shared_turns(a: bytes | None, b: bytes) -> int:
    if a is None:
        return 0
    n = min(len(a), len(b)) // CODE
    return next((k for k in range(n) if a[k * CODE : k * CODE + CODE] != b[k * CODE : k * CODE + CODE]), n)


def lot_nodes(lot: list[tuple[bytes, int, int]], before: bytes | None, after: bytes | None) -> list[tuple]:
    """Nodes of a lot of sorted distinct (sequence, members, smallest member), as in ``_NODES``.

    ``before`` and ``after`` are the neighbours of the lot in the order of all sequences (None: there is none).
    """
    split = [[s[k : k + CODE] for k in range(0, len(s), CODE)] for s, _, _ in lot]
    codes = sorted({c for turns in split for c in turns})
    number = {c: k for k, c in enumerate(codes)}
    tree = TernaryTree()
    paths: list[list[int]] = [[]] * len(lot)
    for k in median_order(len(lot)):
        paths[k] = tree.insert([number[c] for c in split[k]])
    size = len(tree.turn)
    members, first, leaves, children = [0] * size, [None] * size, [0] * size, [0] * size
    gross, net, ends = [0] * size, [0] * size, [False] * size
    new = [True] * size
    for node in paths[0][: _shared_turns(before, lot[0][0]) + 1]:
        new[node] = before is None
    for k, (seq, n, conv_id) in enumerate(lot):
        node = paths[k][-1]
        ends[node] = True
        members[node], first[node] = n, conv_id
        following = lot[k + 1][0] if k + 1 < len(lot) else after
        leaves[node] = int(following is None or not following.startswith(seq))
    depth, keys = [0] * size, [ROOT_KEY] * size
    for node in range(1, size):
        up = tree.parent[node]
        depth[node] = depth[up] + 1
        keys[node] = xxhash.xxh3_128_digest(keys[up] + codes[tree.turn[node]])
    for node in range(size - 1, 0, -1):
        up = tree.parent[node]
        length = int.from_bytes(codes[tree.turn[node]][-4:], "big")
        gross[node] += members[node] * length
        members[up] += members[node]
        leaves[up] += leaves[node]
        gross[up] += gross[node]
        if new[node]:
            net[node] += length
            children[up] += 1
        net[up] += net[node]
        if first[up] is None or first[node] < first[up]:
            first[up] = first[node]
    edge = {0, *paths[0], *paths[-1]}
    rows = []
    for node in range(size):
        up = tree.parent[node]
        known = first[up] if node and up not in edge else None
        rows.append(
            (depth[node], keys[node], keys[up] if node else None, first[node], known, members[node], children[node],
             leaves[node], gross[node], net[node], node in edge, ends[node])
        )
    return rows


def _lots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (range, seq, n, conv_id) → nodes. Rows with n = 0 are a range's neighbours, there for comparison only."""
    fields = _NODES.replace(",", "").split()
    names = fields[::2]
    types = [{"long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}[t] for t in fields[1::2]]
    lot: list[tuple[bytes, int, int]] = []
    state = {"range": None, "before": None, "turns": 0}

    def close(after: bytes | None) -> Iterator[pa.RecordBatch]:
        if lot:
            columns = zip(*lot_nodes(lot, state["before"], after))
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types)], names=names)
            state["before"] = lot[-1][0]
            lot.clear()
        state["turns"] = 0

    for batch in parts(batches, 4096):
        for part, seq, n, conv_id in zip(*(c.to_pylist() for c in batch.columns)):
            if part != state["range"]:
                yield from close(None)
                state.update(range=part, before=None)
            if n == 0:
                yield from close(seq)
                state["before"] = seq
                continue
            if state["turns"] >= LOT_TURNS:
                yield from close(seq)
            lot.append((seq, n, conv_id))
            state["turns"] += len(seq) // CODE + 1
    yield from close(None)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, conv_id) → (key, first id, ids joined by commas), in pieces of ``PIECE_BYTES``."""
    key, ids, size = None, [], 0
    out: list[tuple[bytes, int, str]] = []
    for batch in parts(batches, 1 << 14):
        for k, conv_id in zip(*(c.to_pylist() for c in batch.columns)):
            if ids and (k != key or size >= PIECE_BYTES):
                out.append((key, ids[0], ",".join(map(str, ids))))
                ids, size = [], 0
            key = k
            ids.append(conv_id)
            size += 8
        if out:
            yield _piece_batch(out)
            out = []
    if ids:
        yield _piece_batch([(key, ids[0], ",".join(map(str, ids)))])


def _piece_batch(rows: list[tuple[bytes, int, str]]) -> pa.RecordBatch:
    keys, firsts, texts = zip(*rows)
    arrays = [pa.array(keys, type=pa.binary()), pa.array(firsts, type=pa.int64()), pa.array(texts, type=pa.string())]
    return pa.RecordBatch.from_arrays(arrays, names=["key", "first", "ids"])


def _hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by (key, first id) → (key, SHA-256 of the pieces joined by commas)."""

    def out(key: bytes, digest) -> pa.RecordBatch:
        arrays = [pa.array([key], type=pa.binary()), pa.array([digest.hexdigest()], type=pa.string())]
        return pa.RecordBatch.from_arrays(arrays, names=["end_key", "ends_sha256"])

    key = digest = None
    done: list[pa.RecordBatch] = []
    for batch in parts(batches, 4096):
        for k, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if k == key:
                digest.update(b"," + ids.encode())
                continue
            if digest is not None:
                done.append(out(key, digest))
            key, digest = k, hashlib.sha256(ids.encode())
        if done:
            yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
            done = []
    if digest is not None:
        yield out(key, digest)


def _end_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in parts(batches, 4096):
        keys = [prefix_key(seq) for seq in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(keys, type=pa.binary()), batch.column(0)], names=["key", "conv_id"])


def end_hashes(seqs: DataFrame, tasks: int) -> DataFrame:
    """(end_key, ends_sha256): per sequence that some conversation ends with, the hash of those conversations' ids."""
    ends = seqs.select("conv_id", "seq").mapInArrow(_end_keys, "key binary, conv_id long")
    pieces = (
        ends.repartitionByRange(tasks, "key", "conv_id")
        .sortWithinPartitions("key", "conv_id")
        .mapInArrow(_pieces, "key binary, first long, ids string")
    )
    dealt = pieces.repartition(tasks, "key").sortWithinPartitions("key", "first")
    return dealt.mapInArrow(_hash_pieces, "end_key binary, ends_sha256 string")


def trie(seqs: DataFrame) -> DataFrame:
    """One row per distinct prefix of the sequences (conv_id, seq); ``key`` is its 128-bit key, ``parent`` its parent's."""
    tasks = int(seqs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = seqs.groupBy("seq").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"))
    ranged = distinct.repartitionByRange(tasks, "seq").withColumn("range", F.spark_partition_id())
    ranged = written(ranged.select("range", "seq", "n", "conv_id"), "trie-ranges")
    # One row per range partition: the sequences next to it, sorted before and after its own.
    limits = ranged.groupBy("range").agg(F.min("seq").alias("lo"), F.max("seq").alias("hi"))
    order = Window.orderBy("range")
    beside = limits.select("range", F.array(F.lag("hi").over(order), F.lead("lo").over(order)).alias("both"))
    beside = beside.select("range", F.explode("both").alias("seq")).where(F.col("seq").isNotNull()).select(
        "range", "seq", F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("conv_id")
    )
    shards = ranged.unionByName(beside).repartitionByRange(tasks, "range").sortWithinPartitions("range", "seq")
    nodes = written(shards.mapInArrow(_lots, _NODES), "trie-nodes")

    inner = nodes.where(~F.col("boundary")).drop("boundary")
    merged = nodes.where("boundary").groupBy("depth", "key", "parent").agg(
        F.min("conv_id").alias("conv_id"),
        F.first("parent_conv_id").alias("parent_conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "gross", "net")],
        F.max("ends").alias("ends"),
    )
    merged = written(merged, "trie-boundary")
    parents = broadcast_if_small(merged.select(F.col("key").alias("_key"), F.col("conv_id").alias("_conv")))
    open_nodes = inner.where(F.col("parent_conv_id").isNull()).unionByName(merged)
    found = open_nodes.join(parents, F.col("parent") == F.col("_key"), "left")
    found = found.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_conv")).drop("_key", "_conv")
    every = inner.where(F.col("parent_conv_id").isNotNull()).unionByName(found)
    hashes = end_hashes(seqs, tasks)
    at_end = every.where("ends").join(hashes, F.col("key") == F.col("end_key"), "left").drop("end_key")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    whole = at_end.unionByName(every.where("NOT ends").withColumn("ends_sha256", nothing))
    return whole.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        (F.col("gross") - F.col("net")).alias("saved_tokens"),
        "ends_sha256",
        "key",
        "parent",
    )


def conversation_trie(conversations: DataFrame, family: int = 5, heads: int = 9) -> DataFrame:
    """The trie of the rebuilt conversations."""
    own = written(sequences(conversations), "trie-turns")
    return trie(written(rebuilt(own, family, heads), "trie-sequences"))
