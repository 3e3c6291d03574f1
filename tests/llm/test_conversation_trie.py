"""The conversation trie against a plain walk over all prefixes, with nulls, ties, repeats and clashing columns."""

from __future__ import annotations

import collections
import hashlib
import random
import zlib

import pyarrow as pa
import pytest

from tillgrid.llm import conversation_trie as trie

TABLE = "conv_id long, turn long, role string, text string, seq string, range int, key string, n int"


def _rebuilt(rows):
    own = collections.defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def _brute(rows):
    members = collections.defaultdict(list)
    ends = collections.defaultdict(list)
    for c, turns in _rebuilt(rows).items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    out = []
    for p, who in members.items():
        below = [q for q in members if q[: len(p)] == p]
        saved = sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q)
        ids = ",".join(map(str, sorted(ends[p]))) if p in ends else ""
        out.append(
            (min(who), len(p), min(members[p[:-1]]) if p else None, len(who), children[p],
             sum(children[q] == 0 for q in below), saved, hashlib.sha256(ids.encode()).hexdigest())
        )
    return out


@pytest.fixture(scope="module")
def table():
    rng = random.Random(4)
    texts = ["hello", "héllo", "", None, "a longer text " * 20, "x"]
    rows = []
    for c in range(-12, 90):
        for turn in range(rng.randint(0, 12)):
            same = turn < 3 and c % 3
            rows.append((c, turn, "user" if turn % 2 else None, texts[0] if same else rng.choice(texts)))
    copies = [(c, t, "user", f"t{t}") for c in range(200, 260) for t in range(6)]
    odd = [(300, None, "b", "z"), (300, None, "a", "z"), (300, None, None, "z"), (300, 1, "a", None), (None, 1, "a", "lost")]
    odd += [(301, 5, "a", t) for t in ("y", "x", "x")] + [(302, 1, "a", "one turn")]
    odd += [(303, t, "user", f"t{t % 4}") for t in range(400)]
    return rows + copies + odd


def _columns(df):
    return sorted((tuple(r)[:8] for r in df.drop("key", "parent").collect()), key=repr)


@pytest.mark.parametrize("partitions", [1, 8])
def test_trie_equals_walk_over_all_prefixes(spark, table, partitions):
    df = spark.createDataFrame([(*r, "clash", 1, "clash", 2) for r in table], TABLE).repartition(4)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        assert _columns(trie.conversation_trie(df)) == sorted(_brute(table), key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def _whole(distinct, cuts):
    """Nodes of sorted sequences dealt to lots at ``cuts``, merged as the table does."""
    edges = [0, *cuts, len(distinct)]
    out = collections.defaultdict(lambda: [0] * 5)
    for i, j in zip(edges, edges[1:]):
        if i < j:
            lot = [(s, 1, k) for k, s in enumerate(distinct[i:j], i)]
            before, after = distinct[i - 1] if i else None, distinct[j] if j < len(distinct) else None
            for row in trie.lot_nodes(lot, before, after):
                for k, v in enumerate(row[5:10]):
                    out[row[1]][k] += v
    return dict(out)


def test_lots_sum_to_one_tree():
    rng = random.Random(9)
    for _ in range(60):
        code = lambda k: bytes([k]) * 12 + (k + 1).to_bytes(4, "big")
        distinct = sorted({b"".join(code(rng.randrange(3)) for _ in range(rng.randint(0, 6))) for _ in range(25)})
        cuts = sorted(rng.sample(range(1, len(distinct)), min(4, len(distinct) - 1)))
        assert _whole(distinct, cuts) == _whole(distinct, [])


def test_tree_is_balanced_by_the_order_of_insertion():
    assert sorted(trie.median_order(10)) == list(range(10))
    tree = trie.TernaryTree()
    for k in trie.median_order(1023):
        tree.insert([k])
    depth = {0: 0, tree.child[0]: 1}
    for node in range(1, len(tree.turn)):
        for link in (tree.below, tree.above):
            if link[node]:
                depth[link[node]] = depth[node] + 1
    assert max(depth.values()) == 10


def test_pieces_of_ids_hash_as_one_text(spark, monkeypatch):
    monkeypatch.setattr(trie, "PIECE_BYTES", 24)
    rows = [{"key": b"k", "conv_id": c} for c in range(-3, 40)] + [{"key": b"m", "conv_id": 7}]
    batches = [pa.RecordBatch.from_pylist(rows[i : i + 5]) for i in range(0, len(rows), 5)]
    got = {r["end_key"]: r["ends_sha256"] for b in trie._hash_pieces(trie._pieces(iter(batches))) for r in b.to_pylist()}
    text = ",".join(map(str, range(-3, 40)))
    assert got == {b"k": hashlib.sha256(text.encode()).hexdigest(), b"m": hashlib.sha256(b"7").hexdigest()}


def test_empty_table(spark):
    assert trie.conversation_trie(spark.createDataFrame([], TABLE)).collect() == []
