"""Spelling variants against a comparison of all pairs, on texts with nulls, ties, repeats and clashing columns."""

from __future__ import annotations

import collections
import itertools
import random
import re
import zlib

import pyarrow as pa
import pytest

from tillgrid.llm import spelling

DOCS = "doc_id long, text string, word string, n int, key string"
_RUN = re.compile("[A-Za-zÀ-ÿ]+")


def _one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def _brute(rows, min_chars, min_count):
    count = collections.Counter()
    for doc_id, text in rows:
        for run in _RUN.findall(text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    n = {w: k for w, k in count.items() if len(w) >= min_chars and k >= min_count}
    near = {w: [] for w in n}
    for a, b in itertools.combinations(n, 2):
        if _one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return out


@pytest.fixture(scope="module")
def table():
    rng = random.Random(7)
    letters = "abcdeéÿÀ"
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(4, 9))) for _ in range(40)]

    def edited(w):
        k, c = rng.randrange(len(w) + 1), rng.choice(letters)
        return rng.choice([w[:k] + c + w[k:], w[: k - 1] + w[k:], w[:k] + c + w[k + 1 :]])

    pool = base * 6 + [edited(w) for w in base * 3] + [edited(edited(w)) for w in base]
    pool += ["aaaaaaaaaa" + x + y for x in "abcde" for y in "abcdeé"] * 2 + ["x" * 3000, "x" * 3001]
    rows = []
    for k in range(300):
        sep = rng.choice([" ", ", ", "\n", "1", "日"])
        words = rng.choices(pool, k=rng.randint(0, 30))
        rows.append((k if k % 11 else None, sep.join(w.upper() if w.isascii() and rng.random() < 0.2 else w for w in words)))
    return [*rows, rows[4], rows[4], (500, None), (501, ""), (502, "1 2 ×÷ Ωmega "), (None, None)]


@pytest.mark.parametrize("hot", [4096, 3])
def test_groups_equal_all_pairs(spark, table, hot, monkeypatch):
    monkeypatch.setattr(spelling.near_words, "__defaults__", (spelling.MIN_CHARS, hot))
    docs = spark.createDataFrame([(d, t, "clash", 1, "k") for d, t in table], DOCS).repartition(3)
    got = spelling.variant_groups(docs, 5, 3)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {tuple(r) for r in got.collect()} == _brute(table, 5, 3)


@pytest.mark.parametrize("letters", ["ab", "abcdeé"])
def test_scan_of_a_sorted_list_finds_all_pairs(letters):
    rng = random.Random(len(letters))
    for _ in range(300):
        words = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(1, 7))) for _ in range(rng.randint(1, 25))})
        want = [(x, y) for x, y in itertools.combinations(range(len(words)), 2) if _one_edit(words[x], words[y])]
        assert sorted(spelling.near_pairs(words)) == want


def test_groups_that_go_on_over_batches():
    rows = [{"key": 1, "part": 2, "m": 5, "n": k, "at": -1, "listed": w} for k, w in enumerate(["haust", "hausu", "hausv"])]
    batches = [pa.RecordBatch.from_pylist([r]) for r in rows]
    got = [r for b in spelling._scan_groups(iter(batches)) for r in b.to_pylist()]
    assert {r["word"]: (r["n_near"], r["form"]) for r in got} == {
        "haust": (2, "hausv"),
        "hausu": (2, "hausv"),
        "hausv": (2, "hausu"),
    }


def test_ties_and_chains(spark):
    texts = ["bbbbb " * 4 + "bbbbc " * 8 + "bbbcc " * 16 + "abbbb " * 8, None]
    docs = spark.createDataFrame([(1, texts[0], "", 0, ""), (2, None, "", 0, "")], DOCS)
    got = {r.word: (r.form, r.root) for r in spelling.variant_groups(docs).collect()}
    brute = {w: (form, root) for w, form, root, *_ in _brute([(1, texts[0]), (2, None)], 5, 3)}
    assert got == brute
    assert brute["bbbbb"] == ("abbbb", "abbbb")


def test_empty_table(spark):
    assert spelling.variant_groups(spark.createDataFrame([], DOCS)).collect() == []
