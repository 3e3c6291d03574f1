"""Substring dedup against a count of all windows, on texts with copies, edits, repeats, nulls and clashing columns."""

from __future__ import annotations

import collections
import random

import pyarrow as pa
import pytest

from tillgrid.llm import substrings
from tillgrid.llm.common import SpanHasher

DOCS = "doc_id long, text string, h string, spans long, kept int"


def _brute(texts, width):
    """(words, kept words) per text: a word goes if it lies in a window that starts anywhere else too."""
    split = [(t or "").encode().split() for t in texts]
    count = collections.Counter(tuple(w[i : i + width]) for w in split for i in range(len(w) - width + 1))
    out = []
    for w in split:
        gone = {j for i in range(len(w) - width + 1) if count[tuple(w[i : i + width])] > 1 for j in range(i, i + width)}
        out.append((len(w), b" ".join(x for j, x in enumerate(w) if j not in gone).decode()))
    return out


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcdeé日") for _ in range(rng.randint(1, 4))) for _ in range(300)]

    def words(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    notice, passage = words(48), words(120)
    out = []
    for k in range(30):  # a notice in every text, each time among other words, so every context of it is another one
        out.append(words(rng.randint(0, 90)) + notice + words(rng.randint(0, 90)))
    for k in range(8):  # pieces of one passage, some with an edit
        i, j = sorted((rng.randint(0, 119), rng.randint(0, 119)))
        piece = passage[i : j + 1]
        if k % 2 and piece:
            piece[len(piece) // 2] = f"edit{k}"
        out.append(words(40) + piece + words(20) + piece)
    out += [out[3], out[3], passage, words(34), words(35), ["go"] * 200, ["a", "b"] * 60, words(5000) + passage]
    texts = [" ".join(w) for w in out]
    return [*texts, texts[5].replace(" ", "\n\t "), texts[6].upper(), None, "", " \n", "one"]


@pytest.mark.parametrize(("width", "hot"), [(35, 512), (35, 3), (12, 4), (5, 512), (1, 512)])
def test_removed_words_equal_brute_force(spark, texts, width, hot):
    rows = [(k if k % 7 else None, t, "clash", 1, 2) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    got = substrings.remove_repeats(docs, width, hot_contexts=hot).collect()
    want = [(k if k % 7 else None, n, kept) for k, (n, kept) in enumerate(_brute(texts, width))]
    assert sorted(((r.doc_id, r.n_words, r.kept) for r in got), key=repr) == sorted(want, key=repr)
    for r in got:
        assert r.n_removed == sum(s.stop - s.start for s in r.removed) == r.n_words - len(r.kept.split())


def test_every_window_lies_in_one_context_whatever_the_pieces(monkeypatch, texts):
    def windows(piece):
        monkeypatch.setattr(substrings, "PIECE_WORDS", piece)
        words = substrings._Words([(t or "").encode() for t in texts], 35)
        h, first, last = substrings.contexts(words, SpanHasher(), 35)
        found = []
        for i, j in zip(first.tolist(), last.tolist()):
            found += [(int(words.owner[t]), int(words.index[t])) for t in range(i, j + 1)]
        return found

    want = [(k, i) for k, t in enumerate(texts) for i in range(len((t or "").split()) - 34)]
    assert windows(1 << 17) == want
    assert sorted(windows(60)) == want


def test_automaton_equals_counts_of_windows():
    rng = random.Random(3)
    for _ in range(300):
        texts = [[rng.choice("ab") for _ in range(rng.randint(0, 12))] for _ in range(rng.randint(1, 5))]
        weights = [rng.randint(1, 2) for _ in texts]
        width = rng.randint(1, 4)
        automaton = substrings.SuffixAutomaton(texts, weights)
        count = collections.Counter()
        for t, m in zip(texts, weights):
            for i in range(len(t) - width + 1):
                count[tuple(t[i : i + width])] += m
        for t in [*texts, [rng.choice("abc") for _ in range(15)]]:
            want = [i for i in range(len(t) - width + 1) if count[tuple(t[i : i + width])] >= 2]
            assert automaton.repeated(t, width) == want


def test_matching_statistics_are_longest_matches():
    reference = "the cat sat on the mat".split()
    automaton = substrings.SuffixAutomaton([reference], [1])
    lengths = [n for _, n in automaton.statistics("a cat sat on the cat".split(), 10)]
    assert lengths == [0, 1, 2, 3, 4, 2]


def test_repeated_rows_give_their_contexts_once():
    batch = pa.RecordBatch.from_pylist(
        [{"k1": 1, "k2": 1, "text": "a b c d", "wanted": [{"place": 1 << 16 | 2, "h": 7, "c": 8, "m": 1, "hot": False}]}] * 2
    )
    rows = [r for b in substrings._cut_contexts(iter([batch]), 2) for r in b.to_pylist()]
    assert [(r["h"], r["at"], r["words"]) for r in rows] == [(7, 1, b"b c d")]


def test_empty_table(spark):
    assert substrings.remove_repeats(spark.createDataFrame([], DOCS)).collect() == []
