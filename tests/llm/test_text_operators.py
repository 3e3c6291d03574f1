"""Text operators against brute force, on small literal tables with nulls, ties, repeats, long and empty texts."""

from __future__ import annotations

import collections
import itertools
import math
import random
import re
import time
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillgrid.llm import (
    extraction,
    language_id,
    lm_scoring,
    mixing,
    near_duplicates,
    quality,
    sentencepiece_codec,
    sharding,
    top_k,
    url_filter,
)
from tillgrid.llm.common import written_lean

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, size string, shard int"
_WORD = re.compile(r"[^\x20\x09-\x0d]+")


def _words(text):
    return _WORD.findall(text or "")


def _lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("aeioubcdlmnrst") for _ in range(rng.randint(2, 7))) for _ in range(400)]

    def text(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    base = [text(n) for n in (12, 40, 80, 80, 150, 300, 35, 60)]
    out = list(base)
    for t in base[1:6]:
        w = t.split()
        w[len(w) // 2] = "changed"
        out += [t, " ".join(w), t.upper(), "\n".join(t.split())]
    star = base[2].split()
    for k in range(12):  # a chain of near copies, each one word from the last
        star = [*star]
        star[6 * k] = f"step{k}"
        out.append(" ".join(star))
    out += [None, "", " \t\n", "one", "one two", "one two", "*** ### $$$ 123 456 789 000 111 222 333 444"]
    out += ["go " * 200, "same line here\n" * 30, "Straße été ñandú 日本語 " * 20, base[4] + " " + "x" * 50_000]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    langs, sources = ["en", "fr", None], ["b", "a", None, "ä", "c"]
    rows = [(i, t, langs[i % 3], sources[i % 5], 0, "clash", "clash", 1) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, "a row without an id has its words all the same here", "en", "a", 0, "", "", 2)]
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def _components(rows, width, percent):
    def shingles(t):
        w = _words(_lower(t))
        if not w:
            return set()
        return {tuple(w)} if len(w) < width else {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}

    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    label = {i: i for i, _ in sets}
    links = [
        (a, b)
        for (a, s), (b, t) in itertools.combinations(sets, 2)
        if s and t and 100 * len(s & t) >= percent * len(s | t)
    ]
    for _ in sets:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    return label, {i: len(s) for i, s in sets}


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates_equal_brute_force(docs, width, percent):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    label, sizes = _components(rows, width, percent)
    got = near_duplicates.near_duplicates(docs, width=width, percent=percent).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.component_id, r.n_shingles, r.kept) == (label[r.doc_id], sizes[r.doc_id], label[r.doc_id] == r.doc_id)


def test_near_duplicate_buckets_with_several_components(spark):
    # One word apart in a long text each, so all share buckets; two halves that are not linked to the smallest id.
    rng = random.Random(1)
    base = [f"w{rng.randint(0, 9999)}" for _ in range(60)]
    rows = []
    for i in range(60):
        w = list(base)
        for k in range(i % 12):
            w[(i * 7 + k * 5) % 60] = f"n{i}_{k}"
        rows.append((i, " ".join(w)))
    label, _ = _components(rows, 3, 85)
    got = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=3, percent=85)
    assert {r.doc_id: r.component_id for r in got.collect()} == label


def test_rows_of_one_id_join_their_groups(spark):
    one, two, lone = ("alpha beta gamma delta", "red green blue white", "north east south west")
    rows = [(5, one), (5, two), (3, one), (4, two), (7, lone), (5, None), (8, None)]
    got = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(3, 3), (4, 3), (5, 3), (7, 7), (8, 8)}
    assert len(got) == len(rows) and sorted(r.doc_id for r in got if r.kept) == [3, 7, 8]


def test_one_of_each_group_stays(docs):
    kept = near_duplicates.keep_one_each(docs)
    assert kept.columns == docs.columns
    label, _ = _components([(r.doc_id, r.text) for r in docs.collect()], 5, 80)
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({v for v in label.values()}) and ids.count(None) == 1


def test_sequential_bounds_rise_and_spare_the_threshold():
    fewest = near_duplicates.fewest_matches(85)
    assert fewest == sorted(fewest) and fewest[-1] < 0.85 * near_duplicates.HASHES
    bands, rows = near_duplicates.bands_for(80)
    assert (1 - 0.8**rows) ** bands <= near_duplicates.MISS


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    vectors = [list(map(float, v)) for v in rng.normal(size=(120, 8))]
    rows = [(i, v, "clash") for i, v in enumerate(vectors)]
    rows += [(200 + i, vectors[0], "tie") for i in range(5)]
    rows += [(300, None, ""), (301, [], ""), (302, [1.0, None] * 4, ""), (303, [float("nan")] * 8, ""), (304, [float("inf")] * 8, "")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string").repartition(3)
    got = collections.defaultdict(list)
    for r in top_k.top_k(df, F.col("vec_id") % 20 == 0, k=7, pivots=4).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    ints = {i: [math.floor(64 * x) for x in v] for i, v, _ in rows[:125]}
    for q in (i for i in ints if i % 20 == 0):
        scored = sorted((-sum(a * b for a, b in zip(ints[q], v, strict=True)), i) for i, v in ints.items() if i != q)[:7]
        assert got[q] == [(n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    assert set(got) == {i for i in ints if i % 20 == 0}
    assert top_k.top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_pivot_bounds_hold():
    rng = np.random.default_rng(3)
    v = rng.integers(-300, 300, size=(200, 16))
    pivots = v[:5].astype(float)
    block = top_k.Block(v, pivots)
    for q in range(20):
        assert (top_k.upper_bounds(q, block, block) >= v @ v[q]).all()


def test_mix_meets_targets(docs):
    got = mixing.mix(docs).collect()
    rows = docs.collect()
    assert len(got) == len(rows)
    size = collections.Counter()
    for r in rows:
        size[r.source] += len(_words(r.text))
    names = sorted((s for s in size if s is not None)) + [None]
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    target = {s: 0.0 for s in names}
    free, left = {s for s in names if size[s]}, float(sum(size.values()))
    while free:
        rate = left / sum(weight[s] for s in free)
        over = {s for s in free if rate * weight[s] > 3 * size[s]}
        if not over:
            target |= {s: rate * weight[s] for s in free}
            break
        target |= {s: 3.0 * size[s] for s in over}
        left -= sum(3 * size[s] for s in over)
        free -= over
    taken = collections.Counter()
    for r in got:
        assert r.source_size == size[r.source] and r.target == pytest.approx(target[r.source])
        assert r.taken % max(r["size"], 1) == 0 and r.taken <= 3 * r["size"]
        taken[r.source] += r.taken
    for s in names:
        assert abs(taken[s] - target[s]) <= 12
    again = sorted(map(str, mixing.mix(docs.repartition(5)).collect()))
    assert again == sorted(map(str, got))
    copies = mixing.taken_copies(docs, mixing.mix(docs).where("doc_id is not null and doc_id <> 3"))
    assert copies.columns == docs.columns
    want = sum(r.taken // r["size"] for r in got if r["size"] and r.doc_id not in (None, 3))
    assert copies.count() == want


@pytest.mark.parametrize("seed", range(6))
def test_fitted_lengths_are_as_good_as_any(seed):
    rng = random.Random(seed)
    lengths = np.array(sorted(rng.sample(range(1, 40), 5)))
    counts = np.array([rng.randint(1, 4) for _ in lengths])
    budget = rng.randint(0, int((lengths * counts).sum()) + 5)
    got = mixing.fit_lengths(lengths, counts, budget)
    sums = {0}
    for length, n in zip(lengths, counts, strict=True):
        sums = {s + k * int(length) for s in sums for k in range(n + 1)}
    assert (got >= 0).all() and (got <= counts).all()
    assert int((got * lengths).sum()) == max(s for s in sums if s <= budget)


def test_fitted_lengths_beyond_the_table():
    lengths, counts = np.arange(1, 200), np.full(199, 50)
    for budget in (1000, 12_345, 200_001, 900_000):
        got = mixing.fit_lengths(lengths, counts, budget, table=512)
        assert int((got * lengths).sum()) == budget and (got <= counts).all()


def test_fitted_lengths_of_documents_longer_than_the_table():
    got = mixing.fit_lengths(np.array([150_000]), np.array([10]), 200_000)
    assert got.tolist() == [1]
    got = mixing.fit_lengths(np.array([90_000, 150_000, 170_001]), np.array([4, 4, 4]), 410_001)
    assert int((got * [90_000, 150_000, 170_001]).sum()) == 410_001


def test_long_texts_are_shuffled_once_as_texts(spark):
    df = spark.createDataFrame([(1, "a long text of many words " * 40), (2, "short")], "doc_id long, text string")
    encoded = sentencepiece_codec.encode(df, chunk=100)
    # Chunks do not meet their states as texts: only ids, the ends of chunks and states are left to be put together.
    assert "Join" not in encoded._jdf.queryExecution().optimizedPlan().toString()
    assert {r.doc_id: r.decoded for r in sentencepiece_codec.decode(encoded).collect()} == {r.doc_id: r.text for r in df.collect()}


def test_neighbouring_runs_of_ids_decode_alike(spark):
    with open(sentencepiece_codec.default_model(), "rb") as f:
        pieces = sentencepiece_codec.Pieces(f.read())
    texts = ["", "one two", " \u2603 \U0001f600", "", "x"]
    ids = [np.frombuffer(pieces.encode(pieces.normal(t)), np.int32) for t in texts]
    ends = np.cumsum([0] + [len(i) for i in ids])
    assert pieces.decoded(np.concatenate(ids), ends) == texts


def test_sentencepiece_equals_the_library(spark, docs, texts):
    import sentencepiece

    model = sentencepiece_codec.default_model()
    library = sentencepiece.SentencePieceProcessor(model_file=model)
    rows = docs.select("doc_id", "text", "kept")
    for chunk in (64, 1 << 14):  # with 64, most texts take the scan
        encoded = sentencepiece_codec.encode(rows, chunk=chunk)
        got = collections.defaultdict(list)
        for r in sentencepiece_codec.decode(encoded).collect():
            got[r.doc_id].append((r.ids, r.decoded))
        for i, text in enumerate(texts):
            for ids, decoded in got[i]:
                assert ids == library.encode(text or ""), (chunk, i)
                assert decoded == (text or "")
        assert len(got[3]) == 3 and sum(map(len, got.values())) == docs.count()


def test_scan_over_three_levels_and_without_spaces(spark, monkeypatch):
    import sentencepiece

    monkeypatch.setattr(sentencepiece_codec, "FAN", 4)
    rng = random.Random(9)
    rows = [(1, "".join(rng.choice("abcdeth") for _ in range(2500))), (2, " " * 700 + "a" + " " * 700), (3, "日本語é\n" * 300)]
    library = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.default_model())
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.ids for r in sentencepiece_codec.encode(df, chunk=40).collect()}
    assert got == {i: library.encode(t) for i, t in rows}


def _best_score(pieces, text):
    """Score of the best unigram path, by a table over all places."""
    best = [0.0] + [-math.inf] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - pieces.longest), end):
            piece = text[start:end]
            if piece in pieces.ids or len(piece) == 1:
                best[end] = max(best[end], best[start] + pieces.scores.get(piece, pieces.unknown_score))
    return best[-1]


def test_unigram_paths_have_the_best_score(spark):
    """The (max, +) scan with real values: scores as of a unigram model, over chunks of any size."""
    with open(sentencepiece_codec.default_model(), "rb") as f:
        pieces = sentencepiece_codec.Pieces(f.read(), 1)
    score = {i: pieces.scores[p] for p, i in pieces.ids.items()}
    rng = random.Random(2)
    texts = ["".join(rng.choice("the andi ngo") for _ in range(n)) for n in (1, 30, 400, 900)] + ["information retrieval " * 30]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for chunk in (40, 101, 1 << 14):
        for r in sentencepiece_codec.encode(df, chunk=chunk, kind=1).collect():
            want = _best_score(pieces, pieces.normal(texts[r.doc_id]))
            assert math.isclose(sum(score[i] for i in r.ids), want, abs_tol=1e-6), (chunk, r.doc_id)
            assert pieces.decode(np.asarray(r.ids)) == texts[r.doc_id]


def test_remembered_answers_are_bounded_and_change_nothing(monkeypatch):
    recent = sentencepiece_codec.Recent(3)
    for k in range(10):
        assert recent[k] is None and recent.keep(k, -k) == -k
        assert recent[k] == -k and len(recent) + len(recent.old) <= 6
    assert recent[8] == -8
    with open(sentencepiece_codec.default_model(), "rb") as f:
        model = f.read()
    monkeypatch.setattr(sentencepiece_codec, "WORDS", 2)
    monkeypatch.setattr(sentencepiece_codec, "PAIRS", 2)
    small = sentencepiece_codec.Pieces(model)
    monkeypatch.undo()
    text = small.normal("the same words come again and the same words come again")
    assert small.encode(text) == sentencepiece_codec.Pieces(model).encode(text)


def test_model_file_is_a_setting(spark, tmp_path):
    path = tmp_path / "named.model"
    with open(sentencepiece_codec.default_model(), "rb") as f:
        path.write_bytes(f.read())
    spark.conf.set(sentencepiece_codec.MODEL_KEY, str(path))
    try:
        assert sentencepiece_codec.default_model(spark) == str(path)
    finally:
        spark.conf.unset(sentencepiece_codec.MODEL_KEY)


def _brute_quality(text):
    text = text or ""
    w = _words(text)
    windows = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    inside = {i + k for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if _words(x)]
    return (len(w), len("".join(w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(inside))


def test_quality_equals_brute_force(docs):
    rows = quality.apply_policy(quality.ledger(docs))
    want = collections.defaultdict(set)
    for r in docs.collect():
        want[r.doc_id].add(_brute_quality(r.text))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = rows.collect()
    assert len(got) == docs.count()
    for r in got:
        measured = tuple(r[c] for c in base)
        assert measured in want[r.doc_id]
        failed = measured[0] < 10 or 100 * measured[4] > 20 * measured[0]
        assert (r.failed & quality.BASE_MASK != 0) == failed and not (failed and r.kept)
    assert sorted(map(str, quality.keep_clean(docs).select("doc_id").collect())) == sorted(
        f"Row(doc_id={r.doc_id})" for r in got if r.kept
    )
    assert quality.keep_clean(docs).columns == docs.columns


def test_policies_and_ablations_follow_the_ledger(docs):
    ledger = quality.ledger(docs).cache()
    bits = [r.failed for r in ledger.collect()]
    for version, mask in quality.POLICIES.items():
        kept = quality.apply_policy(ledger, version).where("kept").count()
        assert kept == sum(b & mask == 0 for b in bits)
        for r in quality.ablations(ledger, version).collect():
            bit = 1 << quality.RULE_NAMES.index(r["rule"])
            assert r.n_failed == sum(b & mask & bit != 0 for b in bits)
            assert r.n_failed_alone == sum(b & mask == bit for b in bits)
            assert r.n_kept_without == sum(b & mask & ~bit == 0 for b in bits)


def test_language_of_held_out_rows(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = language_id.identify(df).join(df.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == df.count()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
    held = [r for r in got if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.95


def test_a_language_with_long_texts_only_is_learned(spark):
    rng = random.Random(6)
    vocabulary = {k: ["".join(rng.choice(a) for _ in range(rng.randint(3, 8))) for _ in range(500)]
                  for k, a in (("xx", "aeioubcdf"), ("yy", "ghjklmnopqy"))}

    def text(lang, n):
        return " ".join(rng.choice(vocabulary[lang]) for _ in range(n))

    rows = [(k, text("xx", 50), "xx") for k in range(60)] + [(100 + k, text("yy", 7000), "yy") for k in range(12)]
    assert all(len(t) > language_id.SAMPLE_BYTES for _, t, lang in rows if lang == "yy")
    rows += [(200 + k, text("yy", 30), None) for k in range(20)] + [(300 + k, text("xx", 30), None) for k in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in language_id.identify(df).collect()}
    assert all(got[k] == ("xx" if k < 100 or k >= 300 else "yy") for k in got)


def test_texts_in_no_learned_language_go(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", F.lit(1).alias("score"))
    rng = random.Random(8)
    noise = [(10_000 + k, "".join(rng.choice("qwxzkvj bcdfg") for _ in range(300)), None, 1) for k in range(20)]
    unlabelled = df.withColumn("lang", F.when(F.col("lang") != "de", F.col("lang")))
    kept = language_id.keep_identified(unlabelled.union(spark.createDataFrame(noise, df.schema)))
    assert kept.columns == df.columns
    ids = {r.doc_id for r in kept.collect()}
    assert not ids & {r[0] for r in noise}
    by_lang = {True: [], False: []}
    for r in df.where(F.length("text") >= 200).collect():
        by_lang[r.lang == "de"].append(r.doc_id in ids)
    assert not any(by_lang[True]) and all(by_lang[False])
    everything = {r.doc_id for r in language_id.keep_identified(df).collect()}
    assert everything == {r.doc_id for r in df.where(F.col("text").rlike(r"\p{L}")).collect()}


def test_language_code_lengths_equal_brute_force():
    import pandas as pd

    train = {"x": "abracadabra abra", "y": "bananas and nandus"}
    order = 2
    counts = {k: collections.Counter() for k in train}
    rows = []
    for lang, t in train.items():
        b = b"\xff" * order + t.encode()
        for i in range(order, len(b)):
            for k in range(order + 1):
                counts[lang][b[i - k : i + 1]] += 1
            rows.append((lang, int.from_bytes(b[i - order : i + 1], "big"), 1))
    model = language_id.PPM(pd.DataFrame(rows, columns=["lang", "code", "n"]), order).ready()

    def coded(lang, context, symbol):
        p = 1.0
        for k in range(order, -1, -1):
            ctx = context[order - k :]
            seen = {g[-1:]: n for g, n in counts[lang].items() if len(g) == k + 1 and g[:-1] == ctx}
            if not seen:
                continue
            total = sum(seen.values()) + len(seen)
            if symbol in seen:
                return p * seen[symbol] / total
            p *= len(seen) / total
        return p / 256

    for text in (b"abra nandu", b"zzz", b"a"):
        padded = b"\xff" * order + text
        want = [
            sum(math.log(coded(k, padded[i : i + order], padded[i + order : i + order + 1])) for i in range(len(text)))
            for k in model.langs
        ]
        assert model.code_lengths([text])[0] == pytest.approx(want, rel=1e-5)


def test_language_of_odd_rows(spark, docs, no_docs):
    got = {r.doc_id: r for r in language_id.identify(docs).collect()}
    for r in docs.collect():
        unknown = not any(c.isalpha() for c in r.text or "")
        assert (got[r.doc_id].lang_pred == "und") == unknown
    assert language_id.identify(no_docs).count() == 0
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in language_id.identify(unlabelled).collect()} == {("und", 0.0)}
    assert language_id.keep_identified(docs).columns == docs.columns


def test_lm_baseline_equals_brute_force_and_the_model_beats_it(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(10**6, None), (10**6 + 1, ""), (10**6 + 2, "É Über ABC"), (None, "abc abc")], "doc_id long, text string")
    df = df.union(odd)
    got = {r.doc_id: r for r in lm_scoring.score(df).collect()}
    rows = {r.doc_id: [*_words(_lower(r.text)), None] for r in df.collect()}
    held = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i in rows}
    count = collections.Counter(t for i, ts in rows.items() if not held[i] for t in ts)
    n, v = sum(count.values()), len(count)
    assert set(got) == set(rows)
    for i, tokens in rows.items():
        base = sum(math.log10((count[t] + 1) / (n + v + 1)) for t in tokens)
        r = got[i]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[i], len(tokens), n)
        assert r.n_known == sum(count[t] > 0 for t in tokens) and r.base_score == pytest.approx(base)
        assert r.score < 0
    assert sum(r.score for i, r in got.items() if held[i]) > sum(r.base_score for i, r in got.items() if held[i])


def test_suffix_tree_states_and_sums(spark):
    rows = [("the cat sat on the mat the cat " * 30,)]
    counts = lm_scoring.byte_counts(spark.createDataFrame(rows, "text string"), 3)
    stream = b"\xff" * 3 + b" ".join([*rows[0][0].encode().split(), b"\xfe"])
    want = collections.Counter(stream[i - 3 : i + 1] for i in range(3, len(stream)))
    assert {r.code.to_bytes(4, "big"): r.n for r in counts.collect()} == want
    tree = lm_scoring.SuffixTree(lm_scoring.states(counts, 3, 1e-3).toPandas(), 3).ready()
    assert len(tree.contexts) > 1
    places = 3
    for context in (b"\xff\xff\xff", b"the", b" ca", b"zzz", b"qth"):
        codes = np.array([int.from_bytes(context[-places:] + bytes([s]), "big") for s in range(256)], dtype=np.uint64)
        assert (10 ** tree._places(codes)).sum() == pytest.approx(1.0)


def test_lm_scores_come_from_the_tree(spark):
    rng = random.Random(3)
    trains = [i for i in range(400) if zlib.crc32(str(i).encode()) % 7 != 2]
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 7 == 2]
    words = "the cat sat on a mat and ran off".split()
    rows = [(i, "the cat sat on a mat and ran off " * 20 + f"rare{i}") for i in trains]
    mixed = words * 20
    rng.shuffle(mixed)
    rows += [(held[0], " ".join(words * 20)), (held[1], " ".join(mixed)), (held[2], "matcat"), (held[3], "qxzjvk")]
    got = {r.doc_id: r for r in lm_scoring.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    ordered, shuffled, like, unlike = (got[held[k]] for k in range(4))
    assert ordered.base_score == pytest.approx(shuffled.base_score) and ordered.n_known == ordered.n_tokens
    assert ordered.score > 0.5 * shuffled.score and ordered.score > 0.5 * ordered.base_score  # order is the tree's alone
    assert like.n_known == unlike.n_known == 1 and like.text_score > unlike.text_score + 2


def test_rare_contexts_stay_in_large_corpora(spark):
    grams = {b"aaa": 10**9, b"qya": 10**6, b"qyb": 1, b"xyz": 20}
    counts = spark.createDataFrame([(int.from_bytes(g, "big"), n) for g, n in grams.items()], "code long, n long")
    table = {(r.k, r.gram.to_bytes(r.k + 1, "big")): r.n for r in lm_scoring.states(counts, 2).collect()}
    assert table[2, b"xyz"] == 20 and table[1, b"yb"] == 1 and table[0, b"z"] == 20


def test_states_equal_brute_force(spark, texts):
    raw = [lm_scoring._stream(t) for t in texts]
    grams = collections.Counter()
    for stream in raw:
        padded = b"\xff" * 7 + stream
        grams.update(padded[i - k : i + 1] for i in range(7, len(padded)) for k in range(8))
    after = collections.defaultdict(dict)
    for g, n in grams.items():
        after[g[:-1]][g[-1]] = n
    want = {}
    for context, seen in after.items():
        total, shorter = sum(seen.values()), after[context[1:]]
        if context:
            gain = sum(n * math.log(n / total * sum(shorter.values()) / shorter[b]) for b, n in seen.items())
            if total < lm_scoring.LEAST or gain < 0.5 * len(seen) * math.log(total) - 1e-9:
                continue
        want |= {context + bytes([b]): (n, total, len(seen)) for b, n in seen.items()}
    counts = lm_scoring.byte_counts(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3), 7, 5)
    got = lm_scoring.states(counts, 7, buckets=4).collect()
    assert {(r.gram % 2**64).to_bytes(8, "big")[7 - r.k :]: (r.n, r.total, r.kinds) for r in got} == want


def test_dealt_states_give_the_scores_of_the_whole_tree(spark, docs, monkeypatch):
    monkeypatch.setattr(lm_scoring, "BATCH_BYTES", 2000)
    monkeypatch.setattr(lm_scoring, "BUCKET_ENTRIES", 150)
    rows = docs.select("doc_id", "text").where("doc_id is not null").dropDuplicates(["doc_id"]).cache()
    got = {r.doc_id: r for r in lm_scoring.score(rows).collect()}
    trains = [not got[r.doc_id].held_out for r in rows.collect()]
    trained = spark.createDataFrame([r for r, t in zip(rows.collect(), trains, strict=True) if t], rows.schema)
    table = lm_scoring.states(lm_scoring.byte_counts(trained, lm_scoring.DEPTH), lm_scoring.DEPTH).toPandas()
    tree = lm_scoring.SuffixTree(table, lm_scoring.DEPTH).ready()
    assert len(table) > 10 * 150 and table["k"].max() == lm_scoring.DEPTH
    for r in rows.collect():
        codes = lm_scoring._places([lm_scoring._stream(r.text)], lm_scoring.DEPTH)
        assert got[r.doc_id].text_score == pytest.approx(tree._places(codes).sum(), rel=1e-5)


def _verdict(url):
    text = _lower(url or "")
    hit = lambda t: re.search(rf"(?<![a-z0-9]){re.escape(t)}(?![a-z0-9])", text) is not None
    strict, soft = sum(map(hit, url_filter.STRICT_TERMS)), sum(map(hit, url_filter.SOFT_TERMS))
    return "block" if strict or soft >= url_filter.SOFT_LIMIT else "allow"


def test_url_rules_and_terms(spark):
    cases = {
        "https://a.org/x": "org/",
        "https://A.ORG/casino-win": "org/",
        "https://example.org/es/1": "example.org/es/",
        "http://m.example.org/en/12": "example.org/en/1",
        "http://m.example.org/en/2": "org/",
        "http://x.com/fr/": "com/fr/",
        "http://x.com/de/q": "com/de/",
        "http://xcom/de/q": None,
        "http://org": None,
        "http://casino-win.net/": None,
        "http://casinos.net/free/adults": None,
        "http://a.net/free?x=CASINO": None,
        "http://a.net/free/free": None,
        "x.org/": None,
        "": None,
        None: None,
    }
    rows = [(i, u, "clash") for i, u in enumerate(cases)]
    got = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, rule string")).collect()
    allowed = {"org/": "allow", "com/fr/": "allow"}
    for r in got:
        url = rows[r.page_id][1]
        assert r["rule"] == cases[url]
        assert r.verdict == (allowed.get(cases[url], "block") if cases[url] else _verdict(url)), url
    by = {rows[r.page_id][1]: r for r in got}
    assert by["https://A.ORG/casino-win"].host == "a.org" and by["x.org/"].host == by["x.org/"].path == ""
    assert by["http://m.example.org/en/12"].path == "/en/12"


PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a='</p><p>no</p>';</script></head><body>"
    "<header><p>Site, name.</p></header><nav><ul><li><a href=/>menu</a></ul></nav><div class='cookie-notice'>Accept, all.</div>"
    "{body}<aside><p>Side, text. More.</p></aside><div id=comments><p>Reader, says. Things!</p></div>"
    "<form><p>Sign, up.</p></form><footer>Foot, er.</footer></body></html>"
)


@pytest.mark.parametrize(
    ("body", "want"),
    [
        ("<article><h1>Head</h1><p>One &amp; two,\n three.<p>Short<br>line</article>", "Head\nOne & two, three.\nShort line"),
        ("<main><p><b>Bold.<br><p>Next &eacute;&#33;</main>", "Bold.\nNext é!"),
        (
            "<div class=story><p>A long first paragraph, with marks. And more text in it.</p><p>Tiny</p></div>"
            "<div class=links><a href=x>one</a> <a href=y>two</a></div>",
            "A long first paragraph, with marks. And more text in it.\nTiny",
        ),
        ("<article><p>In<span class=ad>AD</span> out.</p><div class=share>Share</div></article>", "In out."),
    ],
)
def test_main_text(body, want):
    assert extraction.main_text(PAGE.replace("{body}", body)) == want


def test_ratios_decide_inside_and_outside_landmarks():
    story = "".join(f"<p>Paragraph {k} of the story, with marks. And more text in it, too.</p>" for k in range(5))
    lines = [f"Paragraph {k} of the story, with marks. And more text in it, too." for k in range(5)]
    cards = "<article><h3><a href=x>One</a></h3></article>" * 4
    tags = "<ul>" + "<li>tag</li>" * 12 + "</ul>"
    assert extraction.main_text(f"<body><div>{story}</div>{cards}</body>") == "\n".join(lines)
    assert extraction.main_text(f"<body><article>{story}{tags}</article></body>") == "\n".join(lines)


@pytest.mark.parametrize(
    "attrs",
    [
        "style='overflow:hidden'",
        "data-id=related title='class=ad hidden'",
        "class='layout has-sidebar'",
        "class=no-comments",
        "id=post-header",
        "class='share-price form-guide'",
        "class=widget",
        "id='menu'",
    ],
)
@pytest.mark.parametrize("inside", ["<article>{}</article>", "<section>{}</section>"])
def test_containers_of_the_main_text_stay(attrs, inside):
    story = "<p>A long first paragraph, with marks. And more text in it.</p><p>Second one, of much the same length. Also here.</p>"
    want = "A long first paragraph, with marks. And more text in it.\nSecond one, of much the same length. Also here."
    assert extraction.main_text(PAGE.replace("{body}", f"<div {attrs}>{inside.format(story)}</div>")) == want


def test_named_noise_beside_the_main_text_goes():
    story = "<p>A long first paragraph, with marks. And more text in it.</p>"
    long = "<p>Reader, says. Things! And many more, of greater length than the text.</p>" * 9
    for attrs in ("class='x comments'", "id=comment-list", "class=ad-300", "hidden", "aria-hidden=true", "role='dialog'"):
        body = f"<article>{story}<div {attrs}>{long}</div></article><div {attrs}><article>{long}</article></div>"
        assert extraction.main_text(PAGE.replace("{body}", body)) == "A long first paragraph, with marks. And more text in it."
    asp = f"<form action=x><main>{story}</main><div class=menu><p>Men, us.</p></div></form>"
    assert extraction.main_text(f"<body>{asp}</body>") == "A long first paragraph, with marks. And more text in it."


def test_ratios_alone_give_the_texts_of_the_driver(spark, sf_dir):
    for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        bare = re.sub(r"(</?)(article|main)\b", r"\1div", r.html)
        assert bare != r.html and extraction.main_text(bare) == extraction.main_text(r.html)


def test_pages_of_the_driver_hold_their_documents(spark, sf_dir):
    pages = extraction.extract(spark.read.parquet(f"{sf_dir}/pages.parquet")).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    known = {" ".join(r.text.split()) for r in docs if r.text}
    hits = sum(" ".join(r.text.split("\n")[1:]) in known or " ".join(r.text.split("\n")) in known for r in pages)
    assert hits == len(pages) and all(r.n_chars == len(r.text) for r in pages)


def test_odd_pages(spark):
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (3, "u", "<p", "x"), (4, "u", "plain  text", "x"), (4, "u", "plain  text", "x")]
    rows += [(5, "u", "<div>" * 3000 + "deep", "x"), (6, "u", "<p a='" * 20_000, "x"), (None, "u", "<p>x</p>", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(extraction.extract(df).collect(), key=str)
    assert [r.text for r in got if r.page_id == 4] == ["plain text"] * 2
    assert {r.page_id: r.text for r in got}[5] == "deep" and {r.page_id: r.n_chars for r in got}[1] == 0


def _jump(key, n):
    b, j, key = -1, 0, key % 2**64
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_shards_equal_brute_force(spark, docs):
    big = spark.createDataFrame([(i * 7919 - 10**6, f"text {i}") for i in range(3000)] + [(2**63 - 1, None)], "doc_id long, text string")
    for df in (docs.select("doc_id", "text", "shard"), big):
        got = sharding.shard_rows(df, lanes=8).collect()
        want = collections.Counter(
            (r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in df.collect()
        )
        assert collections.Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
        slots = collections.defaultdict(list)
        for r in got:
            key = -1 if r.doc_id is None else r.doc_id
            assert (r.law, r.shard, r.grown_shard) == ("key", _jump(key, 40), _jump(key, 41))
            slots[r.shard].append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_empty_tables(spark, no_docs):
    assert near_duplicates.near_duplicates(no_docs).count() == 0
    assert near_duplicates.keep_one_each(no_docs).count() == 0
    assert mixing.mix(no_docs).count() == 0
    assert sentencepiece_codec.encode(no_docs).count() == 0
    assert quality.ledger(no_docs).count() == 0 and quality.ablations(quality.ledger(no_docs)).count() == 0
    assert lm_scoring.score(no_docs).count() == 0
    assert sharding.shard_rows(no_docs).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert url_filter.judge(pages).count() == 0 and extraction.extract(pages).count() == 0


@pytest.mark.parametrize("last", [3, 4])
def test_place_keys_give_back_their_codes_and_sort_by_bucket(last):
    codes = np.random.default_rng(3).integers(0, 2**64, size=5000, dtype=np.uint64)
    keys = lm_scoring._keys(codes, last)
    assert (lm_scoring._codes(keys, last) == codes).all()
    keys = np.sort(keys)
    shares = list(lm_scoring._shares(keys, 7))
    assert [lo for _, lo, _ in shares] == [0, *(hi for _, _, hi in shares[:-1])] and shares[-1][2] == len(keys)
    for bucket, lo, hi in shares:
        assert set(((keys[lo:hi] >> np.uint64(40)) * np.uint64(7) >> np.uint64(24)).tolist()) == {bucket}


def test_scores_leave_no_exchange_to_be_done(spark):
    df = spark.createDataFrame([(i, f"word {i} and word {i % 5}") for i in range(30)], "doc_id long, text string")
    scored = lm_scoring.score(df)
    # The places and answers of all runs were exchanged one run after another.
    assert "Exchange" not in scored._jdf.queryExecution().executedPlan().toString()
    assert scored.count() == 30


def test_shuffle_files_behind_a_written_table_go(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()

    def files() -> set[str]:
        return {str(f) for d in folders for f in Path(d).rglob("shuffle_*.data")}

    before = files()
    made = written_lean(spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count(), "test-lean")
    written_lean(spark.range(1), "test-lean")  # the last table's plan may still be held
    until = time.time() + 30
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before
    assert made.count() == 10
