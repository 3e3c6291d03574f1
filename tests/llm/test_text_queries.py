"""Registered text queries against their DuckDB SQL, and the corpus pipeline's stages against what they must keep."""

from __future__ import annotations

import collections
import math
from pathlib import Path

import duckdb
import pytest
import sentencepiece
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from tillgrid.llm import language_id, mixing, near_duplicates, quality, queries, sentencepiece_codec

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{Path(sf_dir, t + '.parquet')}')")
    return con


def _canon(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        return round(v, 6) if isinstance(v, float) and not math.isnan(v) else v

    return sorted((tuple(norm(r[i]) for i in order) for r in data), key=repr)


def test_entry_module_adds_the_text_queries():
    assert set(queries.QUERIES) | {"pipeline"} <= set(contract.queries())
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_its_sql(spark, sf_dir, duck, name):
    df = queries.QUERIES[name](spark, sf_dir)
    rel = duck.sql(queries.ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _canon(df.columns, df.collect()) == _canon(rel.columns, rel.fetchall())


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    """The driver's documents with odd rows: nulls in every column, repeats, a copy, noise; and columns that clash."""
    real = spark.read.parquet(f"{sf_dir}/documents.parquet")
    one = real.where(F.length("text") > 1500).orderBy("doc_id").first()
    odd = [
        (None, one["text"], "en", "s", 1), (900, None, None, None, None), (901, "", "en", None, 0), (902, one["text"], None, "s", 1),
        (903, "qx zv wk jj " * 60, None, "s", 1), (903, "qx zv wk jj " * 60, None, "s", 1),
    ]
    table = real.union(spark.createDataFrame(odd, real.schema))
    return table.select("*", *[F.lit("clash").alias(c) for c in ("size", "taken", "kept", "component_id", "score", "n")]).cache()


@pytest.fixture(scope="module")
def no_docs(docs):
    return docs.limit(0)


def _stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def _ids(df):
    return collections.Counter(r["doc_id"] for r in df.select("doc_id").collect())


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_of_an_empty_table(spark, sf_dir, no_docs, name):
    out = _stage(name)(spark, no_docs, sf_dir)
    assert out.collect() == []
    assert out.columns == (["doc_id", "n_tokens", "ids"] if name == "token_ids" else no_docs.columns)


def test_quality_stage_keeps_what_the_policy_keeps(spark, sf_dir, docs):
    out = _stage("quality_rules")(spark, docs, sf_dir)
    assert out.columns == docs.columns
    judged = quality.apply_policy(quality.ledger(docs)).where("kept")
    assert _ids(out) == _ids(judged)
    assert not _ids(out).keys() & {900, 901, 903}


def test_language_stage_drops_noise_and_keeps_the_rest(spark, sf_dir, docs):
    out = _stage("identified_language")(spark, docs, sf_dir)
    assert out.columns == docs.columns
    found = language_id.predicted(docs, docs, "doc_id", "text", "lang").collect()
    want = collections.Counter(r["doc_id"] for r in found if r["__lang"]["lang_pred"] != "und" and r["__lang"]["excess"] <= 2.25)
    assert _ids(out) == want
    assert not want.keys() & {900, 901, 903} and {None, 902} <= want.keys()


def test_near_duplicate_stage_keeps_one_of_each_class(spark, sf_dir, docs):
    usable = docs.where("text IS NOT NULL AND doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    out = _stage("near_duplicate_groups")(spark, usable, sf_dir)
    assert out.columns == docs.columns
    classes = {r.doc_id: r.component_id for r in near_duplicates.near_duplicates(usable, width=5, percent=80).collect()}
    assert _ids(out) == collections.Counter({c: 1 for c in set(classes.values())})


def test_mix_stage_repeats_documents_as_often_as_taken(spark, sf_dir, docs):
    some = docs.where("doc_id IS NULL OR doc_id <> 903")  # repeated rows share the largest count among them
    out = _stage("source_mix")(spark, some, sf_dir)
    assert out.columns == docs.columns
    words = {r["doc_id"]: r["taken"] for r in mixing.mix(some).collect()}
    taken = collections.Counter()
    for r in out.select("doc_id", F.size(F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")).alias("w")).collect():
        taken[r["doc_id"]] += r["w"]
    assert dict(taken) == {k: v for k, v in words.items() if v}


def test_last_stage_gives_the_ids_of_the_library(spark, sf_dir, docs):
    some = docs.where("doc_id IS NULL OR doc_id % 5 = 0 OR doc_id >= 900")
    library = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.default_model())
    got = collections.Counter((r["doc_id"], r["n_tokens"], tuple(r["ids"])) for r in _stage("token_ids")(spark, some, sf_dir).collect())
    want = collections.Counter()
    for r in some.collect():
        ids = library.encode(r["text"] or "")
        want[r["doc_id"], len(ids), tuple(ids)] += 1
    assert got == want


def test_run_applies_the_stages_in_order(spark, sf_dir):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "identified_language", "near_duplicate_groups", "source_mix", "token_ids",
    ]
    out = corpus_pipeline.run(spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, sf_dir)
    assert out.columns == ["doc_id", "n_tokens", "ids"]
    kept = _ids(docs)
    assert _ids(out).keys() <= kept.keys() and out.count() > 0
