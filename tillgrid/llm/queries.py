"""The registered queries of this subpackage and their DuckDB SQL (given where SQL expresses the whole result)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillgrid.llm import (
    conversation_trie,
    extraction,
    language_id,
    lm_scoring,
    mixing,
    near_duplicates,
    quality,
    sentencepiece_codec,
    sharding,
    spelling,
    substrings,
    top_k,
    url_filter,
)
from tillgrid.llm.common import read_table


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(read_table(spark, sf_dir, "documents"), width=3, percent=85)


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source")


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, and whether they decode to the text (its U+2581 read as spaces)."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    decoded = sentencepiece_codec.decode(sentencepiece_codec.encode(docs))
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.length("decoded").cast("long").alias("decoded_chars"),
        F.crc32("decoded").alias("decoded_crc32"),
    )


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.apply_policy(quality.ledger(read_table(spark, sf_dir, "documents")))
    base_failed = F.col("failed").bitwiseAND(F.lit(quality.BASE_MASK).cast("long")) != 0
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed.alias("base_failed"),
        "kept",
        "failed",
    )


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(read_table(spark, sf_dir, "documents"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(read_table(spark, sf_dir, "documents"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read_table(spark, sf_dir, "pages"))


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(read_table(spark, sf_dir, "pages"))


def op10_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(read_table(spark, sf_dir, "documents"), shards=40)


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substrings.remove_repeats(read_table(spark, sf_dir, "documents"), width=35)
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variant_groups(read_table(spark, sf_dir, "documents"), min_chars=5, min_count=3)


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = conversation_trie.conversation_trie(read_table(spark, sf_dir, "conversations"), family=5, heads=9)
    return nodes.drop("key", "parent")


QUERIES = {
    f.__name__: f
    for f in (
        op1_near_duplicates,
        op2_exact_top_k,
        op3_source_mixing,
        op4_sentencepiece,
        op5_quality_rules,
        op6_language_id,
        op7_lm_scoring,
        op8_url_filter,
        op9_main_text,
        op10_jump_shards,
        op11_substring_dedup,
        op12_spelling_variants,
        op13_conversation_trie,
    )
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x20\x09-\x0D]+"

_OP1 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}') AS ws FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE
    WHEN len(ws) = 0 THEN []::VARCHAR[]
    WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' ')) END) AS sh
  FROM w
), e AS (SELECT doc_id, unnest(sh) AS h FROM s),
p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM e a JOIN e b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT p.x, p.y FROM p JOIN s sx ON sx.doc_id = p.x JOIN s sy ON sy.doc_id = p.y
  WHERE 100 * p.c >= 85 * (len(sx.sh) + len(sy.sh) - p.c)
), reach(v, r) AS (
  SELECT doc_id, doc_id FROM s
  UNION
  SELECT links.x, reach.r FROM reach JOIN links ON links.y = reach.v
), low AS (SELECT v, min(r) AS component_id FROM reach GROUP BY v)
SELECT s.doc_id, len(s.sh)::BIGINT AS n_shingles, low.component_id, s.doc_id = low.component_id AS kept
FROM s JOIN low ON low.v = s.doc_id
"""

_OP2 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS a FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_sum(list_transform(range(1, len(q.a) + 1), lambda i: q.a[i] * c.a[i]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

_OP5 = rf"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls,
    row_number() OVER () AS r
  FROM documents
), m AS (SELECT *, array_to_string(ws, '') AS j FROM w),
win AS (
  SELECT r, unnest(range(1, len(ws) - 3)) AS p, unnest(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) AS t
  FROM m WHERE len(ws) >= 5
), again AS (SELECT r, p FROM (SELECT *, count(*) OVER (PARTITION BY r, t) AS c FROM win) WHERE c > 1),
cov AS (SELECT r, count(DISTINCT p + k) AS n FROM again, (SELECT unnest(range(5)) AS k) GROUP BY r),
f AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, length(j)::BIGINT AS word_chars,
    (length(j) - length(regexp_replace(j, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
    len(ls) AS n_lines, length(j) - length(replace(j, '!', '')) AS n_exclaims,
    length(regexp_replace(j, '[^\p{{L}}]', '', 'g')) AS n_letters,
    length(j) - length(regexp_replace(j, '\p{{Lu}}', '', 'g')) AS n_capitals,
    len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) AS n_stutters
  FROM m LEFT JOIN cov USING (r)
), b AS (
  SELECT *, (CASE WHEN n_words < 10 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 100 * n_symbols > 20 * n_words THEN 4 ELSE 0 END
    + CASE WHEN 100 * n_dup_lines > 40 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN 100 * n_capitals > 60 * n_letters THEN 16 ELSE 0 END
    + CASE WHEN 100 * n_exclaims > 30 * n_words THEN 32 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words THEN 64 ELSE 0 END
    + CASE WHEN word_chars > 25 * n_words THEN 128 ELSE 0 END
    + CASE WHEN 100 * n_letters < 50 * word_chars THEN 256 ELSE 0 END
    + CASE WHEN 100 * n_stutters > 30 * n_words THEN 512 ELSE 0 END)::BIGINT AS failed
  FROM f
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed & 3) <> 0 AS base_failed,
  failed = 0 AS kept, failed
FROM b
"""


def _term_sum(terms: tuple[str, ...]) -> str:
    return " + ".join(f"regexp_matches(u, '(^|[^a-z0-9]){t}([^a-z0-9]|$)')::INTEGER" for t in terms)


def _rule_case(column: str) -> str:
    whens = "".join(
        f" WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"
        f" THEN '{getattr(r, column)}'"
        for r in sorted(url_filter.RULES, key=lambda r: -len(r.name))
    )
    return f"CASE{whens} END"


_OP8 = f"""
WITH p AS (
  SELECT page_id, translate(coalesce(url, ''), '{_UPPER}', '{_LOWER}') AS u,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{_UPPER}', '{_LOWER}') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), h AS (
  SELECT *, {_rule_case("name")} AS rule, {_rule_case("verdict")} AS ruled,
    ({_term_sum(url_filter.STRICT_TERMS)})::INTEGER AS n_strict, ({_term_sum(url_filter.SOFT_TERMS)})::INTEGER AS n_soft
  FROM p
)
SELECT page_id, host, path, rule,
  coalesce(ruled, CASE WHEN n_strict > 0 OR n_soft >= {url_filter.SOFT_LIMIT} THEN 'block' ELSE 'allow' END) AS verdict,
  n_strict, n_soft
FROM h
"""

def _crc32(text: str) -> str:
    """SQL for the unsigned crc32 of a text's UTF-8 bytes, bit by bit (3988292384 is the reversed polynomial)."""
    digit = "instr('0123456789ABCDEF', substr({h}, {at}, 1)) - 1"
    hexed = f"hex(encode({text}))"
    high, low = (digit.format(h=hexed, at=at) for at in ("2 * i + 1", "2 * i + 2"))
    steps = f"flatten(list_transform(range(strlen({text})), lambda i: [16 * ({high}) + {low}, 0, 0, 0, 0, 0, 0, 0]))"
    step = "xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1))"
    return f"xor(list_reduce(list_prepend(4294967295, {steps}), lambda a, x: {step}), 4294967295)"


_OP11 = rf"""
WITH w AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws FROM documents
), win AS (
  SELECT r, i, array_to_string(ws[i:i + 34], ' ') AS t FROM (SELECT r, ws, unnest(range(1, len(ws) - 33)) AS i FROM w)
), again AS (SELECT t FROM win GROUP BY t HAVING count(*) > 1),
cov AS (
  SELECT DISTINCT r, i + k AS i FROM (SELECT r, i FROM win SEMI JOIN again USING (t)), (SELECT unnest(range(35)) AS k)
), left_over AS (
  SELECT r, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n
  FROM (SELECT r, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w) ANTI JOIN cov USING (r, i) GROUP BY r
)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN left_over USING (r)
"""

_RUN_CRC = _crc32("x")
_OP12 = f"""
WITH RECURSIVE runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id,
    unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[a-zÀ-ÿ]+')) AS run
  FROM documents
), counted AS (SELECT id || ':' || run AS x, run, count(*) AS c FROM runs GROUP BY ALL),
hashed AS (SELECT run, c, {_RUN_CRC} AS h FROM counted),
spelt AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2)
    ELSE run END AS word, c FROM hashed
), v AS (
  SELECT word, sum(c)::BIGINT AS n FROM spelt WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3
), d AS (
  SELECT word, n, p, left(word, p) || substr(word, p + 2) AS rest
  FROM (SELECT *, unnest(range(length(word))) AS p FROM v)
), near AS (
  SELECT a.word, b.word AS other, b.n FROM d a JOIN d b ON a.rest = b.rest AND a.p = b.p AND a.word <> b.word
  UNION SELECT v.word, d.word, d.n FROM v JOIN d ON d.rest = v.word
  UNION SELECT d.word, v.word, v.n FROM v JOIN d ON d.rest = v.word
), best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, other) AS other, max(n) AS other_n FROM near GROUP BY word
), f AS (
  SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN other_n >= 2 * v.n THEN other END AS form,
    CASE WHEN other_n >= 2 * v.n THEN other_n END AS form_n
  FROM v LEFT JOIN best USING (word)
), chain(word, last_word) AS (
  SELECT word, word FROM f UNION ALL SELECT chain.word, f.form FROM chain JOIN f ON f.word = chain.last_word WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, chain.last_word AS root, f.n, f.n_near, f.form_n
FROM f JOIN chain ON chain.word = f.word JOIN f stop ON stop.word = chain.last_word WHERE stop.form IS NULL
"""

_CONV_CRC = _crc32("x")
_OP13 = f"""
WITH t AS (
  SELECT conv_id, conv_id::VARCHAR AS x,
    list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS ts
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), o AS (SELECT *, ({_CONV_CRC} % 9)::BIGINT AS h FROM t),
s AS (
  SELECT o.conv_id, list_concat(CASE WHEN o.h > 0 THEN coalesce(b.ts[1:o.h], []) ELSE [] END, o.ts[o.h + 1:]) AS ts
  FROM o LEFT JOIN t b ON b.conv_id = o.conv_id - o.conv_id % 5
), p AS (
  SELECT conv_id, depth, len(ts) = depth AS ends, to_json(CASE WHEN depth > 0 THEN ts[1:depth] ELSE [] END)::VARCHAR AS k,
    CASE WHEN depth > 0 THEN to_json(CASE WHEN depth > 1 THEN ts[1:depth - 1] ELSE [] END)::VARCHAR END AS up,
    CASE WHEN depth > 0 THEN strlen(ts[depth].t) ELSE 0 END AS size
  FROM (SELECT conv_id, ts, unnest(range(len(ts) + 1)) AS depth FROM s)
), n AS (
  SELECT k, any_value(up) AS up, any_value(depth) AS depth, any_value(size) AS size, min(conv_id) AS conv_id,
    count(*) AS n_convs, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM p GROUP BY k
), c AS (SELECT up AS k, count(*) AS n_children FROM n WHERE up IS NOT NULL GROUP BY up),
sub AS (SELECT DISTINCT a.k, b.k AS under FROM p a JOIN p b ON a.conv_id = b.conv_id AND b.depth >= a.depth),
total AS (
  SELECT sub.k, count(*) FILTER (WHERE c.k IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.size) AS saved
  FROM sub JOIN n ON n.k = sub.under LEFT JOIN c ON c.k = sub.under GROUP BY sub.k
)
SELECT n.conv_id, n.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0)::BIGINT AS n_children,
  total.n_leaves, total.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM n LEFT JOIN n up ON up.k = n.up LEFT JOIN c ON c.k = n.k JOIN total ON total.k = n.k
"""

ORACLE_SQL = {
    "op1_near_duplicates": _OP1,
    "op2_exact_top_k": _OP2,
    "op5_quality_rules": _OP5,
    "op8_url_filter": _OP8,
    "op11_substring_dedup": _OP11,
    "op12_spelling_variants": _OP12,
    "op13_conversation_trie": _OP13,
}
