"""URL filter: host and path rules, then a weighted vocabulary counted by an Aho-Corasick automaton.

A url is first judged by the longest host and path rule that fits. Else the vocabulary decides: every distinct term
that stands in the url between boundaries (no letter or digit beside it) counts once; one strict term or
``soft_limit`` distinct soft terms reject the url. The automaton is built once per task from the vocabulary, a
parameter of fixed size, and passes over each url once.

Defined results: a null url, or one without ``://``, has an empty host and path, no rule, and is judged by its text
(null: allowed); repeated rows are judged alike; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``host`` with all its subdomains, paths starting with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: Fixed values of the query's contract.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)

#: One of these rejects.
STRICT_TERMS = (
    "adult-x",
    "cheap-pills",
    "casino-win",
    "free-bets",
    "spam-farm",
    "ads-track",
    "porn",
    "porno",
    "xxx",
    "hentai",
    "escorts",
    "sexcam",
    "sexcams",
    "camgirls",
    "viagra",
    "cialis",
)
#: Several distinct ones of these reject.
SOFT_TERMS = (
    "adult",
    "ads",
    "bets",
    "betting",
    "bonus",
    "casino",
    "cheap",
    "deals",
    "dating",
    "escort",
    "free",
    "gambling",
    "jackpot",
    "loans",
    "nude",
    "pills",
    "poker",
    "replica",
    "sex",
    "sexy",
    "slots",
    "spam",
    "torrent",
    "warez",
    "win",
)
SOFT_LIMIT = 2

_LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), *_LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Iterable[Rule] = RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: len(r.name)):
        at_home = (host == r.host) | host.endswith("." + r.host)
        named = F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))
        found = F.when(at_home & path.startswith(r.path), named).otherwise(found)
    return found


def _plain(c: str) -> bool:
    return c.isascii() and c.isalnum()


def term_hits(df: DataFrame, url_col: str, strict: Iterable[str] = STRICT_TERMS, soft: Iterable[str] = SOFT_TERMS):
    """``df`` with ``n_strict`` and ``n_soft``: distinct terms found between boundaries in the url (null: 0)."""
    kinds = {t: 0 for t in soft} | {t: 1 for t in strict}

    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for term, kind in kinds.items():
            automaton.add_word(term, (term, kind))
        automaton.make_automaton()
        for urls in batches:
            out = []
            for url in urls:
                hits: tuple[set[str], set[str]] = (set(), set())
                if url:
                    text = url.translate(_TO_LOWER)
                    for end, (term, kind) in automaton.iter(text):
                        start = end + 1 - len(term)
                        if (start and _plain(text[start - 1])) or (end + 1 < len(text) and _plain(text[end + 1])):
                            continue
                        hits[kind].add(term)
                out.append((len(hits[1]), len(hits[0])))
            yield pd.DataFrame(out, columns=["n_strict", "n_soft"])

    counted = F.pandas_udf(count, "n_strict int, n_soft int")
    return df.withColumn("_hits", counted(F.col(url_col)))


_TO_LOWER = str.maketrans(*_LOWER)


def judge(df: DataFrame, id_col: str = "page_id", url_col: str = "url", soft_limit: int = SOFT_LIMIT) -> DataFrame:
    """Host, path, rule, hits and verdict of every row."""
    rows = df.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("_url"))
    rows = term_hits(rows, "_url").select(
        "page_id",
        host_of(F.col("_url")).alias("host"),
        path_of(F.col("_url")).alias("path"),
        F.col("_hits.n_strict").alias("n_strict"),
        F.col("_hits.n_soft").alias("n_soft"),
    )
    rejected = (F.col("n_strict") > 0) | (F.col("n_soft") >= soft_limit)
    fits = rows.withColumn("_rule", fitting_rule(F.col("host"), F.col("path")))
    return fits.select(
        "page_id",
        "host",
        "path",
        F.col("_rule.rule").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), F.when(rejected, "block").otherwise("allow")).alias("verdict"),
        "n_strict",
        "n_soft",
    )
