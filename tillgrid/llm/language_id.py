"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts of every order up to ``order``. A byte is coded in the longest context that
the language knows; where that context has not seen the byte, it pays the context's escape probability (method C) and
goes one order down, at last to a uniform byte. The statistics are frozen after training, so a text's exact code length
in each language is a sum over its bytes. The shortest code wins; the score is its posterior probability.

Training uses a bounded sample: about ``sample_rows`` labelled rows in all, the same number for each language, and of a
text above ``sample_bytes`` one piece of a quarter as many characters, from a place that the row's hash names. So the model's
size is bounded whatever the input (see ``SAMPLE_ROWS``), and a language with long texts only is learned too. Prediction
covers every row and whole texts.

The posterior only says which learned language fits best; ``excess`` says how well it fits: the text's code length over
what the language's own training text takes for as many bytes. ``keep_identified`` rejects by it.

Defined results: a null text, or one without a letter, is ``und`` with score 0; without any labelled training row every
row is ``und``; equal code lengths go to the smaller language name; repeated rows are predicted alike; an
empty table gives an empty result. Null ids count as the empty id for the folds; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillgrid.llm.common import slices, text_id
from tillgrid.llm.ngrams import Lookup, low_bytes, segments

ORDER = 4
#: Bound of the training sample: rows over all languages, and bytes above which only a piece of a row's text is taken.
SAMPLE_ROWS = 12_000
SAMPLE_BYTES = 32_768
UNKNOWN = "und"
#: A text is taken for none of the learned languages above this excess, with ``SHORT_BITS`` to spare for the first words.
MAX_EXCESS = 2.25
SHORT_BITS = 64.0


def _texts(values) -> list[bytes]:
    return [b"" if t is None else t.lower().encode("utf-8", "ignore") for t in values]


def training_rows(df: DataFrame, id_col: str, text_col: str, lang_col: str, folds: int = 5) -> DataFrame:
    """(lang, text) of rows outside fold 0 that have a language and a text."""
    return df.where(
        (F.pmod(text_id(F.col(id_col)), F.lit(folds)) != 0) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()
    ).select(
        F.col(lang_col).cast("string").alias("lang"),
        F.col(text_col).cast("string").alias("text"),
        F.xxhash64(F.col(id_col).cast("string"), F.lit(29)).alias("lot"),
    )


def train(
    rows: DataFrame, order: int = ORDER, sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES
) -> PPM | None:
    """Frozen statistics of every language of ``rows`` (lang, text, lot); None without rows.

    A row is in the sample if its lot is under its language's threshold, set from an exact count.
    """
    usable = rows.where(F.octet_length("text") > 0)
    totals = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not totals:
        return None
    each = sample_rows / len(totals)
    rates = {k: min(1.0, each / n) for k, n in totals.items()}
    spread = 2**63 - 1
    limit = F.create_map(*[F.lit(x) for k, r in rates.items() for x in (k, spread if r >= 1 else int(spread * (2 * r - 1)))])
    sample = usable.where(F.col("lot") <= F.element_at(limit, F.col("lang")))
    piece = sample_bytes // 4
    at = F.pmod("lot", F.greatest(F.lit(1), F.length("text") - piece + 1)).cast("int") + 1
    whole = F.octet_length("text") <= sample_bytes
    sample = sample.withColumn("text", F.when(whole, F.col("text")).otherwise(F.substring(F.col("text"), at, F.lit(piece))))

    def grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, part in batch.groupby("lang"):
                for codes, _, _ in segments(_texts(part["text"]), order):
                    seen, n = np.unique(codes, return_counts=True)
                    yield pd.DataFrame({"lang": lang, "code": seen.astype(np.int64), "n": n})

    counted = sample.select("lang", "text").mapInPandas(grams, "lang string, code long, n long")
    table = counted.groupBy("lang", "code").agg(F.sum("n").alias("n")).toPandas()
    return PPM(table, order)


class PPM:
    """Frozen code lengths: per order, the n-grams that any language knows with one natural logarithm per language."""

    def __init__(self, table: pd.DataFrame, order: int) -> None:
        self.order, self.langs = order, sorted(table["lang"].unique())
        width = len(self.langs)
        lang = np.searchsorted(np.asarray(self.langs, dtype=object), table["lang"].to_numpy(dtype=object))
        code, n = table["code"].to_numpy(np.int64).astype(np.uint64), table["n"].to_numpy(np.int64)
        self.grams: list[np.ndarray] = []
        self.logs: list[np.ndarray] = []
        self.contexts: list[np.ndarray] = []
        self.escapes: list[np.ndarray] = []
        lower = None
        for k in range(order + 1):
            short = code & low_bytes(k + 1)
            grams = np.arange(256, dtype=np.uint64) if k == 0 else np.unique(short)
            counts = np.zeros((len(grams), width))
            np.add.at(counts, (np.searchsorted(grams, short), lang), n)
            contexts, of = np.unique(grams >> np.uint64(8), return_inverse=True)
            total, kinds = np.zeros((len(contexts), width)), np.zeros((len(contexts), width))
            np.add.at(total, of, counts)
            np.add.at(kinds, of, counts > 0)
            known = total > 0
            escape = np.log(np.where(known, kinds, 1.0)) - np.log(np.where(known, total + kinds, 1.0))
            if lower is None:
                below = np.full((256, width), -np.log(256.0))
            else:
                below = lower[np.searchsorted(self.grams[-1], grams & low_bytes(k))]
            coded = np.log(np.maximum(counts, 1.0)) - np.log(np.maximum((total + kinds)[of], 1.0))
            lower = np.where(counts > 0, coded, below + escape[of])
            self.grams.append(grams)
            self.logs.append(lower.astype(np.float32))
            self.contexts.append(contexts)
            self.escapes.append(escape.astype(np.float32))
            lower = self.logs[-1].astype(np.float64)
        #: Nats a byte that each language's training text takes in its own model.
        self.own = -(counts * lower).sum(axis=0) / counts.sum(axis=0)

    def ready(self) -> PPM:
        """Builds the lookups, once per worker."""
        if not hasattr(self, "_gram_at"):
            self._gram_at = [Lookup(g) for g in self.grams]
            self._context_at = [Lookup(c) for c in self.contexts]
        return self

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Natural-log probability of each whole text in each language."""
        out = np.zeros((len(texts), len(self.langs)))
        for codes, owners, starts in segments(texts, self.order):
            logs = np.zeros((len(codes), len(self.langs)), dtype=np.float32)
            todo = np.arange(len(codes))
            for k in range(self.order, -1, -1):
                gram = codes & low_bytes(k + 1)
                at = self._gram_at[k](gram)
                found = at >= 0
                if found.all():
                    logs[todo] += self.logs[k][at]
                    break
                logs[todo[found]] += self.logs[k][at[found]]
                todo, codes, gram = todo[~found], codes[~found], gram[~found]
                context = self._context_at[k](gram >> np.uint64(8))
                known = context >= 0
                logs[todo[known]] += self.escapes[k][context[known]]
            np.add.at(out, owners, np.add.reduceat(logs, starts, axis=0, dtype=np.float64))
        return out


def identify(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    order: int = ORDER,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row; the model learns from the rows that are not held out."""
    rows = df.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.pmod(text_id(F.col(id_col)), F.lit(5)) == 0, F.lit(True)).alias("held_out"),
        F.col(text_col).cast("string").alias("_text"),
    )
    judged = predicted(rows, df, id_col, text_col, lang_col, order, sample_rows, "_text")
    return judged.select("doc_id", "held_out", F.col("__lang.lang_pred").alias("lang_pred"), F.col("__lang.score").alias("score"))


def predicted(rows, df, id_col, text_col, lang_col, order=ORDER, sample_rows=SAMPLE_ROWS, on="text") -> DataFrame:
    """``rows`` with ``__lang``: the language and score of column ``on`` under a model trained on ``df``."""
    model = train(training_rows(df, id_col, text_col, lang_col), order, sample_rows)
    if model is None:
        unknown = F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0.0).alias("excess"))
        return rows.withColumn("__lang", unknown)
    # Bounded by the training sample, not by the input: see SAMPLE_ROWS.
    shared = df.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        ppm = shared.value.ready()
        names = np.asarray(ppm.langs, dtype=object)
        for texts, letters in batches:
            best = np.zeros(len(texts), dtype=np.int64)
            score = np.zeros(len(texts))
            excess = np.zeros(len(texts))
            for a, b in slices([0 if t is None else len(t) for t in texts], 1 << 19):
                encoded = _texts(texts.iloc[a:b])
                logs = ppm.code_lengths(encoded)
                best[a:b] = logs.argmax(axis=1)
                score[a:b] = 1.0 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
                size = np.fromiter(map(len, encoded), dtype=np.float64, count=len(encoded))
                taken = np.maximum(-logs.max(axis=1) - SHORT_BITS * np.log(2.0), 0.0)
                excess[a:b] = taken / np.maximum(size * ppm.own[best[a:b]], 1e-9)
            named = letters.to_numpy(dtype=bool)
            pred = np.where(named, names[best], UNKNOWN)
            yield pd.DataFrame({"lang_pred": pred, "score": np.where(named, score, 0.0), "excess": excess})

    udf = F.pandas_udf(judge, "lang_pred string, score double, excess double")
    letters = F.coalesce(F.col(on).rlike(r"\p{L}"), F.lit(False))
    return rows.withColumn("__lang", udf(F.col(on), letters))


def keep_identified(df: DataFrame, min_score: float = 0.5, max_excess: float = MAX_EXCESS) -> DataFrame:
    """The rows in one of the learned languages, with the columns of ``df`` alone.

    A row goes if it has no letter, if no language has a posterior of ``min_score``, or if its text takes more than
    ``max_excess`` times the code that the best language's own text takes (an unlearned language, random letters).
    """
    names = [F.col(f"`{n}`") for n in df.columns]
    judged = predicted(df, df, "doc_id", "text", "lang", on="text")
    fits = (F.col("__lang.score") >= min_score) & (F.col("__lang.excess") <= max_excess)
    return judged.where((F.col("__lang.lang_pred") != UNKNOWN) & fits).select(*names)
