"""Quality rules as a bitmask ledger, on DataFrame functions alone.

Every rule is evaluated once per document. The ledger keeps the measurements and one failure bit per rule. A policy is
a version number with a mask of the rules that it enforces, so policies are applied, compared and ablated later with
bitwise arithmetic on the ledger; no text is read again.

Defined results: a null or empty text has no words, all measurements 0 and fails ``few_words``; repeated rows are
judged alike; an empty table gives an empty ledger.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillgrid.llm.common import words

_WINDOW = 5

#: Measurements of the ledger, in order.
MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_exclaims",
    "n_letters",
    "n_capitals",
    "n_stutters",
)


#: Names of the rules by bit. Bits are only ever appended, so an old ledger stays readable.
RULE_NAMES = (
    "few_words",
    "repeated_windows",
    "symbols",
    "duplicate_lines",
    "shouting",
    "exclaiming",
    "short_words",
    "long_words",
    "few_letters",
    "stutters",
)


def mask_of(*names: str) -> int:
    """The bitmask of the named rules."""
    return sum(1 << RULE_NAMES.index(n) for n in set(names))


BASE_MASK = mask_of("few_words", "repeated_windows")
#: Versioned policies: the rules that each version enforces.
POLICIES = {
    1: BASE_MASK,
    2: mask_of("few_words", "repeated_windows", "symbols", "duplicate_lines"),
    3: mask_of(*RULE_NAMES),
}
CURRENT_POLICY = 3


def _matches(text: Column, pattern: str) -> Column:
    """Characters of ``text`` that match a one-character pattern."""
    return F.size(F.split(text, pattern, -1)) - 1


def repeated_window_words(word_hashes: Column, window: int = _WINDOW) -> Column:
    """Words standing in ``window``-word windows that occur at least twice among the given words.

    Windows are compared by 64-bit hashes, sorted with their places, so a text costs n log n whatever it repeats.
    """
    n = F.size(word_hashes)
    starts = F.when(n >= window, F.sequence(F.lit(0), n - window)).otherwise(F.array().cast("array<int>"))
    hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(word_hashes, i + k) for k in range(window)]))

    def covered(h: Column) -> Column:
        def over_sorted(s: Column) -> Column:
            def again(x: Column, i: Column) -> Column:
                key = x["h"]
                earlier = F.coalesce(F.get(s, i - 1)["h"] == key, F.lit(False))
                later = F.coalesce(F.get(s, i + 1)["h"] == key, F.lit(False))
                return earlier | later

            places = F.sort_array(F.transform(F.filter(s, again), lambda x: x["p"]))

            def over_places(p: Column) -> Column:
                steps = F.transform(
                    p, lambda x, i: F.least(F.coalesce(F.get(p, i + 1) - x, F.lit(window)), F.lit(window))
                )
                return F.aggregate(steps, F.lit(0).cast("long"), lambda acc, x: acc + x)

            return _bound(places, over_places)

        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
        heavy = _bound(pairs, over_sorted)
        return F.when(F.size(F.array_distinct(h)) < F.size(h), heavy).otherwise(F.lit(0).cast("long"))

    return _bound(hashes, covered)


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def measures(text: Column) -> Column:
    """Struct of the measurements of MEASURES. One expression that splits the text once, wherever Catalyst puts it."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    parts = F.struct(words(text).alias("words"), lines.alias("lines"), text.alias("text"))

    def of(p: Column) -> Column:
        return _bound(
            F.struct(
                F.transform(p["words"], lambda w: F.xxhash64(w)).alias("hashes"),
                F.array_join(p["words"], "").alias("joined"),
                *[p[k].alias(k) for k in ("words", "lines", "text")],
            ),
            fields,
        )

    def fields(p: Column) -> Column:
        h = p["hashes"]
        out = {
            "n_words": F.size(h),
            "word_chars": F.length(p["joined"]),
            "n_symbols": _matches(p["joined"], "[#*$%&|<>]"),
            "n_dup_lines": F.size(p["lines"]) - F.size(F.array_distinct(p["lines"])),
            "n_repeat_words": repeated_window_words(h),
            "n_lines": F.size(p["lines"]),
            "n_exclaims": _matches(p["joined"], "!"),
            "n_letters": F.length(F.regexp_replace(p["joined"], r"[^\p{L}]+", "")),
            "n_capitals": _matches(p["joined"], r"\p{Lu}"),
            "n_stutters": F.size(F.filter(h, lambda x, i: x == F.coalesce(F.get(h, i - 1), F.bitwise_not(x)))),
        }
        return F.struct(*[out[m].cast("long").alias(m) for m in MEASURES])

    return _bound(parts, of)


def _rules(m: Column) -> dict[str, Column]:
    """Whether each rule of RULE_NAMES fails, from a struct of measurements."""
    return {
        "few_words": m["n_words"] < 10,
        "repeated_windows": 100 * m["n_repeat_words"] > 20 * m["n_words"],
        "symbols": 100 * m["n_symbols"] > 20 * m["n_words"],
        "duplicate_lines": 100 * m["n_dup_lines"] > 40 * m["n_lines"],
        "shouting": 100 * m["n_capitals"] > 60 * m["n_letters"],
        "exclaiming": 100 * m["n_exclaims"] > 30 * m["n_words"],
        "short_words": m["word_chars"] < 2 * m["n_words"],
        "long_words": m["word_chars"] > 25 * m["n_words"],
        "few_letters": 100 * m["n_letters"] < 50 * m["word_chars"],
        "stutters": 100 * m["n_stutters"] > 30 * m["n_words"],
    }


def failure_bits(m: Column) -> Column:
    """The bitmask of failed rules, from a struct of measurements."""
    fails = _rules(m)
    bits = F.lit(0).cast("long")
    for bit, name in enumerate(RULE_NAMES):
        bits = bits.bitwiseOR(F.when(fails[name], F.lit(1 << bit)).otherwise(0).cast("long"))
    return bits


def ledger(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One ledger row per document: doc_id, the measurements, and ``failed`` (one bit per rule of RULE_NAMES)."""
    row = F.transform(
        F.array(measures(F.col(text_col))),
        lambda m: F.struct(*[m[k].alias(k) for k in MEASURES], failure_bits(m).alias("failed")),
    )
    # A generator: the struct is computed once per row, not once per column taken from it.
    return df.select(F.col(id_col).alias("doc_id"), F.inline(row))


def apply_policy(rows: DataFrame, version: int = CURRENT_POLICY) -> DataFrame:
    """A ledger with ``kept``: no rule of the policy's mask failed."""
    return rows.withColumn("kept", _passes(F.col("failed"), version))


def _passes(bits: Column, version: int) -> Column:
    return bits.bitwiseAND(F.lit(POLICIES[version]).cast("long")) == 0


def ablations(rows: DataFrame, version: int = CURRENT_POLICY) -> DataFrame:
    """Per rule of a policy: documents failing it, failing it alone, and kept if the rule were dropped.

    The ledger is first counted per failure mask (at most 2^rules groups, combined before the shuffle).
    """
    mask = POLICIES[version]
    groups = rows.groupBy(F.col("failed").bitwiseAND(F.lit(mask).cast("long")).alias("mask")).agg(
        F.count("*").alias("n")
    )
    bits = [b for b in range(len(RULE_NAMES)) if mask >> b & 1]
    rules = F.array(*[F.struct(F.lit(RULE_NAMES[b]).alias("rule"), F.lit(1 << b).cast("long").alias("bit")) for b in bits])
    each = groups.select("mask", "n", F.explode(rules).alias("r"))
    hit = F.col("mask").bitwiseAND(F.col("r.bit"))
    return each.groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(hit != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("mask") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_failed_alone"),
        F.sum(F.when(F.col("mask").bitwiseAND(F.bitwise_not(F.col("r.bit"))) == 0, F.col("n")).otherwise(0)).alias(
            "n_kept_without"
        ),
    )


def keep_clean(df: DataFrame, text_col: str = "text", version: int = CURRENT_POLICY) -> DataFrame:
    """The rows that the policy keeps, with the columns of ``df`` alone."""
    return df.where(_bound(measures(F.col(text_col)), lambda m: _passes(failure_bits(m), version)))
