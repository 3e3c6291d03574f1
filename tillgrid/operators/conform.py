"""File gate and conformance of sales files to the typed sales fact.

* ``gate`` compares each file's header with the mandatory column set (``array_except``), giving missing and extra
  columns, an accept flag and a reject reason per file: one DataFrame, no per-file job.
* ``conform_lines`` turns the raw lines of all accepted files into the typed fact in one scan: each line is parsed
  positionally and every mandatory column is taken from the position its name has in that file's header; extras
  are packed into ``additional_column``; values are cast with ``try_cast`` so one bad value becomes NULL in that
  row (listed in ``_bad_columns``) instead of failing the whole load. ``conform`` does the same for a frame whose
  text columns are already named.
* ``union_all`` is ``unionByName`` (UNION ALL, duplicates kept), seeded by an empty typed frame.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillgrid.functions.scalars import pack_columns
from tillgrid.schemas import EXTRA_COLUMN, MANDATORY_COLUMNS, SALES_FACT

REASON_NOT_CSV = "not a csv file"
REASON_EMPTY = "empty file"
REASON_MISSING = "missing mandatory columns"

# Most files, and bytes of their paths or of their distinct header lines, that one branch of the line scan broadcasts. A
# drop with more is read in several branches, each file in exactly one of them, so lines are never shuffled to their header.
BRANCH_FILES = 200_000
BRANCH_BYTES = 64 << 20


def _names(cols: Sequence[str]) -> Column:
    return F.array(*[F.lit(c) for c in cols])


def gate(files: DataFrame, headers: DataFrame, mandatory: Sequence[str] = MANDATORY_COLUMNS) -> DataFrame:
    """Per file: path, file_key, file_name, is_csv, header_line, header, missing, extra, accepted, reason.

    ``files`` is a manifest with ``is_csv``; ``headers`` comes from ``file_headers``. Both have one row per file.
    """
    need = _names(mandatory)
    joined = files.join(headers.select("file_key", "header_line", "header"), "file_key", "left")
    none = F.array().cast("array<string>")
    missing = (
        F.when(~F.col("is_csv"), none)
        .when(F.col("header").isNull(), need)
        .otherwise(F.array_except(need, F.col("header")))
    )
    # Every position of the header that no mandatory name takes, so same-named and blank columns all stay.
    extra = F.when(F.col("header").isNull(), none).otherwise(
        F.filter("header", lambda h: ~F.coalesce(F.array_contains(need, h), F.lit(False)))
    )
    reason = (
        F.when(~F.col("is_csv"), F.lit(REASON_NOT_CSV))
        .when(F.col("header").isNull(), F.lit(REASON_EMPTY))
        .when(F.size("missing") > 0, F.lit(REASON_MISSING))
    )
    return (
        joined.withColumn("missing", missing)
        .withColumn("extra", extra)
        .withColumn("reason", reason)
        .withColumn("accepted", F.col("reason").isNull())
        .select(
            "path", "file_key", "file_name", "is_csv", "header_line", "header", "missing", "extra", "accepted", "reason"
        )
    )


def rejects(gated: DataFrame) -> DataFrame:
    """The reject table: path, file_name, reason, missing."""
    return gated.where(~F.col("accepted")).select("path", "file_name", "reason", "missing")


def pack_extras(df: DataFrame, extras: Sequence[str]) -> DataFrame:
    """``additional_column`` = the extras joined with ',' (NULL parts skipped); NULL when there are none."""
    return df.withColumn(EXTRA_COLUMN, pack_columns(list(extras)))


def _typed_columns(text_of: Callable[[str], Column], extra: Column, keep_bad: bool) -> list[Column]:
    """``SALES_FACT`` columns from a function giving each mandatory column's text (``try_cast``, bad list)."""
    typed: list[Column] = []
    bad: list[Column] = []
    for field in SALES_FACT.fields:
        if field.name == EXTRA_COLUMN:
            continue
        raw_text = text_of(field.name)
        if isinstance(field.dataType, T.StringType):
            text, value = raw_text, raw_text
        else:
            text = F.trim(raw_text)
            value = text.try_cast(field.dataType)
        typed.append(value.alias(field.name))
        bad.append(F.when(text.isNotNull() & (text != "") & value.isNull(), F.lit(field.name)))
    cols = [*typed, extra.alias(EXTRA_COLUMN)]
    if keep_bad:
        cols.append(F.filter(F.array(*bad), lambda x: x.isNotNull()).alias("_bad_columns"))
    return cols


def conform(raw: DataFrame, header: Sequence[str], keep_bad: bool = True) -> DataFrame:
    """Typed fact (``SALES_FACT`` columns) from a frame of text columns named by ``header``.

    ``header`` must contain every mandatory column (the gate guarantees it). Extra columns are packed in header
    order. With ``keep_bad`` a ``_bad_columns`` array lists the mandatory columns whose text did not cast.
    """
    mandatory = set(MANDATORY_COLUMNS)
    extras = [c for c in header if c not in mandatory]
    cols = _typed_columns(F.col, pack_columns(extras), keep_bad)
    if "source_file" in raw.columns:
        cols.append(F.col("source_file"))
    return raw.select(*cols)


def _branches(files: DataFrame) -> int:
    """Into how many branches the line scan of these files falls (one aggregate over one row per file)."""
    heads = files.groupBy("_head").agg(F.first("header_line").alias("h")).agg(F.sum(F.octet_length("h"))).first()[0]
    n, paths = files.agg(F.count(F.lit(1)), F.sum(F.octet_length("path"))).first()
    return max(1, -(-n // BRANCH_FILES), -(-(paths or 0) // BRANCH_BYTES), -(-(heads or 0) // BRANCH_BYTES))


def _with_header(lines: DataFrame, files: DataFrame, names: Sequence[str]) -> DataFrame:
    """Lines of ``files`` with path, header line and the positions of columns in that header.

    Two steps: the 8-byte hash of the file's key gives its path and the hash of its header line; that gives the header,
    of which a drop has few however many files it has.
    """
    dictionary = files.groupBy("_head").agg(F.first("header_line").alias("header_line"), F.first("header").alias("header"))
    dictionary = dictionary.select(
        "_head",
        "header_line",
        *[F.array_position("header", F.lit(n)).cast("int").alias(f"_p{i}") for i, n in enumerate(names)],
        F.filter(
            F.sequence(F.lit(1), F.size("header")),
            lambda i: ~F.coalesce(F.array_contains(_names(names), F.element_at("header", i)), F.lit(False)),
        ).alias("_pe"),
    )
    return lines.join(F.broadcast(files.select("_file", "path", "_head")), "_file").join(F.broadcast(dictionary), "_head")


def conform_lines(lines: DataFrame, gated: DataFrame, width: int, keep_bad: bool = True) -> DataFrame:
    """Typed fact of every accepted file, from its raw text lines, in one scan whatever the number of headers.

    ``lines`` has ``value`` (one text line) and ``file_key``; ``gated`` is the gate's one row per file. Each line meets its
    file's header (see ``_with_header``), is parsed once by the CSV parser into ``width`` positional text fields (quotes
    honoured), and each mandatory column is taken from the position its name has in that file's header. So columns are
    matched by name, a reordered header reads correctly, and extras are packed in header order. The header line
    and blank lines are dropped, as the CSV reader does; a line equal to the header further down (files joined
    with their headers) is dropped too instead of becoming a row of failed casts. With ``keep_bad``, ``_bad_line`` is
    the raw line of a row in which a cast failed, else NULL.
    """
    names = [f.name for f in SALES_FACT.fields if f.name != EXTRA_COLUMN]
    file = F.xxhash64("file_key")
    files = gated.where(F.col("accepted")).select(
        file.alias("_file"), "path", F.xxhash64("header_line").alias("_head"), "header_line", "header"
    )
    keyed = lines.withColumn("_file", file)
    n_branches = _branches(files)
    branch = F.pmod(F.col("_file"), F.lit(n_branches))
    joined = union_all([
        _with_header(keyed.where(branch == k), files.where(branch == k), names) if n_branches > 1
        else _with_header(keyed, files, names)
        for k in range(n_branches)
    ])
    data = joined.where((F.col("value") != F.col("header_line")) & (F.trim(F.col("value")) != ""))
    n = max(width, 1)
    # One parse per line: the parsed fields come out of a generator, below which no filter or projection is copied.
    record = F.from_csv(F.col("value"), ", ".join(f"_c{i} string" for i in range(n)))
    texts = F.transform(F.array(record), lambda r: F.array(*[r[f"_c{i}"] for i in range(n)]))
    fields = data.select("path", "value", "_pe", *[f"_p{i}" for i in range(len(names))], F.explode(texts).alias("_f"))

    def at(pos: Column) -> Column:
        return F.when(pos > 0, F.try_element_at(F.col("_f"), pos))

    position = {name: F.col(f"_p{i}") for i, name in enumerate(names)}
    extra = F.when(F.size("_pe") > 0, F.concat_ws(",", F.transform("_pe", at)))
    cols = _typed_columns(lambda name: at(position[name]), extra, keep_bad)
    typed = fields.select(*cols, F.col("path").alias("source_file"), F.col("value").alias("_line"))
    if not keep_bad:
        return typed.drop("_line")
    return typed.withColumn("_bad_line", F.when(F.size("_bad_columns") > 0, F.col("_line"))).drop("_line")


def empty_fact(spark: SparkSession) -> DataFrame:
    """The empty typed fact (the union seed, and the result when no file passes)."""
    return spark.createDataFrame([], SALES_FACT)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name; a column missing from one input is NULL in its rows."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
