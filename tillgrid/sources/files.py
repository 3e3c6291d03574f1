"""File sources: the manifest of a drop folder, the header probe and the header-by-name CSV read.

* ``manifest`` lists files through Spark's own file index (``binaryFile`` with only path, length and modification
  time selected, so file contents are never read), and the zero-byte files that it skips.
* ``file_headers`` finds the first non-blank line of every file (the CSV reader skips blank lines too). Tasks over the
  manifest open each file and stop at that line, so the probe costs one short read per file whatever the files hold.
  Only where tasks cannot open the files themselves (see ``OPENED_SCHEMES``) Spark's text scan finds the lines: each task reads
  the splits that start a file and keeps, per file, the line with the smallest row id (a map-side ``min_by``). One
  row per file leaves the tasks; the number of jobs does not grow with the number of files.
* ``csv_lines`` gives every line of the CSV files with its file key; ``operators.conform.conform_lines`` parses them
  against each file's own header in the same single scan.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the byte-order mark some tools put in front of a CSV header.
_BOM = "\ufeff"
# Schemes of file systems whose files tasks open by themselves; the setting names more (comma-separated) where the workers
# have access to them: pyarrow opens hdfs, s3 and gs.
OPENED_SCHEMES = ("file",)
OPENED_SCHEMES_KEY = "tillgrid.headers.openedSchemes"
_PROBE_BYTES = 1 << 16
_LINE_END = re.compile(rb"\r\n|\r|\n")
# A comma followed by an even number of quote characters up to the end of the line is outside any quoted name.
_COMMA_OUTSIDE_QUOTES = ',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def plain_path(path: str) -> str:
    """A listed path as a reader's argument: characters that mean a pattern there are escaped."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def manifest(spark: SparkSession, root: str | Sequence[str]) -> DataFrame:
    """All files under ``root`` (recursively): path, file_key, length, modificationTime, file_name.

    ``path`` is the plain path (to read the file again); ``file_key`` is the same path as the file scans'
    ``_metadata.file_path`` spells it (URL-encoded), the key every per-file join uses.

    Folders are not files and never appear; names starting with ``_`` or ``.`` are skipped by Spark's file index. Zero-byte
    files, which Spark's scans skip, come from ``empty_files`` where tasks can list the folders themselves.
    """
    paths = [root] if isinstance(root, str) else [plain_path(p) for p in root]
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(paths)
        .select("path", F.col("_metadata.file_path").alias("file_key"), "length", "modificationTime")
    )
    if _opened_by_tasks(spark, paths):
        files = files.unionByName(empty_files(spark, root))
    return files.withColumn("file_name", F.element_at(F.split("path", "/"), -1))


def _system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path and its name there."""
    if re.match("(file:)?/", path):
        return pafs.LocalFileSystem(), re.sub("^(file:)?/+", "/", path)
    return pafs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", path))


def _hidden(name: str) -> bool:
    return any(part.startswith(".") or (part.startswith("_") and "=" not in part) for part in name.split("/"))


def _list_empty(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, deep) of files or folders → (path, modificationTime) of the zero-byte files there."""
    for batch in batches:
        for path, deep in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            system, name = _system(path)
            info = system.get_file_info(name)
            if info.type == pafs.FileType.Directory:
                inside = system.get_file_info(pafs.FileSelector(name, recursive=deep))
            else:
                inside = [info]
            found = [
                i for i in inside
                if i.type == pafs.FileType.File and i.size == 0 and not _hidden(i.path[len(name) :].lstrip("/"))
            ]
            prefix = "file:" if isinstance(system, pafs.LocalFileSystem) else re.match("[^:]+://[^/]*/", path).group(0)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([prefix + i.path for i in found], type=pa.string()),
                    pa.array([i.mtime for i in found], type=pa.timestamp("us", tz="UTC")),
                ],
                names=["path", "modificationTime"],
            )


def empty_files(spark: SparkSession, root: str | Sequence[str]) -> DataFrame:
    """The zero-byte files under ``root`` (a folder, or a list of folders or files), in the manifest's columns.

    Tasks list one sub-folder each, so the driver sees the first level of folders only. A file without a byte has no line, so
    its ``file_key`` meets nothing.
    """
    if isinstance(root, str):
        system, name = _system(root)
        top = system.get_file_info(pafs.FileSelector(name, allow_not_found=True))
        folders = [i.base_name for i in top if i.type == pafs.FileType.Directory and not _hidden(i.base_name)]
        seeds = [(root, False), *((f"{root.rstrip('/')}/{f}", True) for f in folders)]
    else:
        seeds = [(p, True) for p in root]
    found = (
        spark.createDataFrame(seeds, "path string, deep boolean")
        .repartition(max(1, min(len(seeds), 200)))
        .mapInArrow(_list_empty, "path string, modificationTime timestamp")
    )
    return found.select("path", F.col("path").alias("file_key"), F.lit(0).cast("long").alias("length"), "modificationTime")


def split_by_suffix(files: DataFrame, suffix: str = ".csv") -> DataFrame:
    """Add ``is_csv``: the file name ends with ``suffix`` (case-sensitive, like the ``*.csv`` glob of the header
    probe and the line scan) and the entry is not a folder."""
    name = F.col("path")
    return files.withColumn("is_csv", name.endswith(suffix) & ~name.endswith("/"))


def header_names(line: str | F.Column) -> F.Column:
    """Column names of a CSV header line: split on commas outside quotes; BOM, quotes and blanks removed."""
    c = F.col(line) if isinstance(line, str) else line
    return F.transform(
        F.split(c, _COMMA_OUTSIDE_QUOTES),
        lambda x: F.trim(F.regexp_replace(F.regexp_replace(x, f"^{_BOM}", ""), '^\\s*"|"\\s*$', "")),
    )


def first_line(stream) -> str | None:
    """The first line of an open file that holds more than blanks, without a byte-order mark; None if there is none.

    Lines end as in Spark's text reader: at a line feed, a carriage return or both.
    """
    rest, at_start = b"", True
    while True:
        chunk = stream.read(_PROBE_BYTES)
        if at_start and chunk.startswith(_BOM.encode()):
            chunk = chunk[len(_BOM.encode()) :]
        at_start = False
        *lines, rest = _LINE_END.split(rest + chunk)
        for line in lines if chunk else [*lines, rest]:
            if line.strip(b" "):
                return line.decode("utf-8", "replace")
        if not chunk:
            return None


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file_key, path) → (file_key, header_line) of files with a line."""
    for batch in batches:
        found = []
        for key, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            system, name = _system(path if path.startswith("file:") else key)
            with system.open_input_stream(name, buffer_size=0) as stream:
                found.append((key, first_line(stream)))
        lines = [(key, line) for key, line in found if line is not None]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[k] for x in lines], type=pa.string()) for k in (0, 1)], names=["file_key", "header_line"]
        )


def _opened_by_tasks(spark: SparkSession, paths: Sequence[str]) -> bool:
    more = spark.conf.get(OPENED_SCHEMES_KEY, "")
    allowed = {*OPENED_SCHEMES, *(x.strip() for x in more.split(",") if x.strip())}
    default = spark._jvm.org.apache.hadoop.fs.FileSystem.getDefaultUri(spark._jsc.hadoopConfiguration()).getScheme()
    schemes = {m.group(1) if (m := re.match(r"([A-Za-z][\w+.-]*):/", p)) else default for p in paths}
    return schemes <= allowed


def file_headers(spark: SparkSession, root: str | Sequence[str], glob: str | None = "*.csv") -> DataFrame:
    """One row per non-empty file under ``root`` whose name matches ``glob``: file_key, header_line, header."""
    paths = [root] if isinstance(root, str) else [plain_path(p) for p in root]
    if not paths:
        return spark.createDataFrame([], "file_key string, header_line string, header array<string>")
    reader = spark.read.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if _opened_by_tasks(spark, paths):
        files = reader.format("binaryFile").load(paths).select(F.col("_metadata.file_path").alias("file_key"), "path")
        first = files.mapInArrow(_probe, "file_key string, header_line string")
    else:
        first = _scan_first_lines(reader.text(paths))
    return first.withColumn("header", header_names("header_line"))


def _scan_first_lines(text: DataFrame) -> DataFrame:
    """(file_key, header_line) from a scan of all lines, for file systems that only Spark's readers reach."""
    lines = text.select(
        "value",
        F.col("_metadata.file_path").alias("file_key"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_rid"),
    )
    starts = lines.where((F.col("_block") == 0) & (F.trim(F.col("value")) != ""))
    return starts.groupBy("file_key").agg(F.min_by("value", "_rid").alias("header_line"))


def text_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Raw lines of the given files (plain paths) with their ``file_key`` (for the reject store)."""
    if not paths:
        return spark.createDataFrame([], "value string, file_key string")
    return spark.read.text([plain_path(p) for p in paths]).select("value", F.col("_metadata.file_path").alias("file_key"))


def csv_lines(spark: SparkSession, root: str | Sequence[str], glob: str | None = "*.csv") -> DataFrame:
    """Every text line of the files under ``root`` matching ``glob``, with its file_key (one scan, any headers)."""
    paths = [root] if isinstance(root, str) else [plain_path(p) for p in root]
    reader = spark.read.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.text(paths).select("value", F.col("_metadata.file_path").alias("file_key"))
