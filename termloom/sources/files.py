"""File trees as documents: one file, one row."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.functions.metadata import readable_date, size_kb, sortable_date, utc
from termloom.functions.text import decode_utf8, extension, line_window
from termloom.operators.index import IndexSpec
from termloom.session import stage

FILE_SPEC = IndexSpec(
    text=("contents",),
    exact=("path", "modified_str", "size_kb_str", "last_modified", "last_modified_sortable"),
    points=("modified", "size_kb"),
)


def filter_extension(docs: DataFrame, extensions: list[str], path: str = "path") -> DataFrame:
    """Keep documents whose extension is listed; case matters."""
    return docs.filter(extension(F.col(path)).isin(*extensions))


def name_glob(extensions: list[str]) -> str | None:
    """A file name pattern for the extensions, None where a pattern cannot say it."""
    plain = all(e[:1] == "." and e[1:].replace("_", "").isalnum() for e in extensions)
    return "*{" + ",".join(extensions) + "}" if extensions and plain else None


LISTING = "path string, is_dir boolean, length bigint, modificationTime timestamp"
FILE = "path string, modificationTime timestamp, length bigint, content binary"
READ = f"{FILE}, status string"
PIECE = f"{READ}, piece bigint"

# Names in one outgoing batch of a listing, and what one reading task takes on.
LISTED_ROWS = 10_000
TASK_FILES = 2_000
TASK_BYTES = 128 << 20

# What a reading task holds of a file at once.
PIECE_BYTES = 8 << 20


# Fixed value: Hadoop's names of stores and those of the file systems in Arrow that serve them.
SCHEMES = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfss"}


def _opened(path: str) -> tuple[fs.FileSystem, str, str]:
    """(file system, path in it, prefix that makes a path of it a URI again)."""
    plain = path.removeprefix("file:") if path.startswith("file:") else path
    if path.startswith("file:") or "://" not in path:
        return fs.LocalFileSystem(), "/" + plain.lstrip("/"), "file:"
    whole = path.rstrip("/")
    scheme, rest = whole.split("://", 1)
    authority, _, below = rest.partition("/")
    if "@" in authority:  # container@account: paths in Arrow begin with the container
        host = authority.replace(".blob.", ".dfs.", 1)
        system, _ = fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}://{host}/")
        system = fs.SubTreeFileSystem(authority.split("@")[0], system)
        return system, below, f"{scheme}://{authority}/"
    system, inner = fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}://{rest}")
    inner = inner.rstrip("/")
    if not whole.endswith(inner):
        raise ValueError(f"{inner} is no part of {path}")
    return system, inner, whole[: len(whole) - len(inner)]


def _listed(paths: DataFrame) -> DataFrame:
    """What lies directly in each folder, listed in tasks; unreadable folders are empty.

    A folder leaves its task in batches of ``LISTED_ROWS`` names, however many it holds.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, inner, prefix = _opened(path)
                try:
                    found = system.get_file_info(fs.FileSelector(inner, allow_not_found=True))
                except OSError:
                    continue
                kinds = (fs.FileType.Directory, fs.FileType.File)
                for first in range(0, len(found), LISTED_ROWS):
                    part = [f for f in found[first : first + LISTED_ROWS] if f.type in kinds]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([prefix + f.path for f in part], pa.string()),
                            pa.array([f.type == fs.FileType.Directory for f in part], pa.bool_()),
                            pa.array([f.size for f in part], pa.int64()),
                            pa.array([f.mtime for f in part], pa.timestamp("us", tz="UTC")),
                        ],
                        names=["path", "is_dir", "length", "modificationTime"],
                    )

    return paths.mapInArrow(work, LISTING)


# Fixed value: the file and folder names that Spark's file sources skip.
SKIPPED = r"(^|/)(\.[^/]*|_(?!metadata|common_metadata)[^/=]*|[^/]*\._COPYING_)(/|$)"


def hidden(path: Column, root: str) -> Column:
    """Whether Spark's reader skips a name in the path below ``root``."""
    return F.substring(path, len(root) + 1, 1 << 30).rlike(SKIPPED)


def list_files(spark: SparkSession, root: str) -> tuple[DataFrame, str]:
    """(listing of every file below ``root``, the folder their names are counted from).

    Folders are listed level by level in tasks; the listing is a stored table.
    """
    system, inner, prefix = _opened(root)
    start = system.get_file_info(inner)
    here = prefix + inner.rstrip("/")
    if start.type == fs.FileType.File:
        files = spark.createDataFrame([(here, False, start.size, start.mtime)], LISTING)
        return files, here.rsplit("/", 1)[0]  # a file's own name counts
    level = stage(_listed(spark.createDataFrame([(here,)], "path string")), "files-level")
    files = level
    while level.filter("is_dir").limit(1).count():
        folders = level.filter("is_dir").select("path")
        many = folders.count()
        spread_out = folders.repartition(min(many, spark.sparkContext.defaultParallelism))
        level = stage(_listed(spread_out), "files-level")
        files = files.union(level)
    return files.filter("not is_dir"), here


def _status(error: OSError) -> str:
    if isinstance(error, FileNotFoundError):
        return "vanished"
    return "denied" if isinstance(error, PermissionError) else "failed"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each listed file in numbered pieces of its bytes, or what kept it from being read.

    A file always gives its first piece; of one that fails half-way the last has the status.
    """
    for batch in batches:
        for i, path in enumerate(batch.column(0).to_pylist()):
            one = batch.slice(i, 1)

            def row(content: bytes | None, status: str, piece: int, one=one) -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays(
                    [
                        one.column(0), one.column(2), one.column(1),
                        pa.array([content], pa.binary()), pa.array([status]), pa.array([piece], pa.int64()),
                    ],
                    names=["path", "modificationTime", "length", "content", "status", "piece"],
                )

            piece = 0
            try:
                system, inner, _ = _opened(path)
                with system.open_input_stream(inner) as opened:
                    while (content := opened.read(PIECE_BYTES)) or not piece:
                        yield row(content, "read", piece)
                        piece += 1
            except OSError as error:
                yield row(None, _status(error), piece)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each listed file with its bytes, or with what kept them from being read."""
    for batch in batches:
        for i, path in enumerate(batch.column(0).to_pylist()):
            content = None
            try:
                system, inner, _ = _opened(path)
                with system.open_input_stream(inner) as opened:
                    content = opened.read()
                status = "read"
            except OSError as error:
                status = _status(error)
            one = batch.slice(i, 1)
            yield pa.RecordBatch.from_arrays(
                [one.column(0), one.column(2), one.column(1), pa.array([content], pa.binary()), pa.array([status])],
                names=["path", "modificationTime", "length", "content", "status"],
            )


def _joined(pieces: DataFrame) -> DataFrame:
    """Files out of their pieces; one that was not read to its end has no content."""
    whole = F.bool_and(F.col("status") == "read")
    # Binary, in the order of the pieces, in one buffer a file.
    content = F.expr("listagg(content) WITHIN GROUP (ORDER BY piece)")
    joined = pieces.groupBy("path", "modificationTime", "length").agg(
        F.when(whole, F.coalesce(content, F.lit(b""))).alias("content"),
        F.max_by("status", "piece").alias("status"),
    )
    return joined


def read_listed(listing: DataFrame) -> DataFrame:
    """(path, modificationTime, length, content, status) of listed files, read in tasks.

    Tasks get as many files or bytes as one takes on, so the files of one large flat folder
    are read by many.  Files of more than a piece leave Python in pieces and are put together
    behind it, so its memory does not grow with them.  ``status`` is read, vanished, denied or
    failed; only read files have content.
    """
    files = listing.select("path", "length", "modificationTime")
    large = F.col("length") > PIECE_BYTES
    size = files.agg(
        F.count("*"), F.coalesce(F.sum("length"), F.lit(0)), F.count_if(large)
    ).first()
    cores = files.sparkSession.sparkContext.defaultParallelism
    tasks = max(size[0] // TASK_FILES, size[1] // TASK_BYTES, min(size[0], cores), 1)
    if not size[2]:
        return files.repartition(tasks).mapInArrow(_read, READ)
    small = files.filter(~large).repartition(tasks).mapInArrow(_read, READ)
    pieces = files.filter(large).repartition(max(tasks, min(size[2], 8 * tasks))).mapInArrow(_pieces, PIECE)
    return small.unionByName(_joined(pieces))


def refused_files(spark: SparkSession, root: str) -> DataFrame:
    """The files below ``root`` that Spark's reader leaves out: hidden and empty ones."""
    files, here = list_files(spark, root)
    wanted = files.filter(hidden(F.col("path"), here) | (F.col("length") == 0))
    return read_listed(wanted).filter("status = 'read'").drop("status")


def scan_accounted(
    spark: SparkSession, roots: str | list[str], only_extensions: list[str] | None = None
) -> DataFrame:
    """Every listed file with the status of its reading: nothing is left out silently.

    Columns are those of ``read_listed`` and ``root``.  Listing is done when this returns,
    reading when the rows are asked for.  A missing root is an error.
    """
    found = []
    for root in [roots] if isinstance(roots, str) else roots:
        system, inner, _ = _opened(root)
        if system.get_file_info(inner).type == fs.FileType.NotFound:
            raise FileNotFoundError(root)
        files, _ = list_files(spark, root)
        if only_extensions is not None:
            files = filter_extension(files, only_extensions)
        found.append(read_listed(files).withColumn("root", F.lit(root)))
    return reduce(DataFrame.unionByName, found)


def skipped_files(accounted: DataFrame) -> DataFrame:
    """(root, status, n_files, n_bytes listed) of an accounted scan."""
    return accounted.groupBy("root", "status").agg(
        F.count("*").alias("n_files"), F.sum("length").alias("n_bytes")
    )


def scan_root(spark: SparkSession, root: str, only_extensions: list[str] | None) -> DataFrame:
    """Every file below ``root``, or the one file it names; hidden and empty files too.

    A store that Arrow does not reach is an error, as there those two would be missing.
    Files that vanish or cannot be read are left out.  A listed extension is
    used on the listing, before a file is opened, wherever that is exact.
    """
    try:
        _opened(root)
    except (OSError, ValueError, NotImplementedError, pa.ArrowException) as e:
        raise ValueError(f"no file system of Arrow lists {root}: hidden and empty files would be left out") from e
    seen = _seen_files(spark, root, only_extensions)  # an error if there is no such root
    refused = refused_files(spark, root)
    if only_extensions is not None:
        refused = filter_extension(refused, only_extensions)
    return seen.filter(F.col("length") > 0).unionByName(refused)


def _seen_files(
    spark: SparkSession, root: str, only_extensions: list[str] | None
) -> DataFrame:
    """What Spark's reader finds."""
    reader = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("ignoreCorruptFiles", "true")
        .option("ignoreMissingFiles", "true")
    )
    if only_extensions is None:
        return reader.load(root)
    glob = name_glob(only_extensions)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return filter_extension(reader.load(root), only_extensions)


def scan_files(
    spark: SparkSession,
    roots: str | list[str],
    only_extensions: list[str] | None = None,
    top_lines: int | None = None,
    bottom_lines: int | None = None,
) -> DataFrame:
    """One row per file of every root; a missing root is an error.

    Ids are unique in the frame; store it with ``write_index`` before relying
    on them.
    """
    roots = [roots] if isinstance(roots, str) else roots
    if not roots:
        raise ValueError("at least one root is needed")
    scans = [
        scan_root(spark, root, only_extensions).withColumn("root", F.lit(root)) for root in roots
    ]
    files = reduce(DataFrame.unionByName, scans)
    modified, kilobytes = F.col("modificationTime"), size_kb(F.col("length"))
    return files.select(
        F.monotonically_increasing_id().alias("doc_id"),
        "root",
        "path",
        line_window(decode_utf8(F.col("content")), top_lines, bottom_lines).alias("contents"),
        F.unix_millis(modified).alias("modified"),
        F.unix_millis(modified).cast("string").alias("modified_str"),
        kilobytes.alias("size_kb"),
        kilobytes.cast("string").alias("size_kb_str"),
        readable_date(modified).alias("last_modified"),
        sortable_date(utc(modified)).alias("last_modified_sortable"),
    )
