"""Files as rows: listing, checksums, landing byte for byte.

Tasks do all the work: they list folders, read files in pieces of a fixed size, and hash them.  The
driver knows the root's name alone, and no file is ever whole in memory, so neither the number of
files nor the size of one is limited.

Tasks open files with pyarrow's file systems (local and shared folders, S3, GCS, ABFS, HDFS).  For
other stores, or credentials of another kind, hand in `opener`: a function that tasks call with
a URL and that returns a pyarrow file system and the path in it.  Names that start with a dot or an
underscore count as hidden.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from functools import cache

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from washline.shipping import ship_package
from washline.staging import staging_path

Opener = Callable[[str], tuple[fs.FileSystem, str]]

#: Bytes of a file in one landed row.
CHUNK = 32 << 20

#: Bytes that a task reads at a time.
PIECE = 4 << 20

# Schemes that have another name here.
PYARROW_NAMES = {"s3a": "s3", "s3n": "s3"}

FOUND = "path string, folder boolean, length bigint, micros bigint"


@cache
def _system(scheme: str, authority: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(f"{PYARROW_NAMES.get(scheme, scheme)}://{authority}/")


def _parts(url: str) -> tuple[str, str, str]:
    """Scheme, authority and path; names may hold any character, so nothing is decoded."""
    scheme, rest = url.split(":", 1)
    if not rest.startswith("//"):
        return scheme, "", rest
    authority, slash, path = rest[2:].partition("/")
    return scheme, authority, slash + path


def open_filesystem(url: str) -> tuple[fs.FileSystem, str]:
    """pyarrow's file system for a URL, and the path in it."""
    scheme, authority, path = _parts(url)
    if scheme == "file":
        return fs.LocalFileSystem(), path
    system, top = _system(scheme, authority)
    return system, top.rstrip("/") + path


def _url_like(parent: str, path: str) -> str:
    """The URL of a path that the file system of `parent` knows."""
    scheme, authority, _ = _parts(parent)
    if scheme == "file":
        return f"file:/{path.lstrip('/')}"
    bucket = authority.partition("@")[0]  # object stores put it in their paths
    return f"{scheme}://{authority}/{path.lstrip('/').removeprefix(bucket + '/')}"


def qualified(spark: SparkSession, path: str) -> str:
    """A path with scheme, as the session's default file system and working folder have it."""
    known = spark._jvm.org.apache.hadoop.fs.Path(path)
    return known.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(known).toString()


def _tasks(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def list_entries(url: str, opener: Opener, checked: bool = True) -> Iterator[tuple[str, fs.FileInfo]]:
    """URL and description of what is directly in a folder; `checked`: it must exist and may be a file."""
    system, path = opener(url)
    if checked:
        own = system.get_file_info(path)
        if own.type == fs.FileType.NotFound:
            raise FileNotFoundError(f"no such file or folder: {url}")
        if own.type == fs.FileType.File:
            yield url, own
            return
    for entry in system.get_file_info(fs.FileSelector(path, recursive=False)):
        if not entry.base_name.startswith((".", "_")):
            yield _url_like(url, entry.path), entry


def _found(folders: DataFrame, opener: Opener, root: str | None = None) -> DataFrame:
    """What is directly in each of `folders` (path); `root` may be a file, and must exist."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for url in batch.column(0).to_pylist():
                seen = [e for _, e in list_entries(url, opener, url == root)]
                for start in range(0, len(seen), 10_000):
                    yield rows(url, seen[start : start + 10_000])

    def rows(url: str, entries: list[fs.FileInfo]) -> pa.RecordBatch:
        micros = [None if e.mtime_ns is None else e.mtime_ns // 1000 for e in entries]
        folder = [e.type == fs.FileType.Directory for e in entries]
        length = [None if d else e.size for d, e in zip(folder, entries, strict=True)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([_url_like(url, e.path) for e in entries], pa.string()),
                pa.array(folder, pa.bool_()),
                pa.array(length, pa.int64()),
                pa.array(micros, pa.int64()),
            ],
            ["path", "folder", "length", "micros"],
        )

    return folders.mapInArrow(listed, FOUND)


def list_files(spark: SparkSession, path: str, recursive: bool = False, opener: Opener = open_filesystem) -> DataFrame:
    """path, length and modificationTime of the files at `path`, a folder or a file; no content is read.

    A task lists a folder; folders inside are listed level by level, each level by as many tasks as
    it has folders, and the names stay in a staged table.  A missing path is an error of the action, or
    with `recursive` of this call.
    """
    ship_package(spark)
    root = qualified(spark, path)
    found = _found(spark.createDataFrame([(root,)], "path string"), opener, root)
    if recursive:
        staged, levels = staging_path(spark, "listing"), 0
        while True:
            found.write.parquet(f"{staged}/level={levels}")
            level = spark.read.schema(FOUND).parquet(f"{staged}/level={levels}")
            folders = level.where("folder").select("path")
            if folders.isEmpty():
                break
            found, levels = _found(folders.repartition(_tasks(spark), "path"), opener), levels + 1
        found = spark.read.schema(FOUND + ", level int").parquet(staged)
    return found.where("not folder").select("path", "length", F.timestamp_micros("micros").alias("modificationTime"))


def hashed(files: DataFrame, chunk: int = CHUNK, opener: Opener = open_filesystem) -> DataFrame:
    """Add `sha256` of the file, and `chunks_sha256` of its chunks' digests in order, to rows with a `path`.

    SHA-256 goes through a file from its begin to its end, so one task reads one file, a piece at a time.
    """
    schema = files.schema.simpleString().removeprefix("struct<").removesuffix(">")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_digests(path, chunk, opener) for path in batch.column(at).to_pylist()]
            columns = [pa.array([d[i] for d in found], pa.string()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*names, "sha256", "chunks_sha256"])

    ship_package(files.sparkSession)
    names, at = files.columns, files.columns.index("path")
    return files.mapInArrow(digest, f"{schema},sha256:string,chunks_sha256:string")


def _digests(url: str, chunk: int, opener: Opener) -> tuple[str, str]:
    system, path = opener(url)
    whole, chunks = hashlib.sha256(), hashlib.sha256()
    with system.open_input_stream(path, compression=None, buffer_size=None) as stream:
        done = False
        while not done:
            own, left = hashlib.sha256(), chunk
            while left:
                piece = stream.read(min(left, PIECE))
                if not piece:
                    done = True
                    break
                whole.update(piece)
                own.update(piece)
                left -= len(piece)
            if left < chunk:
                chunks.update(own.hexdigest().encode())
    return whole.hexdigest(), chunks.hexdigest()


def _spread(files: DataFrame) -> DataFrame:
    return files.repartition(_tasks(files.sparkSession), "path")


def file_checksums(spark: SparkSession, path: str, recursive: bool = False, opener: Opener = open_filesystem) -> DataFrame:
    """path, length and SHA-256 of the files at `path`; a missing path is an error."""
    return hashed(_spread(list_files(spark, path, recursive, opener)), opener=opener).select("path", "length", "sha256")


def chunks_of(files: DataFrame, chunk: int = CHUNK, opener: Opener = open_filesystem) -> DataFrame:
    """path, number, content: the bytes of files (path, length) in rows of at most `chunk` bytes.

    Chunks are dealt out each by itself, so a large file is read by many tasks.  An empty file has none.
    """
    numbers = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("length") - 1) / chunk))
    wanted = files.where("length > 0").select("path", F.explode(numbers).alias("number"))
    schema = "path string, number bigint, content binary"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for url, number in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                system, path = opener(url)
                with system.open_input_file(path) as file:
                    content = file.read_at(chunk, number * chunk)
                columns = [pa.array([url]), pa.array([number], pa.int64()), pa.array([content], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["path", "number", "content"])

    return wanted.repartition(_tasks(files.sparkSession), "path", "number").mapInArrow(read, schema)


def land_files(
    spark: SparkSession,
    src_dir: str,
    landing: str,
    recursive: bool = False,
    chunk: int = CHUNK,
    opener: Opener = open_filesystem,
) -> DataFrame:
    """Copy the files of a folder into a landing, replacing what was there; returns its files.

    `<landing>/files` has path, length, modificationTime, chunk, sha256 and chunks_sha256 as a reading
    from begin to end found them, `<landing>/chunks` has path, number and content.  The size of a row
    group is looked at after every row, so a task holds few chunks at a time.
    """
    if chunk < 1:
        raise ValueError("a chunk has at least one byte")
    listed = _spread(list_files(spark, src_dir, recursive, opener)).withColumn("chunk", F.lit(chunk).cast("bigint"))
    hashed(listed, chunk, opener).write.mode("overwrite").parquet(f"{landing}/files")
    files = landed_files(spark, landing)
    writer = chunks_of(files, chunk, opener).write.mode("overwrite")
    for check in ("parquet.page.size.row.check.min", "parquet.block.size.row.check.min"):
        writer = writer.option(check, "1")
    writer.parquet(f"{landing}/chunks")
    return files


def landed_files(spark: SparkSession, landing: str) -> DataFrame:
    schema = "path string, length bigint, modificationTime timestamp, chunk bigint, sha256 string, chunks_sha256 string"
    return spark.read.schema(schema).parquet(f"{landing}/files")


def landed_chunks(spark: SparkSession, landing: str) -> DataFrame:
    """path, number and content of what `land_files` has copied."""
    return spark.read.schema("path string, number bigint, content binary").parquet(f"{landing}/chunks")


def restore_files(chunks: DataFrame, folder: str, opener: Opener = open_filesystem) -> DataFrame:
    """Write landed chunks (path, number, content) of single-chunk files to `folder`; returns name and length.

    The name is the path's last part.  A file appears under its name once it is complete, so a task that
    is repeated leaves no half file.  Files of several chunks are refused.
    """
    spark = chunks.sparkSession
    ship_package(spark)
    root = qualified(spark, folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, top = opener(root)
        system.create_dir(top, recursive=True)
        for batch in batches:
            names, lengths = [], []
            for url, number, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if number:
                    raise ValueError(f"a file of several chunks: {url}")
                names.append(url.rsplit("/", 1)[-1])
                lengths.append(len(content))
                hidden = f"{top}/.{uuid.uuid4().hex}"
                with system.open_output_stream(hidden) as out:
                    out.write(content)
                system.move(hidden, f"{top}/{names[-1]}")
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(lengths, pa.int64())], ["name", "length"])

    return chunks.select("path", "number", "content").mapInArrow(write, "name string, length bigint")
