"""Telling apart why a source cannot be read."""

from __future__ import annotations

import codecs
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from washline.shipping import ship_package
from washline.sources.files import PIECE, Opener, list_entries, open_filesystem, qualified

# What storage systems call a missing object (404) and a denied one (403).
MISSING_SIGNS = ("PATH_NOT_FOUND", "FileNotFoundException", "NoSuchKey", "NoSuchBucket", "404")
DENIED_SIGNS = (
    "AccessControlException",
    "AccessDeniedException",
    "AccessDenied",
    "Permission denied",
    "Forbidden",
    "403",
)

LISTED = "path string, file string, status string, error_class string"
PROBED = LISTED + ", length bigint"


def classify_read_error(error: BaseException) -> tuple[str, str]:
    """(status, error class): status is missing, denied or error."""
    condition = error.getCondition() if isinstance(error, PySparkException) else None
    name = condition or type(error).__name__
    if condition == "PATH_NOT_FOUND" or isinstance(error, FileNotFoundError):
        return "missing", name
    if isinstance(error, PermissionError):
        return "denied", name
    text = str(error)
    # A location may hold any digits, so bare status codes count only next to the word status.
    for status, signs in (("denied", DENIED_SIGNS), ("missing", MISSING_SIGNS)):
        for sign in signs:
            if f"Status Code: {sign}" in text if sign.isdigit() else sign in text:
                return status, name
    return "error", name


def _read_through(url: str, encoding: str | None, opener: Opener) -> int:
    """Bytes of a file, decompressed if its name says that it is compressed, all of them read."""
    system, path = opener(url)
    decoder = codecs.getincrementaldecoder(encoding)() if encoding else None
    length = 0
    with system.open_input_stream(path) as stream:
        while piece := stream.read(PIECE):
            length += len(piece)
            if decoder:
                decoder.decode(piece)
    if decoder:
        decoder.decode(b"", final=True)
    return length


def probe_source(
    spark: SparkSession,
    paths: Iterable[str],
    encoding: str | None = None,
    opener: Opener = open_filesystem,
) -> DataFrame:
    """path, file, status, error_class and length: a row per file at the given paths, or per path without any.

    status is ok, empty (no bytes, or a folder without files), missing, denied or error.  Tasks list the folders and
    read every file to its end, decompressing it if its name says so and decoding it if an `encoding`
    is given, so a broken second file does not pass for a good one.  The given paths are the only names
    in the driver.  The `read_*` functions do not go through this: they raise.
    """
    ship_package(spark)
    given = [(p, qualified(spark, p)) for p in paths]
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, url in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                try:
                    files = [u for u, e in list_entries(url, opener) if e.type == fs.FileType.File]
                    rows = [(path, u, None, None) for u in files] or [(path, None, "empty", None)]
                except Exception as error:  # the point is to report every kind of failure
                    rows = [(path, None, *classify_read_error(error))]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows, strict=True)], ["path", "file", "status", "error_class"])

    def probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            statuses, classes, lengths = (batch.column(i).to_pylist() for i in (2, 3, 1))
            for i, url in enumerate(lengths):
                if url is None:
                    continue
                try:
                    lengths[i] = _read_through(url, encoding, opener)
                    statuses[i] = "ok" if lengths[i] else "empty"
                except Exception as error:
                    lengths[i] = None
                    statuses[i], classes[i] = classify_read_error(error)
            columns = [batch.column(0), batch.column(1), pa.array(statuses, pa.string()), pa.array(classes, pa.string()), pa.array(lengths, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["path", "file", "status", "error_class", "length"])

    named = spark.createDataFrame(given, "path string, url string").repartition(tasks, "url")
    found = named.mapInArrow(listed, LISTED)
    return found.repartition(tasks, "path", F.coalesce("file", F.lit(""))).mapInArrow(probed, PROBED)
