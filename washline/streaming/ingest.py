"""Files that keep landing, cleaned and appended batch by batch, with a ledger of what was taken.

The transform must work row by row, as all cleaning here does; then no state, watermark or
shuffle is needed and a batch result equals the stream's.

A stream writes below its sink:

    run=<stream>/batch_id=<n>          rows of a batch; `<stream>` is kept in the checkpoint
    _profile/run=<stream>/batch_id=<n> with `profile`, the batch's counts of types per column
    _ledger/run=<stream>/batch_id=<n>  a row per file of the batch: file, header, rows

The stream itself carries the names of new files alone.  Each batch reads its files as any folder is read: once
for their headers, once to count their rows, and once to write its rows, without a copy of them in memory;
the types of a profile are counted as the rows are written.

A batch counts once its ledger is written.  A repeated batch replaces its own folders.  A stream that starts
without its checkpoint is another run: it removes what a broken run left without a ledger, and takes
no file that a ledger names.  One stream at a time may write to a sink.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from washline.functions.fixed_values import NA_TOKENS
from washline.operators.missing import normalize_nulls
from washline.operators.profile import COUNTS, count_types, infer_types, merge_counts, watch_types, watched_types
from washline.settings import small_methods
from washline.sources.csv import as_path, count_rows, csv_options, dedupe_header, file_headers, header_orders, read_lines_checked
from washline.staging import remove_staged, staging_path

ONCE = {"availableNow": True}
EVERY_FIVE_MINUTES = {"processingTime": "5 minutes"}
DAILY = {"processingTime": "1 day"}

LEDGER, PROFILE = "_ledger", "_profile"
TAKEN = "file string, header string, rows bigint, run string, batch_id bigint"
FOUND = "file string, header string, rows bigint"
COUNTED = "column string, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", run string, batch_id bigint"
FILES = "path string, modificationTime timestamp, length bigint, content binary"  # of Spark's binaryFile source


def _folders(spark: SparkSession, path: str) -> set[str]:
    """`run=…/batch_id=…` folders below a path, as many as there were batches."""
    top = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/run=*/batch_id=*")
    found = top.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(top)
    return {f"{p.getParent().getName()}/{p.getName()}" for p in (s.getPath() for s in found or [])}


def read_ledger(spark: SparkSession, sink: str) -> DataFrame:
    """file, header, rows, run, batch_id of all files that streams into `sink` have taken."""
    path = f"{sink}/{LEDGER}"
    if not _folders(spark, path):
        return spark.createDataFrame([], TAKEN)
    return spark.read.schema(TAKEN).parquet(path)


def read_profile(spark: SparkSession, sink: str) -> DataFrame:
    """Type profile of all texts that streams with `profile=True` have taken into `sink`, before `transform`.

    The same rows as `profile_types` of the files at once gives; `apply_types` takes them.  Only batches with a
    ledger count, so a broken or repeated batch counts once.
    """
    path = f"{sink}/{PROFILE}"
    if not _folders(spark, path):
        return infer_types(merge_counts(spark.createDataFrame([], COUNTED)))
    done = read_ledger(spark, sink).select("run", "batch_id").distinct()
    counts = spark.read.schema(COUNTED).parquet(path).join(done, ["run", "batch_id"], "left_semi")
    return infer_types(merge_counts(counts))


def _remove_unfinished(spark: SparkSession, sink: str) -> None:
    done = {f for f in _folders(spark, f"{sink}/{LEDGER}") if _finished(spark, f"{sink}/{LEDGER}/{f}")}
    for folder in _folders(spark, sink) - done:
        remove_staged(spark, f"{sink}/{folder}")


def _finished(spark: SparkSession, folder: str) -> bool:
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


def ingest_stream(
    spark: SparkSession,
    landing: str,
    schema: T.StructType | Iterable[str],
    transform: Callable[[DataFrame], DataFrame],
    sink: str,
    checkpoint: str,
    trigger: Mapping[str, object] = ONCE,
    sep: str = ",",
    na_tokens: Iterable[str] = NA_TOKENS,
    multiline: bool = False,
    line_sep: str | None = None,
    max_files_per_trigger: int | None = None,
    encoding: str = "UTF-8",
    profile: bool = False,
) -> StreamingQuery:
    """Start reading the CSV files under `landing` and writing `transform` of them to `sink`.

    `schema` names the columns of the files; they arrive as text.  Each file's own header is looked at
    before any row of its batch is written: its columns may stand in another order, but a file with other
    names, fewer or more, or without a header stops the stream at its batch.  With `multiline` the
    files' line end must be given, as there may be no file yet to see it in.  Both `sink` and `checkpoint`
    must be on storage all executors share.

    With `profile`, each batch also stores its counts of types per column, a few rows (`read_profile`).

    A file is known by its path, as Spark's file streams know it: written anew under the same path it is
    not taken again.
    """
    if multiline and line_sep is None:
        raise ValueError("a multiline stream needs line_sep")
    given = schema.names if isinstance(schema, T.StructType) else list(schema)
    names = dedupe_header(given)
    reader = spark.readStream
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    options = csv_options(sep, multiline, line_sep, encoding)
    # Only the files' names are asked for, so no file is opened here.
    listed = reader.schema(FILES).format("binaryFile").load(landing).select(F.col("_metadata.file_path").alias("file"))
    tokens = tuple(na_tokens)
    _remove_unfinished(spark, sink)

    def replace_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        found = staging_path(session, "stream-files")
        try:
            with small_methods(session):
                take(batch, batch_id, found)
        finally:
            remove_staged(session, found)

    def take(batch: DataFrame, batch_id: int, found: str) -> None:
        session = batch.sparkSession
        run = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        own = f"run={run}/batch_id={batch_id}"
        others = read_ledger(session, sink).where((F.col("run") != run) | (F.col("batch_id") != batch_id))
        # The names of a batch's files, which the stream's source holds in the driver as well.
        new = batch.distinct().join(others.select("file"), "file", "left_anti")
        files = [as_path(r["file"]) for r in new.collect()]
        if files:
            counted = count_rows(session, files, options)
            counted.join(file_headers(session, files, encoding), "file", "left").select("file", "header", "rows").write.parquet(found)
        else:
            session.createDataFrame([], FOUND).write.parquet(found)
        # A row per file that has rows.
        taken = session.read.schema(FOUND).parquet(found)
        files = [as_path(r["file"]) for r in taken.select("file").collect()]
        headers = taken.select("file", "header").where(F.col("header").isNotNull())
        moved, orders = header_orders(session, headers, names, options)
        if files:
            fresh = read_lines_checked(session.read, files, names, sep, options, moved, orders)
        else:
            fresh = session.createDataFrame([], T.StructType([T.StructField(n, T.StringType()) for n in names]))
        if tokens:
            fresh = normalize_nulls(fresh, tokens)
        if profile and files:
            watched, seen = watch_types(fresh)
            transform(watched).write.mode("overwrite").parquet(f"{sink}/{own}")
            counts = watched_types(session, seen, taken.agg(F.sum("rows")).first()[0])
            # A transform that takes rows more than once, or not all, costs a pass of its own.
            counts = count_types(fresh) if counts is None else counts
        else:
            transform(fresh).write.mode("overwrite").parquet(f"{sink}/{own}")
            counts = count_types(fresh) if profile else None
        if profile:
            counts.write.mode("overwrite").parquet(f"{sink}/{PROFILE}/{own}")
        taken.write.mode("overwrite").parquet(f"{sink}/{LEDGER}/{own}")

    return (
        listed.writeStream.foreachBatch(replace_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
