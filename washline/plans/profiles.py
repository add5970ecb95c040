"""Type profiles of growing folders: counts per file, stored once and added up.

The store is a folder of Parquet tables, one per update, with a row per file and column:

    file, length, modified, column, n, n_int, n_float, n_bool

A file without rows has one row whose column is null.  A file counts as known while its length and time are
those of the store, so one that was written anew is counted anew, and one that is gone no longer counts.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from washline.functions.fixed_values import NA_TOKENS
from washline.operators.missing import normalize_nulls
from washline.operators.profile import COUNTS, count_types, infer_types, merge_counts
from washline.sinks.replace import replace_folder
from washline.sources.csv import (
    as_path,
    csv_options,
    file_headers,
    header_orders,
    read_header,
    read_lines_checked,
)
from washline.staging import remove_staged, staging_path

ROWS = "file string, length bigint, modified timestamp, column string, " + ", ".join(f"{c} bigint" for c in COUNTS)
FILE = "__file"
KNOWN_BY = ["file", "length", "modified"]


def _listed(spark: SparkSession, path: str) -> DataFrame:
    """The files that Spark's readers find at a path; their contents are not read."""
    meta = "_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time"
    found = spark.read.format("binaryFile").load(path)
    return found.select(*[F.col(m).alias(k) for m, k in zip(meta, KNOWN_BY, strict=True)])


def _stored(spark: SparkSession, store: str) -> DataFrame:
    top = spark._jvm.org.apache.hadoop.fs.Path(f"{store}/update-*")
    if not top.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(top):
        return spark.createDataFrame([], ROWS)
    rows = spark.read.schema(ROWS).option("recursiveFileLookup", "true").parquet(store)
    # Two updates at once may both have counted a file, with the same counts.
    return rows.dropDuplicates([*KNOWN_BY, "column"])


def update_profile(
    spark: SparkSession,
    path: str,
    store: str,
    sep: str = ",",
    na_tokens: Iterable[str] = NA_TOKENS,
    multiline: bool = False,
    line_sep: str | None = None,
    encoding: str = "UTF-8",
) -> DataFrame:
    """Profile of the CSV files at `path`, reading only those that `store` does not know yet.

    Returns what `profile_types` gives for all files together: column, n, n_int, n_float, n_bool,
    inferred; `apply_types` and `read_csv_table(types=...)` take it.  Headers are checked and columns put in
    order file by file, as `read_csv_table` does, and an update with a wrong file changes nothing.
    `na_tokens` and the format must be the same at each update of a store.

    An update costs one scan of the new files and a shuffle of a row per file and column.  The names of
    the new files are in the driver, where Spark's reader holds them as well.  With `multiline` the line end
    must be given, as there may be no new file to see it in.
    """
    if multiline and line_sep is None:
        raise ValueError("a multiline profile needs line_sep")
    tokens = tuple(na_tokens)
    options = csv_options(sep, multiline, line_sep, encoding)
    names = read_header(spark, path, options)
    listing = staging_path(spark, "profile-files")
    _listed(spark, path).write.parquet(listing)
    try:
        files = spark.read.parquet(listing)
        new = files.join(_stored(spark, store), KNOWN_BY, "left_anti")
        fresh = [as_path(r["file"]) for r in new.select("file").collect()]
        if fresh:
            headers = file_headers(spark, fresh, encoding)
            moved, orders = header_orders(spark, headers, names, options)
            texts = read_lines_checked(spark.read, fresh, names, sep, options, moved, orders, with_file=FILE)
            if tokens:
                texts = normalize_nulls(texts, tokens, names)
            counts = count_types(texts, by=FILE).withColumnRenamed(FILE, "file")
            rows = new.join(counts, "file", "left").select(*KNOWN_BY, "column", *COUNTS)
            replace_folder(spark, f"{store}/update-{uuid.uuid4().hex}", rows.write.parquet)
        present = _stored(spark, store).join(files, KNOWN_BY, "left_semi").where(F.col("column").isNotNull())
        nothing = spark.range(1).select(
            F.explode(F.array(*[F.lit(n) for n in names])).alias("column"),
            *[F.lit(0).cast("bigint").alias(c) for c in COUNTS],
        )
        merged = merge_counts(present.select("column", *COUNTS).unionByName(nothing))
        # A row per column; taken now, as the listing they come from is removed.
        found = merged.where(F.col("column").isin(names)).collect()
        return infer_types(spark.createDataFrame(found, merged.schema))
    finally:
        remove_staged(spark, listing)
