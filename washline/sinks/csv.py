"""Headered CSV objects."""

from __future__ import annotations

from pyspark.sql import DataFrame

from washline.sinks.replace import replace_folder
from washline.sources.csv import object_path, spark_sep

ROWS_PER_UNSPLITTABLE_FILE = 100_000
GZIP_LEVEL = {"zlib.compress.level": "FOUR"}  # Hadoop's own level, SIX, takes half as long again and saves a fifteenth


def write_object_csv(
    df: DataFrame,
    root: str,
    bucket: str,
    key: str,
    sep: str = ",",
    max_records_per_file: int = 0,
    compression: str | None = None,
) -> str:
    """Write the table under bucket and key, replacing what is there; returns the location.

    What was there stays until the new object is complete.  It is a directory of part files with a header each, written in parallel.  Nulls are
    empty fields and outer blanks are kept.  Set `max_records_per_file` when texts hold line
    breaks: such files cannot be split by readers, so their size sets the readers' parallelism.  The same holds for
    files with a `compression`, such as gzip, which are kept to `ROWS_PER_UNSPLITTABLE_FILE` rows unless told otherwise;
    readers know them by their names.
    """
    path = object_path(root, bucket, key)
    if compression and not max_records_per_file:
        max_records_per_file = ROWS_PER_UNSPLITTABLE_FILE
    # An empty line is no row, so a lone column needs its quotes to keep missing values.
    quote_all = len(df.columns) == 1
    writer = df.write.options(
        header="true",
        sep=spark_sep(sep),
        quote='"',
        escape='"',
        nullValue="",
        quoteAll=str(quote_all).lower(),
        lineSep="\n",
        ignoreLeadingWhiteSpace="false",
        ignoreTrailingWhiteSpace="false",
        timestampNTZFormat="yyyy-MM-dd HH:mm:ss.SSSSSS",
        timestampFormat="yyyy-MM-dd HH:mm:ss.SSSSSSXXX",
        maxRecordsPerFile=max_records_per_file,
        compression=compression or "none",
        **GZIP_LEVEL,
    )
    replace_folder(df.sparkSession, path, writer.csv)
    return path
