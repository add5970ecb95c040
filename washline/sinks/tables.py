"""Create-or-replace tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from washline.operators.row_index import write_indexed
from washline.sinks.replace import replace_folder
from washline.staging import remove_staged, staging_path


def _write_rows(df: DataFrame, path: str, index_by: str | Iterable[str] | None, **options) -> None:
    """Write the rows, with their index, to a new folder."""

    def add(rows: DataFrame) -> None:
        rows.write.mode("append").options(**options).parquet(path)

    add(df) if index_by is None else write_indexed(df, index_by, add)


def write_table(
    df: DataFrame, path: str, index_by: str | Iterable[str] | None = None, compression: str | None = None
) -> DataFrame:
    """Replace the Parquet table at `path`; with `index_by` a leading `index` column 0..n-1.

    What was there stays until the new table is complete, so a failed write keeps it, and `df` may
    be computed from it.  `compression` is the session's unless given.
    """
    spark = df.sparkSession
    options = {"compression": compression} if compression else {}
    replace_folder(spark, path, lambda new: _write_rows(df, new, index_by, **options))
    index = [] if index_by is None else [T.StructField("index", T.LongType())]
    return spark.read.schema(T.StructType([*index, *df.schema.fields])).parquet(path)


def write_branches(routed: DataFrame, path: str, branches: Iterable[str]) -> dict[str, DataFrame]:
    """Write the branches of a routed table in one pass over it, and return each as a table.

    Below `path` there is a folder `branch=<name>` for every name in `branches`, also for one that no row
    chose: that holds a file without rows.  A row of a branch not named is an error.  As in
    `write_table`, what was at `path` stays until all branches are complete, so they change together.

    Rows are not shuffled; each task writes a file per branch it meets, so a branch holding most rows
    is written by all tasks.  The returned tables have no `branch` column.
    """
    spark = routed.sparkSession
    names = list(dict.fromkeys(branches))
    if not names:
        raise ValueError("write_branches needs at least one branch")
    stranger = F.raise_error(F.concat(F.lit("branch not among those written: "), F.coalesce("branch", F.lit("null"))))
    checked = routed.withColumn("branch", F.when(F.col("branch").isin(names), F.col("branch")).otherwise(stranger.cast("string")))
    rows = [f for f in routed.schema.fields if f.name != "branch"]
    empty = spark.createDataFrame([], T.StructType(rows))

    def write(new: str) -> None:
        checked.write.partitionBy("branch").parquet(new)
        hadoop = spark._jvm.org.apache.hadoop.fs
        system = hadoop.Path(new).getFileSystem(spark._jsc.hadoopConfiguration())
        escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        for name in names:
            folder = f"{new}/branch={escape(name)}"
            if not system.exists(hadoop.Path(folder)):
                empty.write.parquet(folder)

    replace_folder(spark, path, write)
    schema = T.StructType([*rows, T.StructField("branch", T.StringType())])
    stored = spark.read.schema(schema).parquet(path)
    return {name: stored.where(F.col("branch") == name).drop("branch") for name in names}


def write_table_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str],
    index_by: str | Iterable[str] | None = None,
    max_connections: int = 16,
    batch_size: int = 10_000,
) -> None:
    """Replace a relational table: drop, create from the DataFrame's schema, insert.

    `max_connections` bounds the number of tasks that insert at once and `batch_size` the rows
    per round trip.  Each task commits on its own, so a failed write leaves a partial table and
    is repaired by running it again.  Credentials belong in `properties` and are never logged.

    The rows are stored first, so that reading and computing them keeps its own partitions and
    the few inserting tasks only read the stored copy, which is deleted afterwards.
    """
    spark = df.sparkSession
    path = staging_path(spark, "jdbc")
    try:
        _write_rows(df, path, index_by)
        out = spark.read.parquet(path)
        (
            out.write.mode("overwrite")
            .option("numPartitions", max_connections)
            .option("batchsize", batch_size)
            .jdbc(url, table, properties=dict(properties))
        )
    finally:
        remove_staged(spark, path)
