"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from washline.names import column
from washline.staging import staging_path

#: Rows that a Python worker turns into Python objects at a time.
SLICE = 512

#: Sorts null keys before all others.
LEAST = -(1 << 63)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table to the shared folder and read it from there, so that no lost executor repeats it."""
    path = staging_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a table made by `stage`, once nothing will read it again."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(column(name).cast("string"), F.lit(""))


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def range_bucket(df: DataFrame, key: str, buckets: int) -> Column:
    """An integer that grows with the bigint column `key` and parts its rows about evenly.

    The bounds are approximate percentiles of the whole column, at most `buckets` - 1 numbers.
    They are fixed in the returned expression, so a repeated task deals rows out as before.
    Null keys are in bucket -1.
    """
    shares = [i / buckets for i in range(1, buckets)]
    found = df.agg(F.percentile_approx(column(key).cast("bigint"), shares)).first()[0] if shares else []
    bounds = sorted(set(found or []))

    def tree(low: int, high: int) -> str:
        if low == high:
            return str(low)
        middle = (low + high) // 2
        bound = bounds[middle]
        return f"if({name} < {bound}L, {tree(low, middle)}, {tree(middle + 1, high)})"

    name = "`" + key.replace("`", "``") + "`"
    return F.when(column(key).isNull(), -1).otherwise(F.expr(tree(0, len(bounds)))).cast("int")


def with_fields(schema: T.StructType, **types: T.DataType) -> T.StructType:
    return T.StructType([*schema.fields, *(T.StructField(n, t) for n, t in types.items())])
