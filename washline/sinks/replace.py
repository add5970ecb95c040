"""Replacing a folder only once its successor is complete."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from washline.settings import small_methods


def replace_folder(spark: SparkSession, path: str, write: Callable[[str], object]) -> None:
    """Let `write` fill a new folder beside `path`, then put it in the place of what is there.

    If the write fails, what was there stays as it is and the new folder is removed.  So a table may also be
    replaced by something computed from it.  The switch is two renames; where a store copies
    on rename (S3), it takes as long as the copy, and a failure in between leaves the old folder under a
    hidden name beside `path` and the new one, complete, under another.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path.rstrip("/"))
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    target = system.makeQualified(target)
    mark = uuid.uuid4().hex
    # Names that start with an underscore are no data to Spark's readers.
    new, old = (hadoop.Path(target.getParent(), f"_{target.getName()}.{kind}-{mark}") for kind in ("new", "old"))
    try:
        with small_methods(spark):
            write(new.toString())
    except BaseException:
        system.delete(new, True)
        raise
    system.mkdirs(target.getParent())
    held = system.exists(target)
    if held and not system.rename(target, old):
        raise OSError(f"cannot move {target} aside; the new rows are in {new}")
    if not system.rename(new, target):
        if held:
            system.rename(old, target)
        raise OSError(f"cannot move {new} to {target}")
    system.delete(old, True)
    spark.catalog.refreshByPath(path)
