"""Where intermediate tables go.

A plan that must read a computed table twice, or hand it from one job to the next, writes it
to a folder every executor can reach, so a lost executor costs a re-read and never the result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"


def staging_root(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`, else one in the session's warehouse.

    On a cluster the warehouse must not be a local folder, which other machines do not see; there the
    setting has to be given.
    """
    shared = spark.conf.get(SETTING, None)
    if not shared:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        local = spark.conf.get("spark.master", "local").startswith("local") and "cluster" not in spark.conf.get("spark.master", "")
        if not local and warehouse.startswith(("file:", "/")):
            raise ValueError(f"set {SETTING} to a folder that all machines share; {warehouse} is local")
        shared = f"{warehouse}/staging"
    return shared.rstrip("/")


def staging_path(spark: SparkSession, purpose: str) -> str:
    """A new, unused path under the staging root."""
    return f"{staging_root(spark)}/washline/{purpose}-{uuid.uuid4().hex}"


def _found(spark: SparkSession, path: str):
    """The path and its file system."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def remove_staged(spark: SparkSession, path: str) -> None:
    """Delete a staged table, or a file of one, that nothing will read again."""
    folder, system = _found(spark, path)
    system.delete(folder, True)


def staged_size(spark: SparkSession, path: str) -> int:
    """Bytes of a staged table."""
    folder, system = _found(spark, path)
    return system.getContentSummary(folder).getLength()


def staged_files(spark: SparkSession, path: str) -> list[str]:
    """Paths of a staged table's files; there are as many as tasks wrote it."""
    folder, system = _found(spark, path)
    names = (status.getPath().getName() for status in system.listStatus(folder))
    return sorted(f"{path}/{name}" for name in names if not name.startswith(("_", ".")))
