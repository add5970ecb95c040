"""Session settings this package is tuned for.

The caller applies them.  Only the limit on compiled methods is also set by the jobs that clean and write
whole tables, while they run (`small_methods`), as without it they take three times as long; and two settings by the
passes of a row index (`freed_shuffles`, `open_files`).
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import SparkSession

METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"

RECOMMENDED = {
    # Compiled methods above 8000 bytes are never optimised by the JVM and run many times slower.
    # With this limit Spark runs such a stage operator by operator, in small methods.
    METHOD_LIMIT: "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


@contextmanager
def small_methods(spark: SparkSession) -> Iterator[None]:
    """Within it, Spark runs no compiled method that the JVM would refuse to optimise.

    A lower limit of the session stays, and the session has its own limit again afterwards.
    """
    before, limit = spark.conf.get(METHOD_LIMIT), RECOMMENDED[METHOD_LIMIT]
    if int(before) <= int(limit):
        yield
        return
    with _set(spark, METHOD_LIMIT, limit):
        yield


def freed_shuffles(spark: SparkSession) -> AbstractContextManager[None]:
    """Within it, Spark deletes a job's shuffled rows once the job has ended, not when the driver collects its garbage."""
    return _set(spark, FREE_SHUFFLES, "true")


def open_files(spark: SparkSession, number: int) -> AbstractContextManager[None]:
    """Within it, a task that writes up to so many folders keeps a file open in each, and does not sort its rows."""
    # Spark begins to sort with the last file of its limit.
    return _set(spark, OPEN_FILES, str(number + 1))


@contextmanager
def _set(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)
