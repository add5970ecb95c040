"""This package for Python workers, wherever they run."""

from __future__ import annotations

import os
import tempfile
import zipfile
from functools import cache
from pathlib import Path

from pyspark.sql import SparkSession


@cache
def _zipped() -> str:
    top = Path(__file__).parent
    out = os.path.join(tempfile.mkdtemp(), "washline-core.zip")
    with zipfile.ZipFile(out, "w") as archive:
        for file in sorted(top.rglob("*.py")):
            archive.write(file, file.relative_to(top.parent))
    return out


def ship_package(spark: SparkSession) -> None:
    """Send the package's code to all workers of the session, once."""
    context = spark.sparkContext
    if os.path.basename(_zipped()) not in context._python_includes:
        context.addPyFile(_zipped())
