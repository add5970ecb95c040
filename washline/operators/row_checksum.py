"""Checksums of text columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from washline.functions import sha256_hex
from washline.names import as_list, column


def row_checksum(df: DataFrame, cols: str | Iterable[str], suffix: str = "_sha256") -> DataFrame:
    """Add the SHA-256 of each given column's whole text as `<column><suffix>`."""
    return df.withColumns({f"{c}{suffix}": sha256_hex(column(c).cast("string")) for c in as_list(cols)})
