"""A look at a few rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from washline.names import as_list, column


def preview(df: DataFrame, n: int = 5, order_by: str | Iterable[str] | None = None) -> DataFrame:
    """The first n rows: in the given order as a distributed top-n, else any n rows."""
    if order_by is not None:
        df = df.orderBy(*[column(c) for c in as_list(order_by)])
    return df.limit(n)
