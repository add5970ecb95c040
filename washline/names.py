"""Column references and type-based column choice."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def column(name: str) -> Column:
    """The top-level column called exactly `name`, even when the name holds dots or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def string_columns(df: DataFrame) -> list[str]:
    """Names of all text columns, decided from the schema alone."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def as_list(names: str | Iterable[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)
