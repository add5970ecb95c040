"""Missing-value texts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from washline.functions import null_if_token
from washline.functions.fixed_values import NA_TOKENS
from washline.names import as_list, column, string_columns


def normalize_nulls(
    df: DataFrame,
    tokens: Iterable[str] = NA_TOKENS,
    columns: str | Iterable[str] | None = None,
) -> DataFrame:
    """Null out texts that mean "missing": exact matches, so ` NA ` with blanks stays."""
    names = string_columns(df) if columns is None else as_list(columns)
    return df.withColumns({c: null_if_token(column(c), tokens) for c in names})
