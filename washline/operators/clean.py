"""Text and money cleaning. All narrow: no shuffle, one pass, inside code generation.

Non-text columns are cast to text first, so data that is already clean passes too.  A fractional
column is written as whole numbers, 12.0 as 12; a value that is none raises, or is null with
mode='coerce'.  NaN is missing, so null.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from washline.functions import (
    keep_alphanumeric,
    keep_digits,
    parse_double,
    raise_if_unparsed,
    round_half_even,
    strip_currency_marks,
    trim_whitespace,
)
from washline.functions.parsing import COERCE, check_mode
from washline.names import as_list, column, string_columns


def _as_text(df: DataFrame, name: str, mode: str) -> Column:
    check_mode(mode)
    value = column(name)
    kind = df.select(value).schema[0].dataType
    if not isinstance(kind, (T.FractionalType, T.DecimalType)):
        return value.cast("string")
    known = value if isinstance(kind, T.DecimalType) else F.nanvl(value, F.lit(None).cast(kind))
    whole = F.when((F.abs(known) < 1e38) & (F.floor(known) == known), known.try_cast("decimal(38,0)"))
    if mode == COERCE:
        return whole.cast("string")
    problem = F.raise_error(F.lit(f"column {name} holds a number that is not whole")).cast("string")
    return F.coalesce(whole.cast("string"), F.when(known.isNotNull(), problem))


def strip_specials(
    df: DataFrame, cols: str | Iterable[str], keep_space: bool = False, mode: str = "raise"
) -> DataFrame:
    """Keep ASCII letters and digits (and spaces with `keep_space`) in the given columns."""
    return df.withColumns(
        {c: keep_alphanumeric(_as_text(df, c, mode), keep_space) for c in as_list(cols)}
    )


def digits_only(df: DataFrame, cols: str | Iterable[str], mode: str = "raise") -> DataFrame:
    """Keep the digits 0-9 in the given columns; the result is still text."""
    return df.withColumns({c: keep_digits(_as_text(df, c, mode)) for c in as_list(cols)})


def parse_currency(
    df: DataFrame, cols: str | Iterable[str], scale: int = 2, mode: str = "raise"
) -> DataFrame:
    """`$1,234.567` to the double 1234.57: strip marks, parse, round half to even."""
    names = as_list(cols)
    # Two steps, so the stripped text is computed once and not once per use in the parser.
    stripped = df.withColumns({c: strip_currency_marks(column(c).cast("string")) for c in names})
    return stripped.withColumns(
        {
            c: round_half_even(
                raise_if_unparsed(
                    parse_double(column(c)),
                    column(c).isNotNull(),
                    f"column {c} holds text that is no amount of money",
                    mode,
                ),
                scale,
            )
            for c in names
        }
    )


def trim_strings(df: DataFrame, cols: str | Iterable[str] | None = None) -> DataFrame:
    """Trim white space at both ends; by default in every text column of the schema."""
    names = string_columns(df) if cols is None else as_list(cols)
    return df.withColumns({c: trim_whitespace(column(c).cast("string")) for c in names})
