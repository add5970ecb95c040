"""Typed conversion of columns. All narrow."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from washline.functions import parse_bigint, parse_date, parse_double, raise_if_unparsed
from washline.functions.parsing import is_date_given
from washline.names import as_list, column


def _type_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def to_text(
    df: DataFrame, cols: str | Iterable[str], null_token: str | None = None
) -> DataFrame:
    """Cast to text; with `null_token`, missing values (null, NaN) become that text."""

    def text(c: str) -> Column:
        value = column(c).cast("string")
        if null_token is None:
            return value
        if isinstance(_type_of(df, c), (T.FloatType, T.DoubleType)):
            value = F.when(~F.isnan(column(c)), value)
        return F.coalesce(value, F.lit(null_token))

    return df.withColumns({c: text(c) for c in as_list(cols)})


def to_bigint(df: DataFrame, cols: str | Iterable[str], mode: str = "coerce") -> DataFrame:
    """Nullable 64-bit integers; what is no whole number in range is null, or an error."""

    def whole(c: str) -> Column:
        value = column(c)
        if isinstance(_type_of(df, c), (T.FloatType, T.DoubleType, T.DecimalType)):
            value_or_null = F.when(value == F.floor(value), value.try_cast("bigint"))
        else:
            value_or_null = parse_bigint(value)
        problem = f"column {c} holds something that is no 64-bit integer"
        return raise_if_unparsed(value_or_null, value.isNotNull(), problem, mode)

    return df.withColumns({c: whole(c) for c in as_list(cols)})


def to_double(df: DataFrame, cols: str | Iterable[str], mode: str = "raise") -> DataFrame:
    """Doubles; a column that is a double already costs nothing."""
    names = as_list(cols)
    texts = [c for c in names if isinstance(_type_of(df, c), T.StringType)]
    others = {
        c: column(c).cast("double")
        for c in names
        if c not in texts and not isinstance(_type_of(df, c), T.DoubleType)
    }
    if others:
        df = df.withColumns(others)
    if not texts:
        return df
    return df.withColumns(
        {
            c: raise_if_unparsed(
                parse_double(column(c)),
                column(c).isNotNull(),
                f"column {c} holds text that is no number",
                mode,
            )
            for c in texts
        }
    )


def to_timestamp_fmt(
    df: DataFrame, cols: str | Iterable[str], fmt: str = "yyyy-M-d", mode: str = "raise"
) -> DataFrame:
    """Zone-less timestamps from date text. Outer blanks are not a date: trim first."""

    def stamp(c: str) -> Column:
        text = column(c)
        problem = f"column {c} holds text that is no date of the form {fmt}"
        return raise_if_unparsed(parse_date(text, fmt), is_date_given(text), problem, mode)

    texts = [c for c in as_list(cols) if isinstance(_type_of(df, c), T.StringType)]
    others = [c for c in as_list(cols) if c not in texts]
    return df.withColumns(
        {c: stamp(c) for c in texts} | {c: column(c).cast("timestamp_ntz") for c in others}
    )
