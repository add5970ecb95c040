"""Type inference over whole columns.

One aggregation pass decides all columns: each task sends one row of counts per column, so the
shuffle stays small, whatever the data size.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from washline.functions import parse_bigint, parse_double, raise_if_unparsed
from washline.functions.fixed_values import FALSE_TOKENS, TRUE_TOKENS
from washline.functions.parsing import DECIMAL, INFINITY
from washline.names import column, string_columns

INT, FLOAT, BOOL, TEXT = "i", "f", "b", "s"
COUNTS = ("n", "n_int", "n_float", "n_bool")


def _kind(text: Column) -> Column:
    """What one text is; null for null.

    Whole numbers beyond 64 bits and decimals beyond a double's range are text: reading them as
    doubles would lose digits.
    """
    fits_bigint = text.try_cast("bigint").isNotNull()
    # Without an exponent, only more digits than these can leave a double's range.
    exponent = F.contains(text, F.lit("e")) | F.contains(text, F.lit("E"))
    fits_double = (~exponent & (F.octet_length(text) < 300)) | (F.abs(text.try_cast("double")) < float("inf"))
    # Most texts are ruled out as numbers by their first character, and a number takes one match: a decimal
    # without a point and an exponent is a whole number.
    like_a_number = F.ascii(text).isin(*map(ord, "\t\n\x0b\f\r +-.0123456789iI"))
    number = (
        F.when(
            text.rlike(DECIMAL),
            F.when(~F.contains(text, F.lit(".")) & ~exponent, F.when(fits_bigint, INT).otherwise(TEXT))
            .when(fits_double, FLOAT)
            .otherwise(TEXT),
        )
        .when(text.rlike(INFINITY), FLOAT)
        .otherwise(TEXT)
    )
    return (
        F.when(like_a_number, number)
        .when(text.isin(*TRUE_TOKENS, *FALSE_TOKENS), BOOL)
        .when(text.isNotNull(), TEXT)
    )


def count_types(df: DataFrame, by: str | None = None) -> DataFrame:
    """What a profile is made of: column, n (not null), n_int, n_float, n_bool, per text column.

    With `by`, a column of `df` that is not counted itself, a row per value of it and column; else a
    row per column, also for a table without rows.  Counts of parts add up to those of the whole.
    """
    names = [n for n in string_columns(df) if n != by]
    if not names:
        raise ValueError("a profile needs at least one text column")
    group = [] if by is None else [by]
    # One row per cell and one CASE for all columns: its compiled code stays small, however
    # wide the table is.  The cells are counted where they arise and never shuffled.
    texts = F.posexplode(F.array(*[column(n) for n in names])).alias("place", "text")
    cells = df.select(*[column(g).alias("part") for g in group], texts)
    parts = ["part"] if group else []
    kinds = cells.select(*parts, "place", _kind(F.col("text")).alias("kind"))
    found = kinds.groupBy(*parts, "place").agg(
        F.count("kind").alias("n"),
        F.count_if(F.col("kind") == INT).alias("n_int"),
        F.count_if(F.col("kind").isin(INT, FLOAT)).alias("n_float"),
        F.count_if(F.col("kind") == BOOL).alias("n_bool"),
    )
    if group:
        name = F.array(*[F.lit(n) for n in names])[F.col("place")]
        return found.select(F.col("part").alias(by), name.alias("column"), *COUNTS)
    # A table without rows has no cells, yet each of its columns gets a line.
    every = df.sparkSession.range(1).select(
        F.posexplode(F.array(*[F.lit(n) for n in names])).alias("place", "column")
    )
    return every.join(found, "place", "left").select(
        "column", *[F.coalesce(c, F.lit(0)).alias(c) for c in COUNTS]
    )


def watch_types(df: DataFrame) -> tuple[DataFrame, Observation]:
    """`df`, and an observation of its `count_types`, taken as its rows go by; `watched_types` gives them.

    Complete after the first action that evaluates every row once, such as the write of a row-by-row
    conversion.
    """
    names = string_columns(df)
    if not names:
        raise ValueError("a profile needs at least one text column")
    kinds = {f"__kind_{i}": _kind(column(n)) for i, n in enumerate(names)}
    if clash := [k for k in kinds if k in df.columns]:
        raise ValueError(f"column names used here: {clash}")
    counts = [F.count("*").alias("rows")]
    for i, k in enumerate(kinds):
        counts.append(F.count(k).alias(f"n_{i}"))
        counts.append(F.count_if(F.col(k) == INT).alias(f"n_int_{i}"))
        counts.append(F.count_if(F.col(k).isin(INT, FLOAT)).alias(f"n_float_{i}"))
        counts.append(F.count_if(F.col(k) == BOOL).alias(f"n_bool_{i}"))
    seen = Observation()
    seen.columns = names
    return df.withColumns(kinds).observe(seen, *counts).drop(*kinds), seen


def watched_types(spark: SparkSession, seen: Observation, rows: int) -> DataFrame | None:
    """The counts that were watched, a row per column; None if it was not `rows` rows that went by."""
    try:
        found = seen.get
    except Py4JJavaError:  # Spark left the rows out, as none of them can be in the result
        return None
    if found.get("rows") != rows:
        return None
    lines = [(n, *(found[f"{c}_{i}"] for c in COUNTS)) for i, n in enumerate(seen.columns)]
    return spark.createDataFrame(lines, "column string, " + ", ".join(f"{c} bigint" for c in COUNTS))


def merge_counts(counts: DataFrame) -> DataFrame:
    """Counts of parts (column, n, n_int, n_float, n_bool) added up to a row per column."""
    return counts.groupBy("column").agg(*[F.sum(c).alias(c) for c in COUNTS])


def infer_types(counts: DataFrame) -> DataFrame:
    """Adds `inferred` to a row of counts per column.

    The first type of bigint, double, boolean that every present value fits wins, else string;
    a column without any value is a double.
    """
    ladder = [("n_int", "bigint"), ("n_float", "double"), ("n_bool", "boolean")]
    inferred = reduce(
        lambda chain, rung: chain.when(F.col(rung[0]) == F.col("n"), rung[1]),
        ladder,
        F.when(F.col("n") == 0, "double"),
    ).otherwise("string")
    return counts.withColumn("inferred", inferred)


def profile_types(df: DataFrame) -> DataFrame:
    """One row per text column: column, n (not null), n_int, n_float, n_bool, inferred."""
    return infer_types(count_types(df))


def apply_types(
    df: DataFrame, profile: DataFrame | Mapping[str, str], mode: str = "raise"
) -> DataFrame:
    """Cast text columns to the types of a profile (a few rows: one per column).

    A profile of the same data fits by construction.  Where it is older than the data, a text
    that does not fit is an error, or null with mode='coerce'.
    """
    types = inferred_types(profile) if isinstance(profile, DataFrame) else profile

    def typed(name: str, dtype: str) -> Column:
        text = column(name)
        if dtype == "bigint":
            value = parse_bigint(text)
        elif dtype == "double":
            value = parse_double(text)
        elif dtype == "boolean":
            value = F.when(text.isin(*TRUE_TOKENS), True).when(text.isin(*FALSE_TOKENS), False)
        else:
            raise ValueError(f"type of column {name} must be one of the profile's, not {dtype!r}")
        return raise_if_unparsed(
            value, text.isNotNull(), f"column {name} holds text that is no {dtype}", mode
        )

    changes = {name: typed(name, t) for name, t in types.items() if t != "string"}
    return df.withColumns(changes) if changes else df


def inferred_types(profile: DataFrame) -> dict[str, str]:
    """The decided types by column name; bounded by the number of columns, not by the data."""
    return {r["column"]: r["inferred"] for r in profile.select("column", "inferred").collect()}
