"""Text cleaning expressions. A null stays null in all of them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from washline.functions.fixed_values import CURRENCY_MARKS, NA_TOKENS, WHITESPACE


def keep_alphanumeric(text: Column, keep_space: bool = False) -> Column:
    """Drop everything but ASCII letters and digits (and the plain space on request).

    The named class means a-z, A-Z, 0-9; spelled out as three ranges it runs ten times slower.
    """
    pattern = r"[^\p{Alnum} ]" if keep_space else r"\P{Alnum}"
    return F.regexp_replace(text, pattern, "")


def keep_digits(text: Column) -> Column:
    """Drop everything but the digits 0-9, so sign, dot and exponent go too."""
    return F.regexp_replace(text, "[^0-9]", "")


def strip_currency_marks(text: Column) -> Column:
    """Drop dollar signs and thousands commas."""
    for mark in CURRENCY_MARKS:
        text = F.replace(text, F.lit(mark), F.lit(""))
    return text


def trim_whitespace(text: Column) -> Column:
    """Trim every Unicode white-space character from both ends, not only the plain space."""
    return F.btrim(text, F.lit(WHITESPACE))


def null_if_token(text: Column, tokens: Iterable[str] = NA_TOKENS) -> Column:
    """Null where the whole, untrimmed text is one of `tokens`."""
    return F.when(~text.isin(*tokens), text)


def sha256_hex(value: Column) -> Column:
    """SHA-256 of a text or binary value as lower-case hex."""
    return F.sha2(value, 256)
