"""Text to number or date.

The `parse_*` functions give null for text they cannot read, whatever the session's ANSI
setting.  `raise_if_unparsed` turns such nulls into errors, again in both settings.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from washline.functions.fixed_values import NO_DATE_TOKENS
from washline.functions.text import trim_whitespace

# What counts as a whole number, a decimal number and a date, outer blanks
# allowed for numbers; and the words for numbers that are not finite.
WHOLE_NUMBER = r"^\s*[+-]?[0-9]+\s*\z"
DECIMAL = r"^\s*[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\s*\z"
INFINITY = r"^\s*(?i:[+-]?inf(?:inity)?)\s*\z"
NOT_A_NUMBER = r"^\s*(?i:nan)\s*\z"
ISO_DATE = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\z"

RAISE = "raise"
COERCE = "coerce"


def check_mode(mode: str) -> None:
    if mode not in (RAISE, COERCE):
        raise ValueError(f"mode must be 'raise' or 'coerce', not {mode!r}")


def raise_if_unparsed(parsed: Column, given: Column, message: str, mode: str) -> Column:
    """`parsed`, but in raise mode an error where it is null and the boolean `given` holds.

    The error appears when an action evaluates the column: a write does, `count()` may not.  Its
    message is fixed text: building one from the row would swell the compiled code of every
    checked column.  The same job with mode='coerce' shows the rows.
    """
    check_mode(mode)
    if mode == COERCE:
        return parsed
    return F.coalesce(parsed, F.when(given, F.raise_error(F.lit(message))))


def is_date_given(text: Column) -> Column:
    """Whether a text says anything but "no date"; null for null."""
    return ~text.rlike(r"^(?:" + "|".join(NO_DATE_TOKENS) + r")\z")


def parse_double(text: Column) -> Column:
    """Double from text: decimal notation, exponents, the words nan, inf and infinity.

    Spark's own cast also reads Java suffixes and hex floats (`1.5d`, `0x1p3`); those are not
    numbers here.  The pattern decides alone, as a cast that fails costs an exception per row.
    Rare white space beyond the plain kind is trimmed only where the text did not match as it is.
    """

    def matched(candidate: Column) -> Column:
        return F.when(
            candidate.rlike(f"{DECIMAL}|{INFINITY}|{NOT_A_NUMBER}"), candidate.try_cast("double")
        )

    return F.coalesce(matched(text), matched(trim_whitespace(text)))


def parse_bigint(text: Column) -> Column:
    """64-bit integer from text, outer blanks allowed; exact, and null beyond 64 bits."""
    return F.when(text.rlike(WHOLE_NUMBER), text.try_cast("bigint"))


def parse_date(text: Column, fmt: str = "yyyy-M-d") -> Column:
    """Zone-less timestamp from date text; the no-date texts give null.

    The default format goes through the date cast, which knows no time zone and needs no
    formatter object.  The pattern keeps out what that cast accepts beyond it (years alone,
    signs, trailing times).  Other formats go through the CSV function with one field per text:
    it reads zone-less timestamps as such and gives null for others in every session.
    """
    if fmt == "yyyy-M-d":
        return F.when(text.rlike(ISO_DATE), text.try_cast("date").cast("timestamp_ntz"))
    one_field = F.when(is_date_given(text) & ~text.rlike(r"[\r\n\x01]"), text)
    options = {"timestampNTZFormat": fmt, "sep": "\x01", "quote": ""}
    return F.from_csv(one_field, "stamp timestamp_ntz", options)["stamp"]
