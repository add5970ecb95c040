"""Column-level building blocks: each takes Columns and returns a Column."""

from washline.functions.arithmetic import add, divide, hour_of, modulo, multiply, round_half_even
from washline.functions.parsing import parse_bigint, parse_date, parse_double, raise_if_unparsed
from washline.functions.text import (
    keep_alphanumeric,
    keep_digits,
    null_if_token,
    sha256_hex,
    strip_currency_marks,
    trim_whitespace,
)

__all__ = [
    "add",
    "divide",
    "hour_of",
    "keep_alphanumeric",
    "keep_digits",
    "modulo",
    "multiply",
    "null_if_token",
    "parse_bigint",
    "parse_date",
    "parse_double",
    "raise_if_unparsed",
    "round_half_even",
    "sha256_hex",
    "strip_currency_marks",
    "trim_whitespace",
]
