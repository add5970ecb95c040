"""Scalar arithmetic on columns, independent of the session's ANSI setting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from washline.functions.parsing import COERCE, RAISE, check_mode


def _checked(result: Column, x: Column, y: Column, problem: str, mode: str) -> Column:
    check_mode(mode)
    if mode == COERCE:
        return result
    both_given = x.isNotNull() & y.isNotNull()
    return F.coalesce(result, F.when(both_given, F.raise_error(F.lit(problem))))


def _wide(x: Column, dtype: str | None) -> Column:
    """The column in `dtype`; without one, integers as bigint and fractional types as they are."""
    return x.cast(dtype) if dtype else x + F.lit(0).cast("bigint")


def add(x: Column, y: Column, mode: str = RAISE, dtype: str | None = None) -> Column:
    """x + y in `dtype`; overflow is an error, or null with mode='coerce'.

    Without `dtype` integers are added as bigint, and fractions are kept.
    """
    total = F.try_add(_wide(x, dtype), _wide(y, dtype))
    return _checked(total, x, y, "overflow in addition", mode)


def multiply(x: Column, y: Column, mode: str = RAISE, dtype: str | None = None) -> Column:
    """x * y in `dtype`; overflow is an error, or null with mode='coerce'; types as in `add`."""
    product = F.try_multiply(_wide(x, dtype), _wide(y, dtype))
    return _checked(product, x, y, "overflow in multiplication", mode)


def divide(x: Column, y: Column, mode: str = RAISE) -> Column:
    """True division, always a double; a zero divisor is an error, or null with mode='coerce'."""
    quotient = F.try_divide(x.cast("double"), y.cast("double"))
    return _checked(quotient, x, y, "division by zero", mode)


def modulo(x: Column, n: int) -> Column:
    """Remainder of x by a positive constant, never negative."""
    if n <= 0:
        raise ValueError("modulo needs a positive constant")
    return F.pmod(x, F.lit(n))


def hour_of(ts: Column) -> Column:
    """Hour of a timestamp as an integer 0..23."""
    return F.hour(ts)


def round_half_even(value: Column, scale: int = 2) -> Column:
    """Round a double to `scale` decimals, ties (of the scaled binary value) to even.

    `round` rounds ties away from zero and `bround` works on the decimal text of the value;
    both give other results than scaling, `rint` and scaling back.
    """
    factor = F.lit(float(10**scale))
    return F.rint(value * factor) / factor
