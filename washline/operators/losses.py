"""Counting what a conversion loses, in the pass that converts."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from washline.names import as_list, column


def count_losses(
    df: DataFrame,
    cols: str | Iterable[str],
    convert: Callable[[DataFrame], DataFrame],
    given: Mapping[str, Column] | None = None,
) -> tuple[DataFrame, Observation]:
    """`convert(df)`, and an observation of the values of `cols` that it turned into nulls.

    `convert` works row by row and keeps the names in `cols`: the functions of this package with
    mode='coerce', one after another.  A value is lost if it was there before and is null after; `given`
    says per column when one was there, where that is not just "not null" (texts that mean "no date").

    Nothing is read twice: the counts are taken as the rows go by and are complete after the first action
    on the result that evaluates every row, such as a write; `losses_of` waits for it.  A later action
    does not change them.  Spark counts the rows of a stage again that it repeats after losing its shuffle
    files, so convert before shuffling and write first, as all cleaning here does.
    """
    names = as_list(cols)
    known = dict(given or {})
    if unknown := [c for c in (*names, *known) if c not in df.columns]:
        raise ValueError(f"no such columns: {unknown}")
    if not names:
        raise ValueError("count_losses needs at least one column")
    # Marks and not copies of the values, so the row grows by a bit per column.
    marks = {f"__given_{i}": known.get(c, column(c).isNotNull()) for i, c in enumerate(names)}
    if clash := [m for m in marks if m in df.columns]:
        raise ValueError(f"column names used here: {clash}")
    converted = convert(df.withColumns(marks))
    counts = []
    for i, c in enumerate(names):
        there = F.col(f"__given_{i}")
        counts.append(F.count_if(there).alias(f"given_{i}"))
        counts.append(F.count_if(there & column(c).isNull()).alias(f"lost_{i}"))
    seen = Observation()
    seen.columns = names
    return converted.observe(seen, *counts).drop(*marks), seen


def losses_of(seen: Observation) -> dict[str, tuple[int, int]]:
    """By column: how many values were there, and how many of them were lost."""
    found = seen.get
    return {c: (found[f"given_{i}"], found[f"lost_{i}"]) for i, c in enumerate(seen.columns)}
