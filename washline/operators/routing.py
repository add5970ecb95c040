"""Conditional routing of rows to named branches, and merging branches again."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from washline.functions import hour_of, modulo
from washline.names import column


def _names(branches: Sequence[str]) -> Column:
    return F.array(*[F.lit(b) for b in branches]).cast("array<string>")


def _chosen(rules: Mapping[str, Column], default: Sequence[str], first_match: bool) -> Column:
    if not rules:
        return _names(default)
    if first_match:
        chain = reduce(
            lambda so_far, rule: so_far.when(rule[1], _names([rule[0]])), rules.items(), F
        )
        return chain.otherwise(_names(default))
    hits = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in rules.items()]))
    return F.when(F.size(hits) > 0, hits).otherwise(_names(default))


def route(
    df: DataFrame,
    rules: Mapping[str, Column],
    default: Sequence[str],
    first_match: bool = True,
) -> DataFrame:
    """Add `branch`: one output row per row and chosen branch.

    Rules are tried in order and the first that holds wins; with `first_match=False` all that
    hold are chosen.  Rows without a match go to every branch of `default`, which may be one,
    several or none.  Narrow: one pass and no shuffle, so a branch holding most rows is no
    hot spot.
    """
    if first_match and len(default) == 1:
        # One branch per row: a plain column, without building and exploding arrays.
        names = reduce(lambda so_far, rule: so_far.when(rule[1], rule[0]), rules.items(), F)
        branch = names.otherwise(default[0]) if rules else F.lit(default[0])
        return df.withColumn("branch", branch)
    return df.withColumn("branch", F.explode(_chosen(rules, default, first_match)))


def take_branch(routed: DataFrame, name: str) -> DataFrame:
    """The rows of one branch; a branch that nothing chose is empty."""
    return routed.filter(F.col("branch") == name)


def merge_branches(branches: Mapping[str, DataFrame], keep_branch: bool = True) -> DataFrame:
    """All rows of all branches, duplicates kept.

    Each branch reads its own input, so this suits branches from different places.  For branches
    of one routed table, `change_branches` gives the merged result in a single pass.
    """
    if not branches:
        raise ValueError("merge_branches needs at least one branch")
    labelled = [df.withColumn("branch", F.lit(name)) for name, df in branches.items()]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), labelled)
    return merged if keep_branch else merged.drop("branch")


def change_branches(
    routed: DataFrame, changes: Mapping[str, Mapping[str, Column]]
) -> DataFrame:
    """Per-branch work and merge in one pass: `changes` maps branch to {column: expression}.

    Rows of other branches keep their value, or get null in a column that did not exist.
    """
    names = dict.fromkeys(name for change in changes.values() for name in change)
    columns = {}
    for name in names:
        value = column(name) if name in routed.columns else F.lit(None)
        for branch, change in changes.items():
            if name in change:
                value = F.when(F.col("branch") == branch, change[name]).otherwise(value)
        columns[name] = value
    return routed.withColumns(columns)


def hour_parity_rules(
    ts: str | Column = "ts", literal: bool = False
) -> tuple[dict[str, Column], list[str]]:
    """Rules and default for routing by the parity of a timestamp's hour.

    `ts` is a column, or an expression such as `current_timestamp()` to route by the time of
    the run; it is evaluated when the query runs.

    `literal=False`: even and odd hours to their branch, rows without a time to none_hour.
    `literal=True` keeps the tests of the original rule, remainder 2 and remainder 3, which
    no hour can meet, so every row goes to both none_hour and odd_hour.
    """
    remainder = modulo(hour_of(column(ts) if isinstance(ts, str) else ts), 2)
    even, odd = (2, 3) if literal else (0, 1)
    default = ["none_hour", "odd_hour"] if literal else ["none_hour"]
    return {"even_hour": remainder == even, "odd_hour": remainder == odd}, default
