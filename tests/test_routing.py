"""Routing, taking, changing and merging branches."""

import pytest
from helpers import plan_of
from pyspark.sql import functions as F

from washline.operators import (
    change_branches,
    hour_parity_rules,
    merge_branches,
    route,
    take_branch,
)


@pytest.fixture
def numbers(spark):
    return spark.range(6).withColumn("x", F.when(F.col("id") < 5, F.col("id")))


def pairs(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


@pytest.fixture
def rules(spark):
    return {"small": F.col("x") < 2, "even": F.col("x") % 2 == 0}


def test_first_match_wins_and_default_may_be_several(numbers, rules):
    out = route(numbers, rules, ["odd", "rest"])
    assert pairs(out, "id", "branch") == [
        (0, "small"),
        (1, "small"),
        (2, "even"),
        (3, "odd"),
        (3, "rest"),
        (4, "even"),
        (5, "odd"),
        (5, "rest"),
    ]


def test_one_default_builds_no_arrays(numbers, rules):
    out = route(numbers, rules, ["rest"])
    assert "Generate" not in plan_of(out)
    assert pairs(out, "id", "branch") == [
        (0, "small"),
        (1, "small"),
        (2, "even"),
        (3, "rest"),
        (4, "even"),
        (5, "rest"),
    ]


def test_all_matches(numbers, rules):
    out = route(numbers, rules, ["rest"], first_match=False)
    assert pairs(out, "id", "branch") == [
        (0, "even"),
        (0, "small"),
        (1, "small"),
        (2, "even"),
        (3, "rest"),
        (4, "even"),
        (5, "rest"),
    ]


def test_no_rules_and_no_default(numbers, rules):
    assert pairs(route(numbers, {}, ["a", "b"]), "branch") == [("a",)] * 6 + [("b",)] * 6
    assert route(numbers, rules, []).count() == 4


def test_branches_split_and_merge_whole(numbers, rules):
    routed = route(numbers, rules, ["odd", "rest"])
    names = ["small", "even", "odd", "rest", "never"]
    parts = {name: take_branch(routed, name) for name in names}
    assert parts["never"].count() == 0
    assert pairs(merge_branches(parts), "id", "branch") == pairs(routed, "id", "branch")
    assert merge_branches(parts, keep_branch=False).columns == ["id", "x"]
    with pytest.raises(ValueError):
        merge_branches({})


def test_merge_keeps_duplicates_and_adds_missing_columns(numbers):
    merged = merge_branches({"a": numbers, "b": numbers.withColumn("y", F.lit(1))})
    assert merged.count() == 12
    assert pairs(merged.filter("branch = 'a'"), "id", "y") == [(i, None) for i in range(6)]


def test_change_branches_equals_separate_work(numbers, rules):
    routed = route(numbers, rules, ["rest"])
    changes = {"small": {"x": F.col("x") + 10, "y": F.lit("s")}, "rest": {"x": F.lit(-1)}}
    one_pass = change_branches(routed, changes)
    separate = merge_branches(
        {
            name: take_branch(routed, name).withColumns(changes.get(name, {}))
            for name in ("small", "even", "rest")
        }
    )
    as_text = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in ("id", "x", "y", "branch")]
    assert pairs(one_pass, *as_text) == pairs(separate, *as_text)
    assert plan_of(one_pass).count("Range") == 1


def test_hour_parity(spark):
    df = spark.sql(
        "select * from values (1, timestamp_ntz'2024-01-01 04:00:00'), "
        "(2, timestamp_ntz'2024-01-01 23:00:00'), (3, null) as t(id, ts)"
    )
    assert pairs(route(df, *hour_parity_rules("ts")), "id", "branch") == [
        (1, "even_hour"),
        (2, "odd_hour"),
        (3, "none_hour"),
    ]
    literal = route(df, *hour_parity_rules("ts", literal=True))
    assert pairs(literal, "id", "branch") == [
        (i, b) for i in (1, 2, 3) for b in ("none_hour", "odd_hour")
    ]


def test_parity_of_the_present_hour(spark):
    rules, default = hour_parity_rules(F.current_timestamp())
    out = route(spark.range(3), rules, default)
    assert out.select("branch").distinct().count() == 1
    assert out.filter("branch = 'none_hour'").count() == 0


def test_routing_does_not_shuffle(numbers, rules):
    for out in (route(numbers, rules, ["a", "b"]), take_branch(route(numbers, rules, ["a"]), "a")):
        assert "Exchange" not in plan_of(out)
