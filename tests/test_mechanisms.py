"""Stored profiles, branches written together, counted losses."""

from pathlib import Path

import pytest
from helpers import plan_of, write_out
from pyspark.sql import functions as F

from washline.functions.parsing import is_date_given
from washline.operators import (
    count_losses,
    count_types,
    infer_types,
    losses_of,
    merge_counts,
    profile_types,
    route,
    take_branch,
    to_bigint,
    to_double,
    to_timestamp_fmt,
)
from washline.operators.profile import watch_types, watched_types
from washline.plans import update_profile
from washline.sinks import write_branches
from washline.sources import read_csv_table
from washline.streaming import ingest_stream, read_profile


def lines(df):
    return sorted(tuple(r) for r in df.collect())


def put(folder: Path, name: str, text: str) -> None:
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)


def profile_of(spark, folder):
    return lines(profile_types(read_csv_table(spark, str(folder), typed=False)))


# --- profiles ---------------------------------------------------------------------------------


def test_counts_of_parts_add_up(spark):
    df = spark.createDataFrame(
        [("1", "True", "p"), ("2.5", None, "p"), ("x", "false", "q"), (None, "", None)], "a string, `b.c` string, part string"
    )
    parts = count_types(df, by="part")
    assert {r["part"] for r in parts.collect()} == {"p", "q", None}
    assert lines(infer_types(merge_counts(parts))) == lines(profile_types(df.drop("part")))


def test_counts_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "a string, part string")
    assert lines(count_types(empty.drop("part"))) == [("a", 0, 0, 0, 0)]
    assert lines(count_types(empty, by="part")) == []


def test_update_reads_new_files_only(spark, tmp_path):
    folder, store = tmp_path / "in", str(tmp_path / "store")
    put(folder, "one.csv", "a,b\n1,x\n2,\n")
    assert lines(update_profile(spark, str(folder), store)) == profile_of(spark, folder)
    put(folder, "two [1].csv", "b,a\n2.5,7\nNA,8\n")  # other order of columns
    put(folder, "none.csv", "a,b\n")
    assert lines(update_profile(spark, str(folder), store)) == profile_of(spark, folder)
    updates = {p.name for p in Path(store).glob("update-*")}
    assert len(updates) == 2
    assert spark.read.parquet(*map(str, Path(store).glob("update-*"))).select("file").distinct().count() == 3
    assert lines(update_profile(spark, str(folder), store)) == profile_of(spark, folder)
    assert {p.name for p in Path(store).glob("update-*")} == updates


def test_changed_and_removed_files(spark, tmp_path):
    folder, store = tmp_path / "in", str(tmp_path / "store")
    put(folder, "one.csv", "a,b\n1,x\n")
    put(folder, "two.csv", "a,b\ny,True\n")
    update_profile(spark, str(folder), store)
    put(folder, "one.csv", "a,b\n1,False\n5,True\n")
    assert lines(update_profile(spark, str(folder), store)) == profile_of(spark, folder)
    (folder / "two.csv").unlink()
    found = update_profile(spark, str(folder), store)
    assert lines(found.select("column", "n", "inferred")) == [("a", 2, "bigint"), ("b", 2, "boolean")]


def test_a_wrong_file_changes_nothing(spark, tmp_path):
    folder, store = tmp_path / "in", str(tmp_path / "store")
    put(folder, "big.csv", "a,b\n" + "1,2\n" * 50)
    update_profile(spark, str(folder), store)
    put(folder, "wrong.csv", "a,c\n1,2\n")
    with pytest.raises(ValueError, match="header of"):
        update_profile(spark, str(folder), store)
    assert len(list(Path(store).glob("update-*"))) == 1


def test_stream_profile_equals_that_of_all_files(spark, tmp_path):
    folder = tmp_path / "in"
    put(folder, "one.csv", "a,b\n1,x\n2,NA\n")

    def run(checkpoint):
        ingest_stream(
            spark, str(folder), ["a", "b"], lambda df: df, str(tmp_path / "sink"), str(tmp_path / checkpoint), profile=True
        ).awaitTermination()
        return lines(read_profile(spark, str(tmp_path / "sink")))

    assert lines(read_profile(spark, str(tmp_path / "sink"))) == []
    assert run("c1") == profile_of(spark, folder)
    put(folder, "two.csv", "b,a\nTrue,2.5\n")
    assert run("c1") == profile_of(spark, folder)
    assert run("c2") == profile_of(spark, folder)  # a lost checkpoint counts nothing twice


@pytest.mark.parametrize(
    "transform",
    [
        lambda df: df,
        lambda df: df.where("a = '2'"),
        lambda df: df.where("false"),
        lambda df: df.limit(1),
        lambda df: df.union(df),
        lambda df: df.repartition(3),
        lambda df: df.select(F.col("b").alias("c")),
    ],
)
def test_stream_profile_is_that_of_the_files_whatever_is_written(spark, tmp_path, transform):
    folder = tmp_path / "in"
    put(folder, "one.csv", "a,b\n1,x\n2,NA\n")
    put(folder, "two.csv", "b,a\nTrue,2.5\n,\n")
    sink = str(tmp_path / "sink")
    ingest_stream(
        spark, str(folder), ["a", "b"], transform, sink, str(tmp_path / "c"), profile=True
    ).awaitTermination()
    assert lines(read_profile(spark, sink)) == profile_of(spark, folder)


def test_numbers_at_the_ends_of_their_types(spark):
    texts = {
        "bigint": ["9223372036854775807", " -9223372036854775808\t", "\x0b12", "+0"],
        "double": ["1.", ".5", "-1e-400", "1e308", "1" * 299 + ".", "1" * 308 + ".0", " +iNf ", "-Infinity"],
        "boolean": ["True", "FALSE"],
        "string": ["9223372036854775808", "9" * 400 + ".1", "1e400", "2020-01-01", "1_0", "1.5d", "", "+", " True", "infin", "é1"],
    }
    for wanted, given in texts.items():
        for text in given:
            df = spark.createDataFrame([(text,)], "x string").coalesce(1)
            assert profile_types(df).first()["inferred"] == wanted, text


def test_type_tests_match_few_patterns(spark):
    """A number's kind takes two patterns at most; most texts none."""
    plan = plan_of(count_types(spark.range(3).selectExpr("string(id) as x")))
    assert 0 < plan.count("RLIKE") <= 2


def test_watched_types_equal_counted_types(spark):
    df = spark.createDataFrame(
        [("1", "True", 1), ("2.5", None, 2), ("x", "false", 3), (None, "", 4)], "a string, `b.c` string, n int"
    )
    out, seen = watch_types(df)
    assert out.columns == df.columns
    write_out(out)
    assert lines(watched_types(spark, seen, 4)) == lines(count_types(df))
    assert watched_types(spark, seen, 5) is None


# --- branches ---------------------------------------------------------------------------------


def test_branches_are_written_in_one_scan(spark, tmp_path):
    spark.range(100).withColumn("x y", F.col("id") % 7).write.parquet(str(tmp_path / "in"))
    source = spark.read.parquet(str(tmp_path / "in"))
    routed = route(source, {"a/b": F.col("id") < 60, "1": F.col("id") % 2 == 0}, ["rest"])
    tables = write_branches(routed, str(tmp_path / "out"), ["a/b", "1", "rest", "never"])
    for name, found in tables.items():
        assert found.columns == ["id", "x y"]
        assert lines(found) == lines(take_branch(routed, name).drop("branch"))
    assert tables["never"].count() == 0
    folder = next(p for p in (tmp_path / "out").iterdir() if p.name == "branch=never")
    assert spark.read.parquet(str(folder)).columns == ["id", "x y"]
    assert plan_of(routed).count("FileScan") == 1
    assert "Exchange" not in plan_of(routed)


def test_unnamed_branch_is_an_error_and_keeps_the_old(spark, tmp_path):
    routed = route(spark.range(10), {"low": F.col("id") < 5}, ["high"])
    out = str(tmp_path / "out")
    write_branches(routed, out, ["low", "high"])
    for bad in (routed, routed.withColumn("branch", F.lit(None).cast("string"))):
        with pytest.raises(Exception, match="branch not among those written"):
            write_branches(bad, out, ["low"])
    assert spark.read.parquet(out).count() == 10
    with pytest.raises(ValueError):
        write_branches(routed, out, [])


def test_branches_of_an_empty_table(spark, tmp_path):
    routed = route(spark.range(0), {"low": F.col("id") < 5}, ["high"])
    tables = write_branches(routed, str(tmp_path / "out"), ["low", "high"])
    assert [t.count() for t in tables.values()] == [0, 0]


# --- losses -----------------------------------------------------------------------------------


def test_losses_are_counted_while_writing(spark, any_ansi):
    df = spark.createDataFrame(
        [("1", "x", "2020-1-1"), ("1.5", "2", ""), (None, None, "2020-13-1"), ("z", "NaN", None)],
        "`a.b` string, b string, day string",
    )

    def convert(rows):
        rows = to_double(to_bigint(rows, "a.b"), "b", mode="coerce")
        return to_timestamp_fmt(rows, "day", mode="coerce")

    out, seen = count_losses(df, ["a.b", "b", "day"], convert, {"day": is_date_given(F.col("day"))})
    assert out.columns == ["a.b", "b", "day"]
    write_out(out)
    write_out(out)  # a second action changes nothing
    assert losses_of(seen) == {"a.b": (3, 2), "b": (3, 1), "day": (2, 1)}


def test_losses_of_an_empty_table(spark):
    out, seen = count_losses(spark.createDataFrame([], "a string"), "a", lambda df: to_bigint(df, "a"))
    write_out(out)
    assert losses_of(seen) == {"a": (0, 0)}


def test_losses_refuse_what_they_cannot_count(spark):
    df = spark.createDataFrame([("1", True)], "a string, __given_0 boolean")
    with pytest.raises(ValueError, match="used here"):
        count_losses(df, "a", lambda rows: rows)
    with pytest.raises(ValueError, match="no such"):
        count_losses(df, "b", lambda rows: rows)
    with pytest.raises(ValueError):
        count_losses(df, [], lambda rows: rows)
