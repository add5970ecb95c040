"""The dense row number, above all under skew."""

import glob

import pytest
from helpers import SMALL, plan_of
from pyspark.sql import functions as F

from washline.operators import row_index, with_row_index
from washline.settings import FREE_SHUFFLES, OPEN_FILES
from washline.sinks import write_table


def check_dense(df, n, order):
    found = df.select("index", *order).orderBy("index").collect()
    assert [r["index"] for r in found] == list(range(n))
    keys = [tuple((r[c] is not None, r[c]) for c in order) for r in found]
    assert keys == sorted(keys)


def test_unique_order(spark):
    df = spark.read.parquet(f"{SMALL}/events.parquet")
    out = with_row_index(df, ["ts", "event_id"])
    assert out.columns == ["index", *df.columns]
    assert out.schema["index"].dataType.simpleString() == "bigint"
    check_dense(out, 1000, ["ts", "event_id"])
    assert out.drop("index").exceptAll(df).count() == 0


@pytest.fixture
def staged(monkeypatch):
    """Sizes of the ranges, as they are found by the keys of the stored rows."""
    seen = []
    ranged = row_index._with_range

    def watched(keyed, bounds, most):
        out = ranged(keyed, bounds, most)
        seen.append([r["count"] for r in out.groupBy("__range").count().collect()])
        return out

    monkeypatch.setattr(row_index, "_with_range", watched)
    return seen


def test_one_key_holding_a_third_is_spread(spark, staged):
    n = 30_000
    df = spark.range(0, n, 1, 12).withColumn(
        "k", F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id"))
    )
    out = with_row_index(df, "k", partitions=12)
    check_dense(out, n, ["k"])
    assert max(staged[0]) < n / 12 * 2
    assert out.select("id").distinct().count() == n


def test_copies_of_one_row_are_spread(spark, staged):
    n = 30_000
    df = spark.range(0, n, 1, 12).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        F.lit("same").alias("t"),
    )
    out = with_row_index(df, "k", partitions=12)
    check_dense(out, n, ["k"])
    assert max(staged[0]) < n / 12 * 2.5


def test_nulls_empty_partitions_and_empty_tables(spark):
    df = spark.createDataFrame([(None, 1), ("b", 2), (None, 3), ("a", 4)], "k string, v int")
    check_dense(with_row_index(df, ["k"], partitions=16), 4, ["k"])
    assert with_row_index(df.filter("v > 9"), "k").count() == 0


def test_columns_that_cannot_be_hashed(spark):
    df = spark.sql("select id, map('a', id) m, array(map(1, id)) am, struct(id) s from range(5)")
    check_dense(with_row_index(df, "id"), 5, ["id"])


def test_number_of_ranges_follows_the_input(spark, monkeypatch, staged):
    events = spark.read.parquet(f"{SMALL}/events.parquet")
    monkeypatch.setattr(row_index, "INPUT_PER_RANGE", 1000)
    check_dense(with_row_index(events, "event_id"), 1000, ["event_id"])
    assert len(staged[0]) > 15


def test_mixed_types_in_the_order(spark):
    df = spark.sql(
        """select case when id % 5 > 0 then cast(id % 7 as double) / 3 when id % 2 = 0 then double('nan') end as d,
                  cast(id % 3 as decimal(20, 4)) as e, date_add(date'2020-01-01', cast(id % 11 as int)) as f,
                  cast(cast(id % 13 as string) as binary) as g, named_struct('x', id % 4, 'y', null) as h, id % 2 = 0 as i
           from range(3000)"""
    )
    out = with_row_index(df, df.columns, partitions=9).drop("index")
    again = with_row_index(df, df.columns, partitions=1)
    assert [tuple(map(repr, r)) for r in with_row_index(df, df.columns, partitions=9).orderBy("index").collect()] == [
        tuple(map(repr, r)) for r in again.orderBy("index").collect()
    ]
    assert out.count() == 3000


def test_one_shuffle_and_no_join(spark):
    plan = plan_of(with_row_index(spark.range(1000).withColumn("k", F.col("id") % 3), "k"))
    assert plan.count("Exchange") == 1 and "Join" not in plan and "Python" not in plan


@pytest.mark.parametrize("n", [1, 7, 8, 9, 31, 33, 100])
@pytest.mark.parametrize("partitions", [1, 2, 3, 8, 13])
def test_few_rows_in_any_number_of_ranges(spark, n, partitions):
    check_dense(with_row_index(spark.range(n).withColumn("k", F.col("id") % 4), ["k", "id"], partitions=partitions), n, ["k", "id"])


def test_own_name_and_arguments(spark):
    out = with_row_index(spark.range(3), "id", name="place")
    assert out.columns == ["place", "id"]
    with pytest.raises(ValueError, match="column id already"):
        with_row_index(spark.range(3), "id", name="id")
    with pytest.raises(ValueError, match="needs an order"):
        with_row_index(spark.range(3), [])
    with pytest.raises(ValueError, match="partitions"):
        with_row_index(spark.range(3), "id", partitions=2_000_000)


def test_costly_input_is_computed_once(spark):
    computed = spark.sparkContext.accumulator(0)

    def count_rows(batches):
        for batch in batches:
            computed.add(batch.num_rows)
            yield batch

    df = spark.range(1000).mapInArrow(count_rows, "id long")
    out = with_row_index(df, "id")
    check_dense(out, 1000, ["id"])
    assert computed.value == 1000


def test_result_is_the_same_on_every_evaluation(spark):
    df = spark.range(5000).withColumn("k", F.col("id") % 3)
    out = with_row_index(df, "k")
    assert out.exceptAll(out).count() == 0
    assert glob.glob(f"{row_index.staging_path(spark, 'x').rsplit('/', 1)[0]}/row-index-*")


def test_write_table_leaves_no_stored_copy(spark, tmp_path):
    root = row_index.staging_path(spark, "x").rsplit("/", 1)[0]
    before = set(glob.glob(f"{root}/*"))
    out = write_table(spark.range(100), str(tmp_path / "t"), index_by="id")
    assert out.where("index = id").count() == 100 and set(glob.glob(f"{root}/*")) == before


def test_large_tables_are_written_in_passes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(row_index, "ROWS_PER_PASS", 5000)
    n, target = 30_000, str(tmp_path / "t")
    root = row_index.staging_path(spark, "x").rsplit("/", 1)[0]
    before = set(glob.glob(f"{root}/*"))
    df = spark.range(0, n, 1, 12).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 101 > 0, F.col("id")).alias("k"),
        F.when(F.col("id") % 2 == 0, F.lit("same")).otherwise(F.col("id").cast("string")).alias("a b.c"),
        F.create_map(F.lit("m"), F.col("id")).alias("m"),
    )
    stored, rows = [], []

    def add(part):
        files = glob.glob(f"{root}/row-index-*/*/**/*.parquet", recursive=True)
        stored.append(sum(row_index.staged_size(spark, f) for f in set(files) if not any(f.startswith(b) for b in before)))
        part.write.mode("append").parquet(target)
        rows.append(spark.read.parquet(target).count())
        assert spark.conf.get(FREE_SHUFFLES) == "true"

    row_index.write_indexed(df, "k", add)
    out = spark.read.parquet(target)
    check_dense(out, n, ["k"])
    assert sorted(map(str, out.select("k", "`a b.c`", "m").collect())) == sorted(map(str, df.collect()))
    # A part at a time is written, and what was written is not stored any more.
    assert len(rows) == 7 and max(b - a for a, b in zip([0, *rows], rows)) < n / 4
    assert stored == sorted(stored, reverse=True) and stored[-1] < stored[0] / 3
    assert spark.conf.get(FREE_SHUFFLES) == "false" and set(glob.glob(f"{root}/*")) == before


def test_passes_give_the_same_numbers(spark, tmp_path, monkeypatch):
    df = spark.range(0, 20_000, 1, 9).select((F.col("id") % 5).alias("k"), F.hash("id").alias("v"), (F.col("id") % 2).alias("w"))
    whole = write_table(df, str(tmp_path / "whole"), index_by=["k", "w", "v"])
    monkeypatch.setattr(row_index, "INPUT_PER_PASS", 1000)
    parts = write_table(df, str(tmp_path / "parts"), index_by=["k", "w", "v"], compression="zstd")
    assert parts.schema == whole.schema and whole.exceptAll(parts).count() == 0 and parts.count() == 20_000
    assert glob.glob(f"{tmp_path}/parts/*.zstd.parquet") and not glob.glob(f"{tmp_path}/parts/*.snappy.parquet")


def test_a_failed_pass_leaves_no_stored_copy(spark, monkeypatch):
    monkeypatch.setattr(row_index, "ROWS_PER_PASS", 100)
    root = row_index.staging_path(spark, "x").rsplit("/", 1)[0]
    before = set(glob.glob(f"{root}/*"))
    parts = []

    def add(part):
        if parts:
            raise OSError("full")
        parts.append(part)

    with pytest.raises(OSError, match="full"):
        row_index.write_indexed(spark.range(1000), "id", add)
    assert set(glob.glob(f"{root}/*")) == before and spark.conf.get(FREE_SHUFFLES) == "false"


def test_stored_rows_are_split_without_a_sort(spark, monkeypatch):
    """Tasks would spill what they sort, and Spark begins to sort with the last open file of its limit."""
    monkeypatch.setattr(row_index, "ROWS_PER_PASS", 100)
    seen, tied = [], row_index._ranged
    monkeypatch.setattr(row_index, "_ranged", lambda *a: seen.append(spark.conf.get(OPEN_FILES)) or tied(*a))
    opened = row_index.open_files
    monkeypatch.setattr(row_index, "open_files", lambda s, n: seen.append(n) or opened(s, n))
    parts = []
    row_index.write_indexed(spark.range(0, 700, 1, 1), "id", lambda part: parts.append(part.count()))
    assert seen == ["0", 8] and len(parts) == 8 and sum(parts) == 700
    with opened(spark, 8):
        assert spark.conf.get(OPEN_FILES) == "9"
    assert spark.conf.get(OPEN_FILES) == "0"
