"""Whole jobs: cleaning, publishing, streaming, table writing, settings."""

import datetime as dt
import glob
import gzip
import os
from urllib.parse import unquote

import pytest
from helpers import SMALL, plan_of, write_out
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from washline import staging
from washline.catalog import queries
from washline.catalog.dirty import dirty_transactions
from washline.functions.fixed_values import NA_TOKENS
from washline.plans import clean_store_transactions, publish_clean, publish_raw
from pyspark.sql.readwriter import DataFrameWriter

from washline.sinks import csv as sinks_csv
from washline.sinks import preview, write_object_csv, write_table, write_table_jdbc
from washline.sources import read_csv_table
from washline.sources import csv
from washline.settings import METHOD_LIMIT, small_methods
from washline.sinks.replace import replace_folder
from washline.streaming import ingest_stream
from washline.streaming.ingest import ONCE, read_ledger

COLUMNS = (
    "STORE_ID string, STORE_LOCATION string, PRODUCT_CATEGORY string, PRODUCT_ID string, "
    "MRP string, CP string, DISCOUNT string, SP string, Date string, note string, n int"
)
ROW = ("ST-79#", " Dock A/F! ", "A&F ", "P1616?", "$68,423.455", "$1", "$0", "2.5", " 2019-1-5 ", " x ", 4)
CLEAN = ("ST79", "Dock AF", "AF", 1616, 68423.46, 1.0, 0.0, 2.5, dt.datetime(2019, 1, 5), "x", 4)


def test_clean_row(spark, any_ansi):
    df = spark.createDataFrame([ROW], COLUMNS)
    out = clean_store_transactions(df)
    assert out.columns == df.columns
    assert tuple(out.collect()[0]) == CLEAN
    assert [f.dataType.simpleString() for f in out.schema] == (
        ["string"] * 3 + ["bigint"] + ["double"] * 4 + ["timestamp_ntz", "string", "int"]
    )


def test_clean_missing_values(spark, any_ansi):
    df = spark.createDataFrame([(None,) * 11], COLUMNS)
    assert tuple(clean_store_transactions(df).collect()[0]) == ("nan",) * 3 + (None,) * 8
    assert tuple(clean_store_transactions(df, parity=False).collect()[0]) == (None,) * 11


@pytest.mark.parametrize("position, text", [(4, "(5)"), (7, ""), (8, "2019-02-30"), (8, "5/1/2019")])
def test_clean_bad_values(spark, any_ansi, position, text):
    bad = (*ROW[:position], text, *ROW[position + 1 :])
    df = spark.createDataFrame([ROW, bad], COLUMNS)
    with pytest.raises(PySparkException, match="holds text that is no"):
        write_out(clean_store_transactions(df))
    out = clean_store_transactions(df, mode="coerce").collect()
    assert len(out) == 2 and out[1][position] is None and tuple(out[0]) == CLEAN


def test_clean_accepts_typed_columns(spark):
    df = spark.createDataFrame(
        [(7, "a", "b", 12, 1.005, 2, 0.125, 3.0, dt.datetime(2020, 1, 2))],
        "STORE_ID long, STORE_LOCATION string, PRODUCT_CATEGORY string, PRODUCT_ID long, "
        "MRP double, CP int, DISCOUNT double, SP double, Date timestamp_ntz",
    )
    assert tuple(clean_store_transactions(df).collect()[0]) == (
        *("7", "a", "b", 12, 1.0, 2.0, 0.12, 3.0),
        dt.datetime(2020, 1, 2),
    )


def test_clean_is_one_narrow_stage_with_small_methods(spark):
    df = clean_store_transactions(dirty_transactions(spark, SMALL))
    plan = plan_of(df)
    assert "Exchange" not in plan and "Python" not in plan
    assert plan.count("*(1)") > 1 and "*(2)" not in plan
    code = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
    largest = int(code.split("maxMethodCodeSize:")[1].split(";")[0])
    assert largest < 8000, "the JVM does not optimise methods above 8000 bytes"
    assert df.count() == 6000


# --- publishing -------------------------------------------------------------------------------


def test_publish_raw(spark, any_ansi, tmp_path):
    source = tmp_path / "source.csv"
    source.write_text('id,x,y,t\n2,1.50,NA,"a,b"\n\n1,,null, NA \n')
    target = str(tmp_path / "table")
    head = publish_raw(
        spark,
        str(source),
        str(tmp_path),
        "bucket",
        "raw/key.csv",
        publish=lambda df: write_table(df, target, index_by="id"),
        order_by="id",
    )
    assert [tuple(r) for r in head.collect()] == [(1, None, None, " NA "), (2, 1.5, None, "a,b")]
    published = spark.read.parquet(target)
    assert published.columns == ["index", "id", "x", "y", "t"]
    assert sorted(tuple(r) for r in published.collect()) == [
        (0, 1, None, None, " NA "),
        (1, 2, 1.5, None, "a,b"),
    ]
    stored = "".join(p.read_text() for p in (tmp_path / "bucket/raw/key.csv").glob("part-*"))
    assert "1.50" not in stored and "null" not in stored


def test_publish_raw_with_line_breaks(spark, tmp_path):
    source = tmp_path / "source.csv"
    source.write_text('id,t\n1,"a\nb"\n2,c\n')
    published = []
    publish_raw(
        spark, str(source), str(tmp_path), "b", "k", publish=published.append, multiline=True
    )
    assert sorted(tuple(r) for r in published[0].collect()) == [(1, "a\nb"), (2, "c")]


def test_publish_clean_equals_cleaning(spark, tmp_path):
    dirty = dirty_transactions(spark, SMALL)
    source = write_object_csv(dirty, str(tmp_path), "source", "dirty.csv")
    published = []
    publish_clean(spark, source, str(tmp_path), "b", "k", publish=published.append)
    wanted = clean_store_transactions(dirty).withColumn(
        "l_linenumber", F.col("l_linenumber").cast("bigint")
    )
    assert published[0].schema.simpleString() == wanted.schema.simpleString()
    assert published[0].exceptAll(wanted).count() == 0
    assert wanted.exceptAll(published[0]).count() == 0


def test_publish_clean_with_compressed_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks_csv, "ROWS_PER_UNSPLITTABLE_FILE", 500)
    dirty = dirty_transactions(spark, SMALL)
    source = write_object_csv(dirty, str(tmp_path), "source", "dirty.csv", compression="gzip")
    published = []
    head = publish_clean(spark, source, str(tmp_path), "b", "k", publish=published.append, compression="gzip")
    wanted = clean_store_transactions(dirty).withColumn("l_linenumber", F.col("l_linenumber").cast("bigint"))
    assert published[0].exceptAll(wanted).count() == 0 and published[0].count() == wanted.count()
    assert head.count() == 5
    # Readers cannot split such files, so there are many.
    assert len(list((tmp_path / "b/k").glob("part-*.csv.gz"))) >= 12 and not list((tmp_path / "b/k").glob("part-*.csv"))
    empty = write_object_csv(dirty.where("false"), str(tmp_path), "source", "empty.csv", compression="gzip")
    assert read_csv_table(spark, empty).columns == dirty.columns and read_csv_table(spark, empty).count() == 0


def test_the_published_query_keeps_little_on_disk(spark):
    root = staging.staging_root(spark) + "/washline"
    before = set(glob.glob(f"{root}/*"))
    table = queries()["publish_clean"](spark, SMALL)
    assert table.count() == 6000
    kept = set(glob.glob(f"{root}/*")) - before
    assert sorted(p.rsplit("/", 1)[1].split("-")[0] for p in kept) == ["clean", "objects"]
    files = [f for p in kept for f in glob.glob(f"{p}/**/part-*", recursive=True)]
    stored = [f for f in files if "/raw/dirty.csv/" in f]
    plain = sum(len(gzip.decompress(open(f, "rb").read())) for f in stored)
    assert plain > 6000 * 90 and sum(map(os.path.getsize, stored)) < plain / 2
    # The source was read for the last time before the table was written from its stored copy.
    assert not [f for f in files if "/source/" in f]


def test_write_table_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(5), path)
    out = write_table(spark.range(3).withColumnRenamed("id", "other"), path)
    assert out.columns == ["other"] and out.count() == 3


def test_a_failed_write_keeps_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(5), path)
    stored = write_object_csv(spark.range(4), str(tmp_path), "b", "k.csv")
    bad = spark.range(3).withColumn("x", F.when(F.col("id") == 2, F.raise_error(F.lit("broken"))).otherwise("y"))
    for write in (
        lambda: write_table(bad, path),
        lambda: write_table(bad, path, index_by="id"),
        lambda: write_object_csv(bad, str(tmp_path), "b", "k.csv"),
    ):
        with pytest.raises(PySparkException, match="broken"):
            write()
    assert spark.read.parquet(path).count() == 5 and read_csv_table(spark, stored).count() == 4
    assert sorted(p.name for p in tmp_path.iterdir()) == ["b", "t"]
    assert [p.name for p in (tmp_path / "b").iterdir()] == ["k.csv"]


def test_a_table_replaced_by_what_is_computed_from_it(spark, tmp_path):
    path = str(tmp_path / "t")
    table = write_table(spark.range(5), path)
    again = write_table(table.withColumn("id", F.col("id") + 10), path)
    assert sorted(r["id"] for r in again.collect()) == [10, 11, 12, 13, 14]


def test_jdbc_inserts_from_a_stored_copy(spark, monkeypatch):
    seen = {}

    def jdbc(self, url, table, properties):
        seen.update(plan=plan_of(self._df), rows=self._df.count(), at=(url, table, properties))

    monkeypatch.setattr(DataFrameWriter, "jdbc", jdbc)
    df = spark.range(100, numPartitions=7).withColumn("x", F.col("id") * 2)
    write_table_jdbc(df, "jdbc:x:y", "target", {"user": "u"}, max_connections=4)
    assert seen["rows"] == 100 and seen["at"] == ("jdbc:x:y", "target", {"user": "u"})
    assert "FileScan parquet" in seen["plan"] and "Range" not in seen["plan"]


def test_preview(spark):
    df = spark.range(100).withColumn("k", -F.col("id"))
    assert [r["id"] for r in preview(df, order_by="k").collect()] == [99, 98, 97, 96, 95]
    assert "TakeOrderedAndProject" in plan_of(preview(df, order_by="k"))
    assert preview(df, n=3).count() == 3


# --- streaming --------------------------------------------------------------------------------


def run_stream(spark, tmp_path, names, transform, **how):
    query = ingest_stream(
        spark,
        str(tmp_path / "landing"),
        names,
        transform,
        str(tmp_path / "sink"),
        str(tmp_path / "checkpoint"),
        **how,
    )
    query.awaitTermination()
    return query


def test_stream_takes_new_files_once(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    for i in range(3):
        (landing / f"f{i}.csv").write_text(f"a,b\n{i},x\n{i + 10},NA\n")
    run_stream(spark, tmp_path, ["a", "b"], lambda df: df, max_files_per_trigger=1)
    sink = str(tmp_path / "sink")
    assert spark.read.parquet(sink).count() == 6
    assert spark.read.parquet(sink).select("batch_id").distinct().count() == 3
    (landing / "late.csv").write_text("a,b\n99,z\n")
    run_stream(spark, tmp_path, ["a", "b"], lambda df: df)
    out = spark.read.parquet(sink).drop("run", "batch_id")
    wanted = [(str(i), "x") for i in range(3)] + [(str(i + 10), None) for i in range(3)] + [("99", "z")]
    assert sorted((tuple(r) for r in out.collect()), key=repr) == sorted(wanted, key=repr)
    run_stream(spark, tmp_path, ["a", "b"], lambda df: df)
    assert spark.read.parquet(sink).count() == 7


def test_repeated_batch_leaves_no_duplicates(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "f.csv").write_text("a\n1\n2\n")
    run_stream(spark, tmp_path, ["a"], lambda df: df)
    for name in (tmp_path / "checkpoint" / "commits").iterdir():
        name.unlink()  # as after a crash between the write and the commit
    run_stream(spark, tmp_path, ["a"], lambda df: df)
    assert spark.read.parquet(str(tmp_path / "sink")).count() == 2


def test_stream_refuses_rows_that_do_not_fit(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "f.csv").write_text("a,b\n1,2,3\n")
    with pytest.raises(PySparkException, match="more than 2 fields"):
        run_stream(spark, tmp_path, ["a", "b"], lambda df: df)


def test_stream_with_line_breaks(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "f.csv").write_bytes(b'a,b\r\n1,"x\r\ny"\r\n2,z\r\n')
    with pytest.raises(ValueError, match="line_sep"):
        run_stream(spark, tmp_path, ["a", "b"], lambda df: df, multiline=True)
    run_stream(spark, tmp_path, ["a", "b"], lambda df: df, multiline=True, line_sep="\r\n")
    out = spark.read.parquet(str(tmp_path / "sink")).select("a", "b").collect()
    assert sorted(tuple(r) for r in out) == [("1", "x\r\ny"), ("2", "z")]


def test_stream_equals_batch(spark, tmp_path):
    dirty = dirty_transactions(spark, SMALL)
    write_object_csv(dirty.repartition(3), str(tmp_path), "landing", "")
    run_stream(spark, tmp_path, dirty.columns, clean_store_transactions, trigger=ONCE)
    stream = spark.read.parquet(str(tmp_path / "sink")).drop("run", "batch_id")
    batch = clean_store_transactions(
        dirty.withColumns({c: F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber")})
    )
    assert stream.exceptAll(batch).count() == 0 and stream.count() == batch.count() == 6000


# --- settings ---------------------------------------------------------------------------------


class Session:
    def __init__(self, **settings):
        self.conf = {k.replace("_", "."): v for k, v in settings.items()}


def test_staging_folder():
    shared = Session(spark_checkpoint_dir="s3a://shared/dir/", spark_master="yarn")
    assert staging.staging_root(shared) == "s3a://shared/dir"
    assert staging.staging_path(shared, "x").startswith("s3a://shared/dir/washline/x-")
    assert staging.staging_path(shared, "x") != staging.staging_path(shared, "x")
    for master in ("spark://host:7077", "local[2]"):
        unset = Session(spark_sql_warehouse_dir="hdfs://warehouse/", spark_master=master)
        assert staging.staging_root(unset) == "hdfs://warehouse/staging"


def test_number_of_missing_value_tokens():
    assert len(NA_TOKENS) == len(set(NA_TOKENS)) == 19


# --- the stream's ledger ----------------------------------------------------------------------


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()

    def land(name, text):
        (folder / name).write_text(text)

    return land


def taken(spark, tmp_path):
    out = spark.read.parquet(str(tmp_path / "sink")).drop("run", "batch_id")
    return sorted((tuple(r) for r in out.collect()), key=repr)


def plain(df):
    return df


def test_ledger_names_files_headers_and_rows(spark, tmp_path, landing):
    landing("a.csv", "a,b\n1,x\n2,y\n")
    landing("b 3%20 é.csv", "b,a\nz,3\n")
    run_stream(spark, tmp_path, ["a", "b"], plain)
    assert taken(spark, tmp_path) == [("1", "x"), ("2", "y"), ("3", "z")]
    ledger = read_ledger(spark, str(tmp_path / "sink"))
    found = sorted((unquote(r["file"]).rsplit("/", 1)[1], r["header"], r["rows"], r["batch_id"]) for r in ledger.collect())
    assert found == [("a.csv", "a,b", 2, 0), ("b 3%20 é.csv", "b,a", 1, 0)]


def test_a_lost_checkpoint_adds_no_row_twice(spark, tmp_path, landing):
    for i in range(3):
        landing(f"f{i}.csv", f"a,b\n{i},x\n")
    run_stream(spark, tmp_path, ["a", "b"], plain, max_files_per_trigger=1)
    (tmp_path / "checkpoint").rename(tmp_path / "lost")
    landing("late.csv", "a,b\n9,y\n")
    run_stream(spark, tmp_path, ["a", "b"], plain, max_files_per_trigger=2)
    assert taken(spark, tmp_path) == [("0", "x"), ("1", "x"), ("2", "x"), ("9", "y")]
    assert read_ledger(spark, str(tmp_path / "sink")).count() == 4


def test_rows_without_a_ledger_do_not_count(spark, tmp_path, landing):
    """As after a failure between a batch's rows and its ledger, with the checkpoint lost as well."""
    landing("a.csv", "a,b\n1,x\n")
    landing("b.csv", "a,b\n2,x\n")
    run_stream(spark, tmp_path, ["a", "b"], plain, max_files_per_trigger=1)
    ledgers = sorted((tmp_path / "sink" / "_ledger").glob("run=*/batch_id=*"))
    ledgers[1].rename(tmp_path / "gone")
    (tmp_path / "checkpoint").rename(tmp_path / "lost")
    run_stream(spark, tmp_path, ["a", "b"], plain)
    assert taken(spark, tmp_path) == [("1", "x"), ("2", "x")]
    assert read_ledger(spark, str(tmp_path / "sink")).count() == 2


@pytest.mark.parametrize("bad", ["a,c\n5,6\n", "a\n5\n", "a,b,c\n5,6,7\n", "5,6\n7,8\n"])
def test_a_wrong_header_stops_the_batch(spark, tmp_path, landing, bad):
    landing("a.csv", "a,b\n1,x\n")
    run_stream(spark, tmp_path, ["a", "b"], plain)
    landing("bad.csv", bad)
    landing("good.csv", "a,b\n2,x\n")
    with pytest.raises(Exception, match="header of .*bad.csv|more than 2 fields"):
        run_stream(spark, tmp_path, ["a", "b"], plain)
    assert taken(spark, tmp_path) == [("1", "x")]
    landing("bad.csv", "b,a\n6,5\n")
    run_stream(spark, tmp_path, ["a", "b"], plain)
    assert taken(spark, tmp_path) == [("1", "x"), ("2", "x"), ("5", "6")]


def scans_per_job(spark, tmp_path, names, transform, **how):
    """How many rows the stream's files hand to Spark in all, in stages that parse their fields."""
    parsed = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            parsed.add(batch.num_rows)
            yield batch

    run_stream(spark, tmp_path, names, lambda df: transform(df.mapInArrow(seen, df.schema)), **how)
    return parsed.value


@pytest.mark.parametrize("profile", [False, True])
def test_a_batch_is_cleaned_once_and_kept_in_no_cache(spark, tmp_path, landing, profile, monkeypatch):
    for i in range(3):
        landing(f"f{i}.csv", f"a,b\n{i},x\n")
    kept = []
    monkeypatch.setattr(type(spark.range(0)), "persist", lambda df, *level: kept.append(df) or df)
    assert scans_per_job(spark, tmp_path, ["a", "b"], plain, profile=profile) == 3
    assert not kept


def test_rows_are_counted_as_they_are_read(spark, tmp_path, landing):
    """Blank lines, line breaks in quotes and files without rows."""
    landing("a.csv", 'a,b\n\n1,"x\n\ny"\n\n2,\n')
    landing("header.csv", "a,b\n")
    landing("empty.csv", "")
    run_stream(spark, tmp_path, ["a", "b"], plain, multiline=True, line_sep="\n")
    assert taken(spark, tmp_path) == [("1", "x\n\ny"), ("2", None)]
    ledger = read_ledger(spark, str(tmp_path / "sink")).collect()
    assert [(r["file"].rsplit("/", 1)[1], r["header"], r["rows"]) for r in ledger] == [("a.csv", "a,b", 2)]


def test_a_batch_without_rows(spark, tmp_path, landing):
    landing("header.csv", "a,b\n")
    run_stream(spark, tmp_path, ["a", "b"], plain, profile=True)
    assert taken(spark, tmp_path) == [] and read_ledger(spark, str(tmp_path / "sink")).count() == 0


def test_publishing_looks_at_headers_once_and_checks_rows_as_it_stores(spark, tmp_path, landing, monkeypatch):
    landing("a.csv", 'a,b,t\n1,"x,y",p\n 2 ,"q""r",\n')
    landing("b.csv", "t,b,a\nz,,3\n")
    seen, parsed, out = [], [], str(tmp_path / "t")
    for module, name, calls in ((csv, "file_headers", seen), (csv, "read_lines_checked", parsed)):
        real = getattr(module, name)
        monkeypatch.setattr(module, name, lambda *a, f=real, c=calls, **how: c.append(how.get("unchecked")) or f(*a, **how))
    publish_raw(spark, str(tmp_path / "landing"), str(tmp_path), "b", "k", publish=lambda df: write_table(df, out, index_by="a"))
    found = [tuple(r) for r in spark.read.parquet(out).orderBy("index").select("index", "a", "b", "t").collect()]
    assert found == [(0, 1, "x,y", "p"), (1, 2, 'q"r', None), (2, 3, None, "z")]
    assert len(seen) == 1 and sorted(map(str, parsed)) == ["FAILFAST", "None", "PERMISSIVE"]


@pytest.mark.parametrize(
    "text, problem",
    [("a,b\n1,2,3\n", "more than 2 fields"), ('a,b\n1,"x\ny"\n', "line break"), ("a,b\n1,\ufffd\n", "bytes that are no")],
)
def test_publishing_still_refuses_bad_rows(spark, tmp_path, landing, text, problem):
    landing("a.csv", text)
    with pytest.raises(PySparkException, match=problem):
        publish_raw(spark, str(tmp_path / "landing"), str(tmp_path), "b", "k", publish=lambda df: df.count())
    assert not (tmp_path / "b" / "k").exists()


def test_values_with_line_ends_are_read_back_with_checks(spark, tmp_path):
    (tmp_path / "s.csv").write_bytes(b"a,b\r\n1,x\ny,z\r\n")
    with pytest.raises(PySparkException, match="line break inside quotes|more than 2 fields"):
        publish_raw(
            spark, str(tmp_path / "s.csv"), str(tmp_path), "b", "k", line_sep="\r\n", publish=lambda df: write_table(df, str(tmp_path / "t"))
        )


def test_writers_run_small_methods_and_leave_the_setting(spark, tmp_path):
    limits = []
    before = spark.conf.get(METHOD_LIMIT)
    try:
        for given, wanted in (("65535", "8000"), ("7000", "7000")):
            spark.conf.set(METHOD_LIMIT, given)
            replace_folder(
                spark, str(tmp_path / "t"), lambda new: (limits.append(spark.conf.get(METHOD_LIMIT)), spark.range(1).write.parquet(new))
            )
            assert limits.pop() == wanted and spark.conf.get(METHOD_LIMIT) == given
        with pytest.raises(ValueError), small_methods(spark):
            raise ValueError
        assert spark.conf.get(METHOD_LIMIT) == "7000"
    finally:
        spark.conf.set(METHOD_LIMIT, before)


class Session:
    """Stands for a session with other settings."""

    def __init__(self, **settings):
        self.conf = {k.replace("_", "."): v for k, v in settings.items()}


def test_staging_needs_a_shared_folder():
    assert staging.staging_root(Session(spark_checkpoint_dir="hdfs://n/x/", spark_master="yarn")) == "hdfs://n/x"
    assert staging.staging_root(Session(spark_sql_warehouse_dir="file:/w/", spark_master="local[8]")) == "file:/w/staging"
    assert staging.staging_root(Session(spark_sql_warehouse_dir="hdfs://n/w", spark_master="yarn")) == "hdfs://n/w/staging"
    for master in ("yarn", "spark://h:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            staging.staging_root(Session(spark_sql_warehouse_dir="file:/w", spark_master=master))
