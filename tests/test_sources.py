"""Reading CSV: header, widths, quotes, missing values, types; files; probing."""

import hashlib
import os
import random
from pathlib import Path

import pytest
from helpers import SMALL, plan_of, write_out
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from washline.operators import apply_types, normalize_nulls, profile_types
from washline.plans import land_and_verify, verify_landing
from washline.sinks import write_object_csv
from washline.sources import csv
from washline.sources.csv import file_headers
from washline.sources.files import _url_like, landed_chunks, restore_files
from washline.sources import (
    classify_read_error,
    dedupe_header,
    file_checksums,
    land_files,
    list_files,
    probe_source,
    read_csv_table,
    read_object_csv,
)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def types(df):
    return [f.dataType.simpleString() for f in df.schema]


@pytest.mark.parametrize(
    "given, wanted",
    [
        (["a", "b", "c", "a"], ["a", "b", "c", "a.1"]),
        (["a", "a", "a"], ["a", "a.1", "a.2"]),
        (["a", "a", "a.1"], ["a", "a.2", "a.1"]),
        (["a", "a.1", "a"], ["a", "a.1", "a.2"]),
        ([None, "b", ""], ["Unnamed: 0", "b", "Unnamed: 2"]),
        (["a", "A"], ["a", "A"]),
    ],
)
def test_dedupe_header(given, wanted):
    assert dedupe_header(given) == wanted


def test_dedupe_header_when_case_does_not_count():
    assert dedupe_header(["a", "A", "b"], case_sensitive=False) == ["a", "A.1", "b"]


def test_read_types_and_missing_values(spark, any_ansi, csv_file):
    df = read_csv_table(
        spark, csv_file("a,b,c,a,t\n1,NA,x,2,True\n2,1.50, NA ,null,FALSE\n\n3,,y,4,\n")
    )
    assert df.columns == ["a", "b", "c", "a.1", "t"]
    assert types(df) == ["bigint", "double", "string", "bigint", "boolean"]
    assert rows(df) == [
        (1, None, "x", 2, True),
        (2, 1.5, " NA ", None, False),
        (3, None, "y", 4, None),
    ]


@pytest.mark.parametrize("multiline", [False, True])
def test_line_ends_and_byte_order_mark(spark, csv_file, multiline):
    for text in ("\ufeffa,b\r\n1,2\r\n", '\ufeff"a",b\n1,2'):
        df = read_csv_table(spark, csv_file(text), multiline=multiline)
        assert df.columns == ["a", "b"] and rows(df) == [(1, 2)]


@pytest.mark.parametrize("sep", [";", "\t", "|", "^", "]", "-", "\\", "x", "\x01"])
def test_separators(spark, csv_file, sep):
    lines = [f"a{sep}b", f'"p{sep}q"{sep}2', f"{sep}3", '5" z']
    df = read_csv_table(spark, csv_file("\n".join(lines) + "\n"), sep=sep, typed=False)
    assert rows(df) == sorted([(f"p{sep}q", "2"), (None, "3"), ('5" z', None)], key=repr)
    with pytest.raises(PySparkException, match="more than 2 fields"):
        write_out(read_csv_table(spark, csv_file(f"a{sep}b\n1{sep}2{sep}3\n"), sep=sep, typed=False))


def test_columns_and_key(spark, csv_file):
    path = csv_file("a;b;c\n1;x;2.5\n")
    df = read_csv_table(spark, path, sep=";", columns=["c", "a"])
    assert df.columns == ["a", "c"] and rows(df) == [(1, 2.5)]
    df = read_csv_table(spark, path, sep=";", key_column="c")
    assert df.columns == ["c", "a", "b"] and rows(df) == [(2.5, 1, "x")]
    with pytest.raises(ValueError, match="nope"):
        read_csv_table(spark, path, sep=";", columns=["a", "nope"])
    with pytest.raises(ValueError, match="nope"):
        read_csv_table(spark, path, sep=";", key_column="nope")


def test_known_types_need_no_pass_and_must_fit(spark, csv_file):
    path = csv_file("a,b\n1,x\n2,y\n")
    assert types(read_csv_table(spark, path, types={"a": "double"})) == ["double", "string"]
    with pytest.raises(PySparkException, match="column b holds text that is no bigint"):
        write_out(read_csv_table(spark, path, types={"b": "bigint"}))


def test_text_only_and_own_tokens(spark, csv_file):
    path = csv_file("a,b\n1,NA\n2,-\n")
    assert rows(read_csv_table(spark, path, typed=False)) == [("1", None), ("2", "-")]
    assert rows(read_csv_table(spark, path, typed=False, na_tokens=())) == [("1", "NA"), ("2", "-")]
    assert rows(read_csv_table(spark, path, na_tokens=["-"])) == [(1, "NA"), (2, None)]


@pytest.mark.parametrize(
    "line, row",
    [
        ("1", ("1", None)),
        ('"x,y",2', ("x,y", "2")),
        ('"x,y","2,2,2"', ("x,y", "2,2,2")),
        ('5" pipe,2', ('5" pipe', "2")),
        ('"a""b",2', ('a"b', "2")),
        ('"a""b","c,"""', ('a"b', 'c,"')),
        ("a\\b,\\", ("a\\b", "\\")),
        (" x , y ", (" x ", " y ")),
        (",2", (None, "2")),
    ],
)
def test_rows_that_fit(spark, any_ansi, csv_file, line, row):
    path = csv_file(f"a,b\n{line}\n3,4\n")
    for multiline in (False, True):
        df = read_csv_table(spark, path, typed=False, multiline=multiline)
        assert rows(df) == sorted([row, ("3", "4")], key=repr)


@pytest.mark.parametrize(
    "line", ["1,2,3", "1,2,", "1,2,,3", "1,2,3,4", '"x,y",2,', '"x,y",2,,"z"', '"x","y","z"']
)
def test_too_many_fields_is_an_error(spark, any_ansi, csv_file, line):
    path = csv_file(f"a,b\n5,6\n{line}\n")
    for multiline in (False, True):
        df = read_csv_table(spark, path, typed=False, multiline=multiline)
        with pytest.raises(PySparkException, match="more than 2 fields"):
            write_out(df)
        with pytest.raises(PySparkException, match="more than 2 fields"):
            df.select("a").count()


def test_long_separators(spark, csv_file):
    assert rows(read_csv_table(spark, csv_file("a||b\n1||2\n"), sep="||")) == [(1, 2)]
    with pytest.raises(PySparkException, match="more than 2 fields"):
        write_out(read_csv_table(spark, csv_file("a||b\n1||2||3\n"), sep="||", typed=False))


@pytest.mark.parametrize("record", ['"x\ny",2', '1,"x\ny,z"', '"p,q","x\r\ny"', '"a""\n",2'])
def test_line_breaks_in_quotes(spark, csv_file, record):
    path = csv_file(f"a,b\n{record}\n3,4\n")
    with pytest.raises(PySparkException, match="line break inside quotes"):
        write_out(read_csv_table(spark, path, typed=False))
    df = read_csv_table(spark, path, typed=False, multiline=True, line_sep="\n")
    assert df.count() == 2
    assert any("\n" in (v or "") for r in rows(df) for v in r)


def test_line_break_in_the_header(spark, csv_file):
    path = csv_file('"a\nb",c\n1,2\n')
    with pytest.raises(ValueError, match="header"):
        read_csv_table(spark, path)
    df = read_csv_table(spark, path, multiline=True)
    assert df.columns == ["a\nb", "c"] and rows(df) == [(1, 2)]


def test_one_column_keeps_missing_rows(spark, tmp_path):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "x string")
    path = write_object_csv(df, str(tmp_path), "bucket", "key")
    assert rows(read_csv_table(spark, path)) == sorted([("a",), (None,), ("b",)], key=repr)


def test_empty_file_and_header_only(spark, csv_file):
    with pytest.raises(ValueError, match="no header"):
        read_csv_table(spark, csv_file(""))
    df = read_csv_table(spark, csv_file("a,b\n"))
    assert df.columns == ["a", "b"] and types(df) == ["double", "double"] and df.count() == 0


def test_one_large_file_is_read_by_many_tasks(spark, csv_file):
    lines = "".join(f"{i},name {i}\n" for i in range(200_000))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512k")
    try:
        df = read_csv_table(spark, csv_file("id,name\n" + lines), types={"id": "bigint"})
        tasks = df.select(F.spark_partition_id().alias("p")).distinct().count()
        assert tasks >= 4
        total = df.agg(F.count("*"), F.sum("id"), F.countDistinct("name")).collect()[0]
        assert tuple(total) == (200_000, 200_000 * 199_999 // 2, 200_000)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_csv_round_trip_of_hard_texts(spark, any_ansi, tmp_path):
    rng = random.Random(3)
    pieces = ["\n", "\r", "\r\n", '"', '""', ",", " ", "\\", "\t", "#", "'", "NA", "a", "\u2028", ";"]
    given = [(i, "".join(rng.choices(pieces, k=rng.randint(0, 8)))) for i in range(500)]
    given += [(500, None), (501, " lead"), (502, "trail "), (503, '"')]
    df = spark.createDataFrame(given, "id int, x string")
    write_object_csv(df, str(tmp_path), "b", "k", max_records_per_file=100)
    back = read_object_csv(
        spark, str(tmp_path), "b", "k", typed=False, na_tokens=(), multiline=True, line_sep="\n"
    )
    # An empty text and a null are both an empty field; everything else must come back as it was.
    assert {int(i): x or None for i, x in rows(back)} == {i: x or None for i, x in given}
    assert len(os.listdir(tmp_path / "b" / "k")) >= 5


def test_times_keep_their_microseconds(spark, tmp_path):
    df = spark.sql(
        "select timestamp_ntz'2024-01-01 00:00:07.179575' a, timestamp'2024-01-01 00:00:07.179575' b"
    )
    path = write_object_csv(df, str(tmp_path), "b", "k")
    assert rows(read_csv_table(spark, path)) == [
        ("2024-01-01 00:00:07.179575", "2024-01-01 00:00:07.179575Z")
    ]


def test_write_replaces(spark, tmp_path):
    for n in (5, 3):
        path = write_object_csv(spark.range(n), str(tmp_path), "b", "k")
    assert read_csv_table(spark, path).count() == 3


def test_missing_source_raises(spark, tmp_path):
    with pytest.raises(AnalysisException) as caught:
        read_csv_table(spark, str(tmp_path / "nothing.csv"))
    assert classify_read_error(caught.value) == ("missing", "PATH_NOT_FOUND")


def test_normalize_nulls(spark, any_ansi):
    df = spark.createDataFrame([("NA", " NA ", 1), ("<NA>", "na", 2)], "x string, y string, n int")
    assert rows(normalize_nulls(df)) == [(None, " NA ", 1), (None, "na", 2)]
    assert rows(normalize_nulls(df, ["na"], "y")) == [("<NA>", None, 2), ("NA", " NA ", 1)]


PROFILES = [
    (["1", " 5 ", "+7", "007", None], "bigint"),
    (["1", "1.5", "1e3", ".5", "1."], "double"),
    (["inf", "-Infinity", "1"], "double"),
    (["True", "false", None], "boolean"),
    (["True", "1"], "string"),
    (["true ", "false"], "string"),
    (["1", "x"], "string"),
    ([None, None], "double"),
    ([], "double"),
    (["99999999999999999999", "1"], "string"),
    (["9223372036854775807"], "bigint"),
    (["9223372036854775808", "-1"], "string"),
    (["99999999999999999999", "1.5"], "string"),
    (["1e400", "1"], "string"),
    (["1.5d", "2"], "string"),
    (["0x1F", "2"], "string"),
    (["1_0", "2"], "string"),
    (["2019-01-05"], "string"),
]


@pytest.mark.parametrize("values, wanted", PROFILES)
def test_profile(spark, any_ansi, values, wanted):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    found = profile_types(df).collect()
    assert [(r["column"], r["n"], r["inferred"]) for r in found] == [
        ("x", sum(v is not None for v in values), wanted)
    ]
    typed = apply_types(df, profile_types(df))
    assert types(typed) == [wanted]
    assert typed.filter("x is not null").count() == sum(v is not None for v in values)


def test_profile_of_a_wide_table_compiles_small_methods(spark):
    wide = spark.range(50).select(
        *[(F.col("id") * i).cast("string").alias(f"c{i}") for i in range(300)]
    )
    found = profile_types(wide).collect()
    assert len(found) == 300 and {r["inferred"] for r in found} == {"bigint"}
    assert {r["n"] for r in found} == {50}


def test_profile_refuses_a_table_without_text(spark):
    with pytest.raises(ValueError):
        profile_types(spark.range(1))


# --- headers of several files -------------------------------------------------------------------


@pytest.fixture
def csv_folder(tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()

    def write(**files):
        for name, text in files.items():
            (folder / f"{name}.csv").write_bytes(text.encode())
        return str(folder)

    return write


def test_columns_in_another_order(spark, csv_folder):
    path = csv_folder(
        a="id,price,t\n1,10,x\n",
        b='price,"id",t\r\n20,2,"a,b"\r\n21,3,\r\n',
        c="\n \nt,price,id\ny,40,4\n",
        d='"id",price,t\n5,50,z\n',
        empty="",
        only_header="t,id,price\n",
        longest="id,price,t\n" + "".join(f"{i},{i * 10},l\n" for i in range(100, 3000)),
    )
    wanted = {1: (10, "x"), 2: (20, "a,b"), 3: (21, None), 4: (40, "y"), 5: (50, "z")}
    wanted |= {i: (i * 10, "l") for i in range(100, 3000)}
    df = read_csv_table(spark, path)
    assert {r["id"]: (r["price"], r["t"]) for r in df.collect()} == wanted and df.count() == len(wanted)
    assert sorted(df.columns) == ["id", "price", "t"] and read_csv_table(spark, path, columns=["t"]).columns == ["t"]


@pytest.mark.parametrize(
    "other", ["3,30\n4,40\n", "id\n7\n", "id,price,more\n1,2,3\n", "id,cost\n1,2\n", "id,Price\n1,2\n", "id,id\n1,2\n"]
)
def test_files_with_other_columns_are_refused(spark, csv_folder, other):
    path = csv_folder(a="id,price\n1,10\n", b="price,id\n20,2\n", c=other)
    with pytest.raises(ValueError, match="header of .*csv is"):
        read_csv_table(spark, path, typed=False)


def test_equal_headers_are_known_without_sorting_lines(spark, csv_folder, monkeypatch):
    more = {f"f{i}": f"id,price\n{i},id\nid,price\n" for i in range(150)}
    path = csv_folder(a="id,price\n" + "1,10\n" * 5000, b="\n \nid,price\n2,20\n", empty="", **more)
    asked = []
    monkeypatch.setattr(csv, "file_headers", lambda *a: asked.append(a) or file_headers(*a))
    df = read_csv_table(spark, path, typed=False)
    assert df.count() == 5000 + 1 + 300 and df.where("price = 'id'").count() == 150 and not asked
    # A file without a header may hold the header's text further below.
    csv_folder(late="9,90\nid,price\n")
    with pytest.raises(ValueError, match="header of .*late.csv is"):
        read_csv_table(spark, path, typed=False)
    assert asked


def test_header_is_read_from_the_first_block_of_a_file(spark, csv_folder):
    """Of a file in several blocks, whichever task comes first."""
    lines = "".join(f"{i},p{i}\n" for i in range(20_000))
    path = csv_folder(a="id,price\n" + lines, b="price,id\n" + lines)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = read_csv_table(spark, path, typed=False)
        assert df.rdd.getNumPartitions() > 8
        assert df.where("id like 'p%'").count() == 20_000 or df.where("price like 'p%'").count() == 20_000
        headers = {r["file"].rsplit("/", 1)[1]: r["header"] for r in file_headers(spark, path).collect()}
        assert headers == {"a.csv": "id,price", "b.csv": "price,id"}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_more_orders_than_files_in_one_look(spark, csv_folder):
    rng = random.Random(2)
    names, files, wanted = list("abcdefg"), {}, []
    for i in range(40):
        own = rng.sample(names, len(names))
        row = {n: f"{n}{i}" for n in names}
        files[f"f{i}"] = ",".join(own) + "\n" + ",".join(row[n] for n in own) + "\n"
        wanted.append(tuple(row[n] for n in names))
    df = read_csv_table(spark, csv_folder(**files), typed=False)
    assert sorted(map(tuple, df.select(*names).collect())) == sorted(wanted)


# --- files ------------------------------------------------------------------------------------


@pytest.fixture
def folder(tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    rng = random.Random(5)
    for i in range(12):
        (src / f"f{i}.bin").write_bytes(rng.randbytes(1000 * i))  # f0.bin is empty
    return src


def on_disk(folder):
    return {
        f"file:{p}": (p.stat().st_size, hashlib.sha256(p.read_bytes()).hexdigest())
        for p in folder.rglob("*")
        if p.is_file()
    }


def test_list_files(spark, folder):
    df = list_files(spark, str(folder))
    assert "content" not in plan_of(df)
    assert {(r["path"], r["length"]) for r in df.collect()} == {
        (p, size) for p, (size, _) in on_disk(folder).items()
    }
    assert all(r["modificationTime"] is not None for r in df.collect())


def test_nested_folders_on_request(spark, folder):
    (folder / "deep").mkdir()
    (folder / "deep" / "f0.bin").write_bytes(b"same name, other folder")
    found = {r["path"]: (r["length"], r["sha256"]) for r in file_checksums(spark, str(folder), True).collect()}
    assert found == on_disk(folder) and len(found) == 13


def test_unusual_file_names(spark, tmp_path):
    for name in ("a b+c%20d.txt", "\u00e9=1.txt", "empty x+y%2B.txt"):
        (tmp_path / name).write_bytes(b"" if name.startswith("empty") else b"1")
    found = {r["path"]: (r["length"], r["sha256"]) for r in file_checksums(spark, str(tmp_path)).collect()}
    assert found == on_disk(tmp_path)


def test_checksums(spark, folder):
    found = {r["path"]: (r["length"], r["sha256"]) for r in file_checksums(spark, str(folder)).collect()}
    assert found == on_disk(folder)
    with pytest.raises(PySparkException, match="no such file or folder"):
        file_checksums(spark, str(folder / "absent.bin")).collect()
    assert file_checksums(spark, str(folder / "f3.bin")).count() == 1


def test_landing(spark, folder, tmp_path):
    landing = str(tmp_path / "landing")
    landed = land_files(spark, str(folder), landing)
    assert {r["path"]: (r["length"], r["sha256"]) for r in landed.collect()} == on_disk(folder)
    assert all(r["ok"] for r in verify_landing(spark, str(folder), landing).collect())


@pytest.mark.parametrize("chunk", [1, 999, 1000, 5000, 1 << 20])
def test_files_above_the_chunk_size(spark, folder, tmp_path, chunk):
    if chunk == 1:
        for i in range(1, 12):
            (folder / f"f{i}.bin").write_bytes(bytes(range(3 * i)))
    landing = str(tmp_path / "landing")
    out = land_and_verify(spark, str(folder), landing, chunk=chunk).collect()
    assert {r["path"]: (r["length"], r["sha256"]) for r in out} == on_disk(folder) and all(r["ok"] for r in out)
    chunks = {}
    for r in landed_chunks(spark, landing).collect():
        assert 0 < len(r["content"]) <= chunk
        chunks.setdefault(r["path"], []).append((r["number"], bytes(r["content"])))
    for path, (size, _) in on_disk(folder).items():
        own = sorted(chunks.get(path, []))
        assert [n for n, _ in own] == list(range(-(-size // chunk)))
        assert b"".join(c for _, c in own) == Path(path.removeprefix("file:")).read_bytes()


def test_lost_or_exchanged_chunks_are_found(spark, folder, tmp_path):
    landing, bad = str(tmp_path / "landing"), str(tmp_path / "bad")
    land_files(spark, str(folder), landing, chunk=1000)
    spark.read.parquet(f"{landing}/files").write.parquet(f"{bad}/files")
    moved = F.when(F.col("path").endswith("f7.bin"), 6 - F.col("number")).otherwise(F.col("number"))
    lost = F.col("path").endswith("f5.bin") & (F.col("number") == 4)
    twice = spark.read.parquet(f"{landing}/chunks").where(F.col("path").endswith("f9.bin"))
    kept = spark.read.parquet(f"{landing}/chunks").where(~lost).withColumn("number", moved)
    kept.unionByName(twice).write.parquet(f"{bad}/chunks")
    out = verify_landing(spark, str(folder), bad).collect()
    assert len(out) == 12
    assert {r["path"].rsplit("/", 1)[1] for r in out if not r["ok"]} == {f"f{i}.bin" for i in (5, 7, 9)}


def test_restored_files(spark, folder, tmp_path):
    landing, back = str(tmp_path / "landing"), tmp_path / "back"
    land_files(spark, str(folder), landing)
    found = restore_files(landed_chunks(spark, landing), str(back)).collect()
    assert len(found) == 11  # an empty file has no chunk
    assert {p.name: p.read_bytes() for p in back.iterdir()} == {
        p.name: p.read_bytes() for p in folder.iterdir() if p.stat().st_size
    }
    land_files(spark, str(folder), landing, chunk=500)
    with pytest.raises(PySparkException, match="several chunks"):
        restore_files(landed_chunks(spark, landing), str(tmp_path / "other")).collect()


def test_names_stay_out_of_the_driver(spark, folder, tmp_path):
    """The plans hold the root's name and no other."""
    for i in range(3):
        (folder / f"deep{i}").mkdir()
        (folder / f"deep{i}" / "inner.bin").write_bytes(b"x")
    df = file_checksums(spark, str(folder), recursive=True)
    plan = df._jdf.queryExecution().toString()
    assert "f3.bin" not in plan and "inner" not in plan and df.count() == 15


def test_opener_of_the_caller(spark, folder):
    from pyarrow import fs

    def opener(url):
        return fs.SubTreeFileSystem("/", fs.LocalFileSystem()), url.removeprefix("file:/")

    found = file_checksums(spark, str(folder), opener=opener).collect()
    assert {r["sha256"] for r in found} == {h for _, h in on_disk(folder).values()}


def test_urls_of_object_stores():
    assert _url_like("s3a://bucket/a", "bucket/a/b c.txt") == "s3a://bucket/a/b c.txt"
    assert _url_like("hdfs://name:8020/a", "/a/b") == "hdfs://name:8020/a/b"
    assert _url_like("abfss://box@account.dfs.core.windows.net/a", "box/a/b") == "abfss://box@account.dfs.core.windows.net/a/b"
    assert _url_like("file:/a", "/a/b") == "file:/a/b"


@pytest.mark.parametrize("rehash", [False, True])
def test_verification_finds_every_change(spark, folder, tmp_path, rehash):
    landing = str(tmp_path / "landing")
    out = land_and_verify(spark, str(folder), landing, rehash_source=rehash).collect()
    assert len(out) == 12 and all(r["ok"] for r in out)
    assert {r["path"]: (r["length"], r["sha256"]) for r in out} == on_disk(folder)
    (folder / "f3.bin").write_bytes(b"x" * 3000)  # same length, other bytes
    (folder / "f4.bin").write_bytes(b"")
    (folder / "f5.bin").unlink()
    (folder / "new.bin").write_bytes(b"new")
    spark.catalog.refreshByPath(str(folder))
    out = verify_landing(spark, str(folder), landing, rehash_source=rehash).collect()
    bad = {r["path"].rsplit("/", 1)[1] for r in out if not r["ok"]}
    assert bad == {"f3.bin", "f4.bin", "f5.bin", "new.bin"} and len(out) == 13


def test_rehashing_sees_through_a_kept_time(spark, folder, tmp_path):
    landing = str(tmp_path / "landing")
    land_files(spark, str(folder), landing)
    changed = folder / "f3.bin"
    times = changed.stat()
    changed.write_bytes(b"y" * 3000)
    os.utime(changed, ns=(times.st_atime_ns, times.st_mtime_ns))
    by_listing = verify_landing(spark, str(folder), landing).collect()
    assert all(r["ok"] for r in by_listing)
    by_hash = verify_landing(spark, str(folder), landing, rehash_source=True).collect()
    assert [r["path"].rsplit("/", 1)[1] for r in by_hash if not r["ok"]] == ["f3.bin"]


def test_damaged_landing_is_found(spark, folder, tmp_path):
    good, landing = str(tmp_path / "good"), str(tmp_path / "landing")
    broken = F.when(F.col("path").endswith("f7.bin"), F.lit(b"z")).otherwise(F.col("content"))
    land_files(spark, str(folder), good).write.parquet(f"{landing}/files")
    landed_chunks(spark, good).withColumn("content", broken).write.parquet(f"{landing}/chunks")
    out = verify_landing(spark, str(folder), landing).collect()
    assert [r["path"].rsplit("/", 1)[1] for r in out if not r["ok"]] == ["f7.bin"]


def probed(spark, paths, **how):
    found = probe_source(spark, paths, **how).collect()
    assert {r["path"] for r in found} == set(paths)
    return {(r["file"] or r["path"]).rsplit("/", 1)[1]: (r["status"], r["error_class"], r["length"]) for r in found}


def test_probe(spark, csv_file, tmp_path):
    good = csv_file("a\n1\n")
    absent = str(tmp_path / "absent-403-Forbidden")
    (tmp_path / "nothing").mkdir()
    assert probed(spark, [good, absent, str(tmp_path / "nothing")]) == {
        good.rsplit("/", 1)[1]: ("ok", None, 4),
        "absent-403-Forbidden": ("missing", "FileNotFoundError", None),
        "nothing": ("empty", None, None),
    }
    tables = [f"{SMALL}/{t}.parquet" for t in ("orders", "pages")]
    assert {r["status"] for r in probe_source(spark, tables).collect()} == {"ok"}


def test_probe_reads_every_file_to_its_end(spark, tmp_path):
    import gzip

    folder = tmp_path / "several"
    folder.mkdir()
    (folder / "a.csv").write_text("id\n1\n")
    (folder / "b.csv").touch()
    whole = gzip.compress(b"id\n" + bytes(range(256)) * 5000)
    (folder / "c.csv.gz").write_bytes(whole)
    (folder / "d.csv.gz").write_bytes(whole[:-200])
    (folder / "e.csv").write_bytes("é".encode("latin-1"))
    (folder / "long.csv").write_bytes(b"x" * 9_000_000 + "é".encode()[:1])
    found = probed(spark, [str(folder)])
    assert found["d.csv.gz"][0] == "error" and found["b.csv"] == ("empty", None, 0)
    assert {n for n, (status, *_) in found.items() if status == "ok"} == {"a.csv", "c.csv.gz", "e.csv", "long.csv"}
    assert found["c.csv.gz"][2] == 3 + 256 * 5000 and found["long.csv"][2] == 9_000_001
    text = probed(spark, [str(folder)], encoding="utf-8")
    assert {n for n, (status, *_) in text.items() if status == "ok"} == {"a.csv"}
    assert text["e.csv"][1] == text["long.csv"][1] == "UnicodeDecodeError"


def test_probe_reports_denied_files(spark, csv_file):
    def opener(url):
        raise PermissionError("Forbidden")

    good = csv_file("a\n")
    assert [(r["status"], r["error_class"]) for r in probe_source(spark, [good], opener=opener).collect()] == [("denied", "PermissionError")]


@pytest.mark.parametrize(
    "message, status",
    [
        ("java.nio.file.AccessDeniedException: s3a://b/k: Status Code: 403", "denied"),
        ("org.apache.hadoop.security.AccessControlException: Permission denied", "denied"),
        ("Service: S3, Status Code: 403, Request ID: 1", "denied"),
        ("java.io.FileNotFoundException: No such file", "missing"),
        ("Service: S3, Status Code: 404, Request ID: 1", "missing"),
        ("read timed out at /data/404/part-403.csv", "error"),
    ],
)
def test_error_classes(message, status):
    assert classify_read_error(RuntimeError(message)) == (status, "RuntimeError")


def test_undecodable_bytes_are_refused(spark, tmp_path):
    path = tmp_path / "latin.csv"
    path.write_bytes("id,name\n1,caf\u00e9\n2,tea\n".encode("latin-1"))
    with pytest.raises(Exception, match="bytes that are no UTF-8"):
        read_csv_table(spark, str(path)).collect()
    read = read_csv_table(spark, str(path), encoding="ISO-8859-1")
    assert sorted(map(tuple, read.collect())) == [(1, "caf\u00e9"), (2, "tea")]


def test_empty_files_have_a_time(spark, tmp_path):
    (tmp_path / "empty").touch()
    (tmp_path / "full").write_text("x")
    times = {r["length"]: r["modificationTime"] for r in list_files(spark, str(tmp_path)).collect()}
    assert set(times) == {0, 1} and abs(times[0] - times[1]).total_seconds() < 60
