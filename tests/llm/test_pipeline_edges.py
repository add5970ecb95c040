"""Pipeline stages on nulls, empty tables, repeated rows, very long texts and clashing names."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))

import corpus_pipeline  # noqa: E402

LONG = "many different words stand in this long text, " * 30_000
SCHEMA = "doc_id long, text string, score string, predicted int, `a.b` string, component_id int, fingerprint string, `row` int"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A folder with few labels and a benchmark that has odd rows."""
    top = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(1, 1, 0), (None, None, None), (1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{top}/labels.parquet")
    items = [(1, "the quick brown fox jumps over the lazy dog while nobody looks"), (None, None), (2, ""), (1, "x")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{top}/benchmark.parquet")
    return top


def table(spark, rows):
    return spark.createDataFrame([(i, t, "s", 7, "d", 8, "f", 9) for i, t in rows], SCHEMA)


ROWS = [(1, "a first text of some words"), (2, None), (3, ""), (None, None), (None, "without an id"), (5, "same text of some words twice"), (5, "same text of some words twice"), (6, LONG)]


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:-1])
def test_stages_keep_columns_whatever_their_names(spark, folder, name, stage):
    docs = table(spark, ROWS)
    out = stage(spark, docs, folder)
    assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
    kept = [tuple(r) for r in out.collect()]
    assert all(r[2:] == ("s", 7, "d", 8, "f", 9) for r in kept)
    whole = {(i, t) for i, t in ROWS}
    assert {r[:2] for r in kept} <= whole and sum(r[0] == 5 for r in kept) in (0, 2)
    assert stage(spark, table(spark, []), folder).collect() == []


def test_one_of_each_and_leaks(spark, folder):
    docs = table(spark, [*ROWS, (7, "a first text of some words"), (8, "see: The quick  brown fox jumps over the lazy dog, while nobody looks!")])
    single = corpus_pipeline.keep_one_of_each(spark, docs, folder).select("doc_id").collect()
    assert sorted((r[0] for r in single), key=repr) == sorted([1, 2, 5, 5, 6, 8, None, None], key=repr)
    clean = corpus_pipeline.drop_leaks(spark, docs, folder).select("doc_id").collect()
    assert sorted((r[0] for r in clean), key=repr) == sorted([i for i, _ in ROWS] + [7], key=repr)


def test_pack_takes_every_row(spark, folder):
    packed = corpus_pipeline.pack(spark, table(spark, ROWS), folder).collect()
    assert sorted({repr(r["doc_id"]) for r in packed}) == sorted({repr(i) for i, _ in ROWS})
    assert corpus_pipeline.pack(spark, table(spark, []), folder).collect() == []
