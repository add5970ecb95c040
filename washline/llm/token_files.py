"""Token files: concatenated ids with Elias-Fano coded document boundaries.

`write_token_files` encodes the documents and writes two Parquet tables below one folder, both
through Spark's writer, so that a repeated or speculative task leaves no second copy:

- `blocks`: consecutive documents in ascending doc_id order.  bucket, block (its number in the
  bucket), first (ids of the bucket before it), n_docs, n_ids, n_null_ids (documents without doc_id,
  which come first), doc_ids and ends (Elias-Fano: the documents' numbers, and their ends in the
  block), width (bytes an id takes), ids.
- `index`: for each bucket, the ids of all buckets before it; one row per bucket.

A block ends with the document that takes it to `block_ids` ids, so a row stays small whatever the
input; a longer document has a block to itself.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from washline.llm import elias_fano
from washline.llm.common import range_bucket, shuffle_partitions, slices, text_or_empty
from washline.llm.tokens import encoder
from washline.names import column

BLOCKS = "bucket int, block int, first bigint, n_docs bigint, n_ids bigint, n_null_ids bigint, doc_ids binary, ends binary, width int, ids binary"
DOCUMENTS = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, block_ids: int = 1 << 18, buckets_per_partition: int = 4) -> None:
    """Write every text's ids, each followed by `end_id`, in ascending doc_id order.

    A null text counts as empty.  Null doc_ids come first; rows of one doc_id follow each other in
    the order of a hash of their texts.  Other columns are not looked at.
    """
    spark = docs.sparkSession
    partitions = shuffle_partitions(spark)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        wide = max(end_id, own.tokenizer.get_vocab_size() - 1) >= 1 << 16
        end = np.array([end_id], "<u4").tobytes()
        for part in slices(batches):
            ids = [own.encode(text) + end for text in part.column("text").to_pylist()]
            if not wide:
                ids = [np.frombuffer(x, "<u4").astype("<u2").tobytes() for x in ids]
            columns = [*part.columns[:3], pa.array(ids, pa.binary()), pa.array([4 if wide else 2] * len(ids), pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "doc_id", "tie", "ids", "width"])

    rows = docs.select(
        range_bucket(docs, "doc_id", partitions * buckets_per_partition).alias("bucket"),
        column("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64(text_or_empty()).alias("tie"),
        text_or_empty().alias("text"),
    )
    encoded = rows.mapInArrow(encode, "bucket int, doc_id bigint, tie bigint, ids binary, width int")
    ordered = encoded.repartition(partitions, "bucket").sortWithinPartitions("bucket", F.col("doc_id").asc_nulls_first(), "tie")
    ordered.mapInArrow(lambda batches: _blocks(batches, block_ids), BLOCKS).write.parquet(f"{path}/blocks")

    # One row per bucket, of which there are at most partitions * buckets_per_partition + 1.
    sizes = spark.read.schema(BLOCKS).parquet(f"{path}/blocks").groupBy("bucket").agg(F.sum("n_ids").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes.select("bucket", before.alias("base")).write.parquet(f"{path}/index")


def _blocks(batches: Iterator[pa.RecordBatch], block_ids: int) -> Iterator[pa.RecordBatch]:
    bucket, block, first, width = None, 0, 0, 0
    doc_ids: list[int | None] = []
    ids: list[bytes] = []
    held = 0
    schema = pa.schema([(n, {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}[t]) for n, t in (x.split() for x in BLOCKS.split(", "))])

    def full() -> pa.RecordBatch:
        known = [x for x in doc_ids if x is not None]
        ends = np.cumsum([len(x) // width for x in ids])
        row = (bucket, block, first, len(ids), int(ends[-1]), len(ids) - len(known), elias_fano.encode(np.array(known, np.int64)), elias_fano.encode(ends), width, b"".join(ids))
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

    for part in slices(batches):
        for b, doc_id, _, x, w in zip(*(c.to_pylist() for c in part.columns), strict=True):
            if ids and (b != bucket or held >= block_ids):
                yield full()
                block, first = block + 1, first + held
                doc_ids, ids, held = [], [], 0
            if b != bucket:
                bucket, block, first = b, 0, 0
            width = w
            doc_ids.append(doc_id)
            ids.append(x)
            held += len(x) // w
    if ids:
        yield full()


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    index = spark.read.schema("bucket int, base bigint").parquet(f"{path}/index")
    placed = blocks.join(F.broadcast(index), "bucket").withColumn("first", F.col("first") + F.col("base"))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1):
            row = part.to_pylist()[0]
            ids = np.frombuffer(row["ids"], f"<u{row['width']}").astype("<u4")
            ends = elias_fano.decode(row["ends"])
            starts = np.concatenate([[0], ends[:-1]])
            doc_ids = [None] * row["n_null_ids"] + elias_fano.decode(row["doc_ids"]).tolist()
            crcs = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array(starts + row["first"], pa.int64()), pa.array(ends - starts, pa.int64()), pa.array(crcs, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return placed.select("first", "n_null_ids", "doc_ids", "ends", "width", "ids").mapInArrow(documents, DOCUMENTS)


def document_ids(block: dict, i: int) -> np.ndarray:
    """Ids of the i-th document of one row of `blocks`, found by two selects."""
    start = elias_fano.select(block["ends"], i - 1) if i else 0
    end = elias_fano.select(block["ends"], i)
    return np.frombuffer(block["ids"], f"<u{block['width']}", end - start, start * block["width"])
