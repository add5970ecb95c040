"""Landing with proof: list, copy, hash again, compare."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from washline.functions import sha256_hex
from washline.sources.files import CHUNK, Opener, hashed, land_files, landed_chunks, landed_files, list_files, open_filesystem


def _digest_of(chunks: DataFrame) -> DataFrame:
    """path, bytes, digest: of each file, what its landed chunks in order come to.

    Each chunk is hashed where it is read; a file's digests, 64 characters a chunk, are hashed again
    in the order of their numbers, which must run from 0 on without a gap.
    """
    own = chunks.select("path", "number", F.octet_length("content").alias("size"), sha256_hex(F.col("content")).alias("own"))
    files = own.groupBy("path").agg(
        F.sum("size").alias("bytes"),
        F.count("*").alias("n"),
        F.min("number").alias("first"),
        F.max("number").alias("last"),
        F.array_sort(F.collect_list(F.struct("number", "own"))).alias("parts"),
    )
    whole = (F.col("first") == 0) & (F.col("last") == F.col("n") - 1)
    digest = sha256_hex(F.array_join(F.transform("parts", lambda p: p["own"]), ""))
    return files.select("path", "bytes", F.when(whole, digest).alias("digest"))


def verify_landing(
    spark: SparkSession,
    src_dir: str,
    landing: str,
    recursive: bool = False,
    rehash_source: bool = False,
    opener: Opener = open_filesystem,
) -> DataFrame:
    """path, length, sha256, ok for every file on either side.

    Hashes the landed bytes anew, chunk by chunk, and compares their digests with those that a reading of
    the source from begin to end has noted beside its SHA-256; and the source's listing now with the
    noted one.  A file that is missing on one side, or whose length, time or bytes differ, has ok=false.
    The listing costs no content read; with `rehash_source` the source is read and hashed again as well.
    """
    source = list_files(spark, src_dir, recursive, opener).select(
        "path",
        F.col("length").alias("src_length"),
        F.col("modificationTime").alias("src_time"),
    )
    noted = landed_files(spark, landing)
    nothing = sha256_hex(F.lit(""))
    same = (
        (F.col("src_length") == F.col("length"))
        & (F.col("length") == F.coalesce("bytes", F.lit(0)))
        & F.col("src_time").eqNullSafe(F.col("modificationTime"))
        & (F.col("chunks_sha256") == F.when(F.col("bytes").isNull(), nothing).otherwise(F.col("digest")))
    )
    own = noted.join(_digest_of(landed_chunks(spark, landing)), "path", "full_outer")
    both = source.join(own, "path", "full_outer")
    if rehash_source:
        now = hashed(noted.select("path").join(source.select("path"), "path"), opener=opener)
        both = both.join(now.select("path", F.col("sha256").alias("src_sha256")), "path", "left")
        same = same & (F.col("src_sha256") == F.col("sha256"))
    return both.select(
        "path",
        F.coalesce("length", "bytes", "src_length").alias("length"),
        "sha256",
        F.coalesce(same, F.lit(False)).alias("ok"),
    )


def land_and_verify(
    spark: SparkSession,
    src_dir: str,
    landing: str,
    recursive: bool = False,
    rehash_source: bool = False,
    chunk: int = CHUNK,
    opener: Opener = open_filesystem,
) -> DataFrame:
    """Land the files of a folder, then verify every one of them."""
    land_files(spark, src_dir, landing, recursive, chunk, opener)
    return verify_landing(spark, src_dir, landing, recursive, rehash_source, opener)
