"""SimHash near-duplicates by deletion-variant signatures.

A text's fingerprint has a bit set if over half of its shingles' 64-bit hashes have it.  Two
fingerprints link if they differ in at most `distance` bits.

Search: cut the 64 bits into so few segments that, of `distance` differing bits, at most one falls
into some segment: (distance + 1) // 2 segments.  Each fingerprint is indexed by every segment with
one bit deleted, and by the segment itself.  Two segments that differ in one bit are equal
once that bit is deleted, so equality joins find all candidates; counting the differing bits decides.

Copies: only distinct fingerprints are searched.  A segment value that many fingerprints share (a
large group of near copies) would give all pairs of them.  There the other bits must be within
`distance` too, so the search is repeated inside the group on the remaining bits, cut in the same
way; that is exact and needs no cap.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from washline.llm.common import shuffle_partitions, slices, stage, text_or_empty, with_fields
from washline.llm.components import connected_components
from washline.names import column

# What the contract calls a word, the hash seed, the shingle length and the distance.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SEED = 42
SHINGLE = 3
DISTANCE = 3

#: Keys with more fingerprints than this are searched again inside.
CROWDED = 64

#: Where only so many bits are left, a group is small by itself.
FEW_BITS = 8

#: So many 8-byte keys are broadcast at most; more are joined by a shuffle.
MOST_BROADCAST = 1_000_000

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint_of(text: str, shingle: int = SHINGLE) -> int:
    """Of one text; repeats count, a text of fewer words is one shingle, one without words gives 0."""
    words = [w.encode(errors="replace") for w in WORD.findall(text)]
    if not words:
        return 0
    joined = b" ".join(words).translate(LOWER)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) > shingle:
        starts, ends = starts[: 1 - shingle or None], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    hashes = [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
    return majority(np.array(hashes, np.uint64))


def majority(hashes: np.ndarray) -> int:
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 14):
        part = hashes[i : i + (1 << 14)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits((2 * ones > len(hashes)).astype(np.uint8), bitorder="little").view(np.uint64)[0])


def simhash(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Add `fingerprint`, a bigint, to rows with a text; a null text counts as empty.

    A column called fingerprint is replaced; the others stay.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            *own, text = part.columns
            found = [fingerprint_of(t, shingle) for t in text.to_pylist()]
            values = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*own, values], [*names, "fingerprint"])

    kept = docs.drop("fingerprint")
    names = kept.columns
    schema = with_fields(kept.schema, fingerprint=T.LongType())
    return kept.select(*map(column, names), text_or_empty().alias("__text")).mapInArrow(add, schema)


def links(fingerprints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """All pairs (a, b) of distinct values in the bigint column `fingerprint` within `distance` bits, each once."""
    own = fingerprints.select(F.col("fingerprint").alias("f")).where("f is not null").distinct()
    spread = own.withColumn("group", F.lit(0).cast("bigint")).repartition(shuffle_partitions(own.sparkSession))
    stored = stage(spread, "fingerprints")
    return _search(stored, list(range(64)), distance).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _search(rows: DataFrame, bits: list[int], distance: int) -> DataFrame:
    """Pairs of rows (f, group) of one group within `distance` bits; `bits`: where a group's rows may differ."""
    segments = max(1, (distance + 1) // 2)
    found = None
    for number in range(segments):
        own = bits[number::segments]
        rest = [b for b in bits if b not in own]
        keyed = rows.select("f", F.explode(_variants(own)).alias("v"), F.xxhash64("group", F.lit(number)).alias("g")).select("f", F.xxhash64("g", "v.bit", "v.rest").alias("key"), "v.one")
        pairs = _pairs(keyed, rest, distance)
        found = pairs if found is None else found.unionByName(pairs)
    return found


def _variants(bits: list[int]) -> Column:
    """The segment of `f` in these bits as it is (one: null), and with each bit deleted (one: was it set)."""
    signed = lambda x: F.lit(x - (1 << 64) * (x >> 63))
    mask = sum(1 << b for b in bits)
    whole = [(F.lit(-1), F.col("f").bitwiseAND(signed(mask)), F.lit(None).cast("boolean"))]
    deleted = [(F.lit(b), F.col("f").bitwiseAND(signed(mask & ~(1 << b))), F.col("f").bitwiseAND(signed(1 << b)) != 0) for b in bits]
    return F.array(*(F.struct(b.alias("bit"), rest.alias("rest"), one.alias("one")) for b, rest, one in whole + deleted))


def _pairs(keyed: DataFrame, rest: list[int], distance: int) -> DataFrame:
    """Rows that share a key and are near: those with the deleted bit 0 meet those with 1."""
    crowded = None
    if len(rest) > FEW_BITS:
        crowded = stage(keyed.groupBy("key").count().where(F.col("count") > CROWDED).select("key"), "crowded-keys")
        n = crowded.count()
        if not n:
            crowded = None
    alone = keyed
    if crowded is not None:
        few = F.broadcast(crowded) if n <= MOST_BROADCAST else crowded
        alone = keyed.join(few, "key", "left_anti")
    zeros = alone.where("one is null or not one").select(F.col("f").alias("a"), "key", F.col("one").alias("one_a"))
    ones = alone.where("one is null or one").select(F.col("f").alias("b"), "key", F.col("one").alias("one_b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    pairs = zeros.join(ones.hint("merge"), (zeros["key"] == ones["key"]) & near & (F.col("one_a").isNull() & (F.col("a") < F.col("b")) | F.col("one_a").isNotNull())).select("a", "b")
    if crowded is None:
        return pairs
    inside = stage(keyed.join(few, "key", "left_semi").select("f", F.col("key").alias("group")), "crowded")
    return pairs.unionByName(_search(inside, rest, distance))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, id_col: str = "doc_id") -> DataFrame:
    """Rows with `fingerprint` (bigint) and `component_id`: the least id that links reach, its own included.

    Null texts count as empty, and texts without words have fingerprint 0 and link like any other.
    Null ids get a fingerprint and their component, which is null if nothing in it has an id.
    Columns called fingerprint or component_id are replaced; other columns and equal rows stay.
    """
    rows = stage(simhash(docs.drop("component_id"), shingle), "simhash")
    least = stage(rows.groupBy("fingerprint").agg(F.min(column(id_col)).alias("least")), "fingerprint-ids")
    roots = connected_components(links(least, distance)).withColumnsRenamed({"node": "fingerprint"})
    rooted = least.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.select("fingerprint", "root").join(ids, "root").select("fingerprint", "component_id")
    return rows.join(classes, "fingerprint").select(*map(column, rows.columns), "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, id_col: str = "doc_id") -> DataFrame:
    """The documents of `docs` whose id is that of their component; rows that share this id all stay.

    Rows without an id belong to no component that could stand for them, so they stay.
    """
    found = near_duplicates(docs.select(column(id_col), text_or_empty().alias("text")), shingle, distance, id_col)
    gone = found.where(column(id_col) != F.col("component_id")).select(column(id_col).alias("__gone")).distinct()
    return docs.join(gone, column(id_col) == F.col("__gone"), "left_anti")
