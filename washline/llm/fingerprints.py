"""Document fingerprints by locally consistent parsing.

A text is parsed into a hierarchy of phrases.  At each level, runs of equal symbols are first named
as one; deterministic coin tossing (Cole and Vishkin) then gives neighbours different labels below 6,
from a few symbols to the left only; each local maximum of the labels starts a new phrase, and a phrase's name
is a hash of its symbols.  Where phrases begin depends on a bounded neighbourhood, so equal
substrings have the same names inside whatever stands before or after them, at any offset.

A fingerprint keeps the least names (hashes are as good as random) of two sets: phrases of at least
COARSE characters, and of at least FINE ones for short texts.  The share that two fingerprints'
least names have in common estimates the share of phrases the texts have in common, repeats counted.

All texts of a batch are parsed at once, as one array with marked starts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from washline.llm.common import LEAST, range_bucket, shuffle_partitions, slices, text_or_empty, with_fields
from washline.names import column

#: Least code points of a phrase, and names kept, for long and for short texts.
COARSE, COARSE_NAMES = 16, 48
FINE, FINE_NAMES = 4, 24

#: Fewer long phrases than this say too little.
ENOUGH = 12

#: Code points parsed at once, unless one text is longer.
BATCH = 60_000

U = np.uint64


def _mixed(x: np.ndarray) -> np.ndarray:
    """The finisher of splitmix64."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _tossed(labels: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Coin tossing until labels are below 6; neighbours differ before and after."""
    before = np.empty_like(labels)
    before[1:] = labels[:-1]
    before[starts] = ~labels[starts]  # as if the lowest bit differed
    differ = labels ^ before
    place = np.bitwise_count((differ & -differ) - U(1))
    small = (2 * place + ((labels >> place.astype(U)) & U(1)).astype(np.uint8)).astype(np.uint8)
    for _ in range(3):
        before = np.empty_like(small)
        before[1:] = small[:-1]
        before[starts] = small[starts] ^ np.uint8(1)
        small = TOSS[small, before]
    return small


def _toss_table() -> np.ndarray:
    a, b = np.indices((128, 128)).astype(np.uint8)
    differ = np.where(a == b, np.uint8(1), a ^ b)
    place = np.bitwise_count((differ & -differ) - np.uint8(1))
    return (2 * place + ((a >> place) & 1)).astype(np.uint8)


TOSS = _toss_table()


def phrases(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, name and length in code points of every phrase of every level, and of each whole text."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    sizes = np.array([len(t) for t in texts], np.int64)
    names = _mixed(points.astype(U) + U(1))
    lengths = np.ones(len(names), np.int64)
    of = np.repeat(np.arange(len(texts)), sizes)
    found = []
    while len(names):
        # Runs of equal symbols become one.
        new = np.empty(len(names), bool)
        new[0] = True
        new[1:] = (names[1:] != names[:-1]) | (of[1:] != of[:-1])
        at = np.flatnonzero(new)
        times = np.diff(np.append(at, len(names)))
        names, lengths, of = np.where(times > 1, _mixed(names[at] + U(0x9E3779B97F4A7C15) * times.astype(U)), names[at]), np.add.reduceat(lengths, at), of[at]
        starts = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        labels = _tossed(names, starts).astype(np.int8)
        left = np.append(np.int8(-1), labels[:-1])
        right = np.append(labels[1:], np.int8(-1))
        left[starts] = -1
        right[np.append(starts[1:] - 1, len(names) - 1)] = -1
        cut = (labels > left) & (labels > right)
        cut[np.minimum(starts + 1, len(cut) - 1)] = False  # a text's first phrase has two symbols too
        cut[starts] = True
        at = np.flatnonzero(cut)
        step = np.arange(len(names)) - np.repeat(at, np.diff(np.append(at, len(names))))
        names = _mixed(np.add.reduceat(_mixed(names ^ (step.astype(U) * U(0xD6E8FEB86659FD93))), at))
        lengths, of = np.add.reduceat(lengths, at), of[at]
        found.append((of, names, lengths))
        parsed_on = (np.bincount(of) > 1)[of]  # until the text is one phrase
        names, lengths, of = names[parsed_on], lengths[parsed_on], of[parsed_on]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, U), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _least(of: np.ndarray, names: np.ndarray, texts: int, keep: int) -> list[list[int]]:
    """The `keep` least 32-bit names of each text; the second, third ... phrase of one name has a name of its own."""
    keys = np.sort((of.astype(U) << U(32)) | (names >> U(32)))
    places = np.arange(len(keys))
    times = places - np.maximum.accumulate(np.where(np.append(True, keys[1:] != keys[:-1])[: len(keys)], places, 0))
    again = times > 0
    low = keys[again] & U(0xFFFFFFFF)
    keys[again] ^= low ^ (_mixed(low | (times[again].astype(U) << U(32))) >> U(32))
    keys = np.sort(keys)
    keys = keys[np.append(True, keys[1:] != keys[:-1])[: len(keys)]]
    first = np.searchsorted(keys, np.arange(texts + 1).astype(U) << U(32))
    low = (keys & U(0xFFFFFFFF)).astype(np.int64)
    return [low[a : min(b, a + keep)].tolist() for a, b in zip(first[:-1], first[1:], strict=True)]


Sketch = tuple[list[int], list[int]]


def sketches(texts: list[str]) -> list[Sketch]:
    """The least coarse and fine names of each text."""
    out: list[Sketch] = []
    i = 0
    while i < len(texts):
        j, held = i, 0
        while j < len(texts) and (j == i or held + len(texts[j]) <= BATCH):
            held += len(texts[j])
            j += 1
        of, names, lengths = phrases(texts[i:j])
        pick = [(lengths >= n, keep) for n, keep in ((COARSE, COARSE_NAMES), (FINE, FINE_NAMES))]
        coarse, fine = (_least(of[m], names[m], j - i, keep) for m, keep in pick)
        # Texts too short for a fine phrase are named as a whole.
        whole = dict(zip(of[::-1].tolist(), names[::-1].tolist(), strict=True)) if any(not f and t for f, t in zip(fine, texts[i:j], strict=True)) else {}
        out += [(c, f or ([whole[k] >> 32] if k in whole else [])) for k, (c, f) in enumerate(zip(coarse, fine, strict=True))]
        i = j
    return out


def written(sketch: Sketch) -> str:
    """Coarse names, a colon, fine names, 8 hex digits each; a lone colon for an empty text."""
    return ":".join("".join(f"{x:08x}" for x in names) for names in sketch)


def parsed(fingerprint: str) -> Sketch:
    coarse, fine = ([int(p[i : i + 8], 16) for i in range(0, len(p), 8)] for p in fingerprint.split(":"))
    return coarse, fine


def likeness(a: Sketch, b: Sketch) -> float:
    """Estimated share of common phrases, 0 to 1; 1 for equal fingerprints, those of empty texts included."""
    if a == b:
        return 1.0
    long = len(a[0]) >= ENOUGH and len(b[0]) >= ENOUGH
    x, y, keep = (a[0], b[0], COARSE_NAMES) if long else (a[1], b[1], FINE_NAMES)
    common = set(x) & set(y)
    if not common:
        return 0.0
    union = sorted({*x, *y})[:keep]
    return sum(n in common for n in union) / len(union)


def fingerprint(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add `fingerprint` to rows with a text, in place of a column of that name; a null text counts as empty."""
    kept = docs.drop("fingerprint")
    names = kept.columns

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            *own, text = part.columns
            yield pa.RecordBatch.from_arrays([*own, pa.array([written(s) for s in sketches(text.to_pylist())], pa.string())], [*names, "fingerprint"])

    schema = with_fields(kept.schema, fingerprint=T.StringType())
    return kept.select(*map(column, names), text_or_empty(text_col).alias("__text")).mapInArrow(add, schema)


def edited(text: str, following: str) -> str:
    """The last quarter replaced by as many code points from the start of the following text, or all it has."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


NEIGHBOURS = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def with_next(docs: DataFrame, buckets_per_partition: int = 4) -> DataFrame:
    """(bucket, extra, doc_id, text), dealt out and sorted so that each row's next document follows it.

    Documents are parted by ranges of doc_id and sorted inside; the last of a range is followed by an
    `extra` copy of the first of the next one, the last of all by the first of all.  Null doc_ids come
    first; equal doc_ids follow the order of a hash of their texts.  One shuffle of the texts.
    """
    spark = docs.sparkSession
    partitions = shuffle_partitions(spark)
    rows = docs.select(
        range_bucket(docs, "doc_id", partitions * buckets_per_partition).alias("bucket"),
        F.coalesce(column("doc_id").cast("bigint"), F.lit(LEAST)).alias("key"),
        F.xxhash64(text_or_empty()).alias("tie"),
        column("doc_id").cast("bigint").alias("doc_id"),
        text_or_empty().alias("text"),
    )
    # One row per bucket, of which there are at most partitions * buckets_per_partition + 1.
    firsts = sorted(tuple(r) for r in rows.groupBy("bucket").agg(F.min(F.struct("key", "tie")).alias("f")).select("bucket", "f.key", "f.tie").collect())
    follows = [(firsts[i - 1][0], key, tie) for i, (_, key, tie) in enumerate(firsts)]
    heads = spark.createDataFrame(follows, "bucket int, key bigint, tie bigint")
    extra = rows.drop("bucket").join(F.broadcast(heads), ["key", "tie"]).dropDuplicates(["bucket"])
    both = rows.withColumn("extra", F.lit(False)).unionByName(extra.withColumn("extra", F.lit(True)))
    return both.repartition(partitions, "bucket").sortWithinPartitions("bucket", "extra", "key", "tie").select("bucket", "extra", "doc_id", "text")


def compare_neighbours(docs: DataFrame) -> DataFrame:
    """Each text's fingerprint, that of its text edited by the next document's, and how alike they are.

    A null text counts as empty; rows are ordered as in `with_next`; a lone document follows itself.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for part in slices(batches):
            rows = list(zip(*(c.to_pylist() for c in part.columns), strict=True))
            own = sketches([r[3] for r in rows])
            followed = list(zip(rows, own, strict=True))
            if last:
                followed.insert(0, last)
            last = followed[-1]
            pairs = [(a, b) for a, b in zip(followed, followed[1:], strict=False) if not a[0][1] and a[0][0] == b[0][0]]
            new = [edited(a[0][3], b[0][3]) for a, b in pairs]
            changed = sketches(new)
            out = [
                (a[2], len(a[3]), hashlib.sha256(text.encode(errors="replace")).hexdigest(), written(s), written(c), likeness(s, c), likeness(s, t))
                for ((a, s), (_, t)), text, c in zip(pairs, new, changed, strict=True)
            ]
            if out:
                types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], [f.split()[0] for f in NEIGHBOURS.split(", ")])

    return with_next(docs).mapInArrow(compare, NEIGHBOURS)
