"""Best-fit packing with exact complements: documents into as few sequences of a fixed size as possible.

1. `cut_pieces` turns each text into token ids plus an end id and cuts only what is longer than a
   sequence.
2. The plan is made from the number of pieces of each length alone, at most `size` numbers, so it
   costs the same for any input.  Single lengths, sums of two and sums of three are looked up as
   exact complements of what a sequence still lacks, as many copies at once as are available; what
   no combination completes goes, longest first, into the fullest sequence that has room for it.
3. Each piece's rank among those of its length picks its place in the plan.  Ranks are counted
   in salted groups, so a length that a third of all pieces share spreads over many tasks.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from washline.llm.common import shuffle_partitions, slices, stage, text_or_empty, with_fields
from washline.llm.tokens import encoder
from washline.names import column

#: Groups that the pieces of one length are dealt into; bounds the table of offsets.
MOST_SALTS = 256

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def cut_pieces(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, if asked for, ids.

    A text's ids end with `end_id`.  Up to `size` ids stay whole; longer ones are cut into pieces of
    `size`, of which the first may be shorter.  `ids` are little-endian unsigned 32-bit integers.
    A null or empty text has the end id alone; a null doc_id stays null; equal rows are cut alike;
    columns besides doc_id and text are not looked at.
    """
    schema = PIECES + (", ids binary" if with_ids else "")
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        for part in slices(batches):
            rows: list[tuple] = []
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                ids = memoryview(encode(text) + end)
                n = len(ids) // 4
                cuts = [0, *range(n % size or size, n + 1, size)] if n > size else [0, n]
                for piece, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    own = ids[4 * a : 4 * b]
                    rows.append((doc_id, piece, a, b - a, zlib.crc32(own), bytes(own))[: 6 if with_ids else 5])
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=False)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(rows[0])],
            )

    return docs.select(column("doc_id").cast("bigint"), text_or_empty()).mapInArrow(cut, schema)


def plan_sequences(counts: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths with the number of sequences each fills; `counts`: pieces by length."""
    left = np.zeros(size + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    plan: list[tuple[tuple[int, ...], int]] = []
    rest: list[tuple[int, int]] = []
    for longest in range(size, 0, -1):
        while left[longest]:
            found = complement(left, longest, size - longest)
            if found is None:
                rest.append((longest, int(left[longest])))
                left[longest] = 0
                break
            pattern = (longest, *found)
            copies = int(min(left[x] // pattern.count(x) for x in pattern))
            for x in pattern:
                left[x] -= copies
            plan.append((pattern, copies))
    return plan + best_fit(rest, size)


def complement(left: np.ndarray, first: int, gap: int) -> tuple[int, ...] | None:
    """Up to three available lengths that fill `gap` exactly beside one piece of length `first`."""
    if gap == 0:
        return ()
    left[first] -= 1
    try:
        if gap <= first and left[gap]:
            return (gap,)
        if pair := pair_of(left, gap, first):
            return pair
        lengths = np.flatnonzero(left[: min(gap, first + 1)])
        for x in lengths[::-1]:
            if 3 * x < gap:  # the longest of three holds a third of the gap at least
                break
            left[x] -= 1
            pair = pair_of(left, gap - int(x), int(x))
            left[x] += 1
            if pair:
                return (int(x), *pair)
    finally:
        left[first] += 1
    return None


def pair_of(left: np.ndarray, total: int, longest: int) -> tuple[int, int] | None:
    """Two available lengths of a sum, none over `longest`, the longer one as long as possible."""
    high = min(longest, total - 1)
    low = total - high
    if low > high:
        return None
    half = (total + 1) // 2
    longer = np.arange(high, half - 1, -1)
    fits = (left[longer] > 0) & (left[total - longer] > 0)
    if total % 2 == 0 and half <= high and left[half] < 2:
        fits[-1] = False
    i = int(fits.argmax()) if len(fits) else 0
    return (int(longer[i]), total - int(longer[i])) if len(fits) and fits[i] else None


def best_fit(rest: list[tuple[int, int]], size: int) -> list[tuple[tuple[int, ...], int]]:
    """The lengths, longest first, each into the sequences with the least room that suffices."""
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    rooms: list[int] = []

    def put(pattern: tuple[int, ...], copies: int) -> None:
        room = size - sum(pattern)
        if room not in open_:
            open_[room] = []
            insort(rooms, room)
        open_[room].append((pattern, copies))

    for length, n in rest:
        while n:
            i = bisect_left(rooms, length)
            if i == len(rooms):
                each = size // length
                if n >= each:
                    put((length,) * each, n // each)
                if n % each:
                    put((length,) * (n % each), 1)
                break
            room = rooms[i]
            pattern, copies = open_[room].pop()
            if not open_[room]:
                del open_[room], rooms[i]
            used = min(n, copies)
            if copies > used:
                put(pattern, copies - used)
            put((*pattern, length), used)
            n -= used
    return [x for room in rooms for x in open_[room]]


def pack(pieces: DataFrame, size: int = 2048, length: str = "length") -> DataFrame:
    """Add sequence_id and offset (the piece's place in its sequence) to pieces of 1 to `size` tokens.

    `pieces` is read twice, so it should be a stored table.  Columns called sequence_id or offset
    are replaced.  A null length, or one outside 1 to `size`, gets null in both.  Equal rows are
    packed as rows of their own.
    """
    pieces = pieces.drop("sequence_id", "offset")
    names = pieces.columns
    n = column(length).cast("bigint")
    salts = min(MOST_SALTS, shuffle_partitions(pieces.sparkSession))
    salted = pieces.withColumns(
        {
            "__length": F.when(n.between(1, size), n).cast("int"),
            "__salt": F.pmod(F.xxhash64(*map(column, names)), F.lit(salts)).cast("int"),
        }
    )
    groups = salted.where(F.col("__length").isNotNull()).groupBy("__length", "__salt").agg(F.count("*").alias("__n")).collect()  # at most size x MOST_SALTS rows
    counts = np.zeros((size + 1, salts), np.int64)
    for row in groups:
        counts[row[0], row[1]] = row[2]
    totals = counts.sum(axis=1)
    before = np.concatenate([[0], np.cumsum(totals)])[:-1]
    group_start = before[:, None] + np.cumsum(counts, axis=1) - counts

    used, sequence, spans = before.copy(), 0, []
    for pattern, copies in plan_sequences({int(i): int(totals[i]) for i in np.flatnonzero(totals)}, size):
        offset = 0
        for x in pattern:
            spans.append((used[x], sequence, offset))
            used[x] += copies
            offset += x
        sequence += copies
    starts, firsts, offsets = np.array(sorted(spans), np.int64).reshape(-1, 3).T.copy()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *own, lengths, salt, rank = batch.columns
            known = np.array(lengths.is_valid())
            x, s = (np.array(c.fill_null(0)) for c in (lengths, salt))
            at = group_start[x, s] + np.array(rank) - 1
            span = np.maximum(np.searchsorted(starts, at, side="right") - 1, 0)
            found = [firsts[span] + at - starts[span], offsets[span]] if len(starts) else [at, at]
            yield pa.RecordBatch.from_arrays([*own, *(pa.array(f, pa.int64(), mask=~known) for f in found)], [*names, "sequence_id", "offset"])

    ranked = salted.withColumn("__rank", F.row_number().over(Window.partitionBy("__length", "__salt").orderBy(F.xxhash64(*map(column, names)))).cast("bigint"))
    fields = with_fields(pieces.schema, sequence_id=T.LongType(), offset=T.LongType())
    return ranked.mapInArrow(place, fields)


def pack_documents(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0) -> DataFrame:
    """`cut_pieces`, stored once, then `pack`."""
    return pack(stage(cut_pieces(docs, tokenizer, size, end_id), "pieces"), size)
