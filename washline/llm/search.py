"""Ranked lexical search by presence-mask grouping.

A document's score for an item is the sum, over the item's terms, of a term's weight times a share that
grows with the term's occurrences and falls with the document's length, all in integers.

1. One pass over the texts counts each document's terms and the occurrences of those that any item
   has.  The result, numbers alone, is stored; document frequencies and lengths are counted from it.
2. A second pass reads these numbers in blocks.  For each item, one bitmap per term says which documents
   of the block hold it; put together they are each document's presence mask, and documents of one mask
   are a group.  A mask's score is at most the sum of its terms' highest contributions in the block.  Masks
   are evaluated by descending maximum, and once the best documents found score more than the next
   mask can, no other can enter: the search has safely finished.
3. Each task keeps its best documents per item, a window ranks what the tasks kept.

Items are searched in groups of about TERMS_AT_ONCE terms, so that what tasks are handed is bounded,
however large the benchmark.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from washline.llm.common import stage
from washline.names import column

#: Pairs of item and term that tasks are handed at a time.
TERMS_AT_ONCE = 200_000

#: Occurrences of terms, or documents, that a task holds at a time.
BLOCK = 1 << 19

# What a term is, and the numbers of the score.
NO_TERM = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SEPARATORS = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
WEIGHT, UNIT, PER_OCCURRENCE, PER_LENGTH, LENGTH_SHARE = 1000, 1_000_000_000, 1000, 20, 50

#: Lower-cases A to Z and turns what separates terms into blanks; bytes of other letters stay.
TABLE = bytes(0x20 if i in SEPARATORS else i + 32 if 0x41 <= i <= 0x5A else i for i in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """Terms of a UTF-8 text with repeats, in order."""
    return text.translate(TABLE).split()


def weights(df: np.ndarray, documents: int) -> np.ndarray:
    return np.floor(WEIGHT * np.log((2 * documents + 2) / (2 * df + 1))).astype(np.int64)


@dataclass
class Queries:
    """A group of items: each one's terms by their number, and the best documents wanted."""

    items: list[np.ndarray]
    weights: np.ndarray
    top: int


class _Block:
    """Documents with contributions of their terms, grouped by term."""

    def __init__(self, lengths: np.ndarray, sizes: np.ndarray, terms: np.ndarray, counts: np.ndarray, documents: int, total: int, weight: np.ndarray):
        own = np.repeat(np.arange(len(sizes)), sizes)
        normal = 100 - LENGTH_SHARE + LENGTH_SHARE * lengths * documents // max(total, 1)
        shares = UNIT * counts // (PER_OCCURRENCE * counts + PER_LENGTH * normal[own])
        order = np.argsort(terms, kind="stable")
        self.size = len(sizes)
        self.docs, self.gains = own[order], (weight[terms] * shares)[order]
        self.starts = np.searchsorted(terms[order], np.arange(len(weight) + 1))
        self.highest = np.zeros(len(weight), np.int64)
        held = np.flatnonzero(np.diff(self.starts))
        if len(held):
            self.highest[held] = np.maximum.reduceat(self.gains, self.starts[held])

    def of(self, term: int) -> slice:
        return slice(self.starts[term], self.starts[term + 1])

    def masks(self, terms: np.ndarray) -> np.ndarray:
        """Per document its presence mask over `terms`, as words of 64 bits."""
        words = np.zeros((self.size, -(-len(terms) // 64)), np.uint64)
        for i, term in enumerate(terms.tolist()):
            words[self.docs[self.of(term)], i // 64] |= np.uint64(1 << (i % 64))
        return words

    def scores(self, terms: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Exact scores of the documents that the bitmap `wanted` marks, 0 for others."""
        found = np.zeros(self.size, np.int64)
        for term in terms.tolist():
            docs, gains = self.docs[self.of(term)], self.gains[self.of(term)]
            meant = wanted[docs]
            found[docs[meant]] += gains[meant]
        return found

    def best(self, terms: np.ndarray, top: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents, with their scores, of which the `top` best of the block that score `least` or more are part."""
        terms = terms[self.highest[terms] > 0]
        if self.highest[terms].sum() < max(least, 1):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        words = self.masks(terms)
        any_term = np.flatnonzero(words.any(axis=1))
        distinct, group = _groups(words[any_term])
        bits = np.unpackbits(distinct.view(np.uint8).reshape(len(distinct), -1), axis=1, bitorder="little")[:, : len(terms)]
        limit = bits.astype(np.int64) @ self.highest[terms]
        order = np.argsort(-limit, kind="stable")
        held = np.cumsum(np.bincount(group, minlength=len(distinct))[order])
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        done, wanted = 0, 4 * top
        while done < len(order) and limit[order[done]] >= max(least, 1):
            # The next masks in order: as many as hold some more documents, each time more.
            upto = max(done + 1, int(np.searchsorted(held, wanted, side="right")))
            mine = any_term[(place[group] >= done) & (place[group] < upto)]
            marked = np.zeros(self.size, bool)
            marked[mine] = True
            docs, scores = np.r_[docs, mine], np.r_[scores, self.scores(terms, marked)[mine]]
            if len(scores) >= top:
                least = max(least, int(np.partition(scores, len(scores) - top)[len(scores) - top]))
            done, wanted = upto, 4 * wanted
        good = scores >= max(least, 1)
        return docs[good], scores[good]


def _groups(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct masks, and the number of the one that each row has."""
    if words.shape[1] == 1:
        distinct, group = np.unique(words[:, 0], return_inverse=True)
        return distinct[:, None], group
    order = np.lexsort(words.T)
    new = np.r_[True, (words[order][1:] != words[order][:-1]).any(axis=1)] if len(order) else np.zeros(0, bool)
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    return words[order[new]], group


def count_terms(docs: DataFrame, known: dict[bytes, int], id_col: str) -> DataFrame:
    """id, n (all terms), terms and counts (those in `known`, by number) of documents with a term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, totals, terms, counts, ends = [], [], [], [], [0]
            for i, text in enumerate(batch.column(1)):
                held = Counter(terms_of(text.as_py()))
                if not held:
                    continue
                places.append(i)
                totals.append(held.total())
                mine = [(known[t], held[t]) for t in held.keys() & known.keys()]
                terms += [t for t, _ in mine]
                counts += [n for _, n in mine]
                ends.append(len(terms))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, kind)) for x, kind in ((terms, pa.int32()), (counts, pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(places, pa.int64())), pa.array(totals, pa.int64()), *lists], ["id", "n", "terms", "counts"])

    text = F.coalesce(column("text").cast("string"), F.lit("")).cast("binary")
    return docs.select(column(id_col).cast("bigint").alias("id"), text.alias("text")).mapInArrow(count, "id bigint, n bigint, terms array<int>, counts array<bigint>")


def _best_of_tasks(counted: DataFrame, queries: Queries, documents: int, total: int) -> DataFrame:
    """(item, id, score): per task and item, of the documents it saw, the best; `item` is the item's number."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start = 0
            ends = batch.column(2).offsets.to_numpy().astype(np.int64)
            ends = ends[1:] - ends[0]
            while start < batch.num_rows:
                upto = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + BLOCK, side="right")))
                yield batch.slice(start, upto - start)
                start = upto

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for batch in blocks(batches):
            ids = batch.column(0)
            missing = np.array(ids.is_null())
            numbers = ids.fill_null(0).to_numpy()
            lists = [batch.column(i) for i in (2, 3)]
            flat = [x.flatten().to_numpy().astype(np.int64) for x in lists]
            block = _Block(batch.column(1).to_numpy(), np.diff(lists[0].offsets.to_numpy()), *flat, documents, total, queries.weights)
            for item, terms in enumerate(queries.items):
                before = best.get(item)
                least = int(before[2][queries.top - 1]) if before is not None and len(before[2]) >= queries.top else 1
                docs, scores = block.best(terms, queries.top, least)
                if not len(docs):
                    continue
                rows = (missing[docs], numbers[docs], scores)
                if before is not None:
                    rows = tuple(np.r_[a, b] for a, b in zip(before, rows, strict=True))
                order = np.lexsort((rows[1], rows[0], -rows[2]))[: queries.top]
                best[item] = tuple(x[order] for x in rows)
        for item, (missing, numbers, scores) in best.items():
            columns = [pa.array(np.full(len(scores), item, np.int32)), pa.array(numbers, mask=missing), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, ["item", "id", "score"])

    return counted.mapInArrow(search, "item int, id bigint, score bigint")


def search(docs: DataFrame, items: DataFrame, top: int = 50, id_col: str = "doc_id", item_col: str = "item_id") -> DataFrame:
    """`item_col`, rank, `id_col`, score: the `top` best documents of each item with a score above 0.

    Equal scores rank by ascending id, null ids last.  A null or empty text has no terms, so neither
    finds nor is found.  Rows of `items` with one id (null is one too) are one item with all their terms;
    rows of `docs` that share an id are documents of their own.  Other columns are not looked at; an
    empty table gives no rows.
    """
    text = F.coalesce(column("text").cast("string"), F.lit(""))
    split = F.split(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), NO_TERM)
    own = items.select(column(item_col).alias("item"), F.explode(split).alias("term")).where("term <> ''").distinct()
    asked = stage(own, "search-terms")
    groups = -(-asked.count() // (TERMS_AT_ONCE // 2)) or 1  # hashed into groups, so these hold half on average
    out = None
    for number in range(groups):
        mine = asked.where(F.pmod(F.xxhash64("item"), F.lit(groups)) == number).groupBy("item").agg(F.sort_array(F.collect_set("term")).alias("terms"))
        held = mine.orderBy("item").collect()
        known = {t: i for i, t in enumerate(sorted({t for r in held for t in r["terms"]}))}
        counted = stage(count_terms(docs, {t.encode(): i for t, i in known.items()}, id_col), "search-counts")
        documents, total = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        # At most as many rows as the group has terms.
        found = {r[0]: r[1] for r in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect()}
        df = np.array([found.get(i, 0) for i in range(len(known))], np.int64)
        asking = Queries([np.array([known[t] for t in r["terms"]], np.int64) for r in held], weights(df, documents), top)
        best = _best_of_tasks(counted, asking, documents, total)
        ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id")))).where(F.col("rank") <= top)
        kind = asked.schema["item"].dataType
        names = docs.sparkSession.createDataFrame([(i, r["item"]) for i, r in enumerate(held)], f"item int, name {kind.simpleString()}")
        # The names are no more rows than the group has terms.
        named = ranked.join(F.broadcast(names), "item").select(F.col("name").alias(item_col), "rank", F.col("id").alias(id_col), "score")
        out = named if out is None else out.unionByName(stage(named, "search-ranked"))
    return out
