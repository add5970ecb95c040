"""Hard negatives by slot-decomposed selection.

An anchor's positives are its best rows of the same label.  A row of another label is a hard negative
of a positive with score p if its own score lies in a window that ends at a share of p: hard, but not
so close that it may be an unlabelled positive.  The windows of one anchor's positives overlap, so
one row may serve several.

1. Every score is an integer inner product, so the result does not depend on the order of sums.
2. Positives: each task keeps an anchor's best rows of the same label, a window ranks what the tasks kept.
3. Slots: an anchor's upper limits, in descending order, cut the scores into disjoint slots; slot j holds
   the scores up to limit j and above limit j + 1.  Each row is in one slot at most.  Tasks (the
   combiners) and then a window keep the best rows of each slot.
4. Suffix merges: the window of positive i reaches down from limit i, so its best rows are among the
   best of the slots i, i + 1, ...  Taken in descending order of the slots these are a suffix, of which the
   first that are not below the window's lower limit are the answer.

The anchors are taken in blocks of about ANCHORS_AT_ONCE; each block meets all rows in one pass, and only
the best rows of each slot are shuffled.  No table of all pairs is made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from washline.llm.common import stage
from washline.names import column

#: Anchors that tasks are handed at a time: 10 MB at 64 dimensions.
ANCHORS_AT_ONCE = 16_384

#: Scores that a task holds at a time.
SCORES_AT_ONCE = 1 << 21

#: Sums of products below this are exact in doubles.
EXACT = 1 << 53

FIRST = "anchor_id bigint, slot int, id bigint, score bigint"


def quantised(rows: DataFrame, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """id, label, x: floor(scale * component) of each component, one row per id.

    Rows with a null label, vector or component, a component that is no finite number, or a null id
    (nothing could name them) take no part.  Of several rows with one id the one with the least label,
    then the least vector, stays.  Components so large that a product does not fit 64 bits are an error.
    """
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    own = rows.select(column(id_col).cast("bigint").alias("id"), column(label_col).cast("bigint").alias("label"), column(vector_col).cast("array<double>").alias("v"))
    own = own.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & whole)
    one = own.groupBy("id").agg(F.min(F.struct("label", "v")).alias("row"))
    return one.select("id", F.col("row.label").alias("label"), F.transform("row.v", lambda x: F.floor(x * scale)).cast("array<double>").alias("x"))


class _Best:
    """The `keep` best (score, then least id) of each (anchor, slot), as far as seen."""

    def __init__(self, anchors: int, slots: int, keep: int):
        self.keep, self.slots = keep, slots
        self.least = np.full((anchors, slots), -(1 << 63), np.int64)  # no score below this is among the best
        self.groups, self.ids, self.scores = (np.zeros(0, np.int64) for _ in range(3))

    def offer(self, anchors: np.ndarray, slots: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        groups = np.concatenate([self.groups, anchors * self.slots + slots])
        ids, scores = np.concatenate([self.ids, ids]), np.concatenate([self.scores, scores])
        order = np.lexsort((ids, -scores, groups))
        groups, ids, scores = groups[order], ids[order], scores[order]
        starts = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]]) if len(groups) else np.zeros(0, np.int64)
        place = np.arange(len(groups)) - np.repeat(starts, np.diff(np.r_[starts, len(groups)]))
        kept = place < self.keep
        self.groups, self.ids, self.scores = groups[kept], ids[kept], scores[kept]
        full = place == self.keep - 1
        self.least.reshape(-1)[groups[full]] = scores[full]


def _products(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact integer inner products of all anchors with all rows, as bigints."""
    largest = float(np.abs(anchors).max(initial=0)) * float(np.abs(rows).max(initial=0)) * anchors.shape[1]
    if largest < EXACT:
        return (anchors @ rows.T).astype(np.int64)
    if largest < 2**62:
        return anchors.astype(np.int64) @ rows.astype(np.int64).T
    raise OverflowError("inner products of these vectors do not fit 64 bits")


def _per_slot(rows: DataFrame, anchors: list, limits: dict[int, list[int]] | None, keep: int, floors: dict[int, int]) -> DataFrame:
    """(anchor_id, slot, id, score): the `keep` best rows of each slot of the anchors (id, label, x), per task.

    Without `limits` an anchor has one slot, of all other rows of its label; with them, those of the
    other labels, in the slots that its limits cut, from its floor on.
    """
    by_size: dict[int, list] = {}
    for a in anchors:
        by_size.setdefault(len(a["x"]), []).append(a)
    most = max((len(v) for v in limits.values()), default=1) if limits is not None else 1
    blocks = {}
    for size, own in by_size.items():
        ids = np.array([a["id"] for a in own], np.int64)
        uppers = np.full((len(own), most), -(1 << 63), np.int64)
        for i, a in enumerate(own):
            if limits is not None:
                uppers[i, : len(limits[a["id"]])] = limits[a["id"]]
        lowers = np.array([floors.get(a["id"], -(1 << 63)) for a in own], np.int64)
        blocks[size] = (ids, np.array([a["label"] for a in own], np.int64), np.array([a["x"] for a in own], float).reshape(len(own), size), uppers, lowers)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {size: _Best(len(b[0]), most, keep) for size, b in blocks.items()}
        for batch in batches:
            ids, labels = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
            vectors = batch.column(2)
            sizes = np.diff(vectors.offsets.to_numpy())
            for size, (anchor_ids, anchor_labels, x, uppers, lowers) in blocks.items():
                mine = np.flatnonzero(sizes == size)
                step = max(1, SCORES_AT_ONCE // len(anchor_ids))
                for at in range(0, len(mine), step):
                    part = mine[at : at + step]
                    y = vectors.take(pa.array(part)).flatten().to_numpy(zero_copy_only=False).reshape(len(part), size)
                    scores = _products(x, y)
                    same = anchor_labels[:, None] == labels[part][None, :]
                    if limits is None:
                        slots = np.zeros(scores.shape, np.int8)
                        fits = same & (anchor_ids[:, None] != ids[part][None, :])
                    else:
                        slots = np.full(scores.shape, -1, np.int8)
                        for j in range(most):
                            slots += scores <= uppers[:, j, None]
                        fits = ~same & (slots >= 0) & (scores >= lowers[:, None])
                    keeper = found[size]
                    a, r = np.nonzero(fits)
                    s, v = slots[a, r].astype(np.int64), scores[a, r]
                    good = v >= keeper.least[a, s]
                    if good.any():
                        a, r, s, v = a[good], r[good], s[good], v[good]
                        keeper.offer(a, s, ids[part][r], v)
        for size, keeper in found.items():
            if len(keeper.groups):
                columns = [blocks[size][0][keeper.groups // most], (keeper.groups % most).astype(np.int32), keeper.ids, keeper.scores]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor_id", "slot", "id", "score"])

    return rows.mapInArrow(best, FIRST)


def _ranked(found: DataFrame, keep: int) -> DataFrame:
    """The best of what the tasks kept, with `place` from 1 within (anchor, slot)."""
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= keep)


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    least_percent: int = 50,
    most_percent: int = 95,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    `rows` has id, label and x (see `quantised`, whose rules say which rows take part); `is_anchor` is a
    condition on these.  For each anchor and each of its first `positives` other rows of the same label: the
    first `negatives` rows of another label with least_percent * p <= 100 * score <= most_percent * p, p
    the positive's score.  Higher scores come first, ties by smaller id.  Vectors of different
    lengths do not meet.  An anchor without positives, or a positive without negatives, has no row; an
    empty table gives none.  Other columns are not looked at.
    """
    own = stage(rows.select("id", "label", "x"), "vectors")
    total = own.where(is_anchor).count()
    blocks = max(1, -(-total // (ANCHORS_AT_ONCE // 2)))  # hashed into blocks, so these hold half on average
    out = None
    for number in range(blocks):
        mine = F.pmod(F.xxhash64("id"), F.lit(blocks)) == number
        anchors = own.where(is_anchor & mine).collect()
        first = stage(_ranked(_per_slot(own, anchors, None, positives, {}), positives).drop("slot"), "positives")
        # A block's positives are bounded as its anchors are.
        limits: dict[int, list[int]] = {}
        floors: dict[int, int] = {}
        for r in first.orderBy("anchor_id", "place").collect():
            limits.setdefault(r["anchor_id"], []).append(r["score"] * most_percent // 100)
            least = -(-r["score"] * least_percent // 100)
            floors[r["anchor_id"]] = min(least, floors.get(r["anchor_id"], least))
        useful = [a for a in anchors if a["id"] in limits]
        slots = _ranked(_per_slot(own, useful, limits, negatives, floors), negatives).drop("place")
        answer = _suffix_merge(first, slots, negatives, least_percent)
        out = answer if out is None else out.unionByName(stage(answer, "negatives"))
    return out


def _suffix_merge(first: DataFrame, slots: DataFrame, negatives: int, least_percent: int) -> DataFrame:
    """Each positive's best rows: of the slots from its own on in descending order, the first, if not too low.

    An anchor has at most positives x negatives rows in its slots, which one array holds.
    """
    best = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("down"), "id", "slot")))
    merged = slots.groupBy("anchor_id").agg(best.alias("best"))
    both = first.withColumnsRenamed({"id": "positive_id", "score": "positive_score"}).join(merged, "anchor_id")
    suffix = F.slice(F.filter("best", lambda b: b["slot"] >= F.col("place") - 1), 1, negatives)
    rows = both.select("anchor_id", "positive_id", "positive_score", F.posexplode(suffix).alias("at", "negative"))
    negative = -F.col("negative.down")
    wide = lambda score: score.cast("decimal(38,0)")
    return rows.where(wide(F.col("positive_score")) * least_percent <= wide(negative) * 100).select(
        "anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("negative.id").alias("negative_id"), "positive_score", negative.alias("negative_score")
    )
