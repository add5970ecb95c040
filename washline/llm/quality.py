"""Quality by compression: how much better does a text compress with good text in mind than with bad?

Two zstandard dictionaries are built, one from texts labelled good and one from bad ones.  A text is
cut into blocks of BLOCK bytes, all of it, so that its own repetitions do not drown the
dictionaries; each block is compressed with both.  The normalised difference of the compressed sizes
(whole text and worst block), the compressed share (whole text and least block) and the log length,
with their squares and products, give the score through a logistic calibration on labelled texts
that no dictionary was built from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from washline.llm.common import slices, text_or_empty, with_fields
from washline.names import column

BLOCK = 512
DICTIONARY = 112_640
LEVEL = 3

#: Labelled texts of each class that are fitted at most: for its dictionary, and for the calibration.
MOST_DICTIONARY = 3000
MOST_CALIBRATION = 3000

#: Share of a class's labelled texts that its dictionary may use.
DICTIONARY_SHARE = 0.6

#: Predicted good from this score on.
THRESHOLD = 0.3


@dataclass
class Model:
    good: bytes
    bad: bytes
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray


def blocks(text: str) -> list[bytes]:
    data = text.encode(errors="replace")
    return [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)] or [b""]


def _dictionary(texts: list[str]) -> bytes:
    samples = [b for t in texts for b in blocks(t) if b]
    try:
        return zstandard.train_dictionary(DICTIONARY, samples, level=LEVEL).as_bytes()
    except (zstandard.ZstdError, ValueError):  # too few samples to choose from: take them as they are
        return b"".join(samples)[-DICTIONARY:]


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    if known:
        known.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_content_size=False, write_dict_id=False)


def features(texts: list[str], good: zstandard.ZstdCompressor, bad: zstandard.ZstdCompressor) -> np.ndarray:
    rows = []
    for text in texts:
        parts = blocks(text)
        sizes = np.array([(len(good.compress(b)), len(bad.compress(b)), len(b)) for b in parts], float)
        g, b, n = sizes.T
        difference = (b - g) / (b + g + 16)
        share = (np.minimum(g, b) + 8) / (n + 16)
        large = n >= BLOCK / 2 if (n >= BLOCK / 2).any() else n >= 0
        whole_g, whole_b, whole_n = sizes.sum(axis=0)
        rows.append(
            (
                (whole_b - whole_g) / (whole_b + whole_g + 16),
                difference[large].min(),
                np.log((min(whole_g, whole_b) + 8) / (whole_n + 16)),
                np.log(share[large].min()),
                np.log(whole_n + 16),
            )
        )
    return np.array(rows).reshape(-1, 5)


def _design(x: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    z = np.clip((x - mean) / spread, -8, 8)
    squares = [z[:, i] * z[:, j] for i in range(z.shape[1]) for j in range(i + 1)]
    return np.column_stack([np.ones(len(z)), z, *squares])


def _probability(logit: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.3) -> np.ndarray:
    """Ridge logistic regression by Newton steps, each halved until the loss falls."""
    w = np.zeros(x.shape[1])
    loss = lambda w: (weight * np.logaddexp(0, np.where(y == 1, -1, 1) * (x @ w))).sum() + ridge * w[1:] @ w[1:] / 2
    keep = np.full(len(w), ridge)
    keep[0] = 1e-6
    for _ in range(50):
        p = _probability(x @ w)
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(keep), x.T @ (weight * (y - p)) - keep * w)
        size = 1.0
        while size > 1e-4 and loss(w + size * step) > loss(w):
            size /= 2
        w = w + size * step
        if np.abs(size * step).max() < 1e-6:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on documents with a label 0 or 1 in `labels` (doc_id, quality).

    At most MOST_DICTIONARY + MOST_CALIBRATION rows of each class are fetched, those first in the
    order of a hash of their doc_id; class weights restore the share of each class.  Without labels
    of both classes the score of every text is their share of ones, or 0.5.
    """
    known = labels.where(column("quality").isin(0, 1) & column("doc_id").isNotNull())
    known = known.groupBy(column("doc_id").cast("bigint").alias("doc_id")).agg(F.max(column("quality")).cast("int").alias("quality"))
    totals = {r[0]: r[1] for r in known.groupBy("quality").count().collect()}
    chosen = None
    for label in (0, 1):
        first = known.where(F.col("quality") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(MOST_DICTIONARY + MOST_CALIBRATION)
        chosen = first if chosen is None else chosen.unionByName(first)
    # At most 2 x (MOST_DICTIONARY + MOST_CALIBRATION) numbers, so the broadcast is bounded.
    own = docs.select(column("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    rows = own.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    found = rows.toPandas()
    found["order"] = found["doc_id"].map({r[0]: i for i, r in enumerate(chosen.select("doc_id").collect())})
    found = found.sort_values("order")

    texts: dict[int, list[str]] = {k: found.loc[found.quality == k, "text"].tolist() for k in (0, 1)}
    for_dictionary = {k: min(MOST_DICTIONARY, int(DICTIONARY_SHARE * len(t))) for k, t in texts.items()}
    good, bad = (_dictionary(texts[k][: for_dictionary[k]]) for k in (1, 0))
    rest = {k: t[for_dictionary[k] :] for k, t in texts.items()}
    if not all(rest.values()):
        share = (totals.get(1, 0) + 0.5) / (sum(totals.values()) + 1)
        weights = np.zeros(21)
        weights[0] = np.log(share / (1 - share))
        return Model(good, bad, np.zeros(5), np.ones(5), weights)
    x = features(rest[1] + rest[0], _compressor(good), _compressor(bad))
    y = np.repeat([1, 0], [len(rest[1]), len(rest[0])])
    every = sum(totals.values())
    weight = np.repeat([totals[1] / every * len(y) / len(rest[1]), totals[0] / every * len(y) / len(rest[0])], [len(rest[1]), len(rest[0])])
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    return Model(good, bad, mean, spread, _logistic(_design(x, mean, spread), y, weight))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Add `score` (0 to 1) and `predicted` (1 from THRESHOLD on) to rows with a text.

    A null text counts as empty, which has a score like any other.  Columns of these names are
    replaced; other columns and equal rows stay.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        good, bad = _compressor(model.good), _compressor(model.bad)
        for part in slices(batches):
            *own, text = part.columns
            x = features(text.to_pylist(), good, bad)
            p = _probability(_design(x, model.mean, model.spread) @ model.weights)
            yield pa.RecordBatch.from_arrays([*own, pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32))], [*names, "score", "predicted"])

    kept = docs.drop("score", "predicted")
    names = kept.columns
    schema = with_fields(kept.schema, score=T.DoubleType(), predicted=T.IntegerType())
    return kept.select(*map(column, names), text_or_empty().alias("__text")).mapInArrow(add, schema)


def fold_is_not(modulus: int, remainder: int):
    """Rows whose crc32 of doc_id as text does not leave this remainder; a null doc_id counts as empty text."""
    return F.crc32(F.coalesce(column("doc_id").cast("string"), F.lit("")).cast("binary")) % modulus != remainder
