"""Brown's class-based bigram model: exchange clustering, class transitions and word emissions.

    P(text) = product of P(class | class before) * P(word | class)

1. Every word of the training texts is counted (a shuffle of partial counts).
2. Words with a share of 1 / LOOKED_UP of all tokens at least, so at most LOOKED_UP words, are known to the
   tasks.  One pass turns every text into their numbers; all later passes read numbers.  Rarer words share
   ENDINGS units by a hash of their last two letters, and their counts are joined by a shuffle, so nothing
   that grows with the vocabulary is broadcast.
3. Exchange clustering (Kneser and Ney; Martin, Liermann, Ney) moves one unit at a time to the class
   that raises the likelihood of the counted bigrams most, until none moves or ROUNDS have passed.  Units
   are here the end of a text, words with a share of 1 / FREQUENT at least, and the endings, so the
   matrix of bigrams is bounded, not by the corpus.
4. All other known words that occur LEAST times or more are then exchanged as words of their own.  A pass counts, per
   word, the classes before and after it over all training tokens (a shuffle of partial counts); each word
   moves to the class under which its tokens are likeliest, its own counts left out.  All move at once, so
   the class bigrams are counted anew, and a round that did not raise their likelihood is undone and the last.
   At most WORD_ROUNDS.

Transitions are smoothed with ALPHA; each class gives its words add-one emissions and keeps one share
for words it has not seen.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from washline.llm.common import slices, stage, text_or_empty
from washline.names import column

FREQUENT = 4000
ENDINGS = 256
LOOKED_UP = 300_000
CLASSES = 64
ROUNDS = 12
LEAST = 5
WORD_ROUNDS = 2
ALPHA = 0.1

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANK = "\t\n\x0b\x0c\r"
TO_LOWER = str.maketrans(UPPER + BLANK, LOWER + " " * len(BLANK))

#: Stands for the end of a text, as no word is empty.
END = ""


def words_of(text: str) -> list[str]:
    return [w for w in text.translate(TO_LOWER).split(" ") if w]


def words_column(text: Column) -> Column:
    """The text's words, then its end."""
    words = F.filter(F.split(F.translate(text, UPPER + BLANK, LOWER + " " * len(BLANK)), " "), lambda w: w != "")
    return F.array_append(words, F.lit(END))


def ending_of(word: str) -> int:
    return zlib.crc32(word[-2:].encode(errors="replace")) % ENDINGS


#: Number of the end of a text; the number of a word that is not known is OTHER - its ending.
END_NUMBER, OTHER = -1, -2

#: Partial counts that a task holds before it merges them, and before it hands them on.
MERGED, HELD = 1_000_000, 4_000_000


def by_number(known: np.ndarray, endings: np.ndarray, end: int) -> np.ndarray:
    """A table to be indexed by words' numbers: those below zero count from its end."""
    return np.concatenate([known, endings[::-1], [end]]).astype(np.int64)


def number_texts(docs: DataFrame, places: dict[str, int]) -> DataFrame:
    """(row, id, trains, text) with the text's numbers, its end included, and its words that are not known."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        other = Others()
        for part in slices(batches):
            get, numbers, rare, starts, rare_starts = places.get, [], [], [0], [0]
            for text in part.column("text").to_pylist():
                words = words_of(text)
                found = [get(w, END_NUMBER) for w in words]
                if END_NUMBER in found:
                    unknown = [i for i, n in enumerate(found) if n == END_NUMBER]
                    for i in unknown:
                        found[i] = other[words[i][-2:]]
                    rare += [words[i] for i in unknown]
                numbers += found
                numbers.append(END_NUMBER)
                starts.append(len(numbers))
                rare_starts.append(len(rare))
            columns = [
                *(part.column(c) for c in ("row", "id", "trains")),
                pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(np.array(numbers, np.int32))),
                pa.ListArray.from_arrays(pa.array(rare_starts, pa.int32()), pa.array(rare, pa.string())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["row", "id", "trains", "numbers", "rare"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(read, f"row bigint, id {kind}, trains boolean, numbers array<int>, rare array<string>")


class Others(dict):
    def __missing__(self, letters: str) -> int:
        self[letters] = found = OTHER - ending_of(letters)
        return found


def tokens_of(numbers: pa.Array, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of all tokens, what `table` says of them and of the tokens before, and each text's first token.

    The end of a text also stands before its first word.
    """
    flat = numbers.flatten().to_numpy(zero_copy_only=False)
    lengths = numbers.value_lengths().to_numpy(zero_copy_only=False)
    starts = np.cumsum(lengths) - lengths
    here = table[flat]
    before = np.roll(here, 1)
    before[starts] = table[END_NUMBER]
    return flat, here, before, starts


def count_keys(numbered: DataFrame, keys: Callable[[pa.Array], np.ndarray]) -> DataFrame:
    """How often `keys` gives each number over all rows (key, n); partial counts, several rows a key."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, waiting, size = (np.zeros(0, np.int64), np.zeros(0, np.int64)), [], 0
        for part in slices(batches):
            waiting.append(np.unique(keys(part.column(0)), return_counts=True))
            size += len(waiting[-1][0])
            if size > MERGED:
                total, waiting, size = summed([total, *waiting]), [], 0
                if len(total[0]) > HELD:
                    yield pa.RecordBatch.from_arrays([pa.array(t) for t in total], ["key", "n"])
                    total = np.zeros(0, np.int64), np.zeros(0, np.int64)
        found = summed([total, *waiting])
        yield pa.RecordBatch.from_arrays([pa.array(t) for t in found], ["key", "n"])

    return numbered.select("numbers").mapInArrow(count, "key bigint, n bigint")


def summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Counts by key, added up."""
    keys, place = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(place, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)


def pair_counts(numbered: DataFrame, table: np.ndarray, kinds: int) -> np.ndarray:
    """Counts of adjacent tokens by what `table` says of them, one of `kinds` numbers."""

    def pairs(numbers: pa.Array) -> np.ndarray:
        _, here, before, _ = tokens_of(numbers, table)
        return before * kinds + here

    # At most kinds ** 2 rows, and kinds are bounded.
    found = count_keys(numbered, pairs).groupBy("key").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(kinds**2)
    counts[found["key"].to_numpy(np.int64)] = found["n"].to_numpy(float)
    return counts.reshape(kinds, -1)


def exchange(pairs: np.ndarray, classes: int = CLASSES, rounds: int = ROUNDS) -> np.ndarray:
    """Class of each unit from the matrix of bigram counts; unit 0 keeps class 0 for itself."""
    units = len(pairs)
    order = np.argsort(-(pairs.sum(axis=0) + pairs.sum(axis=1)), kind="stable")
    order = order[order != 0]
    of = np.zeros(units, np.int64)
    of[order] = 1 + np.arange(len(order)) % max(1, classes - 1)
    between = np.zeros((classes, classes))
    np.add.at(between, (of[:, None], of[None, :]), pairs)

    def f(x: np.ndarray) -> np.ndarray:
        return x * np.log(np.maximum(x, 1))

    one = np.arange(classes)
    for _ in range(rounds):
        moved = 0
        for unit in order:
            own = of[unit]
            after = np.bincount(of, pairs[unit], classes)
            before = np.bincount(of, pairs[:, unit], classes)
            itself = pairs[unit, unit]
            after[own] -= itself
            before[own] -= itself
            between[own] -= after
            between[:, own] -= before
            between[own, own] -= itself
            rows, columns = between.sum(axis=1) + before, between.sum(axis=0) + after  # wherever the unit goes
            total_after, total_before = after.sum() + itself, before.sum() + itself
            old = f(between)
            gain = (f(between + after[None, :]) - old).sum(axis=1) + (f(between + before[:, None]) - old).sum(axis=0)
            corner = between[one, one]
            gain -= f(corner + after) + f(corner + before) - 2 * f(corner)
            gain += f(corner + after + before + itself) - f(corner)
            gain -= f(rows + total_after) - f(rows) + f(columns + total_before) - f(columns)
            gain[0] = -np.inf
            best = int(gain.argmax())
            if gain[best] <= gain[own] + 1e-9:
                best = own
            moved += best != own
            of[unit] = best
            between[best] += after
            between[:, best] += before
            between[best, best] += itself
        if not moved:
            break
    return of


def best_classes(words: np.ndarray, before: np.ndarray, after: np.ndarray, own: np.ndarray, between: np.ndarray) -> np.ndarray:
    """For each word the class under which its tokens are likeliest.

    `before` and `after` hold a row per word: how often each class stands there.  `between` counts the class
    bigrams; a word's own tokens are left out of its class.  Class 0 is the end's alone.
    """
    classes, line = len(between), np.arange(len(words))
    rows, columns = between.sum(axis=1), between.sum(axis=0)
    n_after, n_before = after.sum(axis=1), before.sum(axis=1)
    smooth = ALPHA * classes
    log = np.log((between + ALPHA) / (rows + smooth)[:, None])
    likely = after @ log.T + before @ log - n_before[:, None] * np.log(columns + 1)[None, :]
    following = np.log((np.maximum(between[own] - after, 0) + ALPHA) / (np.maximum(rows[own] - n_after, 0) + smooth)[:, None])
    leading = np.log((np.maximum(between[:, own].T - before, 0) + ALPHA) / (rows + smooth)[None, :])
    alone = n_before * np.log(np.maximum(columns[own] - n_before, 0) + 1)
    likely[line, own] = (after * following).sum(axis=1) + (before * leading).sum(axis=1) - alone
    likely[:, 0] = -np.inf
    best = likely.argmax(axis=1)
    return np.where(likely[line, best] > likely[line, own] + 1e-9, best, own)


def exchange_words(numbered: DataFrame, moving: np.ndarray, table: np.ndarray, between: np.ndarray) -> np.ndarray:
    """A round for all words that `moving` marks by number: their best classes, in a copy of `table`."""
    classes = len(between)
    slots = 2 * classes

    def contexts(numbers: pa.Array) -> np.ndarray:
        flat, here, before, _ = tokens_of(numbers, table)
        at = np.flatnonzero(moving[flat])  # never the end of a text, so a token follows
        keys = flat[at].astype(np.int64) * slots
        return np.concatenate([keys + before[at], keys + classes + here[at + 1]])

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, waiting, size = (np.zeros(0, np.int64), np.zeros(0, np.int64)), [], 0
        for batch in batches:
            waiting.append(tuple(c.to_numpy() for c in batch.columns))
            size += batch.num_rows
            if size > MERGED:
                total, waiting, size = summed([total, *waiting]), [], 0
        keys, n = summed([total, *waiting])
        words, place = np.unique(keys // slots, return_inverse=True)
        for first in range(0, len(words), 10_000):
            some = words[first : first + 10_000]
            low, high = np.searchsorted(place, [first, first + len(some)])
            seen = np.zeros((len(some), slots))
            seen[place[low:high] - first, keys[low:high] % slots] = n[low:high]
            own = table[some]
            best = best_classes(some, seen[:, :classes], seen[:, classes:], own, between)
            moved = best != own
            yield pa.RecordBatch.from_arrays([pa.array(some[moved]), pa.array(best[moved])], ["word", "class"])

    # A word's counts meet in one task: at most 2 * CLASSES numbers from each task before.
    counted = count_keys(numbered, contexts).repartition(F.expr(f"key div {slots}"))
    found = counted.mapInArrow(choose, "word bigint, class bigint").toPandas()  # at most LOOKED_UP rows
    after = table.copy()
    after[found["word"].to_numpy(np.int64)] = found["class"].to_numpy(np.int64)
    return after


def likelihood(between: np.ndarray) -> float:
    """Of the training tokens given their words' counts, but for what no exchange changes."""

    def f(x: np.ndarray) -> float:
        return float((x * np.log(np.maximum(x, 1))).sum())

    return f(between) - f(between.sum(axis=0)) - f(between.sum(axis=1))


def score_texts(docs: DataFrame, trains: Column, id_col: str = "doc_id") -> DataFrame:
    """Score all texts by a model of those that `trains` marks.

    Returns one row per row: id, trains, n_tokens (words and one end), n_known (tokens seen in
    training), train_tokens, base_score (add-one unigrams) and score (this model), both the log10
    probability of the text, and exchanged_tokens: how many training tokens are of words that were
    exchanged on their own.  Perplexity is 10 ** (-score / n_tokens).

    A null text counts as empty: its end alone.  Null ids are kept; a null mark counts as false; equal
    rows are scored alike; other columns are not looked at.  With nothing to train on, all words
    are unknown and every class is as likely.
    """
    own = docs.select(column(id_col).alias("id"), F.coalesce(trains, F.lit(False)).alias("trains"), text_or_empty().alias("text"))
    tokens = own.where("trains").select(F.explode(words_column(F.col("text"))).alias("word"))
    counts = stage(tokens.groupBy("word").agg(F.count("*").alias("c")), "word-counts")
    total, types = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    known = counts.where((F.col("c") * LOOKED_UP >= total) & (F.col("word") != END)).orderBy("word").collect()  # at most LOOKED_UP rows
    n_known = np.array([r["c"] for r in known], np.int64)
    numbered = stage(
        number_texts(own.withColumn("row", F.monotonically_increasing_id()), {r["word"]: i for i, r in enumerate(known)}), "lm-numbers"
    )
    learned = numbered.where("trains")

    # Units: 0 is the end of a text, 1 to ENDINGS the endings, the rest frequent words.
    frequent = n_known * FREQUENT >= total
    unit_of = np.array([1 + ending_of(r["word"]) for r in known], np.int64)
    unit_of[frequent] = 1 + ENDINGS + np.arange(frequent.sum())
    units = by_number(unit_of, 1 + np.arange(ENDINGS), 0)
    pairs = pair_counts(learned, units, 1 + ENDINGS + int(frequent.sum()))
    of = exchange(pairs)
    ends = int(pairs[:, 0].sum())
    between = np.zeros((CLASSES, CLASSES))
    np.add.at(between, (of[:, None], of[None, :]), pairs)

    # Words of their own: their numbers are those of `known`, the others' never move.
    classes, alone = of[units], ~frequent & (n_known >= LEAST)
    moving = by_number(alone, np.zeros(ENDINGS), 0).astype(bool)
    for _ in range(WORD_ROUNDS if alone.any() else 0):
        tried = exchange_words(learned, moving, classes, between)
        if (tried == classes).all():
            break
        counted = pair_counts(learned, tried, CLASSES)
        if likelihood(counted) <= likelihood(between):
            break
        classes, between = tried, counted
    exchanged = int(n_known[frequent | alone].sum())

    # Tokens and types of each class: the endings' are those of all words that are not known.
    shared = (F.crc32(F.right(F.col("word"), F.lit(2)).cast("binary")) % ENDINGS).cast("int")
    rarer = counts.where(F.col("c") * LOOKED_UP < total)
    class_tokens, class_types = np.zeros(CLASSES), np.zeros(CLASSES)
    for ending, n, kinds in rarer.where(f"word <> '{END}'").groupBy(shared.alias("ending")).agg(F.sum("c"), F.count("*")).collect():
        class_tokens[classes[OTHER - ending]] += n
        class_types[classes[OTHER - ending]] += kinds
    np.add.at(class_tokens, classes[: len(known)], n_known)
    np.add.at(class_types, classes[: len(known)], 1)
    class_tokens[0] += ends
    class_types[0] += 1 if ends else 0
    smooth = np.where(np.isin(np.arange(CLASSES), classes), ALPHA, 0.0)
    transition = np.log10((between + smooth[None, :] + 1e-300) / (between.sum(axis=1, keepdims=True) + smooth.sum()))
    step = transition - np.log10(class_tokens + class_types + 1)[None, :]
    # Those not known get their counts below.
    log_counts = np.concatenate([np.log10(n_known + 1.0), np.zeros(ENDINGS), [np.log10(ends + 1.0)]])
    seen_at = by_number(np.ones(len(known)), np.zeros(ENDINGS), 1 if ends else 0)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            flat, here, before, starts = tokens_of(part.column("numbers"), classes)
            columns = [
                *(part.column(c) for c in ("row", "id", "trains")),
                pa.array(np.diff(np.append(starts, len(flat))), pa.int64()),
                pa.array(np.add.reduceat(seen_at[flat], starts), pa.int64()),
                pa.array(np.add.reduceat(log_counts[flat], starts)),
                pa.array(np.add.reduceat(step[before, here], starts)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["row", "id", "trains", "n_tokens", "n_seen", "logs", "steps"])

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"row bigint, id {kind}, trains boolean, n_tokens bigint, n_seen bigint, logs double, steps double"
    rows = numbered.drop("rare").mapInArrow(score, schema)
    found = numbered.select("row", F.explode("rare").alias("word")).join(rarer, "word")
    counted_rare = found.groupBy("row").agg(F.count("*").alias("rare_seen"), F.sum(F.log10(F.col("c") + 1.0)).alias("rare_logs"))
    logs = F.col("logs") + F.coalesce("rare_logs", F.lit(0.0))
    return rows.join(counted_rare, "row", "left").select(
        F.col("id").alias(id_col),
        "trains",
        "n_tokens",
        (F.col("n_seen") + F.coalesce("rare_seen", F.lit(0))).alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        (logs - F.col("n_tokens") * float(np.log10(total + types + 1.0))).alias("base_score"),
        (logs + F.col("steps")).alias("score"),
        F.lit(exchanged).cast("bigint").alias("exchanged_tokens"),
    )
