"""License scans by ordered signature rules, in column expressions alone.

1. Keywords: every rule names words that any match of it holds.  A text is searched for these as plain
   substrings: first for a few that every rule has one of, then for the others of the rules whose one was
   found.  Rules without a chance are never tried, and most texts go no further.
2. Signatures: a text that has some rule's keywords is written as its words, each between blanks of
   its own, and the rules' regular expressions are matched against that.  What lies between matches tells
   where they start, in words.  Matches are marked by one replacement and words counted by one split, as
   functions that return all matches copy the whole text for each.
3. Suppression: a match inside that of a rule of a lower level, or of a longer or earlier one of its
   own level, is dropped.  As a containing match begins no later, one pass over a text's matches in their order
   finds it: the farthest end so far of each level.

A text is not copied to other machines; only its matches are shuffled, so that they are put in order, and
one row per text.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from washline.llm.license_rules import RULES, Rule
from washline.names import column

# What separates words.
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Stands before and after a match; it separates words, so that no `spaced` text has it.
MARK = "\x01"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: How likely a detection of each level is wrong: powers of two, so that products are exact.
DOUBT = [1 / 16, 1 / 8, 1 / 4, 1 / 2]


def spaced(text: Column) -> Column:
    """The words of a text, A to Z lower-cased, each with one blank before and one after."""
    words = F.trim(F.regexp_replace(F.translate(text, UPPER, LOWER), SEPARATOR, "  "))
    return F.concat(F.lit(" "), words, F.lit(" "))


def over_spaced(pattern: str) -> str:
    """A pattern over words parted by one blank, for `spaced` texts."""
    return " (?:" + pattern.replace(" ", "  ") + ") "


def words_in(text: Column) -> Column:
    """The number of words of a text."""
    return F.size(F.array_remove(F.split(text, WORD.replace("^", "", 1)), ""))


def _blanks_in(text: Column) -> Column:
    """Twice the number of words in part of a spaced text."""
    return F.char_length(text) - F.char_length(F.replace(text, F.lit(" ")))


def _has(lower: Column, keyword: str) -> Column:
    """A cheap test that no text with the word fails; `=word` asks for the whole word."""
    if not keyword.startswith("="):
        return F.contains(lower, F.lit(keyword))
    word = keyword[1:]
    return F.contains(lower, F.lit(word)) & F.regexp_like(lower, F.lit(rf"(?<![0-9a-z\x80-\x{{10FFFF}}]){word}(?![0-9a-z\x80-\x{{10FFFF}}])"))


def leading(sets: list[tuple[str, ...]]) -> list[str]:
    """Few keywords of which every set has one."""
    left, found = set(sets), []
    while left:
        counts = Counter(k for s in left for k in set(s))
        found.append(min(counts, key=lambda k: (-counts[k], k)))
        left = {s for s in left if found[-1] not in s}
    return found


def matches(docs: DataFrame, rules: list[Rule], id_col: str = "doc_id") -> DataFrame:
    """row, id, n_words, rule, level, label, base, start, end (words): one row per match, and one without a rule per row of `docs`."""
    spark = docs.sparkSession
    sets = sorted({r.keywords for r in rules})
    text = F.coalesce(column("text").cast("string"), F.lit(""))
    # Lower-casing all letters can only make more texts pass.
    own = docs.select(F.monotonically_increasing_id().alias("row"), column(id_col).alias("id"), text.alias("text")).withColumn("lower", F.lower("text"))
    single = {k: F.col(f"has{i}") for i, k in enumerate(sorted({k for s in sets for k in s}))}
    search = {k: _has(F.col("lower"), k) for k in single}
    first = leading(sets)
    own = own.select("row", "id", "text", "lower", *(search[k].alias(f"has{i}") for i, k in enumerate(single) if k in first))
    # The others, if a set's own one of these was found.
    rest = {k: reduce(or_, (single[x] for x in first if any(k in s and x in s for s in sets))) & search[k] for k in single if k not in first}
    own = own.select("row", "id", "text", *(rest.get(k, single[k]).alias(f"has{i}") for i, k in enumerate(single)))
    fits = [F.when(_all([single[k] for k in s]), F.lit(i)) for i, s in enumerate(sets)]
    own = own.select("row", "id", words_in(F.col("text")).alias("n_words"), "text", F.array_compact(F.array(*fits)).alias("sets"))
    own = own.select("row", "id", "n_words", F.when(F.size("sets") > 0, spaced(F.col("text"))).alias("spaced"), F.array_append("sets", F.lit(-1)).alias("sets"))
    # No set is ever empty; an inner explode would be planned with a filter that repeats all these searches.
    tried = own.select("row", "id", "n_words", "spaced", F.explode_outer("sets").alias("set"))
    numbers = {s: i for i, s in enumerate(sets)}
    table = [(numbers[r.keywords], i, r.level, r.label, r.base, over_spaced(r.pattern)) for i, r in enumerate(rules)]
    table.append((-1, None, None, None, None, None))
    known = spark.createDataFrame(table, "set int, rule int, level int, label string, base boolean, pattern string")
    # The rules are a few hundred rows.
    marked = F.regexp_replace("spaced", F.col("pattern"), F.lit(f"{MARK}$0{MARK}"))
    # What lies between matches, and the matches, in turn.
    tried = tried.join(F.broadcast(known), "set").withColumn("pieces", F.split(marked, MARK))
    tried = tried.where(F.col("rule").isNull() | (F.size("pieces") > 1))
    sizes = F.transform("pieces", _blanks_in)
    parts = F.arrays_zip(F.filter(sizes, lambda _, i: i % 2 == 0).alias("gap"), F.filter(sizes, lambda _, i: i % 2 == 1).alias("size"))
    parts = F.filter(parts, lambda p: p["size"].isNotNull())
    rows = tried.select("row", "id", "n_words", "rule", "level", "label", "base", F.posexplode_outer(parts).alias("at", "part"))
    rows = rows.select(*rows.columns[:-1], F.col("part.gap").alias("gap"), F.col("part.size").alias("size"))
    spread = rows.repartition("row")
    upto = Window.partitionBy("row", "rule").orderBy("at")
    # Every word has two blanks.
    end = F.floor(F.sum(F.col("gap") + F.col("size")).over(upto) / 2)
    return spread.select("row", "id", "n_words", "rule", "level", "label", "base", (end - F.floor(F.col("size") / 2)).alias("start"), end.alias("end"))


def _all(conditions: list[Column]) -> Column:
    found = conditions[0]
    for c in conditions[1:]:
        found = found & c
    return found


def _undisputed(found: DataFrame) -> DataFrame:
    """Add `kept`: is the match in none that goes before it?"""
    before = Window.partitionBy("row").orderBy("start", F.desc("end"), "level", "rule").rowsBetween(Window.unboundedPreceding, -1)
    farthest = [F.max(F.when(F.col("level") <= level, F.col("end"))).over(before) for level in range(len(DOUBT))]
    inside = F.lit(None).cast("bigint")
    for level, reach in enumerate(farthest):
        inside = F.when(F.col("level") == level, reach).otherwise(inside)
    return found.withColumn("kept", F.col("rule").isNotNull() & ~F.coalesce(inside >= F.col("end"), F.lit(False)))


def scan(docs: DataFrame, rules: list[Rule] = RULES, id_col: str = "doc_id") -> DataFrame:
    """id, n_words, n_base, first_word, last_word, base_labels, labels, score: one row per row of `docs`.

    n_base counts the places of the base phrases, first_word and last_word are their smallest and largest
    start (null without any), base_labels their labels; labels are these and those of the detections
    that no other suppresses.  Labels are distinct, sorted and joined by commas.  The score is 1 less the doubt
    of each level's labels multiplied, so 0 without a detection.

    A null or empty text has no words.  Null ids and equal rows stay, each a row of its own; other columns are
    not looked at, and an empty table gives no rows.
    """
    found = _undisputed(matches(docs, rules, id_col))
    labels = lambda c: F.array_join(F.sort_array(c), ",")
    of_level = [F.collect_set(F.when(F.col("kept") & (F.col("level") == level), F.col("label"))).alias(f"level{level}") for level in range(len(DOUBT))]
    rows = found.groupBy("row").agg(
        F.first("id").alias("id"),
        F.max("n_words").cast("bigint").alias("n_words"),
        F.count_if("base").alias("n_base"),
        F.min(F.when(F.col("base"), F.col("start"))).alias("first_word"),
        F.max(F.when(F.col("base"), F.col("start"))).alias("last_word"),
        F.collect_set(F.when(F.col("base"), F.col("label"))).alias("base_labels"),
        *of_level,
    )
    doubt = F.lit(1.0)
    for level, x in enumerate(DOUBT):
        doubt = doubt * F.pow(F.lit(x), F.size(f"level{level}"))
    every = F.array_distinct(F.concat("base_labels", *(f"level{level}" for level in range(len(DOUBT)))))
    return rows.select(
        F.col("id").alias(id_col),
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        labels("base_labels").alias("base_labels"),
        labels(every).alias("labels"),
        (1 - doubt).alias("score"),
    )
