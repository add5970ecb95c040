"""Benchmark decontamination by template canonicalisation, in column expressions alone.

Numbers, names and units become typed placeholders, so that a question asked again with other
values has the same template.  A number is one slot with its separators and decimals; a name is any run of
capitalised words, wherever they stand, but for common words that start sentences.  Windows of WINDOW
template tokens are hash-joined with those of the benchmark.  Items of one template are matched as one and
told apart by their values afterwards, so that many variants of a question cost little more than one.  Along
one alignment of document and item, equal slots of the item must have equal values in the document: a
window of the same shape with unrelated values is no copy.

Plain windows, of lower-cased words without any slots, are joined as well, so a verbatim copy in any
case or spacing never depends on what is a name.  A document holds an item if windows of either kind that
pass cover at least SHARE of the item's.  An item of fewer tokens is one window.

Most windows of a document can be ruled out by three of their tokens: a table of flags, made from the
benchmark's windows, says which triples occur in it at all.  Only windows that pass are hashed whole.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from washline.llm.common import stage, text_or_empty
from washline.names import column

WINDOW = 8
SHARE = 0.5

#: So many windows or items of the benchmark, or marked documents, are broadcast at most (some 60 bytes each), and items
#: of so many tokens in all.
MOST_BROADCAST, MOST_TOKENS = 500_000, 8_000_000

# Words for units, which are placeholders only right after a number.
UNITS = """
    mm cm m km inch inches ft feet yard yards mile miles mg g kg lb lbs oz ton tons ml l litre litres liter liters
    s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years
    percent usd eur dollar dollars euro euros cent cents pound pounds mph kmh degree degrees
""".split()

# Words that are capitalised because they start a sentence.
STARTERS = """
    A An The This That These Those There Here It Its He She They We You I His Her Their Our Your My If In On At Of For From With Without By To
    As And Or But Not No So Then Than When Where What Which Who Whom Whose Why How While Each Every All Some Any Many Much Most More Is Are Was Were
    Be Do Does Did Has Have Had Can Could Will Would Should May Might Must After Before During Between Both Since Because Although
""".split()

#: Marks of slots, and the point of a decimal number.
NUMBER, NAME, UNIT, POINT = "\x01", "\x02", "\x03", "\x04"


def tokens_of(text: Column) -> Column:
    """Lower-case words of a text; slots start with the character of their type, then have their value.

    A run of digits with single points or commas inside is one number, without its commas.
    """
    marks = NUMBER + NAME + UNIT + POINT
    marked = reduce(or_, (F.contains(text, F.lit(m)) for m in marks))
    clean = F.when(marked, F.translate(text, marks, " " * len(marks))).otherwise(text)
    named = F.regexp_replace(clean, rf"(?=\p{{Lu}})(?<![\p{{L}}\p{{M}}\p{{N}}])(?!(?:{'|'.join(STARTERS)})(?![\p{{L}}\p{{M}}]))\p{{Lu}}\p{{Ll}}+", NAME + "$0")
    whole = F.regexp_replace(named, r"(?<=\p{Nd}),(?=\p{Nd}{3}(?!\p{Nd}))", "")
    pointed = F.regexp_replace(whole, r"(?<=\p{Nd})\.(?=\p{Nd})", POINT)
    numbered = F.regexp_replace(pointed, rf"\p{{Nd}}[\p{{Nd}}{POINT}]*", f" {NUMBER}$0 ")
    units = F.regexp_replace(numbered, rf"(?i)({NUMBER}[\p{{Nd}}{POINT}]+ +){NAME}?({'|'.join(UNITS)})(?!\p{{L}})", f"$1{UNIT}$2")
    slotted = F.when(F.regexp_like(clean, F.lit(r"\p{Nd}")), units).otherwise(named)
    return F.filter(F.split(F.lower(slotted), rf"[^\p{{L}}\p{{M}}\p{{N}}{marks}]+"), lambda w: w != "")


def _is_slot(word: Column) -> Column:
    return F.ascii(word).between(1, 3)


def _triple(hashes: Column, place: Column, size: Column) -> Column:
    """A hash of the first, middle and last token of a window."""
    half = F.shiftright(size, 1)
    return F.xxhash64(F.get(hashes, place), F.get(hashes, place + half), F.get(hashes, place + size - 1), size)


def _places(hashes: Column, size: Column, flags: bytes | None) -> Column:
    """Where windows begin, of those that the flags do not rule out."""
    last = F.size(hashes) - size
    places = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    if flags is None:
        return places
    known = F.lit(flags)
    at = lambda i: _triple(hashes, i, size).bitwiseAND(F.lit(len(flags) - 1)).cast("int")
    return F.filter(places, lambda i: F.substr(known, at(i) + 1, F.lit(1)) == F.lit(b"\x01"))


def windows_of(hashes: Column, words: Column, size: Column, flags: bytes | None = None) -> Column:
    """Windows (place, size, hash, slots) of template tokens; slots: the values in the window, or null without any."""

    def window(i: Column) -> Column:
        values = F.transform(F.filter(F.slice(words, i + 1, size), _is_slot), lambda w: F.substring(w, 2, 1 << 30))
        slots = F.when(F.size(values) > 0, values)
        key = F.xxhash64(F.slice(hashes, i + 1, size))
        return F.struct(i.alias("place"), size.alias("size"), key.alias("hash"), slots.alias("slots"))

    return F.transform(_places(hashes, size, flags), window)


def plain_windows(plain: Column, size: Column, flags: bytes | None = None) -> Column:
    """Hashes of the windows of plain words, each once."""
    return F.array_distinct(F.transform(_places(plain, size, flags), lambda i: F.xxhash64(F.slice(plain, i + 1, size), size)))


def _templates(df: DataFrame, keys: list[str]) -> DataFrame:
    """`keys`, `t`, `w` and `plain`.

    w: the template tokens with one name for a run of names; t: a hash of each, the same for all
    slots of a type; plain: a hash of each word as it is.
    """
    words = df.select(*keys, tokens_of(F.col("text")).alias("w"))
    bare = F.transform("w", lambda w: F.xxhash64(F.when(_is_slot(w), F.substring(w, 2, 1 << 30)).otherwise(w)))
    marked = words.select(*keys, "w", bare.alias("plain"), F.exists("w", _is_slot).alias("slotted"))
    is_name = lambda w: F.startswith(w, F.lit(NAME))
    run = F.filter("w", lambda w, i: ~(is_name(w) & (i > 0) & F.coalesce(is_name(F.get("w", i - 1)), F.lit(False))))
    merged = marked.select(*keys, "plain", "slotted", F.when(F.col("slotted"), run).otherwise(F.col("w")).alias("w"))
    hashes = F.when(F.col("slotted"), F.transform("w", lambda w: F.xxhash64(F.when(_is_slot(w), F.left(w, F.lit(1))).otherwise(w)))).otherwise(F.col("plain"))
    return merged.select(*keys, hashes.alias("t"), "w", "plain")


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """item_id, template (a hash of the template's tokens), of (its windows), t, w, plain (hashes of plain windows); each text once per item."""
    items = benchmark.select(column("item_id").alias("item_id"), text_or_empty().alias("text"))
    tokens = _templates(items, ["item_id"]).where(F.size("t") > 0).dropDuplicates(["item_id", "t", "w", "plain"])
    size, plain_size = F.least(F.size("t"), F.lit(WINDOW)), F.least(F.size("plain"), F.lit(WINDOW))
    return tokens.select(
        "item_id",
        F.xxhash64("t").alias("template"),
        (F.size("t") - size + 1).alias("of"),
        "t",
        "w",
        plain_size.alias("plain_size"),
        plain_windows(F.col("plain"), plain_size).alias("plain_windows"),
        F.transform(_places(F.col("t"), size, None), lambda i: _triple(F.col("t"), i, size)).alias("triples"),
        F.transform(_places(F.col("plain"), plain_size, None), lambda i: _triple(F.col("plain"), i, plain_size)).alias("plain_triples"),
    ).withColumnRenamed("plain_windows", "plain")


def _flags(items: DataFrame, triples: str) -> bytes | None:
    """One byte per remainder of a triple's hash, 1 if some window has it; None if there are too many windows."""
    n = items.select(F.sum(F.size(triples))).first()[0] or 0
    if n > MOST_BROADCAST:
        return None
    size = 1 << max(16, min(22, (16 * n).bit_length()))
    found = bytearray(size)
    places = items.select(F.explode(triples).alias("x")).select(F.col("x").bitwiseAND(F.lit(size - 1)).alias("x")).distinct()
    for row in places.collect():  # at most MOST_BROADCAST
        found[row["x"]] = 1
    return bytes(found)


def _key(window: Column) -> Column:
    """What a window is found by: its hash, and in a window of placeholders mostly, or a crowd of them, the very values."""
    crowded = F.size(window["slots"]) * 2 > window["size"]
    return F.when(crowded, F.xxhash64(window["hash"], window["slots"])).otherwise(window["hash"])


def template_windows(items: DataFrame) -> DataFrame:
    """template, of, hash, size, item_place, weight, key; each hash once per template, at its first place, with the keys of all its items."""
    size = F.least(F.size("t"), F.lit(WINDOW))
    windows = items.select("template", "of", F.explode(windows_of(F.col("t"), F.col("w"), size)).alias("w"))
    windows = windows.select("template", "of", "w.hash", "w.size", F.col("w.place").alias("item_place"), _key(F.col("w")).alias("key")).distinct()
    first = windows.groupBy("template", "hash").agg(F.min("item_place").alias("item_place"), F.count_distinct("item_place").alias("weight"))
    return windows.join(first, ["template", "hash", "item_place"])


def _judged(alignment: Column, values: Column) -> Column:
    """consistent, reworded and matched (hash and weight of windows) of an alignment with the item of these slot values."""

    def own(m: Column) -> Column:
        return F.filter(F.slice(values, m["item_place"] + 1, m["size"]), lambda v: v.isNotNull())

    passed = F.filter(alignment["matched"], lambda m: (F.size(own(m)) * 2 <= m["size"]) | m["slots"].eqNullSafe(own(m)))
    slotted = F.filter(passed, lambda m: m["slots"].isNotNull())
    pairs = F.array_distinct(F.flatten(F.transform(slotted, lambda m: F.zip_with(own(m), m["slots"], lambda a, b: F.struct(a.alias("a"), b.alias("b"))))))
    return F.struct(
        (F.size(F.array_distinct(F.transform(pairs, lambda p: p["a"]))) == F.size(pairs)).alias("consistent"),
        F.exists(pairs, lambda p: p["a"] != p["b"]).alias("reworded"),
        _weights(passed).alias("matched"),
    )


def _weights(windows: Column) -> Column:
    return F.transform(windows, lambda m: F.struct(m["hash"].alias("hash"), m["weight"].alias("weight")))


def _share(matched: Column) -> Column:
    """Of the template's windows, those in any of some arrays."""
    return F.aggregate(F.array_distinct(F.flatten(matched)), F.lit(0).cast("bigint"), lambda n, m: n + m["weight"]) / F.col("of")


def leaks(docs: DataFrame, benchmark: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """doc_id (or `keys`), item_id, share, reworded: one row per document and item that it holds.

    `share` of the item's windows is found, `reworded` tells that some slot has another value, and that
    no larger share is found word by word.  Null texts count as empty, empty texts and items hold
    nothing; null ids are kept as ids; equal rows are one.  An item of several texts is held with the one
    that is held most.  Other columns are not looked at.
    """
    keys = keys or ["doc_id"]
    items = stage(benchmark_items(benchmark), "benchmark-items")
    index = stage(template_windows(items), "benchmark-windows")
    n_items, n_bytes = items.agg(F.count("*"), F.coalesce(F.sum(F.size("t") + F.size("plain")), F.lit(0))).first()
    small = n_items <= MOST_BROADCAST and n_bytes <= MOST_TOKENS
    rows = docs.select(*(column(k).alias(f"k{i}") for i, k in enumerate(keys)), text_or_empty().alias("text"))
    own = [f"k{i}" for i in range(len(keys))]
    templates = _templates(rows, own)
    values = F.transform("w", lambda w: F.when(_is_slot(w), F.substring(w, 2, 1 << 30)))
    own_items = items.select("template", "item_id", values.alias("values"), "plain")
    own_items = F.broadcast(own_items) if small else own_items

    sizes = index.agg(F.count("*"), F.collect_set("size")).first()  # at most WINDOW sizes
    plain_sizes = items.agg(F.collect_set("plain_size")).first()[0]
    flags, plain_flags = _flags(items, "triples"), _flags(items, "plain_triples")
    found = [windows_of(F.col("t"), F.col("w"), F.lit(n), flags) for n in sorted(sizes[1]) or [WINDOW]]
    plain = [plain_windows(F.col("plain"), F.lit(n), plain_flags) for n in sorted(plain_sizes) or [WINDOW]]
    # Both kinds of windows come from one reading of a text; a plain one has its hash alone.
    as_window = lambda x: F.struct(F.lit(-1).alias("place"), F.lit(0).alias("size"), x.alias("hash"), F.lit(None).cast("array<string>").alias("slots"))
    windows = templates.select(*own, F.explode(F.concat(*found, *(F.transform(p, as_window) for p in plain))).alias("w"))
    keyed = windows.select(*own, "w.place", "w.slots", F.when(F.col("w.place") < 0, F.col("w.hash")).otherwise(_key(F.col("w"))).alias("key"))

    plain_index = items.select("template", F.explode("plain").alias("key")).distinct()
    nothing = {c: F.lit(None).cast(index.schema[c].dataType) for c in index.columns if c not in ("template", "key")}
    both = index.withColumn("plain", F.lit(False)).unionByName(plain_index.withColumns(nothing).withColumn("plain", F.lit(True)))
    both = stage(both, "benchmark-keys")
    few = F.broadcast(both) if both.count() <= 2 * MOST_BROADCAST else both
    hits = stage(keyed.join(few, "key").where(F.col("plain") == (F.col("place") < 0)), "benchmark-hits")

    # Word by word.
    words = hits.where("plain").groupBy(*own, "template").agg(F.collect_set("key").alias("found")).join(own_items, "template")
    verbatim = words.select(*own, "item_id", (F.size(F.array_intersect("plain", "found")) / F.size("plain")).alias("share"), F.lit(False).alias("reworded"))

    # By templates.
    shift = (F.col("place") - F.col("item_place")).alias("shift")
    aligned = hits.where("not plain").groupBy(*own, "template", "of", shift).agg(F.collect_set(F.struct("item_place", "size", "hash", "weight", "slots")).alias("matched"))
    whole = aligned.groupBy(*own, "template", "of").agg(F.collect_list(F.struct("matched")).alias("alignments"))
    # Only templates of which enough is found, whatever the values, are told apart by item.
    whole = whole.where(_share(F.transform("alignments", lambda a: _weights(a["matched"]))) >= SHARE)
    judged = whole.join(own_items, "template").withColumn("alignments", F.transform("alignments", lambda a: _judged(a, F.col("values"))))
    judged = judged.withColumn("alignments", F.filter("alignments", lambda a: a["consistent"] & (F.size(a["matched"]) > 0)))
    share = _share(F.transform("alignments", lambda a: a["matched"]))
    judged = judged.select(*own, "item_id", share.alias("share"), F.exists("alignments", lambda a: a["reworded"]).alias("reworded"))

    order = F.struct("share", ~F.col("reworded"))
    best = judged.unionByName(verbatim).where(F.col("share") >= SHARE).groupBy(*own, "item_id").agg(F.max("share").alias("share"), F.max_by("reworded", order).alias("reworded"))
    named = [F.col(f"k{i}").alias(k) for i, k in enumerate(keys)]
    return best.select(*named, "item_id", "share", "reworded")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no item; columns, whatever their names, and equal rows stay as they are."""
    keys = docs.select(column("doc_id"), F.xxhash64(text_or_empty()).alias("__hash"), text_or_empty().alias("text"))
    found = leaks(keys, benchmark, ["doc_id", "__hash"]).select(F.col("doc_id").alias("__doc_id"), F.col("__hash").alias("__marked"))
    marked = stage(found.distinct(), "leaks")
    few = F.broadcast(marked) if marked.count() <= MOST_BROADCAST else marked
    same = docs["`doc_id`"].eqNullSafe(few["__doc_id"]) & (F.xxhash64(F.coalesce(docs["`text`"].cast("string"), F.lit(""))) == few["__marked"])
    return docs.join(few, same, "left_anti")
