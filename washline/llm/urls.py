"""URL filter: allow and block rules first, gradient-boosted trees on lexical features for the rest.

Everything runs in the JVM: features are column expressions, training and scoring are Spark ML's.

The trees learn from labelled URLs, by default those that the rules decide.  At most MOST_TRAINED
different URLs are fitted, those first in the order of a hash.  The suffix statistics (how often URLs
with this ending of the host, or this first path segment, are blocked) count all labelled URLs.  For those
that the trees learn from, each of FOLDS parts of the labelled URLs takes the statistics of the others: a
URL's own label is not in its features, nor, by its absence, readable from them.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from washline.llm.common import stage
from washline.names import column

#: Labelled URLs that are fitted at most.
MOST_TRAINED = 20_000

#: Tables of statistics of at most so many rows are broadcast, larger ones joined by a shuffle.
MOST_BROADCAST = 500_000

FOLDS = 5

#: Rules are compiled into one expression; more of them belong in a table that is joined.
MOST_RULES = 1000

TREES, DEPTH, STEP = 10, 4, 0.3

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

LEXICAL = {
    "url_length": lambda u, h, p: F.char_length(u),
    "host_length": lambda u, h, p: F.char_length(h),
    "path_length": lambda u, h, p: F.char_length(p),
    "depth": lambda u, h, p: F.char_length(p) - F.char_length(F.replace(p, F.lit("/"))),
    "labels": lambda u, h, p: F.size(F.split(h, r"\.")),
    "longest_label": lambda u, h, p: F.array_max(F.transform(F.split(h, r"\."), lambda x: F.char_length(x))),
    "digit_ratio": lambda u, h, p: F.regexp_count(u, F.lit("[0-9]")) / F.greatest(F.char_length(u), F.lit(1)),
    "hyphens": lambda u, h, p: F.char_length(h) - F.char_length(F.replace(h, F.lit("-"))),
    "marks": lambda u, h, p: F.regexp_count(u, F.lit(r"[^A-Za-z0-9/.:]")),
    "parameters": lambda u, h, p: F.regexp_count(u, F.lit("[?&][^=&#]*=")),
    "fragment": lambda u, h, p: F.instr(u, "#").cast("boolean").cast("int"),
    "encrypted": lambda u, h, p: F.startswith(u, F.lit("https:")).cast("int"),
    "host_entropy": lambda u, h, p: _entropy(h),
    "path_entropy": lambda u, h, p: _entropy(p),
}

#: Parts of a URL whose share of blocked ones is a feature.
SUFFIXES = {
    "top": lambda h, p: F.substring_index(h, ".", -1),
    "domain": lambda h, p: F.substring_index(h, ".", -2),
    "host": lambda h, p: h,
    "segment": lambda h, p: F.concat(F.substring_index(h, ".", -1), F.substring_index(p, "/", 2)),
}


def _entropy(text: Column) -> Column:
    """Bits per character."""
    letters = F.array_distinct(F.split(text, ""))
    n = F.char_length(text)
    share = F.transform(letters, lambda c: (n - F.char_length(F.replace(text, c))) / n)
    bits = F.aggregate(share, F.lit(0.0), lambda total, x: total - F.when(x > 0, x * F.log2(x)).otherwise(0.0))
    return F.when(n > 0, bits).otherwise(0.0)


def host_of(url: Column) -> Column:
    """From after the first `://` to `/`, `?`, `#` or the end, A to Z lower-cased; empty for null or without `://`."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end; empty for null or without `://`."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*(/[^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[str]) -> Column:
    """The longest of the rules (`host/path`) that fits, else null.

    A rule fits its host and all its subdomains if the URL's path starts with the rule's.
    """
    found = F.lit(None).cast("string")
    for rule in sorted({r.removeprefix("!") for r in rules}, key=lambda r: (len(r), r)):
        at, slash, start = rule.partition("/")
        fits = ((host == at) | F.endswith(host, F.lit(f".{at}"))) & F.startswith(path, F.lit(slash + start))
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def _fold() -> Column:
    return F.pmod(F.xxhash64("__url"), F.lit(FOLDS)).cast("int")


def _statistics(labelled: DataFrame) -> dict[str, DataFrame]:
    """For each kind of suffix: its value, and per fold how many labelled URLs have it and how many of these are blocked."""
    found = {}
    for name, f in SUFFIXES.items():
        part = f(F.col("host"), F.col("path")).alias(f"__part_{name}")
        blocked = F.array(*(F.sum(F.when(_fold() == k, F.col("__label")).otherwise(0.0)) for k in range(FOLDS)))
        n = F.array(*(F.count_if(_fold() == k) for k in range(FOLDS)))
        found[name] = stage(labelled.groupBy(part).agg(blocked.alias(f"__blocked_{name}"), n.alias(f"__n_{name}")), f"url-{name}")
    return found


def _features(rows: DataFrame, statistics: dict[str, DataFrame], prior: float, apart: Column) -> DataFrame:
    """Rows with `__url`, `host` and `path` get a vector `__features`.

    `apart` is the fold that is left out of a row's statistics, or null.
    """
    url, host, path = F.col("__url"), F.col("host"), F.col("path")
    rows = rows.withColumns({f"__{n}": f(url, host, path).cast("double") for n, f in LEXICAL.items()})
    rows = rows.withColumns({f"__part_{n}": f(host, path) for n, f in SUFFIXES.items()}).withColumn("__apart", apart)

    def total(counts: str) -> Column:
        every = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
        return F.coalesce(every - F.coalesce(F.get(counts, F.col("__apart")), F.lit(0.0)), F.lit(0.0))

    for name, counted in statistics.items():
        few = F.broadcast(counted) if counted.count() <= MOST_BROADCAST else counted
        share = (total(f"__blocked_{name}") + prior) / (total(f"__n_{name}") + 1)
        rows = rows.join(few, f"__part_{name}", "left").withColumn(f"__share_{name}", share)
    inputs = [f"__{n}" for n in LEXICAL] + [f"__share_{n}" for n in statistics]
    return VectorAssembler(inputCols=inputs, outputCol="__features").transform(rows)


def judge(pages: DataFrame, rules: list[str], labelled: DataFrame | None = None) -> DataFrame:
    """Add host, path, rule, verdict (`allow` or `block`) and block_score to rows with a `url`.

    `rules` are `host/path`, to allow, or `!host/path`, to block.  `labelled` has url and blocked
    (boolean); without it the URLs that the rules decide teach the trees.  A null or empty url has an
    empty host and path and is judged like any other.  If only one class is labelled every URL without
    a rule gets its verdict; if none is, `allow`.  Columns of the added names are replaced; other
    columns and equal rows stay.
    """
    if len(rules) > MOST_RULES:
        raise ValueError(f"at most {MOST_RULES} rules")
    added = ["host", "path", "rule", "verdict", "block_score"]
    kept = pages.drop(*added)

    def parsed(df: DataFrame) -> DataFrame:
        url = F.coalesce(column("url").cast("string"), F.lit(""))
        return df.withColumns({"__url": url, "host": host_of(url), "path": path_of(url)})

    rows = parsed(kept).withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    blocking = [r.removeprefix("!") for r in rules if r.startswith("!")]
    ruled = F.when(F.col("rule").isNotNull(), F.col("rule").isin(blocking))
    if labelled is None:
        known = rows.select("__url", "host", "path", ruled.alias("blocked"))
    else:
        known = parsed(labelled).select("__url", "host", "path", column("blocked").cast("boolean").alias("blocked"))
    known = known.where("blocked is not null").groupBy("__url").agg(*(F.first(c).alias(c) for c in ("host", "path")), F.max("blocked").alias("blocked"))
    labels = stage(known.withColumn("__label", F.col("blocked").cast("double")), "labelled-urls")
    n, blocked = labels.agg(F.count("*"), F.coalesce(F.sum("__label"), F.lit(0.0))).first()
    if blocked in (0, n):
        score = F.lit(1.0 if n and blocked else 0.0)
        scored = rows.withColumn("block_score", score)
    else:
        prior = blocked / n
        statistics = _statistics(labels)
        sample = labels.orderBy(F.xxhash64("__url"), "__url").limit(MOST_TRAINED)
        trees = GBTClassifier(featuresCol="__features", labelCol="__label", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=1)
        trees.setPredictionCol("__verdict").setProbabilityCol("__probability").setRawPredictionCol("__raw")
        model = trees.fit(_features(sample, statistics, prior, _fold()))
        scored = model.transform(_features(rows, statistics, prior, F.lit(None).cast("int"))).withColumn("block_score", vector_to_array("__probability")[1])
    verdict = F.when(F.coalesce(ruled, F.col("block_score") > 0.5), "block").otherwise("allow")
    return scored.withColumn("verdict", verdict).select(*map(column, kept.columns), *added)
