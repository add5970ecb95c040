"""A dense row number 0..n-1 without pulling the rows into one task."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from itertools import accumulate, groupby

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from washline.names import as_list, column
from washline.settings import freed_shuffles, open_files, small_methods
from washline.staging import remove_staged, staged_files, staged_size, staging_path

MAX_RANGES = 10_000  # their bounds and offsets are handed to every task
SAMPLED_PER_RANGE = 32
INPUT_PER_RANGE = 1 << 30
MAX_PASSES = 8  # of `write_indexed`; a pass shuffles one of so many parts of a large table
ROWS_PER_PASS, INPUT_PER_PASS = 4_000_000, 1 << 28
KEY, PLACE = "__key", "__row_place"
ENDS = ("tie", "file", "place")  # of a key


def with_row_index(
    df: DataFrame,
    order_by: str | Iterable[str],
    name: str = "index",
    partitions: int | None = None,
) -> DataFrame:
    """Add the row's 0-based place in the order of `order_by` as a bigint, as first column.

    `partitions` is the number of ranges, by default one per GB of the stored table and at least
    `spark.sql.shuffle.partitions`.  The result reads a stored copy of the rows, which must stay until it was used.

    1. Store the rows once.  From then on a row is known by its file and its place in it, so every later
       look at the table sees the same, also after lost executors.
    2. Sample the keys (narrow columns alone) and take the bounds of ranges from the sample.
    3. Count the rows of each range (narrow columns again); sums of the counts are the ranges' offsets.
    4. Shuffle the rows by range, sort each range, and add its offset to the place in it.

    Bounds and offsets are small fixed tables, at most MAX_RANGES rows, so no task depends on what
    another run of step 2 would sample.  A key is the order's columns, then a hash of the others, then file
    and place: a value or a row repeated any number of times still spreads over many ranges.
    """
    order = _order(df, order_by, name)
    if partitions is not None and not 1 <= partitions <= MAX_RANGES:
        raise ValueError(f"partitions must be between 1 and {MAX_RANGES}")
    path = staging_path(df.sparkSession, "row-index")
    total = _store(df, path)
    ranges = partitions or _ranges(df.sparkSession, path)
    _store_bounds(df, path, order, ranges, total)
    ranged = _ranged(df, path, order, ranges)
    return _numbered(ranged, _starts(ranged), ranges + 1, order, name, df.columns)


def write_indexed(df: DataFrame, order_by: str | Iterable[str], write: Callable[[DataFrame], object], name: str = "index") -> None:
    """Hand the table of `with_row_index` to `write`, which adds rows to a table, and leave no stored copy.

    A large table is handed over in parts, one after another, so that beside its rows only a part of them is on
    disk twice and only a part in a shuffle: the stored rows are split by groups of ranges, some of their files at a
    time, each deleted once split; then each group is shuffled, sorted, written and deleted.
    """
    spark, order = df.sparkSession, _order(df, order_by, name)
    path = staging_path(spark, "row-index")
    try:
        total = _store(df, path)
        passes = min(MAX_PASSES, max(total // ROWS_PER_PASS, staged_size(spark, f"{path}/rows") // INPUT_PER_PASS) + 1)
        # Each pass has work for all cores.
        least = 2 * passes * spark.sparkContext.defaultParallelism if passes > 1 else 1
        ranges = min(MAX_RANGES, max(least, _ranges(spark, path)))
        _store_bounds(df, path, order, ranges, total)
        if passes == 1:
            ranged = _ranged(df, path, order, ranges)
            write(_numbered(ranged, _starts(ranged), ranges + 1, order, name, df.columns))
            return
        _split(df, path, order, ranges, passes)
        held = [T.StructField("__range", T.IntegerType())]
        starts = _starts(spark.read.schema(T.StructType(held)).parquet(f"{path}/groups"))
        for group, own in groupby(starts, lambda r: _group(r, ranges, passes)):
            folder, own = f"{path}/groups/__group={group}", list(own)
            rows = spark.read.schema(T.StructType([*df.schema.fields, *held])).parquet(folder)
            # Each part is computed once, so rows alike in all but their place need no order among themselves.
            shifted = rows.withColumn("__range", F.col("__range") - own[0])
            part = {r - own[0]: starts[r] for r in own}
            with freed_shuffles(spark):
                write(_numbered(shifted, part, own[-1] - own[0] + 1, order, name, df.columns, ends=False))
            remove_staged(spark, folder)
    finally:
        remove_staged(spark, path)


def _order(df: DataFrame, order_by: str | Iterable[str], name: str) -> list[str]:
    order = as_list(order_by)
    if not order:
        raise ValueError("with_row_index needs an order: file order is not defined in Spark")
    if name in df.columns:
        raise ValueError(f"the table has a column {name} already")
    return order


def _store(df: DataFrame, path: str) -> int:
    """Store the rows, return their number."""
    with small_methods(df.sparkSession):
        df.write.parquet(f"{path}/rows")
    return df.sparkSession.read.schema(df.schema).parquet(f"{path}/rows").count()


def _ranges(spark: SparkSession, path: str) -> int:
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(MAX_RANGES, max(least, staged_size(spark, f"{path}/rows") // INPUT_PER_RANGE + 1))


def _keyed(df: DataFrame, order: list[str], *paths: str) -> DataFrame:
    stored = df.sparkSession.read.schema(df.schema).parquet(*paths)
    return stored.withColumn(KEY, _key(stored, order))


def _store_bounds(df: DataFrame, path: str, order: list[str], ranges: int, total: int) -> None:
    share = min(1.0, ranges * SAMPLED_PER_RANGE / max(total, 1))
    chosen = F.pmod(F.xxhash64(f"{KEY}.file", f"{KEY}.place"), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = _keyed(df, order, f"{path}/rows").where(chosen).agg(F.array_sort(F.collect_list(KEY)).alias("keys"))
    every = F.greatest(F.floor(F.size("keys") / ranges), F.lit(1))
    bounds = F.filter("keys", lambda _, i: (i > 0) & (i % every == 0))
    sample.select(bounds.alias("bounds")).write.parquet(f"{path}/bounds")


def _ranged(df: DataFrame, path: str, order: list[str], ranges: int, files: Iterable[str] = ()) -> DataFrame:
    """The stored rows, or those in the given files, with key and range."""
    keyed = _keyed(df, order, *(files or [f"{path}/rows"]))
    return _with_range(keyed, df.sparkSession.read.parquet(f"{path}/bounds"), ranges)


def _starts(ranged: DataFrame) -> dict[int, int]:
    """How many rows are before each range, by ascending range."""
    # One row per range, at most MAX_RANGES + 1.
    sizes = sorted(ranged.groupBy("__range").count().collect())
    return dict(zip((r[0] for r in sizes), accumulate((r[1] for r in sizes), initial=0)))


def _group(number, ranges: int, passes: int):
    """The group of a range, or of a column of them; there can be a few more ranges than asked for."""
    if isinstance(number, Column):
        return F.least(F.floor(number * passes / (ranges + 1)), F.lit(passes - 1)).cast("int")
    return min(int(number * passes / (ranges + 1)), passes - 1)


def _split(df: DataFrame, path: str, order: list[str], ranges: int, passes: int) -> None:
    """Move the stored rows, with their ranges, into a folder per group of ranges."""
    spark, files = df.sparkSession, staged_files(df.sparkSession, f"{path}/rows")
    # Each step has files for all cores.
    steps = min(MAX_PASSES, max(1, len(files) // spark.sparkContext.defaultParallelism))
    group = _group(F.col("__range"), ranges, passes).alias("__group")
    for i in range(steps):
        some = files[i::steps]
        rows = _ranged(df, path, order, ranges, some).select(*[column(c) for c in df.columns], "__range", group)
        # Rows go to the open file of their group, so that a task need not sort them.
        with open_files(spark, passes):
            out = rows.write.mode("append").partitionBy("__group")
            out.options(**{"compression": "zstd", "parquet.block.size": 16 << 20}).parquet(f"{path}/groups")
        for file in some:
            remove_staged(spark, file)


def _numbered(
    ranged: DataFrame, starts: dict[int, int], partitions: int, order: list[str], name: str, columns: list[str], ends: bool = True
) -> DataFrame:
    """The rows with their index; `starts` has the ranges' offsets.

    Without the `ends` of the keys, rows that are alike in the order's columns and the hash of the others come in any order.
    """
    offsets = ranged.sparkSession.createDataFrame([(starts,)], "starts map<int, bigint>")
    # The key's columns are the rows' own, so only what ends it is shuffled beside them.
    last = [F.col(f"{KEY}.{e}").alias(f"__{e}") for e in ENDS] if ends else []
    rows = ranged.select(*[column(c) for c in columns], "__range", *last)
    tail = [F.col(f"__{e}") for e in ENDS] if ends else [_tie(rows.drop("__range"), order)]
    place = F.row_number().over(Window.partitionBy("__range").orderBy(*[column(c) for c in order], *tail)) - 1
    indexed = rows.repartitionById(partitions, F.col("__range")).withColumn(PLACE, place)
    index = F.element_at(offsets.scalar(), F.col("__range")) + F.col(PLACE)
    return indexed.select(index.alias(name), *[column(c) for c in columns])


def _tie(rows: DataFrame, order: list[str]) -> Column:
    rest = [column(f.name) for f in rows.schema.fields if f.name not in order and not _holds_map(f.dataType)]
    return F.xxhash64(*rest) if rest else F.lit(0).cast("bigint")


def _key(stored: DataFrame, order: list[str]) -> Column:
    row = stored.metadataColumn("_metadata")
    parts = [column(c).alias(f"k{i}") for i, c in enumerate(order)]
    return F.struct(*parts, _tie(stored, order).alias("tie"), row["file_name"].alias("file"), row["row_index"].alias("place"))


def _with_range(keyed: DataFrame, bounds: DataFrame, most: int) -> DataFrame:
    """Add `__range`: how many of the sorted bounds are not above the key, found by halving.

    Each step is a projection of its own, as its result is used twice in the next.
    """
    found = keyed.withColumn("__range", F.lit(0))
    step = 1 << max(most.bit_length() - 1, 0)
    while step:
        # Beyond the last bound there is null, which is no bound.
        passed = F.coalesce(F.get(bounds.scalar(), F.col("__range") + (step - 1)) <= F.col(KEY), F.lit(False))
        found = found.withColumn("__range", F.col("__range") + F.when(passed, step).otherwise(0))
        step //= 2
    return found


def _holds_map(dtype: T.DataType) -> bool:
    """Maps (also nested) can neither be hashed nor compared."""
    if isinstance(dtype, T.StructType):
        return any(_holds_map(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _holds_map(dtype.elementType)
    return isinstance(dtype, (T.MapType, T.VariantType))
