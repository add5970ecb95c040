"""Source CSV to stored CSV to table, raw or cleaned.

The stored CSV is the hand-over point: the table is built from it alone, so a failed second
half can be run again without the source.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from washline.names import column
from washline.operators.profile import apply_types, inferred_types, profile_types
from washline.plans.store_transactions import COLUMNS, clean_store_transactions
from washline.sinks.csv import ROWS_PER_UNSPLITTABLE_FILE, write_object_csv
from washline.sinks.preview import preview
from washline.sources.csv import FAILFAST, PERMISSIVE, csv_layout, read_csv_table, read_object_csv

LAYOUT = ("sep", "multiline", "line_sep", "encoding", "same_header")


def store_csv(
    spark: SparkSession,
    src: str,
    root: str,
    bucket: str,
    key: str,
    keep_text: Iterable[str] = (),
    compression: str | None = None,
    **how,
) -> dict[str, str]:
    """Parse the source, store its values as CSV, return the types found.

    The rows are checked as they are stored; the look at their types before parses only what it needs.

    Columns in `keep_text` are stored as they are.  The types are decided once, here, and handed
    on: the stored values are the typed ones, so a second look would find the same.  With a
    `compression`, such as gzip, the stored files have it.
    """
    layout = csv_layout(spark, src, **{k: v for k, v in how.items() if k in LAYOUT})
    text = read_csv_table(spark, src, typed=False, layout=layout, **how)
    kept = set(keep_text)
    candidates = [c for c in text.columns if c not in kept]
    types = {c: "string" for c in text.columns}
    if candidates:
        unchecked = read_csv_table(spark, src, typed=False, unchecked=PERMISSIVE, layout=layout, **how)
        types |= inferred_types(profile_types(unchecked.select(*map(column, candidates))))
    # Files with line breaks in quotes cannot be split, so many of them keep readers parallel.
    per_file = ROWS_PER_UNSPLITTABLE_FILE if how.get("multiline") else 0
    write_object_csv(
        apply_types(text, types), root, bucket, key, max_records_per_file=per_file, compression=compression
    )
    return types


def publish_raw(
    spark: SparkSession,
    src: str,
    root: str,
    bucket: str,
    key: str,
    publish: Callable[[DataFrame], object],
    order_by: str | Iterable[str] | None = None,
    compression: str | None = None,
    **how,
) -> DataFrame:
    """Store a source CSV and publish it as a table; returns a preview of the stored rows.

    `publish` receives the stored table, for example
    `lambda df: write_table(df, path, index_by="id")` or one calling `write_table_jdbc`.
    """
    types = store_csv(spark, src, root, bucket, key, compression=compression, **how)
    stored = read_object_csv(spark, root, bucket, key, types=types, **_stored(how))
    publish(stored)
    return preview(stored, order_by=order_by)


def publish_clean(
    spark: SparkSession,
    src: str,
    root: str,
    bucket: str,
    key: str,
    publish: Callable[[DataFrame], object],
    order_by: str | Iterable[str] | None = None,
    parity: bool = True,
    compression: str | None = None,
    **how,
) -> DataFrame:
    """Store a source CSV of store transactions and publish it cleaned; returns a raw preview.

    When `publish` is called the stored copy is complete, and the source is not read again.
    """
    types = store_csv(spark, src, root, bucket, key, keep_text=COLUMNS, compression=compression, **how)
    stored = read_object_csv(spark, root, bucket, key, types=types, **_stored(how))
    publish(clean_store_transactions(stored, parity=parity))
    return preview(stored, order_by=order_by)


def _stored(how: dict) -> dict:
    """How to read back what `write_object_csv` wrote."""
    multiline = how.get("multiline", False)
    # Read line by line, no value holds the end of a line, so each stored line is a row of the right width.
    one_line = not multiline and how.get("line_sep") in (None, "\n")
    return {"line_sep": "\n", "multiline": multiline, "same_header": True, "unchecked": FAILFAST if one_line else None}
