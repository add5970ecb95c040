"""Headered delimited files as DataFrames.

Files are read splittable by default, so one file holding most of the data still spreads over
many tasks.  What such a read cannot get right it refuses: rows with surplus fields and line
breaks inside quotes raise an error instead of shifting values.  Rows with too few fields end
in nulls.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.readwriter import DataFrameReader
from pyspark.sql.streaming.readwriter import DataStreamReader

from washline.functions.fixed_values import NA_TOKENS
from washline.names import column
from washline.operators.missing import normalize_nulls
from washline.operators.profile import apply_types, profile_types
from washline.staging import staging_path

SURPLUS = "__surplus"
LINE = "__line"
FILE = "__file"
ORDER = "__order"
END_MARK = "\x01end\x01"
PERMISSIVE, FAILFAST = "PERMISSIVE", "FAILFAST"
REPLACED = "\ufffd"  # what the decoder puts in the place of bytes it cannot read


def spark_sep(sep: str) -> str:
    """A separator as Spark's option wants it, where a backslash starts an escape."""
    return sep.replace("\\", "\\\\")


def csv_options(
    sep: str, multiline: bool, line_sep: str | None, encoding: str = "UTF-8"
) -> dict[str, str]:
    options = {
        "encoding": encoding,
        "sep": spark_sep(sep),
        "quote": '"',
        "escape": '"',
        "multiLine": str(multiline).lower(),
    }
    if line_sep is not None:
        options["lineSep"] = line_sep
    return options


def dedupe_header(names: Iterable[str | None], case_sensitive: bool = True) -> list[str]:
    """Unique column names: a repeated `a` becomes `a.1`, a blank one `Unnamed: <position>`.

    Names that stand in the header as they are keep precedence over made-up ones.  With
    `case_sensitive=False`, `a` and `A` count as repeated too, as Spark could not tell them apart.
    """
    fold = (lambda s: s) if case_sensitive else str.lower
    given = [name if name else f"Unnamed: {i}" for i, name in enumerate(names)]
    taken = {fold(name) for name in given}
    first_seen: set[str] = set()
    unique = []
    for name in given:
        candidate = name
        if fold(name) in first_seen:
            number = 1
            while fold(candidate := f"{name}.{number}") in taken:
                number += 1
            taken.add(fold(candidate))
        first_seen.add(fold(name))
        unique.append(candidate)
    return unique


def read_header(spark: SparkSession, path: str, options: Mapping[str, str]) -> list[str]:
    """Column names from the first line of the first file; reads that line only."""
    first = spark.read.options(**options).option("header", False).csv(path).first()
    if first is None:
        raise ValueError(f"no header line in {path}")
    case_sensitive = spark.conf.get("spark.sql.caseSensitive", "false").lower() == "true"
    return dedupe_header(first, case_sensitive)


def read_first_line(spark: SparkSession, path: str) -> str:
    """The first line of the first file up to its line feed."""
    first = spark.read.option("lineSep", "\n").text(path).first()
    return first["value"] if first is not None else ""


def as_path(url: str) -> str:
    """A file's URL as a path for Spark's readers, which take some characters for patterns."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", unquote(url))


def file_headers(
    spark: SparkSession, paths: str | list[str], encoding: str = "UTF-8"
) -> DataFrame:
    """file and header: each file's first line that is not blank.

    One pass over the files as text and one aggregation with a row per file, for which tasks sort the lines by
    file.  Files without such a line have no row.
    """
    found = _numbered_lines(spark, paths).groupBy("file").agg(F.min_by("line", "place").alias("header"))
    header = F.rtrim(F.decode(F.col("header").cast("binary"), encoding), F.lit("\r"))
    return found.select("file", header.alias("header"))


def _numbered_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """file, line, place: the lines that are not blank; the least place is of the file's first."""
    text = spark.read.option("lineSep", "\n").text(paths)
    rows = text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").alias("line"),
    ).where(F.btrim("line", F.lit(" \t\r")) != "")
    # Within a task rows keep their order; the first block of a file is read by one task.
    place = F.when(F.col("block") == 0, F.monotonically_increasing_id())
    return rows.withColumn("place", place)


def all_begin_with(spark: SparkSession, paths: str | list[str], line: str) -> bool:
    """Whether this is the first line that is not blank in every file that has one.

    One pass over the files as text; only numbers are aggregated, so no line is sorted or spilled.
    """
    place = F.col("place")
    same = F.min(F.when(F.col("line") == line, place)) == F.min(place)
    files = _numbered_lines(spark, paths).groupBy("file").agg(F.coalesce(same, F.lit(False)).alias("same"))
    return files.where(~F.col("same")).isEmpty()


def count_rows(spark: SparkSession, paths: str | list[str], options: Mapping[str, str]) -> DataFrame:
    """file and rows: how many rows `read_lines_checked` finds in each file that has any.

    The same reader, asked for no column; so it finds the rows' ends only, and their fields are not parsed.
    """
    reader = spark.read.schema("value string").options(**options).options(header="true", columnPruning="true")
    return reader.csv(paths).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("rows"))


#: Distinct headers of one table, and files with another order of columns that are broadcast.
MOST_HEADERS, MOST_BROADCAST = 1000, 200_000


def header_orders(
    spark: SparkSession,
    headers: DataFrame,
    names: list[str],
    options: Mapping[str, str],
) -> tuple[DataFrame | None, list[list[int]]]:
    """Which files have the columns in another order than `names`, and these orders.

    Returns (file, order) of such files, or None, and per order the place of each name in it.  A file with
    other names, more or fewer of them, or whose first line is a data row is an error.
    """
    kinds = headers.groupBy("header").agg(F.min("file").alias("file")).orderBy("file")
    schema = ", ".join(f"c{i} string" for i in range(len(names) + 1))
    fields = F.from_csv("header", schema, dict(options)).alias("fields")
    # A line per distinct header; files without one show up as having another.
    found = kinds.limit(MOST_HEADERS + 1).select("header", "file", fields).collect()
    case_sensitive = spark.conf.get("spark.sql.caseSensitive", "false").lower() == "true"
    orders: list[list[int]] = []
    known = []
    for row in found:
        *own, surplus = row["fields"]
        own = dedupe_header(own, case_sensitive)
        if own == names and surplus is None:
            continue
        if sorted(own) != sorted(names) or surplus is not None:
            raise ValueError(f"header of {row['file']} is {row['header']!r}, not {names} in some order")
        orders.append([own.index(n) for n in names])
        known.append((row["header"], len(orders) - 1))
    if len(found) > MOST_HEADERS:
        raise ValueError(f"more than {MOST_HEADERS} different headers")
    if not orders:
        return None, []
    table = spark.createDataFrame(known, "header string, order int")
    path = staging_path(spark, "other-headers")
    headers.join(F.broadcast(table), "header").select("file", "order").write.parquet(path)
    moved = spark.read.schema("file string, order int").parquet(path)
    # Rows are not shuffled for the sake of a few files.
    return (F.broadcast(moved) if moved.count() <= MOST_BROADCAST else moved), orders


def _plain_row(sep: str, width: int) -> str:
    """Pattern of a row of at most `width` fields, each quoted as a whole or free of quotes.

    Nearly all rows are of this kind, and one match without backtracking clears them, also of characters
    that the decoder could not read.
    """
    field = rf'(?:(?:"[^"{REPLACED}]*+")++|[^"{REPLACED}{re.escape(sep)}]*+)'
    return rf"^{field}(?:{re.escape(sep)}{field}){{0,{width - 1}}}+\z"


def _quotes(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))


def _breaks_in_quotes(line: Column, sep: str) -> Column:
    """Whether a field opens a quote that the line does not close."""
    return (_quotes(line) % 2 == 1) & line.rlike("(^|" + re.escape(sep) + ')"')


def _too_wide(line: Column, width: int, sep: str, options: Mapping[str, str]) -> Column:
    """Whether a row has more than `width` fields.

    Without quotes the separators tell the width; with quotes they only bound it.  The rare row
    above the bound is parsed again: a mark put at its end must show up within the first fields.
    """
    separators = (F.length(line) - F.length(F.replace(line, F.lit(sep), F.lit("")))) / len(sep)
    schema = ", ".join(f"c{i} string" for i in range(width + 1))
    parsed = F.from_csv(F.concat(line, F.lit(sep + END_MARK)), schema, dict(options))
    return (
        F.when(line.isNull() | F.col(SURPLUS).isNotNull(), True)
        .when(separators < width, False)
        .when(_quotes(line) == 0, True)
        .otherwise(~parsed.cast("string").contains(END_MARK))
    )


def read_lines_checked(
    reader: DataFrameReader | DataStreamReader,
    path: str | list[str],
    names: list[str],
    sep: str,
    options: Mapping[str, str],
    moved: DataFrame | None = None,
    orders: list[list[int]] | None = None,
    with_file: str | None = None,
    unchecked: str | None = None,
) -> DataFrame:
    """All columns as text, with the row checks; the same for batch and stream readers.

    Rows of the files in `moved` (see `header_orders`) have their fields put in the order of `names`;
    `with_file` names one more column, of the row's file.

    The schema has one more text column than the header.  That makes a row of the right width
    "malformed" to the parser, which then hands over the row's own text for the checks below;
    only a row with exactly one surplus field comes without.

    With `unchecked`, a mode of Spark's parser, the rows are taken as that finds them (see `read_csv_table`).
    """
    width = len(names)
    where = path if isinstance(path, str) else f"{len(path)} files"
    if unchecked:
        texts = T.StructType([T.StructField(n, T.StringType()) for n in names])
        # To know a row's width, the parser has to look at all its fields.
        pruned = str(unchecked != FAILFAST).lower()
        plain = reader.schema(texts).options(**options).options(header="true", mode=unchecked, columnPruning=pruned).csv(path)
        return _placed(plain, names, moved, orders, with_file)
    fields = [T.StructField(n, T.StringType()) for n in (*names, SURPLUS, LINE)]
    raw = (
        reader.schema(T.StructType(fields))
        .options(**options)
        .options(header="true", mode="PERMISSIVE", columnNameOfCorruptRecord=LINE)
        .option("columnPruning", "false")
        .csv(path)
    )
    line = F.col(LINE)
    plain = line.rlike(_plain_row(sep, width)) if len(sep) == 1 else F.lit(False)
    replaced = F.contains(F.coalesce(line, F.concat_ws(sep, *map(column, names))), F.lit(REPLACED))
    checked = (
        F.when(plain, True)
        .when(
            replaced,
            F.raise_error(F.lit(f"bytes that are no {options['encoding']} in {where}")).cast(
                "boolean"
            ),
        )
        .when(
            _breaks_in_quotes(line, sep) if options["multiLine"] != "true" else F.lit(False),
            F.raise_error(
                F.concat(F.lit("line break inside quotes, read with multiline=True: "), line)
            ).cast("boolean"),
        )
        .when(
            _too_wide(line, width, sep, options),
            F.raise_error(
                F.concat(
                    F.lit(f"more than {width} fields in row: "), F.coalesce(line, column(names[0]))
                )
            ).cast("boolean"),
        )
        .otherwise(True)
    )
    return _placed(raw.filter(checked), names, moved, orders, with_file)


def _placed(
    rows: DataFrame, names: list[str], moved: DataFrame | None, orders: list[list[int]] | None, with_file: str | None
) -> DataFrame:
    file = F.col("_metadata.file_path")
    if moved is not None:
        rows = in_order(rows.withColumn(FILE, file), moved, orders, names, FILE)
        file = F.col(FILE)
    return rows.select(*[column(n) for n in names], *([file.alias(with_file)] if with_file else []))


def in_order(
    rows: DataFrame, moved: DataFrame, orders: list[list[int]], names: list[str], file: str
) -> DataFrame:
    """Rows of the files in `moved` with their fields in the order of `names`; `file` is their file's column."""
    placed = rows.join(moved.select(F.col("file").alias(file), F.col("order").alias(ORDER)), file, "left")
    fields = []
    for i, name in enumerate(names):
        field = column(name)
        for number, order in enumerate(orders):
            if order[i] != i:
                field = F.when(F.col(ORDER) == number, column(names[order[i]])).otherwise(field)
        fields.append(field.alias(name))
    return placed.select(*fields, column(file))


#: Names of the columns, the parser's options, files with another order of columns, and these orders.
Layout = tuple[list[str], dict[str, str], DataFrame | None, list[list[int]]]


def csv_layout(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    multiline: bool = False,
    line_sep: str | None = None,
    encoding: str = "UTF-8",
    same_header: bool = False,
) -> Layout:
    """What the headers of a path say; arguments as in `read_csv_table`."""
    first_line = read_first_line(spark, path)
    if multiline and line_sep is None:
        # Left to itself the parser would turn line ends inside quotes into LF.
        line_sep = "\r\n" if first_line.endswith("\r") else "\n"
    if not multiline and first_line.count('"') % 2 == 1:
        raise ValueError(f"line break inside quotes in the header, read with multiline=True: {path}")
    options = csv_options(sep, multiline, line_sep, encoding)
    names = read_header(spark, path, options)
    moved, orders = None, []
    if not same_header and _several_files(spark, path):
        # Only files with different first lines, or headers of several lines, need a look at each header.
        if first_line.count('"') % 2 == 1 or not all_begin_with(spark, path, first_line):
            moved, orders = header_orders(spark, file_headers(spark, path, encoding), names, options)
    return names, options, moved, orders


def read_csv_table(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    columns: Iterable[str] | None = None,
    typed: bool = True,
    types: Mapping[str, str] | None = None,
    key_column: str | None = None,
    na_tokens: Iterable[str] = NA_TOKENS,
    multiline: bool = False,
    line_sep: str | None = None,
    encoding: str = "UTF-8",
    same_header: bool = False,
    unchecked: str | None = None,
    layout: Layout | None = None,
) -> DataFrame:
    """A headered CSV file, or a directory of files with the same columns.

    The first file's header names the columns.  Each other file's own header is read as well, in one
    more pass over the files as text, or two if headers differ: its columns may stand in another order, but a file with other
    names, fewer or more, or without a header is an error.

    columns     keep only these, in file order; an unknown name is an error
    typed       decide one type per whole column, which costs one more pass over the files;
                with False all columns are text
    types       column types known beforehand (from an earlier profile): no extra pass
    key_column  moved to the front
    na_tokens   field texts that mean "missing"; pass () to keep all texts
    multiline   allow line breaks inside quotes; each file is then read by one task
    line_sep    the exact line end; by default any in a split read, and the one of the first
                line in a multiline read
    same_header of all files, as their writer guarantees: spares the pass over their headers
    encoding    of the files; bytes that it cannot hold, or a replacement character in the
                text, are an error
    unchecked   no row checks, for files whose rows are known to be right: because `write_object_csv` wrote
                them and no text holds a line end (FAILFAST: still, other widths are an error), or because
                the same files are read with checks before the result is used (PERMISSIVE)
    layout      the path's `csv_layout`, where it is read more than once
    """
    names, options, moved, orders = layout or csv_layout(spark, path, sep, multiline, line_sep, encoding, same_header)
    df = read_lines_checked(spark.read, path, names, sep, options, moved, orders, unchecked=unchecked)
    if columns is not None:
        wanted = list(columns)
        unknown = [c for c in wanted if c not in names]
        if unknown:
            raise ValueError(f"no such columns in {path}: {unknown}")
        df = df.select(*[column(c) for c in names if c in wanted])
    if key_column is not None:
        if key_column not in df.columns:
            raise ValueError(f"no such key column in {path}: {key_column}")
        df = df.select(column(key_column), *[column(c) for c in df.columns if c != key_column])
    tokens = tuple(na_tokens)
    if tokens:
        df = normalize_nulls(df, tokens)
    if types is not None:
        return apply_types(df, {c: t for c, t in types.items() if c in df.columns})
    return apply_types(df, profile_types(df)) if typed else df


def _several_files(spark: SparkSession, path: str) -> bool:
    """Spark's listing holds a path's files in any case."""
    return spark.read.text(path)._jdf.inputFiles().__len__() > 1


def object_path(root: str, bucket: str, key: str) -> str:
    """Location of an object: root is `s3a:/` for an object store, or a shared directory."""
    return f"{root}/{bucket}/{key}"


def read_object_csv(
    spark: SparkSession, root: str, bucket: str, key: str, sep: str = ",", **how
) -> DataFrame:
    """`read_csv_table` of the object under bucket and key."""
    return read_csv_table(spark, object_path(root, bucket, key), sep=sep, **how)
