"""One query per operator over the given tables; each takes (spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from washline.catalog.dirty import dirty_transactions, table
from washline.functions import (
    add,
    divide,
    hour_of,
    modulo,
    multiply,
    null_if_token,
    round_half_even,
    sha256_hex,
)
from washline.functions.fixed_values import MISSING_TEXT
from washline.operators import (
    apply_types,
    change_branches,
    count_losses,
    digits_only,
    hour_parity_rules,
    losses_of,
    merge_branches,
    normalize_nulls,
    parse_currency,
    profile_types,
    route,
    row_checksum,
    strip_specials,
    take_branch,
    to_bigint,
    to_double,
    to_text,
    to_timestamp_fmt,
    trim_strings,
    with_row_index,
)
from washline.plans import (
    clean_store_transactions,
    land_and_verify,
    publish_clean,
    publish_raw,
    update_profile,
)
from washline.sinks import preview, write_branches, write_object_csv, write_table
from washline.sources import (
    file_checksums,
    list_files,
    probe_source,
    read_csv_table,
    read_object_csv,
)
from washline.sources.files import land_files, landed_chunks, restore_files
from washline.staging import remove_staged, staging_path
from washline.streaming import ingest_stream, read_profile

Query = Callable[[SparkSession, str], DataFrame]


def store_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_store_transactions(dirty_transactions(spark, sf_dir))


def store_transactions_keep_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_store_transactions(
        dirty_transactions(spark, sf_dir), parity=False, mode="coerce"
    )


# --- text and money ---------------------------------------------------------------------------


def specials(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_orderpriority").alias("packed"),
        F.col("o_orderpriority").alias("spaced"),
    )
    return strip_specials(strip_specials(df, "packed"), "spaced", keep_space=True)


def specials_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "documents").select("doc_id", "text")
    return strip_specials(df, "text", keep_space=True).select(
        "doc_id", sha256_hex(F.col("text")).alias("text_sha256"), F.length("text").alias("n_kept")
    )


def customer_digits(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("number"))
    return to_bigint(digits_only(df, "number"), "number")


def page_digits(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("digits"))
    return to_bigint(digits_only(df, "digits").withColumn("number", F.col("digits")), "number")


def currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    net = F.format_number(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4)
    df = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.concat(F.lit("$"), net).alias("net")
    )
    return parse_currency(df, "net")


def half_even(spark: SparkSession, sf_dir: str) -> DataFrame:
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        round_half_even(net, 2).alias("cents"),
        round_half_even(F.col("l_quantity") / 2, 0).alias("halves"),
    )


def trimmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = F.concat(F.lit(" \t　 "), F.col("text"), F.lit(" \x1c\r\n "))
    df = table(spark, sf_dir, "documents").select("doc_id", padded.alias("text"), "source")
    return trim_strings(df).select(
        "doc_id",
        "source",
        sha256_hex(F.col("text")).alias("text_sha256"),
        F.length("text").alias("n_kept"),
    )


# --- conversions ------------------------------------------------------------------------------


def text_with_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "events").select(
        "event_id",
        F.nullif("event_type", F.lit("error")).alias("event_type"),
        F.col("user_id").alias("user_text"),
    )
    return to_text(df, ["event_type", "user_text"], MISSING_TEXT)


def doubles(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.concat(F.lit(" "), F.col("o_totalprice").cast("string"), F.lit("\t")).alias("price"),
        F.col("o_orderpriority").alias("priority"),
    )
    return to_double(to_double(df, "price"), "priority", mode="coerce")


def dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    short = F.date_format("o_orderdate", "yyyy-M-d")
    df = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 13 == 0, "").otherwise(short).alias("day"),
        F.when(F.col("o_orderkey") % 11 == 0, "2019-02-30").otherwise(short).alias("checked"),
        F.col("o_orderdate").cast("string").alias("stamp"),
    )
    df = to_timestamp_fmt(to_timestamp_fmt(df, "day"), "checked", mode="coerce")
    return to_timestamp_fmt(df, "stamp", fmt="yyyy-MM-dd HH:mm:ss")


def counted_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a conversion of all orders loses per column, counted while it is written."""
    key = F.col("o_orderkey")
    short = F.date_format("o_orderdate", "yyyy-M-d")
    df = table(spark, sf_dir, "orders").select(
        F.when(key % 11 == 0, "2019-02-30").when(key % 13 != 0, short).alias("day"),
        F.when(key % 5 == 0, "1_000").otherwise(key.cast("string")).alias("number"),
        F.when(key % 3 == 0, F.col("o_orderpriority")).otherwise(F.col("o_totalprice").cast("string")).alias("price"),
    )

    def convert(rows: DataFrame) -> DataFrame:
        rows = to_bigint(to_timestamp_fmt(rows, "day", mode="coerce"), "number")
        return to_double(rows, "price", mode="coerce")

    converted, seen = count_losses(df, ["day", "number", "price"], convert)
    write_table(converted, staging_path(spark, "converted"))
    found = [(c, given, lost) for c, (given, lost) in losses_of(seen).items()]
    return spark.createDataFrame(found, "column string, given bigint, lost bigint")


def missing_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("event_id")
    mixed = (
        F.when(key % 7 == 0, "NA")
        .when(key % 7 == 1, "null")
        .when(key % 7 == 2, "<NA>")
        .when(key % 7 == 3, " NA ")
        .when(key % 7 == 4, "")
        .otherwise(F.col("event_type"))
    )
    df = table(spark, sf_dir, "events").select("event_id", mixed.alias("event_type"))
    return normalize_nulls(df)


# --- arithmetic and routing -------------------------------------------------------------------


def arithmetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    line, part = F.col("l_linenumber"), F.col("l_partkey")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        add(line, part).alias("total"),
        multiply(line, part).alias("product"),
        divide(part, line).alias("ratio"),
        divide(line, part, mode="coerce").alias("ratio_or_null"),
        add(F.col("l_tax"), F.col("l_quantity")).alias("fraction_total"),
        multiply(F.col("l_quantity"), F.col("l_extendedprice")).alias("fraction_product"),
    )


def hour_and_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    hour = hour_of(F.col("ts"))
    return table(spark, sf_dir, "events").select(
        "event_id", hour.alias("hour"), modulo(hour, 2).alias("parity")
    )


def _timed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events, with the time missing in the error events."""
    known = F.when(F.col("event_type") != "error", F.col("ts"))
    return table(spark, sf_dir, "events").select("event_id", known.alias("ts"))


def routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route(_timed_events(spark, sf_dir), *hour_parity_rules("ts"))


def routed_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "events").select("event_id", "ts")
    return route(df, *hour_parity_rules("ts", literal=True))


def routed_all_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "events").select("event_id", "value")
    rules = {"positive": F.col("value") > 0, "large": F.col("value") > 50}
    return route(df, rules, ["rest"], first_match=False)


def one_branch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return take_branch(routed(spark, sf_dir), "odd_hour")


def merged_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Branches that are tables of their own, each read once."""
    parts, orders = table(spark, sf_dir, "part"), table(spark, sf_dir, "orders")
    return merge_branches(
        {
            "part": parts.select(F.col("p_partkey").alias("key"), F.col("p_retailprice").alias("price")),
            "order": orders.select(F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("price")),
        }
    )


def whole_fractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole numbers held as doubles, cleaned as text."""
    df = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("digits"), F.col("l_quantity").alias("code")
    )
    return strip_specials(digits_only(df, "digits"), "code")


def changed_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    hour = hour_of(F.col("ts"))
    changes = {
        "even_hour": {"half": (hour / 2).cast("int")},
        "odd_hour": {"half": ((hour - 1) / 2).cast("int"), "event_id": -F.col("event_id")},
    }
    return change_branches(routed(spark, sf_dir), changes)


def written_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All branches written in one pass and read back; one of them is chosen by no row."""
    names = ["even_hour", "odd_hour", "none_hour", "no_such_hour"]
    return merge_branches(write_branches(routed(spark, sf_dir), staging_path(spark, "branches"), names))


# --- index, checksums, preview, profile -------------------------------------------------------


def row_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_row_index(table(spark, sf_dir, "events"), ["ts", "event_id"])


def checksums(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "documents").select("doc_id", "text")
    return row_checksum(df, "text").drop("text")


def page_checksums(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return row_checksum(df, ["url", "html"]).drop("url", "html")


def first_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(table(spark, sf_dir, "orders"), order_by="o_orderkey")


def _texts(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def type_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _texts(table(spark, sf_dir, "lineitem"))
    return profile_types(
        lines.withColumn("is_returned", F.initcap((F.col("l_returnflag") == "R").cast("string")))
        .withColumn("gaps", null_if_token(F.col("l_linenumber"), ["1", "2"]))
        .withColumn("nothing", F.nullif("l_tax", "l_tax"))
    )


def typed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = _texts(table(spark, sf_dir, "part"))
    return apply_types(texts, profile_types(texts))


# --- CSV objects and tables -------------------------------------------------------------------


def _bucket(spark: SparkSession) -> tuple[str, str]:
    """Root and an unused bucket name below the shared staging folder."""
    path = staging_path(spark, "objects")
    return tuple(path.rsplit("/", 1))


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    root, bucket = _bucket(spark)
    write_object_csv(orders, root, bucket, "raw/orders.csv")
    typed = read_object_csv(spark, root, bucket, "raw/orders.csv")
    return typed.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))


def csv_round_trip_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    root, bucket = _bucket(spark)
    write_object_csv(documents, root, bucket, "documents.csv", max_records_per_file=100_000)
    # Texts with line breaks; every text is kept as it is, also one that reads like a token.
    back = read_object_csv(
        spark, root, bucket, "documents.csv", typed=False, na_tokens=(), multiline=True, line_sep="\n"
    )
    return to_bigint(back, ["doc_id", "n_chars"], mode="raise")


def chosen_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, bucket = _bucket(spark)
    write_object_csv(table(spark, sf_dir, "orders"), root, bucket, "orders.csv", sep=";")
    return read_object_csv(
        spark,
        root,
        bucket,
        "orders.csv",
        sep=";",
        columns=["o_totalprice", "o_orderkey", "o_orderpriority"],
        key_column="o_totalprice",
    )


def repeated_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file whose header names one column twice: key, name and the nation under the key's name."""
    path = staging_path(spark, "repeated-header")
    line = F.to_csv(F.struct("c_custkey", "c_name", "c_nationkey"))
    lines = table(spark, sf_dir, "customer").select(line.alias("c_custkey,c_name,c_custkey"))
    # One unquoted column, so its name becomes the header line as it is.
    lines.write.options(header="true", sep="\x01", quote="\x00").csv(path)
    return read_csv_table(spark, path).withColumnRenamed("c_custkey.1", "second_custkey")


def replaced_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    path = staging_path(spark, "orders-table")
    write_table(orders.select("o_orderkey"), path)
    return write_table(orders, path)


def raw_publication(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, bucket = _bucket(spark)
    source = write_object_csv(table(spark, sf_dir, "part"), root, bucket, "source/part.csv")
    target = staging_path(spark, "part-table")
    publish_raw(
        spark,
        source,
        root,
        bucket,
        "raw/part.csv",
        publish=lambda df: write_table(df, target, index_by="p_partkey"),
        order_by="p_partkey",
    )
    return spark.read.parquet(target)


def clean_publication(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, bucket = _bucket(spark)
    dirty = dirty_transactions(spark, sf_dir)
    source = write_object_csv(dirty, root, bucket, "source/dirty.csv", compression="gzip")
    target = staging_path(spark, "clean-table")

    def publish(df: DataFrame) -> None:
        remove_staged(spark, source)
        order = ["l_orderkey", "l_linenumber", "SP", "MRP", "STORE_ID", "Date"]
        write_table(df, target, index_by=order, compression="zstd")

    publish_clean(spark, source, root, bucket, "raw/dirty.csv", publish=publish, compression="gzip")
    return spark.read.parquet(target)


def grown_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile of a folder that grew between two updates."""
    root, bucket = _bucket(spark)
    lines, store = table(spark, sf_dir, "lineitem"), f"{root}/{bucket}/profile"
    folder = f"{root}/{bucket}/lines"
    for half in (0, 1):
        write_object_csv(lines.where(F.col("l_orderkey") % 2 == half), root, bucket, f"lines/half={half}")
        found = update_profile(spark, f"{folder}/*", store)
    return found


# --- streams ----------------------------------------------------------------------------------


def _streamed(
    spark: SparkSession,
    df: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    profile: bool = False,
) -> DataFrame:
    """Land `df` as CSV files, let a stream take in all of them, return what it wrote, or its profile."""
    root, bucket = _bucket(spark)
    landing = write_object_csv(df, root, bucket, "landing")
    sink = f"{root}/{bucket}/sink"
    query = ingest_stream(
        spark, landing, df.columns, transform, sink, f"{root}/{bucket}/checkpoint", profile=profile
    )
    query.awaitTermination()
    if profile:
        return read_profile(spark, sink)
    return spark.read.parquet(sink).drop("run", "batch_id")


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    def typed(df: DataFrame) -> DataFrame:
        df = to_bigint(df, ["o_orderkey", "o_custkey"], mode="raise")
        df = to_double(df, "o_totalprice")
        return to_timestamp_fmt(df, "o_orderdate", fmt="yyyy-MM-dd HH:mm:ss.SSSSSS")

    return _streamed(spark, table(spark, sf_dir, "orders"), typed)


def stream_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    def clean(df: DataFrame) -> DataFrame:
        return clean_store_transactions(to_bigint(df, ["l_orderkey", "l_linenumber"], "raise"))

    return _streamed(spark, dirty_transactions(spark, sf_dir), clean)


def stream_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, table(spark, sf_dir, "lineitem"), lambda df: df, profile=True)


# --- files ------------------------------------------------------------------------------------


def _page_files(spark: SparkSession, sf_dir: str) -> str:
    """A folder with a file for each page."""
    folder = staging_path(spark, "pages")
    pages = table(spark, sf_dir, "pages").select(
        F.concat("page_id", F.lit(".html")).alias("path"),
        F.lit(0).cast("bigint").alias("number"),
        F.coalesce("html", F.lit("")).cast("binary").alias("content"),
    )
    restore_files(pages, folder).write.format("noop").mode("overwrite").save()
    return folder


def _file_name() -> Column:
    return F.substring_index("path", "/", -1).alias("name")


def file_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return list_files(spark, _page_files(spark, sf_dir), recursive=True).select(_file_name(), "length")


def file_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = file_checksums(spark, _page_files(spark, sf_dir))
    return found.select(_file_name(), "length", "sha256")


def probed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = probe_source(spark, [_page_files(spark, sf_dir)], encoding="utf-8")
    return found.select(F.substring_index("file", "/", -1).alias("name"), "length", "status")


SMALL_CHUNK = 4096  # so that most pages have several


def files_in_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = staging_path(spark, "landing")
    files = land_files(spark, _page_files(spark, sf_dir), landing, chunk=SMALL_CHUNK)
    chunks = landed_chunks(spark, landing).groupBy("path")
    counted = chunks.agg(
        F.count("*").alias("chunks"), F.sum(F.octet_length("content")).alias("landed_bytes")
    )
    return files.join(counted, "path", "left").select(
        _file_name(),
        "length",
        "sha256",
        F.coalesce("chunks", F.lit(0)).alias("chunks"),
        F.coalesce("landed_bytes", F.lit(0)).alias("landed_bytes"),
    )


def verified_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, landing = _page_files(spark, sf_dir), staging_path(spark, "landing")
    found = land_and_verify(spark, pages, landing, rehash_source=True, chunk=SMALL_CHUNK)
    return found.select(_file_name(), "length", "sha256", "ok")


def queries() -> dict[str, Query]:
    return {
        "clean_store_transactions": store_transactions,
        "clean_store_transactions_keep_nulls": store_transactions_keep_nulls,
        "strip_specials": specials,
        "strip_specials_text": specials_text,
        "digits_to_bigint": customer_digits,
        "digits_to_bigint_pages": page_digits,
        "clean_whole_fractions": whole_fractions,
        "parse_currency": currency,
        "round_half_even": half_even,
        "trim_strings": trimmed,
        "to_text_null_token": text_with_token,
        "to_double": doubles,
        "to_timestamp_fmt": dates,
        "count_losses": counted_losses,
        "normalize_nulls": missing_values,
        "arithmetic": arithmetic,
        "hour_and_parity": hour_and_parity,
        "route_hour_parity": routed,
        "route_hour_literal": routed_literal,
        "route_all_matches": routed_all_matches,
        "take_branch": one_branch,
        "merge_branches": merged_branches,
        "change_branches": changed_branches,
        "write_branches": written_branches,
        "row_index": row_index,
        "row_checksum": checksums,
        "row_checksum_pages": page_checksums,
        "preview": first_orders,
        "profile_types": type_profile,
        "apply_types": typed_columns,
        "csv_round_trip": csv_round_trip,
        "csv_round_trip_text": csv_round_trip_text,
        "usecols_sep_key": chosen_columns,
        "dedupe_header": repeated_header,
        "write_table": replaced_table,
        "publish_raw": raw_publication,
        "publish_clean": clean_publication,
        "stream_ingest": stream_ingest,
        "update_profile": grown_profile,
        "stream_clean": stream_clean,
        "stream_profile": stream_types,
        "list_files": file_list,
        "file_checksums": file_hashes,
        "probe_source": probed_files,
        "land_files": files_in_chunks,
        "land_and_verify": verified_landing,
    }
