"""Store transactions as they arrive: every line item turned into a row of messy text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dirty_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    price, discount, tax = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")

    def dollars(amount, decimals):
        return F.concat(F.lit("$"), F.format_number(amount, decimals))

    def between(first, second, before, separator, after):
        return F.concat(F.lit(before), first, F.lit(separator), second, F.lit(after))

    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_suppkey") % 29 != 0, F.concat(F.lit("ST-"), "l_suppkey", F.lit("#"))).alias(
            "STORE_ID"
        ),
        between(flag, status, " Dock ", "/", "! ").alias("STORE_LOCATION"),
        between(flag, status, "  ", "&", " ").alias("PRODUCT_CATEGORY"),
        F.when(F.col("l_partkey") % 17 == 0, "n/a")
        .otherwise(F.concat(F.lit("P"), "l_partkey", F.lit("?")))
        .alias("PRODUCT_ID"),
        dollars(price, 2).alias("MRP"),
        dollars(price * (1 - discount), 4).alias("CP"),
        dollars(price * discount, 4).alias("DISCOUNT"),
        dollars(price * (1 - discount) * (1 + tax), 4).alias("SP"),
        F.concat(F.lit(" "), F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit(" ")).alias("Date"),
    )


# The same rows in DuckDB's SQL.
DIRTY_SQL = """
    select l_orderkey, l_linenumber,
           case when l_suppkey % 29 <> 0 then 'ST-' || l_suppkey || '#' end as "STORE_ID",
           ' Dock ' || l_returnflag || '/' || l_linestatus || '! ' as "STORE_LOCATION",
           '  ' || l_returnflag || '&' || l_linestatus || ' ' as "PRODUCT_CATEGORY",
           case when l_partkey % 17 = 0 then 'n/a' else 'P' || l_partkey || '?' end
               as "PRODUCT_ID",
           '$' || format('{:,.2f}', l_extendedprice) as "MRP",
           '$' || format('{:,.4f}', l_extendedprice * (1 - l_discount)) as "CP",
           '$' || format('{:,.4f}', l_extendedprice * l_discount) as "DISCOUNT",
           '$' || format('{:,.4f}', l_extendedprice * (1 - l_discount) * (1 + l_tax)) as "SP",
           ' ' || strftime(l_shipdate, '%Y-%m-%d') || ' ' as "Date"
    from lineitem
"""
