"""Cleaning of store transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from washline.functions.fixed_values import MISSING_TEXT
from washline.names import column, string_columns
from washline.operators.clean import digits_only, parse_currency, strip_specials, trim_strings
from washline.operators.convert import to_bigint, to_double, to_text, to_timestamp_fmt

# The columns of a store transaction.
CODE = "STORE_ID"
NAMES = ["STORE_LOCATION", "PRODUCT_CATEGORY"]
PRODUCT = "PRODUCT_ID"
MONEY = ["MRP", "CP", "DISCOUNT", "SP"]
DAY = "Date"
COLUMNS = [CODE, *NAMES, PRODUCT, *MONEY, DAY]


def clean_store_transactions(
    df: DataFrame, parity: bool = True, mode: str = "raise"
) -> DataFrame:
    """Clean and type the columns of a store transaction; other text columns are trimmed.

    The row count never changes and nothing shuffles.  Unreadable money and dates are errors
    (`mode='coerce'`: null); an unreadable product number is null.  With `parity` missing codes
    and names become the text `nan`, otherwise they stay null.
    """
    df = strip_specials(df, CODE)
    df = strip_specials(df, NAMES, keep_space=True)
    df = digits_only(df, PRODUCT)
    df = parse_currency(df, MONEY, mode=mode)
    # By now the code and the product number hold no white space and the names only plain spaces,
    # which the plain trim removes faster.
    df = df.withColumns({c: F.trim(column(c)) for c in NAMES})
    df = trim_strings(df, [c for c in string_columns(df) if c not in (CODE, PRODUCT, *NAMES)])
    df = to_text(df, [CODE, *NAMES], MISSING_TEXT if parity else None)
    df = to_bigint(df, PRODUCT)
    df = to_double(df, MONEY)
    return to_timestamp_fmt(df, DAY, mode=mode)
