"""Fixed values that decide results: they must equal what CSV users already rely on."""

# CSV field texts that mean "missing" (exact match, no trimming).
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Texts that a date column reads as "no date".
NO_DATE_TOKENS = ("", "NaT", "nat", "NAT", "nan", "NaN", "NAN")

# Texts that a CSV column of booleans may hold.
TRUE_TOKENS = ("True", "TRUE", "true")
FALSE_TOKENS = ("False", "FALSE", "false")

# The 29 characters that count as white space at the ends of a text.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Characters removed from money texts.
CURRENCY_MARKS = "$,"

# The text a missing value turns into when a column is cast to text.
MISSING_TEXT = "nan"
