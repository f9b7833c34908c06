"""Text clean-up as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The field texts a CSV reader of the pandas family takes as missing.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# The characters Python's str.strip() removes.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def na_to_null(column: Column) -> Column:
    """Null where the raw field text is one of the missing-value tokens."""
    return F.when(~column.isin(NA_TOKENS), column)


def clean_text(column: Column) -> Column:
    """Drop every double quote, then strip blanks from both ends."""
    return F.btrim(F.replace(column, F.lit('"'), F.lit("")), F.lit(BLANKS))


def to_number(column: Column) -> Column:
    """Double, or null where the text is no number."""
    return column.try_cast("double")


def to_date(column: Column) -> Column:
    """Date of a text YYYY-MM-DD or YYYY/MM/DD, a time of day after it or not; null for any other text."""
    whole = F.regexp_like(column, F.lit(r"^\d{4}([-/])\d{2}\1\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d+)?)?)?$"))
    return F.when(whole, F.translate(F.substring(column, 1, 10), "/", "-").try_cast("date"))
