"""Whitespace helpers."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Unicode counts as white space; Spark's own trim removes blanks only.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WHITESPACE_CLASS = f"[{WHITESPACE}]"


def strip(c: Column) -> Column:
    """Remove white space of any kind from both ends."""
    return F.btrim(c, F.lit(WHITESPACE))


def text_or_empty(c: Column) -> Column:
    """The value as text, with '' for null."""
    return F.coalesce(c.cast("string"), F.lit(""))
