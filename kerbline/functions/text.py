"""Text and number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that Unicode counts as whitespace.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
    "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
NUMBER = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def strip(column: str) -> Column:
    """Remove leading and trailing whitespace of any Unicode kind.

    Most values start and end with a visible ASCII character and skip the character-set trim.
    """
    value = F.col(column)
    clean = F.ascii(value).between(33, 126) & F.ascii(F.substring(value, -1, 1)).between(33, 126)
    return F.when(clean, value).otherwise(F.btrim(value, F.lit(WHITESPACE)))


def title(column: str) -> Column:
    """Strip and capitalise every run of letters; any other character starts a new run."""
    runs = F.regexp_extract_all(strip(column), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def number(column: str) -> Column:
    """Text to double; anything that is not a plain number becomes null."""
    text = F.col(column).cast("string")
    return F.when(text.rlike(NUMBER), F.trim(text).try_cast("double"))


def timestamp(column: str) -> Column:
    """Text to a zone-free timestamp; unreadable text becomes null."""
    return F.col(column).try_cast("timestamp_ntz")


def hour_range(hour: Column) -> Column:
    return F.format_string("%02d:00 to %02d:00", hour, (hour + 1) % 24)


def hour_mark(hour: Column) -> Column:
    return F.format_string("%02d:00", hour)
