"""Words as the operators count them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A word: a run of characters that are neither space nor \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """Number of words of the whole text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def words(text: Column) -> Column:
    """Array of the words of the whole text; empty for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def utf8_crc32(text: Column) -> Column:
    """Unsigned CRC-32 of the UTF-8 bytes."""
    return F.crc32(text.cast("binary"))
