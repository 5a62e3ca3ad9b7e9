"""Column functions of the domain: sample names, periods, hit strings, short names."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The names of dated samples, site, year, week and number; weeks run from 1 to 53.
DATED_SAMPLE = r"^(Ki|Lj)[-_](\d{4})[-_](\d{1,2})[-_](\d{1,3})$"
LAST_WEEK = 53
#: A pair of taxon and number of k-mers in a hit string; ambiguous stretches and mate borders don't match.
HIT = r"(\d+:\d+)"


def sample_name(path: Column) -> Column:
    """File name up to its first dot."""
    return F.substring_index(F.element_at(F.split(path, "/"), -1), ".", 1)


def sample_year(sample: Column) -> Column:
    return F.when(is_dated(sample), F.regexp_extract(sample, DATED_SAMPLE, 2).cast("int"))


def sample_week(sample: Column) -> Column:
    return F.when(is_dated(sample), F.regexp_extract(sample, DATED_SAMPLE, 3).cast("int"))


def is_dated(sample: Column) -> Column:
    week = F.try_to_number(F.regexp_extract(sample, DATED_SAMPLE, 3), F.lit("99"))
    return F.coalesce(sample.rlike(DATED_SAMPLE) & week.between(1, LAST_WEEK), F.lit(False))


def name_in_period(name: str, from_year: int | None = None, from_week: int | None = None, to_year: int | None = None, to_week: int | None = None) -> bool:
    """in_period() of a file's name, without reading the file; true for names without a date."""
    found = re.match(DATED_SAMPLE, name.rstrip("/").rsplit("/", 1)[-1].split(".")[0])
    if not found or not 1 <= int(found[3]) <= LAST_WEEK:
        return True
    at = int(found[2]), int(found[3])
    return (from_year is None or at >= (from_year, from_week or 0)) and (to_year is None or at <= (to_year, 99 if to_week is None else to_week))


def period(year: Column, week: Column) -> Column:
    """Year and two-digit week, such as 2013_07."""
    return F.concat_ws("_", year.cast("string"), F.lpad(week.cast("string"), 2, "0"))


def in_period(year: Column, week: Column, from_year: int | None = None, from_week: int | None = None, to_year: int | None = None, to_week: int | None = None) -> Column:
    """Whether (year, week) lies between two inclusive ends; a week without its year is no end, an end without a week takes its whole year."""
    at = F.struct(year.cast("int").alias("y"), week.cast("int").alias("w"))
    end = lambda y, w: F.struct(F.lit(y).cast("int").alias("y"), F.lit(w).cast("int").alias("w"))
    found = F.lit(True)
    if from_year is not None:
        found = found & (at >= end(from_year, 0 if from_week is None else from_week))
    if to_year is not None:
        found = found & (at <= end(to_year, 99 if to_week is None else to_week))
    return found


def hits(kmer_string: Column) -> Column:
    """Array of (kmer_tax_id, kmer_count) of a hit string."""
    found = F.regexp_extract_all(F.coalesce(kmer_string, F.lit("")), F.lit(HIT), F.lit(1))
    return F.transform(found, lambda x: F.struct(F.split_part(x, F.lit(":"), F.lit(1)).cast("long").alias("kmer_tax_id"), F.split_part(x, F.lit(":"), F.lit(2)).cast("long").alias("kmer_count")))


def total_length(lengths: Column) -> Column:
    """Sum of a read's lengths, such as 150|148; a missing second one is 0."""
    part = lambda k: F.coalesce(F.try_element_at(F.split(lengths, r"\|"), F.lit(k)).try_cast("int"), F.lit(0))
    return part(1) + part(2)


def short_name(name: Column) -> Column:
    """First three letters of the first two words, capitalised; a single word as it is."""
    words = F.split(F.trim(name), r"\s+")
    two = F.concat(F.initcap(F.substring(F.get(words, F.lit(0)), 1, 3)), F.initcap(F.substring(F.get(words, F.lit(1)), 1, 3)))
    return F.when(F.size(words) >= 2, two).otherwise(name)
