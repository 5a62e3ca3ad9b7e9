"""Classification reports: one file a sample, one row a taxon.

Cases: a folder without matching files, files of different formats and files with other numbers of columns are errors; ids that aren't numbers are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import is_dated, sample_name, sample_week, sample_year

#: Columns of a report line, with and without minimizer counts, and the formats' names.
COLUMNS = {"HYPERLOGLOG": ("percent", "clade_reads", "taxon_reads", "mm_tot", "mm_uniq", "rank", "t_id", "name"), "LEGACY": ("percent", "clade_reads", "taxon_reads", "rank", "t_id", "name")}


def read_reports(spark: SparkSession, folder: str, pattern: str = "*.report", recursive: bool = True, sample_from: Column | None = None) -> tuple[DataFrame, str, bool]:
    """(sample_id, [year, week,] t_id, taxon_reads [, mm_tot, mm_uniq]), the format's name, and whether all samples are dated.

    Year and week are there if every file is named for them. sample_from is the path or name that holds the sample; the file's path by default.
    """
    lines = spark.read.option("recursiveFileLookup", str(recursive).lower()).option("pathGlobFilter", pattern).text(folder)
    lines = lines.filter(F.trim("value") != "").select(sample_name(F.col("_metadata.file_path") if sample_from is None else sample_from).alias("sample_id"), F.split("value", "\t").alias("c"))
    found = lines.agg(F.min(F.size("c")).alias("least"), F.max(F.size("c")).alias("most"), F.bool_and(is_dated(F.col("sample_id"))).alias("dated")).first()
    if found["least"] is None:
        raise FileNotFoundError(f"no report matches {pattern} in {folder}")
    if found["least"] != found["most"]:
        raise ValueError("Mixed report formats: files with and without minimizer columns")
    kind = next((k for k, names in COLUMNS.items() if len(names) == found["least"]), None)
    if kind is None:
        raise ValueError(f"a report has 6 or 8 columns, not {found['least']}")
    at = {name: F.trim(F.get("c", F.lit(i))) for i, name in enumerate(COLUMNS[kind])}
    numbers = ["t_id", "taxon_reads", *(["mm_tot", "mm_uniq"] if kind == "HYPERLOGLOG" else [])]
    dates = [sample_year(F.col("sample_id")).alias("year"), sample_week(F.col("sample_id")).alias("week")] if found["dated"] else []
    rows = lines.select("sample_id", *dates, *[at[n].try_cast("long").alias(n) for n in numbers])
    return rows.filter("t_id IS NOT NULL"), kind, bool(found["dated"])


def sorted_reports(reports: DataFrame) -> DataFrame:
    return reports.orderBy(*[c for c in ("year", "week") if c in reports.columns], "sample_id", "t_id")
