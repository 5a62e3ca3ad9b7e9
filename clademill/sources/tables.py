"""Tables in files: Parquet, CSV and TSV by extension, taxonomy dumps, id lists; all through Spark's readers and writers.

What is written is a folder of part files under the given name, as Spark writes it, or with single, for CSV and TSV, one file of that name.

Cases: unknown extensions and missing columns are errors; lists become strings in CSV and TSV; an empty table is written with its columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType

from .single import write_single

_TEXT = {".csv": ",", ".tsv": "\t"}


def extension(path: str) -> str:
    name = path.rstrip("/").rsplit("/", 1)[-1].lower().removesuffix(".gz")
    return "." + name.rsplit(".", 1)[-1] if "." in name else ""


def read_table(spark: SparkSession, path: str) -> DataFrame:
    kind = extension(path)
    if kind == ".parquet":
        return spark.read.parquet(path)
    if kind in _TEXT:
        return spark.read.csv(path, sep=_TEXT[kind], header=True, inferSchema=True, escape='"')
    raise ValueError(f"can't tell the format of {path}: .parquet, .csv or .tsv")


def _as_text(x: Column) -> Column:
    return x.cast("string")


def _rounded(x: Column) -> Column:
    return F.round(x, 4).cast("string")


def plain_lists(df: DataFrame) -> DataFrame:
    """Lists joined by semicolons, numbers with a fraction rounded to 4 places."""
    out = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, ArrayType):
            double = isinstance(f.dataType.elementType, DoubleType)
            out[f.name] = F.array_join(F.transform(f"`{f.name}`", _rounded if double else _as_text), ";")
    return df.withColumns(out) if out else df


def _lines(df: DataFrame, sep: str, quoted: bool = True) -> tuple[DataFrame, str]:
    """Lines as one column, and the header. quoted: text, and columns' names, are in double quotes, so that only numbers are bare; else only where they must be.

    Line ends in text become blanks.
    """
    marks = lambda c: F.concat(F.lit('"'), F.regexp_replace(c, '"', '""'), F.lit('"'))

    def text(c: Column) -> Column:
        flat = F.regexp_replace(c, r"\s*\n\s*", " ")
        return marks(flat) if quoted else F.when(flat.contains(sep) | flat.contains('"') | (flat == ""), marks(flat)).otherwise(flat)

    cell = lambda f: text(F.col(f"`{f.name}`")) if isinstance(f.dataType, StringType) else F.col(f"`{f.name}`").cast("string")
    name = lambda c: '"' + c.replace('"', '""') + '"' if quoted or sep in c or '"' in c else c
    return df.select(F.concat_ws(sep, *[F.coalesce(cell(f), F.lit("")) for f in df.schema.fields]).alias("line")), sep.join(map(name, df.columns))


def write_table(df: DataFrame, path: str, overwrite: bool = False, quoted: bool = False, single: bool = False) -> None:
    """quoted: in CSV and TSV, all that isn't a number is put in quotes. single: CSV and TSV are one file, in the rows' order."""
    mode, kind = "overwrite" if overwrite else "errorifexists", extension(path)
    if kind == ".parquet":
        df.write.mode(mode).option("compression", "zstd").parquet(path)
    elif kind in _TEXT:
        rows = plain_lists(df)
        if single:
            lines, header = _lines(rows, _TEXT[kind], quoted)
            write_single(lines, f"{path.rstrip('/')}.parts", path, f"{header}\n".encode(), "gzip" if path.endswith(".gz") else None)
        elif quoted:  # a separator that is in no line
            lines, header = _lines(rows, _TEXT[kind])
            lines.toDF(header).write.mode(mode).csv(path, sep="\1", quote="\0", header=True)
        else:
            rows.write.mode(mode).csv(path, sep=_TEXT[kind], header=True, escape='"')
    else:
        raise ValueError(f"can't tell the format of {path}: .parquet, .csv or .tsv")


def read_inspect(spark: SparkSession, path: str) -> DataFrame:
    """(t_id, clade_minimizers) of a database listing with columns tax_id and clade_minimizers, separated by ; or ,."""
    for sep in (";", ","):
        rows = spark.read.csv(path, sep=sep, header=True)
        if {"tax_id", "clade_minimizers"} <= set(rows.columns):
            return rows.select(F.col("tax_id").cast("long").alias("t_id"), F.col("clade_minimizers").cast("double").alias("clade_minimizers"))
    raise ValueError(f"{path} has no columns tax_id and clade_minimizers")


def read_taxonomy(spark: SparkSession, folder: str) -> DataFrame:
    """(t_id, parent_id, rank, name) of nodes.dmp and names.dmp; scientific names only, if names have a class."""
    fields = lambda name: spark.read.text(f"{folder}/{name}").select(F.transform(F.split("value", r"\|"), lambda x: F.trim(F.translate(x, "\t", ""))).alias("c"))
    at = lambda k: F.get("c", F.lit(k))
    nodes = fields("nodes.dmp").select(at(0).try_cast("long").alias("t_id"), at(1).try_cast("long").alias("parent_id"), at(2).alias("rank"))
    names = fields("names.dmp").filter(at(3).isNull() | (at(3) == "") | (at(3) == "scientific name")).select(at(0).try_cast("long").alias("t_id"), at(1).alias("name"))
    return nodes.filter("t_id IS NOT NULL").join(names.groupBy("t_id").agg(F.min("name").alias("name")), "t_id", "left")


def read_ids(spark: SparkSession, path: str) -> list[str]:
    """Ids of a list that a user keeps by hand: one a line, # starts a comment, the first of repeated ones counts."""
    lines = (r["value"].strip() for r in spark.read.text(path).toLocalIterator())
    return list(dict.fromkeys(x for x in lines if x and not x.startswith("#")))
