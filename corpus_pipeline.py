"""The corpus pipeline: documents in, sampled segmentations of the kept and mixed ones out.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept; docs is read from what that one wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clademill.llm import cotrain, hostrules, minhash, mixing, segment
from clademill.llm.store import importable, saved


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained views don't reject.

    Null and empty texts are scored like any others; repeated rows are kept or rejected alike; without labels of both classes all stay.
    """
    importable(spark)
    return cotrain.filtered(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither a rule nor their host's verdict rejects.

    Null and empty texts have too few words and go; a null source is a host of its own; repeated rows count each.
    """
    return hostrules.filtered(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: five-word shingles, similarity of 0.8 or more.

    Rows that repeat an id with unlike texts are documents of their own; texts without words and rows with a null id all stay; of equal rows one stays.
    """
    importable(spark)
    return minhash.deduplicated(docs, size=5, percent=80)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as a mix of the sources takes them.

    Texts without words are never taken; a null source is a source of its own; rows that repeat id and text share what is taken of them.
    """
    return mixing.resampled(docs)


def segmentations(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of each document.

    A null text has none, an empty one has one; copies of a document have the same segmentations. Very long texts are worked on whole in every stage, and an
    empty table gives an empty one.
    """
    importable(spark)
    return segment.digested(docs, k=2)


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_duplicates),
    ("mixing sources", source_mix),
    ("SentencePiece segmentations", segmentations),
]

#: SQL can't express the classifier, the sketches or the lattices.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage returns is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
