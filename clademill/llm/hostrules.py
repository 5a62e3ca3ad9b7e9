"""Quality rules judged by host.

Every document is measured by built-in functions; failures are summed up by host (the document's source), each
host's failure rate is shrunk towards the corpus by a beta prior fitted to all hosts by moments, and the host's
verdict is joined back. A host whose shrunk rate exceeds max_host_rate is rejected whole; in the others, a document
goes that itself breaks a rule.

Cases: null and empty texts have no words and fail; a null host is a host of its own; repeated rows count each; a rate or share of just the bound is
kept; very long texts are measured whole; an empty table gives no rows; extra columns are not carried by judged(), and carried as they are, whatever their
names, by filtered().
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import drop_saved, saved
from .text import WORD

#: Bounds of the rules: least words, most % of repeated words, most % symbols to words, most % of repeated lines.
MIN_WORDS, MAX_REPEAT, MAX_SYMBOLS, MAX_DUP_LINES = 50, 50, 10, 30
#: A host goes if its shrunk failure rate is above this.
MAX_HOST_RATE = 0.6
#: Bytes of host rates, and of marks of failing texts, that are broadcast at most.
BROADCAST_BYTES, MARKS_BYTES = 8 << 20, 32 << 20


def _marks(text: str) -> list[Column]:
    """128 bits that equal texts share."""
    return [F.xxhash64(F.lit(k), text).alias(f"t{k}") for k in (1, 2)]


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", texts: bool = False) -> DataFrame:
    """(doc_id, host, host_null, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, failed).

    With texts, marks of the text come along as the columns t1 and t2.
    """
    marks = _marks(text_col) if texts else []
    text = F.coalesce(F.col(text_col), F.lit(""))
    # w and s each have several references, so the optimizer keeps them as columns of their own projections.
    base = docs.select(
        *marks,
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(host_col), F.lit("")).alias("host"),
        F.col(host_col).isNull().alias("host_null"),
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("w"),
        F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD)).alias("lines"),
    )
    # Three-word windows as (hash, place), sorted: equal windows are neighbours.
    base = base.select(
        *(["t1", "t2"] if texts else []), "doc_id", "host", "host_null", "word_chars", "n_symbols",
        F.size("w").cast("long").alias("n_words"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.sort_array(
            F.transform(
                F.slice("w", 1, F.greatest(F.size("w") - 2, F.lit(0))),
                lambda x, i: F.struct(F.xxhash64(x, F.get("w", i + 1), F.get("w", i + 2)).alias("h"), i.alias("i")),
            )
        ).alias("s"),
    )
    twice = base.withColumn(
        "at",
        F.sort_array(
            F.filter(
                F.transform("s", lambda x, j: F.when((x["h"] == F.get("s", j - 1)["h"]) | (x["h"] == F.get("s", j + 1)["h"]), x["i"])),
                lambda x: x.isNotNull(),
            )
        ),
    )
    # Windows overlap: one starting at a adds the places up to the next one's start, three at most.
    steps = F.zip_with("at", F.slice("at", 2, F.greatest(F.size("at"), F.lit(1))), lambda a, b: F.coalesce(F.least(b - a, F.lit(3)), F.lit(3)))
    out = twice.withColumn("n_repeat_words", F.aggregate(steps, F.lit(0), lambda acc, x: acc + x).cast("long")).drop("s", "at")
    out = out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words")))
    return out.withColumn(
        "failed",
        F.col("base_failed") | (100 * F.col("n_symbols") > MAX_SYMBOLS * F.col("n_words")) | (100 * F.col("n_dup_lines") > MAX_DUP_LINES * F.col("n_words")),
    )


def host_rates(docs: DataFrame) -> DataFrame:
    """(host, host_null, n, failures, rate): measured documents by host, rates shrunk by a beta prior.

    The prior has the mean m of all documents and, from the spread v of host rates weighted by documents, the
    strength m(1-m)/v - 1, held to [1, 1000]; without spread it is 1000.
    """
    hosts = docs.groupBy("host", "host_null").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("failed").cast("long")).alias("failures"))
    m = F.sum("failures") / F.sum("n")
    raw = F.col("failures") / F.col("n")
    prior = hosts.agg(m.alias("m"), (F.sum(F.col("n") * raw * raw) / F.sum("n") - m * m).alias("v"))
    mean, spread = prior.first()  # one row for the whole corpus
    mean, spread = mean or 0.0, spread or 0.0
    strength = min(max(mean * (1 - mean) / spread - 1, 1.0), 1000.0) if spread > 1e-12 else 1000.0
    return hosts.withColumn("rate", (F.col("failures") + mean * strength) / (F.col("n") + strength))


def _rates(m: DataFrame) -> DataFrame:
    """(host, host_null, host_rate) of written measured documents."""
    rates = saved(host_rates(m).select("host", "host_null", F.col("rate").alias("host_rate")), "rule-hosts")
    # The hosts' size is checked: beyond the bound documents are shuffled to them, where Spark splits large hosts.
    return F.broadcast(rates) if (rates.agg(F.sum(F.octet_length("host") + 32)).first()[0] or 0) <= BROADCAST_BYTES else rates


def judged(docs: DataFrame, max_host_rate: float = MAX_HOST_RATE, **columns) -> DataFrame:
    """measured() with host_rate and kept for every document."""
    m = saved(measured(docs, **columns), "rule-counts")
    return m.join(_rates(m), ["host", "host_null"], "left").withColumn("kept", ~F.col("failed") & (F.col("host_rate") <= max_host_rate))


def filtered(docs: DataFrame, max_host_rate: float = MAX_HOST_RATE, text_col: str = "text", host_col: str = "source", **columns) -> DataFrame:
    """The rows of docs that are kept, all columns as they were. No document is written: its text's marks tell that it fails, its host the host's verdict."""
    m = measured(docs, text_col=text_col, host_col=host_col, texts=True, **columns)
    m = saved(m.select("host", "host_null", "failed", "t1", "t2"), "rule-counts")
    rates, failing = _rates(m), saved(m.filter("failed").select("t1", "t2").distinct(), "rule-failing")
    # The marks' size is checked: beyond the bound documents are shuffled to them.
    failing = F.broadcast(failing) if failing.count() * 24 <= MARKS_BYTES else failing
    drop_saved(m)
    host = [F.coalesce(F.col(host_col), F.lit("")).alias("host"), F.col(host_col).isNull().alias("host_null")]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *_marks(text_col), *host)
    rows = rows.join(failing, ["t1", "t2"], "left_anti").join(rates, ["host", "host_null"], "left")
    return rows.filter(F.col("host_rate") <= max_host_rate).select("row.*")
