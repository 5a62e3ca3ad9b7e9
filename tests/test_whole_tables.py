"""Queries over the star schema's tables use all rows that they should, whatever dates the tables hold."""

from __future__ import annotations

from conftest import SMALL
from pyspark.sql import functions as F

from clademill.functions import scalar
from clademill.operators import extract, kmers, tables
from clademill.plans import queries
from clademill.plans import warehouse as w


def test_wide_table_has_every_read(spark):
    table = queries.wide_table(spark, SMALL)
    reads = {r["y"]: r["n"] for r in w.bare_reads(spark, SMALL).groupBy(F.left("sample_id", F.lit(4)).alias("y")).agg(F.count(F.lit(1)).alias("n")).collect()}
    assert sorted(table.columns[1:]) == sorted(reads)
    # The root's clade and the reads without a taxon are all reads of a sample.
    held = table.filter("t_id IN (0, 1)").agg(*[F.sum(f"`{y}`").alias(y) for y in reads]).first()
    assert held.asDict() == reads


def test_chunks_are_two_halves(spark):
    lengths = queries.read_length_aggregate(spark, SMALL)
    first, second = ({r["sample_id"] for r in half.select("sample_id").distinct().collect()} for half in queries._halves(lengths))
    assert first and second and max(first) < min(second) and abs(len(first) - len(second)) <= 1
    assert first | second == {r["sample_id"] for r in lengths.select("sample_id").distinct().collect()}
    assert [half.count() for half in queries._halves(lengths.limit(0))] == [0, 0]


def test_periods_within_the_tables(spark, con):
    """Bounds that cut on both sides, as those of the registered queries lie before the first read."""
    rows, taxa = w.bare_reads(spark, SMALL), w.taxa(spark, SMALL)
    dates = {k: (y, n) for k, y, n in con.execute("SELECT o_orderkey, isoyear(o_orderdate), week(o_orderdate) FROM orders").fetchall()}
    period = rows.filter(scalar.in_period(F.col("year"), F.col("week"), 1996, 12, 1998, None)).select("read_id").collect()
    want = {k for k, d in dates.items() if (1996, 12) <= d <= (1998, 99)}
    assert 0 < len(want) < len(dates) and {r.read_id for r in period} == want
    got = extract.wanted_reads(rows, taxa, [queries.CLADE], from_year=1996, to_year=1997, to_week=20).select("read_id").collect()
    whole = extract.wanted_reads(rows, taxa, [queries.CLADE]).select("read_id").collect()
    want = {r.read_id for r in whole if (1996, 0) <= dates[r.read_id] <= (1997, 20)}
    assert 0 < len(want) < len(whole) and {r.read_id for r in got} == want
    kept = tables.selected_reads(kmers.read_counts(rows, ("sample_id", "year", "week")), ("1995-01", "2001-07"), by_period=True)
    left = rows.filter("sample_id NOT IN ('1995-01', '2001-07')").count()
    assert kept.agg(F.sum("taxon_reads")).first()[0] == left < rows.count() - 1
