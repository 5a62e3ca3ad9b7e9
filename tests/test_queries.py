"""Every query that has SQL gives the SQL's rows on the smallest tables."""

from __future__ import annotations

import pytest
from compare import difference
from conftest import SMALL

from clademill.plans import oracle, queries


def test_every_query_has_sql():
    assert set(oracle.oracle_sql()) == set(queries.queries())


@pytest.mark.parametrize("name", list(oracle.oracle_sql()))
def test_same_rows(spark, con, name):
    assert difference(spark, SMALL, name, con) == ""


def test_bounds_lie_in_the_tables(spark, con):
    """Years that SQL lists are the years that there are; filters find rows and leave rows out."""
    years = [str(r[0]) for r in con.execute("SELECT DISTINCT year(o_orderdate) FROM orders ORDER BY 1").fetchall()]
    assert years == oracle._YEARS
    n = con.execute("SELECT count(*) FROM orders").fetchone()[0]
    sql = oracle.oracle_sql()
    for name in ("temporal_filter", "reads_in_period"):
        assert 0 < con.execute(f"SELECT count(*) FROM ({sql[name]})").fetchone()[0] < n
    months = {r[0] for r in con.execute("SELECT DISTINCT strftime(o_orderdate, '%Y-%m') FROM orders").fetchall()}
    assert {"1995-01", "2001-07"} <= months


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["t_id", "sample_id", "taxon_reads", "clade_reads"]
