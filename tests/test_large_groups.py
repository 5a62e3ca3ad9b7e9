"""Groups that no task should sort whole, and tables in buckets."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from tree import NODES, SCHEMA

from clademill.functions import stats
from clademill.functions.stats import STATISTICS, distribution, distributions
from clademill.operators import features, tables, taxonomy
from clademill.shared import bucketed, saved


def _values(seed):
    r = random.Random(seed)
    rows = [("spread", r.uniform(-5, 5), r.choice([0, 1, 2, None])) for _ in range(300)]
    rows += [("powers", 2.0 ** -r.randrange(300), r.randrange(1, 4)) for _ in range(200)]
    rows += [("ties", float(r.randrange(12)), r.randrange(1, 9)) for _ in range(200)] + [("one", 3.0, 5)] * 40 + [("two", x, 1) for x in (1.0, 2.0)]
    rows += [("spread", None, 1), ("spread", float("nan"), 1), ("nothing", None, 1), ("huge", 1e300, 1), ("huge", -1e300, 2), ("huge", 0.0, 1)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("most", [40])
def test_split_groups_have_the_same_statistics(spark, most):
    df = spark.createDataFrame(_values(most), "g string, value double, w long").repartition(3)
    for weight in (None, "w"):
        got = {r.g: r for r in distribution(df, ["g"], "value", weight, most=most).collect()}
        want = {r.g: r for r in distribution(df, ["g"], "value", weight).collect()}
        assert got.keys() == want.keys() and "nothing" not in got
        for g, r in want.items():
            for s in STATISTICS:
                exact = s in ("median", "p05", "p95")
                assert got[g][s] == (r[s] if exact or r[s] is None else pytest.approx(r[s], rel=1e-9)), (g, s, weight)
    assert distribution(df.limit(0), ["g"], most=most).count() == 0


def test_places_of_a_split_group(spark):
    df = spark.range(5000).select(F.lit("g").alias("g"), (F.col("id") * 7 % 5000).cast("double").alias("value"))
    out = distribution(df, ["g"], most=40).first()
    assert (out.median, out.p05, out.p95) == (2499.5, 250.0, 4749.0)


def test_buckets_move_no_rows(spark, tmp_path):
    taxa = saved(taxonomy.prepared(spark.createDataFrame(NODES, SCHEMA)), "taxa")  # small enough to be sent
    r = random.Random(4)
    ids = [n[0] for n in NODES]
    kmers = spark.createDataFrame([(f"s{r.randrange(3)}", r.choice(ids), r.choice([0, 77, None, *ids]), r.randrange(1, 9)) for _ in range(500)], "sample_id string, t_id long, kmer_tax_id long, kmer_count long")
    table = bucketed(kmers, "kmers_in_buckets", ["t_id"], 4, f"{tmp_path}/kmers")
    for scope in ("global", "sample"):
        got = features.kmer_features(table, taxa, scope, parts=("counts",))
        want = features.kmer_features(kmers, taxa, scope, parts=("counts",))
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    plan = features.kmer_features(table, taxa, "global", parts=("counts",))._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "Exchange hashpartitioning(t_id" not in plan and "Exchange hashpartitioning" not in plan
    spark.sql("DROP TABLE kmers_in_buckets")


def test_prepared_taxa_have_their_places(spark):
    """Nothing is shuffled for what a prepared taxonomy holds, and only nodes with children have their paths walked."""
    r = random.Random(6)
    nodes = [(1, 1, "no rank", "root"), (900, 901, "clade", "its parent is not there"), (902, None, "clade", None)]
    for t in range(2, 120):
        nodes.append((t, r.choice([n[0] for n in nodes]), r.choice(["clade", None]), f"n{t}"))
    up = {t: p for t, p, _, _ in nodes}
    taxa = saved(taxonomy.prepared(spark.createDataFrame(nodes + nodes[:5], SCHEMA)), "taxa")
    rows = {x.t_id: x for x in taxa.collect()}
    assert len(rows) == len(nodes)
    for t, _, rank, name in nodes:
        want = [t]
        while up[want[0]] in up and up[want[0]] != want[0]:
            want.insert(0, up[want[0]])
        assert (rows[t].path, rows[t].depth, rows[t].ranks[-1], rows[t]["rank"], rows[t].name) == (want, len(want) - 1, rank, rank, name)
        assert rows[t].exit - rows[t].entry == sum(t in x.path for x in rows.values())
    sets = taxonomy.nested_sets(taxa)
    assert "Exchange" not in sets._jdf.queryExecution().executedPlan().toString()
    bare = taxonomy.nested_sets(taxa.drop("entry", "exit", "code"))
    assert sorted(map(tuple, sets.collect())) == sorted(map(tuple, bare.collect()))


@pytest.mark.parametrize("weight", [None, "w"])
def test_tasks_grow_with_the_values(spark, monkeypatch, weight):
    """Values that come of a row are dealt by their number, with the same statistics."""
    r = random.Random(9)
    df = spark.createDataFrame([(r.randrange(60), float(r.randrange(9)), r.uniform(0, 1), r.randrange(1, 4)) for _ in range(600)], "g long, a double, b double, w long")
    metrics = {"a": F.col("a"), "b": F.col("b")}
    want = distributions(df, ["g"], metrics, weight)
    monkeypatch.setattr(stats, "TASK_VALUES", 100)
    got = distributions(df, ["g"], metrics, weight, df.count())
    assert "hashpartitioning(g#" in (plan := got._jdf.queryExecution().executedPlan().toString()) and ", 12), REPARTITION_BY_NUM" in plan
    at = lambda out: sorted(tuple(x if x is None else round(x, 9) for x in row) for row in out.collect())
    assert at(got) == at(want)


def test_filtered_cells_are_made_once(spark):
    """What a clade leaves out is told from written cells: the table's plan reads no read twice."""
    taxa = saved(taxonomy.prepared(spark.createDataFrame(NODES, SCHEMA)), "taxa")
    reads = saved(spark.createDataFrame([(t, s, 3) for t in (0, 562, 9606, 10090) for s in ("a", "b")], "t_id long, sample_id string, taxon_reads long"), "only-reads")
    for mode in tables.MODES:
        cells = tables.table_cells(reads, taxa, mode, 1, 1, clade=2, keep_filtered=True)
        assert "only-reads" not in cells._jdf.queryExecution().executedPlan().toString()
        assert {x.sample_id: x.value for x in cells.filter("t_id = 100000000").collect()} == {"a": 6, "b": 6}


def test_only_nodes_with_grandchildren_are_walked(spark, monkeypatch):
    """Paths are looked up for nodes with grandchildren alone, and wide rows aren't written before the end."""
    r, up = random.Random(4), {1: 1, 500: 501, 502: 500, 503: 502}
    for t in range(2, 200):
        up[t] = r.choice([x for x in up if x < t])
    inner = {p for t, p in up.items() if p != t and p in up}
    deep = {up[t] for t in inner if up[t] != t and up[t] in up}
    written = []
    monkeypatch.setattr(taxonomy, "saved", lambda df, name: written.append((name, out := saved(df, name))) or out)
    monkeypatch.setattr(taxonomy, "drop_saved", lambda df: None)
    taxa = taxonomy.prepared(spark.createDataFrame([(t, p, "clade", f"n{t}") for t, p in up.items()], SCHEMA))
    walked = [out for name, out in written if any(kind.startswith("array") for _, kind in out.dtypes)]
    assert walked and all({x.t_id for x in out.collect()} == deep for out in walked)
    rows = {x.t_id: x for x in taxa.collect()}
    assert len(rows) == len(up) and sorted(x.entry for x in rows.values()) == list(range(len(up)))
    for t, x in rows.items():
        assert x.path == ([*rows[up[t]].path, t] if up[t] != t and up[t] in up else [t])
        assert {y.t_id for y in rows.values() if x.entry <= y.entry < x.exit} == {y.t_id for y in rows.values() if t in y.path}
        assert all(y.code.startswith(x.code) == (t in y.path) for y in rows.values())


def _reads_of(df, column: str) -> int:
    """How often a plan reads the table that has the column first."""
    return df._jdf.queryExecution().optimizedPlan().toString().count(f"Relation [{column}#")


def test_reports_make_their_reads_once(spark, tmp_path):
    """Cells count reads without stretches, and a stretch that several reads of a cell have once."""
    from datetime import datetime

    from clademill.plans import warehouse

    table = lambda rows, schema, name: spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    table([(1, "a", 3, "X"), (2, "b", 4, "Y")], "c_custkey long, c_name string, c_nationkey int, c_mktsegment string", "customer")
    orders = [(3, 1, "1"), (4, 1, "1"), (5, 1, None), (8, 2, "1"), (9, 2, None), (10, 2, "2"), (20, 1, "2"), (33, 77, "1")]
    table([(k, c, datetime(1995, 1, 1 + k % 20), p) for k, c, p in orders], "o_orderkey long, o_custkey long, o_orderdate timestamp, o_orderpriority string", "orders")
    lines = [(3, 7, 2.0), (3, 7, 1.0), (4, 7, 5.0), (4, 8, 1.0), (8, 7, 3.0), (9, 7, 3.0), (10, None, 4.0), (10, 2, None), (33, 1, 1.0)]
    table([(k, p, q) for k, p, q in lines], "l_orderkey long, l_partkey long, l_quantity double", "lineitem")
    got = warehouse.reports(spark, str(tmp_path))
    assert _reads_of(got, "o_orderkey") == 1
    want = {(100_001, 3, 9, 2), (10_000_021, 1, 3, 1), (None, 1, 0, 0), (0, 2, 4, 1)}
    assert {(x.t_id, x.taxon_reads, x.mm_tot, x.mm_uniq) for x in got.collect()} == want
    assert dict(got.dtypes) == {"t_id": "bigint", "sample_id": "string", "taxon_reads": "bigint", "mm_tot": "bigint", "mm_uniq": "bigint"}


def test_minimizers_go_with_their_reads(spark, tmp_path):
    """Reports are read once for clade sums and own numbers: repeated cells add up, rows without a count have their minimizers, a null sample has none."""
    rows = [(562, "a", 4, 8, 6), (562, "a", 1, 2, 1), (511145, "a", 3, 5, 5), (561, "a", None, 7, 3), (511145, "b", 2, 4, 2), (562, None, 2, 4, 3), (None, "a", 9, 9, 9), (0, "a", 5, 5, 5), (7, "b", 1, None, None)]
    spark.createDataFrame(rows, "t_id long, sample_id string, taxon_reads long, mm_tot long, mm_uniq long").coalesce(1).write.parquet(f"{tmp_path}/reports")
    taxa = saved(taxonomy.prepared(spark.createDataFrame(NODES, SCHEMA)), "taxa")
    out = features.minimizer_samples(spark.read.parquet(f"{tmp_path}/reports"), taxa.select("t_id", F.lit(10).alias("clade_minimizers")), taxa)
    files = [x.split("]")[0] for x in out._jdf.queryExecution().optimizedPlan().toString().split("Relation [")[1:]]
    assert sum("taxon_reads#" in x for x in files) == 1
    got = {(x.t_id, x.sample_id): (x.reads_tot, x.mm_tot, x.mm_uniq) for x in out.collect()}
    want = {(511145, "a"): (3, 5, 5), (562, "a"): (8, 10, 7), (561, "a"): (8, 7, 3), (511145, "b"): (2, 4, 2), (562, "b"): (2, None, None), (562, None): (2, None, None), (561, None): (2, None, None), (7, "b"): (1, None, None)}
    assert {k: v for k, v in got.items() if k[0] in (511145, 562, 561, 7) and k != (561, "b")} == want
