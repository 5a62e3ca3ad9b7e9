from __future__ import annotations

import random

import pytest
from tree import NODES, SCHEMA, bubble, clades, push_up

from clademill.operators import rollup, tables, taxonomy

RANKS = taxonomy.CANONICAL_RANKS


@pytest.fixture(scope="module")
def taxa(spark):
    return taxonomy.with_paths(spark.createDataFrame(NODES, SCHEMA)).cache()


def _random_tree(seed):
    r = random.Random(seed)
    nodes = [(1, 1, "no rank", "root")]
    depth = {1: 0}
    for t in range(2, 40):
        p = r.choice(list(depth))
        depth[t] = depth[p] + 1
        nodes.append((t, p, RANKS[min(depth[t] - 1, 6)] if r.random() < 0.6 else "clade", f"n{t}"))
    reads = {(r.choice(list(depth)), f"s{r.randrange(4)}"): r.randrange(1, 9) for _ in range(60)}
    return nodes, reads


@pytest.mark.parametrize("seed", range(4))
def test_against_slow_models(spark, seed):
    nodes, reads = _random_tree(seed)
    parents, ranks = {n[0]: n[1] for n in nodes}, {n[0]: n[2] for n in nodes}
    reads[77, "s1"] = 5  # not in the tree
    taxa = taxonomy.with_paths(spark.createDataFrame(nodes, SCHEMA))
    df = spark.createDataFrame([(t, s, n) for (t, s), n in reads.items()], "t_id long, sample_id string, taxon_reads long")
    assert {(r.t_id, r.sample_id): r.clade_reads for r in rollup.clade_sums(df, taxa).collect()} == clades(parents, reads)
    got = {(r.t_id, r.sample_id): (r.taxon_reads, r.clade_reads) for r in rollup.pushed_up(df, taxa, 6, 2).collect()}
    assert got == push_up(parents, reads, 6, 2)
    # A node's rank can occur twice on a path here, which the slow model treats alike.
    got = {(r.t_id, r.sample_id): r.value for r in rollup.canonical_remainders(df, taxa, 6, 2, ranks=RANKS, top=1).collect()}
    expected = bubble(parents, ranks, RANKS, reads, 6, 2)
    assert sum(got.values()) == sum(expected.values()) == sum(n for (t, _), n in reads.items() if t in parents)
    assert got == expected


def test_routes_longer_than_the_ranks(spark):
    """Eleven species in a chain: what fails at its end is passed up, however long the chain."""
    nodes = [(1, 1, "no rank", "root"), *[(t, t - 1, "species", f"s{t}") for t in range(2, 13)]]
    reads = {(12, "a"): 1, (2, "a"): 60, (7, "a"): 49}
    df = spark.createDataFrame([(t, s, n) for (t, s), n in reads.items()], "t_id long, sample_id string, taxon_reads long")
    got = {(r.t_id, r.sample_id): r.value for r in rollup.canonical_remainders(df, taxonomy.with_paths(spark.createDataFrame(nodes, SCHEMA)), 50, 1).collect()}
    assert got == {(7, "a"): 50, (2, "a"): 60} == bubble({n[0]: n[1] for n in nodes}, {n[0]: n[2] for n in nodes}, RANKS, reads, 50, 1)


def test_top_ranks(spark):
    node = lambda rank: taxonomy.with_paths(spark.createDataFrame([(1, 1, "no rank", "root"), (2, 1, rank, "top"), (3, 2, "phylum", "p"), (4, 2, "clade", "c")], SCHEMA))
    assert taxonomy.canonical_ranks(node("superkingdom")) == RANKS and taxonomy.canonical_ranks(node("clade")) == RANKS
    taxa = node("domain")
    assert taxonomy.canonical_ranks(taxa) == ("domain", *RANKS[1:])
    reads = spark.createDataFrame([(4, "a", 7), (3, "a", 2)], "t_id long, sample_id string, taxon_reads long")
    got = {r.t_id: r.value for r in tables.abundance_table(reads, taxa, "canonical", 0, 0, ranks=taxonomy.canonical_ranks(taxa)).collect()}
    assert got == {2: 7, 3: 2}
    assert {r["rank"]: (r.before, r.after, r.moved) for r in rollup.read_migration(reads, tables.abundance_table(reads, taxa, "taxon", 3, 1), taxa).collect()} == {"clade": (7, 7, 0), "phylum": (2, 0, -2), "domain": (0, 2, 2)}


def test_nested_sets_contain_clades(spark, taxa):
    sets = {r.t_id: (r.entry, r.exit) for r in taxonomy.nested_sets(taxa).collect()}
    for r in taxa.collect():
        for a in sets:
            assert (a in r.path) == (sets[a][0] <= sets[r.t_id][0] < sets[a][1])
    assert sets[1] == (0, len(NODES))


def test_taxonomy_cases(spark, taxa):
    odd = [(5, 6, "genus", "orphan"), (8, None, "species", "no parent"), (5, 6, "genus", "orphan"), (None, 1, "genus", "no id")]
    got = {r.t_id: r.path for r in taxonomy.with_paths(spark.createDataFrame(odd, SCHEMA)).collect()}
    assert got == {5: [5], 8: [8]}
    assert taxonomy.with_paths(spark.createDataFrame([], SCHEMA)).count() == 0
    with pytest.raises(ValueError, match="cycle"):
        taxonomy.with_paths(spark.createDataFrame([(1, 2, "", ""), (2, 1, "", "")], SCHEMA))
    with pytest.raises(ValueError, match="taxonomy"):
        taxonomy.described(spark.createDataFrame([(4,)], "t_id long"), taxa, strict=True)
    pairs = spark.createDataFrame([(9606, 10090), (562, 511145), (9606, 4)], "a long, b long")
    got = {(r.a, r.b): (r.lca_id, r.distance) for r in taxonomy.lowest_common(pairs, taxa).collect()}
    assert got == {(9606, 10090): (7711, 4), (562, 511145): (562, 1), (9606, 4): (None, None)}


def test_table_modes_and_mass(spark, taxa):
    reads = spark.createDataFrame([(9606, "a", 10), (9605, "a", 5), (10090, "a", 1), (562, "a", 4), (0, "a", 7), (562, "b", 3), (None, "b", 2)], "t_id long, sample_id string, taxon_reads long")
    table = lambda mode, **o: {(r.t_id, r.sample_id): r.value for r in tables.abundance_table(reads, taxa, mode, 2, 1, **o).collect()}
    assert table("taxon") == {(9606, "a"): 10, (9605, "a"): 5, (7711, "a"): 1, (562, "a"): 4, (562, "b"): 3}
    assert table("clade")[1, "a"] == 20
    kept = table("taxon", clade=2759, keep_unclassified=True, keep_filtered=True)
    assert kept == {(9606, "a"): 10, (9605, "a"): 5, (7711, "a"): 1, (0, "a"): 7, (taxonomy.FILTERED, "a"): 4}
    assert table("canonical") == {(9606, "a"): 10, (9605, "a"): 5, (1, "a"): 1, (562, "a"): 4, (562, "b"): 3}
    assert table("taxon", as_proportions=True)[562, "b"] == 1.0
    with pytest.raises(ValueError, match="canonical rank"):
        tables.abundance_table(reads, taxa, "canonical", clade=511145)
    with pytest.raises(ValueError, match="mode"):
        tables.abundance_table(reads, taxa, "none")
    assert tables.abundance_table(reads.limit(0), taxa).count() == 0
    assert tables.absent_samples(reads, ("a", "z")) == ["z"]
    wide = tables.wide(tables.abundance_table(reads, taxa, "taxon", 2, 1))
    assert wide.columns == ["t_id", "a", "b"] and wide.filter("t_id = 9606").first()["b"] == 0
