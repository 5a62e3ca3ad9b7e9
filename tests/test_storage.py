"""How tables and files are stored: pruned clades, path codes, block gzip, merges by place, named files, publishing, observed audits."""

from __future__ import annotations

import gzip
import random

import pytest
from pyspark.sql import functions as F
from tree import NODES, SCHEMA

from clademill.operators import extract, tables, taxonomy
from clademill.plans import commands
from clademill.sources import blocks, lines, matching, provenance, reads
from clademill.sources.tables import read_table, write_table


@pytest.fixture(scope="module")
def taxa(spark):
    return taxonomy.prepared(spark.createDataFrame(NODES, SCHEMA)).cache()


@pytest.fixture
def dump(tmp_path):
    d = tmp_path / "tax"
    d.mkdir()
    (d / "nodes.dmp").write_text("".join(f"{t}\t|\t{p}\t|\t{r}\t|\n" for t, p, r, _ in NODES))
    (d / "names.dmp").write_text("".join(f"{t}\t|\t{n}\t|\t\t|\tscientific name\t|\n" for t, _, _, n in NODES))
    return str(d)


def _random_taxa(spark, seed):
    r = random.Random(seed)
    nodes = [(1, 1, "no rank", "root"), (1000, None, "no rank", "other root")]
    for t in range(2, 80):
        nodes.append((t, r.choice([n[0] for n in nodes]), "clade", f"n{t}"))
    return taxonomy.prepared(spark.createDataFrame(nodes, SCHEMA))


@pytest.mark.parametrize("seed", range(2))
def test_codes_and_intervals(spark, seed):
    taxa = _random_taxa(spark, seed)
    rows = {r.t_id: r for r in taxa.withColumn("d", taxonomy.code_depth(F.col("code"))).withColumn("places", taxonomy.child_places(F.col("code"))).collect()}
    sets = {r.t_id: (r.entry, r.exit) for r in taxonomy.nested_sets(taxa).collect()}
    assert {t: (r.entry, r.exit) for t, r in rows.items()} == sets
    for a in rows.values():
        assert a.d == a.depth == len(a.places) - 1
        for b in rows.values():
            below = a.t_id in b.path
            assert below == b.code.startswith(a.code) == (a.entry <= b.entry < a.exit)
    trees = [sorted((r.code.encode(), r.entry) for r in rows.values() if r.path[0] == top) for top in (1, 1000)]
    assert all([e for _, e in t] == sorted(e for _, e in t) for t in trees)  # bytes are in preorder
    pairs = spark.createDataFrame([(a, b) for a in list(rows)[:20] for b in rows], "a long, b long")
    for r in taxonomy.lowest_common(pairs, taxa).collect():
        common = [x for x, y in zip(rows[r.a].path, rows[r.b].path) if x == y]
        want = (common[-1], len(common) - 1, len(rows[r.a].path) + len(rows[r.b].path) - 2 * len(common)) if common else (None, -1, len(rows[r.a].path) + len(rows[r.b].path))
        assert (r.lca_id, r.lca_depth, r.distance) == want


def test_codes_of_many_children(spark):
    places = [0, 1, 126, 127, 2000, 55_294, 55_295, 70_000, 999_999, 1_000_000, 1_000_001, 2_500_000]
    df = spark.createDataFrame([(p,) for p in places], "p long").withColumn("c", taxonomy.child_code(F.col("p")))
    got = df.select("p", "c", taxonomy.child_places(F.concat("c", "c")).alias("back"), taxonomy.code_depth(F.concat("c", "c")).alias("d")).collect()
    assert [r.p for r in sorted(got, key=lambda r: r.c.encode())] == places
    assert all(r.back == [r.p, r.p] and r.d == 1 for r in got)
    one, two = (next(r.c for r in got if r.p == p) for p in (1_000_000, 1_000_001))
    assert spark.range(1).select(taxonomy.common_code(F.lit("ab" + one), F.lit("ab" + two))).first()[0] == "ab"


def _scanned(df):
    """Rows that the scan of a plan without shuffles gave, and its description."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    scan = plan.collectLeaves().head()
    return scan.metrics().apply("numOutputRows").value(), scan.toString()


def test_clade_filter_reaches_the_scan(spark, taxa, tmp_path):
    r = random.Random(1)
    ids = [n[0] for n in NODES] + [0, 77]
    rows = spark.createDataFrame([(f"r{i:05}", "s", r.choice(ids), 2013, 7) for i in range(20_000)], "read_id string, sample_id string, t_id long, year int, week int")
    stored = reads.clustered(reads.placed(rows, taxa))
    stored.sortWithinPartitions("entry", "read_id").write.option("parquet.block.size", 1 << 14).option("parquet.page.size", 1 << 12).option("parquet.block.size.row.check.min", 100).parquet(f"{tmp_path}/reads.parquet")
    table = spark.read.parquet(f"{tmp_path}/reads.parquet")
    for wanted, mode in (([9606], "clade"), ([9606, 9605, 561], "clade"), ([562], "taxon"), ([4], "clade"), ([], "clade")):
        got = extract.wanted_reads(table, taxa, wanted, mode, by_place=True)
        want = extract.wanted_reads(rows, taxa, wanted, mode)
        key = lambda df: sorted((x.read_id, x.target) for x in df.collect())
        assert key(got) == key(want)
    n, text = _scanned(extract.wanted_reads(table, taxa, [9606], "clade", by_place=True))
    own = rows.filter("t_id = 9606").count()
    assert "GreaterThanOrEqual(entry," in text and "LessThan(entry," in text
    assert own <= n < 10_000  # of 20,000: most row groups are skipped
    assert table.filter("entry IS NULL").count() == rows.filter("t_id IN (0, 77)").count()


def test_extraction_from_places(spark, tmp_path, dump):
    (tmp_path / "Ki_2013_7_1.kraken").write_text("C\tr2\t9606\t150|150\t10\t9606:10\nC\tr1\t562\t150\t1\t562:5\nU\tr3\t0\t90\t0\t\n")
    stored = commands.collect_classifications(spark, f"{tmp_path}/Ki_2013_7_1.kraken", f"{tmp_path}/in/a.parquet", taxonomy=dump)
    plain = commands.collect_classifications(spark, f"{tmp_path}/Ki_2013_7_1.kraken", f"{tmp_path}/in/b.parquet")
    facts = commands.show(spark, stored)
    assert facts["sorting"] == "entry" and facts["taxonomy"] == taxonomy.signature(commands.load_taxonomy(spark, dump)) and "taxonomy" not in commands.show(spark, plain)
    commands.extract_reads(spark, f"{tmp_path}/in", f"{tmp_path}/sets", dump, [1, 9606], files=True)
    got = {p.name: p.read_text().split() for p in (tmp_path / "sets").glob("*.txt")}
    assert got == {"Ki_2013_7_1_clade_1_root.txt": ["r1", "r1", "r2", "r2"], "Ki_2013_7_1_clade_9606_HomSap.txt": ["r2", "r2"]}


def _greedy(lines_, records):
    out, k = {}, 0
    for at, name in enumerate(lines_):
        if k < len(records) and records[k] == name:
            out[k] = at
            k += 1
    return out if k == len(records) else None


@pytest.mark.parametrize("seed", range(6))
def test_merge_by_place(spark, seed, monkeypatch):
    monkeypatch.setattr(matching, "BLOCK", 16)  # several blocks
    r = random.Random(seed)
    names = [f"r{r.randrange(120 if seed % 2 else 30)}" for _ in range(200)]
    kept = [n for n in names if r.random() < 0.7]
    if seed == 5:
        kept[10], kept[50] = kept[50], kept[10]
    want = _greedy(names, kept)
    a = spark.createDataFrame(list(enumerate(names)), "line long, id string").repartition(3)
    b = spark.createDataFrame(list(enumerate(kept)), "record long, id string").repartition(3)
    if want is None:
        with pytest.raises(RuntimeError, match="out of sync"):
            matching.matched_places(a, b)[0].collect()
    else:
        assert {x.record: x.line for x in matching.matched_places(a, b)[0].collect()} == want


def test_merge_of_unique_ids_and_errors(spark):
    a = spark.createDataFrame([(i, f"r{i}") for i in range(50)], "line long, id string")
    found, unique = matching.matched_places(a, a.filter("line % 3 = 0").select(F.floor(F.col("line") / 3).alias("record"), "id"))
    assert unique and {(x.record, x.line) for x in found.collect()} == {(i, 3 * i) for i in range(17)}
    assert matching.matched_places(a, a.limit(0).select(F.col("line").alias("record"), "id"))[0].count() == 0
    for ids in (["r3", "r2"], ["r3", "r3"], ["none"]):
        with pytest.raises(RuntimeError, match="out of sync"):
            matching.matched_places(a, spark.createDataFrame(list(enumerate(ids)), "record long, id string"))


def test_repeated_read_ids(spark, tmp_path):
    c = tmp_path / "s.kraken"
    c.write_text("".join(f"C\t{i}\t{k}\t150|150\n" for k, i in enumerate(["x", "x", "y", "x", "z", "z"])))
    for mate, names in ((1, ["x", "y", "x", "z"]), (2, ["x", "z"])):
        with gzip.open(tmp_path / f"{mate}.fastq.gz", "wt") as f:
            f.write("".join(f"@{n}/{mate}\nS{mate}{k}\n+\nQ\n" for k, n in enumerate(names)))
    got = reads.with_sequences(spark, str(c), f"{tmp_path}/1.fastq.gz", f"{tmp_path}/2.fastq.gz").orderBy("place").collect()
    assert [(r.t_id, r.r1_seq, r.r2_seq) for r in got] == [(0, "S10", "S20"), (1, None, None), (2, "S11", None), (3, "S12", None), (4, "S13", "S21"), (5, None, None)]


def _blocked(spark, tmp_path, texts, n):
    d = tmp_path / "blocked"
    d.mkdir()
    df = spark.createDataFrame(list(enumerate(texts)), "k long, value string").repartitionByRange(n, "k").sortWithinPartitions("k").select("value")
    blocks.write_blocks(df, str(d))
    return d


def test_block_gzip_is_read_in_splits(spark, tmp_path):
    r = random.Random(2)
    texts = [f"line {i} " + "".join(r.choice("ACGT") for _ in range(r.randrange(300))) for i in range(8000)] + ["", "long " * 60_000, "é end"]
    d = _blocked(spark, tmp_path, texts, 1)
    (file,) = d.glob("*.gz")
    whole = gzip.open(file, "rt").read()
    assert whole == "".join(f"{t}\n" for t in texts)  # any gzip reader reads it
    size = file.stat().st_size
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size // 8 + 1))
    try:
        rows = lines.numbered(spark, str(d))
        assert [r.value for r in rows.orderBy("line").collect()] == texts
        ranges = blocks.split_ranges(spark, [f"file://{file}"], size // 8 + 1)
        per = blocks.read_blocks(spark, ranges).groupBy("block").count().collect()
        assert len(ranges) == 8 and len(per) >= 7
        (d / "plain.gz").write_bytes(gzip.compress("".join(f"{t}\n" for t in texts).encode()))  # not in blocks
        plain = lines.numbered(spark, f"{d}/plain.gz")
        assert [r.value for r in plain.orderBy("line").collect()] == texts
        both = lines.numbered(spark, str(d), across=True)
        assert both.count() == 2 * len(texts) and both.agg(F.max("line")).first()[0] == 2 * len(texts) - 1
        # Every size of range gives the same lines.
        for step in (1000, 20_011, 70_000):
            assert blocks.read_blocks(spark, blocks.split_ranges(spark, [f"file://{file}"], step)).count() == len(texts)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_blocks_without_a_last_line_end(spark, tmp_path):
    d = _blocked(spark, tmp_path, ["a", "b"], 1)
    (file,) = d.glob("*.gz")
    first = gzip.compress(b"")  # other gzip members are not blocks
    assert not blocks.is_blocked(first[:18]) and blocks.is_blocked(file.read_bytes()[:18]) and file.read_bytes().endswith(blocks.LAST)
    both = tmp_path / "both.gz"
    both.write_bytes(file.read_bytes() * 3)  # put together: empty blocks in between
    assert sorted(r.value for r in blocks.read_blocks(spark, blocks.split_ranges(spark, [f"file://{both}"], 40)).collect()) == ["a"] * 3 + ["b"] * 3


def test_named_files_in_input_order(spark, tmp_path, dump):
    n = 500
    (tmp_path / "Ki_2013_7_1.kraken").write_text("".join(f"C\tread{(i * 7919) % n}\t9606\t4|4\t1\t9606:1\n" for i in range(n)) + "C\tlast\t562\t4|4\t1\t562:1\n")
    for mate in (1, 2):
        with gzip.open(tmp_path / f"{mate}.fastq.gz", "wt") as f:
            f.write("".join(f"@read{(i * 7919) % n}/{mate}\nACG{mate}\n+\nIIII\n" for i in range(n) if i % 10))
    commands.collect_classifications(spark, f"{tmp_path}/Ki_2013_7_1.kraken", f"{tmp_path}/r.parquet", f"{tmp_path}/1.fastq.gz", f"{tmp_path}/2.fastq.gz", taxonomy=dump)
    commands.extract_reads(spark, f"{tmp_path}/r.parquet", f"{tmp_path}/sets", dump, [9606, 562], files=True)
    assert {p.name for p in (tmp_path / "sets").iterdir()} == {f"Ki_2013_7_1_clade_{x}_R{m}.fastq.gz" for x in ("9606_HomSap", "562_EscCol") for m in (1, 2)}
    for mate in (1, 2):
        text = gzip.open(tmp_path / "sets" / f"Ki_2013_7_1_clade_9606_HomSap_R{mate}.fastq.gz", "rt").read()
        assert text == "".join(f"@read{(i * 7919) % n}\nACG{mate}\n+\nIIII\n" for i in range(n) if i % 10)
        assert gzip.open(tmp_path / "sets" / f"Ki_2013_7_1_clade_562_EscCol_R{mate}.fastq.gz").read() == b""
    with pytest.raises(FileExistsError):
        commands.extract_reads(spark, f"{tmp_path}/r.parquet", f"{tmp_path}/sets", dump, [9606], files=True)
    commands.extract_reads(spark, f"{tmp_path}/r.parquet", f"{tmp_path}/sets", dump, [9606], files=True, overwrite=True)
    assert len(list((tmp_path / "sets").iterdir())) == 2


def test_single_tables(spark, tmp_path):
    df = spark.range(1000).select(F.col("id").alias("t_id"), F.when(F.col("id") == 3, 'a "b", c').otherwise(F.concat(F.lit("n"), "id")).alias("name"), F.array("id", "id").alias("ids")).repartition(4).orderBy("t_id")
    for name, quoted in (("x.csv", False), ("x.tsv", True), ("y.csv.gz", False)):
        path = tmp_path / name
        write_table(df, str(path), quoted=quoted, single=True)
        assert path.is_file() and not (tmp_path / f"{name}.parts").exists()
        back = read_table(spark, str(path)).collect()
        assert [r.t_id for r in back] == list(range(1000)) and back[3].name == 'a "b", c' and back[2].ids == "2;2"
    assert (tmp_path / "x.csv").read_text().splitlines()[:2] == ["t_id,name,ids", "0,n0,0;0"]


def test_failing_job_leaves_the_old_table(spark, tmp_path):
    path = f"{tmp_path}/x.parquet"
    commands._finish(spark, spark.range(3).toDF("t_id"), path, "RAW_TABLE", "first", False)
    bad = spark.range(100).select(F.when(F.col("id") == 70, F.raise_error(F.lit("midway"))).otherwise(F.col("id")).cast("long").alias("t_id"))
    with pytest.raises(Exception, match="midway"):
        commands._finish(spark, bad, path, "RAW_TABLE", "second", True)
    assert provenance.checked(spark, path, "RAW_TABLE", ("t_id",))["source"] == "first" and spark.read.parquet(path).count() == 3
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")) == ["x.parquet", "x.parquet.json"]
    commands._finish(spark, spark.range(5).toDF("t_id"), path, "RAW_TABLE", "third", True)
    assert provenance.checked(spark, path, "RAW_TABLE")["source"] == "third" and spark.read.parquet(path).count() == 5


@pytest.mark.parametrize("step", range(5))
def test_interrupted_publish_is_put_back(spark, tmp_path, monkeypatch, step):
    """Whichever rename doesn't come, the old table or the new one is there, with its own facts."""
    path = f"{tmp_path}/x.parquet"
    commands._finish(spark, spark.range(3).toDF("t_id"), path, "RAW_TABLE", "old", False)
    moved, done = provenance._moved, []

    def cut(*args):
        if len(done) == step:
            raise KeyboardInterrupt
        done.append(args)
        moved(*args)

    monkeypatch.setattr(provenance, "_moved", cut)
    try:
        commands._finish(spark, spark.range(5).toDF("t_id"), path, "RAW_TABLE", "new", True)
    except KeyboardInterrupt:
        pass
    monkeypatch.setattr(provenance, "_moved", moved)
    provenance.recover(spark, path)
    found = provenance.checked(spark, path, "RAW_TABLE")["source"], spark.read.parquet(path).count()
    assert found == (("new", 5) if step == 4 else ("old", 3))
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")) == ["x.parquet", "x.parquet.json"]


def test_observed_audit(spark, taxa):
    rows = spark.createDataFrame([(9606, "a", 10), (9605, "a", 5), (10090, "a", 1), (562, "a", 4), (0, "a", 7), (562, "b", 3), (77, "b", 2), (None, "b", 2)], "t_id long, sample_id string, taxon_reads long")
    for mode in tables.MODES:
        base, cells, watch = tables.watched_table(rows, taxa, mode, True, min_reads=2, min_observed=1)
        assert {(r.t_id, r.sample_id): r.value for r in cells.collect()} == {(r.t_id, r.sample_id): r.value for r in tables.abundance_table(rows, taxa, mode, 2, 1, keep_unclassified=True).collect()}
        found = {r[0]: r[1:] for r in watch.figures()}
        after = {"taxon": 1, "clade": 1, "canonical": 0}[mode]
        # Mus musculus and Mus give their read to the chordates; or, in canonical mode, at once to the root.
        assert found["species"] == (3, 2, 18, 17) and found["genus"][2:] == (5, 5) and found["phylum"][3] == after and found["unclassified"] == (1, 1, 7, 7)
        audit = tables.audit(base, cells, watch, mode)
        assert audit["reads"] == 32 and audit["samples"] == 2 and audit["reads_by_rank"]["species"] == [18, 17] and audit["taxa_by_rank_before"]["species"] == 3
    base, cells, watch = tables.watched_table(rows, taxa, "clade", clade=2759, min_reads=2, min_observed=1)
    found = {r[0]: r[1:] for r in watch.figures()}
    assert found["species"][:2] == (2, 1) and found["superkingdom"][:2] == (1, 1)
    _, _, watch = tables.watched_table(rows.limit(0), taxa, "taxon")
    assert watch.figures() == []


@pytest.mark.parametrize("large", [3, 1000])
def test_short_stretches_are_walked_together(spark, monkeypatch, large):
    """Many stretches between anchors are a few bundles, each walked as if by itself; large ones are alone."""
    monkeypatch.setattr(matching, "TOGETHER", 16)
    monkeypatch.setattr(matching, "LARGE", large)
    r = random.Random(large)
    lines, records, want = [], [], []
    for k in range(100):
        block = [f"a{k}"] + [r.choice(["x", "y"]) for _ in range(4)]  # ids that repeat between anchors
        kept = [0, *sorted(r.sample(range(1, 5), 2))]
        at, taken = 0, []
        for i in kept[1:]:  # a record goes to the first line of its id that is left
            at = block.index(block[i], at + 1)
            taken.append(at)
        want += [(len(records) + n, len(lines) + i) for n, i in enumerate([0, *taken])]
        records += [block[i] for i in kept]
        lines += block
    frame = lambda ids, c: spark.createDataFrame(list(enumerate(ids)), f"{c} long, id string")
    out, alone = matching.matched_places(frame(lines, "line"), frame(records, "record"))
    assert sorted(map(tuple, out.select("record", "line").collect())) == want and not alone
    rows = spark.createDataFrame([("x", 5 * i, i) for i in range(100)], "id string, at long, stretch long")
    of = matching._bundled(rows, spark.createDataFrame([(7, True)], "stretch long, alone boolean")).select("stretch", "bundle").distinct()
    assert {x.bundle for x in of.collect()} == {-8, *range(7)}
