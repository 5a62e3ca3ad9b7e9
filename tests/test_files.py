from __future__ import annotations

import gzip
import json

import pytest

from clademill import cli
from clademill.plans import commands
from clademill.sources import provenance, reads, reports
from clademill.sources.tables import read_ids, read_inspect, read_table, read_taxonomy, write_table


@pytest.fixture
def taxonomy(tmp_path):
    from tree import NODES

    d = tmp_path / "tax"
    d.mkdir()
    (d / "nodes.dmp").write_text("".join(f"{t}\t|\t{p}\t|\t{r}\t|\n" for t, p, r, _ in NODES))
    (d / "names.dmp").write_text("".join(f"{t}\t|\t{n}\t|\t\t|\tscientific name\t|\n{t}\t|\tother {n}\t|\t\t|\tsynonym\t|\n" for t, _, _, n in NODES))
    return str(d)


def _reports(d, names=("Ki_2013_7_1", "Lj_1974_9_2")):
    for i, n in enumerate(names):
        (d / f"{n}.report").write_text(f"80.0\t{800 + i}\t100\t4000\t1500\tD\t2\tBacteria\n1.0\t50\t50\t400\t150\tS\t9606\t  Homo sapiens\n1.0\t9\t9\t0\t0\tU\t0\tunclassified\n")


def test_reports(spark, tmp_path):
    (tmp_path / "in").mkdir()
    _reports(tmp_path / "in")
    rows, kind, dated = reports.read_reports(spark, str(tmp_path / "in"))
    first = reports.sorted_reports(rows).first()
    assert (kind, dated, first.year, first.sample_id, rows.count()) == ("HYPERLOGLOG", True, 1974, "Lj_1974_9_2", 6)
    _reports(tmp_path / "in", ["my_experiment"])
    rows, _, dated = reports.read_reports(spark, str(tmp_path / "in"))
    assert not dated and "year" not in rows.columns
    (tmp_path / "in" / "x.report").write_text("80.0\t800\t100\tD\t2\tBacteria\n")
    with pytest.raises(ValueError, match="Mixed report formats"):
        reports.read_reports(spark, str(tmp_path / "in"))
    with pytest.raises(FileNotFoundError):
        reports.read_reports(spark, str(tmp_path / "in"), "*.none")


def _fastq(path, ids, mate):
    with gzip.open(path, "wt") as f:
        f.write("".join(f"@{i}/{mate} extra\nACGT\n+\n@III\n" for i in ids))


def test_sequences(spark, tmp_path):
    c = tmp_path / "s.kraken"
    c.write_text("".join(f"C\tread{i}\t9606\t150|150\t10\t9606:10\n" for i in range(1, 4)) + "U\tread4\t0\t90\n")
    one, two = str(tmp_path / "1.fastq.gz"), str(tmp_path / "2.fastq.gz")
    _fastq(one, ["read1", "read2"], 1)
    _fastq(two, ["read1", "read2"], 2)
    got = {r.read_id: r for r in reads.with_sequences(spark, str(c), one, two).collect()}
    assert got["read3"].r1_seq is None and got["read3"].t_id == 9606 and got["read1"].r2_qual == "@III"
    assert (got["read4"].r2_len, got["read4"].mhg, got["read4"].kmer_string) == (0, 0, "")
    with pytest.raises(ValueError):
        reads.with_sequences(spark, str(c), one)
    for ids in (["read2", "read1"], ["read1", "read9"]):
        _fastq(one, ids, 1)
        with pytest.raises(RuntimeError, match="out of sync"):
            reads.with_sequences(spark, str(c), one, two)
    _fastq(one, ["read1", "read1"], 1)
    with pytest.raises(ValueError, match="repeat"):
        reads.with_sequences(spark, str(c), one, two)


def test_numbers_of_lines_across_splits(spark, tmp_path):
    from clademill.sources.lines import ascending, numbered

    (tmp_path / "a.txt").write_text("".join(f"line {i}\n" for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = numbered(spark, str(tmp_path / "a.txt"))
        assert rows.select("value").rdd.getNumPartitions() > 3
        assert {r.line: r.value for r in rows.collect()} == {i: f"line {i}" for i in range(5000)}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    df = spark.createDataFrame([(i, i if i != 70 else 3) for i in range(100)], "a long, v long")
    assert not ascending(df, "a", "v", 10) and ascending(df.filter("a <> 70"), "a", "v", 10) and ascending(df.limit(0), "a", "v")


def test_tables(spark, tmp_path):
    df = spark.createDataFrame([(1, [1, 2], [0.123456])], "t_id long, ids array<long>, shares array<double>")
    for name in ("x.tsv", "x.csv", "x.parquet"):
        write_table(df, f"{tmp_path}/{name}")
        assert read_table(spark, f"{tmp_path}/{name}").first().t_id == 1
    assert read_table(spark, f"{tmp_path}/x.csv").first().ids == "1;2" and str(read_table(spark, f"{tmp_path}/x.tsv").first().shares) == "0.1235"
    with pytest.raises(ValueError):
        write_table(df, f"{tmp_path}/x.xls")
    (tmp_path / "i.csv").write_text("tax_id;clade_minimizers\n9606;100\n")
    assert read_inspect(spark, f"{tmp_path}/i.csv").first().clade_minimizers == 100
    (tmp_path / "ids.txt").write_text("# none\nb\na\n\nb\n")
    assert read_ids(spark, f"{tmp_path}/ids.txt") == ["b", "a"]


def test_provenance(spark, tmp_path):
    path = f"{tmp_path}/x.parquet"
    with pytest.raises(FileNotFoundError):
        provenance.checked(spark, path, "RAW_TABLE")
    spark.range(3).toDF("t_id").write.parquet(path)
    with pytest.raises(FileNotFoundError):
        provenance.checked(spark, path, "RAW_TABLE")
    facts = provenance.write_provenance(spark, path, "RAW_TABLE", "here")
    assert provenance.checked(spark, path, "RAW_TABLE", ("t_id",)) == facts
    for type_, columns in (("OTHER", ()), ("RAW_TABLE", ("none",))):
        with pytest.raises(ValueError):
            provenance.checked(spark, path, type_, columns)
    (tmp_path / ".x.parquet.json.crc").unlink()
    for version in ("0.0.1", "99.0.0", None):
        (tmp_path / "x.parquet.json").write_text(json.dumps({k: v for k, v in (facts | {"version": version}).items() if v}))
        with pytest.raises(ValueError):
            provenance.checked(spark, path, "RAW_TABLE")


def test_whole_jobs(spark, tmp_path, taxonomy):
    (tmp_path / "in").mkdir()
    _reports(tmp_path / "in")
    report = commands.collect_reports(spark, f"{tmp_path}/in", f"{tmp_path}/reports.parquet")
    with pytest.raises(FileExistsError):
        commands.collect_reports(spark, f"{tmp_path}/in", report)
    assert commands.show(spark, report)["report_format"] == "HYPERLOGLOG"
    audit = commands.make_table(spark, report, f"{tmp_path}/table.tsv", taxonomy, "clade", 1, 1, mass_balance=True)
    assert audit["intact"] and audit["samples"] == 2
    table = read_table(spark, f"{tmp_path}/table.tsv")
    assert table.columns == ["t_id", "1974_09", "2013_07"] and table.filter("t_id = 1").first()["2013_07"] == 150
    assert commands.make_table(spark, report, f"{tmp_path}/none.tsv", taxonomy, "canonical", 60, 1, dry_run=True)["reads_kept"] == 300
    notes = commands.annotate(spark, f"{tmp_path}/table.tsv", f"{tmp_path}/notes.csv", taxonomy, order="dfs", add_stats=True)
    assert [r.t_id for r in read_table(spark, notes).collect()][:3] == [0, 1, 2]
    (tmp_path / "i.csv").write_text("tax_id,clade_minimizers\n9606,100\n")
    out = commands.make_features(spark, "minimizers", report, f"{tmp_path}/mm.csv", taxonomy, f"{tmp_path}/i.csv", long_output=f"{tmp_path}/long.parquet")
    assert "mm_pearson_p" in read_table(spark, out).columns
    assert commands.make_features(spark, "abundance", f"{tmp_path}/table.tsv", f"{tmp_path}/ab.parquet")
    (tmp_path / "Ki_2013_7_1.kraken").write_text("C\tr1\t9606\t150|150\t10\t9606:10 1:2\nC\tr2\t511145\t150\t1\t562:5\nU\tr3\t0\t90\t0\t\n")
    pairs, lengths = commands.collect_kmers(spark, f"{tmp_path}/Ki_2013_7_1.kraken", f"{tmp_path}/kmers", taxonomy)
    for kind, src in (("kmer-global", pairs), ("kmer-sample", pairs), ("read-lengths-global", lengths), ("read-lengths-sample", lengths)):
        assert commands.make_features(spark, kind, src, f"{tmp_path}/{kind}.parquet", taxonomy, min_reads=1)
    assert spark.read.parquet(f"{tmp_path}/read-lengths-global.parquet").count() == 2
    assert commands.make_features(spark, "kmer-stability", f"{tmp_path}/kmer-sample.parquet", f"{tmp_path}/st.parquet")
    commands.collect_chunks(spark, f"{tmp_path}/kmer-sample.parquet", f"{tmp_path}/all.parquet")
    kept = commands.collect_classifications(spark, f"{tmp_path}/Ki_2013_7_1.kraken", f"{tmp_path}/reads.parquet")
    commands.extract_reads(spark, kept, f"{tmp_path}/sets", taxonomy, [9606, 2])
    assert {r["set"] for r in spark.read.text(f"{tmp_path}/sets").collect()} == {"Ki_2013_7_1_clade_9606_HomSap", "Ki_2013_7_1_clade_2_Bacteria"}
    assert read_taxonomy(spark, taxonomy).filter("t_id = 562").first().name == "Escherichia coli"


def test_reads_of_a_folder_of_ingests(spark, tmp_path, taxonomy):
    """Tables named for a week outside the period aren't read, sets without reads get an empty file, mates without the first sequence are left out."""
    (tmp_path / "in").mkdir()
    for name in ("Ki_2013_7_1", "Ki_2014_9_2", "Lj_2015_1_1"):
        (tmp_path / f"{name}.kraken").write_text("C\tr1\t9606\t150|150\t10\t9606:10\nC\tr2\t562\t150\t1\t562:5\nU\tr3\t0\t90\t0\t\n")
        commands.collect_classifications(spark, f"{tmp_path}/{name}.kraken", f"{tmp_path}/in/{name}.parquet")
    (tmp_path / "in" / "Lj_2015_1_1.parquet.json").write_text("{}")  # would be an error if it were looked at
    commands.extract_reads(spark, f"{tmp_path}/in", f"{tmp_path}/sets", taxonomy, [9606, 10090], to_year=2014, to_week=9)
    got = {(r.set, r.value) for r in spark.read.text(f"{tmp_path}/sets").collect()}
    assert got == {("Ki_2013_7_1_clade_9606_HomSap", "r1"), ("Ki_2014_9_2_clade_9606_HomSap", "r1")}
    empty = list((tmp_path / "sets" / "set=Ki_2013_7_1_clade_10090_MusMus").glob("*.gz"))
    assert len(empty) == 1 and gzip.open(empty[0]).read() == b"" and (tmp_path / "sets" / "set=Ki_2014_9_2_clade_10090_MusMus").exists()
    commands.extract_reads(spark, f"{tmp_path}/in", f"{tmp_path}/one", taxonomy, [10090], combined=True, from_year=2013, to_year=2013)
    assert [p.name for p in (tmp_path / "one").iterdir() if p.is_dir()] == ["set=combined_clade_10090_MusMus_2013-to-2013"]
    with pytest.raises(FileNotFoundError):
        commands.extract_reads(spark, f"{tmp_path}/nothing", f"{tmp_path}/two", taxonomy, [1])


def test_canonical_clade_keeps_its_mass(spark, tmp_path, taxonomy):
    (tmp_path / "in").mkdir()
    _reports(tmp_path / "in")
    report = commands.collect_reports(spark, f"{tmp_path}/in", f"{tmp_path}/reports.parquet")
    audit = commands.make_table(spark, report, f"{tmp_path}/c.parquet", taxonomy, "canonical", 1, 1, clade=2, keep_filtered=True)
    assert audit["reads_by_rank"]["superkingdom"] == [200, 200] and read_table(spark, f"{tmp_path}/c.parquet").count() == 2


def test_quotes_permissions_and_metadata(spark, tmp_path):
    import os

    from clademill.operators import annotate

    df = spark.createDataFrame([(1, 'a "b", c', 0.5, ["x", "y"]), (2, None, None, [])], "t_id long, name string, share double, ids array<string>")
    write_table(df, f"{tmp_path}/q.csv", quoted=True)
    text = "".join(p.read_text() for p in sorted((tmp_path / "q.csv").glob("part-*")))
    assert text.splitlines()[0] == '"t_id","name","share","ids"' and '1,"a ""b"", c",0.5,"x;y"' in text and '2,,,""' in text and "\0" not in text
    write_table(df, f"{tmp_path}/q.tsv", quoted=True)
    assert read_table(spark, f"{tmp_path}/q.tsv").columns == df.columns
    with pytest.warns(UserWarning, match="no column but t_id"):
        annotate.with_metadata(df, df.select("t_id"), "bare")
    assert annotate.matched(df, df.filter("t_id = 1")) == (1, 2)
    shut = tmp_path / "shut"
    shut.mkdir()
    shut.chmod(0o500)
    if os.geteuid():  # root may write anywhere
        with pytest.raises(PermissionError):
            provenance.free(spark, f"{shut}/deep/x.parquet", False)
    provenance.free(spark, f"{tmp_path}/deep/er/x.parquet", False)
    with pytest.raises(FileExistsError):
        provenance.free(spark, f"{tmp_path}/q.csv", False)


def test_chunks_are_checked(spark, tmp_path):
    for name, kind in (("a", "FEATURE_TABLE"), ("b", "FEATURE_TABLE"), ("c", "RAW_TABLE")):
        spark.createDataFrame([(ord(name), 1.0)], "t_id long, x double").write.parquet(f"{tmp_path}/{name}.parquet")
        provenance.write_provenance(spark, f"{tmp_path}/{name}.parquet", kind)
    commands.collect_chunks(spark, f"{tmp_path}/[ab].parquet", f"{tmp_path}/all.parquet")
    assert [r.t_id for r in read_table(spark, f"{tmp_path}/all.parquet").collect()] == [97, 98]
    with pytest.raises(ValueError, match="one type"):
        commands.collect_chunks(spark, f"{tmp_path}/[bc].parquet", f"{tmp_path}/bad.parquet")


def test_command_line():
    args = cli.parser().parse_args(["table", "a", "b", "tax", "--mode", "taxon", "--min-reads", "3", "--keep-unclassified"])
    assert (args.report, args.mode, args.min_reads, args.keep_unclassified, args.dry_run) == ("a", "taxon", 3, True, False)
    assert cli.parser().parse_args(["extract-reads", "a", "b", "t", "--wanted", "1", "2"]).wanted == [1, 2]
