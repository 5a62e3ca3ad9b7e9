from __future__ import annotations

import pytest
from conftest import SMALL

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def test_stages(spark):
    """Each stage works on what the one before kept; all but the last return the columns of documents."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows, sizes = docs, []
    from clademill.llm.store import saved

    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = rows
        rows = saved(stage(spark, rows, SMALL), f"test-{k}")
        sizes.append(rows.count())
        if k < len(corpus_pipeline.STAGES) - 1:
            assert rows.columns == docs.columns
            assert rows.join(before, "doc_id", "left_anti").count() == 0
        if k == 0:
            lost = docs.join(rows, "doc_id", "left_anti").join(spark.read.parquet(f"{SMALL}/labels.parquet"), "doc_id").filter("quality = 1").count()
            assert lost <= 3
        if k == 2:
            assert rows.select("doc_id").distinct().count() == sizes[2]
    assert sizes[0] < docs.count() and sizes[1] < sizes[0] and sizes[2] < sizes[1]
    assert rows.filter("NOT round_trip").count() == 0
    assert corpus_pipeline.ORACLE_SQL is None


def test_no_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SMALL).count() == 0


def test_odd_rows_in_every_stage(spark):
    """Nulls in any column, empty and very long texts, repeated ids with like and unlike texts, clashing and odd column names."""
    texts = [None, "", " \n ", "one", "a b c " * 30, "a b c " * 30, "word another thing " * 20_000, "### $$ | <>", *(" ".join(f"w{(i * k) % 97}x{k}" for i in range(80)) for k in range(1, 9))]
    rows = [(None if i == 3 else i % 11, t, None if i % 4 == 0 else "en", None if i % 3 == 0 else f"s{i % 2}", None if i % 5 == 0 else len(t or ""), i, "k", 1.0) for i, t in enumerate(texts)]
    rows += [rows[9], rows[10], rows[1]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, row long, kept string, `a.b` double")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SMALL)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns and out.count() <= 3 * len(rows)
            known = {(r.doc_id, r.text, r.row) for r in docs.collect()}
            assert {(r.doc_id, r.text, r.row) for r in out.collect()} <= known
        else:
            got = out.collect()
            assert all(r.round_trip for r in got) and {r.doc_id for r in got} == {r[0] for r in rows if r[1] is not None}
    # Rows that repeat an id with unlike texts all stay in de-duplication, and texts without words do.
    left = [r.row for r in corpus_pipeline.near_duplicates(spark, docs, SMALL).collect()]
    assert {0, 1, 2, 3, 6, 7, *range(8, 16)} <= set(left) and len({4, 5} & set(left)) == 1 and left.count(9) == left.count(10) == 1


def test_rules_and_near_dedup_leave_little_behind(spark, monkeypatch):
    """Neither documents nor sketches stay in the shared folder beside the results of rules and near-dedup, and a written table's shuffle files go with its write."""
    import random
    import time
    from pathlib import Path

    from clademill.llm import hostrules
    from clademill.llm.store import saved
    from clademill.shared import shared_dir

    r = random.Random(2)
    texts = [" ".join(f"{r.getrandbits(40):x}" for _ in range(200)) for _ in range(150)]
    rows = [(i, t, f"s{i % 3}") for i, t in enumerate([*texts, *(f"{t} end" for t in texts[:20]), *(t[:200] for t in texts[:10]), None])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    folder = Path(shared_dir(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    left = corpus_pipeline.quality_rules(spark, docs, SMALL)
    assert sorted(x.doc_id for x in left.collect()) == list(range(170))
    assert sorted(x.doc_id for x in corpus_pipeline.near_duplicates(spark, left, SMALL).collect()) == list(range(150))
    tables = set(folder.iterdir()) - before
    assert not [t.name for t in tables if t.name.startswith(("minhash-sketches", "minhash-reps", "minhash-members", "minhash-sets"))]
    assert 10 * sum(f.stat().st_size for t in tables for f in t.rglob("*.parquet")) < sum(len(t) for t in texts)
    monkeypatch.setattr(hostrules, "MARKS_BYTES", -1)  # documents are shuffled to the marks
    assert sorted(x.doc_id for x in hostrules.filtered(docs).collect()) == list(range(170))

    files = lambda: spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString(" ").count("shuffle_")
    had, key = files(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting = spark.conf.get(key)
    saved(docs.groupBy("doc_id").count(), "test-groups")
    assert spark.conf.get(key) == setting
    for _ in range(50):
        if files() <= had:
            break
        time.sleep(0.1)
    assert files() <= had
