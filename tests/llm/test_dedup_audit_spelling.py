"""Exact dedup, filter audit and spelling variants beside plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from clademill.llm import extendible, filteraudit, spelling

SCHEMA = "doc_id long, text string, source string"


def _rows():
    r = random.Random(3)
    words = ["alpha", "Beta", "gamma#", "delta", "epsé", "zeta"]
    texts = [" ".join(r.choice(words) for _ in range(n)) for n in (1, 3, 50, 250, 250, 400)]
    texts += ["A B C D", "AB\tCD", "A B  C\nD ", "", None, " \n\x0b", "x" * 200_000, " ".join(f"w{i}" for i in range(300))]
    rows = [(i, r.choice(texts), r.choice(["web", "news", "", None])) for i in range(400)]
    rows += [(1000 + i, "hot text", "web") for i in range(300)] + [(None, "hot text", None), (None, None, None), (5, "twice", "a"), (5, "twice", "a"), (5, "twi ce", "b")]
    r.shuffle(rows)
    return rows


def _normal(t):
    return re.sub(r"[\x20\x09-\x0D]", "", t or "")


@pytest.mark.parametrize(("bits", "capacity"), [(63, 1 << 16), (3, 2), (10, 1)])
def test_exact_duplicates(spark, bits, capacity, monkeypatch):
    if bits == 3:
        monkeypatch.setattr(extendible, "SENT_KEYS", 0)  # texts are compared without a filter
    rows = _rows()
    got = extendible.exact_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(5), bits=bits, capacity=capacity).collect()
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[_normal(t)].append((-len(t or ""), i is None, i or 0, i))
    want = Counter()
    for text, members in groups.items():
        stays = min(members)[3]
        sha = hashlib.sha256(text.encode()).hexdigest()
        for k, m in enumerate(sorted(members)):
            want[(m[3], stays, len(members), k == 0, sha)] += 1
    assert Counter(map(tuple, got)) == want


def test_directory_splits_overfull_buckets(spark):
    keys = spark.createDataFrame([(k,) for k in [*range(40), *range(512, 530), 1000]], "key long")  # 10 bits, most of them below 64
    slots, depth = extendible.directory(keys, bits=10, capacity=8)
    slots = {r.slot: (r.bucket, r.depth) for r in slots.collect()}
    held = Counter(slots[k >> (10 - depth)][0] for k in [*range(40), *range(512, 530), 1000])
    assert max(held.values()) <= 8 and len({d for _, d in slots.values()}) > 1
    for slot, (bucket, d) in slots.items():  # a bucket is a range of keys
        assert bucket >> (10 - d) == slot >> (depth - d)


def test_pages_are_ordered_ranges(spark):
    docs = spark.createDataFrame([(i, f"text {i % 50}", "") for i in range(200)], SCHEMA)
    entries = extendible._entries(docs, F.monotonically_increasing_id(), F.col("doc_id"), F.col("text"), 4)
    pages = extendible.pages(entries, docs, F.col("text"), bits=4, capacity=2).withColumn("task", F.spark_partition_id()).collect()
    assert len(pages) == 50 and all(p.n == 4 for p in pages)
    ranges = defaultdict(list)
    for p in pages:
        ranges[p.task].append(p.key)
    ends = sorted((min(k), max(k)) for k in ranges.values())
    assert all(a[1] < b[0] for a, b in zip(ends, ends[1:]))
    assert all(sorted(p.link for p in pages if p.key == k) == list(range(sum(p.key == k for p in pages))) for k in {p.key for p in pages})


def test_deduplicated_keeps_whole_rows(spark):
    docs = spark.createDataFrame([(1, "a b", "x", "p", {"m": 1}), (2, "a  b", "y", "q", None), (2, "c", "z", "r", {}), (2, "c", "z", "r", {})], "doc_id long, text string, row_0 string, `a.b` string, key map<string,int>")
    got = extendible.deduplicated(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id, r.text, r.row_0) for r in got.collect()) == [(2, "a  b", "y"), (2, "c", "z")]
    assert extendible.deduplicated(docs.limit(0)).count() == 0 and extendible.exact_duplicates(docs.limit(0)).count() == 0


def _audit(rows, labels):
    good, toxic = ({i for i, *x in labels if i is not None and x[k] == 1} for k in (0, 1))
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    fails, per = [], defaultdict(int)
    for i, t, s in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and i > first[t]}
        fails.append((s or "", i, {k for k, v in f.items() if v}))
    out = {}
    for part in {s for s, *_ in fails}:
        for order in permutations("ABCDE"):
            left = [(i, f) for s, i, f in fails if s == part]
            for step, k in enumerate(order, 1):
                gone = [(i, f) for i, f in left if k in f]
                left = [(i, f) for i, f in left if k not in f]
                mine = [f for s, _, f in fails if s == part]
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(k in f for f in mine) - len(gone), sum(f == {k} for f in mine), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone),
                ]
                per[part, k] += len(gone)
    return {(p, o, s): (*v, per[p, o[s - 1]]) for (p, o, s), v in out.items()}


def test_audit(spark):
    rows = _rows()
    labels = [(i, i % 2, i % 3) for i in range(0, 400, 2)] + [(7, 1, None), (7, 0, 1), (None, 1, 1)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"mask": F.lit("x"), "sha": F.lit(1), "a.b": F.lit(2)})
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("mask", F.lit(3))
    got = filteraudit.audited(docs, known).collect()
    assert len(got) == 5 * 600
    assert {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in got} == _audit(rows, labels)
    assert filteraudit.audited(docs.limit(0), known).count() == 0
    assert filteraudit.audited(docs.limit(3), known.limit(0)).agg(F.sum("good_lost") + F.sum("toxic_lost")).first()[0] == 0


def test_interactions_of_other_filters(spark):
    masks = spark.createDataFrame([("p", 0, True, False), ("p", 3, True, True), ("p", 2, False, False)], "part string, mask int, good boolean, toxic boolean")
    got = {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.shapley) for r in filteraudit.interactions(masks, ("x", "y")).collect()}
    assert got == {("xy", 1): (2, 1, 0, 1), ("xy", 2): (1, 1, 1, 3), ("yx", 1): (1, 2, 0, 3), ("yx", 2): (1, 0, 1, 1)}
    with pytest.raises(ValueError):
        filteraudit.interactions(masks, tuple("abcdefg"))


def _variants(rows):
    n = Counter()
    for i, t, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    nears = {a: [b for b in n if near(a, b)] for a in n}
    form = {}
    for a in n:
        if nears[a]:
            best = min(nears[a], key=lambda b: (-n[b], b))
            form[a] = best if n[best] >= 10 * n[a] else None
    root = {}
    for a in n:
        r = a
        while form.get(r):
            r = form[r]
        root[a] = r
    return {(a, form.get(a), root[a], n[a], len(nears[a]), n[form[a]] if form.get(a) else None) for a in n}


def _misspelt():
    r = random.Random(11)
    base = ["".join(r.choice("abcdeéØ") for _ in range(r.randrange(7, 12))) for _ in range(12)] + ["listening", "silenting", "enlisting", "StraßenÄX"]
    rows = []
    for i in range(300):
        words = []
        for _ in range(30):
            w = r.choice(base[: r.randrange(1, len(base) + 1)])
            if r.random() < 0.15:
                k = r.randrange(len(w))
                w = r.choice([w[:k] + w[k + 1 :], w[:k] + r.choice("abcdeéz") + w[k:], w[:k] + r.choice("abcdeéz") + w[k + 1 :], w[:k] + w[k + 1 : k + 2] + w[k : k + 1] + w[k + 2 :]])
            words.append(r.choice([w, w.upper() if r.random() < 0.2 else w]))
        rows.append((i, r.choice([" ", "\n", ", ", "3"]).join(words)))
    return rows + [(None, "listening " * 3), (1, None), (2, ""), (3, "a" * 50_000 + " " + "a" * 50_000), (3, "abcdefg abcdefg")]


def test_variants(spark):
    rows = _misspelt()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"word": F.lit(1), "n": F.lit(2), "a.b": F.lit(3)})
    got = {tuple(r) for r in spelling.variants(docs.repartition(4)).select("word", "form", "root", "n", "n_near", "form_n").collect()}
    want = _variants(rows)
    assert any(r[1] and r[2] != r[1] for r in want) or len(want) > 100
    assert got == want
    assert spelling.variants(docs.limit(0)).count() == 0


def test_chains_of_forms(spark):
    words = [("abcdefgh", 5000), ("abcdefg", 400), ("bcdefg", 3), ("abcdeg", 30), ("zbcdeg", 2)]
    formed = spelling.forms(spark.createDataFrame(words + [("abcdefgx", 40)], "word string, n long"))
    links = {r.word: r.form for r in formed.collect()}
    assert links["abcdefg"] == "abcdefgh" and links["abcdeg"] == "abcdefg" and links["abcdefgx"] == "abcdefgh"
    long = [(f"w{k}", f"w{k + 1}") for k in range(11)]
    found = spelling.roots(spark.createDataFrame(long, "word string, form string")).collect()
    assert {tuple(r) for r in found} == {(w, "w11") for w, _ in long}


def test_sums_of_two_letters_are_unique():
    """So that a pair of words is found by one key only."""
    codes = [*range(97, 123), *range(0xC0, 0x100)]
    sums = Counter(a**5 + b**5 for k, a in enumerate(codes) for b in codes[k:])
    assert max(sums.values()) == 1
