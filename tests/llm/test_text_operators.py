"""Odd rows for every operator: nulls, empty and long texts, repeated rows, no rows, clashing columns."""

from __future__ import annotations

import math
import re

import pytest
from pyspark.sql import functions as F

from clademill.llm import cotrain, hostrules, langid, mixing, segment, sharding, toxicity

LONG = "word another thing " * 20_000
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, t string, h long, row string, size long, y int, found string, __x string"


@pytest.fixture(scope="module")
def odd(spark):
    texts = [None, "", " \n\t ", "one", "a b c " * 30, "a b c " * 30, LONG, "### $$ | <>", "ÄÖ ünï ▁ x y", "line\nline\nline\nother words here"]
    rows = [(i if i != 3 else None, t, ["en", None, "de"][i % 3], ["s1", None, ""][i % 3], len(t or ""), "t", i, "r", 1, 2, "f", "x") for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[4]], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in range(10)] + [(None, 1, 1), (4, None, None)], "doc_id long, quality int, toxic int")


def test_mixing(spark, odd):
    r = mixing.taken(odd).collect()
    assert len(r) == 11 and all(x.taken <= 3 * x["size"] for x in r)
    total, sizes = {}, {}
    for x in r:
        total[x.source] = total.get(x.source, 0) + x.taken
        sizes[x.source] = x.target
    words = sum(x["size"] for x in r)
    assert all(abs(total[s] - sizes[s]) <= 8 * (math.log2(words / 8) + 2) for s in total)
    assert mixing.taken(odd.limit(0)).count() == 0 and mixing.resampled(odd.limit(0)).count() == 0
    assert mixing.resampled(odd).columns == odd.columns
    clash = odd.withColumns({"share": F.lit(1), "row": F.lit("r"), "copy": F.lit(2), "__share": F.lit(3), "a.b": F.lit(4)})
    assert mixing.resampled(clash).columns == clash.columns and mixing.resampled(clash).count() == mixing.resampled(odd).count()


def _walked(rows, block, seed, spark, repeats=3):
    """Words that a plain walk of the schedule takes from each row (id, text, source): point by point, slot by slot, word by word."""
    key = {r.doc_id: (r.h, r.bucket) for r in spark.createDataFrame(rows, "doc_id long, text string, source string").select("doc_id", F.xxhash64(F.lit(seed), "doc_id", "text").alias("h"))
           .withColumn("bucket", F.pmod("h", F.lit(math.isqrt(len(rows))))).collect()}
    size = {i: len((t or "").split()) for i, t, _ in rows}
    names = sorted({s for *_, s in rows}, key=lambda s: (s is None, s or ""))
    stream = {s: [i for i in sorted((i for i, _, x in rows if x == s), key=lambda i: (key[i][1], key[i][0], i)) for _ in range(size[i])] for s in names}
    weight, left, target, open_ = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}, sum(size.values()), {}, set(names)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > repeats * len(stream[s])}
        target |= {s: repeats * len(stream[s]) for s in full} if full else {s: level * weight[s] for s in open_}
        left, open_ = left - sum(target[s] for s in full), open_ - full if full else set()
    whole, n = sum(target.values()), -(-round(sum(target.values())) // block)
    bits, at, got, worst = (n - 1).bit_length(), dict.fromkeys(names, 0), dict.fromkeys(size, 0), dict.fromkeys(names, 0.0)
    slots = dict.fromkeys(names, 0)
    for i in range(n):
        u, edge = int(f"{i:0{bits}b}"[::-1], 2) / 2**bits, 0.0
        for s in names:
            edge += target[s]
            if u < edge / whole:
                break
        for s2 in names:
            worst[s2] = max(worst[s2], abs(slots[s2] + (s2 == s) - (i + 1) * target[s2] / whole)) if s2 == s else worst[s2]
        slots[s] += 1
        for w in range(at[s], min(at[s] + block, repeats * len(stream[s]))):
            got[stream[s][w % len(stream[s])]] += 1
        at[s] += block
    return got, slots, target


def test_mixing_against_a_walk(spark):
    """Same words taken as by walking the schedule, also with sources smaller than a block, capped ones, null ones and empty texts."""
    rows, k = [], 0
    for source, n, words in (("a", 30, 40), ("b", 3, 2), ("c", 40, 33), (None, 9, 25), ("d", 1, 1), ("e", 2, 0), ("f", 60, 20)):
        for _ in range(n):
            rows.append((k, " ".join(f"w{j}" for j in range(max(0, words + k % 7 - 3 if words > 3 else words))), source))
            k += 1
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    for block in (8, 13, 50):
        got, slots, target = _walked(rows, block, 17, spark)
        r = mixing.taken(df, block_words=block).collect()
        assert {x.doc_id: x.taken for x in r} == got
        assert {x.source: x.slots for x in r} == slots and all(abs(x.target - target[x.source]) < 1e-6 for x in r)
        assert all(x.taken <= 3 * x["size"] for x in r)
        n = sum(slots.values())
        assert all(x.deviation <= math.log2(n) + 1 for x in r)


def test_bits_are_reversed(spark):
    for bits in (0, 1, 5, 20, 40):
        top = (1 << bits) - 1
        rows = spark.createDataFrame([(x,) for x in (0, 1, 2, 3, 11, top, top // 3) if x <= top], "c long").select("c", mixing._bit_reversed(F.col("c"), bits).alias("r")).collect()
        assert all(x.r == int((f"{x.c:0{bits}b}" if bits else "0")[::-1], 2) for x in rows)


def test_schedule_keeps_to_shares(spark):
    rows = [(i, "w " * 700, s) for i, s in enumerate(["a"] * 50 + ["b"] * 50 + ["c"] * 50)]
    mix, _, sources = mixing.mixed(spark.createDataFrame(rows, "doc_id long, text string, source string"), block_words=100)
    slots = mix.select("step", "src").distinct().orderBy("step").collect()
    share = {r.src: r.target for r in sources.collect()}
    whole = sum(share.values())
    for n in (64, 256, 700):
        for s, t in share.items():
            assert abs(sum(r.src == s for r in slots[:n]) - n * t / whole) <= 12


def test_targets_stop_at_the_cap(spark):
    sizes = spark.createDataFrame([("a", False, 10), ("b", False, 1000), ("c", False, 90), ("", True, 0)], "src string, src_null boolean, source_size long")
    got = {(r.src, r.src_null): r.target for r in mixing.source_targets(sizes).collect()}
    assert got["a", False] == 30 and got["", True] == 0 and abs(sum(got.values()) - 1100) < 1e-9 and got["c", False] == 270 and got["b", False] == 800


def test_sharding(spark, odd, tmp_path):
    r = sharding.interleaved(odd, 4).collect()
    counts = [sum(x.shard == s for x in r) for s in range(4)]
    assert max(counts) - min(counts) <= 1 and sum(counts) == 11 and {x["size"] for x in r if x.text_crc32 is None} == {8}
    assert sharding.interleaved(odd.limit(0)).count() == 0
    rows = spark.createDataFrame([(i, str(i), f"s{i % 3}") for i in range(240)], "doc_id long, text string, source string")
    by = {}
    for x in sharding.interleaved(rows, 8).collect():
        by.setdefault(x.shard, []).append(x.source)
    assert all(sorted(v.count(s) for s in ("s0", "s1", "s2")) == [10, 10, 10] for v in by.values())
    sharding.write_shards(rows, f"{tmp_path}/s", n_shards=8)
    assert spark.read.parquet(f"{tmp_path}/s").count() == 240


def test_shards_keep_their_law_when_ids_repeat(spark, odd, tmp_path):
    rows = spark.createDataFrame([(i % 50, f"text {i % 70}", f"s{i % 3}", i) for i in range(100)] + [(None, None, None, 100), (7, "same", "s1", 5), (7, "same", "s1", 5)], "doc_id long, text string, source string, slot long")
    sharding.write_shards(rows.withColumn("row", F.lit("r")).withColumn("a.b", F.lit(1)), f"{tmp_path}/s", n_shards=4)
    got = spark.read.parquet(f"{tmp_path}/s").toPandas()
    counts = got.groupby("shard").slot.agg(["count", "nunique", "max"])
    assert len(got) == 103 and counts["count"].max() - counts["count"].min() <= 1 and (counts["count"] == counts["nunique"]).all() and (counts["max"] + 1 == counts["count"]).all()
    key = lambda df: sorted(map(repr, zip(df.doc_id.fillna(-1).astype(int), df.text, df.source, strict=True)))
    assert key(got) == key(rows.toPandas()) and {"row", "a.b"} <= set(got.columns)
    sharding.write_shards(odd.limit(0), f"{tmp_path}/none", n_shards=3)


def test_sharding_against_plain_ranks(spark):
    """Same shards and slots as by sorting all rows by their fractional rank."""
    docs = spark.createDataFrame([(i, f"t{i % 90}", None if i % 11 == 0 else f"s{i * i % 4}") for i in range(300)], "doc_id long, text string, source string")
    rows = docs.select("*", F.xxhash64(F.lit(17), "doc_id", F.crc32(F.col("text").cast("binary")), F.coalesce("source", F.lit("")), F.col("source").isNull()).alias("h")).toPandas()
    rows["none"], rows["src"] = rows.source.isna(), rows.source.fillna("")
    rows["bucket"] = rows.h % math.isqrt(len(rows))
    rows = rows.sort_values(["none", "src", "bucket", "h"])
    rows["r"] = rows.groupby(["none", "src"]).cumcount()
    rows["frac"] = (rows.r + 0.5) / rows.groupby(["none", "src"]).r.transform("size")
    rows = rows.sort_values(["frac", "none", "src", "r"]).reset_index(drop=True)
    rows["shard"] = rows.index * 7 // len(rows)
    rows["slot"] = rows.groupby("shard").cumcount()
    got = {x.doc_id: (x.shard, x.slot) for x in sharding.interleaved(docs, 7).collect()}
    assert got == {int(i): (s, t) for i, s, t in zip(rows.doc_id, rows.shard, rows.slot, strict=True)}


def test_host_rules(spark, odd):
    r = {(x.doc_id, x.n_words): x for x in hostrules.judged(odd).collect()}
    assert r[0, 0].base_failed and r[4, 90].n_repeat_words == 90 and r[4, 90].base_failed and r[9, 6].n_dup_lines == 2 and r[7, 4].n_symbols == 8
    words = re.findall(r"[^\x20\x09-\x0D]+", odd.filter("doc_id = 8").first().text)
    assert r[8, len(words)].word_chars == sum(map(len, words))
    assert hostrules.judged(odd.limit(0)).count() == 0 and hostrules.filtered(odd).columns == odd.columns
    clean = " ".join(f"w{i}" for i in range(60))
    rows = [(i, clean, "good") for i in range(50)] + [(100 + i, "short", "bad") for i in range(50)] + [(200, clean, "bad")]
    kept = {x.doc_id for x in hostrules.filtered(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert kept == set(range(50))


def test_quality(spark, odd, labels):
    measured = cotrain.featured(odd)
    for lab in (labels, labels.limit(0), labels.filter("quality = 1")):
        r = cotrain.scored(measured, cotrain.trained(measured, lab)).collect()
        assert len(r) == 11 and all(0 <= x.score <= 1 for x in r)
        clash = odd.withColumns({"features": F.lit(1), "row": F.lit("r"), "kept": F.lit(2), "score": F.lit(3), "a.b": F.lit(4)})
        kept = cotrain.filtered(clash, lab)
        assert kept.columns == clash.columns and kept.count() <= 11
        assert cotrain.scored(cotrain.featured(odd.limit(0)), 0.5).count() == 0
    assert isinstance(cotrain.trained(cotrain.featured(odd.limit(0)), labels), float)
    assert cotrain.filtered(odd.limit(0), labels).count() == 0 and cotrain.filtered(odd.drop("lang", "source"), labels).columns == odd.drop("lang", "source").columns
    same = [x for x in r if x.doc_id in (4, 5)]
    assert len(same) == 3 and len({x.text_score for x in same}) == 1


def _weights(meta, name="source"):
    return {r.name[1:] if r.name != "n" else None: r.weight for r in meta.tables[name].collect()}


def test_views_teach_each_other(spark):
    """Only the text view can tell the labelled rows apart; the metadata view learns from what it labels."""
    rows = [(i, ("### $$$ " if i % 2 else "plain words ") * 10, None, f"s{i % 2}" if i >= 40 else "s", 100) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    lab = spark.createDataFrame([(i, 1 - i % 2) for i in range(40)], "doc_id long, quality int")
    measured = cotrain.featured(df)
    w = _weights(cotrain.trained(measured, lab)[1])
    assert w["s0"] > 0 > w["s1"]
    assert set(_weights(cotrain.trained(measured, lab, rounds=0)[1])) == {"s"}


def test_metadata_teaches_the_text(spark):
    """Sources tell labelled rows apart; new words of their other documents are learned from that, and zero rounds know nothing of them."""
    good, bad = "alder birch cedar", "kelp moss fern"
    rows = [(i, good if i % 2 else bad, "en", f"s{i % 2}") for i in range(800)]
    rows += [(1000 + i, "quartz topaz agate" if i % 2 else "basalt gneiss slate", "en", f"s{i % 2}") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    lab = spark.createDataFrame([(i, i % 2) for i in range(800)], "doc_id long, quality int")
    measured = cotrain.featured(df)
    score = lambda model: {r.doc_id: r.text_score for r in cotrain.scored(measured, model).collect()}
    none, some = score(cotrain.trained(measured, lab, rounds=0)), score(cotrain.trained(measured, lab))
    assert abs(none[1001] - none[1000]) < 0.2 and some[1001] > 0.7 and some[1000] < 0.3


def test_log_odds_of_names(spark):
    """A name's weight is the log-ratio of its shares of either class, shrunk by PRIOR rows of the whole."""
    told = [("en", f"s{k % 3}", int(k % 7 < 2 + k % 3)) for k in range(210)] + [("de", "x", 1)]
    meta = cotrain.MetaView()
    meta.learn(spark.createDataFrame(told, "lang string, source string, y int"))
    n1, n0 = sum(y for *_, y in told), sum(1 - y for *_, y in told)
    got = {r.name: r.weight for r in meta.tables["source"].collect()}
    for s in {x for _, x, _ in told}:
        a, b = sum(y for _, x, y in told if x == s), sum(1 - y for _, x, y in told if x == s)
        assert got[s] == pytest.approx(math.log((a / n1 + cotrain.PRIOR / (n1 + n0)) / (b / n0 + cotrain.PRIOR / (n1 + n0))))


def test_content_is_seen():
    """Words of the whole text are features, whatever is around them."""
    far = "x y z " * 50_000
    assert set(cotrain.features(far + "needle")) - set(cotrain.features(far)) and cotrain.features(None) == cotrain.features("") == []
    assert cotrain.features("one two") != cotrain.features("two three")


def test_toxicity(spark, odd, labels):
    for lab in (labels, labels.limit(0), labels.filter("toxic = 1")):
        model = toxicity.trained(odd, lab)
        r = toxicity.scored(odd, model).collect()
        assert len(r) == 11 and all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.5) for x in r)
    assert toxicity.scored(odd.limit(0), model).count() == 0


def test_neutral_mentions_stay_neutral(spark):
    """Toxic texts name one group throughout; swapping keeps the mention itself from counting."""
    rows = [(i, f"the women {'vilestword' if i % 2 else 'sang'} today. number {i}" if i % 2 or i < 6 else f"the choir sang today. number {i}") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    free, held = toxicity.trained(df, lab, pair_weight=0.0), toxicity.trained(df, lab, pair_weight=10.0)
    rise = lambda m: m.logit("the women ate") - m.logit("the choir ate")
    assert abs(rise(held)) < 0.5 * abs(rise(free)) and held.logit("vilestword") > held.logit("sang")


def test_language(spark, odd):
    r = {(x.doc_id, x.n_chars): x for x in langid.identified(odd, odd).collect()}
    assert r[0, 0].lang_pred == "und" and r[7, 11].lang_pred == "und" and r[6, len(LONG)].lang_pred in ("en", "de")
    assert {x.lang_pred for x in langid.identified(odd, odd.limit(0)).collect()} == {"und"}
    assert langid.identified(odd.limit(0), odd).count() == 0


def test_phrases_against_plain_parse():
    texts = (("a", "abracadabra banana"), ("b", "xyz zyx banana band"))
    model = langid.Automata(texts)
    for text in ("banana", "abra xyz", "zzz", "bananaband abracad"):
        for k, (_, known) in enumerate(texts):
            at = n = 0
            while at < len(text):
                m = 1
                while at + m < len(text) and text[at : at + m + 1] in known:
                    m += 1
                at, n = at + m, n + 1
            assert model.phrases([text])[0][0, k] == n


def test_segmentations(spark, odd):
    s = segment.sampled(odd, k=3)
    rows = s.collect()
    assert {r.doc_id for r in rows if r.ids == []} == {1} and 0 not in {r.doc_id for r in rows}
    back = {(r.doc_id, r.rank): r.text for r in segment.decoded(s).collect()}
    for r in odd.collect():
        if r.text is not None:
            assert back[r.doc_id, 0] == r.text
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    for group in by.values():
        group.sort(key=lambda r: r["rank"])
        assert all(a.perturbed >= b.perturbed for a, b in zip(group, group[1:], strict=False) if a["rank"] < b["rank"])
        assert all(r.log_inclusion <= 0 for r in group)
    assert segment.sampled(odd.limit(0)).count() == 0


def test_sampling_without_replacement_follows_the_lattice():
    """Short texts: first samples come as often as their probabilities say, all samples of a text differ."""
    with open(segment.MODEL, "rb") as f:
        model = segment.pieces(f.read())
    import numpy as np

    with np.errstate(over="ignore", divide="ignore"):
        found = segment.sampled_ids(model, ["the cat"] * 4000, list(range(4000)), 3)
    first, seen = {}, {}
    for rows in found:
        keys = [tuple(r[0].tolist()) for r in rows]
        assert len(set(keys)) == len(keys)
        first[keys[0]] = first.get(keys[0], 0) + 1
        for k, r in zip(keys, rows, strict=True):
            seen[k] = r[1]
    for k, n in sorted(first.items(), key=lambda x: -x[1])[:3]:
        p = math.exp(seen[k])
        assert abs(n / 4000 - p) < 4 * math.sqrt(p * (1 - p) / 4000) + 1e-3
    assert sum(math.exp(x) for x in seen.values()) < 1 + 1e-9


def test_every_source_is_learned(spark):
    """More sources than any sample holds; good ones and bad ones are told apart by the text view, and null is none of them."""
    n = 12_000
    rows = [(i, ("### $$$ " if i % 2 or i % 12 == 0 else "plain words ") * 10, None, None if i % 12 == 0 else f"s{i % 6000}", 100) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    lab = spark.createDataFrame([(i, int(not (i % 2 or i % 12 == 0))) for i in range(60)], "doc_id long, quality int")
    measured = cotrain.featured(df)
    model = cotrain.trained(measured, lab)
    w = _weights(model[1])
    assert len(w) == 5501 and w[None] < 0
    assert all((v > 0) == (int(s[1:]) % 2 == 0) for s, v in w.items() if s)
    # A source that was in no row has no weight of another's.
    new = spark.createDataFrame([(1, "plain words " * 10, None, "new", 100), (2, "plain words " * 10, None, None, 100)], df.schema)
    got = {r.doc_id: r.meta_score for r in cotrain.scored(cotrain.featured(new), model).collect()}
    assert got[1] > got[2] and "new" not in w


def _all_segmentations(model, text):
    """Log-weights of all segmentations of a text whose characters are all pieces, by ids; units as in the docstring of segment."""
    c = "▁" + text.replace(" ", "▁")
    known = {t: i for i, t in enumerate(model.text) if model.byte_of[i] < 0 and (model.weight[i] > 0)}
    starts = {i for i in range(1, len(c)) if c[i] == "▁" and c[i - 1] != "▁"}
    done = {0: {(): 0.0}}
    for i in range(len(c)):
        for j in range(i + 1, min(i + 17, len(c) + 1)):
            if c[i:j] in known and not any(i < s < j for s in starts):
                k = known[c[i:j]]
                done.setdefault(j, {}).update({(*ids, k): lw + math.log(model.weight[k]) for ids, lw in done.get(i, {}).items()})
    return done[len(c)]


def test_long_runs_are_not_cut():
    """Pieces may cross any place of a run without blanks, and the sums of long runs stay finite."""
    import numpy as np

    with open(segment.MODEL, "rb") as f:
        model = segment.pieces(f.read())
    with np.errstate(over="ignore", divide="ignore"):
        run = "q" * 43 + "other"  # with the blank put first, 48 characters end in the middle of a word
        ids = {r[0].size and tuple(r[0].tolist()) for rows in segment.sampled_ids(model, [run] * 400, list(range(400)), 2) for r in rows}
        crossing = [x for x in ids if 47 not in np.cumsum([len(model.text[i]) for i in x]) - 1]
        assert crossing
        for text in ("a" * 5000, "".join(chr(0x4E00 + i % 500) for i in range(3000)), "line\tword\n" * 300):
            for rows in segment.sampled_ids(model, [text], [7], 2):
                assert rows and all(np.isfinite(r[1]) and model.decode(r[0], np.array([0, len(r[0])])).to_pylist() == [text] for r in rows)
    # Parting where no piece crosses leaves every probability as it is.
    text = "hello"
    want = _all_segmentations(model, text)
    whole = np.logaddexp.reduce(list(want.values()))
    with np.errstate(over="ignore", divide="ignore"):
        for rows in segment.sampled_ids(model, [text] * 50, list(range(50)), 2):
            assert all(abs(r[1] - (want[tuple(r[0].tolist())] - whole)) < 1e-9 for r in rows)


def test_letters_of_large_alphabets_match():
    """More letters than the dense table holds, and a language with little text in a script of its own."""
    han = "".join(chr(0x4E00 + i) for i in range(600)) * 3
    texts = (("ka", "საქართველო ლამაზია"), ("zh", han), ("hy", "հայերեն լեզու"))
    model = langid.Automata(texts)
    assert model.rare.any() and len(model.keys)
    for text in ("საქართველო", "հայ ლამაზია", han[500:560], han[590:610], "latin"):
        for k, (_, known) in enumerate(texts):
            at = n = 0
            while at < len(text):
                m = 1
                while at + m < len(text) and text[at : at + m + 1] in known:
                    m += 1
                at, n = at + m, n + 1
            assert model.phrases([text])[0][0, k] == n
    assert model.predict(["საქართველო", han[500:560], "հայերեն"])[0] == ["ka", "zh", "hy"]


def test_all_segmentations_come_for_large_k():
    """Every segmentation of a short text is drawn once, however unlikely; log-probabilities and inclusion are the brute-force ones."""
    import numpy as np

    with open(segment.MODEL, "rb") as f:
        model = segment.pieces(f.read())
    few = "აბ" * 14 + "the" + "აბ" * 14 + "a"  # 60 letters without a blank; Georgian ones are pieces by themselves only
    assert len(few) == 60
    with np.errstate(over="ignore", divide="ignore"):
        for text in ("x", "a b", "the", "it is", few):
            want = _all_segmentations(model, text)
            whole = np.logaddexp.reduce(list(want.values()))
            for k in (2, len(want) // 2 + 1, len(want) + 50):
                (rows,) = segment.sampled_ids(model, [text], [11], k)
                got = [tuple(r[0].tolist()) for r in rows]
                assert len(set(got)) == len(got) == min(k, len(want)) and set(got) <= set(want)
                assert all(abs(r[1] - (want[x] - whole)) < 1e-9 for x, r in zip(got, rows, strict=True))
                assert all(a[2] >= b[2] for a, b in zip(rows, rows[1:], strict=False))
                if k >= len(want):
                    assert {r[3] for r in rows} == {0.0}
                else:  # the inclusion follows from kappa, which is one perturbed value further down
                    (more,) = segment.sampled_ids(model, [text], [11], k + 1)
                    assert [tuple(r[0].tolist()) for r in more[:k]] == got
                    inclusion = [np.log(-np.expm1(-np.exp(r[1] - more[k][2]))) for r in rows]
                    assert np.allclose([r[3] for r in rows], inclusion, rtol=1e-6, atol=1e-12)


def test_perturbed_values_are_gumbel():
    """Second samples come as often as without-replacement sampling says: p2 = sum over first ones of p1 * p / (1 - p1)."""
    import numpy as np

    with open(segment.MODEL, "rb") as f:
        model = segment.pieces(f.read())
    want = _all_segmentations(model, "as")
    whole = np.logaddexp.reduce(list(want.values()))
    p = {x: float(np.exp(v - whole)) for x, v in want.items()}
    n = 6000
    with np.errstate(over="ignore", divide="ignore"):
        found = segment.sampled_ids(model, ["as"] * n, list(range(n)), 2)
    for x in p:
        second = sum(q * p[x] / (1 - q) for y, q in p.items() if y != x)
        seen = sum(tuple(rows[1][0].tolist()) == x for rows in found) / n
        assert abs(seen - second) < 4.5 * np.sqrt(second * (1 - second) / n) + 1e-3


def test_gradient_of_the_penalised_loss():
    import numpy as np

    from clademill.llm.logistic import Sparse, loss

    r = np.random.default_rng(4)
    draw = lambda n: Sparse([sorted(set(r.integers(0, 12, 4).tolist())) for _ in range(n)], 12)
    x, y, two, w = draw(30), r.integers(0, 2, 30).astype(float), (draw(9), draw(9)), r.normal(size=13)
    weight = r.random(30) / 15
    value, g = loss(w, x, y, weight, 0.01, two, 0.7)
    for k in range(13):
        step = np.zeros(13)
        step[k] = 1e-6
        high, low = (loss(w + s, x, y, weight, 0.01, two, 0.7)[0] for s in (step, -step))
        assert abs((high - low) / 2e-6 - g[k]) < 1e-6
    assert value - loss(w, x, y, weight, 0.01, None, 0.0)[0] == pytest.approx(0.7 * np.mean((two[0].dot(w[:-1]) - two[1].dot(w[:-1])) ** 2))


def test_swap_terms_are_found_in_the_texts(spark):
    """Words that stand where others stand, but mostly in toxic texts, are found in two languages, and swapping them stops to count."""
    groups = {"en": (["norbs", "talms", "vints"], "the {} went home early. {}"), "xx": (["zork", "lumm", "kiff"], "ja {} mora silo tepi. {}")}
    rows = []
    for i in range(600):
        names, shape = groups["en" if i % 3 else "xx"]
        toxic = i % 2
        who = names[0] if (toxic and i % 5) or i % 4 == 0 else names[1 + i // 2 % 2]
        rows.append((i, shape.format(who, "vilestword here" if toxic else f"calm number{i % 7} here"), "en" if i % 3 else "xx", toxic))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    docs, lab = df.drop("toxic"), df.select("doc_id", "toxic")
    free, held = toxicity.trained(docs, lab, pair_weight=0.0), toxicity.trained(docs, lab, pair_weight=5.0)
    assert {"norbs", "zork"} <= set(held.terms) and held.terms["norbs"][0] in {"talms", "vints"} and held.terms["zork"][0] in {"lumm", "kiff"} and held.pairs > 100
    assert held.weights != free.weights
    change = lambda m: {r.by: r.mean_change for r in toxicity.swap_changes(df, m, "lang").collect()}
    loose, tight = change(free), change(held)
    assert set(tight) == {"en", "xx"} and all(tight[g] < 0.2 * loose[g] for g in tight)
    with pytest.warns(UserWarning, match="no pairs"):
        toxicity.trained(docs.withColumn("text", F.when(F.col("doc_id") % 2 == 1, "vilestword").otherwise("calm")), lab)


def _plain_phrases(text, known):
    at = n = 0
    while at < len(text):
        m = 1
        while at + m < len(text) and text[at : at + m + 1] in known:
            m += 1
        at, n = at + m, n + 1
    return n


def test_long_texts_and_large_alphabets_against_plain_parse(monkeypatch):
    """Texts of 5000 characters and more, alphabets of 400 letters, repetitions that never fall into step, segments of several lengths."""
    import random

    r = random.Random(3)
    many = "".join(r.choice([chr(0x4E00 + i) for i in range(400)]) for _ in range(3000))
    other = "".join(r.choice([chr(0xAC00 + i) for i in range(400)]) for _ in range(3000))
    latin = " ".join("".join(r.choice("abcde") for _ in range(r.randrange(1, 9))) for _ in range(900))
    texts = (("a", many), ("b", other), ("c", latin), ("d", "ab" * 700 + "ba"))
    model = langid.Automata(texts)
    long = [
        "".join(many[k : k + 40] for k in range(0, 2900, 23)), "".join(r.choice(many) for _ in range(5000)), other[700:] + many[:2500] + other,
        " ".join("".join(r.choice("abcdx") for _ in range(r.randrange(1, 9))) for _ in range(1500)), "ab" * 3000, "aab" * 2000, "zz" * 2600, latin[5:] + latin[3:3000], "b",
    ]
    want = [[_plain_phrases(t, known) for _, known in texts] for t in long]
    for segment_size in (1024, 100, 7):
        monkeypatch.setattr(langid, "SEGMENT", segment_size)
        got, chars = model.phrases(long)
        assert got.tolist() == want and chars.tolist() == [len(t) for t in long]
    # Each language's own characters tell: two languages of 400 letters.
    assert langid.Automata(texts[:2]).predict(["".join(r.choice(many) for _ in range(300)), "".join(r.choice(other) for _ in range(300))])[0] == ["a", "b"]


def test_learned_rows_are_whole(spark):
    rows = [(1, "x" * 30_000, "long"), (2, "y" * 40_000, "long"), (3, "kurz und gut", "de"), (4, "z" * 23_990, "de"), (5, "noch ein text", "de"), (6, "q" * 50_000, "de"), (7, None, "xx"), (8, "...", "yy")]
    texts = dict(langid.sampled_text(spark.createDataFrame(rows, "doc_id long, text string, lang string")))
    assert texts["long"] == "x" * 30_000 and set(texts) == {"long", "de"}
    assert set(texts["de"].split(chr(0x1E))) <= {t for _, t, _ in rows} and len(texts["de"]) <= 24_002
    assert all(langid.model_bytes(t) < 1 << 27 for t in texts.values())
