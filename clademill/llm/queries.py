"""The registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import importable


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all documents takes from each, sources weighing 5, 2, 1."""
    from .mixing import taken

    return taken(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "slots", F.round("deviation", 6).alias("deviation"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from labels of those whose id's CRC-32 mod 5 is not 0."""
    from .toxicity import scored, trained

    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(~held_out)
    return scored(docs.withColumn("held_out", held_out), trained(docs, labels))


def op3_segmentations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of every document, and whether they decode to its text."""
    from .segment import digested

    return digested(_table(spark, sf_dir, "documents"), k=2)


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents by three-word shingles at 85 %."""
    from .minhash import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"), size=3, percent=85)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards whose row counts are at most one apart."""
    from .sharding import interleaved

    placed = interleaved(_table(spark, sf_dir, "documents"), n_shards=24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule measures and verdict of every document."""
    from .hostrules import judged

    return judged(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("host_rate", 6).alias("host_rate")
    )


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP6_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
lines AS (
  SELECT rid, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
pos AS (SELECT rid, unnest(range(1, len(w) - 1)) AS i, w FROM d WHERE len(w) >= 3),
grams AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, w[i], w[i + 1], w[i + 2]) AS c FROM pos),
rep AS (SELECT rid, count(DISTINCT p) AS n_repeat_words FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM grams WHERE c > 1) GROUP BY rid),
m AS (
  SELECT d.rid, doc_id, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM d LEFT JOIN lines USING (rid) LEFT JOIN rep USING (rid)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
f AS (SELECT *, base_failed OR 100 * n_symbols > 10 * n_words OR 100 * n_dup_lines > 30 * n_words AS failed FROM b),
h AS (SELECT source, count(*) AS n, sum(failed::INT) AS fails FROM f GROUP BY source),
p AS (SELECT sum(fails) / sum(n) AS mean, sum(n * (fails / n) * (fails / n)) / sum(n) - (sum(fails) / sum(n)) ^ 2 AS v FROM h),
s AS (SELECT mean, CASE WHEN v > 1e-12 THEN least(greatest(mean * (1 - mean) / v - 1, 1), 1000) ELSE 1000 END AS strength FROM p),
r AS (SELECT source, (fails + mean * strength) / (n + strength) AS host_rate FROM h, s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT failed AND host_rate <= 0.6 AS kept, round(host_rate, 6) AS host_rate
FROM f JOIN r ON f.source IS NOT DISTINCT FROM r.source
"""


def op7_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and classes of all embeddings at a cosine of 0.98 within their label."""
    from .covertree import near_vectors

    return near_vectors(_table(spark, sf_dir, "embeddings"))


OP7_SQL = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS rid, vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
ok AS (
  SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.rid AS a, b.rid AS b, b.vec_id AS to_id FROM ok a JOIN ok b
  ON a.label = b.label AND a.rid <> b.rid AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (
  SELECT rid AS a, rid AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT v.vec_id, (SELECT count(*) FROM links l WHERE l.a = v.rid) AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v JOIN (SELECT r.a, min(t.vec_id) AS component_id FROM reach r JOIN v t ON t.rid = r.b GROUP BY r.a) c ON c.a = v.rid
"""


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from those whose id's CRC-32 mod 4 is not 2."""
    from .langid import identified

    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang", held_out.alias("held_out"))
    return identified(docs.drop("lang"), docs.filter(~F.col("held_out")))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by two co-trained views, learned from labels of those whose id's CRC-32 mod 5 is not 0."""
    from .cotrain import featured, scored, trained

    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    measured = featured(_table(spark, sf_dir, "documents"))
    model = trained(measured, _table(spark, sf_dir, "labels").filter(~held_out))
    return scored(measured, model).select("doc_id", held_out.alias("held_out"), *[F.round(c, 9).alias(c) for c in ("text_score", "meta_score", "score")], "kept")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records and read back."""
    from .warc import archived

    return archived(_table(spark, sf_dir, "pages")).drop("url")


#: SHA-1 as base32: 40 hex digits are 160 bits, read five at a time.
OP10_SQL = r"""
WITH p AS (SELECT row_number() OVER () AS rid, page_id, encode(coalesce(html, '')) AS payload FROM pages),
hexed AS (SELECT rid, page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS hex FROM p),
bits AS (
  SELECT rid, page_id, payload_bytes, hex,
         array_to_string(list_transform(range(1, 41), lambda k: right('0000' || bin(strpos('0123456789abcdef', hex[k]) - 1), 4)), '') AS b
  FROM hexed),
dig AS (
  SELECT rid, page_id, payload_bytes,
         array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + list_sum(list_transform(range(1, 6), lambda j: CAST(substr(b, CAST(5 * k + j AS INT), 1) AS INT) * CAST(2 ** (5 - j) AS INT)))::INT, 1)), '') AS payload_digest
  FROM bits),
g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS last FROM dig)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN last IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN last IS DISTINCT FROM page_id THEN last END AS refers_to
FROM g
"""


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all documents."""
    from .spelling import variants

    return variants(_table(spark, sf_dir, "documents"))


#: CRC-32 byte by byte over UTF-8: letters from \u00C0 on are two bytes. Near words share what is left when a letter at the same place goes, or one is what is left of the other.
OP11_SQL = r"""
WITH RECURSIVE tab AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(range(8), lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END, i) AS c FROM (SELECT unnest(range(256)) AS i))),
occ AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]{7,}')) AS run FROM documents),
runs AS (SELECT doc_id, run, count(*) AS k FROM occ GROUP BY ALL),
bytes AS (
  SELECT doc_id, run, k, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195, unicode(c)::BIGINT - 64] END)) AS b FROM runs),
crc AS (SELECT doc_id, run, k, xor(list_reduce(b, lambda a, x: xor(a // 256, t[xor(a % 256, x) + 1]), 4294967295::BIGINT), 4294967295::BIGINT) AS h FROM bytes, tab),
made AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, k FROM crc),
words AS (SELECT word, sum(k)::BIGINT AS n FROM made WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
less AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n AS m FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, first(other ORDER BY m DESC, encode(other)) AS form, max(m) AS form_n FROM near GROUP BY word),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * w.n THEN form END AS form, CASE WHEN form_n >= 10 * w.n THEN form_n END AS form_n FROM words w LEFT JOIN best USING (word)),
walk AS (SELECT word, word AS here, 0 AS k FROM formed UNION ALL SELECT walk.word, f.form, k + 1 FROM walk JOIN formed f ON f.word = walk.here WHERE f.form IS NOT NULL)
SELECT word, form, (SELECT arg_max(here, k) FROM walk WHERE walk.word = formed.word) AS root, n, n_near, form_n FROM formed
"""


def op12_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove from all documents in each of their orders, by source."""
    from .filteraudit import audited

    return audited(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
lab AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
m AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w), 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 2 * length(text),
          regexp_matches(text, '[#$%&*|]'), coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)] AS f
  FROM d LEFT JOIN lab USING (doc_id)),
l AS (SELECT unnest([1, 2, 3, 4, 5]) AS i),
p AS (
  SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM l a, l b, l c, l d, l e WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
s AS (SELECT o, array_to_string(list_transform(o, lambda i: 'ABCDE'[i]), '') AS filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM p),
c AS (SELECT part, f, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM m GROUP BY part, f),
x AS (
  SELECT part, filter_order, step, o[step] AS i, n, good, toxic, f[o[step]] AS fails, len(list_filter(o[:step - 1], lambda j: f[j])) > 0 AS gone, len(list_filter(f, lambda y: y)) = 1 AS once FROM c, s),
r AS (
  SELECT part, filter_order, step, i, coalesce(sum(n) FILTER (WHERE NOT fails AND NOT gone), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (WHERE fails AND NOT gone), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (WHERE fails AND gone), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (WHERE fails AND once), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (WHERE fails AND NOT gone), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (WHERE fails AND NOT gone), 0)::BIGINT AS toxic_lost
  FROM x GROUP BY part, filter_order, step, i)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, i))::BIGINT AS shapley FROM r
"""


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents that are equal but for white space, and the one of each that stays."""
    from .extendible import exact_duplicates

    return exact_duplicates(_table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS x FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY x) AS group_size, row_number() OVER w = 1 AS kept, sha256(x) AS text_sha256
FROM d WINDOW w AS (PARTITION BY x ORDER BY n DESC, doc_id)
"""


def queries() -> dict:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {
        "op6_host_rules": OP6_SQL, "op7_embeddings": OP7_SQL, "op10_warc": OP10_SQL, "op11_spelling": OP11_SQL, "op12_filters": OP12_SQL, "op13_exact_dedup": OP13_SQL,
    }
