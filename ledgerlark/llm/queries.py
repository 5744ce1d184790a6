"""The registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlark.llm import (
    ball_codes,
    decontaminate,
    fingerprint,
    near_dedup,
    packing,
    pii,
    quality,
    resampling,
    suffix_dedup,
    token_counts,
    token_files,
    toxicity,
    url_filter,
)
from ledgerlark.sources.tables import load


def op1_url_filter(spark: SparkSession, base: str) -> DataFrame:
    """Verdict on every URL of ``pages``."""
    rules = spark.createDataFrame(url_filter.RULES, "host string, path string, verdict string")
    return url_filter.filter_urls(load(spark, base, "pages"), rules)


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Where the public tokenizers lie on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op10_packing(spark: SparkSession, base: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return packing.pack_documents(load(spark, base, "documents"), vocabulary())


def op2_near_dedup(spark: SparkSession, base: str) -> DataFrame:
    """Components of documents that share most of their word shingles."""
    return near_dedup.near_duplicates(load(spark, base, "documents"))


def op3_pii(spark: SparkSession, base: str) -> DataFrame:
    """Personal data in every text."""
    return pii.find_personal_data(load(spark, base, "documents"))


def op4_quality(spark: SparkSession, base: str) -> DataFrame:
    """Quality of every document by a network over its bytes."""
    return quality.score_quality(load(spark, base, "documents"), load(spark, base, "labels"))


def op5_suffix_dedup(spark: SparkSession, base: str) -> DataFrame:
    """Bytes of every document that stand in a repeated string of 200 bytes."""
    return suffix_dedup.remove_repeats(load(spark, base, "documents"))


def op6_decontamination(spark: SparkSession, base: str) -> DataFrame:
    """Words of every document that stand in a window of a benchmark item."""
    return decontaminate.find_contamination(
        load(spark, base, "documents"), load(spark, base, "benchmark")
    )


def op7_toxicity(spark: SparkSession, base: str) -> DataFrame:
    """Toxicity of every document by a recurrent network over all its windows."""
    return toxicity.score_toxicity(load(spark, base, "documents"), load(spark, base, "labels"))


def op8_token_files(spark: SparkSession, base: str) -> DataFrame:
    """Token ids of all documents, written to coded files and read back."""
    files = token_files.write_tokens(load(spark, base, "documents"), vocabulary())
    return token_files.read_tokens(files)


def op9_fingerprints(spark: SparkSession, base: str) -> DataFrame:
    """Fingerprints of every text and of its edited text."""
    return fingerprint.fingerprints(load(spark, base, "documents"))


def op12_token_counts(spark: SparkSession, base: str) -> DataFrame:
    """Bytes and tokens of every text."""
    return token_counts.count_tokens(load(spark, base, "documents"), vocabulary("byte_bpe_50k.json"))


def op11_vector_codes(spark: SparkSession, base: str) -> DataFrame:
    """Codes of all vectors, 16 parts of 64 entries each."""
    return ball_codes.vector_codes(load(spark, base, "embeddings"))


def op13_resampling(spark: SparkSession, base: str) -> DataFrame:
    """A quarter of the documents, drawn towards the benchmark's words."""
    return resampling.resample(load(spark, base, "documents"), load(spark, base, "benchmark"))


QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_near_dedup": op2_near_dedup,
    "op3_pii": op3_pii,
    "op4_quality": op4_quality,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_decontamination": op6_decontamination,
    "op7_toxicity": op7_toxicity,
    "op8_token_files": op8_token_files,
    "op9_fingerprints": op9_fingerprints,
    "op10_packing": op10_packing,
    "op11_vector_codes": op11_vector_codes,
    "op12_token_counts": op12_token_counts,
    "op13_resampling": op13_resampling,
}

ORACLE = {
    "op1_url_filter": r"""
WITH cut AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules(h, p, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                          ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
fits AS (
  SELECT page_id, host, path,
         (SELECT max_by(h || p, 1000 * length(h || p) + length(h)) FROM rules
          WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS rule
  FROM cut)
SELECT page_id, host, path, rule,
       coalesce((SELECT v FROM rules WHERE h || p = rule), 'allow') AS verdict
FROM fits""",
    "op6_decontamination": r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(10, len(words)) AS n,
         array_to_string(words[i : i + least(10, len(words)) - 1], ' ') AS win
  FROM b, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS u(i) WHERE len(words) > 0),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, i, n, array_to_string(words[i : i + n - 1], ' ') AS win
  FROM w, sizes, unnest(range(1, len(words) - n + 2)) AS u(i) WHERE len(words) >= n),
h AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT DISTINCT doc_id, i, n FROM h), unnest(range(i, i + n)) AS u(p) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS l
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM h) GROUP BY doc_id)
SELECT w.doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(l, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)""",
    "op11_vector_codes": r"""
WITH kept AS (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id, embedding) AS r,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT r, p, v[p * (len(v) // 16) + 1 : (p + 1) * (len(v) // 16)] AS x
  FROM kept, unnest(range(16)) AS u(p)),
c0 AS MATERIALIZED (SELECT p, r - 1 AS e, x AS c FROM parts WHERE r <= 64),
"""
    + "".join(
        f"""
a{i} AS MATERIALIZED (
  SELECT r, p, least % 64 AS e, least // 64 AS d
  FROM (SELECT r, parts.p, min(CAST(list_inner_product(x, x) - 2 * list_inner_product(x, c)
               + list_inner_product(c, c) AS BIGINT) * 64 + e) AS least
        FROM parts JOIN c{i} ON parts.p = c{i}.p GROUP BY r, parts.p)),
"""
        + (f"""
m{i} AS (
  SELECT p, e, list(m ORDER BY k) AS c
  FROM (SELECT p, e, k, floor(sum(x[k]) / count(*)) AS m
        FROM a{i} JOIN parts USING (r, p), unnest(range(1, len(x) + 1)) AS u(k) GROUP BY p, e, k)
  GROUP BY p, e),
c{i + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(m{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN m{i} USING (p, e)),
""" if i < 2 else "")
        for i in range(3)
    )
    + r"""
digest AS (
  SELECT sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, k)) AS s
  FROM (SELECT p, e, unnest(c) AS x, unnest(range(len(c))) AS k FROM c2)),
codes AS (
  SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d) AS error FROM a2 GROUP BY r)
SELECT vec_id, code, CAST(error AS BIGINT) AS error,
       CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, s AS codebooks_sha256
FROM kept JOIN codes USING (r), digest""",
    "op13_resampling": r"""
WITH RECURSIVE texts AS (
  SELECT 'd' AS side, doc_id, row_number() OVER () AS r, coalesce(text, '') AS text FROM documents
  UNION ALL SELECT 'b', NULL, row_number() OVER (), coalesce(text, '') FROM benchmark),
words AS MATERIALIZED (
  SELECT side, doc_id, r, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM texts),
feats AS MATERIALIZED (
  SELECT side, r, unnest(w) AS f FROM words
  UNION ALL
  SELECT side, r, w[i] || ' ' || w[i + 1] FROM words, unnest(range(1, len(w))) AS u(i)),
table_of AS MATERIALIZED (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END,
                          b) ORDER BY b) AS t
  FROM range(256) AS u(b)),
names AS MATERIALIZED (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM feats)),
crc AS (
  SELECT f, h, 0 AS i, CAST(4294967295 AS BIGINT) AS c FROM names
  UNION ALL
  SELECT f, h, i + 1,
         xor(c >> 8, t[1 + (xor(c, CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)) & 255)])
  FROM crc, table_of WHERE 2 * i < length(h)),
buckets AS MATERIALIZED (SELECT f, xor(c, 4294967295) % 10000 AS b FROM crc WHERE 2 * i = length(h)),
counts AS (
  SELECT b, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t
  FROM feats JOIN buckets USING (f) GROUP BY b),
totals AS (SELECT CAST(sum(s) AS DOUBLE) AS s_all, CAST(sum(t) AS DOUBLE) AS t_all FROM counts),
gain AS (
  SELECT b, CAST(floor(1000 * ln((t + 1) * (s_all + 10000) / ((s + 1) * (t_all + 10000)))) AS BIGINT) AS g
  FROM counts, totals),
mean AS (
  SELECT r, count(*) AS n_features, CAST(floor(sum(g) / count(*)) AS BIGINT) AS weight
  FROM feats JOIN buckets USING (f) JOIN gain USING (b) WHERE side = 'd' GROUP BY r),
scored AS (
  SELECT doc_id, r, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || coalesce(
           CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM words LEFT JOIN mean USING (r) WHERE side = 'd'),
placed AS (
  SELECT *, n_words >= 20 AS able,
         row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS place,
         count(*) OVER (PARTITION BY n_words >= 20) AS n
  FROM scored)
SELECT doc_id, n_features, weight, score,
       CASE WHEN able AND place <= 25 * n // 100 THEN place END AS rank
FROM placed""",
}
