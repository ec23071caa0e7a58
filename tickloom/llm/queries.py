"""The operators as registered queries over the whole test tables, with SQL where it can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickloom.llm import (
    bpe, credentials, decontam, hmm, langid, near_dedup, packing, periodic, phrases, quality, sharding,
    token_files, warc)
from tickloom.session import ship

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            ship(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(n: int, id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo n."""
    return F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(n))


@query("op1_hidden_markov_score")
def op1(spark, sf_dir):
    made = hmm.score_documents(table(spark, sf_dir, "documents"), fold(7) != 2)
    return made.select("doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                       "base_score", "score")


@query("op2_credential_links")
def op2(spark, sf_dir):
    return credentials.findings(table(spark, sf_dir, "documents")).withColumnRenamed("_id", "doc_id").drop("_text")


NEAR_DUPLICATES = r"""WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), x -> x <> '') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 3), i -> array_to_string(w[i:i + 4], ' ')) END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id
  GROUP BY 1, 2),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * common >= 75 * (x.n + y.n - common)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS id, doc_id AS low FROM documents
  UNION SELECT e.b, r.low FROM reach r JOIN edges e ON e.a = r.id WHERE r.low < e.b)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, min(low) AS component_id, d.doc_id = min(low) AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN reach r ON r.id = d.doc_id
GROUP BY d.doc_id, n"""


@query("op3_circulant_minhash", NEAR_DUPLICATES)
def op3(spark, sf_dir):
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query("op4_byte_bpe")
def op4(spark, sf_dir):
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                          public_tokenizers.PATTERN, keep=["doc_id"])


WINNOWED = r"""WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS span, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS g
  FROM i, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS t(s) WHERE len(w) > 0),
found AS (
  SELECT doc_id, s, span, array_to_string(w[s:s + span - 1], ' ') AS g
  FROM d, (SELECT DISTINCT span FROM windows) AS spans, unnest(range(1, len(w) - span + 2)) AS t(s)),
hits AS (SELECT doc_id, s, f.span, item_id FROM found f JOIN windows x ON x.span = f.span AND x.g = f.g),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM hits, unnest(range(s, s + span)) AS t(p) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
         sha256(string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR)) AS items_sha256
  FROM hits GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered c ON c.doc_id = d.doc_id LEFT JOIN items t ON t.doc_id = d.doc_id"""


@query("op5_winnowing", WINNOWED)
def op5(spark, sf_dir):
    made = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return made.withColumnRenamed("_id", "doc_id").drop("_text")


@query("op6_weighted_hash_tree")
def op6(spark, sf_dir):
    return sharding.assign(table(spark, sf_dir, "documents"), sharding.balanced_tree(16))


@query("op7_ngram_ratio")
def op7(spark, sf_dir):
    trusted = table(spark, sf_dir, "labels").filter("quality = 1 and toxic = 0").select("doc_id")
    return quality.judge_held_out(table(spark, sf_dir, "documents"), trusted)


CAPTURES = r"""WITH hosts AS (
  SELECT *, coalesce(html, '') AS payload, coalesce(regexp_replace(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://', ''), '') AS rest
  FROM pages),
keys AS (
  SELECT *, regexp_replace(lower(regexp_extract(rest, '^([^/?#]*)', 1)), '^www[0-9]*\.', '') AS host,
         lower(regexp_extract(rest, '^[^/?#]*([/?]?[^#]*)', 1)) AS path FROM hosts),
digests AS (
  SELECT page_id, strlen(payload) AS n, sha256(payload) AS digest,
         array_to_string(list_reverse(string_split(host, '.')), ',') || ')' ||
           CASE WHEN path LIKE '/%' THEN path ELSE '/' || path END AS url_key,
         1704067200 + page_id AS captured_at FROM keys),
firsts AS (SELECT digest, min(page_id) AS first FROM digests WHERE n >= 100 GROUP BY digest),
described AS (
  SELECT page_id, n AS payload_bytes, d.digest AS payload_digest,
         CASE WHEN first < page_id AND n >= 100 THEN 'revisit' ELSE 'response' END AS record_type,
         CASE WHEN first < page_id AND n >= 100 THEN first END AS refers_to, url_key, captured_at
  FROM digests d LEFT JOIN firsts f ON f.digest = d.digest)
SELECT *, row_number() OVER (ORDER BY url_key, captured_at, page_id) - 1 AS position,
       row_number() OVER (PARTITION BY url_key ORDER BY captured_at, page_id) AS capture
FROM described"""


@query("op8_capture_index", CAPTURES)
def op8(spark, sf_dir):
    return warc.capture_history(table(spark, sf_dir, "pages")).drop("archive", "offset", "length")


@query("op9_mixed_token_files")
def op9(spark, sf_dir):
    return token_files.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 2)


@query("op10_crf_language")
def op10(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(fold(4) == 2, F.lit(False)))
    model = langid.fit(docs, ~F.col("held_out"))
    return langid.label(docs.select("doc_id", "held_out", "text"), model, keep=["doc_id", "held_out"])


@query("op11_sum_of_squares_packing")
def op11(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 1, keep_ids=False)


@query("op12_dyadic_square_runs")
def op12(spark, sf_dir):
    return periodic.run_digests(table(spark, sf_dir, "documents"))


PHRASES = r"""WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
counts AS (
  SELECT lang, k, array_to_string(w[s:s + k - 1], ' ') AS phrase, count(*) AS f
  FROM words, (VALUES (1), (2), (3), (4)) AS sizes(k), unnest(range(1, len(w) - k + 2)) AS t(s)
  GROUP BY 1, 2, 3 HAVING count(*) >= 30),
candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE k >= 2),
cuts AS (
  SELECT c.lang, c.k, c.phrase, c.a, cut, x.f AS l, y.f AS r, ((2000000::HUGEINT * c.a) // (x.f + y.f))::BIGINT AS score
  FROM candidates c, unnest(range(1, c.k)) AS t(cut)
  JOIN counts x ON x.lang = c.lang AND x.k = cut AND x.phrase = array_to_string(c.w[1:cut], ' ')
  JOIN counts y ON y.lang = c.lang AND y.k = c.k - cut AND y.phrase = array_to_string(c.w[cut + 1:], ' ')),
lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS nth FROM cuts),
inside AS (
  SELECT lang, array_to_string(w[s:s + size - 1], ' ') AS phrase, max(a) AS longer
  FROM candidates, (VALUES (2), (3)) AS sizes(size), unnest(range(1, k - size + 2)) AS t(s)
  WHERE size < k GROUP BY 1, 2),
kept AS (
  SELECT b.* FROM lowest b LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase
  WHERE nth = 1 AND (longer IS NULL OR 100 * longer < 80 * a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT r.lang, rank, phrase, a, l, r.r AS r, n, score FROM ranked r JOIN totals t ON t.lang = r.lang WHERE rank <= 2000"""


@query("op13_toivonen_phrases", PHRASES)
def op13(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents"))
