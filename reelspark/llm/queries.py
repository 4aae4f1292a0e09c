"""Registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe, decontam, embdedup, filteraudit, htmltext, langid, linededup, minhash, piecebpe, tokencount, tokenfile, toxicity,
    whitening,
)
from .common import hash_bucket, scratch_path, table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = hash_bucket("doc_id", 5) == 0
    model = langid.train(docs.where(~held_out))
    out = langid.identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out.alias("held_out"), "language.*")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = hash_bucket("doc_id", 3) == 1
    model = toxicity.train(docs, table(spark, sf_dir, "labels").where(~held_out))
    out = toxicity.score_toxicity(docs, model)
    return out.select("doc_id", held_out.alias("held_out"), "toxicity.score",
                      (F.col("toxicity.score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
                      F.size("toxicity.passages").alias("n_passages"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return htmltext.extract(pages).select("page_id", "url", "text", "n_chars")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = linededup.dedup_lines(docs)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


OP4_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
hot AS (SELECT key, max(doc_id) AS last_doc FROM k WHERE length(key) >= 20
        GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.*, coalesce(k.doc_id < hot.last_doc, false) AS gone FROM k LEFT JOIN hot USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY r, doc_id
"""


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontam.contamination(docs, table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.encode(F.array_join("items", ","), "UTF-8"), 256).alias("items_sha256"), "contaminated")


OP5_SQL = """
WITH dw AS (SELECT row_number() OVER () AS r, doc_id,
                   list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM documents),
iw AS (SELECT CAST(item_id AS VARCHAR) AS item_id,
              list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM benchmark),
it AS (SELECT item_id, ws, unnest(generate_series(1, greatest(len(ws) - 12, 1))) AS i FROM iw WHERE len(ws) > 0),
win AS (SELECT DISTINCT item_id, ws[i:i + 12] AS w FROM it),
sizes AS (SELECT DISTINCT len(w) AS n FROM win),
places AS (SELECT r, ws, n, unnest(generate_series(1, len(ws) - n + 1)) AS i FROM dw, sizes WHERE len(ws) >= n),
grams AS (SELECT r, i, n, ws[i:i + n - 1] AS w FROM places),
hits AS (SELECT r, i, n, item_id FROM grams JOIN win USING (w)),
items AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM hits GROUP BY r),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT r, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY r)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM dw LEFT JOIN items USING (r) LEFT JOIN covered USING (r)
"""


def op6_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs).select(
        "doc_id", F.expr("octet_length(ids_packed) div 4").cast("long").alias("n_tokens"),
        F.sha2("ids_packed", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    tokenfile.write_token_files(tokenfile.encode_sorted(table(spark, sf_dir, "documents")), path)
    return tokenfile.token_digest(spark, path)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokencount.token_counts(docs).drop("text")


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embdedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents")).drop("text_hash")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filteraudit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP11_SQL = """
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(string_split_regex(t, '[ \\t-\\r]+'), lambda x: x <> '') AS ws,
             min(doc_id) OVER (PARTITION BY t) AS first_id FROM d),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
flags AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
                 [len(ws) < 100, 100 * len(list_distinct(ws)) < 80 * len(ws),
                  100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t),
                  regexp_matches(t, '[#$%&*|]'), coalesce(w.doc_id > first_id, false)] AS fails
          FROM w LEFT JOIN l USING (doc_id)),
letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
orders AS (SELECT a.c || b.c || c.c || d.c || e.c AS filter_order
           FROM letter a, letter b, letter c, letter d, letter e
           WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5),
steps AS (SELECT filter_order, step, instr('ABCDE', filter_order[step]) AS f,
                 [instr('ABCDE', x) FOR x IN string_split(filter_order[1:step - 1], '') IF x <> ''] AS before
          FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
masks AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM flags GROUP BY ALL),
told AS (SELECT *, len(list_filter(before, lambda b: fails[b])) > 0 AS gone,
                len(list_filter([1, 2, 3, 4, 5], lambda b: b <> f AND fails[b])) > 0 AS other FROM masks, steps),
counts AS (SELECT part, filter_order, step, f, sum(n) FILTER (NOT gone AND NOT fails[f]) AS kept,
                  sum(n) FILTER (NOT gone AND fails[f]) AS removed, sum(n) FILTER (gone AND fails[f]) AS redundant,
                  sum(n) FILTER (fails[f] AND NOT other) AS unique_fails,
                  sum(good) FILTER (NOT gone AND fails[f]) AS good_lost, sum(toxic) FILTER (NOT gone AND fails[f]) AS toxic_lost
           FROM told GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept,
       CAST(coalesce(removed, 0) AS BIGINT) AS removed, CAST(coalesce(redundant, 0) AS BIGINT) AS redundant,
       CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails, CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
       CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(coalesce(sum(removed) OVER (PARTITION BY part, f), 0) AS BIGINT) AS shapley
FROM counts
"""


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return out.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


def op13_piece_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = piecebpe.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"))
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.encode(ids, "UTF-8"), 256).alias("ids_sha256"),
                      F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def all_queries() -> dict:
    return {
        "op1_language_id": op1_language_id,
        "op2_toxicity": op2_toxicity,
        "op3_html_text": op3_html_text,
        "op4_line_dedup": op4_line_dedup,
        "op5_decontamination": op5_decontamination,
        "op6_bpe_roundtrip": op6_bpe_roundtrip,
        "op7_token_files": op7_token_files,
        "op8_token_counts": op8_token_counts,
        "op9_embedding_dedup": op9_embedding_dedup,
        "op10_minhash_dedup": op10_minhash_dedup,
        "op11_filter_audit": op11_filter_audit,
        "op12_embedding_whitening": op12_embedding_whitening,
        "op13_piece_roundtrip": op13_piece_roundtrip,
    }


def all_oracles() -> dict[str, str]:
    return {
        "op4_line_dedup": OP4_SQL,
        "op5_decontamination": OP5_SQL,
        "op11_filter_audit": OP11_SQL,
    }
