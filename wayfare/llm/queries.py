"""The registered text queries: whole tables in, the contracts' columns out."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from wayfare.llm import (
    byte_bpe, centroids, exact_dedup, html_text, langid, mtree, near_dedup, packing, simhash, suffix_dedup, token_counts, vector_codes, warc)
from wayfare.llm.common import table

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def page_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_text.main_text(table(spark, sf_dir, "pages"))
    return pages.withColumn("n_chars", F.length("text").cast("long"))


def pow2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), WORD_BPE)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


def mtree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def digest_index_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup_in_batches(table(spark, sf_dir, "documents"))


def byte_bpe_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = byte_bpe.decode(byte_bpe.encode(table(spark, sf_dir, "documents"), BYTE_BPE), BYTE_BPE)
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def chosen_path_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def ecoc_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.learn(docs.where(~langid.held_out()))
    return langid.predict(docs, model).withColumn("held_out", langid.held_out())


def warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    records = warc.read(warc.look_up(warc.write(pages), pages))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def viterbi_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), PIECES)


def laesa_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


def sharded_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_page_differencing": page_differencing,
    "op2_pow2_packing": pow2_packing,
    "op3_mtree_topk": mtree_topk,
    "op4_digest_index_dedup": digest_index_dedup,
    "op5_byte_bpe": byte_bpe_ids,
    "op6_chosen_path_dedup": chosen_path_dedup,
    "op7_suffix_array_dedup": suffix_array_dedup,
    "op8_ecoc_langid": ecoc_langid,
    "op9_warc_index": warc_index,
    "op10_viterbi_counts": viterbi_counts,
    "op11_laesa_codes": laesa_codes,
    "op12_sharded_lloyd": sharded_lloyd,
    "op13_simhash_dedup": simhash_dedup,
    "pipeline": corpus_pipeline.run,
}

# Whole numbers below 2^53, so that inner products of doubles are exact.
LAESA_SQL = """
    WITH clean AS MATERIALIZED (
        SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
        WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(embedding) % 4 = 0
        AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
    kept AS MATERIALIZED (
        SELECT *, row_number() OVER (ORDER BY vec_id, v) AS r, len(v) // 4 AS w FROM clean
        WHERE len(v) = (SELECT len(v) FROM clean GROUP BY len(v) ORDER BY count(*) DESC, len(v) LIMIT 1)),
    parts AS MATERIALIZED (
        SELECT r, p, v[p * w + 1:(p + 1) * w] AS x, list_inner_product(x, x) AS xx FROM kept, range(4) t(p)),
    c0 AS MATERIALIZED (SELECT p, r - 1 AS e, x AS c, xx AS cc FROM parts WHERE r <= 256),""" + "".join(f"""
    a{i} AS MATERIALIZED (
        SELECT r, p, min(CAST(xx - 2 * list_inner_product(x, c) + cc AS BIGINT) * 256 + e) AS k
        FROM parts JOIN c{i} USING (p) GROUP BY r, p),""" + (f"""
    n{i} AS (SELECT p, k % 256 AS e, list(s ORDER BY i) AS c FROM (
        SELECT p, k % 256 AS k, i, floor(sum(CAST(x[i] AS BIGINT)) / CAST(count(*) AS DOUBLE)) AS s
        FROM a{i} JOIN parts USING (r, p), range(1, 4096) t(i) WHERE i <= len(x) GROUP BY ALL) GROUP BY p, k),
    c{i + 1} AS MATERIALIZED (
        SELECT p, e, coalesce(n.c, o.c) AS c, list_inner_product(coalesce(n.c, o.c), coalesce(n.c, o.c)) AS cc
        FROM c{i} o LEFT JOIN n{i} n USING (p, e)),""" if i < 4 else "") for i in range(5)) + """
    coded AS (SELECT r, string_agg(format('{:02x}', k % 256), '' ORDER BY p) AS code, CAST(sum(k // 256) AS BIGINT) AS error
              FROM a4 GROUP BY r)
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
           (SELECT sha256(string_agg(array_to_string(list_transform(c, lambda x: CAST(x AS BIGINT)), ','), ',' ORDER BY p, e)) FROM c4) AS codebooks_sha256
    FROM coded JOIN kept USING (r)"""

LLOYD_SQL = """
    WITH kept AS MATERIALIZED (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x,
               row_number() OVER (ORDER BY sha256('2:' || vec_id), x) AS r, list_inner_product(x, x) AS xx FROM embeddings
        WHERE vec_id IS NOT NULL AND len(embedding) = 64
        AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
    c0 AS MATERIALIZED (SELECT r - 1 AS e, x AS c, xx AS cc FROM kept WHERE r <= 40),""" + "".join(f"""
    a{i} AS MATERIALIZED (
        SELECT r, min(CAST(xx - 2 * list_inner_product(x, c) + cc AS BIGINT) * 64 + e) AS k FROM kept, c{i} GROUP BY r),""" + (f"""
    n{i} AS (SELECT e, list(s ORDER BY i) AS c FROM (
        SELECT k % 64 AS e, i, floor(sum(CAST(x[i] AS BIGINT)) / CAST(count(*) AS DOUBLE)) AS s
        FROM a{i} JOIN kept USING (r), range(1, 65) t(i) GROUP BY ALL) GROUP BY e),
    c{i + 1} AS MATERIALIZED (
        SELECT e, coalesce(n.c, o.c) AS c, list_inner_product(coalesce(n.c, o.c), coalesce(n.c, o.c)) AS cc
        FROM c{i} o LEFT JOIN n{i} n USING (e)),""" if i < 5 else "") for i in range(6)) + """
    found AS (SELECT vec_id, CAST(k % 64 AS INTEGER) AS cluster, k // 64 AS distance FROM a5 JOIN kept USING (r))
    SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
           CAST(sum(distance) OVER () AS BIGINT) AS inertia,
           sha256(array_to_string(list_transform(c, lambda x: CAST(x AS BIGINT)), ',')) AS centroid_sha256
    FROM found JOIN c5 ON cluster = e"""

ORACLE: dict[str, str] = {
    "op3_mtree_topk": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
                   FROM embeddings WHERE len(embedding) > 0
                   AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
        s AS (SELECT q.vec_id AS query_id, c.vec_id,
                     CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
              FROM v q, v c WHERE q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
        r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
                     vec_id, score FROM s)
        SELECT * FROM r WHERE rank <= 10""",
    "op4_digest_index_dedup": r"""
        WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                          sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
                   FROM documents WHERE doc_id IS NOT NULL),
        w AS (SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
                     count(*) OVER (PARTITION BY text_sha256) AS group_size FROM d)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM w""",
    "op11_laesa_codes": LAESA_SQL,
    "op12_sharded_lloyd": LLOYD_SQL,
    "op9_warc_index": """
        WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
                   FROM pages WHERE page_id IS NOT NULL),
        m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM p)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id < last THEN last END AS refers_to FROM m""",
}
