"""The registered queries of the ten operators and the pipeline, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayframe.llm import bpe, near_dedup, ngram_lm, packing, pii, substring_dedup, toxicity, vectors, warc
from wayframe.llm.common import table


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, packing.word_encoder(tokenizer_file("word_bpe_49k.json")), end_id=2, emit_ids=False)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.remove_repeats(docs)


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return bpe.encode_table(docs, tokenizer_file("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, digests=True)


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"), payloads=False)


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), size=4, share=(80, 100))


def op7_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.score(table(spark, sf_dir, "documents"), order=3)


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"), least=0.9)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"), mask=False)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {"op1_packing": op1_packing, "op2_substring_dedup": op2_substring_dedup, "op3_byte_bpe": op3_byte_bpe, "op4_top_k": op4_top_k, "op5_warc": op5_warc, "op6_near_dedup": op6_near_dedup, "op7_ngram_lm": op7_ngram_lm, "op8_embedding_dedup": op8_embedding_dedup, "op9_pii": op9_pii, "op10_toxicity": op10_toxicity, "pipeline": pipeline}
ORACLE_SQL: dict[str, str] = {
    "op4_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, x.vec_id AS vec_id, CAST(list_sum(list_transform(list_zip(q.v, x.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM (SELECT * FROM v WHERE vec_id % 50 = 0) q JOIN v x ON q.vec_id <> x.vec_id
        ), r AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
        )
        SELECT * FROM r WHERE rank <= 5
    """,
    "op5_warc": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
        ), f AS (
            SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1
        )
        SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, p.payload_digest,
               CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to
        FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest AND payload_bytes >= 100
    """,
    "op6_near_dedup": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), s AS (
            SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s FROM w
        ), e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s
        ), p AS (
            SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id
            GROUP BY 1, 2 HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))
        ), links AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p
        ), reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
        ), c AS (
            SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(m.b, s.doc_id)) AS component_id
            FROM s LEFT JOIN (SELECT a, min(b) AS b FROM reach GROUP BY 1) m ON m.a = s.doc_id
        )
        SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM c
    """,
    "op8_embedding_dedup": """
        WITH RECURSIVE v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
            WHERE list_cosine_similarity(a.v, b.v) >= 0.9
        ), reach AS (
            SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
        ), c AS (
            SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links,
                   least(vec_id, coalesce((SELECT min(b) FROM reach WHERE a = vec_id), vec_id)) AS component_id
            FROM embeddings
        )
        SELECT vec_id, CAST(n_links AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept FROM c
    """,
}
