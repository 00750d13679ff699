"""Queries of the llm operators: each applies one operator, with production settings, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .archives import round_trip
from .decontamination import decontaminate
from .embeddings import near_vectors
from .extraction import extract
from .hard_negatives import mine, relabelled
from .language import identify
from .lattice import score_texts
from .minhash import near_duplicates
from .packing import pack
from .substrings import remove_repeats
from .token_counts import count_tokens
from .toxicity import score_documents
from .whitening import whiten

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op7_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages")).drop("url", "record_id")


ORACLES["op7_arc_to_warc"] = """
WITH p AS (SELECT page_id, url, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                  sha256(coalesce(html, '')) AS payload_digest FROM pages),
r AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM r
"""


@query
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


@query
def op4_lattice_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return score_texts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


ORACLES["op1_embedding_near_dedup"] = """
WITH RECURSIVE v AS (
    SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
    WHERE len(embedding) > 0 AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
      AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
links AS (
    SELECT a.vec_id AS u, b.vec_id AS w FROM v a JOIN v b
    ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach(u, w) AS (
    SELECT u, w FROM links UNION SELECT r.u, l.w FROM reach r JOIN links l ON r.w = l.u),
n AS (SELECT u, count(*) AS n_links FROM links GROUP BY u),
c AS (SELECT u, min(w) AS least FROM reach GROUP BY u)
SELECT vec_id, coalesce(n_links, 0) AS n_links, least(vec_id, coalesce(least, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(least, vec_id)) AS kept
FROM embeddings LEFT JOIN n ON n.u = vec_id LEFT JOIN c ON c.u = vec_id
"""


@query
def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(table(spark, sf_dir, "embeddings").transform(relabelled(7, 10)))


ORACLES["op11_hard_negatives"] = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.x, b.x)::BIGINT AS score
    FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank,
       s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score
QUALIFY rank <= 5
"""
