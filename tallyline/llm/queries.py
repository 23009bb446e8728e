"""The registered queries of the training-data operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyline.llm import bpe, codes, decontaminate, divergence, jaccard, langid, licenses, mixing, quality, sharding, token_files, topk, toxicity
from tallyline.llm.common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; labels are learnt outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and what they decode to, by their digests."""
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best vectors for every vec_id that is divisible by 20."""
    return topk.every_twentieth(table(spark, sf_dir, "embeddings"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot and shard of every document."""
    return sharding.shard_of_documents(table(spark, sf_dir, "documents"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files written, read back and told by place, length and checksum."""
    return token_files.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements, failure bits and verdict of every document."""
    return quality.rate(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of every document the mix takes."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.train(docs))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component and number of links of every document."""
    return jaccard.join_components(table(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best matching license of every document."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes of all vectors, with errors and the codebooks' digest."""
    return codes.compress(table(spark, sf_dir, "embeddings"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents that lie in windows of benchmark items, and those items."""
    return decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How sources of a language differ from each other and from the language, over all documents."""
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity, op2_byte_bpe, op3_top_k, op4_sharding, op5_token_files, op6_quality_rules, op7_mixing, op8_language,
        op9_jaccard_join, op10_license_scan, op11_vector_codes, op12_decontamination, op13_source_divergence,
    )
}

OP3_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as t from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select q.vec_id as query_id, c.vec_id, list_sum(list_transform(list_zip(q.t, c.t), lambda p: p[1] * p[2]))::bigint as score
  from v q, v c where q.vec_id % 20 = 0 and q.vec_id <> c.vec_id
)
select query_id, (row_number() over (partition by query_id order by score desc, vec_id))::integer as rank, vec_id, score
from s qualify rank <= 20"""

ORACLES: dict[str, str] = {
    "op3_top_k": OP3_SQL,
    "op4_sharding": sharding.oracle(),
    "op6_quality_rules": quality.oracle(),
    "op11_vector_codes": codes.oracle(),
    "op12_decontamination": decontaminate.oracle(),
    "op13_source_divergence": divergence.oracle(),
}
