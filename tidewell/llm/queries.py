"""Registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import (
    batched_bpe,
    binary_codes,
    lexical_search,
    ngram_join,
    packing,
    pairwise_quality,
    pii,
    quality_rules,
    sentencepieces,
    token_counts,
    url_rules,
    warc,
    whitening,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _vocabulary() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), _vocabulary())


def op2_mcd_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.rate(_table(spark, sf_dir, "documents"), carry=["doc_id"]).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")


def op3_warc_revisit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_online_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), _vocabulary()).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op5_rotation_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binary_codes.link(_table(spark, sf_dir, "embeddings"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(_table(spark, sf_dir, "documents")).drop("text_key")


def op7_batched_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = batched_bpe.encode_documents(_table(spark, sf_dir, "documents"), _vocabulary())
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


def op8_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = pairwise_quality.train(docs, _table(spark, sf_dir, "labels"))
    return pairwise_quality.with_score(docs, model).select(
        "doc_id", pairwise_quality.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= pairwise_quality.LIMIT).cast("int").alias("predicted"))


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(_table(spark, sf_dir, "pages").select("page_id", "url")).select(
        "page_id", "host", "path", "rule", "verdict")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(_table(spark, sf_dir, "documents"), carry=["doc_id"])
    kinds = F.array(*[F.lit(k) for k in pii.KINDS])
    listed = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))))
    base = F.filter("spans", lambda s: s["base"])
    count = lambda i: F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == i))).cast("long")
    return found.select(
        "row.doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(pii.KINDS)],
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def op11_offset_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = sentencepieces.encode_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
        F.element_at("stops", -1).cast("long").alias("n_bytes"))


def op12_cholesky_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.components(_table(spark, sf_dir, "embeddings"))


def op13_geometric_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical_search.build_index(_table(spark, sf_dir, "documents"))
    return lexical_search.search(index, _table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_mcd_quality": op2_mcd_quality,
    "op3_warc_revisit": op3_warc_revisit,
    "op4_online_packing": op4_online_packing,
    "op5_rotation_codes": op5_rotation_codes,
    "op6_ngram_join": op6_ngram_join,
    "op7_batched_bpe": op7_batched_bpe,
    "op8_pairwise_quality": op8_pairwise_quality,
    "op9_url_rules": op9_url_rules,
    "op10_pii": op10_pii,
    "op11_offset_pieces": op11_offset_pieces,
    "op12_cholesky_whitening": op12_cholesky_whitening,
    "op13_geometric_blocks": op13_geometric_blocks,
}


