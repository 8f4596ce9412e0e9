"""Documents to training sequences: quality scores, rules, near-duplicates, personal data, packing.

Each stage takes all that its predecessor kept and returns the columns of ``documents``, but for the last, which
returns the pieces of the packed sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import ngram_join, packing, pairwise_quality, pii, quality_rules
from tidewell.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose pairwise quality score reaches the limit.

    A null or empty text is scored as one without words; rows that repeat get equal scores and stay or go together; where
    no labels of both kinds are known every document stays. All columns are kept, whatever their names.
    """
    model = pairwise_quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = docs.select(F.struct("*").alias("row"), F.col("text").alias("text"))
    scored = pairwise_quality.with_score(scored, model)
    return scored.filter(F.col("score") >= pairwise_quality.LIMIT).select("row.*")


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the limits and not an outlier of their language and source.

    A null or empty text has no words and goes; a null language or source is a value of its own; rows that repeat stay or
    go together. All columns are kept, whatever their names.
    """
    return quality_rules.rate(docs).filter("kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the least id, with all rows that repeat this id.

    What goes is named by id and text, so a row without an id, or one that repeats an id with another text, is not
    taken for another row.
    """
    dropped = ngram_join.join(docs).filter(~F.col("kept")).select("doc_id", "text_key").distinct()
    marked = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        ngram_join.text_key(F.col("text")).alias("text_key"))
    # By shuffle whatever the sizes: what goes is a share of the documents, so it grows with them.
    return marked.join(dropped.hint("merge"), ["doc_id", "text_key"], "left_anti").select("row.*")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind in brackets; ``n_chars`` counts the new text."""
    found = pii.find(docs)
    text = pii.redact(F.col("row.text"), F.col("spans"))
    changed = found.withColumn("clean", text)
    return changed.select(*[
        F.col("clean").alias("text") if c == "text"
        else F.when(F.size("spans") > 0, F.length("clean")).otherwise(F.col("row.n_chars")).cast(docs.schema[c].dataType).alias(c)
        if c == "n_chars" else F.col(f"row.`{c}`") for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences, as query ``op4_online_packing`` gives them.

    A null or empty text is its end id alone, rows that repeat are packed as often as they come, a null id stays null;
    other columns are not read. No documents give no pieces.
    """
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality_classifier", quality),
    ("quality_rules", rules),
    ("ngram_join", near_duplicates),
    ("pii", personal_data),
    ("packing", pack),
]

#: The fitted stages have no counterpart in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
