"""Entity totals, normal forms and the join with a knowledge base."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.text import norm_form
from tidewell.operators.joins import lookup_join


def entity_total(counts: DataFrame) -> DataFrame:
    """Count of each entity over all records."""
    return counts.groupBy("entity").agg(F.sum("cnt").cast("long").alias("total"))


def without_type_digit(entity: Column) -> Column:
    """Re-tagged entity text without its type digit."""
    return F.regexp_replace(entity, " [0-9]$", "")


def entity_norm(mentions: DataFrame, entity: str = "entity") -> DataFrame:
    """Add the normal form; entities whose form is empty are left out."""
    return mentions.withColumn("norm", norm_form(F.col(entity))).filter(F.col("norm") != "")


def entity_norm_distinct(counts: DataFrame) -> DataFrame:
    """One normal form per entity text. Distinct first: the form is worked out once per text."""
    return entity_norm(counts.select("entity").distinct())


def doc_entity_norm(counts: DataFrame) -> DataFrame:
    return entity_norm(counts).select("stream_id", "doc_id", "entity", "norm", "cnt")


def entity_kb_join(doc_norms: DataFrame, kb: DataFrame) -> DataFrame:
    """Scored knowledge-base names ``(kb_id, norm, score)`` with the documents' normal forms.

    A popular name may hold a large part of the document side, so its rows are spread.
    """
    return lookup_join(doc_norms, kb, "norm").select("norm", "kb_id", "score", "doc_id", "cnt")


def lemma_lookup(entities: DataFrame, lemmas: DataFrame) -> DataFrame:
    """Replace each word of the distinct entities by its lemma; words without one stay.

    ``lemmas`` has one row ``(form, lemma)`` per form. An entity's words are put together again per
    entity, which is at most a mention long.
    """
    parts = entities.select("entity").distinct().select(
        "entity", F.posexplode(F.split(F.trim("entity"), " ")).alias("place", "form"))
    known = lookup_join(parts, lemmas, "form", how="left")
    return known.groupBy("entity").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("place", F.coalesce("lemma", "form").alias("lemma")))),
        lambda w: w["lemma"]), " ").alias("lemmatised"))
