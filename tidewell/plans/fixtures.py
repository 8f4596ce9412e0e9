"""Corpus records and dictionaries derived from the given tables.

Every rule here has the same rule in :mod:`tidewell.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.arrays import unnest
from tidewell.functions.flat import in_parts, laid, places
from tidewell.functions.text import host_of, norm_form, words
from tidewell.model import TAGGERS
from tidewell.operators.blocks import plain_text
from tidewell.session import scratch_path

# Word types of the two taggers, by word length.
SERIF_TYPES = ("PER", "ORG", "LOC", "MISC", "VEH", "TIME")
LINGPIPE_TYPES = ("PER", "ORG", "LOC", "MISC")
RETAGGED = {"PER": "PERSON", "ORG": "ORGANIZATION", "LOC": "LOCATION"}

STOPWORDS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on",
    "that", "the", "this", "to", "was", "were", "which", "with", "der", "die", "und", "la", "le", "el", "de",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _typed(length: Column, shortest: int, kinds: tuple[str, ...]) -> Column:
    return F.when(length < shortest, F.lit(None)).otherwise(
        F.element_at(F.array(*[F.lit(k) for k in kinds]), length % len(kinds) + 1))


def serif_type(token: Column) -> Column:
    return _typed(F.length(token), 5, SERIF_TYPES)


def lingpipe_type(token: Column) -> Column:
    return _typed(F.length(token), 4, LINGPIPE_TYPES)


def _kinds(lengths: np.ndarray, shortest: int, kinds: tuple[str, ...]) -> pa.Array:
    """As :func:`_typed`, for many tokens."""
    return pa.array(kinds, pa.string()).take(pa.array(lengths % len(kinds), mask=lengths < shortest))


def _two_taggers(words: pa.Array) -> pa.Array:
    """The sentence maps of many texts from the words of their sentences; a null text has null in each tagger's place."""
    sentences = words.flatten()
    tokens, lemmas = sentences.flatten().flatten()
    lengths = pc.utf8_length(tokens).to_numpy(zero_copy_only=False)
    inner = pa.array(np.concatenate([[0], np.cumsum(laid(sentences)[0])]), pa.int32())
    sizes = laid(words)[0]
    ends = np.cumsum(sizes)
    # Both taggers' sentences are laid end to end, and a text's map has its part of each.
    both = []
    for kinds in (_kinds(lengths, 5, SERIF_TYPES), _kinds(lengths, 4, LINGPIPE_TYPES)):
        token = pa.StructArray.from_arrays([tokens, lemmas, kinds], ["token", "lemma", "entity_type"])
        both.append(pa.StructArray.from_arrays([pa.ListArray.from_arrays(inner, token)], ["tokens"]))
    n = len(words)
    pieces = np.stack([ends - sizes, ends - sizes + len(sentences)], axis=1).reshape(-1)
    order = np.repeat(pieces, np.repeat(sizes, 2)) + places(np.repeat(sizes, 2))
    bounds = np.concatenate([[0], np.cumsum(np.repeat(sizes, 2))])
    missing = np.repeat(words.is_null().to_numpy(zero_copy_only=False), 2)
    values = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.concat_arrays(both).take(pa.array(order)), mask=pa.array(missing))
    return pa.MapArray.from_arrays(pa.array(np.arange(n + 1) * 2, pa.int32()), pa.array(TAGGERS * n, pa.string()), values)


_SENTENCES = "map<string, array<struct<tokens: array<struct<token: string, lemma: string, entity_type: string>>>>>"


def _sentence_map(text: Column) -> Column:
    """The sentences of both taggers; words and their lower case are found once for both."""
    found = F.transform(F.split(text, "\n"), lambda s: F.transform(
        words(s), lambda t: F.struct(t.alias("token"), F.lower(t).alias("lemma"))))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for tokens in batches:
            yield in_parts((tokens,), 4 * laid(tokens)[0], _two_taggers)

    return F.arrow_udf(run, _SENTENCES)(found)


def timed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the time of the event of the same number."""
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("doc_id"), F.col("ts").cast("timestamp").alias("ts"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return records(docs.join(events, "doc_id"))


def records(joined: DataFrame, *keep: str) -> DataFrame:
    """Flat columns of the corpus records from documents with a time, and the ``keep`` columns."""
    epoch = F.unix_seconds("ts")
    key = F.md5(F.col("doc_id").cast("string"))
    host = F.concat("source", F.lit(".example.com"))
    return joined.select(
        key.alias("doc_id"),
        F.concat_ws("-", epoch.cast("string"), key).alias("stream_id"),
        epoch.alias("epoch"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("zulu"),
        host.alias("schost"),
        F.concat(F.lit("http://"), host, F.lit("/"), F.col("lang"), F.lit("/"), F.col("doc_id").cast("string")).alias("url"),
        "source", "text",
        F.concat_ws("-", "source", F.concat(F.date_format("ts", "yyyyMMdd"), F.lit(".parquet"))).alias("src_file"),
        *keep,
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corpus records in the layout of :data:`tidewell.model.STREAM_ITEM`."""
    return stream_items(timed_documents(spark, sf_dir))


def stream_items(flat: DataFrame) -> DataFrame:
    first = F.substring_index("text", "\n", 1)
    return flat.select(
        "stream_id", "doc_id",
        F.encode("url", "UTF-8").alias("abs_url"),
        "schost", "source",
        F.struct(F.col("epoch").cast("double").alias("epoch_ticks"), F.col("zulu").alias("zulu_timestamp")).alias("stream_time"),
        F.struct(
            F.col("text").alias("clean_visible"),
            F.lit(None).cast("string").alias("clean_html"),
            _sentence_map(F.col("text")).alias("sentences"),
        ).alias("body"),
        F.create_map(F.lit("title"), F.struct(
            first.alias("clean_visible"), _sentence_map(first).alias("sentences"))).alias("other_content"),
        "src_file",
    )


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences with the labels of a second tagger; ``O`` is the background."""
    def label(token: Column) -> Column:
        kind = serif_type(token)
        out = F.lit("O")
        for name, other in RETAGGED.items():
            out = F.when(kind == name, other).otherwise(out)
        return out

    return timed_documents(spark, sf_dir).select("stream_id", "doc_id", F.transform(
        F.split("text", "\n"),
        lambda s: F.transform(words(s), lambda t: F.struct(t.alias("token"), label(t).alias("label"))),
    ).alias("sentences"))


def page_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages as records; they carry no time."""
    key = F.md5(F.col("page_id").cast("string"))
    unseen = F.regexp_replace("html", r"(?is)<(script|style)[^>]*>.*?</(script|style)>|<!--.*?-->", " ")
    return table(spark, sf_dir, "pages").select(
        F.concat(F.lit("0-"), key).alias("stream_id"),
        key.alias("doc_id"),
        F.encode("url", "UTF-8").alias("abs_url"),
        host_of(F.col("url")).alias("schost"),
        F.struct(plain_text(unseen).alias("clean_visible"), F.col("html").alias("clean_html")).alias("body"),
    )


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, text)`` of the documents, without their time."""
    return table(spark, sf_dir, "documents").select("doc_id", "text").select(
        F.md5(F.col("doc_id").cast("string")).alias("doc_id"), "text")


def record_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(stream_id, doc_id, text)`` of the corpus records; a document's id may come more than once, a record's does not."""
    return timed_documents(spark, sf_dir).select("stream_id", "doc_id", "text")


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(page, url, href, text)`` of every link in the pages."""
    link = F.lit(r'(?is)<a href="([^"]*)"[^>]*>(.*?)</a>')
    found = table(spark, sf_dir, "pages").select(
        F.md5(F.col("page_id").cast("string")).alias("page"), "url",
        F.arrays_zip(
            F.regexp_extract_all("html", link, F.lit(1)).alias("href"),
            F.regexp_extract_all("html", link, F.lit(2)).alias("text")).alias("links"))
    return unnest(found, ["page", "url"], "links", "href", "text")


def anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(page, target, spot)`` of every link in the pages that has a text."""
    spot = F.lower(F.trim(F.regexp_replace("text", r"[^\pL]+", " ")))
    return page_links(spark, sf_dir).select("page", F.col("href").alias("target"), spot.alias("spot")).filter(F.col("spot") != "")


def kb_names(anchors: DataFrame) -> DataFrame:
    """Knowledge-base names ``(kb_id, norm, score)``: normal forms of the link texts in the pages, scored by their links."""
    named = anchors.groupBy(norm_form(F.col("spot")).alias("norm")).agg(F.count(F.lit(1)).cast("int").alias("score"))
    return named.filter(F.col("norm") != "").select(F.concat(F.lit("kb:"), F.substring(F.md5("norm"), 1, 8)).alias("kb_id"), "norm", "score")


def lemma_table(entities: DataFrame) -> DataFrame:
    """``(form, lemma)`` of the words in the entities that end in ``s`` and also occur without it."""
    forms = entities.select(F.explode(F.split(F.trim("entity"), " ")).alias("form")).distinct()
    plural = forms.filter(F.col("form").endswith("s") & (F.length("form") > 3)).select(
        "form", F.expr("substring(form, 1, length(form) - 1)").alias("lemma"))
    return plural.join(forms.select(F.col("form").alias("lemma")), "lemma", "left_semi").select("form", "lemma")


def stopwords(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(F.explode(F.array(*[F.lit(w) for w in STOPWORDS])).alias("term"))


def topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics ``(number, title)``, the benchmark passages as they are."""
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("number"), F.col("text").alias("title"))


def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(stream_id, doc_id, text)`` of the pages' visible text."""
    return page_items(spark, sf_dir).select("stream_id", "doc_id", F.col("body.clean_visible").alias("text"))


def entity_labels(anchors: DataFrame) -> DataFrame:
    """``(entity, label)``: the text most links to a target have (of equals, the first); targets of one link have none."""
    texts = anchors.groupBy("target", "spot").agg(F.count(F.lit(1)).alias("n"))
    return texts.groupBy(F.col("target").alias("entity")).agg(
        F.min_by("spot", F.struct(-F.col("n"), "spot")).alias("label"), F.sum("n").alias("_links")).filter(F.col("_links") > 1).drop("_links")


EVENTS = "event_id long, ts timestamp_ntz"


def timed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat corpus records with their ``ts`` as a stream: arriving events with the documents they announce.

    The events come in four files, days mixed, a file to a micro-batch.
    """
    arrived = scratch_path(spark, "events")
    table(spark, sf_dir, "events").select("event_id", "ts").repartition(4, "event_id").write.parquet(arrived)
    events = (
        spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(arrived)
        .select(F.col("event_id").alias("doc_id"), F.col("ts").cast("timestamp").alias("ts"))
    )
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return records(events.join(docs, "doc_id"), "ts")
