"""Scans, projections and day counts over corpus records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.text import day_key, file_stem, host_of, hour_of, hour_of_as_millis


def has_text() -> Column:
    """The record has a body with visible text."""
    text = F.col("body.clean_visible")
    return text.isNotNull() & (text != "")


def with_text(items: DataFrame) -> DataFrame:
    return items.filter(has_text())


def doc_text(items: DataFrame) -> DataFrame:
    return with_text(items).select("doc_id", F.col("body.clean_visible").alias("text"))


def doc_url(items: DataFrame) -> DataFrame:
    """``(doc_id, url)`` of records with a body and a URL."""
    return items.filter(F.col("body").isNotNull() & F.col("abs_url").isNotNull()).select(
        "doc_id", F.decode("abs_url", "UTF-8").alias("url"))


def doc_host(items: DataFrame) -> DataFrame:
    return doc_url(items).select("doc_id", host_of(F.col("url")).alias("host"))


def doc_chunk_hour(items: DataFrame, compat: bool = False) -> DataFrame:
    """``(doc_id, file stem, time, hour)``; ``compat`` reads the seconds as milliseconds."""
    epoch = F.col("stream_time.epoch_ticks")
    return items.select(
        "doc_id",
        file_stem(F.col("src_file")).alias("chunk"),
        F.col("stream_time.zulu_timestamp").alias("time"),
        (hour_of_as_millis(epoch) if compat else hour_of(epoch)).alias("hour"),
    )


def doc_props(items: DataFrame) -> DataFrame:
    """Named properties of each record with text."""
    return with_text(items).select(
        "stream_id",
        F.col("doc_id").alias("docno"),
        F.col("schost").alias("url"),
        F.col("source").alias("type"),
        F.col("stream_time.zulu_timestamp").alias("time"),
    )


def docs_per_day(items: DataFrame) -> DataFrame:
    return items.groupBy(day_key(F.col("stream_time.epoch_ticks")).alias("day")).agg(
        F.count(F.lit(1)).alias("docs"))
