"""Doc-keyed text lines: ``key TAB value``, with the value as a JSON string or plain."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.text import json_string, json_unstring


def encode_lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """``value`` lines with the text as a JSON string."""
    return df.select(F.concat_ws("\t", F.col(key), json_string(F.col(text))).alias("value"))


def decode_lines(lines: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Split each line at its first tab and decode the rest."""
    cut = F.split("value", "\t", 2)
    return lines.filter(F.instr("value", "\t") > 0).select(
        F.get(cut, 0).alias(key), json_unstring(F.get(cut, 1)).alias(text))


def plain_lines(df: DataFrame, *columns: str) -> DataFrame:
    """``value`` lines of the columns, tab-separated."""
    return df.select(F.concat_ws("\t", *[F.col(c).cast("string") for c in columns]).alias("value"))


def read_lines(spark: SparkSession, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    return decode_lines(spark.read.text(path), key, text)
