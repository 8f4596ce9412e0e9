"""Corpus scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.model import STREAM_ITEM


def read_items(spark: SparkSession, *paths: str, fmt: str = "parquet") -> DataFrame:
    """Every record of every chunk, with the chunk's base name in ``src_file``."""
    schema = T.StructType([f for f in STREAM_ITEM if f.name != "src_file"])
    return (
        spark.read.schema(schema).format(fmt).load(list(paths))
        .withColumn("src_file", F.col("_metadata.file_name"))
    )


def with_chunk(df: DataFrame) -> DataFrame:
    """Add ``chunk``, the base name of the file a record was read from."""
    return df.withColumn("chunk", F.col("_metadata.file_name"))
