"""Chunk files of JSON lines, xz-compressed or plain."""

from __future__ import annotations

import lzma
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.sources.chunk_source import BATCH_LINES, MOST_TASKS, file_lines, open_folder, register

UNNAMED = "unnamed"


def _lines(path: str):
    """Lines of a chunk."""
    return file_lines(*open_folder(path))


def _numbered(spark: SparkSession, path: str, strict: bool) -> DataFrame:
    """``(chunk, number, line)`` of all lines under ``path``, numbered from 1; not ``strict``, up to where a chunk breaks off."""
    if strict:
        return register(spark).read.format("chunks").load(path).filter(F.col("line") != "")

    def read(batches):
        import pandas as pd

        for batch in batches:
            for file in batch["path"]:
                lines: list[str] = []
                first = 1
                name = os.path.basename(file)
                try:
                    for line in _lines(file):
                        lines.append(line.decode("utf-8", errors="replace"))
                        if len(lines) == BATCH_LINES:
                            yield _frame(pd, name, first, lines)
                            first, lines = first + len(lines), []
                except (EOFError, lzma.LZMAError):
                    pass  # listed by broken_chunks
                if lines:
                    yield _frame(pd, name, first, lines)

    return _files(spark, path).mapInPandas(read, "chunk string, number long, line string").filter(F.col("line") != "")


def _frame(pd, name: str, first: int, lines: list[str]):
    return pd.DataFrame({"chunk": name, "number": range(first, first + len(lines)), "line": lines})


def _parsed(lines: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Lines with the record ``r`` they hold; ``r._bad`` is the line itself where it is no such record."""
    with_bad = f"{schema}, _bad string" if isinstance(schema, str) else T.StructType(
        [*schema.fields, T.StructField("_bad", T.StringType())])
    return lines.withColumn("r", F.from_json("line", with_bad, {"columnNameOfCorruptRecord": "_bad"}))


def read_chunks(spark: SparkSession, path: str, schema: T.StructType | str, strict: bool = True) -> DataFrame:
    """Records of all chunk files under ``path``, with their ``chunk`` name.

    A chunk that breaks off is an error; without ``strict`` it gives the records read so far and is listed by
    :func:`broken_chunks`. Lines that hold no such record are listed by :func:`rejected_lines`.
    """
    good = _parsed(_numbered(spark, path, strict), schema).filter("r._bad is null")
    return good.select("chunk", "r.*").drop("_bad")


def stream_chunks(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """As :func:`read_chunks`, a stream that takes up chunk files as they arrive."""
    lines = register(spark).readStream.format("chunks").load(path).filter(F.col("line") != "")
    good = _parsed(lines, schema).filter("r._bad is null")
    return good.select("chunk", "r.*").drop("_bad")


def rejected_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """``(chunk, number, line)`` of the lines that hold no record of the schema."""
    return _parsed(_numbered(spark, path, False), schema).filter("r._bad is not null").select("chunk", "number", "line")


def broken_chunks(spark: SparkSession, path: str) -> DataFrame:
    """``(chunk, lines, error)`` of the chunk files that cannot be read to their end."""
    def check(batches):
        import pandas as pd

        for batch in batches:
            bad = []
            for file in batch["path"]:
                n = 0
                try:
                    for line in _lines(file):
                        line.decode("utf-8")
                        n += 1
                except Exception as error:
                    bad.append((os.path.basename(file), n, type(error).__name__))
            yield pd.DataFrame(bad, columns=["chunk", "lines", "error"])

    return _files(spark, path).mapInPandas(check, "chunk string, lines long, error string")


def _files(spark: SparkSession, path: str) -> DataFrame:
    """Paths under ``path``, one task each up to :data:`MOST_TASKS`; the contents are not loaded here."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    return listing.repartition(max(1, min(len(listing.inputFiles()), MOST_TASKS)))


def save_chunks(df: DataFrame, path: str, chunk: str, compress: bool = True, overwrite: bool = False) -> None:
    """Write records as JSON-lines chunk files, named by their ``chunk``.

    Rows are put in order of ``chunk`` by range, so a large chunk is cut into several files instead of going through one
    task. Files appear when the whole job has succeeded. Records without a chunk go to :data:`UNNAMED`.
    """
    fields = [c for c in df.columns if c != chunk]
    name = F.coalesce(F.col(chunk), F.lit(UNNAMED)).alias("chunk")
    lines = df.select(name, F.lit(0).cast("long").alias("number"), F.to_json(F.struct(*fields)).alias("line"))
    register(df.sparkSession)
    placed = lines.repartitionByRange(F.col("chunk"), F.xxhash64("line")).sortWithinPartitions("chunk")
    placed.write.format("chunks").option("compress", str(compress).lower()).mode("overwrite" if overwrite else "append").save(path)
