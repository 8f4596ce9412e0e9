"""An index that grows by segments: one per delivery, marks for records delivered again, and compaction.

Under a folder, ``postings`` and ``documents`` hold a folder per segment, in order of delivery; ``marks`` holds for each
segment the records that an older segment also has. The newest delivery of a record counts. A segment is written once;
its documents come last, and a segment without them is not read, so a job that broke off leaves nothing behind that counts.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators.index import by_letter, doc_lengths, inverted_index, number_in_order, vocabulary
from tidewell.operators.joins import lookup_join
from tidewell.session import materialize
from tidewell.sources.sinks import sink

DOCUMENT = "stream_id string, doc_id string, doc_len int, segment int"
MARK = "stream_id string, segment int"
POSTING = "term string, stream_id string, doc_id string, tf int, positions array<int>, segment int, letter string"


def _read(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame:
    """All segments of one table, none where none has been written."""
    try:
        return spark.read.schema(schema).parquet(f"{path}/{name}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _alive(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """Rows of records that no newer segment has."""
    newest = marks.groupBy("stream_id").agg(F.max("segment").alias("_since"))
    joined = lookup_join(rows, newest, "stream_id", "left")
    return joined.filter(F.coalesce(F.col("segment") >= F.col("_since"), F.lit(True))).drop("_since")


def add_segment(items: DataFrame, path: str, segment: int) -> None:
    """Index ``items`` as segment ``segment``, an error if it is there already.

    A record that comes several times in one delivery is to be made unique before. Only ids of older segments are looked
    up, no older posting is read or written.
    """
    spark = items.sparkSession
    postings = inverted_index(items, fields=()).select("term", "stream_id", "doc_id", "tf", "positions")
    sink(by_letter(postings), f"{path}/postings/segment={segment}", by="letter", key="term", stay=True, compression="zstd")
    lengths = materialize(doc_lengths(items), "lengths")
    older = _read(spark, path, "documents", DOCUMENT).filter(F.col("segment") < segment).select("stream_id").distinct()
    lengths.select("stream_id").join(older, "stream_id", "left_semi").write.parquet(f"{path}/marks/segment={segment}")
    lengths.write.parquet(f"{path}/documents/segment={segment}")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``(stream_id, doc_id, doc_len, segment)`` of the records that count."""
    return _alive(_read(spark, path, "documents", DOCUMENT), _read(spark, path, "marks", MARK))


def read_postings(spark: SparkSession, path: str) -> DataFrame:
    """Postings ``(letter, term, stream_id, doc_id, tf, positions)`` of the records that count."""
    whole = _read(spark, path, "documents", DOCUMENT).select("segment").distinct()
    postings = _read(spark, path, "postings", POSTING).join(F.broadcast(whole), "segment", "left_semi")  # a row per segment
    return _alive(postings, _read(spark, path, "marks", MARK)).select("letter", "term", "stream_id", "doc_id", "tf", "positions")


def compact(spark: SparkSession, path: str, out: str, overwrite: bool = False) -> None:
    """Write the records that count as one index under ``out``, with dense numbers for terms and documents.

    ``lexicon`` has the terms in order with df and cf, ``documents`` the records in order of their id, ``postings`` both
    numbers and no id. The old segments stay for readers at work; delete their folder when there are none.

    A posting meets its record first and loses the ids there, while those of a record still stand together; what is
    shuffled by term has numbers only.
    """
    mode = "overwrite" if overwrite else "errorifexists"
    documents = number_in_order(read_documents(spark, path), "stream_id", "doc_no")
    documents.drop("segment").write.mode(mode).option("compression", "zstd").parquet(f"{out}/documents")
    lexicon = by_letter(number_in_order(vocabulary(read_postings(spark, path)), "term", "term_id"))
    sink(lexicon, f"{out}/lexicon", by="letter", key="term", overwrite=overwrite)
    # Those of older deliveries have no number.
    postings = _read(spark, path, "postings", POSTING).drop("doc_id")
    numbered = lookup_join(postings, documents.select("stream_id", "segment", "doc_no"), ["stream_id", "segment"])
    numbered = materialize(numbered.drop("stream_id", "segment"), "numbered")
    numbered = lookup_join(numbered, spark.read.parquet(f"{out}/lexicon").select("letter", "term", "term_id"), ["letter", "term"])
    sink(numbered, f"{out}/postings", by="letter", key="term_id", overwrite=overwrite, stay=True, compression="zstd")
