"""Counts that go on as new chunks arrive.

Each function runs the stream over what is there now and returns the finished table. A micro-batch
writes to a folder of its own number, so one that is repeated after a failure replaces its output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.text import day_key
from tidewell.operators.spans import doc_entity_map, explode_map


def _run(stream: DataFrame, path: str, mode: str, write) -> None:
    query = (
        stream.writeStream.outputMode(mode).foreachBatch(write)
        .option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()


def _batches(stream: DataFrame, path: str, schema: str, rows_of) -> DataFrame:
    """Run the stream; the table of what ``rows_of`` gives for each micro-batch, empty where none came."""
    spark = stream.sparkSession
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{path}/table/batch=-1")

    def write(rows: DataFrame, batch: int) -> None:
        rows_of(rows).write.mode("overwrite").parquet(f"{path}/table/batch={batch}")

    _run(stream, path, "append", write)
    return spark.read.schema(schema).parquet(f"{path}/table")


def docs_per_day(stream: DataFrame, path: str) -> DataFrame:
    """Documents per day of a stream with a time ``ts``.

    Counts add up, so each micro-batch writes its own and no state is kept: however late a row comes, it counts. A
    micro-batch has all columns of its stream worked out, so only the day goes into it.
    """
    days = stream.select(F.date_format("ts", "yyyyMMdd").cast("int").alias("day"))
    stored = _batches(days, path, "day int, docs long", lambda rows: rows.groupBy("day").agg(F.count(F.lit(1)).alias("docs")))
    return stored.groupBy("day").agg(F.sum("docs").alias("docs"))


CHUNK_TOTAL = "source string, docs long, characters long"


def run_chunks(stream: DataFrame, path: str) -> None:
    """Add what has arrived since the last run to the totals of ``(chunk, text)`` records under ``path``."""
    def write(rows: DataFrame, batch: int) -> None:
        totals = rows.groupBy(F.substring_index("chunk", "-", 1).alias("source")).agg(
            F.count(F.lit(1)).alias("docs"), F.sum(F.length("text")).cast("long").alias("characters"))
        totals.write.mode("overwrite").parquet(f"{path}/table/batch={batch}")

    _run(stream, path, "append", write)


def chunk_totals(spark: SparkSession, path: str) -> DataFrame:
    """``(source, docs, characters)`` of all runs."""
    stored = spark.read.schema(CHUNK_TOTAL).parquet(f"{path}/table")
    return stored.groupBy("source").agg(F.sum("docs").alias("docs"), F.sum("characters").alias("characters"))


def entities_per_day(items: DataFrame, path: str) -> DataFrame:
    """Entity totals per day of a stream of corpus records; counted as :func:`docs_per_day`."""
    dated = items.select("stream_id", "doc_id", "body", day_key(F.col("stream_time.epoch_ticks")).alias("day"))

    def totals(rows: DataFrame) -> DataFrame:
        return explode_map(doc_entity_map(rows, "day")).groupBy("day", "entity").agg(
            F.sum("cnt").cast("long").alias("total"))

    stored = _batches(dated, path, "day int, entity string, total long", totals)
    return stored.groupBy("day", "entity").agg(F.sum("total").alias("total"))


def first_seen(stream: DataFrame, path: str) -> DataFrame:
    """Each ``stream_id`` once, whenever it or its repeats arrive.

    The state holds every id seen, on disk (RocksDB): with a watermark it would be smaller, and late records lost.
    """
    conf, key = stream.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(key)
    conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema.fields)
        return _batches(stream.dropDuplicates(["stream_id"]), path, schema, lambda rows: rows)
    finally:
        conf.set(key, before)
