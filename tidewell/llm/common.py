"""Helpers the operators share: batches, lookups without a hot task, blocks of groups, components."""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.session import materialize

#: A key with at least one in so many of all rows is hot; there are at most as many such keys.
HOT_KEYS = 1000
#: Members of a group that are compared with each other in one piece of work.
BLOCK = 128
#: Rows in an Arrow batch, so that a batch of very long texts fits a Python worker.
BATCH_ROWS = 256


@contextlib.contextmanager
def batches(spark: SparkSession, rows: int = BATCH_ROWS) -> Iterator[None]:
    """Plans that are made and run inside send at most ``rows`` rows to Python at a time."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def text_batches(df: DataFrame, rows: int = BATCH_ROWS) -> None:
    """As :func:`batches` for a plan that is run later, by the caller."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def lookup_join(
    facts: DataFrame, lookup: DataFrame, key: str, count: str, how: str = "inner", total: int | None = None,
) -> DataFrame:
    """Join ``facts`` with a stored ``lookup``, one row per ``key``, of which ``count`` facts have the key.

    Hot keys, of which there are at most :data:`HOT_KEYS` by their definition, are broadcast; their
    facts stay where they are. The rest is an ordinary join, in which no key holds many rows.
    ``count`` is dropped. ``total`` is the sum of the counts, where it is known.
    """
    if total is None:
        total = lookup.agg(F.sum(count)).first()[0] or 0
    is_hot = F.col(count) * HOT_KEYS >= F.lit(max(total, 1))
    hot, rest = lookup.filter(is_hot), lookup.filter(~is_hot).drop(count)
    near = facts.join(F.broadcast(hot.drop(count)), key, "inner")
    far = facts.join(F.broadcast(hot.select(key)), key, "left_anti").join(rest, key, how)
    return near.unionByName(far)


def block_pairs(df: DataFrame, size: Column, member: Column, block: int = BLOCK) -> DataFrame:
    """Deal the members of each group to blocks and repeat each row for the pairs its block is in.

    Adds ``side_a``, ``side_b`` (a pair of blocks, in order) and ``own`` (the row's own block). A group
    of ``n`` members has ``n / block`` blocks, so any two members meet in exactly one piece of work, or,
    if they are in one block, in the piece of that block with itself.
    """
    blocks = F.greatest(F.ceil(size / F.lit(block)), F.lit(1)).cast("int")
    return (
        df.withColumn("_blocks", blocks)
        .withColumn("own", F.pmod(F.xxhash64(member), F.col("_blocks")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        .withColumn("side_a", F.least("own", "_other")).withColumn("side_b", F.greatest("own", "_other"))
        .drop("_blocks", "_other")
    )


Arrays = dict[str, np.ndarray]


def sweep(df: DataFrame, keys: list[str], work: Callable[[Arrays], Arrays | None], schema: str) -> DataFrame:
    """Call ``work`` with the columns of each group of ``keys`` of two rows or more; one pass over sorted partitions.

    Groups are expected to be bounded, as :func:`block_pairs` makes them; a task holds one group and
    one batch at a time.
    """
    names = list(df.columns)

    def groups(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Arrays | None = None
        for frame in frames:
            if frame.empty:
                continue
            columns = {c: frame[c].to_numpy() for c in names}
            if held is not None:
                columns = {c: np.concatenate([held[c], columns[c]]) for c in names}
            change = np.zeros(len(columns[keys[0]]), bool)
            change[0] = True
            for key in keys:
                change[1:] |= columns[key][1:] != columns[key][:-1]
            starts = np.flatnonzero(change)
            done = []
            for start, stop in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                if stop - start > 1 and (out := work({c: columns[c][start:stop] for c in names})) is not None:
                    done.append(out)
            held = {c: columns[c][starts[-1]:] for c in names}
            if done:
                yield pd.DataFrame({c: np.concatenate([out[c] for out in done]) for c in done[0]})
        if held is not None and len(held[keys[0]]) > 1 and (out := work(held)) is not None:
            yield pd.DataFrame(out)

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(groups, schema)


def stars(linked: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each node to the least node of its component in the symmetric matrix ``linked``."""
    root = node.copy()
    top = np.iinfo(node.dtype).max
    while True:
        least = np.minimum(root, np.where(linked, root[None, :], top).min(axis=1))
        if (least == root).all():
            break
        root = least
    far = root != node
    return node[far], root[far]


def shared_buckets(slim: DataFrame) -> DataFrame:
    """Rows ``(bucket, node)`` of buckets with two nodes or more, with the bucket's ``size``."""
    sizes = materialize(
        slim.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1").withColumn("n", F.col("size")),
        "buckets")
    return lookup_join(slim, sizes, "bucket", "n")


def _pull(edges: DataFrame, node: str, other: str) -> DataFrame:
    """Edges with the least ``other`` of their ``node`` as ``least``."""
    least = materialize(
        edges.groupBy(node).agg(F.min(other).alias("least"), F.count(F.lit(1)).alias("n")), "least")
    return lookup_join(edges, least, node, "n")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``(a, b)``: ``(node, component)``, the component's least node, for all nodes with an edge.

    Alternates large and small stars (Kiveris et al. 2014) until each node hangs on the least one of its
    component, which takes few rounds as the edges come as stars already. Each round is stored, so a lost
    executor costs one round at most.
    """
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    down = materialize(down, "edges")
    while True:
        one = down.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("u").alias("k")).first()
        if one["n"] == one["k"] and down.join(down.select(F.col("u").alias("v")), "v", "left_semi").isEmpty():
            break
        both = down.unionByName(down.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _pull(both, "u", "v").filter("v > u").select(
            F.col("v").alias("u"), F.least("u", "least").alias("v")).distinct()
        large = materialize(large, "large")
        pulled = _pull(large, "u", "v")
        small = pulled.select("u", F.col("least").alias("v")).unionByName(
            pulled.filter("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))).distinct()
        down = materialize(small, "small")
    return down.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        down.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def least_members(linked: DataFrame, classes: DataFrame) -> DataFrame:
    """``linked`` with the least ``member`` of each ``component`` in the component's place; ``classes`` has the members of its nodes.

    Members may repeat: nodes tell classes apart, members only name the component.
    """
    named = materialize(linked.join(classes.select("node", "member"), "node"), "named")
    least = materialize(
        named.groupBy("component").agg(F.min("member").alias("least"), F.count(F.lit(1)).alias("n")), "names")
    return lookup_join(named.drop("member"), least, "component", "n").drop("component").withColumnRenamed("least", "component")
