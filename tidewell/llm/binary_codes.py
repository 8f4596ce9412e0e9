"""Near-duplicate embeddings by randomised-rotation binary codes.

A unit vector is turned by random orthogonal matrices; its code is the signs of the result, and a correction
factor per rotation, the inner product of the turned vector and its code, is stored with it. The inner product of a
vector and a coded one, divided by the factor, is an unbiased estimate of their cosine with a known error
(RaBitQ, Gao and Long 2024). Pairs whose upper confidence bound is below the limit are ruled out; the others are
recomputed exactly.

Which vectors meet at all: the codes' bits are cut into bands, as many and as wide as the number of rows and the
target recall ask for, and vectors that share a band meet. Links found there give components, within which all
pairs are compared, so counts of links are whole. Equal vectors are one until the end.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm import common
from tidewell.session import materialize

LIMIT = 0.98
#: Share of pairs exactly at the limit that meet in a band, at least; closer pairs meet more surely.
RECALL = 0.9999
#: Standard errors of the confidence bounds.
DEVIATIONS = 5.0
SEED = 20240521


@dataclass(frozen=True)
class Plan:
    """Bits per band, bands, and rotations that give as many bits."""

    width: int
    bands: int
    rotations: int
    dim: int


def plan(rows: int, dim: int, limit: float = LIMIT, recall: float = RECALL) -> Plan:
    """Bands for ``rows`` vectors: so wide that unrelated vectors rarely share one, so many that the recall is met."""
    same = 1 - math.acos(limit) / math.pi
    width = min(40, max(8, math.ceil(math.log2(max(rows, 2))) + 3))
    bands = max(1, math.ceil(math.log(1 - recall) / math.log1p(-(same ** width))))
    return Plan(width, bands, math.ceil(width * bands / dim), dim)


@functools.lru_cache(maxsize=4)
def rotations(shape: Plan) -> np.ndarray:
    """Random orthogonal matrices, one below the other, the same in every task."""
    draw = np.random.default_rng(SEED)
    return np.concatenate([np.linalg.qr(draw.standard_normal((shape.dim, shape.dim)))[0] for _ in range(shape.rotations)])


def unit(data: np.ndarray, dim: int) -> np.ndarray:
    """Unit vectors in double precision from packed single-precision ones."""
    rows = np.frombuffer(b"".join(data), "<f4").astype(np.float64).reshape(-1, dim)
    # Scaled first, so that squares of very large or small components stay finite.
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def coded(vectors: np.ndarray, shape: Plan) -> tuple[np.ndarray, np.ndarray]:
    """Sign bits and correction factors (per rotation) of unit vectors."""
    turned = vectors @ rotations(shape).T
    factors = np.abs(turned).reshape(len(vectors), shape.rotations, shape.dim).sum(axis=2) / math.sqrt(shape.dim)
    return turned > 0, factors


def bands_of(bits: np.ndarray, shape: Plan) -> np.ndarray:
    """One number per band: the band's bits, with the band's number above them."""
    cut = bits[:, :shape.width * shape.bands].reshape(len(bits), shape.bands, shape.width).astype(np.int64)
    return (cut << np.arange(shape.width)).sum(axis=2) + (np.arange(shape.bands, dtype=np.int64) << shape.width)


def links(block: common.Arrays, shape: Plan, limit: float) -> np.ndarray:
    """Symmetric matrix of the pairs at or above the limit that this piece of work is to compare."""
    vectors = unit(block["vector"], shape.dim)
    n = len(vectors)
    bits = np.unpackbits(
        np.frombuffer(b"".join(block["bits"]), np.uint8).reshape(n, -1), axis=1, count=shape.rotations * shape.dim)
    factors = np.frombuffer(b"".join(block["factors"]), "<f4").astype(np.float64).reshape(n, shape.rotations)
    signs = (bits.astype(np.float64) * 2 - 1).reshape(n, shape.rotations, shape.dim) / math.sqrt(shape.dim)
    stored = (signs / factors[:, :, None]).reshape(n, -1) / shape.rotations
    estimate = (vectors @ rotations(shape).T) @ stored.T
    spread = np.sqrt((np.maximum(1 - factors ** 2, 0) / factors ** 2).sum(axis=1) / max(shape.dim - 1, 1)) / shape.rotations
    open_pair = estimate + DEVIATIONS * spread[None, :] >= limit
    # A pair is ruled out if either of its two estimates rules it out.
    open_pair &= open_pair.T
    np.fill_diagonal(open_pair, False)
    own = block["own"]
    if block["side_a"][0] != block["side_b"][0]:
        open_pair &= own[:, None] != own[None, :]
    i, j = np.nonzero(np.triu(open_pair))
    close = np.einsum("ij,ij->i", vectors[i], vectors[j]) >= limit
    linked = np.zeros((n, n), bool)
    linked[i[close], j[close]] = linked[j[close], i[close]] = True
    return linked


def _codes(distinct: DataFrame, shape: Plan) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if frame.empty:
                continue
            packed = [np.asarray(v, "<f4").tobytes() for v in frame["embedding"]]
            bits, factors = coded(unit(np.array(packed, object), shape.dim), shape)
            yield pd.DataFrame({
                "node": frame["node"], "label": frame["label"], "copies": frame["copies"], "vector": packed,
                "bits": [b.tobytes() for b in np.packbits(bits, axis=1)],
                "factors": [f.tobytes() for f in factors.astype("<f4")], "bands": list(bands_of(bits, shape)),
            })

    return distinct.mapInPandas(
        run, "node long, label string, copies long, vector binary, bits binary, factors binary, bands array<long>")


def link(rows: DataFrame, limit: float = LIMIT, vec: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row.

    Vectors link when their labels are equal and their cosine in double precision is at or above ``limit``. A null id,
    label or vector, a null or non-finite component, an empty or zero vector links with nothing. Equal vectors
    link with each other. Vectors of different length do not link. Rows that repeat an id count as copies.
    """
    usable = (
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("embedding", lambda x: x != 0))
    facts = rows.select(
        F.col(vec).alias("vec_id"), F.col(label).cast("string").alias("label"),
        F.col(embedding).cast("array<float>").alias("embedding")
    ).withColumn("class", F.when(F.coalesce(usable, F.lit(False)), F.md5(F.concat_ws(
        ",", "label", F.col("embedding").cast("array<string>")))))
    classes = materialize(facts.filter("class is not null").groupBy("class", "label").agg(
        F.first("embedding").alias("embedding"), F.min("vec_id").alias("member"), F.count(F.lit(1)).alias("copies")).withColumn(
            # An id may come with several vectors, so classes are told apart by a number of their own, stored with them.
            "node", F.monotonically_increasing_id()), "classes")
    alone = facts.filter("class is null").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    shapes = classes.groupBy(F.size("embedding").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy("dim").collect()
    found = [_link_class(classes.filter(F.size("embedding") == s["dim"]), s["dim"], limit) for s in shapes]
    if not found:
        return alone
    linked = common.least_members(functools.reduce(DataFrame.unionByName, found), classes)
    table = materialize(
        classes.select("class", "node", "member", "copies").join(linked, "node", "left").select(
            "class", F.col("copies").alias("n"),
            (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "member").alias("component_id")), "links")
    joined = common.lookup_join(facts.filter("class is not null").select("vec_id", "class"), table, "class", "n")
    return joined.select(
        "vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept")).unionByName(alone)


def _link_class(classes: DataFrame, dim: int, limit: float) -> DataFrame:
    """``node, others, component`` of the distinct vectors of one length that have links."""
    largest = classes.groupBy("label").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    shape = plan(largest, dim, limit)
    codes = materialize(_codes(classes.select("node", "label", "copies", "embedding"), shape), "codes")
    slim = codes.select("node", "label", F.explode("bands").alias("band")).select(
        F.xxhash64("label", "band").alias("bucket"), "node")
    payload = codes.select("node", "label", "copies", "vector", "bits", "factors")
    met = common.block_pairs(common.shared_buckets(slim).join(payload, "node"), F.col("size"), F.col("node"))

    def edges(block: common.Arrays) -> common.Arrays | None:
        linked = links(block, shape, limit) & (block["label"][:, None] == block["label"][None, :])
        a, b = common.stars(linked, block["node"])
        return {"a": a, "b": b} if len(a) else None

    found = materialize(common.sweep(met.drop("size", "copies"), ["bucket", "side_a", "side_b"], edges, "a long, b long"), "edges")
    nodes = materialize(common.components(found), "components")
    sizes = materialize(
        nodes.groupBy("component").agg(F.count(F.lit(1)).alias("n")).withColumn("size", F.col("n")), "sizes")
    grouped = common.lookup_join(nodes, sizes, "component", "n")
    pairs = common.block_pairs(grouped.join(payload, "node"), F.col("size"), F.col("node"))

    def counts(block: common.Arrays) -> common.Arrays | None:
        linked = links(block, shape, limit)
        return {"node": block["node"], "others": linked.astype(np.int64) @ block["copies"]}

    counted = common.sweep(pairs.drop("size", "label"), ["component", "side_a", "side_b"], counts, "node long, others long")
    return counted.groupBy("node").agg(F.sum("others").alias("others")).join(nodes, "node")
