"""Similarity join of documents on the Jaccard similarity of their word n-grams, by MinHash banding.

Documents with equal n-gram sets are one class. Each class has a MinHash signature; rows per band and number of
bands are chosen for a target recall at the limit, and band hashes are shuffled. Classes that share a band are
compared by their sketches (one byte per hash); what may reach the limit is joined to candidate components. Only
their texts are fetched, once per class, and all pairs within a component are verified on the full n-gram sets.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm import common
from tidewell.session import materialize

WORDS = 5
LIMIT = 0.8
#: Share of pairs exactly at the limit that meet in a band, at least.
RECALL = 0.9995
#: Hash functions at most.
HASHES = 128
#: Standard errors by which a sketch's estimate may fall short of the limit.
DEVIATIONS = 4.5
SEED = 20240607
_SPACES = " \t\n\x0b\f\r"
_BREAKS = "\t\n\x0b\f\r"
_KNOWN_WORDS = 1 << 20


@dataclass(frozen=True)
class Bands:
    rows: int
    count: int

    @property
    def hashes(self) -> int:
        return self.rows * self.count


def choose(limit: float = LIMIT, recall: float = RECALL, hashes: int = HASHES) -> Bands:
    """As many rows per band as the recall at ``limit`` allows with at most ``hashes`` hash functions.

    More rows let fewer unlike documents meet, and then need more bands.
    """
    best = Bands(1, max(1, math.ceil(math.log(1 - recall) / math.log1p(-limit)))) if limit < 1 else Bands(1, 1)
    for rows in range(1, hashes + 1):
        met = limit ** rows
        count = 1 if met >= 1 else math.ceil(math.log(1 - recall) / math.log1p(-met))
        if rows * count <= hashes:
            best = Bands(rows, count)
    return best


@functools.lru_cache(maxsize=1)
def _word_hashes() -> dict[str, int]:
    return {}


def shingles(text: str | None, width: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``width`` lower-case words; a shorter text is one run.

    Words are separated by ASCII white space; a text without words has none.
    """
    if not text:
        return np.empty(0, np.uint64)
    for sign in _BREAKS:
        if sign in text:
            text = text.replace(sign, " ")
    words = [w for w in text.lower().split(" ") if w]
    if not words:
        return np.empty(0, np.uint64)
    known = _word_hashes()
    if len(known) > _KNOWN_WORDS:
        known.clear()
    fresh = set(words).difference(known)
    known.update((word, xxhash.xxh3_64_intdigest(word)) for word in fresh)
    hashed = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    for word in fresh:
        if len(word) > 64:
            del known[word]
    span = min(width, len(words))
    mixed = np.zeros(len(words) - span + 1, np.uint64)
    for i in range(span):
        mixed = (mixed ^ hashed[i:len(hashed) - span + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed + np.uint64(span))


@functools.lru_cache(maxsize=4)
def _functions(count: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(SEED)
    high = np.iinfo(np.uint64).max
    return draw.integers(1, high, count, np.uint64) | np.uint64(1), draw.integers(0, high, count, np.uint64)


def minhash(grams: np.ndarray, bands: Bands, block: int = 4096) -> np.ndarray:
    """The least hash of the set under each function, in pieces of ``block`` n-grams."""
    times, plus = _functions(bands.hashes)
    least = np.full(bands.hashes, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(grams), block):
        mixed = grams[None, at:at + block] * times[:, None] + plus[:, None]
        mixed ^= mixed >> np.uint64(32)
        least = np.minimum(least, mixed.min(axis=1))
    return least


def _signed(rows: DataFrame, bands: Bands) -> DataFrame:
    """``member, text_key, class, grams, bands, sketch`` of every row; a null class without words."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for member, key, text in zip(frame["member"], frame["text_key"], frame["text"], strict=True):
                grams = shingles(text)
                if not len(grams):
                    out.append((member, key, None, 0, None, None))
                    continue
                least = minhash(grams, bands)
                cut = least.reshape(bands.count, bands.rows)
                keys = [xxhash.xxh3_64_intdigest(row.tobytes(), seed=i) - (1 << 63) for i, row in enumerate(cut)]
                out.append((
                    member, key, xxhash.xxh3_128_hexdigest(grams.tobytes()), len(grams), np.array(keys, np.int64),
                    (least & np.uint64(255)).astype(np.uint8).tobytes()))
            yield pd.DataFrame(out, columns=["member", "text_key", "class", "grams", "bands", "sketch"]).astype({"member": "Int64"})

    return rows.mapInPandas(run, "member long, text_key long, class string, grams long, bands array<long>, sketch binary")


def text_key(text: Column) -> Column:
    """Tells the texts of rows that repeat an id apart."""
    return F.xxhash64(text)


def likely(block: common.Arrays, bands: Bands, limit: float) -> np.ndarray:
    """Symmetric matrix of pairs whose sketches and set sizes do not rule out the limit."""
    sketch = np.frombuffer(b"".join(block["sketch"]), np.uint8).reshape(-1, bands.hashes)
    size = block["grams"].astype(float)
    n = len(sketch)
    agree = np.zeros((n, n))
    for i in range(n):
        agree[i] = (sketch == sketch[i]).mean(axis=1)
    estimate = (agree - 1 / 256) / (1 - 1 / 256)
    short = limit - DEVIATIONS * math.sqrt(limit * (1 - limit) / bands.hashes)
    pairs = (estimate >= short) & (np.minimum(size[:, None], size[None, :]) >= limit * np.maximum(size[:, None], size[None, :]))
    np.fill_diagonal(pairs, False)
    return pairs


def verified(block: common.Arrays, limit: float, chunk: int = 8192) -> np.ndarray:
    """Symmetric matrix of the pairs of this piece of work whose full n-gram sets reach the limit."""
    sets = [np.frombuffer(data, np.uint64) for data in block["shingles"]]
    sizes = np.array([len(s) for s in sets], float)
    n = len(sets)
    every = np.concatenate(sets)
    row = np.repeat(np.arange(n), sizes.astype(np.int64))
    values, column, seen = np.unique(every, return_inverse=True, return_counts=True)
    shared = seen[column] > 1
    place = np.cumsum(seen > 1) - 1
    row, column = row[shared], place[column[shared]]
    both = np.zeros((n, n))
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    width = int((seen > 1).sum())
    for at in range(0, width, chunk):
        part = slice(*np.searchsorted(column, [at, at + chunk]))
        has = np.zeros((n, min(chunk, width - at)), np.float32)
        has[row[part], column[part] - at] = 1
        both += has @ has.T
    # |A and B| / |A or B| >= limit, in whole numbers scaled by the limit's denominator.
    linked = both >= limit * (sizes[:, None] + sizes[None, :] - both) - 1e-9
    np.fill_diagonal(linked, False)
    if block["side_a"][0] != block["side_b"][0]:
        linked &= block["own"][:, None] != block["own"][None, :]
    return linked


def join(docs: DataFrame, limit: float = LIMIT, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text_key, n_links, component_id, kept`` of every row.

    Two documents link when their sets of word 5-grams have a Jaccard similarity of ``limit`` or more; a text with
    fewer words is one n-gram. ``n_links`` counts other rows linked directly, copies each; ``component_id`` is the
    least id that links reach; ``kept`` is true for that document. Null ids, null texts and texts without words link
    with nothing and are kept. Rows that repeat an id and text are copies of one document:
    they are kept or not together. Other columns are not read.
    """
    bands = choose(limit)
    common.text_batches(docs)
    source = docs.select(F.col(doc).cast("long").alias("member"), F.col(text).alias("text"), text_key(F.col(text)).alias("text_key"))
    signed = materialize(_signed(source, bands), "signed")
    facts = signed.filter("member is not null and class is not null")
    # An id may come with several texts, so classes are told apart by a number of their own, stored with them.
    classes = materialize(facts.groupBy("class").agg(
        F.min(F.struct("member", "text_key")).alias("least"), F.count(F.lit(1)).alias("copies"), F.first("grams").alias("grams"),
        F.first("bands").alias("bands"), F.first("sketch").alias("sketch")).select(
            F.monotonically_increasing_id().alias("node"), "class", "least.*", "copies", "grams", "bands", "sketch"), "classes")
    slim = classes.select("node", F.posexplode("bands").alias("band", "key")).select(
        F.xxhash64("band", "key").alias("bucket"), "node")
    payload = classes.select("node", "grams", "sketch")
    met = common.block_pairs(common.shared_buckets(slim).join(payload, "node"), F.col("size"), F.col("node"))

    def candidates(block: common.Arrays) -> common.Arrays | None:
        a, b = common.stars(likely(block, bands, limit), block["node"])
        return {"a": a, "b": b} if len(a) else None

    near = materialize(
        common.sweep(met.drop("size", "own"), ["bucket", "side_a", "side_b"], candidates, "a long, b long").distinct(), "candidates")
    groups = materialize(common.components(near).withColumnRenamed("component", "group"), "groups")
    linked = _verify(source, groups, classes.select("node", "class", "member", "text_key", "copies"), limit)
    linked = common.least_members(linked, classes)
    answer = materialize(
        classes.select("class", "node", "member", "copies").join(linked, "node", "left").select(
            "class", F.col("copies").alias("n"), (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "member").alias("component_id")), "answer")
    joined = common.lookup_join(facts.select("member", "text_key", "class"), answer, "class", "n").select(
        F.col("member").alias("doc_id"), "text_key", "n_links", "component_id",
        (F.col("member") == F.col("component_id")).alias("kept"))
    alone = signed.filter("member is null or class is null").select(
        F.col("member").alias("doc_id"), "text_key", F.lit(0).cast("long").alias("n_links"),
        F.col("member").alias("component_id"), F.lit(True).alias("kept"))
    return joined.unionByName(alone)


def _verify(source: DataFrame, groups: DataFrame, classes: DataFrame, limit: float) -> DataFrame:
    """``node, others, component`` of the classes in candidate groups, from all pairs within a group."""
    sizes = materialize(groups.groupBy("group").agg(F.count(F.lit(1)).alias("n")).withColumn("size", F.col("n")), "sizes")
    grouped = materialize(common.lookup_join(groups, sizes, "group", "n").join(classes, "node"), "grouped")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sets = [shingles(t) for t in frame["text"]]
            # Texts of an id may share a key: only the class's own set counts.
            own = [xxhash.xxh3_128_hexdigest(s.tobytes()) == c for s, c in zip(sets, frame["class"], strict=True)]
            out = frame.drop(columns=["text", "class"])
            out["shingles"] = [s.tobytes() for s in sets]
            yield out[own]

    # By shuffle whatever the sizes: groups hold a share of the documents, so they grow with them.
    texts = source.join(grouped.hint("merge"), ["member", "text_key"]).select("node", "group", "size", "copies", "class", "text")
    # Rows that repeat an id and text bring a class's set more than once; all of a node's sets are equal.
    full = texts.mapInPandas(run, "node long, group long, size long, copies long, shingles binary").dropDuplicates(["node"])
    pairs = common.block_pairs(full, F.col("size"), F.col("node")).drop("size")

    def check(block: common.Arrays) -> common.Arrays:
        linked = verified(block, limit)
        a, b = common.stars(linked, block["node"])
        none = np.full(len(a), -1, np.int64)
        return {
            "a": np.concatenate([block["node"], a]), "b": np.concatenate([block["node"], b]),
            "others": np.concatenate([linked.astype(np.int64) @ block["copies"], none])}

    found = materialize(common.sweep(pairs, ["group", "side_a", "side_b"], check, "a long, b long, others long"), "verified")
    nodes = common.components(found.filter("others < 0").select("a", "b"))
    others = found.filter("others >= 0").groupBy(F.col("a").alias("node")).agg(F.sum("others").alias("others"))
    return others.join(nodes, "node", "left").select("node", "others", F.coalesce("component", "node").alias("component"))
