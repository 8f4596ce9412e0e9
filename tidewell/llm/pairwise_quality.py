"""Quality scores learned from preference pairs (Bradley and Terry 1952).

A document labelled good is preferred to one labelled bad. The log-odds of a preference is a weight vector
times the difference of the two documents' features, fitted by logistic loss; the same weights give every
document a score of its own. The limit is the quantile of the training scores that tells the labels apart best.
Both are fitted on all labelled documents: sums over pairs and ranges of scores are worked out in the tasks.
"""

from __future__ import annotations

import itertools
import math
import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm import common
from tidewell.operators.index import number_in_order
from tidewell.session import materialize

#: Labelled documents of each label that the first weights come from, at most; what is fitted on all does not depend on them.
START = 4000
#: Partners of each document of the label with more documents.
PARTNERS = 8
PENALTY = 1e-3
#: Score at the limit.
LIMIT = 0.7
#: Scores in order that one task counts.
_RANGE = 1 << 20
_SPACES = np.frombuffer(b" \t\n\x0b\f\r", np.uint8)
_SYMBOLS = np.frombuffer(b"#*$%&|<>{}[]=@^~_/\\", np.uint8)
_MARKS = np.frombuffer(b"!?", np.uint8)
_STOPS = np.frombuffer(b".,;:", np.uint8)
_DIGITS = np.frombuffer(b"0123456789", np.uint8)
_CAPITALS = np.arange(65, 91)
_OTHER_CAPITALS = regex.compile(r"[^\x00-\x7F\P{Lu}]")
FEATURES = ("word", "symbol", "mark", "capital", "digit", "stop", "variety", "again", "line", "brief")


def _share(part: float, whole: float) -> float:
    return math.sqrt(part / (whole + 20.0))


def features_of(text: str) -> list[float]:
    """Ten numbers of a text, from its characters, words (parts between ASCII white space) and lines."""
    data = text.encode()
    signs = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    count = lambda chosen: int(signs[chosen].sum())
    k = len(text) - count(_SPACES)
    capitals = count(_CAPITALS)
    if not text.isascii():
        capitals += len(_OTHER_CAPITALS.findall(text))
    words = data.split()
    n = len(words)
    lines = [line for line in data.split(b"\n") if line.strip(b" ")]
    return [
        math.log((k + 100.0) / (n + 20.0)),
        _share(count(_SYMBOLS), k), _share(count(_MARKS), k), _share(capitals, k), _share(count(_DIGITS), k), _share(count(_STOPS), k),
        math.log(len(set(words)) + 1.0) / math.log(n + 2.0),
        _share(sum(map(operator.eq, words, itertools.islice(words, 1, None))), n),
        _share(len(lines) - len(set(lines)), len(lines)),
        math.exp(-n / 10.0),
    ]


def features(text: Column) -> Column:
    """The ten numbers of each text (``array<double>``), in one pass; a null text counts as empty."""

    def run(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in series:
            yield pd.Series([features_of(t or "") for t in texts], dtype=object)

    return F.pandas_udf(run, "array<double>")(text)


@dataclass(frozen=True)
class Model:
    """Weights of the features, offset and training quantile of the limit; ``score`` is :data:`LIMIT` at the limit."""

    weights: tuple[float, ...]
    limit: float
    quantile: float

    def score(self, rows: list[list[float]]) -> np.ndarray:
        raw = np.array(rows, float).reshape(-1, len(FEATURES)) @ np.array(self.weights) - self.limit
        return 1 / (1 + np.exp(-np.clip(raw + math.log(LIMIT / (1 - LIMIT)), -700, 700)))


#: Where there are no two labels to compare: every document is at the limit.
NEUTRAL = Model((0.0,) * len(FEATURES), 0.0, 0.0)


def fit_pairs(good: np.ndarray, bad: np.ndarray, seed: int = 7) -> Model:
    """Fit the weights on differences of ``good`` and ``bad`` feature rows by Newton steps."""
    if not len(good) or not len(bad):
        return NEUTRAL
    both = np.concatenate([good, bad])
    scale = np.maximum(both.std(axis=0), 1e-6)
    draw = np.random.default_rng(seed)
    pairs = max(len(bad) * PARTNERS, len(good))
    i, j = draw.integers(len(good), size=pairs), np.arange(pairs) % len(bad)
    i[:len(good)] = np.arange(len(good))
    difference = (good[i] - bad[j]) / scale
    w = np.zeros(difference.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(np.clip(difference @ w, -30, 30)))
        gradient = difference.T @ p / pairs - PENALTY * w
        curve = (difference * (p * (1 - p))[:, None]).T @ difference / pairs + PENALTY * np.eye(len(w))
        step = np.linalg.solve(curve, gradient)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    w = w / scale
    raw = both @ w
    order = np.argsort(raw, kind="stable")
    is_bad = np.r_[np.zeros(len(good)), np.ones(len(bad))][order]
    # Limit after the k lowest scores: bad ones below and good ones above it are right.
    below = np.r_[0, np.cumsum(is_bad)]
    right = below / len(bad) + (len(good) - (np.arange(len(both) + 1) - below)) / len(good)
    best = np.flatnonzero(right >= right.max() - 1e-12)
    k = int(best[len(best) // 2])
    ends = np.r_[raw[order[0]] - 1, raw[order], raw[order[-1]] + 1]
    return Model(tuple(map(float, w)), float((ends[k] + ends[k + 1]) / 2), k / len(both))


def held_out(doc: Column) -> Column:
    """Rows that never train: CRC-32 of the id as text leaves 2 by 4 (a null id is none of them)."""
    return F.coalesce(F.crc32(doc.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, start: int = START, doc: str = "doc_id", text: str = "text") -> Model:
    """Fit on all labelled documents that are not held out.

    An id with both labels is left out; labels that are null or neither 0 nor 1 are ignored. Of an id's rows the one
    with the least text hash counts. Newton steps begin at the weights of at most ``start`` documents of each label,
    which are all that reaches the driver; they end at those of all pairs.
    """
    common.text_batches(docs)
    known = labels.select(F.col(doc).alias("id"), F.col("quality").alias("label")).filter(
        F.col("label").isin(0, 1) & F.col("id").isNotNull() & ~held_out(F.col("id")))
    one = known.groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("other")).filter("label = other").drop("other")
    # Features before the join: it moves ten numbers a document, not its text.
    read = docs.filter(F.col(doc).isNotNull() & ~held_out(F.col(doc))).select(
        F.col(doc).alias("id"), F.xxhash64(F.col(text)).alias("hash"), features(F.col(text)).alias("x"))
    rows = materialize(read.join(one, "id").groupBy("id", "label").agg(F.min(F.struct("hash", "x")).alias("least")).select(
        "id", F.col("label").cast("int").alias("label"), "least.x"), "labelled")
    spread = [F.stddev_pop(F.get("x", F.lit(i))) for i in range(len(FEATURES))]
    good, total, *deviations = rows.agg(F.coalesce(F.sum("label"), F.lit(0)), F.count(F.lit(1)), *spread).first()
    if not 0 < good < total:
        return NEUTRAL
    scale = np.maximum(np.array(deviations), 1e-6)
    weights = _fit_all(_pairs(rows, int(good < total - good), min(good, total - good)), _first(rows, start) * scale, scale) / scale
    # Nine digits, so that sums in another order give the same model.
    weights = np.array([float(f"{w:.9g}") for w in weights])
    limit, quantile = _limit(rows, weights, good, total - good)
    return Model(tuple(map(float, weights)), limit, quantile)


def _first(rows: DataFrame, start: int) -> np.ndarray:
    """Weights of at most ``start`` documents of each label, those with the least hash."""
    part = lambda value: np.array([r["x"] for r in rows.filter(F.col("label") == value).orderBy(
        F.xxhash64("id"), "id").limit(start).collect()], float).reshape(-1, len(FEATURES))
    return np.array((fit_pairs(part(1), part(0)) or NEUTRAL).weights)


def _pairs(rows: DataFrame, fewer: int, count: int) -> DataFrame:
    """``(label, x, partners)``: each document of the label with more, and the features of its partners laid end to end.

    The ``count`` documents of the label with ``fewer`` are dealt to groups of :data:`PARTNERS` in order of their hash, and
    the others to these groups in turn. So each document of either label is in a pair, and no group is larger.
    """
    hashed = rows.withColumn("key", F.struct(F.xxhash64("id").alias("hash"), "id")).drop("id")
    few = number_in_order(hashed.filter(F.col("label") == fewer), "key", "n")
    groups = few.groupBy(F.floor(F.col("n") / PARTNERS).alias("group")).agg(F.sort_array(F.collect_list(F.struct("n", "x"))).alias("all"))
    many = number_in_order(hashed.filter(F.col("label") != fewer), "key", "n").select(
        "label", "x", F.pmod("n", F.lit(-(-count // PARTNERS))).alias("group"))
    return materialize(many.join(groups, "group").select("label", "x", F.flatten(F.col("all")["x"]).alias("partners")), "pairs")


def _fit_all(pairs: DataFrame, w: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Newton steps from ``w`` on the scaled differences of all pairs; a task gives the sums of its pairs."""
    p = len(scale)

    def sums(w: np.ndarray):
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros(2 + p + p * p)
            for frame in frames:
                if frame.empty:
                    continue
                others = np.concatenate(frame["partners"].to_numpy()).reshape(-1, p)
                each = frame["partners"].map(len).to_numpy() // p
                sign = np.where(frame["label"] == 1, 1.0, -1.0)
                difference = np.repeat(sign, each)[:, None] * (np.repeat(np.stack(frame["x"].to_numpy()), each, axis=0) - others) / scale
                margin = difference @ w
                chance = 1 / (1 + np.exp(np.clip(margin, -30, 30)))
                total[:2] += len(difference), np.logaddexp(0, -margin).sum()
                total[2:2 + p] += difference.T @ chance
                total[2 + p:] += ((difference * (chance * (1 - chance))[:, None]).T @ difference).reshape(-1)
            yield pd.DataFrame({"total": [total]})

        return run

    # Without weights the loss is log 2; where a step makes it greater, half of the step is tried.
    least, last = math.log(2), np.zeros(p)
    for _ in range(60):
        total = np.sum([r["total"] for r in pairs.mapInPandas(sums(w), "total array<double>").collect()], axis=0)
        total, loss = total / total[0], total[1] / total[0] + PENALTY / 2 * (w @ w)
        if loss > least + 1e-12:
            w = (w + last) / 2
            continue
        step = np.linalg.solve(total[2 + p:].reshape(p, p) + PENALTY * np.eye(p), total[2:2 + p] - PENALTY * w)
        least, last, w = loss, w, w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _limit(rows: DataFrame, weights: np.ndarray, good: int, bad: int) -> tuple[float, float]:
    """Limit and quantile after the ``k`` lowest scores: bad ones below and good ones above it are right.

    The rows are put in ranges of their scores; counts in a range go on from those of the ranges before. Of several best
    places the middle one is taken.
    """
    def raw(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for x in series:
            yield pd.Series((np.stack(x.to_numpy()) * weights).sum(axis=1) if len(x) else np.zeros(0))

    scored = rows.select("id", (1 - F.col("label")).alias("bad"), F.pandas_udf(raw, "double")("x").alias("raw"))
    key = F.struct("raw", "bad", "id").alias("key")
    placed = number_in_order(scored.select(key), "key", "at").select(
        (F.col("at") + 1).alias("k"), "key.raw", "key.bad", F.floor(F.col("at") / _RANGE).alias("range"))
    placed = materialize(placed, "scores")
    ranges = placed.groupBy("range").agg(F.sum("bad").alias("n"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("range").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    below = F.col("start") + F.sum("bad").over(inside)
    # Whole numbers: shares of right ones times the documents of both labels. Place 0 has all bad ones wrong.
    right = (below * F.lit(good) + (F.lit(good) - (F.col("k") - below)) * F.lit(bad)).cast("decimal(38,0)")
    places = placed.join(F.broadcast(starts), "range").select("k", right.alias("right"))
    places = materialize(places.unionByName(rows.sparkSession.range(1).select(
        F.lit(0).cast("long").alias("k"), (F.lit(good).cast("decimal(19,0)") * F.lit(bad)).cast("decimal(38,0)").alias("right"))), "places")
    best = places.join(F.broadcast(places.agg(F.max("right").alias("right"))), "right").select("k")
    k = best.orderBy("k").offset(best.count() // 2).first()["k"]
    ends = {r["k"]: r["raw"] for r in placed.filter(F.col("k").isin(k, k + 1)).collect()}
    low, high = ends.get(k, ends.get(k + 1, 0.0) - 1), ends.get(k + 1, ends.get(k, 0.0) + 1)
    return (low + high) / 2, k / (good + bad)


def with_score(docs: DataFrame, model: Model, out: str = "score", text: str = "text") -> DataFrame:
    """``docs`` with the score of the whole text; an input column of that name is replaced.

    Null and empty texts are scored as texts without words; repeated rows get equal scores.
    """
    def run(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in series:
            yield pd.Series(model.score([features_of(t or "") for t in texts]))

    common.text_batches(docs)
    return docs.withColumn(out, F.pandas_udf(run, "double")(text))
