"""Choice of an entity for each mention: by prior, by votes of the neighbours, or by a learned score."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.functions import urls
from tidewell.functions.arrays import drop_null, let, unnest
from tidewell.functions.flat import ranks, starts_of
from tidewell.functions.text import shard_of
from tidewell.model import VOTE_EPSILON, VOTE_WINDOW
from tidewell.operators.joins import lookup_join
from tidewell.session import materialize

FEATURES = ("link_probability", "commonness", "context_relatedness", "context_weight")


def link_graph(anchors: DataFrame) -> DataFrame:
    """Distinct ``(page, target)`` edges."""
    return anchors.select("page", "target").distinct()


def url_graph(links: DataFrame) -> DataFrame:
    """Distinct ``(page, target)`` edges from rows ``(url, href)``: references resolved, one form for equal URLs.

    Pages and targets are nodes of one kind, so a page is also what other pages link to. References that are not to the
    web are left out.
    """
    target = let(urls.resolve(F.trim("href"), F.col("url")), lambda t: F.when(urls.is_web(t), urls.canonical(t)))
    edges = links.select(urls.canonical(F.col("url")).alias("page"), target.alias("target"))
    return drop_null(edges, "target").distinct()


def link_degrees(graph: DataFrame) -> DataFrame:
    """Both directions of the graph: ``(node, direction, degree)``."""
    one = F.count(F.lit(1)).alias("degree")
    incoming = graph.groupBy(F.col("target").alias("node")).agg(one).withColumn("direction", F.lit("in"))
    outgoing = graph.groupBy(F.col("page").alias("node")).agg(one).withColumn("direction", F.lit("out"))
    return incoming.unionByName(outgoing)


def related_pairs(graph: DataFrame, pages: DataFrame, among: DataFrame | None = None) -> DataFrame:
    """``(a, b, shared, relatedness)`` of the pairs ``a < b`` that at least one page links to together.

    The common pages are counted by joining the graph with itself on the page, so pairs without one never arise. With
    ``among``, a table of distinct ``target``, only those are paired; their degrees are those of the whole graph.
    """
    degree = graph.groupBy("target").agg(F.count(F.lit(1)).alias("degree"))
    edges = graph if among is None else graph.join(among, "target", "left_semi")
    common = edges.select("page", F.col("target").alias("a")).join(edges.select("page", F.col("target").alias("b")), "page").filter(
        "a < b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"))
    known = lookup_join(common, degree.select(F.col("target").alias("a"), F.col("degree").alias("in_a")), "a")
    known = lookup_join(known, degree.select(F.col("target").alias("b"), F.col("degree").alias("in_b")), "b")
    joined = known.withColumn("_pages", pages.agg(F.count(F.lit(1)).alias("n")).scalar())
    lo, hi = F.least("in_a", "in_b"), F.greatest("in_a", "in_b")
    far = (F.log(hi) - F.log("shared")) / (F.log("_pages") - F.log(lo))
    # Both entities on every page: nothing sets them apart.
    value = F.when(lo == F.col("_pages"), 1.0).otherwise(F.greatest(F.lit(0.0), 1 - far))
    return joined.select("a", "b", "shared", value.alias("relatedness"))


def relatedness(pairs: DataFrame, graph: DataFrame, pages: DataFrame) -> DataFrame:
    """``(a, b, shared, relatedness)`` of the given distinct pairs ``a < b``; zeros where no page links to both."""
    among = pairs.select(F.col("a").alias("target")).unionByName(pairs.select(F.col("b").alias("target"))).distinct()
    return pairs.join(related_pairs(graph, pages, among), ["a", "b"], "left").na.fill(0, ["shared"]).na.fill(0.0, ["relatedness"])


# --- votes of the neighbours ---

#: Mentions of a text that are worked on together, besides those around them.
PIECE = 512


def _candidate_rows(spots: DataFrame) -> DataFrame:
    """``(spot_id, place, entity, commonness, n, weight)``; the weight is the spot's if it has one candidate, else 0."""
    n = F.size("candidates")
    known = spots.select("spot_id", n.alias("n"), F.when(n == 1, F.col("link_probability")).otherwise(0.0).alias("weight"), "candidates")
    return unnest(known, ["spot_id", "n", "weight"], "candidates", "entity", "commonness", place="place")


def vote_matrix(spots: DataFrame, graph: DataFrame, pages: DataFrame) -> DataFrame:
    """``(spot_id, entries)``: what each other spot nearby gives to a spot's candidates, stored.

    A vote depends on the two spots alone, so this is a sparse product of candidates, relatedness and candidates. An
    entry is ``struct(other, place, vote, related)`` for the candidate at ``place``: ``vote`` is the mean over the other
    spot's candidates of relatedness times commonness; ``related`` is the relatedness to its only candidate times its
    weight, and 0 if it has several. Entries of zero are left out.
    """
    rows = materialize(_candidate_rows(spots), "candidates")
    among = materialize(rows.select(F.col("entity").alias("target")).distinct(), "entities")
    pairs = materialize(related_pairs(graph, pages, among).filter(F.col("relatedness") > 0), "related").select("a", "b", "relatedness")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "relatedness")).unionByName(
        among.select(F.col("target").alias("a"), F.col("target").alias("b"), F.lit(1.0).alias("relatedness")))
    mine = rows.select("spot_id", "place", F.col("entity").alias("a"))
    theirs = rows.select(F.col("spot_id").alias("other"), F.col("entity").alias("b"), "commonness", "n", "weight")
    given = mine.join(both, "a").join(theirs, "b")
    votes = given.groupBy("spot_id", "other", "place").agg(
        (F.sum(F.col("relatedness") * F.col("commonness")) / F.max("n")).alias("vote"),
        F.max(F.col("relatedness") * F.col("weight")).alias("related"))
    return materialize(votes.groupBy("spot_id").agg(
        F.sort_array(F.collect_list(F.struct("other", "place", "vote", "related"))).alias("entries")), "votes")


def _pieces(docs: DataFrame, keys: list[str], window: int) -> DataFrame:
    """Runs of at most :data:`PIECE` mentions of a text: ``(keys, first, lead, own, near)``.

    ``near`` are the run's mentions and ``window`` more on each side, ``lead`` of them before the run.
    """
    first, before = F.col("first"), F.least(F.col("first"), F.lit(window))
    starts = F.when(F.size("mentions") > 0, F.sequence(F.lit(0), F.size("mentions") - 1, F.lit(PIECE)))
    runs = docs.select(*keys, "mentions", F.explode_outer(starts).alias("first")).filter(F.col("first").isNotNull())
    return runs.select(
        *keys, "first", before.alias("lead"), F.slice("mentions", first + 1, F.lit(PIECE)).alias("own"),
        F.slice("mentions", first - before + 1, before + PIECE + window).alias("near"))


def _counts(ids: np.ndarray, lead: int, own: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct spots, each mention's among them, and how often each is in the window around each own mention.

    Sliding sums: the running total at a window's end less that at its start, less the mention itself.
    """
    distinct, at = np.unique(ids, return_inverse=True)
    here = np.zeros((len(ids) + 1, len(distinct)), np.int32)
    here[np.arange(1, len(ids) + 1), at] = 1
    totals = here.cumsum(axis=0)
    place = np.arange(lead, lead + own)
    near = totals[np.minimum(place + window + 1, len(ids))] - totals[np.maximum(place - window, 0)] - here[place + 1]
    return distinct, at, near


#: Entries of the vote matrix that a task holds at a time, and those of one spot that lie in a row on their way there.
BLOCK_ENTRIES = 1 << 20
ROW_ENTRIES = 4096
#: Pieces that one copy of a block serves, and those in an Arrow batch.
BLOCK_PIECES = 4096
BATCH_PIECES = 256
#: Candidates that are worked on together, whatever number the spots of a piece have.
BLOCK_CANDIDATES = 512

_OWN = "array<struct<start: int, end: int, spot: string, link_probability: double, spot_id: int>>"
_RECEIVED = "n_context array<int>, weight array<double>, votes array<array<double>>, related array<array<double>>"
_NO_ENTRIES = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((2, 0)))


def _entries(rows: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A block of the matrix: sorted keys (spot, other), the candidates' places, votes and relatedness."""
    if not rows:
        return _NO_ENTRIES
    spot, other, place, vote, related = (np.concatenate(column) for column in zip(*rows, strict=True))
    keys = (spot.astype(np.int64) << 32) | other
    order = np.argsort(keys, kind="stable")
    return keys[order], place[order].astype(np.int64), np.stack([vote[order], related[order]])


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Runs of ``counts`` numbers from ``starts`` on, end to end."""
    return np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())


def _receive(ids, certain, sizes, lead, own, chosen, entries, window):
    """Size and weight of the context of the ``chosen`` own mentions, their numbers of candidates, and what these receive."""
    distinct, at, near = _counts(ids, lead, own, window)
    weights, many = np.zeros(len(distinct)), np.zeros(len(distinct), np.int64)
    weights[at], many[at] = certain, sizes
    near, mine = near[chosen].astype(float), at[lead:lead + own][chosen]
    each = many[mine]
    first = np.cumsum(each) - each
    out = np.zeros((2, each.sum()))
    keys, places, values = entries
    spots = np.unique(mine)
    for part in np.split(spots, np.flatnonzero(np.diff(np.cumsum(many[spots]) // BLOCK_CANDIDATES)) + 1):
        wanted = ((distinct[part].astype(np.int64) << 32)[:, None] | distinct[None, :]).reshape(-1)
        start = np.searchsorted(keys, wanted)
        counts = np.searchsorted(keys, wanted + 1) - start
        found = _spread(start, counts)
        pair = np.repeat(np.arange(len(wanted)), counts)
        base = np.cumsum(many[part]) - many[part]
        given = np.zeros((2, many[part].sum(), len(distinct)))
        given[:, base[pair // len(distinct)] + places[found], pair % len(distinct)] = values[:, found]
        which = np.flatnonzero(np.isin(mine, part))
        spot = np.searchsorted(part, mine[which])
        to, row, column = _spread(first[which], each[which]), np.repeat(np.arange(len(which)), each[which]), _spread(base[spot], each[which])
        for kind in (0, 1):
            out[kind, to] = (near[which] @ given[kind].T)[row, column]
    return near.sum(axis=1), near @ weights, each, out


def _received(window: int, blocks: int, names: list[str]):
    """Over rows sorted by group, a block's entries before its pieces: the pieces' ``names`` and what their mentions receive."""
    def numbers(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
        column = batch.column(name)
        return column.flatten().to_numpy(zero_copy_only=False), np.append(0, np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy()))

    def worked(batch: pa.RecordBatch, block: int, entries) -> pa.RecordBatch:
        (ids, stops), (certain, _), (sizes, _) = (numbers(batch, name) for name in ("ids", "certain", "sizes"))
        lead, own = (batch.column(name).to_numpy() for name in ("lead", "n_own"))
        done = []
        for i in range(len(batch)):
            piece = slice(stops[i], stops[i + 1])
            chosen = np.flatnonzero(ids[piece][lead[i]:lead[i] + own[i]] % blocks == block)
            done.append(_receive(ids[piece], certain[piece], sizes[piece], lead[i], own[i], chosen, entries, window))
        contexts, weights, each, out = (np.concatenate(x, axis=-1) for x in zip(*done, strict=True))
        ends = pa.array(np.append(0, np.cumsum([len(d[0]) for d in done])), pa.int32())
        inner = pa.array(np.append(0, np.cumsum(each)), pa.int32())
        return pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *(pa.ListArray.from_arrays(ends, x) for x in (
            pa.array(contexts, pa.int32(), safe=False), pa.array(weights), *(pa.ListArray.from_arrays(inner, pa.array(o)) for o in out)))],
            [*names, "n_context", "weight", "votes", "related"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, entries = -1, [], _NO_ENTRIES
        for batch in batches:
            group = batch.column("group").to_numpy() * 2 + batch.column("kind").to_numpy()
            cuts = np.append(np.flatnonzero(np.diff(group, prepend=-1)), len(group)) if len(group) else np.zeros(1, np.int64)
            for start, stop in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                part = batch.slice(start, stop - start)
                if group[start] // 2 != held:
                    held, rows, entries = group[start] // 2, [], _NO_ENTRIES
                if group[start] % 2 == 0:
                    others, stops = numbers(part, "ids")
                    spot = np.repeat(part.column("spot_id").to_numpy(), np.diff(stops))
                    rows.append((spot, others, *(numbers(part, n)[0] for n in ("sizes", "certain", "related"))))
                else:
                    if rows:
                        entries, rows = _entries(rows), []
                    yield worked(part, held % blocks, entries)

    return run


def _with_received(docs: DataFrame, matrix: DataFrame, spots: DataFrame, keys: list[str], window: int) -> DataFrame:
    """One row per mention, with the size and weight of its context and what its candidates receive.

    ``received`` is ``array<struct<entity, commonness, votes, related>>``, best prior first. The matrix is cut to blocks of
    its spots and a piece is sent to the blocks of its mentions, as the numbers of its spots: neither a neighbour nor an
    entry is ever a row. A block is copied for each :data:`BLOCK_PIECES` pieces, but the copies have no more entries than
    there are mentions. A piece has at most :data:`PIECE` mentions and their windows, however long its text.
    """
    spark = docs.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_PIECES))
    entries = matrix.agg(F.coalesce(F.sum(F.size("entries")), F.lit(0))).first()[0]
    size = F.size("mentions")
    n_pieces, n_mentions = docs.agg(F.coalesce(F.sum(F.ceil(size / PIECE)), F.lit(0)), F.coalesce(F.sum(size), F.lit(0))).first()
    blocks = max(1, -(-entries // BLOCK_ENTRIES))
    copies = max(1, min(-(-n_pieces // BLOCK_PIECES), n_mentions // max(entries, 1)))
    pieces = _pieces(docs, keys, window)
    block = lambda spot: F.pmod(spot, F.lit(blocks)).cast("long")
    own = F.col("own") if blocks == 1 else F.filter("own", lambda m: block(m["spot_id"]) == F.col("_block"))
    sent = pieces.withColumn("_block", F.explode(F.array_distinct(F.transform("own", lambda m: block(m["spot_id"]))))).select(
        (F.pmod(F.xxhash64(*keys, "first"), F.lit(copies)) * blocks + F.col("_block")).alias("group"), F.lit(1).alias("kind"),
        F.lit(None).cast("int").alias("spot_id"), F.col("near")["spot_id"].alias("ids"), F.col("near")["n_candidates"].alias("sizes"),
        F.transform("near", lambda m: F.when(m["n_candidates"] == 1, m["link_probability"]).otherwise(0.0)).alias("certain"),
        F.lit(None).cast("array<double>").alias("related"), "lead", F.size("own").alias("n_own"),
        F.transform(own, lambda m: F.struct(*[m[f].alias(f) for f in ("start", "end", "spot", "link_probability", "spot_id")])).alias("own"), *keys)
    cut = F.explode(F.transform(
        F.sequence(F.lit(0), F.size("entries") - 1, F.lit(ROW_ENTRIES)), lambda i: F.slice("entries", i + 1, F.lit(ROW_ENTRIES))))
    rows = matrix.filter(F.size("entries") > 0).select("spot_id", cut.alias("e")).withColumn(
        "_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))).select(
        (F.col("_copy") * blocks + block(F.col("spot_id"))).alias("group"), F.lit(0).alias("kind"), "spot_id",
        F.col("e")["other"].alias("ids"), F.col("e")["place"].alias("sizes"), F.col("e")["vote"].alias("certain"), F.col("e")["related"].alias("related"))
    names = [*keys, "own"]
    schema = ", ".join([*(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keys), f"own {_OWN}", _RECEIVED])
    dealt = sent.unionByName(rows, allowMissingColumns=True).repartition("group").sortWithinPartitions("group", "kind")
    got = dealt.mapInArrow(_received(window, blocks, names), schema)
    mentions = unnest(
        got.select(*keys, F.arrays_zip("own", "n_context", "weight", "votes", "related").alias("_all")),
        keys, "_all", "own", "n_context", "weight", "votes", "related")
    named = lookup_join(mentions.withColumn("spot_id", F.col("own.spot_id")), spots.select("spot_id", "candidates"), "spot_id")
    return named.select(
        *keys, *[F.col(f"own.{f}").alias(f) for f in ("start", "end", "spot", "link_probability")], "n_context",
        F.col("weight").alias("context_weight"), F.transform("candidates", lambda c, i: F.struct(
            c["entity"].alias("entity"), c["commonness"].alias("commonness"),
            F.get("votes", i).alias("votes"), F.get("related", i).alias("related"))).alias("received"))


def context_pairs(docs: DataFrame, keys: list[str], window: int = VOTE_WINDOW) -> DataFrame:
    """Distinct ``(spot_id, other_id)`` of spots at most ``window`` mentions from each other, in both orders."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for ids, lead, own in zip(frame["ids"], frame["lead"], frame["own"], strict=True):
                distinct, at, near = _counts(ids, lead, own, window)
                met = np.zeros((len(distinct), len(distinct)), bool)
                np.logical_or.at(met, at[lead:lead + own], near > 0)
                a, b = np.nonzero(met)
                yield pd.DataFrame({"spot_id": distinct[a], "other_id": distinct[b]})

    pieces = _pieces(docs, keys, window).select(F.col("near")["spot_id"].alias("ids"), "lead", F.size("own").alias("own"))
    return pieces.mapInPandas(run, "spot_id int, other_id int").distinct()


def related_in_context(docs: DataFrame, spots: DataFrame, graph: DataFrame, pages: DataFrame, keys: list[str], window: int = VOTE_WINDOW) -> DataFrame:
    """:func:`relatedness` of the entities that are candidates in each other's context, zeros where no page links to both.

    The spots that meet are made distinct before their candidates are paired, so pairs are by dictionary, not by text.
    """
    rows = materialize(_candidate_rows(spots).select("spot_id", "entity"), "candidates")
    met = materialize(context_pairs(docs, keys, window), "met")
    near = met.join(rows.withColumnRenamed("entity", "a"), "spot_id").join(
        rows.select(F.col("spot_id").alias("other_id"), F.col("entity").alias("b")), "other_id")
    pairs = materialize(near.filter("a < b").select("a", "b").distinct(), "pairs")
    return relatedness(pairs, graph, pages)


def _collected(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys and ``annotations`` from one row ``(spot, start, end, entity, score)`` per mention."""
    return rows.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(
        "start", "end", "spot", "entity", "score"))).alias("annotations"))


def by_prior(docs: DataFrame, keys: list[str]) -> DataFrame:
    """Best candidate by commonness; its score is the chance that the spot is a link to it."""
    return docs.select(*keys, F.transform("mentions", lambda m: F.struct(
        m["start"].alias("start"), m["end"].alias("end"), m["spot"].alias("spot"),
        m["entity"].alias("entity"), F.round(m["link_probability"] * m["commonness"], 6).alias("score"),
    )).alias("annotations"))


def by_votes(
    docs: DataFrame, spots: DataFrame, matrix: DataFrame, keys: list[str], window: int = VOTE_WINDOW, epsilon: float = VOTE_EPSILON,
    stored: bool = False,
) -> DataFrame:
    """Collective choice: among the candidates near the most voted one, the most common.

    A neighbour's vote is the mean over its candidates of relatedness times commonness. The score is
    the mean of the link probability and of the chosen candidate's average vote. ``docs`` that are not ``stored`` are first.
    """
    received = _with_received(docs if stored else materialize(docs, "mentions"), matrix, spots, keys, window)
    floor = F.array_max(F.transform("received", lambda c: c["votes"])) * F.lit(1 - epsilon)
    # Compared with six digits, so that equal sums in another order stay equal.
    chosen = received.withColumn("_floor", F.round(floor, 6)).withColumn(
        "_chosen", F.get(F.filter("received", lambda c: F.round(c["votes"], 6) >= F.col("_floor")), 0))
    coherence = F.when(F.col("n_context") > 0, F.col("_chosen.votes") / F.col("n_context")).otherwise(0.0)
    rows = chosen.select(*keys, "start", "end", "spot", F.col("_chosen.entity").alias("entity"),
                         F.round((F.col("link_probability") + coherence) / 2, 6).alias("score"))
    return _collected(rows, keys)


def link_features(docs: DataFrame, spots: DataFrame, matrix: DataFrame, keys: list[str], window: int = VOTE_WINDOW, stored: bool = False) -> DataFrame:
    """Per mention and candidate: commonness, relatedness to the certain neighbours, and their weight."""
    received = _with_received(docs if stored else materialize(docs, "mentions"), matrix, spots, keys, window)
    rows = unnest(received, [*keys, "start", "end", "spot", "link_probability", "context_weight"], "received",
                  "entity", "commonness", "related")
    return rows.select(
        *keys, "start", "end", "spot", "entity", "link_probability", "commonness",
        F.when(F.col("context_weight") > 0, F.col("related") / F.col("context_weight")).otherwise(0.0)
        .alias("context_relatedness"), "context_weight")


#: Parts that the pages are dealt to for training and testing.
FOLDS = 5


def training_rows(features: DataFrame, anchors: DataFrame, page: str, folds: int = FOLDS) -> DataFrame:
    """``features`` of the mentions whose spot is a link on their own page, with ``label`` and ``fold``.

    A candidate that the page links the spot to is an example for (1), the spot's other candidates are examples against
    (0). ``fold`` is the same for all rows of a page, so what is learned on some pages can be tested on others.
    """
    linked = anchors.groupBy(F.col("page").alias(page), "spot").agg(F.collect_set("target").alias("_targets"))
    known = features.join(linked, [page, "spot"])
    return known.withColumn("label", F.array_contains("_targets", F.col("entity")).cast("int")).withColumn(
        "fold", shard_of(F.col(page), folds)).drop("_targets")


def fit_scorer(features: DataFrame, label: str = "label"):
    """Logistic regression over the features."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    vector = VectorAssembler(inputCols=list(FEATURES), outputCol="_vector")
    return Pipeline(stages=[vector, LogisticRegression(
        featuresCol="_vector", labelCol=label, probabilityCol="_probability", maxIter=20)]).fit(features)


def scored_by(model, features: DataFrame) -> DataFrame:
    """Add the model's probability as ``score``."""
    from pyspark.ml.functions import vector_to_array

    return model.transform(features).withColumn("score", F.round(F.get(vector_to_array("_probability"), 1), 6)).drop(
        "_vector", "_probability", "rawPrediction", "prediction")


def scored_with(weights: Mapping[str, float], offset: float, features: DataFrame) -> DataFrame:
    """Add ``score``, the logistic function of given weights of the features (rounded to six digits) and an offset."""
    total = sum((F.lit(weight) * F.round(name, 6) for name, weight in weights.items()), F.lit(offset))
    return features.withColumn("score", F.round(1 / (1 + F.exp(-total)), 6))


#: Rows that are looked through together for the best candidate of a mention.
RUN_ROWS = 1 << 14


def _best_in_runs(mention: list[str], order: list[str]):
    """Of rows next to each other with the same ``mention`` columns, the one with the greatest ``order`` columns."""
    def codes(column: pa.Array) -> np.ndarray:
        return ranks(column)[0]

    def best(table: pa.Table) -> Iterator[pa.RecordBatch]:
        rows = table.combine_chunks().to_batches()[0]
        run = np.zeros(len(rows), np.int64)
        run[starts_of(*(codes(rows.column(c)) for c in mention))[1:]] = 1
        run = run.cumsum()
        at = np.lexsort((*(codes(rows.column(c)) for c in reversed(order)), run))
        yield rows.take(pa.array(at[np.append(run[at][1:] != run[at][:-1], True)]))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            if len(batch):
                held.append(batch)
            if sum(map(len, held)) >= RUN_ROWS:
                yield from best(pa.Table.from_batches(held))
                held = []
        if held:
            yield from best(pa.Table.from_batches(held))

    return found


def by_score(features: DataFrame, score: Callable[[DataFrame], DataFrame], keys: list[str]) -> DataFrame:
    """Best candidate of each mention by a learned score; ties by commonness, then entity.

    The candidates of a mention leave their task as its best one there, and what is shuffled is a text's list of mentions.
    """
    mention, order = ["start", "end", "spot"], ["score", "commonness", "entity"]
    rows = score(features).select(*keys, *mention, *order)
    listed = rows.mapInArrow(_best_in_runs([*keys, *mention], order), rows.schema).groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct(*mention, *order)), asc=False).alias("_all"))
    # The greatest of a mention comes first.
    same = lambda m, other: functools.reduce(lambda x, y: x & y, (m[c].eqNullSafe(other[c]) for c in mention))
    first = F.filter("_all", lambda m, i: (i == 0) | ~same(m, F.get(F.col("_all"), i - 1)))
    return listed.select(*keys, F.sort_array(F.transform(first, lambda m: F.struct(
        *[m[c].alias(c) for c in (*mention, "entity", "score")]))).alias("annotations"))


def disambiguate(
    docs: DataFrame, keys: list[str], method: str = "tagme", *, spots: DataFrame | None = None,
    graph: DataFrame | None = None, pages: DataFrame | None = None, matrix: DataFrame | None = None, model=None,
    stored: bool = False,
) -> DataFrame:
    """Annotate with the method asked for: ``prior``, ``tagme`` (votes) or ``wikiminer`` (learned score).

    ``matrix`` is the stored :func:`vote_matrix`, made from ``graph`` and ``pages`` where it is not given. ``model`` is a
    fitted pipeline or a function that adds ``score`` to the features. ``docs`` may be a ``stored`` table.
    """
    if method == "prior":
        return by_prior(docs, keys)
    if method not in ("tagme", "wikiminer"):
        raise ValueError(f"unknown disambiguation method {method!r}")
    if matrix is None:
        matrix = vote_matrix(spots, graph, pages)
    if method == "tagme":
        return by_votes(docs, spots, matrix, keys, stored=stored)
    score = model if callable(model) else lambda f: scored_by(model, f)
    return by_score(link_features(docs, spots, matrix, keys, stored=stored), score, keys)
