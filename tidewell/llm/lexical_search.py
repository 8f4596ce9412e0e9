"""Ranked lexical search with posting lists in geometric blocks (after Bruch et al. 2024), exact.

Documents are dealt to shards of a bounded number of postings, each one row of the stored index, so that no task holds
the whole list of a frequent term. Within a shard the list of each term that is frequent there is clustered by the
similarity of the documents: each joins the nearest of a few of the list's documents, on random projections. A block
stores the coordinatewise maximum of its documents' vectors.

A search reads a shard's rare terms in full and scores their documents. A frequent term's block is then skipped if the
query's product with the block's maxima is below the score of the k-th best document so far; other blocks' documents
are scored. A document that has been scored needs no bound, so terms already read are left out of it.
"""

from __future__ import annotations

import functools
import heapq
import itertools
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm import common
from tidewell.session import materialize, scratch_path

#: Documents and postings of a shard.
SHARD_DOCS, SHARD_POSTINGS = 2048, 1 << 20
#: Documents of a block, about, and of a list that is worth blocks.
BLOCK, FREQUENT = 64, 128
#: Numbers a document is projected on for clustering.
PROJECTIONS = 32
#: Maxima are stored in one byte, rounded up to multiples of this; a posting's value is below a million.
LEVEL = 4000
TOP = 10
#: Different terms of the queries that are sent to the tasks at once.
BATCH_TERMS = 1 << 17
SHARD = "docs array<long>, known array<boolean>, sizes array<long>, starts array<int>, terms array<int>, tf array<long>, vocabulary array<string>, df array<int>"
_BLOCKS = "frequent array<int>, members array<int>, member_starts array<int>, block_starts array<int>, first_block array<int>, maxima binary"
INDEX = f"docs array<long>, known array<boolean>, starts array<int>, terms array<int>, value array<int>, vocabulary array<string>, {_BLOCKS}"
_FOUND = "query long, doc_id long, score long"
# ASCII letters (lower-cased) and digits and all bytes beyond ASCII stay, the rest parts terms.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_TABLE).split() if text else []


def _row(frame_columns: dict[str, object]) -> pd.DataFrame:
    return pd.DataFrame({name: [value] for name, value in frame_columns.items()})


def shards(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of :data:`SHARD`: documents with a term, their sizes, and their distinct terms with frequencies.

    A null id is a 0 that is not ``known``. Document ``i``'s postings are ``[starts[i], starts[i + 1])``; ``terms`` are places in the ``vocabulary``.
    """
    def pack(held: list[tuple[int, bool, Counter]]) -> pd.DataFrame:
        vocabulary = list(dict.fromkeys(itertools.chain.from_iterable(counts for *_, counts in held)))
        place = {term: i for i, term in enumerate(vocabulary)}
        lengths = [len(counts) for *_, counts in held]
        terms = np.fromiter((place[t] for *_, counts in held for t in counts), np.int32, sum(lengths))
        return _row({
            "docs": np.array([doc for doc, *_ in held], np.int64), "known": np.array([known for _, known, _ in held]),
            "sizes": np.array([sum(counts.values()) for *_, counts in held], np.int64),
            "starts": np.append(0, np.cumsum(lengths)).astype(np.int32), "terms": terms,
            "tf": np.fromiter((n for *_, counts in held for n in counts.values()), np.int64, len(terms)),
            "vocabulary": [t.decode() for t in vocabulary], "df": np.bincount(terms, minlength=len(vocabulary)).astype(np.int32)})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, postings = [], 0
        for frame in frames:
            for doc_id, known, body in zip(frame["doc"], frame["known"], frame["text"], strict=True):
                counts = Counter(terms_of(body))
                if not counts:
                    continue
                if held and (len(held) >= SHARD_DOCS or postings + len(counts) > SHARD_POSTINGS):
                    yield pack(held)
                    held, postings = [], 0
                held.append((doc_id, known, counts))
                postings += len(counts)
        if held:
            yield pack(held)

    common.text_batches(docs)
    return docs.select(
        F.coalesce(F.col(doc).cast("long"), F.lit(0)).alias("doc"), F.col(doc).isNotNull().alias("known"),
        F.col(text).alias("text")).mapInPandas(run, SHARD)


def _clustered(sketch: np.ndarray) -> np.ndarray:
    """Cluster of each row: the nearest of rows taken evenly, about one for :data:`BLOCK` rows."""
    leaders = sketch[:: BLOCK]
    return (sketch @ leaders.T).argmax(axis=1)


def blocked(docs: int, starts: np.ndarray, terms: np.ndarray, value: np.ndarray, df: np.ndarray) -> dict[str, object]:
    """Block columns of a shard.

    ``members`` are the documents of the ``frequent`` terms' lists, block by block; list ``i`` is
    ``[member_starts[i], member_starts[i + 1])`` and has the blocks from ``first_block[i]`` to ``first_block[i + 1]``;
    block ``b``'s documents start at ``block_starts[b]``. ``maxima`` has a byte for each block and frequent term.
    """
    frequent = np.flatnonzero(df >= FREQUENT)
    column = np.full(len(df), -1)
    column[frequent] = np.arange(len(frequent))
    owner = np.repeat(np.arange(docs), np.diff(starts))
    inside = column[terms] >= 0
    owner, at, levels = owner[inside], column[terms[inside]], -(-value[inside] // LEVEL)
    dense = np.zeros((docs, len(frequent)), np.uint8)
    dense[owner, at] = levels
    axes = np.random.default_rng(11).standard_normal((len(frequent), PROJECTIONS), np.float32)
    sketch = dense.astype(np.float32) @ axes
    sketch /= np.maximum(np.linalg.norm(sketch, axis=1, keepdims=True), 1e-9)
    order = np.argsort(at, kind="stable")
    lists = np.split(owner[order], np.cumsum(df[frequent])[:-1]) if len(frequent) else []
    members, block_starts, first_block, maxima, placed = [], [], [0], [], 0
    for held in lists:
        cluster = _clustered(sketch[held])
        by = np.argsort(cluster, kind="stable")
        held, cluster = held[by], cluster[by]
        cut = np.flatnonzero(np.append(True, cluster[1:] != cluster[:-1]))
        members.append(held)
        maxima.append(np.maximum.reduceat(dense[held], cut, axis=0))
        block_starts += (cut + placed).tolist()
        placed += len(held)
        first_block.append(len(block_starts))
    return {
        "frequent": frequent.astype(np.int32), "members": np.concatenate(members or [np.zeros(0)]).astype(np.int32),
        "member_starts": np.append(0, np.cumsum([len(m) for m in members])).astype(np.int32),
        "block_starts": np.array([*block_starts, placed], np.int32), "first_block": np.array(first_block, np.int32),
        "maxima": (np.concatenate(maxima) if maxima else np.zeros(0, np.uint8)).tobytes()}


def _values(sizes: np.ndarray, starts: np.ndarray, tf: np.ndarray, documents: int, total: int) -> np.ndarray:
    """A posting's share of a score: ``(10^9 tf) div (1000 tf + 8 m)`` with ``m = 25 + (75 n N) div L``."""
    m = np.array([25 + 75 * n * documents // total for n in sizes.tolist()], np.int64)
    return 1_000_000_000 * tf // (1000 * tf + 8 * np.repeat(m, np.diff(starts)))


@dataclass(frozen=True)
class Index:
    """Stored rows of :data:`INDEX`, the vocabulary's document counts, and the numbers of documents and of their terms."""

    shards: DataFrame
    frequencies: DataFrame
    documents: int
    total: int


def _written(df: DataFrame, name: str) -> DataFrame:
    """Stored with small row groups, as a shard is a row of some MB.

    A writer looks at the size of a row group only every so many rows, at first after 100, so it is told to look at each:
    else it holds up to 100 shards, and a reader gets them all at once.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.options(**{
        "parquet.block.size": 1 << 24, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 1}).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def build_index(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> Index:
    """Index of all ``docs``: one pass over the texts, then one over the shards, when all sizes are known.

    Nothing is shuffled but ``(term, documents)`` pairs of the shards. Null and empty texts, which have no term, are
    not in the index; repeated rows are as often as they come; null ids stay null.
    """
    stored = _written(shards(docs, doc, text), "shards")
    sizes = stored.agg(
        F.sum(F.size("docs")).alias("n"), F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)).alias("l")).first()
    documents, total = sizes["n"] or 0, sizes["l"] or 0

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r in frame.itertuples(index=False):
                value = _values(r.sizes, r.starts, r.tf, documents, total)
                blocks = blocked(len(r.docs), r.starts, r.terms, value, r.df)
                yield _row({"docs": r.docs, "known": r.known, "starts": r.starts, "terms": r.terms, "value": value.astype(np.int32), "vocabulary": r.vocabulary} | blocks)

    counts = stored.select(F.explode(F.arrays_zip("vocabulary", "df")).alias("e")).groupBy(F.col("e.vocabulary").alias("term")).agg(
        F.sum("e.df").alias("df"))
    with common.batches(docs.sparkSession, 1):
        index = _written(stored.mapInPandas(run, INDEX), "index")
    return Index(index, materialize(counts, "terms"), documents, total)


def _best(best: list[tuple[int, bool, int]], found: Iterator[tuple[int, bool, int]]) -> None:
    """Keep the :data:`TOP` highest of ``(score, known, -doc)`` in the heap ``best``: a null id comes after all others."""
    for entry in found:
        if len(best) < TOP:
            heapq.heappush(best, entry)
        elif entry > best[0]:
            heapq.heapreplace(best, entry)


class Shard:
    """One row of the index in a task, with the counts of blocks seen and skipped."""

    def __init__(self, row: object) -> None:
        self.docs, self.known, self.starts, self.terms = row.docs, row.known, row.starts.astype(np.int64), row.terms
        self.value, self.place = row.value.astype(np.int64), {t: i for i, t in enumerate(row.vocabulary)}
        self.members, self.member_starts, self.block_starts = row.members, row.member_starts, row.block_starts
        self.first_block = row.first_block
        self.column = {int(t): i for i, t in enumerate(row.frequent)}
        self.maxima = np.frombuffer(row.maxima, np.uint8).reshape(-1, max(len(row.frequent), 1))
        order = np.argsort(self.terms, kind="stable")
        self.by_term = np.repeat(np.arange(len(self.docs)), np.diff(self.starts))[order]
        self.term_starts = np.append(0, np.cumsum(np.bincount(self.terms, minlength=len(self.place))))
        self.weights = np.zeros(len(self.place), np.int64)
        self.seen = self.skipped = 0

    def scores(self, docs: np.ndarray) -> np.ndarray:
        """Products of the documents' vectors with :attr:`weights`; each has a posting at least."""
        lengths = self.starts[docs + 1] - self.starts[docs]
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1]) + np.repeat(self.starts[docs] - (ends - lengths), lengths)
        return np.add.reduceat(self.weights[self.terms[at]] * self.value[at], ends - lengths)

    def search(self, query: list[tuple[str, int]], best: list[tuple[int, bool, int]]) -> None:
        """Merge the shard's documents into ``best``; ``query`` has terms and weights."""
        here = [(self.place[t], w) for t, w in query if w > 0 and t in self.place]
        if not here:
            return
        places = np.array([p for p, _ in here])
        self.weights[places] = [w for _, w in here]
        rare = [p for p, _ in here if p not in self.column]
        blocked = sorted(((w * LEVEL, self.column[p]) for p, w in here if p in self.column), reverse=True)
        done = np.zeros(len(self.docs), bool)

        def score(docs: np.ndarray) -> None:
            docs = docs[~done[docs]]
            if not len(docs):
                return
            done[docs] = True
            found = self.scores(docs)
            floor = best[0][0] if len(best) == TOP else 1
            good = np.flatnonzero(found >= max(floor, 1))
            _best(best, zip(found[good].tolist(), self.known[docs[good]].tolist(), (-self.docs[docs[good]]).tolist(), strict=True))

        if rare:
            score(np.unique(np.concatenate([self.by_term[self.term_starts[p]:self.term_starts[p + 1]] for p in rare])))
        for i, (_, column) in enumerate(blocked):
            # Terms read so far are left out: their documents have been scored.
            left = np.array([c for _, c in blocked[i:]])
            weights = np.array([w for w, _ in blocked[i:]], np.int64)
            first, stop = self.first_block[column], self.first_block[column + 1]
            bounds = self.maxima[first:stop][:, left].astype(np.int64) @ weights
            floor = best[0][0] if len(best) == TOP else 1
            open_blocks = np.flatnonzero(bounds >= floor)
            self.seen += stop - first
            self.skipped += stop - first - len(open_blocks)
            if len(open_blocks):
                score(np.concatenate([self.members[self.block_starts[first + b]:self.block_starts[first + b + 1]] for b in open_blocks]))
        self.weights[places] = 0


def _queries(index: Index, items: DataFrame, item: str, text: str) -> DataFrame:
    """Stored rows ``(query, item_id, size, terms)``: a number for each row of ``items``, its terms and their weights.

    A term's weight is its occurrences times ``floor(1000 ln((2 N + 2) / (2 df + 1)))``; terms in no document are left out.
    """
    def split(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in series:
            yield pd.Series([[(t.decode(), n) for t, n in Counter(terms_of(x)).items()] for x in texts])

    counted = F.pandas_udf(split, "array<struct<term string, n long>>")
    rows = materialize(items.select(F.monotonically_increasing_id().alias("query"), F.col(item).alias("item_id"), counted(text).alias("t")), "items")
    idf = F.floor(1000 * F.log((2.0 * index.documents + 2) / (2.0 * F.col("df") + 1))).cast("long")
    weighted = rows.select("query", F.explode("t").alias("t")).select("query", "t.*").join(index.frequencies, "term").select(
        "query", "term", (idf * F.col("n")).alias("weight"))
    listed = weighted.groupBy("query").agg(F.collect_list(F.struct("term", "weight")).alias("terms"), F.count(F.lit(1)).alias("size"))
    return materialize(listed.join(rows.select("query", "item_id"), "query"), "queries")


def _batches(queries: DataFrame, most: int) -> Iterator[DataFrame]:
    """Parts of ``queries`` of at most ``most`` terms each, or of one query that has more."""
    total = queries.agg(F.sum("size")).first()[0] or 0
    if not total:
        return
    parts = 1
    while True:
        dealt = queries.withColumn("part", F.pmod(F.xxhash64("query"), F.lit(parts)))
        sizes = {r["part"]: (r["s"], r["n"]) for r in dealt.groupBy("part").agg(F.sum("size").alias("s"), F.count(F.lit(1)).alias("n")).collect()}
        if all(s <= most or n == 1 for s, n in sizes.values()):
            break
        parts *= 2
    for part in sorted(sizes):
        yield dealt.filter(F.col("part") == part).drop("part")


def _search(index: Index, queries: list[tuple[int, list[tuple[str, int]]]]) -> DataFrame:
    """Each task's best documents of each query (:data:`_FOUND`); a score found in a shard is a floor for the next."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: dict[int, list] = {number: [] for number, _ in queries}
        for frame in frames:
            for row in frame.itertuples(index=False):
                shard = Shard(row)
                for number, terms in queries:
                    shard.search(terms, best[number])
        rows = [(number, -doc if known else None, score) for number, heap in best.items() for score, known, doc in heap]
        yield pd.DataFrame({
            "query": np.array([r[0] for r in rows], np.int64), "doc_id": pd.array([r[1] for r in rows], "Int64"),
            "score": np.array([r[2] for r in rows], np.int64)})

    return index.shards.mapInPandas(run, _FOUND)


def search(
    index: Index, items: DataFrame, item: str = "item_id", text: str = "text", batch_terms: int = BATCH_TERMS,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the :data:`TOP` highest-scoring documents of each row of ``items``.

    Only scores above 0 are listed; equal ones by ascending ``doc_id``, null ids last, repeated ids one after the
    other. A row without a term that a document has is not listed; rows that repeat an item are searched one by one.
    Queries go to the tasks in batches of at most ``batch_terms`` terms (a query with more of them by itself); a
    task gives ten rows a query at most.
    """
    kind = dict(items.dtypes)[item]
    queries = _queries(index, items, item, text)
    out = []
    for part in _batches(queries, batch_terms):
        sent = [(r["query"], [(t["term"], t["weight"]) for t in r["terms"]]) for r in part.select("query", "terms").collect()]
        with common.batches(items.sparkSession, 1):
            out.append(materialize(_search(index, sent), "found"))
    if not out:
        return items.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    found = functools.reduce(DataFrame.unionByName, out)
    place = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= TOP)
    return ranked.join(queries.select("query", "item_id"), "query").select("item_id", "rank", "doc_id", "score")
