"""Inverted index as tables.

A document's terms are sorted and grouped in its own row, so postings leave the document complete;
the only shuffles are those by term, of one row per document and term.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewell.functions.arrays import unnest
from tidewell.functions.flat import field, group_sums, in_parts, laid, laid_entries, offsets, places, ranks, record_batches, starts_of
from tidewell.functions.stems import porter, stem as porter_stem
from tidewell.functions.text import shard_of
from tidewell.model import FIELDS, META_LENGTHS, TAGGERS
from tidewell.operators.corpus import doc_props, with_text
from tidewell.operators.joins import lookup_join
from tidewell.session import materialize
from tidewell.sources.sinks import sink

BIT = {name: 1 << place for place, name in enumerate(FIELDS)}


def _sections(items: DataFrame) -> DataFrame:
    """Keys and the sentences of title and body, columns of their own so that they are worked out once."""
    title = F.element_at("other_content", "title")
    read = with_text(items).select(
        "stream_id", "doc_id", title.alias("_title"), F.col("body.sentences").alias("_body"))
    return read.select(
        "stream_id", "doc_id",
        F.when(F.length(F.col("_title.clean_visible")) > 0, F.col("_title.sentences")).alias("_head"), "_body")


def _passes(sentences: pa.Array, part: str) -> list[tuple[np.ndarray, pa.Array, str, np.ndarray]]:
    """``(tokens of each record, the tokens, tagger, section bit of each record)`` of the passes over title or body.

    A record has no tokens in a pass when its tagger, or the section, is missing. The section's own field
    goes to the first tagger that is there.
    """
    n, out = len(sentences), []
    entries, keys, values = laid_entries(sentences)
    owner = np.repeat(np.arange(n), entries)
    bit = np.full(n, BIT[part], np.int32)
    for tagger in TAGGERS:
        mine = pc.and_(pc.fill_null(pc.equal(keys, tagger), False), pc.is_valid(values))
        records = owner[mine.to_numpy(zero_copy_only=False)]
        in_record, each_sentence = laid(values.filter(mine))
        in_sentence, tokens = laid(field(each_sentence, "tokens"))
        sizes = np.bincount(np.repeat(np.repeat(records, in_record), in_sentence), minlength=n)
        out.append((sizes, tokens, tagger, bit.copy()))
        bit[records] = 0
    return out


def _bits_of(kinds: pa.Array, tagger: str) -> np.ndarray:
    """The entity fields' bits of the tokens' types."""
    prefix = {TAGGERS[0]: "Serif_", TAGGERS[1]: "Lingpipe_"}[tagger]
    names = ("PER", "ORG", "LOC", "MISC")
    at = pc.fill_null(pc.index_in(kinds, pa.array(names)), len(names)).to_numpy(zero_copy_only=False)
    return np.array([*(BIT[prefix + name] for name in names), 0], np.int32)[at]


def _lemma_mask(lemma: pa.Array) -> np.ndarray:
    """A lemma is indexed when it has more than one letter, or is ``i``."""
    return pc.fill_null(pc.or_(pc.greater(pc.utf8_length(lemma), 1), pc.equal(lemma, "i")), False).to_numpy(zero_copy_only=False)


def _placed(head: pa.Array, body: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``term, record, pos, surface, bits`` of the terms of all passes; a lemma comes with its token, see :func:`term_stream`."""
    n, out = len(head), []
    before = np.zeros(n, np.int64)
    for sizes, flat, tagger, section in _passes(head, "title") + _passes(body, "body"):
        record = np.repeat(np.arange(n), sizes)
        pos = places(sizes) + before[record]
        before = before + sizes
        lemma = field(flat, "lemma")
        good = _lemma_mask(lemma)
        bits = section[record] | _bits_of(field(flat, "entity_type"), tagger)
        out.append((lemma.filter(pa.array(good)), record[good], pos[good], np.zeros(good.sum(), np.int32),
                    np.full(good.sum(), BIT["Lemma"], np.int32)))
        out.append((field(flat, "token"), record, pos, np.ones(len(pos), np.int32), bits))
    return pa.concat_arrays([part[0] for part in out]), *(np.concatenate([part[i] for part in out]) for i in range(1, 5))


def _grouped(
    head: pa.Array, text: pa.Array, body: Callable[..., list[tuple[str, pa.Array]]],
    pipe: Callable[[pa.Array], pa.Array] | None = None,
) -> pa.Array:
    """Per record, ``struct<doc_len, groups>``: its distinct terms in order with what ``body`` makes of their occurrences.

    ``body`` gets the starts of the groups and the occurrences' terms, places, surfaces and bits in order. ``pipe`` turns
    the distinct terms of many records into those that are grouped; occurrences of a term that it makes null are left out.
    """
    n = len(head)
    terms, record, pos, surface, bits = _placed(head, text)
    rank, distinct = ranks(terms)
    if pipe is not None:
        place, distinct = ranks(pipe(distinct))
        rank = place[rank]
        left = rank >= distinct.null_count
        rank, record, pos, surface, bits = (x[left] for x in (rank, record, pos, surface, bits))
    order = np.lexsort((2 * pos + surface, record * len(distinct) + rank))
    record, rank = record[order], rank[order]
    starts = starts_of(record, rank)
    term = distinct.take(pa.array(rank[starts]))
    fields = [("term", term), *body(starts, lambda: distinct.take(pa.array(rank)), pos[order], surface[order], bits[order])]
    groups = pa.StructArray.from_arrays([v for _, v in fields], [k for k, _ in fields])
    lists = pa.ListArray.from_arrays(offsets(record[starts], n), groups)
    return pa.StructArray.from_arrays([pa.array(np.bincount(record, minlength=n), pa.int32()), lists], ["doc_len", "groups"])


def _n_terms(head: pa.Array, text: pa.Array) -> np.ndarray:
    """Terms of each record, lemmas and surface forms, at most."""
    return sum(2 * part[0] for part in _passes(head, "title") + _passes(text, "body"))


def _of_terms(items: DataFrame, schema: str, work: Callable[[pa.Array, pa.Array], pa.Array]) -> DataFrame:
    """Keys and ``_got``, what ``work`` makes of the sentences of title and body of many records."""
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for head, text in batches:
            yield in_parts((head, text), _n_terms(head, text), work)

    return record_batches(_sections(items)).select("stream_id", "doc_id", F.arrow_udf(run, schema)("_head", "_body").alias("_got"))


def _with_groups(
    items: DataFrame, of_term: str, body: Callable[..., list[tuple[str, pa.Array]]],
    pipe: Callable[[pa.Array], pa.Array] | None = None,
) -> DataFrame:
    """``(stream_id, doc_id, doc_len, groups)``, see :func:`_grouped`."""
    rows = _of_terms(items, f"struct<doc_len: int, groups: array<struct<term: string, {of_term}>>>", lambda head, text: _grouped(head, text, body, pipe))
    return rows.select("stream_id", "doc_id", "_got.doc_len", "_got.groups")


def _sizes(starts: np.ndarray, n: int) -> pa.Array:
    return pa.array(np.diff(np.append(starts, n)), pa.int32())


def term_stream(items: DataFrame) -> DataFrame:
    """The terms of each document in order: title, then body, in each one pass per tagger.

    Each token gives its lemma (see :func:`_lemma_mask`), with ``surface`` 0 and the field ``Lemma``,
    and then its surface form with ``surface`` 1 and its fields. ``pos`` is the token's number in the
    document; a lemma and its surface form share it.
    """
    def work(head: pa.Array, text: pa.Array) -> pa.Array:
        terms, record, pos, surface, bits = _placed(head, text)
        order = np.lexsort((2 * pos + surface, record))
        values = [terms.take(pa.array(order)), *(pa.array(x[order], pa.int32()) for x in (pos, surface, bits))]
        structs = pa.StructArray.from_arrays(values, ["term", "pos", "surface", "bits"])
        return pa.ListArray.from_arrays(offsets(record[order], len(head)), structs)

    found = _of_terms(items, "array<struct<term: string, pos: int, surface: int, bits: int>>", work)
    rows = unnest(found, ["stream_id", "doc_id"], "_got", "term", "pos", "surface", "bits")
    return rows.withColumn("fields", field_names(F.col("bits"))).drop("bits")


def field_names(bits: Column) -> Column:
    """Names of the fields in a bit set, joined with commas."""
    return F.concat_ws(",", *[F.when(bits.bitwiseAND(bit) != 0, name) for name, bit in BIT.items()])


def remove_stopwords(terms: DataFrame, stop: DataFrame) -> DataFrame:
    """Rows whose ``term`` is not in the one-column table ``stop``.

    Stop words are the most frequent terms, so their keys are hot.
    """
    return lookup_join(terms, stop.select("term").distinct(), "term", "left_anti")


def read_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """A stop-word file with one word a line."""
    return spark.read.text(path).select(F.trim("value").alias("term")).filter(F.col("term") != "").distinct()


def _number(starts, terms, pos, surface, bits) -> list[tuple[str, pa.Array]]:
    return [("n", _sizes(starts, len(pos)))]


def _counted(items: DataFrame) -> DataFrame:
    """Keys, ``doc_len`` and ``groups: array<struct<term, n>>``, the document's terms in order."""
    return _with_groups(items, "n: int", _number)


def _counts_of(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray, pa.Array, np.ndarray]:
    """``doc_len`` of a batch of :func:`_sections`, and the record, term and frequency of each posting."""
    columns = batch.column("_head"), batch.column("_body")
    got = in_parts(columns, _n_terms(*columns), lambda head, text: _grouped(head, text, _number))
    sizes, groups = laid(field(got, "groups"))
    return field(got, "doc_len"), np.repeat(np.arange(len(batch)), sizes), field(groups, "term"), field(groups, "n").to_numpy()


#: Rows of :func:`posting_blocks`, and the records of a block, about.
BLOCK = (
    "term string, block bigint, places array<int>, tf array<int>, "
    "records array<struct<stream_id: string, doc_id: string, doc_len: int>>")
BLOCK_RECORDS = 2048
_RECORD = pa.struct([("stream_id", pa.string()), ("doc_id", pa.string()), ("doc_len", pa.int32())])


def posting_blocks(items: DataFrame) -> DataFrame:
    """Postings without positions, those of many records together, as rows of :data:`BLOCK`.

    A row has the ``places`` of a term's records in their block, and the term's frequency in each. The ids and lengths of
    the block's ``records`` are in one row more, without lists, and not in every posting. A block's number is the same for all
    its rows, as one task makes them.
    """
    names = ["term", "block", "places", "tf", "records"]

    def block(number: int, held: list[tuple]) -> Iterator[pa.RecordBatch]:
        before = np.cumsum([0, *(len(h[0]) for h in held)])
        ids = pa.StructArray.from_arrays(
            [pa.concat_arrays([h[i] for h in held]) for i in range(3)], fields=list(_RECORD))
        record = np.concatenate([h[3] + n for h, n in zip(held, before)])
        rank, distinct = ranks(pa.concat_arrays([h[4] for h in held]))
        order = np.argsort(rank, kind="stable")
        starts = starts_of(rank[order])
        bounds = pa.array(np.append(starts, len(order)), pa.int32())
        lists = (pa.ListArray.from_arrays(bounds, pa.array(x[order], pa.int32())) for x in (record, np.concatenate([h[5] for h in held])))
        n = len(starts)
        yield pa.RecordBatch.from_arrays(
            [distinct.take(pa.array(rank[order][starts])), pa.array(np.full(n, number), pa.int64()), *lists, pa.nulls(n, pa.list_(_RECORD))], names)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, pa.string()), pa.array([number], pa.int64()), *(pa.nulls(1, pa.list_(pa.int32())) for _ in range(2)),
             pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 32, []
        for batch in batches:
            length, record, term, n = _counts_of(batch)
            held.append((batch.column("stream_id"), batch.column("doc_id"), length, record, term, n))
            if sum(len(h[0]) for h in held) >= BLOCK_RECORDS:
                yield from block(number, held)
                number, held = number + 1, []
        if held:
            yield from block(number, held)

    return record_batches(_sections(items)).mapInArrow(run, BLOCK)


def block_frequencies(blocks: DataFrame, *keep: str) -> DataFrame:
    """``(keep, term, tf)`` of each posting of :func:`posting_blocks`."""
    return unnest(blocks.filter(F.col("records").isNull()), [*keep, "term"], "tf").withColumnRenamed("item", "tf")


def occurrences(items: DataFrame) -> DataFrame:
    """One row per document and term with the term's ``occurrences`` in order."""
    def body(starts, terms, pos, surface, bits):
        each_one = pa.StructArray.from_arrays(
            [terms(), *(pa.array(x, pa.int32()) for x in (pos, surface, bits))], ["term", "pos", "surface", "bits"])
        return [("occurrences", pa.ListArray.from_arrays(pa.array(np.append(starts, len(pos)), pa.int32()), each_one))]

    found = _with_groups(items, "occurrences: array<struct<term: string, pos: int, surface: int, bits: int>>", body)
    return unnest(found, ["stream_id", "doc_id", "doc_len"], "groups", "term", "occurrences")


def inverted_groups(items: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """A document's postings in its row: ``(stream_id, doc_id, doc_len, groups)``, see :func:`inverted_index`."""
    names = ["tf_" + f.lower() for f in fields]

    def body(starts, terms, pos, surface, bits):
        counts = [pa.array(group_sums((bits & BIT[f] != 0).astype(np.int32), starts), pa.int32()) for f in fields]
        positions = pa.ListArray.from_arrays(pa.array(np.append(starts, len(pos)), pa.int32()), pa.array(pos, pa.int32()))
        return [("tf", _sizes(starts, len(pos))), *zip(names, counts, strict=True), ("positions", positions)]

    return _with_groups(items, ", ".join(["tf: int", *(f"{name}: int" for name in names), "positions: array<int>"]), body)


def inverted_index(items: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """Postings with frequency, frequency per field, and token positions."""
    names = ["tf_" + f.lower() for f in fields]
    rows = unnest(inverted_groups(items, fields), ["stream_id", "doc_id", "doc_len"], "groups", "term", "tf", *names, "positions")
    return rows.select("term", "stream_id", "doc_id", "doc_len", "tf", *names, "positions")


def term_frequencies(items: DataFrame) -> DataFrame:
    """Postings without positions: ``(term, stream_id, doc_id, doc_len, tf)``."""
    rows = unnest(_counted(items), ["stream_id", "doc_id", "doc_len"], "groups", "term", "n")
    return rows.withColumnRenamed("n", "tf")


def direct_index(items: DataFrame) -> DataFrame:
    """Terms per document, in term order, with their frequencies."""
    return _counted(items).select("stream_id", "doc_id", F.col("groups").alias("terms"))


def doc_lengths(items: DataFrame) -> DataFrame:
    """Number of terms of each document with text."""
    def work(head: pa.Array, text: pa.Array) -> pa.Array:
        total = np.zeros(len(head), np.int64)
        for sizes, tokens, _, _ in _passes(head, "title") + _passes(text, "body"):
            total += sizes + np.bincount(np.repeat(np.arange(len(head)), sizes)[_lemma_mask(field(tokens, "lemma"))], minlength=len(head))
        return pa.array(total, pa.int32())

    return _of_terms(items, "int", work).withColumnRenamed("_got", "doc_len")


def vocabulary(postings: DataFrame, *by: str) -> DataFrame:
    """Documents and occurrences of each term."""
    return postings.groupBy(*by, "term").agg(
        F.count(F.lit(1)).alias("df"), F.sum("tf").cast("long").alias("cf"))


def number_in_order(rows: DataFrame, key: str, out: str) -> DataFrame:
    """Dense numbers from 0 in the order of a unique ``key``.

    The rows are put in ranges of the key and written to the shared folder, so that every later step
    sees the same ranges; a row's number is its place in the range plus the sizes of the ranges
    before. Only one row per range, not per key, goes through a single window.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = materialize(rows.repartitionByRange(parts, key).sortWithinPartitions(key).select(
        "*", F.spark_partition_id().alias("_range"),
        F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("_place")))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("n"))
    starts = sizes.select("_range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
    # At most ``parts`` rows.
    return placed.join(F.broadcast(starts), "_range").withColumn(
        out, F.col("_start") + F.col("_place")).drop("_range", "_place", "_start")


def lexicon(postings: DataFrame) -> DataFrame:
    """Terms with document frequency, collection frequency and dense ids in term order."""
    return number_in_order(vocabulary(postings), "term", "term_id")


def letter_of(term: Column) -> Column:
    """Partition of a term: its first letter, ``_`` when that is not a lower-case letter."""
    first = F.substring(term, 1, 1)
    return F.when(first.between("a", "z"), first).otherwise("_")


def by_letter(postings: DataFrame) -> DataFrame:
    """Postings with the ``letter`` they are laid out by."""
    return postings.withColumn("letter", letter_of(F.col("term")))


def by_shard(postings: DataFrame, shards: int) -> DataFrame:
    """Postings with the number of the independent index their document belongs to."""
    return postings.withColumn("shard", shard_of(F.col("stream_id"), shards))


def merge_vocabularies(*parts: DataFrame) -> DataFrame:
    """One lexicon from those of partial indices; any of them may be empty."""
    union = parts[0].select("term", "df", "cf")
    for part in parts[1:]:
        union = union.unionByName(part.select("term", "df", "cf"))
    merged = union.groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))
    return number_in_order(merged, "term", "term_id")


def meta_index(items: DataFrame) -> DataFrame:
    """Document properties cut to their lengths in the index."""
    return doc_props(items).select(*[F.substring(c, 1, n).alias(c) for c, n in META_LENGTHS.items()])


def collection_stats(postings: DataFrame, lengths: DataFrame) -> DataFrame:
    """One row: documents, tokens, unique terms, average length."""
    docs = lengths.agg(
        F.count(F.lit(1)).alias("docs"), F.sum("doc_len").cast("long").alias("tokens"), F.avg("doc_len").alias("avg_len"))
    terms = postings.select("term").distinct().agg(F.count(F.lit(1)).alias("unique_terms"))
    return docs.withColumn("unique_terms", terms.scalar())


# Suffix rules of the stemmer's first step, first match wins.
SUFFIXES = (
    ("sses$", "ss"), ("ies$", "i"), ("([^s])s$", "$1"),
)
ENDINGS = (
    ("([aeiouy].*)ing$", "$1"), ("([aeiouy].*)ed$", "$1"),
)


def stem(term: Column) -> Column:
    """Conflated form of a lower-cased term: plural, then ``-ing`` / ``-ed`` after a vowel, then ``y``."""
    word = F.lower(term)
    for rules in (SUFFIXES, ENDINGS):
        out = word
        for pattern, form in reversed(rules):
            out = F.when(word.rlike(pattern), F.regexp_replace(word, pattern, form)).otherwise(out)
        word = out
    return F.regexp_replace(word, "([aeiouy].*)y$", "$1i")


def term_pipeline(terms: DataFrame, stop: DataFrame | None = None) -> DataFrame:
    """``(term, stem)`` of the distinct ``terms``: those whose lower case is no stop word, conflated by suffix.

    The work is done once per different word of the vocabulary, never per posting.
    """
    words = terms.select("term", F.lower("term").alias("_word")).distinct()
    known = words.select(F.col("_word").alias("term")).distinct()
    if stop is not None:
        known = remove_stopwords(known, stop)
    stems = known.select(F.col("term").alias("_word"), porter(F.col("term")).alias("stem"))
    return words.join(stems, "_word").select("term", "stem")


def conflated(postings: DataFrame, stems: DataFrame) -> DataFrame:
    """Posting lists ``(term, stream_id, doc_id, tf, positions)`` of stems, merged from those of their forms.

    ``stems`` is a :func:`term_pipeline`; terms that it lacks are gone. A document is in a merged list once, with the
    positions of all forms in order. Only forms of one stem in one document are grouped.
    """
    rows = lookup_join(postings.select("term", "stream_id", "doc_id", "tf", "positions"), stems, "term")
    return rows.groupBy(F.col("stem").alias("term"), "stream_id", "doc_id").agg(
        F.sum("tf").cast("int").alias("tf"), F.sort_array(F.flatten(F.collect_list("positions"))).alias("positions"))


def conflated_groups(items: DataFrame, stop: DataFrame | None = None) -> DataFrame:
    """``(stream_id, doc_id, doc_len, groups)`` with the posting lists of stems in their record's row; ``doc_len`` is their sum.

    What :func:`term_pipeline` does to a term is done where the text is read, once per different word of many records, so
    no posting is shuffled to find its stem or to meet the other forms. ``stop`` is the one-column table of stop words, a
    list that every task holds.
    """
    words = frozenset(() if stop is None else (row.term for row in stop.select("term").distinct().collect()))

    def pipe(terms: pa.Array) -> pa.Array:
        lower = [None if term is None else term.lower() for term in terms.to_pylist()]
        return pa.array([None if w is None or w in words else porter_stem(w) for w in lower], pa.string())

    def body(starts, terms, pos, surface, bits):
        positions = pa.ListArray.from_arrays(pa.array(np.append(starts, len(pos)), pa.int32()), pa.array(pos, pa.int32()))
        return [("tf", _sizes(starts, len(pos))), ("positions", positions)]

    return _with_groups(items, "tf: int, positions: array<int>", body, pipe)


def conflated_postings(records: DataFrame) -> DataFrame:
    """The posting lists ``(term, stream_id, doc_id, tf, positions)`` of :func:`conflated_groups`, as :func:`conflated` has them.

    A document is in a list once: the lists of rows with the same ids are merged, all others leave their row as they are.
    """
    keys = ["stream_id", "doc_id"]
    repeated = materialize(records.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(
        F.col("stream_id").alias("_stream"), F.col("doc_id").alias("_doc")), "repeated")
    same = F.col("stream_id").eqNullSafe(F.col("_stream")) & F.col("doc_id").eqNullSafe(F.col("_doc"))

    def lists(rows: DataFrame) -> DataFrame:
        return unnest(rows, keys, "groups", "term", "tf", "positions").select("term", *keys, "tf", "positions")

    merged = lists(records.join(repeated, same, "left_semi")).groupBy("term", *keys).agg(
        F.sum("tf").cast("int").alias("tf"), F.sort_array(F.flatten(F.collect_list("positions"))).alias("positions"))
    return lists(records.join(repeated, same, "left_anti")).unionByName(merged)


def conflated_lengths(lengths: DataFrame, merged: DataFrame) -> DataFrame:
    """Lengths of the documents of ``lengths`` in terms that the pipeline let through, 0 where there are none."""
    left = merged.groupBy("stream_id").agg(F.sum("tf").cast("int").alias("_left"))
    return lengths.join(left, "stream_id", "left").select("stream_id", "doc_id", F.coalesce("_left", F.lit(0)).alias("doc_len"))


def form_counts(items: DataFrame) -> DataFrame:
    """``(stem, term, df, cf)`` of batches of records: a term's occurrences, and the documents with any form of its stem.

    The documents are counted at one of the stem's terms in the batch, so ``df`` adds up by stem. Terms find their stems
    where the text is read, so no posting is shuffled.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, record, term, n = _counts_of(batch)
            rank, distinct = ranks(term)
            stems = pa.array([None if t is None else porter_stem(t.lower()) for t in distinct.to_pylist()], pa.string())
            place, known = ranks(stems)
            docs = np.bincount(np.unique(place[rank] * len(batch) + record) // max(len(batch), 1), minlength=len(known))
            at, df = np.unique(place, return_index=True)[1], np.zeros(len(distinct), np.int64)
            df[at] = docs[place[at]]
            cf = np.bincount(rank, n, len(distinct)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([stems, distinct, pa.array(df), pa.array(cf)], ["stem", "term", "df", "cf"]).filter(stems.is_valid())

    return record_batches(_sections(items)).mapInArrow(run, "stem string, term string, df bigint, cf bigint")


def vocab_conflate(postings: DataFrame | None, counts: DataFrame | None = None) -> DataFrame:
    """Stem classes over the vocabulary of ``(term, stream_id, tf)``: forms, documents with any form, occurrences.

    ``counts`` are the :func:`form_counts` of records that are not in ``postings``, whose ids do not repeat.
    """
    rows = [] if counts is None else [counts]
    if postings is not None:
        stems = materialize(term_pipeline(postings.select("term")), "stems")
        rows.append(lookup_join(vocabulary(postings), stems, "term").select("stem", "term", F.lit(0).cast("long").alias("df"), "cf"))
        merged = lookup_join(postings.select("term", "stream_id"), stems, "term").select("stem", "stream_id").distinct()
        rows.append(merged.groupBy("stem").agg(F.count(F.lit(1)).alias("df")).select(
            "stem", F.lit(None).cast("string").alias("term"), "df", F.lit(0).cast("long").alias("cf")))
    of_forms = functools.reduce(DataFrame.unionByName, rows).groupBy("stem", "term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))
    return of_forms.groupBy("stem").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"), F.count("term").alias("forms"))


def conflated_vocabulary(items: DataFrame) -> DataFrame:
    """:func:`vocab_conflate` of all ``items``, where only rows that repeat a record's id are grouped by it."""
    again = materialize(with_text(items).groupBy("stream_id").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(
        F.col("stream_id").alias("_stream")), "repeated")
    if again.isEmpty():
        return vocab_conflate(None, form_counts(items))
    same = F.col("stream_id").eqNullSafe(F.col("_stream"))
    return vocab_conflate(term_frequencies(items.join(again, same, "left_semi")), form_counts(items.join(again, same, "left_anti")))


def write_index(items: DataFrame, path: str, partitions: int | None = None, overwrite: bool = False) -> None:
    """Write the index tables under ``path``; an existing index is an error unless ``overwrite``.

    The text is read twice, for postings and for the direct index; lexicon and document table come from these. Without
    ``partitions`` no posting is shuffled: a letter has a file for each task, whose postings are a document's after another's.
    """
    read = items.sparkSession.read
    sink(by_letter(inverted_index(items)), f"{path}/inverted", by="letter", key="term",
         partitions=partitions, overwrite=overwrite, stay=True)
    sink(_counted(items).withColumnRenamed("groups", "terms"), f"{path}/direct", partitions=partitions, overwrite=overwrite)
    sink(by_letter(lexicon(read.parquet(f"{path}/inverted"))), f"{path}/lexicon", by="letter", key="term",
         partitions=partitions, overwrite=overwrite)
    sink(read.parquet(f"{path}/direct").drop("terms"), f"{path}/document", partitions=partitions, overwrite=overwrite)
    sink(meta_index(items), f"{path}/meta", partitions=partitions, overwrite=overwrite)


@dataclass(frozen=True)
class Index:
    """Tables of a stored index: postings by letter, lexicon by letter, terms and length per document, properties."""

    postings: DataFrame
    lexicon: DataFrame
    direct: DataFrame
    lengths: DataFrame
    meta: DataFrame

    def frequencies(self) -> DataFrame:
        """Postings without positions."""
        return self.postings.select("letter", "term", "stream_id", "doc_id", "doc_len", "tf")

    def terms_of(self, docs: DataFrame) -> DataFrame:
        """``(term, stream_id, doc_id, doc_len, tf)`` of the documents named in ``docs``."""
        chosen = self.direct.join(docs.select("stream_id").distinct(), "stream_id", "left_semi")
        return unnest(chosen, ["stream_id", "doc_id", "doc_len"], "terms", "term", "n").withColumnRenamed("n", "tf")


def read_index(spark: SparkSession, path: str) -> Index:
    """The tables that :func:`write_index` wrote."""
    return Index(*(spark.read.parquet(f"{path}/{name}") for name in ("inverted", "lexicon", "direct", "document", "meta")))
