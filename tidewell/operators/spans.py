"""Entity mentions: runs of equally tagged tokens.

All of this works inside the record (see :mod:`tidewell.functions.arrays`): a record's mentions are
found, grouped and counted in its own row, and only mentions leave it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.arrays import drop_null, group_sizes, indexes, part_of, unnest
from tidewell.functions.flat import field, group_sums, in_parts, laid, offsets, places, ranks, record_batches, starts_of
from tidewell.model import MAX_MENTION, MENTION_TYPES, RETAGGED_CODES, RETAGGED_LENGTH, TAGGERS, TYPE_CODES


def _with_runs(rows: DataFrame, label: str, breaks: tuple[str, ...], emitted: Callable[[Column, Column], Column]) -> DataFrame:
    """Add ``_runs``, the runs ``struct(start, stop, is_end)`` of equal labels in the flat array ``label``.

    ``breaks`` are flat arrays at whose changes a sentence ends. ``emitted`` chooses the runs to keep
    from their label and whether their sentence ends with them; null labels make no run.
    """
    labels, marks = F.col(label), [F.col(b) for b in breaks]
    n = F.size(labels)

    def sentence_changes(i: Column, j: Column) -> Column:
        test = F.lit(False)
        for mark in marks:
            test = test | (F.get(mark, i) != F.get(mark, j))
        return test

    started = rows.withColumn("_starts", F.filter(indexes(n), lambda i: (
        (i == 0) | ~F.get(labels, i).eqNullSafe(F.get(labels, i - 1)) | sentence_changes(i, i - 1))))
    bounded = started.withColumn("_bounds", F.transform("_starts", lambda s, k: F.struct(
        s.alias("start"), F.coalesce(F.get(F.col("_starts"), k + 1), n).alias("stop"))))

    def is_end(run: Column) -> Column:
        return (run["stop"] == n) | sentence_changes(run["stop"], run["start"])

    runs = F.filter("_bounds", lambda r: emitted(F.get(labels, r["start"]), is_end(r)))
    return bounded.withColumn("_runs", F.transform(runs, lambda r: F.struct(
        r["start"].alias("start"), r["stop"].alias("stop"), is_end(r).alias("is_end")))).drop("_starts", "_bounds")


def _joined(tokens: Column, run: Column) -> Column:
    """The run's tokens, each followed by one space."""
    one = run["stop"] - run["start"] == 1
    text = F.when(one, F.get(tokens, run["start"])).otherwise(
        F.array_join(part_of(tokens, run["start"], run["stop"]), " "))
    return F.concat(text, F.lit(" "))


def tagger_order(tagger: Column) -> Column:
    """Known taggers in their fixed order, others after them."""
    rank = F.lit(len(TAGGERS) + 1)
    for place, name in reversed(list(enumerate(TAGGERS, start=1))):
        rank = F.when(tagger == name, place).otherwise(rank)
    return rank


def _taggers(items: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and ``_taggers``, the record's taggers in order with their sentences; null without a body or sentences."""
    by_tagger = F.array_sort(F.transform(
        F.map_entries("_sentences"),
        lambda e: F.struct(tagger_order(e["key"]), e["key"].alias("tagger"), e["value"].alias("sentences"))))
    read = items.select(*keep, F.col("body.sentences").alias("_sentences"))
    return record_batches(read).select(*keep, F.when(F.size("_sentences") > 0, by_tagger).alias("_taggers"))


@dataclass(frozen=True)
class _Runs:
    """Emitted runs of many records, a record's in reading order: an element per run."""

    record: np.ndarray
    tagger_rank: np.ndarray
    sent_no: np.ndarray
    place: np.ndarray
    stop: np.ndarray
    is_end: np.ndarray
    entity_type: pa.Array
    mention: pa.Array

    def take(self, chosen: np.ndarray) -> _Runs:
        at = pa.array(chosen)
        return _Runs(*(x[chosen] if isinstance(x, np.ndarray) else x.take(at) for x in (getattr(self, f.name) for f in fields(self))))


def _mention_texts(tokens: pa.Array, starts: np.ndarray) -> pa.Array:
    """The runs' tokens, each followed by one space; missing tokens are left out, of one token alone the text is missing."""
    spaced = pa.concat_arrays([pc.if_else(pc.is_valid(tokens), pc.binary_join_element_wise(tokens, " ", ""), "")])
    _, ends, data = spaced.buffers()
    at = np.frombuffer(ends, np.int32)[:len(spaced) + 1][np.append(starts, len(spaced))]
    texts = pa.StringArray.from_buffers(len(starts), pa.py_buffer(at.copy()), data)
    if tokens.null_count:
        known = group_sums(pc.is_valid(tokens).to_numpy(zero_copy_only=False).astype(np.int64), starts) > 0
        alone = np.diff(np.append(starts, len(tokens))) == 1
        texts = pc.if_else(pa.array(known), texts, pc.if_else(pa.array(alone), pa.scalar(None, pa.string()), " "))
    return texts


def _mention_runs(taggers: pa.Array) -> _Runs:
    """The runs of equal types in the sentences of ``_taggers``, see :func:`with_mentions`."""
    many, tagged = laid(taggers)
    sentences_of, sentences = laid(field(tagged, "sentences"))
    tokens_of, flat = laid(field(sentences, "tokens"))
    spread = lambda x: np.repeat(np.repeat(x, sentences_of), tokens_of)
    record, rank = spread(np.repeat(np.arange(len(taggers)), many)), spread(places(many) + 1)
    sentence = np.repeat(places(sentences_of), tokens_of)
    kinds = field(flat, "entity_type")
    starts = starts_of(record, rank, sentence, kinds.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False))
    following = np.append(starts[1:], 0)[:len(starts)]
    is_end = (record[following] != record[starts]) | (rank[following] != rank[starts]) | (sentence[following] != sentence[starts])
    is_end[-1:] = True
    first = np.searchsorted(record, record[starts])
    kind = kinds.take(pa.array(starts))
    emitted = pc.is_valid(kind).to_numpy(zero_copy_only=False) & (
        is_end | pc.is_in(kind, pa.array(MENTION_TYPES)).to_numpy(zero_copy_only=False))
    runs = _Runs(
        record[starts], rank[starts], sentence[starts], starts - first, np.append(starts, len(record))[1:] - first, is_end,
        kind, _mention_texts(field(flat, "token"), starts))
    return runs.take(np.flatnonzero(emitted))


def _of_runs(items: DataFrame, keep: list[str], schema: str, work: Callable[[_Runs], tuple[np.ndarray, pa.Array]]) -> DataFrame:
    """``keep`` and ``_got: array<schema>``: the elements, with their records, that ``work`` makes of the runs of many records.

    Null for records without a body or without sentences.
    """
    def part(taggers: pa.Array) -> pa.Array:
        owner, made = work(_mention_runs(taggers))
        return pa.ListArray.from_arrays(offsets(owner, len(taggers)), made, mask=taggers.is_null())

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for taggers in batches:
            many, tagged = laid(taggers)
            sentences_of, sentences = laid(field(tagged, "sentences"))
            tokens_of = np.repeat(np.arange(len(sentences_of)), sentences_of)
            of_tagger = np.bincount(tokens_of, laid(field(sentences, "tokens"))[0], minlength=len(sentences_of))
            sizes = np.bincount(np.repeat(np.arange(len(many)), many), of_tagger, minlength=len(many)).astype(np.int64)
            yield in_parts((taggers,), sizes, part)

    return _taggers(items, keep).select(*keep, F.arrow_udf(run, f"array<{schema}>")("_taggers").alias("_got"))


def with_mentions(items: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and ``mentions``, a record's emitted runs in the order tagger, sentence, token.

    A run ended by another type needs a mention type, one ended by the sentence any type. ``mentions``
    is null for records without a body or without sentences.
    """
    def work(runs: _Runs) -> tuple[np.ndarray, pa.Array]:
        ints = [pa.array(x, pa.int32()) for x in (runs.tagger_rank, runs.sent_no, runs.place, runs.stop)]
        return runs.record, pa.StructArray.from_arrays(
            [*ints, pa.array(runs.is_end), runs.entity_type, runs.mention],
            ["tagger_rank", "sent_no", "place", "stop", "is_end", "entity_type", "mention"])

    schema = "struct<tagger_rank: int, sent_no: int, place: int, stop: int, is_end: boolean, entity_type: string, mention: string>"
    return _of_runs(items, list(keep), schema, work).withColumnRenamed("_got", "mentions")


def ne_spans(items: DataFrame) -> DataFrame:
    """One row per mention with its tagger's rank, its sentence and its first token in the record's stream."""
    return unnest(with_mentions(items, "stream_id", "doc_id"), ["stream_id", "doc_id"], "mentions",
                  "tagger_rank", "sent_no", "place", "mention", "entity_type", "is_end")


def mention_list(items: DataFrame) -> DataFrame:
    """Text and type of every mention of all taggers, uncounted."""
    return unnest(with_mentions(items, "doc_id"), ["doc_id"], "mentions", "mention", "entity_type")


def _mention_groups(
    items: DataFrame, keep: list[str], body: Callable[[_Runs, np.ndarray], np.ndarray],
) -> DataFrame:
    """Per record, ``groups: array<struct<entity, value>>`` of its short mentions grouped by text.

    ``body`` gets the mentions, in order of record and text and each group in reading order, and the groups' starts, and
    gives each group's value; groups of value 0 are left out.
    """
    def work(runs: _Runs) -> tuple[np.ndarray, pa.Array]:
        short = pc.fill_null(pc.less(pc.utf8_length(runs.mention), MAX_MENTION), False)
        runs = runs.take(np.flatnonzero(short.to_numpy(zero_copy_only=False)))
        rank, distinct = ranks(runs.mention)
        key = runs.record * len(distinct) + rank
        order = np.argsort(key, kind="stable")
        runs, starts = runs.take(order), starts_of(key[order])
        values = body(runs, starts)
        starts, values = starts[values > 0], values[values > 0]
        return runs.record[starts], pa.StructArray.from_arrays(
            [runs.mention.take(pa.array(starts)), pa.array(values, pa.int32())], ["entity", "value"])

    return _of_runs(items, keep, "struct<entity: string, value: int>", work).withColumnRenamed("_got", "groups")


def _as_map(entries: Column) -> Column:
    return F.map_from_entries(entries)


def doc_entity_map(items: DataFrame, *keep: str) -> DataFrame:
    """``(stream_id, doc_id, *keep, entities)`` with the count of each mention text; the map may be empty.

    A text first seen with the record's first tagger, or first seen at the end of a sentence, counts each
    time. One first seen later and in mid-sentence counts once there, and after that only at
    sentence ends.
    """
    def count(runs: _Runs, starts: np.ndarray) -> np.ndarray:
        every_time = (runs.tagger_rank[starts] == 1) | runs.is_end[starts]
        return np.where(every_time, np.diff(np.append(starts, len(runs.record))), 1 + group_sums(runs.is_end.astype(np.int64), starts))

    groups = _mention_groups(items, ["stream_id", "doc_id", *keep], count)
    return drop_null(groups.select("stream_id", "doc_id", *keep, _as_map(F.col("groups")).alias("entities")), "entities")


def doc_type_map(items: DataFrame) -> DataFrame:
    """As :func:`doc_entity_map`, with the code of the first coded type instead of a count."""
    codes = np.array([*TYPE_CODES.values(), 0], np.int64)

    def code(runs: _Runs, starts: np.ndarray) -> np.ndarray:
        found = pc.fill_null(pc.index_in(runs.entity_type, pa.array(list(TYPE_CODES))), len(TYPE_CODES))
        of_mention, out = codes[found.to_numpy(zero_copy_only=False)], np.zeros(len(starts), np.int64)
        coded = np.flatnonzero(of_mention)
        group, first = np.unique(np.searchsorted(starts, coded, side="right") - 1, return_index=True)
        out[group] = of_mention[coded[first]]
        return out

    groups = _mention_groups(items, ["stream_id", "doc_id"], code)
    return drop_null(groups.select("stream_id", "doc_id", _as_map(F.col("groups")).alias("entities")), "entities")


def retagged_map(labelled: DataFrame) -> DataFrame:
    """Mention counts over ``sentences: array<array<struct<token, label>>>`` of a second tagger.

    Only runs of the three coded labels count; the text ends in the label's digit, and its length is
    checked with the digit.
    """
    def digit(label: Column) -> Column:
        out = F.lit(None).cast("string")
        for name, number in RETAGGED_CODES.items():
            out = F.when(label == name, str(number)).otherwise(out)
        return out

    low, high = RETAGGED_LENGTH
    flat = labelled.select(
        "stream_id", "doc_id",
        F.flatten(F.transform("sentences", lambda s: s["token"])).alias("_tokens"),
        F.flatten(F.transform("sentences", lambda s: s["label"])).alias("_labels"),
        F.flatten(F.transform("sentences", lambda s, no: F.array_repeat(no, F.size(s)))).alias("_sents"))
    runs = _with_runs(flat, "_labels", ("_sents",), lambda label, end: label.isin(*RETAGGED_CODES))
    found = F.transform("_runs", lambda r: F.concat(
        _joined(F.col("_tokens"), r), digit(F.get(F.col("_labels"), r["start"]))))
    kept = F.filter(found, lambda m: (F.length(m) > low) & (F.length(m) < high))
    rows = runs.select("stream_id", "doc_id", F.sort_array(
        F.transform(kept, lambda m: F.struct(m.alias("entity")))).alias("sorted"))
    return group_sizes(rows, "sorted", "entity", "groups").select(
        "stream_id", "doc_id", _as_map(F.col("groups")).alias("entities"))


def explode_map(maps: DataFrame, key: str = "entity", value: str = "cnt") -> DataFrame:
    """One row ``(key, value)`` per entry of the ``entities`` maps, with their other columns."""
    others = [c for c in maps.columns if c != "entities"]
    rows = maps.select(*others, F.explode_outer("entities").alias(key, value))
    return rows.filter(F.col(key).isNotNull())


def ne_doc_counts(items: DataFrame) -> DataFrame:
    return explode_map(doc_entity_map(items))


def ne_doc_types(items: DataFrame) -> DataFrame:
    return explode_map(doc_type_map(items), value="type_code")


def ner_typed_counts(labelled: DataFrame) -> DataFrame:
    return explode_map(retagged_map(labelled))
