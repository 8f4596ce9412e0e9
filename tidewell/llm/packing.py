"""Packing documents into sequences by bounded-space online best fit.

Each partition keeps a fixed number of open windows. A document's whole sequences leave at once; its rest goes
to the open window with the least room that holds it; when none does and all windows are in use, the fullest
is emitted. What is open at the end of the partitions is merged, eight partitions to one in each round, by
filling windows to the brim, until one task is left with less than a sequence.
"""

from __future__ import annotations

import functools
import itertools
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm import common
from tidewell.llm.batched_bpe import batch_encoder
from tidewell.session import materialize

SEQUENCE = 4096
END = 2
#: Open windows of a partition: 256 windows of 4,096 ids hold 4 MB.
WINDOWS = 256
#: Partitions whose open windows one task merges.
MERGE = 8
PIECE = "doc long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, done boolean"
_COLUMNS = ["doc", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "done"]
_ARROW = pa.schema([(name, {"ids": pa.binary(), "done": pa.bool_()}.get(name, pa.int64())) for name in _COLUMNS])


class Windows:
    """Open windows of one task, by room; windows that leave are handed out with their sequence number."""

    def __init__(self, base: int, limit: int, size: int) -> None:
        self.room: list[tuple[int, int]] = []
        self.held: dict[int, list[tuple]] = {}
        self.base, self.limit, self.size = base, limit, size
        self.number = itertools.count()

    def _rows(self, pieces: list[tuple], done: bool) -> list[tuple]:
        sequence, rows, offset = self.base + next(self.number), [], 0
        for doc, start, ids, total in pieces:
            rows.append((doc, start, len(ids) // 4, ids, total, sequence, offset, done))
            offset += len(ids) // 4
        return rows

    def add(self, doc: int | None, ids: bytes) -> list[tuple]:
        """Place one document; returns the rows of the sequences that are complete or emitted."""
        total, out, at = len(ids) // 4, [], 0
        while total - at >= self.size:
            out += self._rows([(doc, at, ids[4 * at:4 * (at + self.size)], total)], True)
            at += self.size
        if at == total:
            return out
        piece, need = (doc, at, ids[4 * at:], total), total - at
        best = bisect_left(self.room, (need, -1))
        if best < len(self.room):
            left, key = self.room.pop(best)
            self.held[key].append(piece)
        else:
            if len(self.room) >= self.limit:
                _, fullest = self.room.pop(0)
                out += self._rows(self.held.pop(fullest), True)
            left, key = self.size, next(self.number)
            self.held[key] = [piece]
        if left == need:
            out += self._rows(self.held.pop(key), True)
        else:
            insort(self.room, (left - need, key))
        return out

    def rest(self) -> list[tuple]:
        return [row for _, key in self.room for row in self._rows(self.held[key], False)]


def _base(round_number: int) -> int:
    """Sequence numbers of a task of a round start here: 8 bits for the round, 24 for the task, 31 within it."""
    return (round_number << 55) | (TaskContext.get().partitionId() << 31)


def _task() -> Column:
    """The task in a sequence number."""
    return F.shiftright("sequence_id", 31).bitwiseAND((1 << 24) - 1)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=_COLUMNS)
    return frame.astype({"doc": "Int64"})


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(_COLUMNS)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW)


def _place(docs: DataFrame, path: str, end: int, windows: int, size: int) -> DataFrame:
    tail = end.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, open_windows = batch_encoder(path), Windows(_base(0), windows, size)
        for batch in batches:
            counts, ids = encoder.encode(batch["text"])
            data, ends = ids.tobytes(), (4 * np.cumsum(counts)).tolist()
            rows: list[tuple] = []
            for doc, start, stop in zip(batch["doc"].to_pylist(), [0, *ends], ends, strict=False):
                rows += open_windows.add(doc, data[start:stop] + tail)
            yield _batch(rows)
        yield _batch(open_windows.rest())

    return docs.mapInArrow(run, PIECE)


def _merge(rest: DataFrame, tasks: int, round_number: int, last: bool, size: int) -> DataFrame:
    """Fill windows to the brim with the open windows' pieces; a piece that crosses the brim is cut."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sequence, offset, waiting = _base(round_number), 0, []
        for frame in frames:
            out: list[tuple] = []
            for doc, start, ids, total in zip(frame["doc"], frame["start"], frame["ids"], frame["doc_tokens"], strict=True):
                doc, at, n = (None if pd.isna(doc) else int(doc)), 0, len(ids) // 4
                while at < n:
                    take = min(n - at, size - offset)
                    waiting.append((doc, start + at, take, ids[4 * at:4 * (at + take)], total, sequence, offset, True))
                    at, offset = at + take, offset + take
                    if offset == size:
                        out += waiting
                        sequence, offset, waiting = sequence + 1, 0, []
            yield _frame(out)
        yield _frame([(*row[:-1], last) for row in waiting])

    dealt = rest.withColumn("task", F.pmod(_task(), F.lit(tasks)).cast("int")).repartitionById(tasks, "task").sortWithinPartitions("sequence_id", "offset")
    return dealt.drop("task").mapInPandas(run, PIECE)


def pack(
    docs: DataFrame, path: str, end: int = END, windows: int = WINDOWS, size: int = SEQUENCE,
    doc: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Pieces of all documents: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids`` are the piece's token ids as little-endian unsigned 32-bit numbers. A document is the ids of its
    whole text and then ``end``; a null or empty text is ``end`` alone. Rows that repeat a document are
    packed as often as they come; a null ``doc_id`` stays null. Only the last sequence of the last merge and
    the windows emitted as fullest have padding. An empty table gives no pieces.
    """
    common.text_batches(docs)
    source = docs.select(F.col(doc).cast("long").alias("doc"), F.col(text).alias("text"))
    step = materialize(_place(source, path, end, windows, size), "pieces")
    tasks, number, closed = (step.agg(F.max(_task())).first()[0] or 0) + 1, 0, []
    while True:
        closed.append(step.filter("done"))
        if tasks == 1 and number:
            break
        tasks, number = -(-tasks // MERGE), number + 1
        step = materialize(_merge(step.filter("not done"), tasks, number, tasks == 1, size), "pieces")
    return functools.reduce(DataFrame.unionByName, closed).select(
        F.col("doc").alias("doc_id"), "start", "length", "ids", "doc_tokens", "sequence_id", "offset")
