"""Encoding with a SentencePiece model that keeps every piece's place in the original bytes, and decoding.

A text is normalised by the longest entry of the model's compiled character map at each place; an array beside the
normalised bytes holds the original byte each of them came from. Byte pairs are merged in the normalised text, best
score first and then leftmost, and the pieces' ends are looked up in that array.

Merging never crosses a place whose two characters lie side by side in no piece of the vocabulary, so a text is cut
before white space and line feeds, and each distinct cut part is worked out once per Python worker.
"""

from __future__ import annotations

import functools
import itertools
import operator
import re
import struct
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm import common

SPACE = "▁"
#: Parts kept in a worker's memory, and the longest of them; a full memory starts anew.
MEMORY = 1 << 20
LONGEST_KEPT = 64
#: Kinds of pieces in a model file.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
CODED = "ids array<int>, starts array<int>, stops array<int>"
#: A word of more characters is merged by itself, with a heap.
LONG = 512
NONE = 1 << 62
_PARTS = re.compile("▁+[^▁\n]*|\n[^▁\n]*|[^▁\n]+")


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of a protocol-buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(kind) or number()
        yield key >> 3, data[at:at + size]
        at += size


def _pair(left: int, right: int) -> int:
    """One number for a pair; an unknown character, a negative number, is in none that is known."""
    return (left << 21) ^ right


class CharacterMap:
    """A compiled character map: a double-array trie over UTF-8 bytes, and the replacements its leaves point to."""

    def __init__(self, blob: bytes) -> None:
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4:4 + size], "<u4").tolist()
        self.replacements = blob[4 + size:]

    @staticmethod
    def _below(unit: int) -> int:
        """How far a unit's children lie from it (as an exclusive-or)."""
        return (unit >> 10) << ((unit & 512) >> 6)

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest entry that ``data`` has at ``at``."""
        if not self.units:
            return None
        units, found = self.units, None
        node = self._below(units[0])
        for end in range(at, len(data)):
            byte = data[end]
            node ^= byte
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != byte:
                break
            node ^= self._below(unit)
            if unit >> 8 & 1:
                found = end + 1 - at, units[node] & 0x7FFFFFFF
        if found is None:
            return None
        length, place = found
        return length, self.replacements[place:self.replacements.index(b"\0", place)]


class Model:
    """A model file of byte pairs with byte fallback, loaded once per Python worker with :func:`model`."""

    def __init__(self, data: bytes) -> None:
        pieces, trainer, normaliser = [], {}, {}
        for field, value in _fields(data):
            if field == 1:
                piece = dict(_fields(value))
                pieces.append((piece[1].decode(), struct.unpack("<f", piece.get(2, bytes(4)))[0], piece.get(3, NORMAL)))
            elif field == 2:
                trainer = dict(_fields(value))
            elif field == 3:
                normaliser = dict(_fields(value))
        kinds = {kind for _, _, kind in pieces}
        if trainer.get(3, 1) != 2 or kinds - {NORMAL, UNKNOWN, CONTROL, BYTE} or BYTE not in kinds or trainer.get(24):
            raise ValueError("only byte-pair models with byte fallback, leading spaces and no user-defined or unused pieces are read")
        self.map = CharacterMap(normaliser.get(2, b""))
        self.prefix, self.trim, self.escape = (bool(normaliser.get(i, 1)) for i in (3, 4, 5))
        self.end = next(i for i, (text, _, _) in enumerate(pieces) if text == trainer.get(47, b"</s>").decode())
        self.kinds = [kind for _, _, kind in pieces]
        self.byte_ids = [i for i, kind in enumerate(self.kinds) if kind == BYTE]
        self.ids = {text: i for i, (text, _, kind) in enumerate(pieces) if kind == NORMAL}
        # Pairs of pieces that make a third, sorted by their key, with the third and its place by score (ties are equal).
        order = {score: rank for rank, score in enumerate(sorted({score for _, score, kind in pieces if kind == NORMAL}, reverse=True))}
        made = {}
        for i, (text, score, kind) in enumerate(pieces):
            for cut in range(1, len(text) if kind == NORMAL else 0):
                left, right = self.ids.get(text[:cut]), self.ids.get(text[cut:])
                if left is not None and right is not None:
                    made[_pair(left, right)] = order[score], i
        self.pairs = np.array(sorted(made), np.int64)
        self.ranks, self.made = (np.array([made[key][field] for key in self.pairs.tolist()], np.int64) for field in (0, 1))
        # Ids of single characters; characters that are no piece are negative, by their number.
        self.signs = ~np.arange(0x110000, dtype=np.int64)
        for text, i in self.ids.items():
            if len(text) == 1:
                self.signs[ord(text)] = i
        # Neighbouring characters that occur in a piece; a merge never spans other neighbours.
        neighbours = {text[i:i + 2] for text in self.ids for i in range(len(text) - 1)}
        self.neighbours = np.array(sorted(_pair(*map(ord, pair)) for pair in neighbours), np.int64)
        self.apart = not any(pair[1] in "▁\n" and pair != SPACE * 2 for pair in neighbours)
        self.known: dict[str, bytes] = {}
        # Bytes of the text that an id takes; those of a character's bytes are told by their neighbours.
        self.sizes = np.array([len(text.encode()) for text, _, _ in pieces], np.int64)
        self.sizes[self.byte_ids] = 1
        self.sign_byte = np.full(len(pieces), -1)
        self.sign_byte[self.byte_ids] = np.arange(256)
        text_of = [text.replace(SPACE, " ").encode() for text, _, _ in pieces]
        for byte, i in enumerate(self.byte_ids):
            text_of[i] = bytes([byte])
        for i, kind in enumerate(self.kinds):
            if kind == CONTROL:
                text_of[i] = b""
            elif kind == UNKNOWN:
                text_of[i] = trainer.get(44, " ⁇ ".encode())
        self.text_of = text_of

    # --- normalisation ---

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its bytes and its end the original byte it came from."""
        if not text:
            return "", np.zeros(1, np.int32)
        if self.map.units or self.trim:
            return self._mapped(text.encode())
        data = np.frombuffer(text.encode(), np.uint8)
        marks = 3 if self.escape else 1
        head = marks if self.prefix else 0
        align = np.arange(len(data) + 1, dtype=np.int32)
        if self.escape:
            widths = np.where(data == 32, 3, 1)
            align = np.repeat(align, np.append(widths, 1))
        mark = SPACE if self.escape else " "
        return (mark if self.prefix else "") + text.replace(" ", mark), np.append(np.zeros(head, np.int32), align)

    def _mapped(self, data: bytes) -> tuple[str, np.ndarray]:
        mark = SPACE.encode() if self.escape else b" "
        out, align = [], []
        at, size, before = 0, len(data), self.trim

        def put(piece: bytes, origin: int) -> None:
            piece = piece.replace(b" ", mark)
            out.append(piece)
            align.extend([origin] * len(piece))

        def step(at: int) -> tuple[int, bytes]:
            found = self.map.longest(data, at)
            if found:
                return found
            first = data[at]
            width = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
            return width, data[at:at + width]

        while self.trim and at < size:
            width, piece = step(at)
            if piece != b" ":
                break
            at += width
        if at == size:
            return "", np.array([at], np.int32)
        if self.prefix:
            put(b" ", at)
        while at < size:
            width, piece = step(at)
            if before:
                piece = piece.lstrip(b" ")
            if piece:
                put(piece, at)
                before = piece.endswith(b" ")
            at += width
            before = before and self.trim
        joined, stop = b"".join(out), at
        if self.trim:
            while joined.endswith(mark):
                joined = joined[:-len(mark)]
                stop = align[len(joined)]
        return joined.decode(), np.array([*align[:len(joined)], stop], np.int32)

    # --- merging ---

    def _find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in the table and rank of each pair; no rank for pairs that make no piece."""
        keys = np.where((left >= 0) & (right >= 0), (left << 21) ^ right, -1)
        at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        return at, np.where(self.pairs[at] == keys, self.ranks[at], NONE)

    def merge(self, signs: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge the words that lie one after the other; ``word`` numbers each sign's.

        In each round each word merges one pair: that whose piece has the best score, the leftmost of equals. Ranks are
        kept and only those beside a merge are looked up again; words without a pair left leave the arrays.
        """
        done_signs, done_words = [], []
        at, rank = self._find(signs[:-1], signs[1:])
        at, rank = np.append(at, 0), np.append(np.where(word[:-1] == word[1:], rank, NONE), NONE)
        while len(signs):
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            best = np.minimum.reduceat(rank, first)
            sizes = np.diff(np.append(first, len(signs)))
            live = np.repeat(best != NONE, sizes)
            if not live.all():
                done_signs.append(signs[~live])
                done_words.append(word[~live])
                best, sizes = best[best != NONE], sizes[best != NONE]
                signs, word, at, rank = signs[live], word[live], at[live], rank[live]
                if not len(signs):
                    break
            place = np.flatnonzero(rank == np.repeat(best, sizes))
            place = place[np.append(True, word[place[1:]] != word[place[:-1]])]
            signs[place] = self.made[at[place]]
            stays = np.ones(len(signs), bool)
            stays[place + 1] = False
            signs, word, at, rank = signs[stays], word[stays], at[stays], rank[stays]
            place = place - np.arange(len(place))
            for i in (place, place[place > 0] - 1):
                right = np.minimum(i + 1, len(signs) - 1)
                at[i], found = self._find(signs[i], signs[right])
                rank[i] = np.where((i < right) & (word[i] == word[right]), found, NONE)
        signs, word = np.concatenate([signs, *done_signs]), np.concatenate([word, *done_words])
        by = np.argsort(word, kind="stable")
        return signs[by], word[by]

    def merge_long(self, signs: list[int]) -> list[int]:
        """As :meth:`merge` for one long word, with a heap of its pairs and links to the neighbours that are left."""
        n, pairs = len(signs), dict(zip(self.pairs.tolist(), zip(self.ranks.tolist(), self.made.tolist(), strict=True), strict=True))
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rule: list[tuple[int, int] | None] = [None] * n
        heap: list[tuple[int, int]] = []
        gone = [False] * n

        def renew(i: int) -> None:
            j = after[i]
            rule[i] = pairs.get(_pair(signs[i], signs[j])) if j < n and signs[i] >= 0 and signs[j] >= 0 else None
            if rule[i]:
                heappush(heap, (rule[i][0], i))

        for i in range(n):
            renew(i)
        while heap:
            rank, i = heappop(heap)
            if gone[i] or not rule[i] or rule[i][0] != rank:
                continue
            signs[i], gone[after[i]] = rule[i][1], True
            after[i] = after[after[i]]
            if after[i] < n:
                before[after[i]] = i
            renew(i)
            if before[i] >= 0:
                renew(before[i])
        return [sign for sign, out in zip(signs, gone, strict=True) if not out]

    def _code(self, parts: list[str]) -> list[bytes]:
        """Ids of each part, as little-endian 32-bit numbers."""
        if not parts:
            return []
        points = np.frombuffer("".join(parts).encode("utf-32-le"), "<u4").astype(np.int64)
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
        keys = (points[:-1] << 21) ^ points[1:]
        near = np.minimum(np.searchsorted(self.neighbours, keys), len(self.neighbours) - 1)
        fresh = np.append(True, self.neighbours[near] != keys)
        fresh[ends[:-1]] = True
        word = np.cumsum(fresh) - 1
        signs = self.signs[points]
        owner = np.repeat(np.arange(len(parts)), np.diff(np.append(0, ends)))[fresh]
        lengths = np.bincount(word)
        long = lengths > LONG
        if long.any():
            starts = np.append(0, np.cumsum(lengths))
            apart = {int(w): self.merge_long(signs[starts[w]:starts[w + 1]].tolist()) for w in np.flatnonzero(long)}
            inside = ~long[word]
            signs, word = self.merge(signs[inside], word[inside])
            signs = np.concatenate([signs, *[np.array(x, np.int64) for x in apart.values()]])
            word = np.concatenate([word, *[np.full(len(x), w) for w, x in apart.items()]])
            by = np.argsort(word, kind="stable")
            signs, word = signs[by], word[by]
        else:
            signs, word = self.merge(signs, word)
        part = owner[word]
        strange = np.flatnonzero(signs < 0)
        if len(strange):
            data = [chr(~x).encode() for x in signs[strange].tolist()]
            widths = np.ones(len(signs), np.int64)
            widths[strange] = [len(x) for x in data]
            signs, part = np.repeat(signs, widths), np.repeat(part, widths)
            signs[signs < 0] = [self.byte_ids[b] for x in data for b in x]
        stops = np.cumsum(np.bincount(part, minlength=len(parts))) * 4
        coded = signs.astype("<i4").tobytes()
        return [coded[start:stop] for start, stop in zip([0, *stops.tolist()], stops.tolist(), strict=False)]

    def _taken(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of the normalised text that each id takes; all of a character's bytes are its last byte id's."""
        sizes, byte = self.sizes[ids], self.sign_byte[ids]
        if (byte < 0x80).all():
            return sizes
        more = (byte >= 0x80) & (byte < 0xC0)
        at = np.arange(len(ids))
        lead = np.maximum.accumulate(np.where(byte >= 0xC0, at, -1))
        last = more & ~np.append(more[1:], False)
        return np.where(last, at - lead + 1, np.where(byte >= 0x80, 0, sizes))

    def parts(self, text: str) -> list[str]:
        """Parts of a normalised text that no merge crosses."""
        if not self.apart:
            return [text] if text else []
        spread = text.replace(SPACE, " " + SPACE).replace("\n", " \n")
        parts = spread.split(" ")
        # A mark by itself may belong to the next one: white space in a row.
        if " " in text or SPACE in parts:
            return _PARTS.findall(text)
        return parts[1:] if parts[0] == "" else parts

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Ids of each text, and the original bytes ``[start, stop)`` each stands for."""
        normal = [self.normalise(text) for text in texts]
        split = [self.parts(text) for text, _ in normal]
        known, out = self.known, []
        if len(known) > MEMORY:
            known.clear()
        coded = [list(map(known.get, parts)) for parts in split]
        holes = [list(itertools.compress(itertools.count(), map(operator.not_, row))) for row in coded]
        unseen = list({parts[i] for parts, at in zip(split, holes, strict=True) for i in at})
        known.update(zip(unseen, self._code(unseen), strict=True))
        for row, parts, at, (_, align) in zip(coded, split, holes, normal, strict=True):
            for i in at:
                row[i] = known[parts[i]]
            ids = np.frombuffer(b"".join(row), "<i4")
            ends = np.append(0, np.cumsum(self._taken(ids)))
            out.append((ids, align[ends[:-1]], align[ends[1:]]))
        for part in unseen:
            if len(part) > LONGEST_KEPT:
                del known[part]
        return out

    # --- decoding ---

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids: marks become spaces, the first one falls away, byte pieces are joined to characters."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.kinds)):
            ids = ids[(ids >= 0) & (ids < len(self.kinds))]
        ids = ids.tolist()
        data = b"".join(map(self.text_of.__getitem__, ids))
        if self.prefix or self.trim:
            first = next((i for i in ids if self.text_of[i]), None)
            if first is not None and self.kinds[first] == NORMAL and data.startswith(b" "):
                data = data.lstrip(b" ") if self.trim else data[1:]
        try:
            return data.decode()
        except UnicodeDecodeError:
            return _whole_characters(data)


def _whole_characters(data: bytes) -> str:
    """UTF-8 in which each byte that is part of no character becomes U+FFFD."""
    out, at = [], 0
    while at < len(data):
        for width in (1, 2, 3, 4):
            try:
                out.append(data[at:at + width].decode())
            except UnicodeDecodeError:
                continue
            at += width
            break
        else:
            out.append("�")
            at += 1
    return "".join(out)


@functools.lru_cache(maxsize=2)
def model(path: str) -> Model:
    with open(path, "rb") as file:
        return Model(file.read())


def encode(text: Column, path: str, end: bool = True) -> Column:
    """``struct<ids, starts, stops>`` of the whole text: token ids and the original UTF-8 bytes of each.

    With ``end`` the model's end id follows, at the text's end and of no bytes. A null or empty text has no other
    ids. ``path`` is the model file's place on every executor.
    """

    def coded(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = model(path)
        tail = np.array([known.end], "<i4") if end else np.zeros(0, "<i4")
        for texts in series:
            rows = known.encode([t or "" for t in texts])
            sizes = [len(t.encode()) if t else 0 for t in texts]
            # Bytes that fall away at the end are nobody's; the end id stands behind all bytes.
            last = [np.full(len(tail), size, "<i4") for size in sizes]
            yield pd.DataFrame({
                "ids": [np.append(ids, tail) for ids, _, _ in rows],
                "starts": [np.append(starts, z) for (_, starts, _), z in zip(rows, last, strict=True)],
                "stops": [np.append(stops, z) for (_, _, stops), z in zip(rows, last, strict=True)]})

    return F.pandas_udf(coded, CODED)(text)


def decode(ids: Column, path: str) -> Column:
    """Text of token ids; null ids give null, ids that the model lacks are left out."""

    def texts(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = model(path)
        for rows in series:
            yield pd.Series([None if row is None else known.decode(row) for row in rows], dtype=object)

    return F.pandas_udf(texts, "string")(ids)


def encode_documents(docs: DataFrame, path: str, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc``, ``ids``, ``starts``, ``stops`` and ``decoded`` of every row; other columns are not read.

    A null text counts as empty; rows that repeat are coded as often as they come; an empty table gives no rows.
    """
    common.text_batches(docs)
    return (
        docs.select(doc, F.coalesce(text, F.lit("")).alias("_text"))
        .select(doc, encode(F.col("_text"), path).alias("_coded"))
        .select(doc, "_coded.*")
        .withColumn("decoded", decode(F.col("ids"), path))
    )
