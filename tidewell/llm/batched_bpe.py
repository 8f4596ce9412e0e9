"""Byte-pair encoding of many words at a time in numpy, and decoding.

The symbols of all words not met before lie in one flat array. A round looks up all neighbouring pairs in the
table of pairs, takes each word's pair of lowest rank, and merges all its places,
from the left. As a merged symbol occurs only in pairs of higher rank, this gives the same symbols as
merging one place at a time. Words without a pair left leave the array.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm import common
from tidewell.llm.wordbpe import LONGEST_KEPT, Remembered, Vocabulary, parts, vocabulary

_NONE = np.iinfo(np.int64).max
#: Bits of a symbol in a key.
_SYMBOL = (1 << 20) - 1
#: Words, and other parts, that a :class:`BatchEncoder` keeps, some 25 MB each.
MEMORY = 1 << 17


class PairTable:
    """Merge rules as sorted keys (left symbol, right symbol), with rank and merged symbol.

    A rule's slot is its left symbol's offset plus its right symbol. Offsets are drawn until no two rules share a slot, so
    a look into one slot tells whether there is a rule.
    """

    def __init__(self, merges: dict[int, tuple[int, int]]) -> None:
        keys = np.fromiter(merges.keys(), np.int64, len(merges))
        order = np.argsort(keys)
        rules = np.array(list(merges.values()), np.int64).reshape(-1, 2)[order]
        self.keys, self.rank, self.merged = keys[order], rules[:, 0], rules[:, 1]
        left, right = self.keys >> 20, self.keys & _SYMBOL
        lefts, starts, sizes = np.unique(left, return_index=True, return_counts=True)
        spread = 1 << max(10, (3 * len(keys)).bit_length())
        self.offset = np.zeros(1 << 20, np.int32)
        self.owner = np.full(spread + (1 << 20), -1, np.int32)
        self.slot = np.zeros(spread + (1 << 20), np.int32)
        draw = np.random.default_rng(1)
        # The longest rows first, while there is most room.
        for row in np.argsort(-sizes, kind="stable").tolist():
            rules_of = np.arange(starts[row], starts[row] + sizes[row])
            at = right[rules_of] + draw.integers(spread)
            while (self.owner[at] >= 0).any():
                at = right[rules_of] + draw.integers(spread)
            self.offset[lefts[row]] = at[0] - right[rules_of[0]]
            self.owner[at], self.slot[at] = lefts[row], rules_of

    def find(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in the table and rank of each pair, ``_NONE`` where there is no rule."""
        left = pairs >> 20
        slots = self.offset[left] + (pairs & _SYMBOL)
        at = self.slot[slots]
        if not len(self.rank):
            return at, np.full(len(pairs), _NONE)
        return at, np.where(self.owner[slots] == left, self.rank[at], _NONE)


def merge_words(symbols: np.ndarray, lengths: np.ndarray, table: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """Merge the words laid end to end in ``symbols``; returns the merged symbols and new lengths."""
    word = np.repeat(np.arange(len(lengths)), lengths)
    done_symbols, done_words = [], []
    while len(symbols):
        at, rank = table.find((symbols[:-1] << 20) | symbols[1:])
        rank[word[:-1] != word[1:]] = _NONE
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        lowest = np.minimum.reduceat(np.r_[rank, _NONE], first)
        sizes = np.diff(np.r_[first, len(word)])
        place = np.flatnonzero((rank != _NONE) & (rank == np.repeat(lowest, sizes)[:-1]))
        # In a run of places ("aaa") every other one merges, from the left.
        run = np.flatnonzero(np.r_[True, np.diff(place) != 1]) if len(place) else place
        offset = np.arange(len(place)) - np.repeat(run, np.diff(np.r_[run, len(place)]))
        place = place[offset % 2 == 0]
        symbols = symbols.copy()
        symbols[place] = table.merged[at[place]]
        stays = np.ones(len(symbols), bool)
        stays[place + 1] = False
        live = np.repeat(lowest != _NONE, sizes)
        done_symbols.append(symbols[~live])
        done_words.append(word[~live])
        symbols, word = symbols[stays & live], word[stays & live]
    if not done_words:
        return symbols, lengths
    words, out = np.concatenate(done_words), np.concatenate(done_symbols)
    order = np.argsort(words, kind="stable")
    return out[order], np.bincount(words, minlength=len(lengths))


def merge_pieces(pieces: list[bytes], words: Vocabulary, table: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the pieces end to end, and how many each has."""
    flat = np.frombuffer(b"".join(pieces), np.uint8)
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    ends = np.cumsum(lengths)
    symbols = words.inner[flat]
    symbols[ends - 1] = words.final[flat[ends - 1]]
    return merge_words(symbols, lengths, table)


def encode_pieces(pieces: list[bytes], words: Vocabulary, table: PairTable) -> list[bytes]:
    """Ids of each piece as little-endian unsigned 32-bit numbers."""
    if not pieces:
        return []
    merged, sizes = merge_pieces(pieces, words, table)
    data, stops = merged.astype("<u4").tobytes(), (np.cumsum(sizes) * 4).tolist()
    return [data[start:stop] for start, stop in zip([0, *stops], stops, strict=False)]


def encode_parts(unseen: list[str], words: Vocabulary, table: PairTable) -> list[bytes]:
    """Ids of each part; each distinct piece is merged once."""
    split = [words.pieces(part) for part in unseen]
    distinct = list({piece for pieces in split for piece in pieces if isinstance(piece, bytes)})
    ids = dict(zip(distinct, encode_pieces(distinct, words, table), strict=True))
    return [b"".join(ids[p] if isinstance(p, bytes) else p.to_bytes(4, "little") for p in pieces) for pieces in split]


@functools.lru_cache(maxsize=2)
def _memory(path: str) -> Remembered:
    words = vocabulary(path)
    table = PairTable(words.merges)
    return Remembered(lambda unseen: encode_parts(unseen, words, table))


#: Words of Latin-1 letters, perhaps with a comma or full stop, which is a piece of its own.
_WORD = "^[A-Za-zÀ-ÖØ-öø-ÿ]+[,.]?$"


def _strings(words: pa.Array) -> list[str]:
    return words.to_numpy(zero_copy_only=False).tolist()


class BatchEncoder:
    """Ids of many texts at a time.

    The texts are split, and words told apart, lower-cased and freed of a sign behind them, in Arrow; only a batch's
    distinct words are looked up among those met before. The ids of all words met are in one array, of which a text's
    ids are taken in numpy; a word met for the second time is a number, never bytes of its own. Out of a full memory only
    the words go that no later batch had.
    """

    def __init__(self, path: str) -> None:
        self.words = vocabulary(path)
        self.table = PairTable(self.words.merges)
        self.others = Remembered(lambda unseen: encode_parts(unseen, self.words, self.table), MEMORY)
        self.signs = np.array([0, self.words.final[ord(",")], self.words.final[ord(".")]], "<u4")
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.count, self.start, self.size = 0, np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)
        self.again = np.zeros(1 << 12, bool)
        self.used, self.store = 0, np.zeros(1 << 16, "<u4")

    def _take(self, number: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """So many ids from where each numbered word begins, end to end."""
        ends = np.cumsum(counts)
        return self.store[np.repeat(self.start[number] - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)]

    def _forget(self) -> None:
        """Keep the words that a second batch had since the last time, or none where these fill half of the memory."""
        stay = {word: n for word, n in self.known.items() if self.again[n]}
        number = np.fromiter(stay.values(), np.int64, len(stay))
        sizes = self.size[number]
        ids = self._take(number, sizes)
        self._clear()
        if len(stay) <= MEMORY // 2 and len(ids) <= 8 * MEMORY:
            self.known = dict(zip(stay, self._hold(ids, sizes).tolist(), strict=True))

    def _hold(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Numbers of new words, whose ids lie end to end."""
        count, used = self.count + len(sizes), self.used + len(ids)
        if count > len(self.size):
            self.start, self.size, self.again = (np.resize(a, 2 * count) for a in (self.start, self.size, self.again))
        if used >= len(self.store):
            self.store = np.resize(self.store, 2 * used)
        self.store[self.used:used] = ids
        self.start[self.count:count] = self.used + np.cumsum(sizes) - sizes
        self.size[self.count:count] = sizes
        self.again[self.count:count] = False
        numbers = np.arange(self.count, count)
        self.count, self.used = count, used
        return numbers

    def _lower(self, words: list[str]) -> np.ndarray:
        """Numbers of distinct lower-case words of letters; long ones are not met again."""
        found = np.fromiter(map(self.known.get, words, itertools.repeat(-1)), np.int64, len(words))
        self.again[found[found >= 0]] = True
        holes = np.flatnonzero(found < 0)
        if len(holes):
            unseen = [words[i] for i in holes.tolist()]
            found[holes] = self._hold(*merge_pieces([word.encode() for word in unseen], self.words, self.table))
            self.known.update((w, n) for w, n in zip(unseen, found[holes].tolist(), strict=True) if len(w) <= LONGEST_KEPT)
        return found

    def _distinct(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Number of each of the distinct parts, without the sign behind it, and that sign; what follows ``kept`` is of this batch."""
        plain = pc.match_substring_regex(parts, _WORD)
        words, rest = parts.filter(plain), parts.filter(pc.invert(plain))
        base = pc.utf8_lower(pc.utf8_rtrim(words, ",.")).dictionary_encode()
        number, sign = np.empty(len(parts), np.int64), np.zeros(len(parts), np.int64)
        mask = plain.to_numpy(zero_copy_only=False)
        number[mask] = self._lower(_strings(base.dictionary))[base.indices.to_numpy(zero_copy_only=False)]
        sign[mask] = sum(k * pc.ends_with(words, s).to_numpy(zero_copy_only=False).astype(np.int64) for k, s in ((1, ","), (2, ".")))
        self.kept = self.count, self.used
        ids = self.others.results([_strings(rest)])[0]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        number[~mask] = self._hold(np.frombuffer(b"".join(ids), "<u4"), sizes)
        return number, sign

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The number of ids of each text, and all ids end to end as little-endian unsigned 32-bit numbers."""
        if len(self.known) > MEMORY or self.used > 16 * MEMORY:
            self._forget()
        split = pc.ascii_split_whitespace(texts)
        found = split.flatten()
        owner = np.repeat(np.arange(len(texts)), pc.fill_null(pc.list_value_length(split), 0).to_numpy(zero_copy_only=False))
        given = pc.not_equal(found, "")
        owner = owner[given.to_numpy(zero_copy_only=False)]
        coded = found.filter(given).dictionary_encode()
        number, sign = self._distinct(coded.dictionary)
        place = coded.indices.to_numpy(zero_copy_only=False)
        counts = (self.size[number] + (sign > 0))[place]
        # What is read one behind a word is its sign's place.
        ids, sign, ends = self._take(number[place], counts), sign[place], np.cumsum(counts)
        signed = np.flatnonzero(sign)
        ids[ends[signed] - 1] = self.signs[sign[signed]]
        self.count, self.used = self.kept
        return np.bincount(owner, weights=counts, minlength=len(texts)).astype(np.int64), ids


@functools.lru_cache(maxsize=2)
def batch_encoder(path: str) -> BatchEncoder:
    """One for each Python worker."""
    return BatchEncoder(path)


def encode(text: Column, path: str) -> Column:
    """Token ids (``array<int>``) of the whole text; none for a null or empty text."""

    def ids(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        memory = _memory(path)
        for texts in series:
            split = [parts(t) if t else [] for t in texts]
            known = memory.learn(split)
            yield pd.Series([np.frombuffer(b"".join(map(known.__getitem__, w)), "<u4").astype("i4") for w in split])
            memory.forget(split)

    return F.pandas_udf(ids, "array<int>")(text)


def decode(ids: Column, path: str) -> Column:
    """Text of token ids as the library gives it for a file without a decoder: the tokens with spaces between.

    Null ids give null; ids that the vocabulary lacks are left out.
    """

    def texts(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens = vocabulary(path).tokens
        top = max(tokens) + 1
        lookup = [tokens.get(i) for i in range(top)]
        for rows in series:
            yield pd.Series([
                None if row is None else " ".join([
                    t for i in row.tolist() if 0 <= i < top and (t := lookup[i]) is not None])
                for row in rows], dtype=object)

    return F.pandas_udf(texts, "string")(ids)


def encode_documents(docs: DataFrame, path: str, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc``, ``ids`` and ``decoded`` of every row; a null text counts as empty; other columns are not read."""
    common.text_batches(docs)
    return (
        docs.select(doc, F.coalesce(text, F.lit("")).alias("_text"))
        .select(doc, encode(F.col("_text"), path).alias("ids"))
        .withColumn("decoded", decode(F.col("ids"), path))
    )
