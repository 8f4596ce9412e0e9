"""Token counts by heap-and-linked-list byte-pair merging.

A piece's symbols form a linked list; a heap holds the adjacent pairs that can merge, by rank, then place.
The lowest is popped and merged, its new neighbours are pushed, until none is left. The count is the number
of symbols at the start less the number of merges: no identifiers are made.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm import common
from tidewell.llm.wordbpe import Remembered, Vocabulary, parts, vocabulary


def merges_of(symbols: list[int], rules: dict[int, int], made: list[int]) -> int:
    """How many merges the symbols of one piece allow; ``symbols`` is used up.

    ``rules`` gives a pair's rank, ``made`` the merged symbol of a rank. ``rule[i]`` is the rank of the pair
    that starts at ``i`` now, so an entry of the heap that differs from it is out of date.
    """
    find = rules.get
    n = len(symbols)
    rule = [find((a << 20) | b) for a, b in zip(symbols, symbols[1:], strict=False)]
    rule.append(None)
    heap = [(r << 32) | i for i, r in enumerate(rule) if r is not None]
    if not heap:
        return 0
    heapify(heap)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    merges = 0
    while heap:
        entry = heappop(heap)
        i, r = entry & 0xFFFFFFFF, entry >> 32
        if rule[i] != r:
            continue
        merges += 1
        merged = symbols[i] = made[r]
        j = after[i]
        rule[j] = None
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            rule[i] = r = find((merged << 20) | symbols[k])
            if r is not None:
                heappush(heap, (r << 32) | i)
        else:
            rule[i] = None
        h = before[i]
        if h >= 0:
            rule[h] = r = find((symbols[h] << 20) | merged)
            if r is not None:
                heappush(heap, (r << 32) | h)
    return merges


def count_piece(piece: bytes | int, words: Vocabulary) -> int:
    """Tokens of one piece; a special token is one."""
    if isinstance(piece, int):
        return 1
    if len(piece) == 1:
        return 1
    symbols = [words.inner_ids[b] for b in piece]
    symbols[-1] = words.final_ids[piece[-1]]
    return len(symbols) - merges_of(symbols, words.rules, words.made)


@functools.lru_cache(maxsize=2)
def _memory(path: str) -> Remembered:
    words = vocabulary(path)
    return Remembered(lambda unseen: [sum(count_piece(p, words) for p in words.pieces(part)) for part in unseen])


def token_count(text: Column, path: str) -> Column:
    """Tokens of each text by the tokenizer file at ``path``; a null or empty text has 0.

    The whole text counts, whatever its length; special tokens' strings inside it count as those tokens.
    """

    def counts(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        memory = _memory(path)
        for texts in series:
            split = [parts(t) if t else [] for t in texts]
            known = memory.learn(split)
            yield pd.Series([sum(map(known.__getitem__, words)) for words in split], dtype="int64")
            memory.forget(split)

    return F.pandas_udf(counts, "long")(text)


def count_tokens(docs: DataFrame, path: str, limit: int = 2048, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit``) of every row.

    One row per input row, repeated rows too; a null text counts as empty; other columns are not read.
    """
    common.text_batches(docs)
    return (
        docs.select(doc, F.coalesce(text, F.lit("")).alias("_text"))
        .select(doc, F.octet_length("_text").cast("long").alias("n_bytes"), token_count(F.col("_text"), path).alias("n_tokens"))
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )
