"""Numpy over the nested arrays of many records at once, for Arrow functions.

A batch's arrays are laid end to end; a record is a number beside each element. What the lambdas of
:mod:`tidewell.functions.arrays` do element by element is here done for the whole batch.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: Records of a batch; texts are long, and a record's terms are several times its text.
BATCH_ROWS = 256
#: Elements that are worked on together, but for a record that has more.
ELEMENTS = 1 << 19


def record_batches(df: DataFrame) -> DataFrame:
    """``df``, whose plan is to hand its records to Python in batches of :data:`BATCH_ROWS`."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df


def laid(lists: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The sizes of the lists (0 for null) and their elements end to end."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return sizes, lists.flatten()


def laid_entries(maps: pa.MapArray) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """The sizes of the maps (0 for null), their keys and their values end to end."""
    bounds = maps.offsets.to_numpy().astype(np.int64)
    first, n = int(bounds[0]), int(bounds[-1] - bounds[0])
    return np.diff(bounds), maps.keys.slice(first, n), maps.items.slice(first, n)


def places(sizes: np.ndarray) -> np.ndarray:
    """Each element's place in its list."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def field(structs: pa.Array, name: str) -> pa.Array:
    """A field of structs, null where the struct is."""
    return pc.struct_field(structs, name)


def ranks(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Each word's place among the distinct words, and these in byte order, null first."""
    coded = words.dictionary_encode(null_encoding="encode")
    order = pc.array_sort_indices(coded.dictionary, null_placement="at_start")
    rank = np.empty(len(order), np.int64)
    rank[order.to_numpy()] = np.arange(len(order))
    return rank[coded.indices.to_numpy(zero_copy_only=False)], coded.dictionary.take(order)


def starts_of(*keys: np.ndarray) -> np.ndarray:
    """Indexes at which one of the keys differs from the element before."""
    n = len(keys[0])
    changed = np.zeros(n, bool)
    changed[:1] = True
    for key in keys:
        changed[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(changed)


def offsets(owner: np.ndarray, owners: int) -> pa.Array:
    """List offsets from each element's owner, in order."""
    return pa.array(np.searchsorted(owner, np.arange(owners + 1)), pa.int32())


def group_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts) if len(starts) else np.zeros(0, np.int64)


def in_parts(columns: tuple[pa.Array, ...], sizes: np.ndarray, work: Callable[..., pa.Array]) -> pa.Array:
    """``work`` on runs of records that have :data:`ELEMENTS` together, put end to end."""
    if not len(sizes):
        return work(*columns)
    part = np.cumsum(sizes) // ELEMENTS
    bounds = [*starts_of(part).tolist(), len(sizes)]
    return pa.concat_arrays([work(*(c.slice(a, b - a) for c in columns)) for a, b in zip(bounds, bounds[1:])])
