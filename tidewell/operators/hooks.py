"""Annotate job with pluggable parts."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def annotate(
    df: DataFrame, key: str, inputs: list[str], schema: str | T.StructType, *,
    load: Callable[[], Any],
    contents: Callable[..., Iterable[str] | None],
    annotate_text: Callable[[Any, str], Iterable[Any]],
    consume: Callable[[list, Any], None] = list.append,
    keep: Callable[[list], bool] = bool,
) -> DataFrame:
    """Run a Python model over the records, one output row ``(key, values)`` per kept record.

    ``load`` runs once per task before its first record. ``contents`` gives a record's texts from the
    ``inputs`` columns (``None`` skips the record), ``annotate_text`` the model's annotations of one
    text, ``consume`` puts an annotation into the record's list, and ``keep`` decides on the list.
    """
    def run(batches: Iterator):
        import pandas as pd

        model = load()
        for batch in batches:
            rows = []
            for row in batch.itertuples(index=False):
                texts = contents(*[getattr(row, c) for c in inputs])
                if texts is None:
                    continue
                values: list = []
                for text in texts:
                    for found in annotate_text(model, text):
                        consume(values, found)
                if keep(values):
                    rows.append((getattr(row, key), values))
            yield pd.DataFrame(rows, columns=["key", "values"])

    return df.select(key, *inputs).mapInPandas(run, schema)
