"""Array expressions that work inside one record.

A record's sentences, tokens and mentions arrive in one row. Runs, groups and running totals over
them are computed where the row is, so none of the token-level work needs a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it in ``body``, also inside a lambda."""
    return F.get(F.transform(F.array(value), body), 0)


def indexes(n: Column) -> Column:
    """``[0 .. n-1]``, empty for ``n <= 0`` and null for a null ``n``."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).when(n <= 0, F.array().cast("array<int>"))


def part_of(items: Column, start: Column, stop: Column, value: Callable[[Column], Column] = lambda x: x) -> Column:
    """``items[start:stop]`` with ``value`` taken of each; ``start < stop``.

    Inside a lambda ``slice`` copies the whole array each time; reading by index does not.
    """
    return F.transform(F.sequence(start, stop - 1), lambda j: value(F.get(items, j)))


def run_starts(items: Column, key: Callable[[Column], Column]) -> Column:
    """Indexes at which ``key`` differs from the item before (nulls are equal)."""
    return F.filter(
        indexes(F.size(items)),
        lambda i: (i == 0) | ~key(F.get(items, i)).eqNullSafe(key(F.get(items, i - 1))),
    )


def group_sorted(df: DataFrame, items: str, key: str, out: str) -> DataFrame:
    """Groups of a sorted array column: ``out`` holds ``struct(key, items)`` for each distinct key."""
    marked = df.withColumn("_starts", run_starts(F.col(items), lambda x: x[key]))
    groups = F.transform(
        F.col("_starts"),
        lambda s, k: F.struct(
            F.get(F.col(items), s)[key].alias(key),
            part_of(
                F.col(items), s, F.coalesce(F.get(F.col("_starts"), k + 1), F.size(F.col(items))),
            ).alias("items"),
        ),
    )
    return marked.withColumn(out, groups).drop("_starts")


def group_sizes(df: DataFrame, items: str, key: str, out: str) -> DataFrame:
    """As :func:`group_sorted`, with only the number of items of each group."""
    marked = df.withColumn("_starts", run_starts(F.col(items), lambda x: x[key]))
    groups = F.transform(
        F.col("_starts"),
        lambda s, k: F.struct(
            F.get(F.col(items), s)[key].alias(key),
            (F.coalesce(F.get(F.col("_starts"), k + 1), F.size(F.col(items))) - s).alias("n"),
        ),
    )
    return marked.withColumn(out, groups).drop("_starts")


def _scan(values: Column) -> Column:
    """Running totals of a short array, led by 0."""
    return F.aggregate(
        values,
        F.array(F.lit(0)),
        lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)),
    )


def running_totals(df: DataFrame, values: str, out: str, block: int = 64) -> DataFrame:
    """Running totals of an int array column.

    Appending to an array copies it, so the totals are built in blocks: within each block, over the
    block sums, and then added together.
    """
    n = F.size(F.col(values))
    blocked = df.withColumn("_blocks", F.transform(
        indexes(F.ceil(n / block).cast("int")),
        lambda b: _scan(part_of(F.col(values), b * block, F.least((b + 1) * block, n)))))
    # ``let``: a column used once, inside a lambda, would be put there and evaluated each time.
    totals = let(
        _scan(F.transform("_blocks", lambda b: F.element_at(b, -1))),
        lambda bases: F.flatten(F.transform("_blocks", lambda b, i: F.transform(
            F.slice(b, 2, F.lit(block)), lambda x: x + F.get(bases, i)))))
    return blocked.withColumn(out, totals).drop("_blocks")


def unnest(df: DataFrame, keep: list[str], items: Column | str, *fields: str, place: str | None = None) -> DataFrame:
    """One row per array element: the ``keep`` columns and the element's ``fields`` (default: ``item``).

    ``explode`` makes Spark infer the filter "array not empty" and push it below the projection that
    computes the array, which computes it twice. The outer form infers nothing; its extra row for an
    empty array is dropped afterwards.
    """
    items = F.col(items) if isinstance(items, str) else items
    if place is None:
        rows = df.select(*keep, F.explode_outer(items).alias("item"))
    else:
        rows = df.select(*keep, F.posexplode_outer(items).alias(place, "item"))
    rows = rows.filter(F.col("item").isNotNull())
    head = [*keep, *([place] if place else [])]
    return rows.select(*head, *[F.col(f"item.{f}") for f in fields]) if fields else rows


def drop_null(df: DataFrame, column: str) -> DataFrame:
    """Rows whose computed ``column`` is not null.

    A filter on a computed column is pushed below the projection and computes it twice; a generator
    is not.
    """
    others = [c for c in df.columns if c != column]
    one = F.when(F.col(column).isNotNull(), F.array(F.col(column)))
    return df.select(*others, F.explode_outer(one).alias(column)).filter(F.col(column).isNotNull()).select(*df.columns)
