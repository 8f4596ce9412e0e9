"""Equi-joins of large fact tables with lookup tables."""

from __future__ import annotations

from pyspark.sql import DataFrame


def lookup_join(facts: DataFrame, lookup: DataFrame, on: list[str] | str, how: str = "inner") -> DataFrame:
    """Join in which one key may hold a large part of ``facts``; ``facts`` stay on the left.

    No hint is set: Spark broadcasts the lookup when its measured bytes are below
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise, and then splits a partition that
    a hot key makes large (``spark.sql.adaptive.skewJoin``, forced in :mod:`tidewell.session`).
    """
    return facts.join(lookup, on, how)
