"""Shaping of a text's annotations: best ones, lists, lines, links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.arrays import drop_null, unnest
from tidewell.model import LINK_CLOSE, LINK_OPEN, MIN_CONFIDENCE, TOP_ANNOTATIONS


def top_annotations(
    annotated: DataFrame, most: int = TOP_ANNOTATIONS, least: float = MIN_CONFIDENCE,
) -> DataFrame:
    """The first ``most`` annotations by score, equal scores by place, and of those the confident ones.

    The threshold comes after the cut: an annotation below it uses up a place.
    """
    ordered = F.sort_array(F.transform("annotations", lambda a: F.struct(
        (-a["score"]).alias("_order"), a["start"].alias("start"), a["end"].alias("end"), a["spot"].alias("spot"),
        a["entity"].alias("entity"), a["score"].alias("score"))))
    return annotated.withColumn("annotations", F.transform(
        F.filter(F.slice(ordered, 1, most), lambda a: a["score"] >= least),
        lambda a: a.dropFields("_order")))


def annotation_rows(annotated: DataFrame, keys: list[str]) -> DataFrame:
    return unnest(annotated, keys, "annotations", "start", "end", "spot", "entity", "score")


def annot_list(annotated: DataFrame, keys: list[str]) -> DataFrame:
    """``entities: array<struct<entity, score>>`` per text; texts without annotations have no row."""
    listed = F.transform("annotations", lambda a: F.struct(a["entity"].alias("entity"), a["score"].cast("float").alias("score")))
    rows = annotated.select(*keys, F.when(F.size("annotations") > 0, listed).alias("entities"))
    return drop_null(rows, "entities")


def _for_all(texts: DataFrame, annotated: DataFrame, keys: list[str], *more: str) -> DataFrame:
    """All texts, those without annotations with an empty array."""
    joined = texts.select(*keys, *more).join(annotated, keys, "left")
    return joined.withColumn("annotations", F.coalesce("annotations", F.array()))


def _lines(texts: DataFrame, annotated: DataFrame, keys: list[str], shown: str | None, *fields: str) -> DataFrame:
    # A comma parts the fields, so one inside a field is written as in a URL.
    parts = F.transform("annotations", lambda a: F.concat_ws(",", *[F.replace(a[f].cast("string"), F.lit(","), F.lit("%2C")) for f in fields]))
    return _for_all(texts, annotated, keys).select(*keys, F.concat_ws(
        "\t", F.concat(F.array(F.col(shown or keys[-1])), parts)).alias("line"))


def annot_lines(texts: DataFrame, annotated: DataFrame, keys: list[str], shown: str | None = None) -> DataFrame:
    """Line ``id TAB entity,score ...`` of every text; the id is the column ``shown``, or else the last of ``keys``."""
    return _lines(texts, annotated, keys, shown, "entity", "score")


def annot_mentions(texts: DataFrame, annotated: DataFrame, keys: list[str], shown: str | None = None) -> DataFrame:
    """Line ``id TAB mention,start,entity,score ...`` of every text, the id as in :func:`annot_lines`."""
    return _lines(texts, annotated, keys, shown, "spot", "start", "entity", "score")


def annot_render(texts: DataFrame, annotated: DataFrame, keys: list[str]) -> DataFrame:
    """Every text with its annotated mentions wrapped in links.

    A text has at most :data:`TOP_ANNOTATIONS` annotations and they do not overlap.
    """
    before, after = LINK_OPEN.split("{}")
    joined = _for_all(texts, annotated, keys, "text").withColumn("_at", F.sort_array("annotations"))

    def piece(a: Column, i: Column) -> Column:
        left = F.coalesce(F.get(F.col("_at"), i - 1)["end"], F.lit(0))
        return F.concat(
            F.substring(F.col("text"), left + 1, a["start"] - left),
            F.lit(before), a["entity"], F.lit(after),
            F.substring(F.col("text"), a["start"] + 1, a["end"] - a["start"]), F.lit(LINK_CLOSE))

    last = F.coalesce(F.element_at(F.transform("_at", lambda a: a["end"]), -1), F.lit(0))
    return joined.select(*keys, F.concat(
        F.array_join(F.transform("_at", piece), ""),
        F.substring(F.col("text"), F.when(F.size("_at") > 0, last).otherwise(0) + 1, F.length("text")),
    ).alias("rendered"))


def entity_label(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Add the ``label`` of each ``entity``, where there is one."""
    return rows.join(labels, "entity", "left")
