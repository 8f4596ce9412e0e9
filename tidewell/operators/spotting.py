"""Mention dictionary from page links, and its mentions in texts.

``texts`` are tables of key columns and a ``text``. Word offsets and word sequences are worked out in
the text's row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions.arrays import running_totals, unnest
from tidewell.functions.text import words
from tidewell.model import MIN_COMMONNESS, MIN_LINK_PROBABILITY
from tidewell.operators.index import number_in_order
from tidewell.operators.joins import lookup_join
from tidewell.session import materialize


def longest(spots: DataFrame) -> Column:
    """Words of the longest spot, as a scalar subquery."""
    return spots.agg(F.max(F.size(F.split("spot", " "))).alias("n")).scalar()


PLACE = ("tok", "n", "start", "end")
MENTION = (*PLACE, "spot", "spot_id", "link_probability", "entity", "commonness", "n_candidates")


def prefixes(spots: DataFrame) -> DataFrame:
    """``(first, lengths)``: the first words of spots, and the numbers of words of the spots that begin with each."""
    parts = F.split("spot", " ")
    return spots.select(F.get(parts, 0).alias("first"), F.size(parts).alias("n")).groupBy("first").agg(
        F.sort_array(F.collect_set("n")).alias("lengths"))


def _with_words(texts: DataFrame, keys: list[str], longest_spot: Column) -> DataFrame:
    """Keys, the text's ``_lower`` words, their ``_starts`` and ``_ends`` in the text, and ``_most`` words of a spot."""
    read = texts.select(*keys, words(F.col("text")).alias("_words"), F.split("text", r"\pL+").alias("_gaps"))
    # There is one gap more than words; the last total is not used.
    read = read.withColumn("_widths", F.zip_with(
        "_words", "_gaps", lambda w, g: F.coalesce(F.length(w), F.lit(0)) + F.length(g)))
    return running_totals(read, "_widths", "_ends").select(
        *keys, F.transform("_words", F.lower).alias("_lower"), "_ends",
        F.zip_with("_words", "_ends", lambda w, e: e - F.length(w)).alias("_starts"), F.coalesce(longest_spot, F.lit(0)).alias("_most"))


def _grams(read: DataFrame, first_words: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys, spot, tok, n, start, end)``: the word sequences of a text that a spot may be.

    A word that begins no spot leaves the text without sequences, others only those of the lengths of its spots. So a
    row holds at most the words of the longest spot, also where the first words are too many to be broadcast.
    """
    at = read.select(
        *keys, "_most", "_lower", "_ends", "_starts", F.posexplode_outer("_lower").alias("tok", "first")).filter(F.col("first").isNotNull())
    near = lambda name: F.slice(name, F.col("tok") + 1, F.col("_most"))
    skinny = at.select(*keys, "tok", "first", F.get("_starts", F.col("tok")).alias("start"), near("_lower").alias("_near"), near("_ends").alias("_stops"))
    known = lookup_join(skinny, first_words, "first")
    rows = known.select("*", F.explode_outer("lengths").alias("n")).filter(F.col("n") <= F.size("_near"))
    return rows.select(
        *keys,
        F.when(F.col("n") == 1, F.col("first")).otherwise(F.array_join(F.slice("_near", F.lit(1), F.col("n")), " ")).alias("spot"),
        "tok", "n", "start", F.get("_stops", F.col("n") - 1).alias("end"))


def find_spots(texts: DataFrame, spots: DataFrame, keys: list[str]) -> DataFrame:
    """Mentions of the ``spots`` (unique, with any further columns): ``(keys, spot, ..., tok, n, start, end)``.

    The table of first words prunes the word sequences before they are looked up; both lookups happen in the text's
    task while their bytes allow them to be broadcast.
    """
    return lookup_join(_grams(_with_words(texts, keys, longest(spots)), prefixes(spots), keys), spots, "spot")


def spot_frequency(texts: DataFrame, spots: DataFrame, keys: list[str]) -> DataFrame:
    """``(spot, doc_freq)``: number of texts in which each spot occurs."""
    known = spots.select("spot").distinct()
    hits = find_spots(texts, known, keys)
    return hits.select(*keys, "spot").distinct().groupBy("spot").agg(F.count(F.lit(1)).alias("doc_freq"))


def spot_stats(anchors: DataFrame, texts: DataFrame, keys: list[str]) -> DataFrame:
    """Links per spot and target, and the spot's link probability over ``texts``.

    ``anchors`` are rows ``(page, target, spot)``. The probability is the share of the texts with the
    spot in which it is a link.
    """
    pairs = anchors.groupBy("spot", "target").agg(F.count(F.lit(1)).alias("links"))
    linked = anchors.groupBy("spot", "page").agg(F.count(F.lit(1)).alias("n")).groupBy("spot").agg(
        F.sum("n").alias("spot_links"), F.count(F.lit(1)).alias("link_docs"))
    per_spot = linked.join(spot_frequency(texts, anchors, keys), "spot", "left").select(
        "spot", "spot_links", "link_docs", F.greatest(F.coalesce("doc_freq", F.lit(0)), "link_docs").alias("doc_freq"))
    return lookup_join(pairs, per_spot, "spot").withColumn(
        "link_probability", F.col("link_docs") / F.col("doc_freq"))


def likely_spots(stats: DataFrame, least: float = MIN_LINK_PROBABILITY) -> DataFrame:
    return stats.filter(F.col("link_probability") >= least)


def link_prior(stats: DataFrame, least: float = MIN_COMMONNESS) -> DataFrame:
    """Commonness of each target of a spot, and its rank. At most ``1 / least`` targets of a spot stay."""
    common = stats.withColumn("commonness", F.col("links") / F.col("spot_links")).filter(F.col("commonness") >= least)
    order = Window.partitionBy("spot").orderBy(F.desc("commonness"), "target")
    return common.withColumn("rank", F.row_number().over(order))


def dictionary(stats: DataFrame) -> DataFrame:
    """``(spot, spot_id, link_probability, candidates)``, the candidates best first.

    The ids are dense; the table is stored in the shared folder, as every step of linking reads it.
    """
    common = likely_spots(stats).withColumn("commonness", F.col("links") / F.col("spot_links")).filter(
        F.col("commonness") >= MIN_COMMONNESS)
    grouped = common.groupBy("spot").agg(
        F.min("link_probability").alias("link_probability"),
        F.sort_array(F.collect_list(F.struct((-F.col("commonness")).alias("_order"), "target", "commonness"))).alias("c"))
    numbered = number_in_order(grouped, "spot", "spot_id")
    return materialize(numbered.select("spot", F.col("spot_id").cast("int").alias("spot_id"), "link_probability", F.transform(
        "c", lambda c: F.struct(c["target"].alias("entity"), c["commonness"].alias("commonness"))).alias("candidates")))


def doc_mentions(texts: DataFrame, spots: DataFrame, keys: list[str]) -> DataFrame:
    """Keys and ``mentions``, all dictionary mentions of a text in order of place.

    A mention (see :data:`MENTION`) has its spot's best candidate and number of candidates. Texts without a mention
    have no row. A text's mentions are grouped by its key and are at most as many as it has word sequences.
    """
    best = F.get("candidates", 0)
    slim = spots.select(
        "spot", "spot_id", "link_probability", best["entity"].alias("entity"), best["commonness"].alias("commonness"),
        F.size("candidates").alias("n_candidates"))
    return find_spots(texts, slim, keys).groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct(*MENTION))).alias("mentions"))


def without_overlaps(docs: DataFrame) -> DataFrame:
    """Drop a mention that shares a word with a longer one, or with an earlier one of equal length.

    Mentions are in order of place, so those that share a word are near: there are at most ``w * w``
    of them on each side for spots of up to ``w`` words.
    """
    def beats(other: Column, one: Column) -> Column:
        overlap = (other["tok"] < one["tok"] + one["n"]) & (one["tok"] < other["tok"] + other["n"])
        gain = (other["end"] - other["start"]) - (one["end"] - one["start"])
        # One word alone beats nothing: what shares that word is longer.
        return (other["n"] > 1) & overlap & ((gain > 0) | ((gain == 0) & (other["start"] < one["start"])))

    widest = F.array_max(F.transform("mentions", lambda m: m["n"]))
    reach = docs.withColumn("_reach", widest * widest)
    kept = F.filter("mentions", lambda m, i: ~F.exists(
        F.sequence(F.greatest(i - F.col("_reach"), F.lit(0)), F.least(i + F.col("_reach"), F.size("mentions") - 1)),
        lambda j: beats(F.get(F.col("mentions"), j), m)))
    return reach.withColumn("_kept", kept).withColumn("mentions", F.col("_kept")).drop("_reach", "_kept")


def mention_rows(docs: DataFrame, keys: list[str]) -> DataFrame:
    """One row per mention."""
    return unnest(docs, keys, "mentions", *MENTION, place="ord")


def candidates(docs: DataFrame, spots: DataFrame, keys: list[str]) -> DataFrame:
    """One row per mention and candidate entity."""
    rows = mention_rows(docs, keys).select(*keys, "start", "end", "spot", "spot_id")
    known = lookup_join(rows, spots.select("spot_id", "candidates"), "spot_id")
    return unnest(known, [*keys, "start", "end", "spot"], "candidates", "entity", "commonness")
