"""Quality rules over text statistics, with robust multivariate outliers per language and source.

Fixed limits reject first. The rest is judged by the minimum covariance determinant (MCD): per language and
source, the mean and covariance of the ``SHARE`` of documents that lie closest together, found by C-steps
from three starts (the one with the least determinant counts), and a document is rejected when its
Mahalanobis distance is beyond a chi-square limit. The same is estimated per language and over all, and the distances
are blended by weights that grow smoothly with the documents of a cell, so no size switches the verdict.
DataFrame functions only.

The covariance is mixed with a part of the identity (regularised MCD, Boudt et al. 2020), because most
documents have no symbol and no repeated line at all.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.arrays import indexes, let
from tidewell.llm.common import lookup_join
from tidewell.session import materialize

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
SIGNS = "!?;:=_~^"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ"
#: Share of a cell's documents that the estimate is made of.
SHARE = 0.75
#: Documents of a language and source at which its own estimate counts as much as its language's (and so on for all).
HALF = 50.0
#: Cell of all documents; other cells' names begin otherwise.
ALL = "all"
C_STEPS = 5
#: Part of the identity in the covariance of the scaled statistics.
RIDGE = 0.25
#: Normal deviate of the chi-square limit (upper tail of about 3e-7).
TAIL = 5.0
#: Least scale of each transformed statistic, in its own units: differences below it are no evidence.
FLOORS = {"x_word": 0.1, "x_symbol": 0.05, "x_line": 0.25, "x_repeat": 0.2, "x_sign": 0.08, "x_capital": 0.1}
STATISTICS = tuple(FLOORS)
_P = len(STATISTICS)


def _without(text: Column, signs: str) -> Column:
    return F.translate(text, signs, "")


def words(text: Column) -> Column:
    """Runs of anything but ASCII white space."""
    return F.filter(F.split(text, f"[{SPACES}]+"), lambda w: w != "")


def repeated_words(hashes: Column) -> Column:
    """Words that lie in a window of five found twice or more, given the windows' hashes in order."""
    placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    starts = let(placed, lambda z: F.array_sort(F.transform(
        F.filter(indexes(F.size(z)), lambda k: (F.get(z, k)["h"].eqNullSafe(F.get(z, k - 1)["h"]))
                 | (F.get(z, k)["h"].eqNullSafe(F.get(z, k + 1)["h"]))),
        lambda k: F.get(z, k)["i"])))
    return F.aggregate(
        starts, F.struct(F.lit(0).alias("n"), F.lit(-5).alias("at")),
        lambda a, s: F.struct((a["n"] + F.least(F.lit(5), s - a["at"])).alias("n"), s.alias("at")),
        lambda a: a["n"])


def base_statistics(
    docs: DataFrame, carry: list[str] | None = None, text: str = "text", lang: str = "lang", source: str = "source",
) -> DataFrame:
    """The ``carry`` columns (default: all) as struct ``row``, the base counts, ``base_failed``, the statistics."""
    counted = docs.select(
        F.struct(*(carry or ["*"])).alias("row"), F.col(lang).alias("lang"), F.col(source).alias("source"),
        F.coalesce(text, F.lit("")).alias("_text"),
    ).select(
        "row", "lang", "source",
        words(F.col("_text")).alias("_words"),
        F.filter(F.split("_text", "\n"), lambda line: _without(line, SPACES) != "").alias("_lines"),
        _without(F.col("_text"), SPACES).alias("_solid"),
    ).select(
        "row", "lang", "source", "_words", F.size("_words").cast("long").alias("n_words"),
        F.length("_solid").cast("long").alias("word_chars"),
        (F.length("_solid") - F.length(_without(F.col("_solid"), SYMBOLS))).cast("long").alias("n_symbols"),
        (F.length("_solid") - F.length(_without(F.col("_solid"), SIGNS))).alias("_signs"),
        (F.length("_solid") - F.length(_without(F.col("_solid"), CAPITALS))).alias("_capitals"),
        F.size("_lines").alias("_n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
    ).withColumn(
        "_windows", F.transform(indexes(F.size("_words") - 4), lambda i: F.xxhash64(
            *[F.get(F.col("_words"), i + k) for k in range(5)])),
    ).withColumn(
        "n_repeat_words", F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"),
                                 repeated_words(F.col("_windows"))).otherwise(0).cast("long"))
    share = lambda part, whole, prior: F.sqrt(part / (whole + F.lit(prior)))
    # The added counts pull short documents to the middle, as their shares say little.
    return counted.select(
        "row", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        ((F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))).alias("base_failed"),
        F.log((F.col("word_chars") + 250.0) / (F.col("n_words") + 50.0)).alias("x_word"),
        share(F.col("n_symbols"), F.col("word_chars"), 100.0).alias("x_symbol"),
        share(F.col("n_dup_lines"), F.col("_n_lines"), 10.0).alias("x_line"),
        share(F.col("n_repeat_words"), F.col("n_words"), 50.0).alias("x_repeat"),
        share(F.col("_signs"), F.col("word_chars"), 100.0).alias("x_sign"),
        share(F.col("_capitals"), F.col("word_chars"), 100.0).alias("x_capital"),
    )


def _named(stats: DataFrame) -> DataFrame:
    """Add the ``pair`` of language and source, and the language as ``one``."""
    name = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("null"))
    return stats.withColumn("pair", F.concat_ws("\x1f", name("lang"), name("source"))).withColumn("one", name("lang")).drop("lang", "source")


def _levels(named: DataFrame) -> DataFrame:
    """The statistics once for each ``cell`` a document is in: its language and source, its language, and all."""
    return named.select(F.explode(F.array("pair", "one", F.lit(ALL))).alias("cell"), *STATISTICS)


def _spread(rows: DataFrame) -> DataFrame:
    """Per cell: documents ``n``, and medians ``mid`` and scales ``unit`` of the statistics."""
    found = rows.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.percentile_approx(x, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 1000).alias(f"q_{x}") for x in STATISTICS])
    return materialize(found.select(
        "cell", "n", F.array(*[F.col(f"q_{x}")[1] for x in STATISTICS]).alias("mid"),
        F.array(*[F.greatest((F.col(f"q_{x}")[2] - F.col(f"q_{x}")[0]) / 1.349, F.lit(FLOORS[x])) for x in STATISTICS]).alias("unit")), "spread")


def _z(mid: Column, unit: Column) -> list[Column]:
    """The statistics less their cell's median, in units of its quartile range."""
    return [(F.col(x) - mid[i]) / unit[i] for i, x in enumerate(STATISTICS)]


def _scaled(rows: DataFrame, spread: DataFrame) -> DataFrame:
    """``cell`` and ``z0 ..``."""
    return lookup_join(rows, spread, "cell", "n").select(
        "cell", *[z.alias(f"z{i}") for i, z in enumerate(_z(F.col("mid"), F.col("unit")))])


def _starts() -> Column:
    """First distances of the three starts: squares, damped squares, the largest deviation."""
    z = [F.col(f"z{i}") for i in range(_P)]
    return F.array(
        sum((x * x for x in z), F.lit(0.0)),
        sum((F.tanh(x) * F.tanh(x) for x in z), F.lit(0.0)),
        F.greatest(*[F.abs(x) for x in z]),
    )


def _distance(center: Column, white: Column, z: list[Column] | None = None) -> Column:
    """Squared Mahalanobis distance of ``z``, by default ``z0 ..``."""
    total, at = F.lit(0.0), 0
    z = z or [F.col(f"z{i}") for i in range(_P)]
    for i in range(_P):
        row = F.lit(0.0)
        for j in range(i + 1):
            row = row + white[at] * (z[j] - center[j])
            at += 1
        total = total + row * row
    return total


def _whitening(sums: DataFrame) -> DataFrame:
    """``key, n, center, white`` (rows of the inverse Cholesky factor) and ``logdet`` from sums of products.

    The factor is written out entry by entry, each a column over entries before it.
    """
    step = sums.withColumns({f"m{i}": F.col(f"s{i}") / F.col("k") for i in range(_P)})
    step = step.withColumns({
        f"c{i}_{j}": (F.col(f"s{i}_{j}") / F.col("k") - F.col(f"m{i}") * F.col(f"m{j}")) * (1 - RIDGE)
        + F.lit(RIDGE if i == j else 0.0) for i in range(_P) for j in range(i + 1)})
    for j in range(_P):
        column = {i: F.col(f"c{i}_{j}") for i in range(j, _P)}
        for i in column:
            for k in range(j):
                column[i] = column[i] - F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}")
        step = step.withColumn(f"l{j}_{j}", F.sqrt(F.greatest(column[j], F.lit(1e-9))))
        step = step.withColumns({f"l{i}_{j}": column[i] / F.col(f"l{j}_{j}") for i in range(j + 1, _P)})
    for i in range(_P):
        row = {}
        for j in range(i + 1):
            value = F.lit(1.0 if i == j else 0.0)
            for k in range(j, i):
                value = value - F.col(f"l{i}_{k}") * F.col(f"w{k}_{j}")
            row[f"w{i}_{j}"] = value / F.col(f"l{i}_{i}")
        step = step.withColumns(row)
    return step.select(
        "key", "n", F.array(*[F.col(f"m{i}") for i in range(_P)]).alias("center"),
        F.array(*[F.col(f"w{i}_{j}") for i in range(_P) for j in range(i + 1)]).alias("white"),
        sum((F.log(F.col(f"l{i}_{i}")) for i in range(_P)), F.lit(0.0)).alias("logdet"))


def _c_step(rows: DataFrame, params: DataFrame | None, total: int) -> DataFrame:
    """New center and covariance of each ``key`` from the :data:`SHARE` of its rows that are closest.

    Without ``params`` the rows bring their first distance ``d``.
    """

    def measured(table: DataFrame | None) -> DataFrame:
        if table is None:
            return rows
        return lookup_join(rows, table, "key", "n", total=total).withColumn(
            "d", _distance(F.col("center"), F.col("white"))).drop("center", "white")

    cuts = measured(params and params.drop("logdet")).groupBy("key").agg(
        F.percentile_approx("d", F.lit(SHARE), 10000).alias("cut"), F.count(F.lit(1)).alias("n"))
    if params is None:
        cuts = materialize(cuts, "cuts")
        inner = lookup_join(rows, cuts, "key", "n", total=total)
    else:
        cuts = materialize(cuts.join(params.drop("logdet", "n"), "key"), "cuts")
        inner = measured(cuts)
    sums = inner.filter("d <= cut").groupBy("key").agg(
        F.count(F.lit(1)).alias("k"),
        *[F.sum(f"z{i}").alias(f"s{i}") for i in range(_P)],
        *[F.sum(F.col(f"z{i}") * F.col(f"z{j}")).alias(f"s{i}_{j}") for i in range(_P) for j in range(i + 1)])
    return materialize(_whitening(sums.join(cuts.select("key", "n"), "key")), "params")


def estimates(scaled: DataFrame) -> DataFrame:
    """MCD per cell: ``cell, n, center, white, typical`` (median distance). ``scaled`` has ``cell, z0 ..``."""
    rows = scaled.select("cell", *[f"z{i}" for i in range(_P)])
    total = rows.count()
    tried = rows.select(*rows.columns, F.posexplode(_starts()).alias("start", "d"))
    tried = tried.withColumn("key", F.concat_ws("\x1e", "cell", "start")).drop("cell", "start")
    params = _c_step(tried, None, 3 * total)
    params = _c_step(tried.drop("d"), params, 3 * total)
    best = params.groupBy(F.substring_index("key", "\x1e", 1).alias("key")).agg(
        F.min_by(F.struct("n", "center", "white", "logdet"), F.struct("logdet", "key")).alias("b"))
    params = materialize(best.select("key", "b.*"), "params")
    rows = rows.withColumnRenamed("cell", "key")
    for _ in range(C_STEPS - 2):
        params = _c_step(rows, params, total)
    typical = lookup_join(rows, params, "key", "n", total=total).groupBy("key").agg(
        F.percentile_approx(_distance(F.col("center"), F.col("white")), F.lit(0.5), 10000).alias("typical"))
    return materialize(params.drop("logdet").join(typical, "key").withColumnRenamed("key", "cell"), "estimates")


def chi_square(deviate: float) -> float:
    """Quantile of chi-square with as many degrees as there are statistics (Wilson and Hilferty's approximation)."""
    return _P * (1 - 2 / (9 * _P) + deviate * math.sqrt(2 / (9 * _P))) ** 3


def _blended(passed: DataFrame, models: DataFrame) -> DataFrame:
    """Per pair: its documents ``n``, and the models of the pair, of its language and of all, as structs."""
    of = lambda name, key: models.select(F.col("cell").alias(key), F.struct("n", "mid", "unit", "center", "white", "typical").alias(name))
    pairs = passed.groupBy("pair", "one").agg(F.count(F.lit(1)).alias("n")).withColumn("every", F.lit(ALL))
    return materialize(pairs.join(of("m_pair", "pair"), "pair").join(of("m_one", "one"), "one").join(of("m_all", "every"), "every").drop(
        "one", "every"), "blended")


def _blend() -> Column:
    """Distances of the three models; a model counts the more against the wider one, the more documents it has.

    Where a cell's median distance is above that of chi-square, its distances are scaled down: the closest documents
    understate the covariance.
    """
    def of(model: Column) -> Column:
        return _distance(model["center"], model["white"], _z(model["mid"], model["unit"])) * chi_square(0.0) / F.greatest(
            model["typical"], F.lit(chi_square(0.0)))

    weight = lambda model: model["n"] / (model["n"] + F.lit(HALF))
    one, pair = F.col("m_one"), F.col("m_pair")
    wide = weight(one) * of(one) + (1 - weight(one)) * of(F.col("m_all"))
    return weight(pair) * of(pair) + (1 - weight(pair)) * wide


def rate(
    docs: DataFrame, carry: list[str] | None = None, tail: float = TAIL, text: str = "text", lang: str = "lang", source: str = "source",
) -> DataFrame:
    """``row`` (a struct of the ``carry`` columns, all by default), the base counts, ``base_failed``, ``distance`` and ``kept``, per input row.

    ``distance`` is the squared Mahalanobis distance, a mean of those from the language and source, the language and all
    documents (:func:`_blend`), and null where the fixed limits reject. A null text counts as empty and is rejected by
    them. A null language or source is a value of its own. Equal rows get equal verdicts. An empty table gives no rows.
    """
    stats = materialize(base_statistics(docs, carry, text, lang, source), "statistics")
    passed = _named(stats.filter(~F.col("base_failed")))
    rows = _levels(passed)
    spread = _spread(rows)
    models = estimates(materialize(_scaled(rows, spread), "scaled")).join(spread.drop("n"), "cell")
    judged = lookup_join(passed, _blended(passed, materialize(models, "models")), "pair", "n").withColumn("distance", _blend())
    columns = ["row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return judged.select(*columns, "distance", (F.col("distance") <= chi_square(tail)).alias("kept")).unionByName(
        stats.filter("base_failed").select(*columns, F.lit(None).cast("double").alias("distance"), F.lit(False).alias("kept")))
