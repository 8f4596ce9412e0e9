"""URL filters: editors' rules, and association rules mined from the URLs those rules decide.

Editors' rules name a host (with all its subdomains) and the start of a path; the longest that fits decides.
URLs they decide are labelled examples: Spark's FP-growth mines token combinations that go with a label, rules
below a support or confidence are pruned, and the others judge the URLs that no editor's rule fits. They are
matched through an inverted index: a mined rule is filed under its rarest token only.
DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.session import materialize

#: Action, host and path start of the editors' rules: a short list, kept in the plan.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
SUPPORT = 0.005
CONFIDENCE = 0.9
LABEL = "verdict="
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (lower case) and path of a URL; both empty for a null or one without ``://``."""
    text = F.coalesce(url, F.lit(""))
    start = F.locate("://", text)
    rest = F.when(start > 0, F.substring(text, start + 3, F.length(text))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def editors_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as host and path start, and its action; null where none fits."""
    name = action = None
    for act, domain, start in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(start)
        name = F.when(fits, domain + start) if name is None else name.when(fits, domain + start)
        action = F.when(fits, act) if action is None else action.when(fits, act)
    none = F.lit(None).cast("string")
    return (none, none) if name is None else (name, action)


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens: scheme, labels of the host, parts of the path (numbers as one token) and its ending, query keys."""
    text = F.coalesce(url, F.lit(""))
    scheme = F.translate(F.substring_index(text, "://", 1), UPPER, LOWER)
    query = F.regexp_extract(text, r"^[^?#]*\?([^#]*)", 1)
    part = lambda kind, items: F.transform(F.filter(items, lambda x: x != ""), lambda x: F.concat(F.lit(kind), x))
    stems = F.transform(F.split(path, "/"), lambda p: F.regexp_replace(F.regexp_replace(p, r"\.[A-Za-z]+$", ""), "^[0-9]+$", "0"))
    return F.when(F.instr(text, "://") > 0, F.array_distinct(F.concat(
        F.array(F.concat(F.lit("scheme:"), scheme)),
        part("host:", F.split(host, r"\.")),
        part("path:", stems),
        part("ending:", F.array(F.regexp_extract(path, r"\.([A-Za-z]+)$", 1))),
        part("query:", F.transform(F.split(query, "&"), lambda pair: F.substring_index(pair, "=", 1))),
    ))).otherwise(F.array().cast("array<string>"))


def mine(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """Association rules ``tokens, verdict, confidence, support`` from ``(tokens, verdict)`` rows.

    A rule's support counts rows with all its tokens and the verdict, as a share of all rows. Rules may have any number
    of tokens; :func:`prune` drops those that never decide.
    """
    baskets = labelled.filter(F.size("tokens") > 0).select(
        F.concat("tokens", F.array(F.concat(F.lit(LABEL), "verdict"))).alias("items"))
    found = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(baskets).associationRules
    named = F.get("consequent", 0)
    return found.filter(
        named.startswith(LABEL) & ~F.exists("antecedent", lambda t: t.startswith(LABEL))
    ).select(
        F.array_sort("antecedent").alias("tokens"), F.substring(named, len(LABEL) + 1, 100).alias("verdict"),
        "confidence", "support")


def prune(rules: DataFrame) -> DataFrame:
    """``rules`` less those that never decide: one token fewer gives the same verdict with at least the confidence.

    The shorter rule fits wherever the longer does, with no less support, so it (or one that replaces it in turn)
    comes first or says the same.
    """
    name = lambda tokens: F.concat_ws("\x1f", tokens)
    shorter = rules.select(name("tokens").alias("short"), "verdict", F.col("confidence").alias("surer"))
    keyed = rules.withColumn("rule", name("tokens"))
    implied = keyed.filter(F.size("tokens") > 1).select(
        "rule", "verdict", "confidence", F.explode(F.transform("tokens", lambda t: name(F.array_remove("tokens", t)))).alias("short"),
    ).join(shorter, ["short", "verdict"]).filter("surer >= confidence").select("rule", "verdict").distinct()
    return keyed.join(implied, ["rule", "verdict"], "left_anti").drop("rule")


def index_rules(rules: DataFrame, labelled: DataFrame) -> DataFrame:
    """Rules with the token they are filed under: the one that fewest labelled rows have."""
    ranked = rules.withColumn("rule_id", F.concat_ws("\x1f", "tokens")).select(
        "*", F.explode("tokens").alias("token"))
    counts = labelled.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("rows"))
    rarest = ranked.join(counts, "token").groupBy("rule_id", "verdict").agg(
        F.min_by("token", F.struct("rows", "token")).alias("token"), F.first("tokens").alias("rule_tokens"),
        F.first("confidence").alias("confidence"), F.first("support").alias("support"))
    return rarest


def judge(
    pages: DataFrame, url: str = "url", rules: Sequence[tuple[str, str, str]] = RULES, support: float = SUPPORT,
    confidence: float = CONFIDENCE, default: str = "allow",
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` (``allow`` or ``block``), per input row.

    Where no editor's rule fits, the mined rule of highest confidence decides, then support, then the first
    tokens in order; ``default`` where none matches, as for null and odd URLs and where nothing is labelled.
    Input columns of those names are replaced. An empty table gives no rows.
    """
    spark = pages.sparkSession
    row = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    host, path = host_and_path(F.col(url))
    read = pages.select(F.struct(*row).alias("row"), F.col(url).alias("_url"), host.alias("host"), path.alias("path"))
    name, action = editors_rule(F.col("host"), F.col("path"), rules)
    read = read.select(
        "row", "host", "path", name.alias("rule"), action.alias("verdict"),
        url_tokens(F.col("_url"), F.col("host"), F.col("path")).alias("tokens"))
    read = materialize(read, "urls")
    labelled = read.filter("verdict is not null").select("tokens", "verdict")
    done = read.filter("verdict is not null").drop("tokens")
    if labelled.filter(F.size("tokens") > 0).isEmpty():
        mined = spark.createDataFrame(
            [], "rule_id string, verdict string, token string, rule_tokens array<string>, confidence double, support double")
    else:
        mined = materialize(index_rules(prune(materialize(mine(labelled, support, confidence), "mined")), labelled), "rules")
    # No hint: Spark broadcasts the rules by their measured bytes, or splits the partitions of frequent tokens.
    filed = mined.withColumnRenamed("verdict", "said")
    rest = read.filter("verdict is null").withColumn("row_key", F.monotonically_increasing_id())
    hits = rest.select("*", F.explode_outer("tokens").alias("token")).join(filed, "token", "left")
    fits = F.col("said").isNotNull() & F.forall("rule_tokens", lambda t: F.array_contains("tokens", t))
    best = hits.groupBy("row_key").agg(
        F.first("row").alias("row"), F.first("host").alias("host"), F.first("path").alias("path"),
        F.min_by("said", F.when(fits, F.struct(-F.col("confidence"), -F.col("support"), "rule_id", "said"))).alias("verdict"))
    judged = best.select(
        "row", "host", "path", F.lit(None).cast("string").alias("rule"), F.coalesce("verdict", F.lit(default)).alias("verdict"))
    return done.unionByName(judged).select("row.*", "host", "path", "rule", "verdict")
