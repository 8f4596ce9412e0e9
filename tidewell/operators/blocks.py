"""Text blocks of web pages and their sorting into content and boilerplate.

A page's blocks are an array of its row: a block's neighbours are read from the same array, so a
page is worked out without a shuffle.
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.arrays import let, unnest
from tidewell.operators.corpus import has_text

# HTML's tags that end a block.
BLOCK_TAGS = (
    "address", "article", "aside", "blockquote", "body", "br", "caption", "center", "dd", "details", "dialog", "dir", "div",
    "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header",
    "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section", "select", "summary", "table",
    "tbody", "td", "tfoot", "th", "thead", "title", "tr", "ul",
)
REFERENCE = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,7});"

UNSEEN = r"(?is)<(script|style)[^>]*>.*?</(script|style)>|<!--.*?-->"
BLOCK_BREAK = rf"(?i)</?({'|'.join(BLOCK_TAGS)})(\s[^>]*)?/?>"
ANCHOR_TEXT = r"(?is)<a\s[^>]*>(.*?)</a>"


def _character(reference: Column) -> Column:
    """What a character reference stands for; itself where it stands for nothing. Fixed spaces are plain ones."""
    names = {name: chr(code) for name, code in name2codepoint.items()} | {"nbsp": " ", "apos": "'"}
    named = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    body = F.substring(reference, F.lit(2), F.length(reference) - 2)
    number = F.when(body.startswith("#x") | body.startswith("#X"), F.conv(F.substring(body, 3, 6), 16, 10)).otherwise(
        F.substring(body, 2, 7)).cast("int")
    usable = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    return F.coalesce(
        F.when(body.startswith("#"), F.when(number == 160, F.lit(" ")).when(usable, char)).otherwise(F.try_element_at(named, body)),
        reference)


def decode_references(text: Column) -> Column:
    """Text with its character references decoded, once: ``&amp;lt;`` becomes ``&lt;``."""
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(0)))
    others = F.array_remove(found, "&amp;")
    decoded = F.aggregate(others, text, lambda out, r: F.replace(out, r, _character(r)))
    return F.when(F.instr(text, "&") == 0, text).otherwise(F.replace(decoded, F.lit("&amp;"), F.lit("&")))


def plain_text(markup: Column) -> Column:
    """Text of a piece of markup: no tags, references decoded, single spaces."""
    text = decode_references(F.regexp_replace(markup, "<[^>]*>", " "))
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def _word_count(text: Column) -> Column:
    """Number of words of a text in single spaces."""
    return F.when(text == "", 0).otherwise(F.size(F.split(text, " ")))


def block_array(html: Column) -> Column:
    """Non-empty blocks of a page as ``struct(text, words, linked)``."""
    pieces = F.split(F.regexp_replace(html, UNSEEN, " "), BLOCK_BREAK)
    return F.transform(
        F.filter(
            F.transform(pieces, lambda p: F.struct(p.alias("markup"), plain_text(p).alias("text"))),
            lambda b: b["text"] != ""),
        lambda b: F.struct(
            b["text"].alias("text"),
            _word_count(b["text"]).alias("words"),
            let(plain_text(F.array_join(F.regexp_extract_all(b["markup"], F.lit(ANCHOR_TEXT), F.lit(1)), " ")),
                _word_count).alias("linked"),
        ))


def _density(block: Column) -> Column:
    return F.when(block["words"] > 0, block["linked"] / block["words"]).otherwise(F.lit(0.0))


def is_content(previous: Column, current: Column, following: Column) -> Column:
    """Word-count and link-density tree over a block and its neighbours; a missing one is empty."""
    p_words, n_words = F.coalesce(previous["words"], F.lit(0)), F.coalesce(following["words"], F.lit(0))
    p_density = F.coalesce(_density(previous), F.lit(0.0))
    after_text = (current["words"] > 16) | (n_words > 15) | (p_words > 4)
    after_links = (current["words"] > 40) | (n_words > 17)
    return (_density(current) <= 0.333333) & F.when(p_density <= 0.555556, after_text).otherwise(after_links)


def with_blocks(pages: DataFrame, html: str = "body.clean_html") -> DataFrame:
    """Add ``blocks``, each with its number, features and decision."""
    return pages.withColumn("_found", block_array(F.col(html))).withColumn("blocks", F.transform(
        "_found",
        lambda b, i: F.struct(
            i.alias("block_no"), b["text"].alias("text"), b["words"].alias("words"), b["linked"].alias("linked_words"),
            _density(b).alias("link_density"),
            is_content(F.get(F.col("_found"), i - 1), b, F.get(F.col("_found"), i + 1)).alias("is_content"),
        ))).drop("_found")


def html_blocks(pages: DataFrame) -> DataFrame:
    return unnest(with_blocks(pages), ["doc_id"], "blocks", "block_no", "text")


def block_features(pages: DataFrame) -> DataFrame:
    return unnest(with_blocks(pages), ["doc_id"], "blocks", "block_no", "words", "linked_words", "link_density")


def block_classify(pages: DataFrame) -> DataFrame:
    return unnest(with_blocks(pages), ["doc_id"], "blocks", "block_no", "is_content", "words")


def _article(blocks: str = "blocks") -> Column:
    return F.array_join(F.transform(F.filter(blocks, lambda b: b["is_content"]), lambda b: b["text"]), "\n")


def article_text(pages: DataFrame) -> DataFrame:
    """``(stream_id, doc_id, article)``; empty when a page has no content block."""
    return with_blocks(pages).select("stream_id", "doc_id", _article().alias("article"))


def article_or_visible(pages: DataFrame) -> DataFrame:
    """Article text of records with visible text, or all the visible text when there is no article."""
    return with_blocks(pages.filter(has_text())).select("stream_id", F.coalesce(
        F.nullif(_article(), F.lit("")), F.col("body.clean_visible")).alias("text"))
