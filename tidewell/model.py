"""Record layout of the corpus and the fixed values the results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

TOKEN = T.StructType([
    T.StructField("token", T.StringType()),
    T.StructField("lemma", T.StringType()),
    T.StructField("entity_type", T.StringType()),
])
SENTENCE = T.StructType([T.StructField("tokens", T.ArrayType(TOKEN))])
SENTENCES = T.MapType(T.StringType(), T.ArrayType(SENTENCE))

BODY = T.StructType([
    T.StructField("clean_visible", T.StringType()),
    T.StructField("clean_html", T.StringType()),
    T.StructField("sentences", SENTENCES),
])
SECTION = T.StructType([
    T.StructField("clean_visible", T.StringType()),
    T.StructField("sentences", SENTENCES),
])

STREAM_ITEM = T.StructType([
    T.StructField("stream_id", T.StringType()),
    T.StructField("doc_id", T.StringType()),
    T.StructField("abs_url", T.BinaryType()),
    T.StructField("schost", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("stream_time", T.StructType([
        T.StructField("epoch_ticks", T.DoubleType()),
        T.StructField("zulu_timestamp", T.StringType()),
    ])),
    T.StructField("body", BODY),
    T.StructField("other_content", T.MapType(T.StringType(), SECTION)),
    T.StructField("src_file", T.StringType()),
])

# --- fixed values -----------------------------------------------------------
# Tagger keys of the sentence maps, in the order in which they are read.
TAGGERS = ("serif", "lingpipecounter")

# Entity types that a run in mid-sentence has to have to count as a mention.
MENTION_TYPES = ("ORG", "LOC", "PER", "VEH", "TIME")

# Type codes of mentions, and of mentions found by a second tagger.
TYPE_CODES = {"PER": 1, "LOC": 2, "ORG": 3, "VEH": 4}
RETAGGED_CODES = {"LOCATION": 1, "ORGANIZATION": 2, "PERSON": 3}

# Mention text (with its trailing space) has to be shorter than this.
MAX_MENTION = 50
# Bounds for re-tagged mentions, type digit included; both exclusive.
RETAGGED_LENGTH = (3, 30)

# Index fields of a term; entity fields are kept per tagger.
FIELDS = (
    "Lemma", "title", "body",
    "Serif_PER", "Serif_ORG", "Serif_LOC", "Serif_MISC",
    "Lingpipe_PER", "Lingpipe_ORG", "Lingpipe_LOC", "Lingpipe_MISC",
)

# Meta columns of the index and their greatest lengths.
META_LENGTHS = {"stream_id": 320, "docno": 200, "url": 500, "type": 140, "time": 50}

# Linking: spots need this link probability, entities this commonness.
MIN_LINK_PROBABILITY = 0.02
MIN_COMMONNESS = 0.005
# Voting window in mentions, and how far below the best vote a candidate may lie.
VOTE_WINDOW = 30
VOTE_EPSILON = 0.7
# Annotations kept for a document, and the score they need afterwards.
TOP_ANNOTATIONS = 50
MIN_CONFIDENCE = 0.1
# Link put around a mention in rendered text.
LINK_OPEN = "<a href=\"#\" onmouseover='manage({})' >"
LINK_CLOSE = "</a>"

# Query expansion: documents read and terms added.
EXPANSION_DOCS = 3
EXPANSION_TERMS = 10
