import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewell.model import STREAM_ITEM  # noqa: E402
from tidewell.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[4]", "tests", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__driver__memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def sentences(*sents):
    """Sentences from ``token/TYPE`` words; a word without a slash has no type."""
    out = []
    for sent in sents:
        tokens = []
        for word in sent.split():
            token, _, kind = word.partition("/")
            tokens.append({"token": token, "lemma": token.lower(), "entity_type": kind or None})
        out.append({"tokens": tokens})
    return out


def item(doc="d", stream=None, text="x", taggers=None, title=None, url=b"http://h.example/1", body=True, ticks=0.0):
    """One corpus record."""
    return {
        "stream_id": stream or f"0-{doc}", "doc_id": doc, "abs_url": bytearray(url) if url else None,
        "schost": "h.example", "source": "news",
        "stream_time": {"epoch_ticks": ticks, "zulu_timestamp": "1970-01-01T00:00:00Z"},
        "body": {"clean_visible": text, "clean_html": None, "sentences": taggers} if body else None,
        "other_content": {"title": title} if title else {},
        "src_file": "chunk-1.parquet",
    }


@pytest.fixture
def corpus(spark):
    return lambda *records: spark.createDataFrame(list(records), STREAM_ITEM)
