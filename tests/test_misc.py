import datetime
import random
import time

from conftest import SF, item
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewell.functions import arrays, text
from tidewell.operators import blocks, corpus as ops, hooks, joins
from tidewell.plans.catalog import QUERIES
from tidewell.plans.oracle import ORACLE
from tidewell.streaming import counts


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.integers(0, 50), max_size=200), min_size=1, max_size=5))
def test_running_totals(spark, rows):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, v array<int>")
    got = {r.i: r.t for r in arrays.running_totals(df, "v", "t", block=8).collect()}
    for i, row in enumerate(rows):
        total, want = 0, []
        for x in row:
            total += x
            want.append(total)
        assert got[i] == want


def test_groups_of_sorted_arrays(spark):
    df = spark.createDataFrame([(1, [("a", 1), ("a", 2), ("b", 3)]), (2, [])], "i int, v array<struct<k:string,x:int>>")
    got = {r.i: [(g.k, [x.x for x in g["items"]]) for g in r.g] for r in arrays.group_sorted(df, "v", "k", "g").collect()}
    assert got == {1: [("a", [1, 2]), ("b", [3])], 2: []}


def test_lookup_join_equals_join(spark):
    pick = random.Random(1)
    facts = spark.createDataFrame([(i, "hot" if pick.random() < .5 else f"k{i % 9}") for i in range(200)], "i int, k string")
    lookup = spark.createDataFrame([("hot", 1), ("k1", 2), ("k1", 3)], "k string, v int")
    for how in ("inner", "left", "left_semi", "left_anti"):
        want = sorted(map(tuple, facts.join(lookup, "k", how).select("i", "k").collect()))
        assert sorted(map(tuple, joins.lookup_join(facts, lookup, "k", how).select("i", "k").collect())) == want


def test_records_without_text_or_url(corpus):
    df = corpus(item("a"), item("b", text=""), item("c", text=None), item("e", body=False), item("f", url=None))
    assert {r.doc_id for r in ops.doc_text(df).collect()} == {"a", "f"}
    assert {r.doc_id for r in ops.doc_url(df).collect()} == {"a", "b", "c"}
    assert {r.host for r in ops.doc_host(df).collect()} == {"h.example"}
    assert {r.docno for r in ops.doc_props(df).collect()} == {"a", "f"}


def test_days_and_hours_are_utc(corpus):
    df = corpus(item("a", ticks=1704067199.9), item("b", ticks=1704067200.0))
    assert {(r.day, r.docs) for r in ops.docs_per_day(df).collect()} == {(20231231, 1), (20240101, 1)}
    assert {r.doc_id: r.hour for r in ops.doc_chunk_hour(df).collect()} == {"a": 23, "b": 0}
    assert {r.doc_id: r.hour for r in ops.doc_chunk_hour(df, compat=True).collect()} == {"a": 17, "b": 17}


def test_file_stems(spark):
    df = spark.createDataFrame([("a.b.xz",), ("plain",), (".hidden",)], "n string")
    assert [r[0] for r in df.select(text.file_stem(F.col("n"))).collect()] == ["a", "plain", ".hidden"]


def page(spark, html, visible="all of it"):
    return spark.createDataFrame([("s", "d", (visible, html))], "stream_id string, doc_id string, body struct<clean_visible:string,clean_html:string>")


def test_blocks_and_article(spark):
    prose = " ".join(["word"] * 20)
    df = page(spark, f"<html><script>var p='</p>'</script><ul><li><a href='/x'>menu entry</a></li></ul><p>{prose} &amp; <b>more</b></p><p></p></html>")
    assert [(r.block_no, r.text) for r in blocks.html_blocks(df).collect()] == [(0, "menu entry"), (1, prose + " & more")]
    assert [(r.words, r.linked_words) for r in blocks.block_features(df).collect()] == [(2, 2), (22, 0)]
    assert [r.is_content for r in blocks.block_classify(df).collect()] == [False, False]
    longer = " ".join(["word"] * 41)
    df = page(spark, f"<ul><li><a href='/x'>menu entry</a></li></ul><p>{longer}</p>")
    assert blocks.article_text(df).first().article == longer


def test_page_without_article_gives_visible_text(spark):
    assert blocks.article_or_visible(page(spark, "<a href='/x'>menu</a>")).first().text == "all of it"
    assert blocks.article_or_visible(page(spark, "")).first().text == "all of it"
    assert blocks.article_or_visible(page(spark, "<p>x</p>", visible="")).count() == 0
    assert blocks.article_text(page(spark, "")).first().article == ""


def test_annotate_hook_loads_once_per_task(spark):
    df = spark.createDataFrame([("a", "x yy"), ("b", None), ("c", "z")], "doc_id string, text string").coalesce(1)

    def load():
        return iter(range(100))  # a second load would start again from 0

    out = hooks.annotate(
        df, "doc_id", ["text"], "key string, values array<string>", load=load,
        contents=lambda t: [t] if t else None,
        annotate_text=lambda model, t: [f"{w}{next(model)}" for w in t.split()],
        keep=lambda values: len(values) > 0)
    assert {r.key: list(r["values"]) for r in out.collect()} == {"a": ["x0", "yy1"], "c": ["z2"]}


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def _late_stream(spark, folder, batches):
    for n, rows in enumerate(batches):
        frame = spark.createDataFrame(rows, "stream_id string, ts timestamp")
        frame.coalesce(1).write.mode("append").parquet(str(folder))
        time.sleep(0.05)
    return spark.readStream.schema("stream_id string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(str(folder))


def test_late_rows_are_counted_and_kept(spark, tmp_path):
    day = lambda d: datetime.datetime(2024, 1, d)
    batches = [[("a", day(1)), ("b", day(2))], [("c", day(9)), ("d", day(9)), ("a", day(1))], [("e", day(1)), ("f", day(1)), ("d", day(9))]]
    stream = _late_stream(spark, tmp_path / "in", batches)
    got = counts.docs_per_day(stream, str(tmp_path / "days")).collect()
    assert {r.day: r.docs for r in got} == {20240101: 4, 20240102: 1, 20240109: 3}
    got = counts.first_seen(stream, str(tmp_path / "first")).collect()
    assert sorted(r.stream_id for r in got) == list("abcdef")


def test_micro_batches_hold_only_what_is_counted(spark, tmp_path, monkeypatch):
    """A micro-batch has all its columns worked out and, in a join, shuffled; texts must not be among them."""
    seen, plain = [], counts._batches
    monkeypatch.setattr(counts, "_batches", lambda stream, *more: seen.append(stream.columns) or plain(stream, *more))
    QUERIES["stream_docs_per_day"](spark, SF)
    QUERIES["stream_entity_day"](spark, SF)
    assert seen == [["day"], ["stream_id", "doc_id", "body", "day"]]


def test_an_empty_stream_gives_an_empty_table(spark, tmp_path):
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema("stream_id string, ts timestamp").parquet(str(tmp_path / "in"))
    assert counts.docs_per_day(stream, str(tmp_path / "days")).count() == 0
    assert counts.first_seen(stream, str(tmp_path / "first")).count() == 0


def test_streams_give_the_batch_results(spark):
    batch = sorted(map(tuple, QUERIES["docs_per_day"](spark, SF).collect()))
    assert sorted(map(tuple, QUERIES["stream_docs_per_day"](spark, SF).collect())) == batch
    first = QUERIES["stream_dedup"](spark, SF)
    assert first.count() == first.distinct().count() == QUERIES["has_text"](spark, SF).count()
