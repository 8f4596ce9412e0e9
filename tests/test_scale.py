"""What keeps disk, memory and time in proportion to the input."""

import random

import pyarrow.parquet as pq
from conftest import SF, item, sentences
from pyspark.sql import functions as F

from tidewell.functions import flat
from tidewell.llm import lexical_search
from tidewell.operators import index, linking, segments
from tidewell.plans import catalog, fixtures as fx


def test_postings_by_letter_hold_an_id_once_a_record(spark, monkeypatch):
    monkeypatch.setattr(index, "BLOCK_RECORDS", 30)
    monkeypatch.setattr(flat, "BATCH_ROWS", 20)
    stored, sink = [], catalog.sinks.sink
    monkeypatch.setattr(catalog.sinks, "sink", lambda df, path, **options: (stored.append(path), sink(df, path, **options)))
    catalog.QUERIES["index_by_letter"](spark, SF).collect()
    rows = spark.read.schema(f"{index.BLOCK}, letter string").parquet(stored[0])
    assert "stream_id" not in rows.columns
    records = rows.filter("records IS NOT NULL").select("block", F.posexplode("records").alias("place", "r")).select("block", "place", "r.*")
    assert records.count() == fx.timed_documents(spark, SF).filter("length(text) > 0").count() and records.select("block").distinct().count() > 1
    lists = rows.filter("records IS NULL").select("block", "term", F.explode(F.arrays_zip("places", "tf")).alias("p"))
    found = lists.select("block", "term", F.col("p.places").alias("place"), "p.tf").join(records, ["block", "place"])
    want = index.term_frequencies(fx.items(spark, SF))
    assert sorted(map(tuple, found.select(want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_stem_classes_shuffle_no_posting(spark, corpus):
    twice = item("a", taggers={"serif": sentences("Cats cat the running", "Runs")})
    records = [item("b", taggers={"serif": sentences("The runs")}), item("c", taggers={"serif": sentences("the I")}), item("e", taggers={})]
    for df in (corpus(twice, *records), corpus(twice, twice, *records), corpus(twice, {**twice, "doc_id": "z"})):
        want = index.vocab_conflate(index.term_frequencies(df))
        got = index.conflated_vocabulary(df)
        assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    plan = index.conflated_vocabulary(corpus(twice, *records))._jdf.queryExecution().executedPlan().toString()
    assert "stream_id" not in "".join(line for line in plan.splitlines() if "Exchange" in line)


def test_a_learned_score_shuffles_lists_of_best_candidates(spark, monkeypatch):
    monkeypatch.setattr(linking, "RUN_ROWS", 3)
    draw = random.Random(3)
    rows = [(f"{d}-x", "x", p, p + 1, f"s{p}", f"e{e}", round(draw.random(), 1), draw.choice([0.1, 0.2, None]))
            for d in range(4) for p in range(5) for e in range(draw.randrange(1, 4))]
    rows += [row for row in rows if row[0] == "1-x"]
    features = spark.createDataFrame(rows, "stream_id string, doc_id string, start int, end int, spot string, entity string, score double, commonness double")
    found = linking.by_score(features, lambda f: f, ["stream_id", "doc_id"])
    want = {}
    for key, _, start, end, spot, entity, score, commonness in rows:
        here = want.setdefault(key, {})
        here[start, end, spot] = max(here.get((start, end, spot), (-1.0, -1.0, "")), (score, -1.0 if commonness is None else commonness, entity))
    got = {r.stream_id: [tuple(a) for a in r.annotations] for r in found.collect()}
    assert got == {key: sorted((*m, best[2], best[0]) for m, best in here.items()) for key, here in want.items()}
    plan = found._jdf.queryExecution().executedPlan().toString()
    final = plan[plan.index("Initial Plan"):] if "Initial Plan" in plan else plan
    assert final.count("Exchange hashpartitioning") == 1


def test_choosing_by_each_method_finds_the_mentions_once(spark, monkeypatch):
    calls, found = [], catalog.spotting.without_overlaps
    monkeypatch.setattr(catalog.spotting, "without_overlaps", lambda docs: (calls.append(1), found(docs))[1])
    rows = catalog.QUERIES["link_choice"](spark, SF)
    assert len(calls) == 1 and {r.method for r in rows.select("method").distinct().collect()} == {"prior", "tagme", "wikiminer"}


def test_a_row_group_holds_few_shards(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lexical_search, "scratch_path", lambda session, name: str(tmp_path / name))
    rows = spark.range(0, 40, 1, 1).select(F.expr("transform(sequence(1, 250000), i -> xxhash64(id, i))").alias("docs"))
    lexical_search._written(rows, "shards")
    file = pq.ParquetFile(next((tmp_path / "shards").glob("*.parquet"))).metadata
    assert max(file.row_group(i).num_rows for i in range(file.num_row_groups)) < 20


def test_compacted_postings_hold_numbers(spark, corpus, tmp_path):
    path, out = str(tmp_path / "s"), str(tmp_path / "one")
    record = lambda stream, text: item("d" + stream, stream=stream, text=text, taggers={"serif": sentences(text)})
    segments.add_segment(corpus(record("1", "red"), record("2", "red car")), path, 0)
    segments.add_segment(corpus(record("1", "blue car")), path, 1)
    segments.compact(spark, path, out)
    stored = spark.read.parquet(f"{out}/postings")
    assert sorted(stored.columns) == ["doc_no", "letter", "positions", "term", "term_id", "tf"]
    ids = stored.join(spark.read.parquet(f"{out}/documents"), "doc_no")
    assert {(r.term, r.doc_id, r.tf) for r in ids.collect()} == {("blue", "d1", 2), ("car", "d1", 2), ("car", "d2", 2), ("red", "d2", 2)}
