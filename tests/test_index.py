from conftest import SF, item, sentences

import pytest
from pyspark.sql import functions as F

from tidewell.operators import index, search, segments
from tidewell.plans import fixtures as fx


def stream(df):
    return [(r.term, r.fields) for r in index.term_stream(df).orderBy("pos", "surface").collect()]


def test_lemma_needs_two_letters_or_i(corpus):
    df = corpus(item(taggers={"serif": sentences("I a Go/PER")}))
    assert stream(df) == [("i", "Lemma"), ("I", "body"), ("a", "body"), ("go", "Lemma"), ("Go", "body,Serif_PER")]


def test_section_field_goes_to_the_first_tagger_there(corpus):
    both = corpus(item(taggers={"serif": sentences("b"), "lingpipecounter": sentences("b/ORG")}))
    assert stream(both) == [("b", "body"), ("b", "Lingpipe_ORG")]
    second = corpus(item(taggers={"lingpipecounter": sentences("b/ORG")}))
    assert stream(second) == [("b", "body,Lingpipe_ORG")]


def test_title_comes_first_and_may_be_missing_or_empty(corpus):
    title = {"clean_visible": "t", "sentences": {"serif": sentences("t")}}
    df = corpus(item(taggers={"serif": sentences("b")}, title=title))
    assert stream(df) == [("t", "title"), ("b", "body")]
    empty = corpus(item(taggers={"serif": sentences("b")}, title={"clean_visible": "", "sentences": {"serif": sentences("t")}}))
    assert stream(empty) == [("b", "body")]


def test_no_tagger_at_all_gives_an_empty_document(corpus):
    df = corpus(item("a", taggers={}), item("b", taggers=None), item("c", text="", taggers={"serif": sentences("b")}))
    assert stream(df) == []
    assert {(r.doc_id, r.doc_len) for r in index.doc_lengths(df).collect()} == {("a", 0), ("b", 0)}


def test_frequencies_add_up_to_lengths(spark):
    items = fx.items(spark, SF)
    total = index.inverted_index(items).agg(
        F.sum("tf").alias("tf"), F.sum(F.size("positions")).alias("places")).first()
    tokens = index.doc_lengths(items).agg(F.sum("doc_len")).first()[0]
    assert total.tf == total.places == tokens


def test_term_ids_are_dense_and_in_order(spark):
    rows = index.lexicon(index.term_frequencies(fx.items(spark, SF))).orderBy("term_id").collect()
    assert [r.term_id for r in rows] == list(range(len(rows)))
    assert [r.term for r in rows] == sorted(r.term for r in rows)


def test_merged_shards_equal_the_whole(spark):
    postings = index.term_frequencies(fx.items(spark, SF)).persist()
    shards = index.by_shard(postings, 3)
    parts = [index.vocabulary(shards.filter(F.col("shard") == n)) for n in range(4)]  # the last one is empty
    merged = {tuple(r) for r in index.merge_vocabularies(*parts).select("term", "df", "cf", "term_id").collect()}
    assert merged == {tuple(r) for r in index.lexicon(postings).select("term", "df", "cf", "term_id").collect()}
    postings.unpersist()


def test_index_is_written_once(spark, corpus, tmp_path):
    df = corpus(item(taggers={"serif": sentences("alpha beta Alpha")}))
    path = str(tmp_path / "index")
    index.write_index(df, path, partitions=2)
    lexicon = spark.read.parquet(path + "/lexicon")
    # "alpha" is the lemma of two tokens and the surface form of one.
    assert {(r.term, r.letter, r.cf) for r in lexicon.collect()} == {("alpha", "a", 3), ("beta", "b", 2), ("Alpha", "_", 1)}
    with pytest.raises(Exception, match="(?i)exist"):
        index.write_index(df, path, partitions=2)
    index.write_index(df, path, partitions=2, overwrite=True)


def test_conflation_rules(spark):
    df = spark.createDataFrame([(w,) for w in ("classes", "ponies", "cats", "class", "hopping", "sing", "agreed", "happy", "sky")], "w string")
    got = {r.w: r.s for r in df.select("w", index.stem(F.col("w")).alias("s")).collect()}
    assert got == {"classes": "class", "ponies": "poni", "cats": "cat", "class": "class", "hopping": "hopp", "sing": "sing",
                   "agreed": "agre", "happy": "happi", "sky": "sky"}


def test_rank_range_and_phrases(spark, corpus):
    df = corpus(*[item(d, taggers={"serif": sentences(t)}) for d, t in (
        ("a", "red car"), ("b", "car red"), ("c", "red blue car"), ("e", "green"))])
    topics = spark.createDataFrame([(1, "red car")], "number int, title string")
    terms = search.topic_terms(topics)
    lengths = index.doc_lengths(df)
    postings = search.matching(index.inverted_index(df, fields=()), terms)
    scored = search.scores(postings, search.query_weights(terms), lengths)
    assert [r.doc_id for r in search.ranked(scored).orderBy("rank").collect()] == ["a", "b", "c"]
    assert [(r.rank, r.doc_id) for r in search.ranked(scored, start=1, end=1).collect()] == [(1, "b")]
    pairs = search.adjacent_pairs(terms)
    found = search.pair_postings(postings, pairs).collect()
    assert [(r.doc_id, r.term) for r in found] == [("a", "red car")]


def test_stopword_file(spark, tmp_path):
    (tmp_path / "stop.txt").write_text("the\n of \n\n")
    terms = spark.createDataFrame([("d", "the", 3), ("d", "The", 1), ("d", "car", 2)], "doc_id string, term string, tf int")
    left = index.remove_stopwords(terms, index.read_stopwords(spark, str(tmp_path / "stop.txt")))
    assert {r.term for r in left.collect()} == {"The", "car"}


def test_a_stored_index_is_read_back(spark, corpus, tmp_path):
    df = corpus(item("a", taggers={"serif": sentences("red car", "red")}), item("b", taggers={"serif": sentences("blue")}))
    path = str(tmp_path / "i")
    index.write_index(df, path)
    stored = index.read_index(spark, path)
    want = {(r.term, r.doc_id, r.tf, r.doc_len) for r in index.term_frequencies(df).collect()}
    assert {(r.term, r.doc_id, r.tf, r.doc_len) for r in stored.frequencies().collect()} == want
    assert {(r.term, r.doc_id, r.tf, r.doc_len) for r in stored.terms_of(df.filter("doc_id = 'a'")).collect()} == {w for w in want if w[1] == "a"}
    assert {(r.doc_id, r.doc_len) for r in stored.lengths.collect()} == {(r.doc_id, r.doc_len) for r in index.doc_lengths(df).collect()}


def test_segments_hold_the_newest_delivery(spark, corpus, tmp_path):
    path, out = str(tmp_path / "s"), str(tmp_path / "one")
    record = lambda stream, text: item("d", stream=stream, text=text, taggers={"serif": sentences(text)})
    first, second = corpus(record("1", "red"), record("2", "red car")), corpus(record("1", "blue car"), record("3", "car"))
    segments.add_segment(first, path, 0)
    segments.add_segment(second, path, 1)
    segments.add_segment(second.limit(0), path, 2)
    with pytest.raises(Exception, match="(?i)exist"):
        segments.add_segment(first, path, 1)
    whole = corpus(record("1", "blue car"), record("2", "red car"), record("3", "car"))
    want = {(r.term, r.stream_id, r.tf, tuple(r.positions)) for r in index.inverted_index(whole, fields=()).collect()}
    assert {(r.term, r.stream_id, r.tf, tuple(r.positions)) for r in segments.read_postings(spark, path).collect()} == want
    assert {(r.stream_id, r.segment) for r in segments.read_documents(spark, path).collect()} == {("1", 1), ("2", 0), ("3", 1)}
    # A segment that broke off before its documents were written does not count.
    spark.createDataFrame([("x", "9", "d", 1, [0])], "term string, stream_id string, doc_id string, tf int, positions array<int>").write.parquet(
        f"{path}/postings/segment=7/letter=x")
    segments.compact(spark, path, out)
    lexicon = {r.term: (r.term_id, r.df, r.cf) for r in spark.read.parquet(f"{out}/lexicon").collect()}
    assert lexicon == {"blue": (0, 1, 2), "car": (1, 3, 6), "red": (2, 1, 2)}
    assert {(r.stream_id, r.doc_no) for r in spark.read.parquet(f"{out}/documents").collect()} == {("1", 0), ("2", 1), ("3", 2)}
    got = {(r.term_id, r.doc_no, r.tf) for r in spark.read.parquet(f"{out}/postings").collect()}
    assert got == {(0, 0, 2), (1, 0, 2), (1, 1, 2), (1, 2, 2), (2, 1, 2)}


def test_pipeline_merges_forms(spark, corpus):
    df = corpus(item("a", taggers={"serif": sentences("Cats cat the running")}), item("b", taggers={"serif": sentences("The runs")}))
    postings = index.inverted_index(df, fields=())
    stop = spark.createDataFrame([("the",)], "term string")
    merged = index.conflated(postings, index.term_pipeline(postings.select("term"), stop))
    got = {(r.term, r.doc_id): (r.tf, r.positions) for r in merged.collect()}
    assert got == {("cat", "a"): (4, [0, 0, 1, 1]), ("run", "a"): (2, [3, 3]), ("run", "b"): (2, [1, 1])}
    assert {(r.doc_id, r.doc_len) for r in index.conflated_lengths(index.doc_lengths(df), merged).collect()} == {("a", 6), ("b", 2)}
    classes = {r.stem: (r.forms, r.df, r.cf) for r in index.vocab_conflate(index.term_frequencies(df)).collect()}
    assert classes["run"] == (2, 2, 4) and classes["cat"] == (3, 1, 4) and classes["the"] == (2, 2, 4)


def test_pipeline_in_the_row_equals_the_merged_lists(spark, corpus):
    twice = item("a", taggers={"serif": sentences("Cats cat the running", "Runs"), "lingpipecounter": sentences("RUNNING i")})
    df = corpus(twice, twice, item("b", taggers={"serif": sentences("The runs")}), item("c", taggers={"serif": sentences("the")}))
    stop = spark.createDataFrame([("the",), (None,)], "term string")
    found = index.conflated_groups(df, stop)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    records = found.persist()
    got = index.conflated_postings(records)
    postings = index.inverted_index(df, fields=())
    want = index.conflated(postings, index.term_pipeline(postings.select("term"), stop))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    lengths = index.conflated_lengths(records, records.select("stream_id", F.col("doc_len").alias("tf")))
    assert sorted(map(tuple, lengths.collect())) == sorted(map(tuple, index.conflated_lengths(index.doc_lengths(df), want).collect()))
    assert {r.doc_id for r in lengths.collect()} == {"a", "b", "c"}
    records.unpersist()


def test_topic_file(spark, tmp_path):
    (tmp_path / "topics").write_text(
        "<top>\n<num> Number: 1\n<title> Topic: Red  CAR,\n parks\n<desc> Description:\nnot this\n<narr> nor this\n</top>\n"
        "<top><num>2</num><title>one</title></top>\n")
    topics = search.read_topics(spark, str(tmp_path / "topics"))
    assert {(r.number, r.title) for r in topics.collect()} == {("1", "Red CAR, parks"), ("2", "one")}
    terms = search.topic_terms(topics, spark.createDataFrame([("parks",)], "term string"))
    assert {(r.number, r.place, r.term) for r in terms.collect()} == {("1", 0, "red"), ("1", 1, "car"), ("2", 0, "one")}


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_words_are_found_once_for_all_passes(spark):
    for rows in (index.term_stream(fx.items(spark, SF)), index.inverted_index(fx.items(spark, SF)), index.term_frequencies(fx.items(spark, SF))):
        plan = _plan(rows)
        # Once in the title, once in the body; the terms are not sorted or grouped by expressions.
        assert plan.count("[^\\pL]+") == 2
        assert "sort_array" not in plan


def test_terms_without_lemma_title_or_tokens(corpus):
    tagged = sentences("Ab/PER i x")
    tagged[0]["tokens"][2]["lemma"] = None
    df = corpus(
        item("a", taggers={"serif": tagged}), item("b", taggers={"lingpipecounter": sentences("q")}), item("c", taggers={}),
        item("d", taggers=None), item("e", text="", taggers={"serif": sentences("no")}))
    found = {(r.doc_id, r.term): (r.tf, r.tf_lemma, r.tf_body, r.tf_serif_per, r.positions) for r in index.inverted_index(df).collect()}
    assert found == {
        ("a", "Ab"): (1, 0, 1, 1, [0]), ("a", "ab"): (1, 1, 0, 0, [0]), ("a", "i"): (2, 1, 1, 0, [1, 1]),
        ("a", "x"): (1, 0, 1, 0, [2]), ("b", "q"): (1, 0, 1, 0, [0])}
    lengths = {r.doc_id: r.doc_len for r in index.doc_lengths(df).collect()}
    assert lengths == {"a": 5, "b": 1, "c": 0, "d": 0}


def test_index_is_written_where_its_postings_arise(spark, tmp_path):
    path = str(tmp_path / "index")
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    index.write_index(fx.items(spark, SF).repartition(3), path)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    stored = index.read_index(spark, path).postings
    want = {(r.letter, r.term, r.stream_id, r.tf) for r in index.by_letter(index.term_frequencies(fx.items(spark, SF))).collect()}
    assert {(r.letter, r.term, r.stream_id, r.tf) for r in stored.collect()} == want
    # A record's postings have stayed in one task: each task has written one file a letter.
    files = stored.select("stream_id", F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).alias("task")).distinct()
    assert files.groupBy("stream_id").count().filter("count > 1").isEmpty()


def test_scores_deal_postings_once_by_record(spark):
    df = fx.items(spark, SF)
    terms = search.topic_terms(spark.createDataFrame([("1", "the house"), ("2", "the water")], "number string, title string"))
    postings = search.matching(index.inverted_index(df, fields=()), terms)
    scored = search.scores(postings, search.query_weights(terms), index.doc_lengths(df))
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(stream_id" in plan and "hashpartitioning(number" not in plan
