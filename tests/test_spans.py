"""Mention rules that the derived corpus does not single out."""

from conftest import item, sentences

from tidewell.operators import entities, spans


def counts(df):
    return {(r.doc_id, r.entity): r.cnt for r in spans.ne_doc_counts(df).collect()}


def test_misc_counts_only_at_sentence_end(corpus):
    df = corpus(item(taggers={"serif": sentences("Alpha/MISC beta", "gamma Delta/MISC")}))
    assert counts(df) == {("d", "Delta "): 1}


def test_run_joins_tokens_of_one_type_and_breaks_at_another(corpus):
    df = corpus(item(taggers={"serif": sentences("New/LOC York/LOC Times/ORG said x")}))
    assert counts(df) == {("d", "New York "): 1, ("d", "Times "): 1}


def test_runs_do_not_cross_sentences_or_taggers(corpus):
    df = corpus(item(taggers={"serif": sentences("a New/LOC", "York/LOC b"), "lingpipecounter": sentences("b/LOC c")}))
    assert counts(df) == {("d", "New "): 1, ("d", "York "): 1, ("d", "b "): 1}


def test_mention_of_both_taggers_counts_each_time(corpus):
    df = corpus(item(taggers={"serif": sentences("Bob/PER x"), "lingpipecounter": sentences("Bob/PER x Bob/PER y")}))
    assert counts(df) == {("d", "Bob "): 3}


def test_mention_of_second_tagger_only_counts_once_in_mid_sentence(corpus):
    df = corpus(item(taggers={"serif": sentences("x y"), "lingpipecounter": sentences("Bob/PER x Bob/PER y", "Bob/PER z")}))
    assert counts(df) == {("d", "Bob "): 1}


def test_second_tagger_sentence_ends_always_count(corpus):
    mid_first = corpus(item(taggers={"serif": sentences("x"), "lingpipecounter": sentences("Bob/PER x", "y Bob/PER", "z Bob/PER")}))
    assert counts(mid_first) == {("d", "Bob "): 3}
    end_first = corpus(item(taggers={"serif": sentences("x"), "lingpipecounter": sentences("y Bob/PER", "Bob/PER x", "Bob/PER z")}))
    assert counts(end_first) == {("d", "Bob "): 3}


def test_unknown_tagger_is_read_last(corpus):
    df = corpus(item(taggers={"another": sentences("Bob/PER x Bob/PER y"), "serif": sentences("x")}))
    assert counts(df) == {("d", "Bob "): 1}


def test_mention_length_limit_counts_the_trailing_space(corpus):
    short, long = "a" * 48, "b" * 49
    df = corpus(item(taggers={"serif": sentences(f"{short}/PER x {long}/PER y")}))
    assert counts(df) == {("d", short + " "): 1}
    assert {r.mention for r in spans.mention_list(df).collect()} == {short + " ", long + " "}


def test_records_with_one_doc_id_stay_apart(corpus):
    df = corpus(item(stream="1-d", taggers={"serif": sentences("Bob/PER x")}), item(stream="2-d", taggers={"serif": sentences("Bob/PER x")}))
    assert sorted(r.cnt for r in spans.ne_doc_counts(df).collect()) == [1, 1]


def test_empty_maps_are_kept_and_records_without_sentences_are_not(corpus):
    df = corpus(item("none", body=False), item("null", taggers=None), item("bare", taggers={}), item("plain", taggers={"serif": sentences("x y")}))
    assert [(r.doc_id, r.entities) for r in spans.doc_entity_map(df).collect()] == [("plain", {})]


def test_first_coded_type_wins(corpus):
    df = corpus(item(taggers={"serif": sentences("Bob/TIME x", "Bob/PER x", "Bob/ORG x", "May/TIME x")}))
    assert [(r.entity, r.type_code) for r in spans.ne_doc_types(df).collect()] == [("Bob ", 1)]


def test_retagged_length_counts_the_digit(spark):
    words = ["a", "ab", "c" * 27, "d" * 28]
    rows = [("s", "d", [[(w, "PERSON"), ("x", "O")]]) for w in words]
    df = spark.createDataFrame(rows, "stream_id string, doc_id string, sentences array<array<struct<token:string,label:string>>>")
    assert {r.entity for r in spans.ner_typed_counts(df).collect()} == {"ab 3", "c" * 27 + " 3"}


def test_retagged_runs_break_at_labels(spark):
    rows = [("s", "d", [[("Ann", "PERSON"), ("Lee", "PERSON"), ("Rome", "LOCATION")], [("Oslo", "LOCATION")]])]
    df = spark.createDataFrame(rows, "stream_id string, doc_id string, sentences array<array<struct<token:string,label:string>>>")
    assert {(r.entity, r.cnt) for r in spans.ner_typed_counts(df).collect()} == {("Ann Lee 3", 1), ("Rome 1", 1), ("Oslo 1", 1)}


def test_empty_normal_form_drops_that_entity_only(spark):
    df = spark.createDataFrame([("s", "d", "... ", 1), ("s", "d", "U.S. ", 2)], "stream_id string, doc_id string, entity string, cnt int")
    assert [(r.entity, r.norm) for r in entities.doc_entity_norm(df).collect()] == [("U.S. ", "us")]
    assert [(r.entity, r.norm) for r in entities.entity_norm_distinct(df).collect()] == [("U.S. ", "us")]


def test_kb_join_is_inner(spark):
    docs = spark.createDataFrame([("s", "d", "us", 2), ("s", "d", "zz", 1)], "stream_id string, doc_id string, norm string, cnt int")
    kb = spark.createDataFrame([("kb:1", "us", 9)], "kb_id string, norm string, score int")
    assert [tuple(r) for r in entities.entity_kb_join(docs, kb).collect()] == [("us", "kb:1", 9, "d", 2)]


def test_a_lone_tagger_is_the_first(corpus):
    df = corpus(item(taggers={"lingpipecounter": sentences("Bob/PER x Bob/PER y")}))
    assert counts(df) == {("d", "Bob "): 2}


def test_runs_of_two_unknown_taggers_stay_apart(corpus):
    df = corpus(item(taggers={"one": sentences("Ann/PER"), "two": sentences("Lee/PER")}))
    assert counts(df) == {("d", "Ann "): 1, ("d", "Lee "): 1}


def test_sentences_without_tokens(corpus):
    df = corpus(item(taggers={"serif": [{"tokens": None}, {"tokens": []}, *sentences("Ann/PER x")]}))
    assert counts(df) == {("d", "Ann "): 1}


def test_mentions_are_found_in_one_pass_over_the_tokens(corpus):
    tagged = sentences("Ann/PER Lee/PER went/TIME", "x/MISC")
    tagged[0]["tokens"][1]["token"] = None
    df = corpus(item("a", taggers={"serif": tagged}), item("b", taggers={"serif": sentences("")}))
    rows = spans.with_mentions(df, "doc_id")
    assert "filter(sequence" not in rows._jdf.queryExecution().optimizedPlan().toString()
    found = {r.doc_id: [(m.place, m.stop, m.is_end, m.mention) for m in r.mentions] for r in rows.collect()}
    assert found == {"a": [(0, 2, False, "Ann "), (2, 3, True, "went "), (3, 4, True, "x ")], "b": []}
