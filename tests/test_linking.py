import itertools
import random

import pytest
from pyspark.sql import functions as F

from tidewell.operators import annotations, linking, spotting

KEY = ["doc_id"]
SPOT = "spot string, spot_id int, link_probability double, candidates array<struct<entity:string,commonness:double>>"


def spots_of(spark, *names, candidates=None):
    return spark.createDataFrame([
        (name, i, 0.5, (candidates or {}).get(name, [(f"/{name}", 1.0)])) for i, name in enumerate(names)], SPOT)


def texts_of(spark, **texts):
    return spark.createDataFrame(list(texts.items()), "doc_id string, text string")


def mentions(docs):
    return {(r.doc_id, r.spot, r.start, r.end) for r in spotting.mention_rows(docs, KEY).collect()}


def test_mentions_have_character_offsets(spark):
    docs = spotting.doc_mentions(texts_of(spark, a="été, New  York; new!", b="nothing", c=""), spots_of(spark, "new", "new york"), KEY)
    assert mentions(docs) == {("a", "new", 5, 8), ("a", "new york", 5, 14), ("a", "new", 16, 19)}


def test_broadcast_and_shuffled_dictionaries_agree(spark):
    pick = random.Random(5)
    text = {f"d{i}": " ".join(pick.choice(["aa", "b", "cc,", "d.", "é"]) for _ in range(pick.randint(0, 60))) for i in range(30)}
    spots = spots_of(spark, "aa", "b", "aa b", "b aa", "cc d aa", "d")
    key, found = "spark.sql.autoBroadcastJoinThreshold", []
    before = spark.conf.get(key)
    for most in (before, "-1"):
        spark.conf.set(key, most)
        found.append(mentions(spotting.doc_mentions(texts_of(spark, **text), spots, KEY)))
    spark.conf.set(key, before)
    assert found[0] == found[1] and found[0]


def test_words_of_any_script_are_whole(spark):
    docs = spotting.doc_mentions(texts_of(spark, a="in München heute, für Müller"), spots_of(spark, "münchen", "müller", "ller"), KEY)
    assert mentions(docs) == {("a", "münchen", 3, 10), ("a", "müller", 22, 28)}


def test_overlapping_mentions_keep_the_longest(spark):
    docs = spotting.doc_mentions(
        texts_of(spark, a="red car park", b="ab cd ef"), spots_of(spark, "red car", "car park", "car", "ab cd", "cd ef"), KEY)
    assert mentions(spotting.without_overlaps(docs)) == {("a", "car park", 4, 12), ("b", "ab cd", 0, 5)}


def test_no_overlaps_remain(spark):
    pick = random.Random(3)
    words = ["a", "bb", "c"]
    names = [" ".join(w) for n in (1, 2, 3) for w in itertools.product(words, repeat=n)][::2]
    texts = texts_of(spark, **{f"d{i}": " ".join(pick.choice(words) for _ in range(40)) for i in range(8)})
    docs = spotting.doc_mentions(texts, spots_of(spark, *names), KEY)
    before, after = mentions(docs), mentions(spotting.without_overlaps(docs))

    def beaten(m, others):
        return any(o[0] == m[0] and o[2] < m[3] and m[2] < o[3] and (
            o[3] - o[2] > m[3] - m[2] or (o[3] - o[2] == m[3] - m[2] and o[2] < m[2])) for o in others)

    assert after == {m for m in before if not beaten(m, before)}
    for doc, group in itertools.groupby(sorted(after, key=lambda m: (m[0], m[2])), key=lambda m: m[0]):
        spans = [(m[2], m[3]) for m in group]
        assert all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))


def annotated(spark, *rows):
    data = [("d", [(start, start + 1, "s", "e", score) for start, score in rows])]
    return spark.createDataFrame(
        data, "doc_id string, annotations array<struct<start:int,end:int,spot:string,entity:string,score:double>>")


def test_threshold_comes_after_the_cut(spark):
    rows = [(i, 0.9) for i in range(49)] + [(100, 0.05), (101, 0.04)]
    kept = annotations.annotation_rows(annotations.top_annotations(annotated(spark, *rows)), KEY).collect()
    assert len(kept) == 49
    more = [(i, 0.9) for i in range(51)]
    kept = annotations.annotation_rows(annotations.top_annotations(annotated(spark, *more)), KEY).collect()
    assert sorted(r.start for r in kept) == list(range(50))


def test_lines_and_links(spark):
    texts = texts_of(spark, d="ab cd", e="none")
    found = annotated(spark, (0, 0.25), (3, 0.5))
    lines = {r.doc_id: r.line for r in annotations.annot_mentions(texts, found, KEY).collect()}
    assert lines == {"d": "d\ts,0,e,0.25\ts,3,e,0.5", "e": "e"}
    assert {r.doc_id for r in annotations.annot_list(found, KEY).collect()} == {"d"}
    shown = {r.doc_id: r.rendered for r in annotations.annot_render(texts, found, KEY).collect()}
    link = "<a href=\"#\" onmouseover='manage(e)' >{}</a>"
    assert shown == {"d": link.format("a") + "b " + link.format("c") + "d", "e": "none"}


def test_relatedness_of_linked_pairs(spark):
    graph = spark.createDataFrame([("p1", "a"), ("p2", "a"), ("p1", "b"), ("p3", "c")], "page string, target string")
    pages = spark.range(8)
    pairs = spark.createDataFrame([("a", "b"), ("a", "c"), ("a", "z")], "a string, b string")
    got = {(r.a, r.b): (r.shared, round(r.relatedness, 6)) for r in linking.relatedness(pairs, graph, pages).collect()}
    assert got == {("a", "b"): (1, round(1 - 1 / 3, 6)), ("a", "c"): (0, 0.0), ("a", "z"): (0, 0.0)}


def test_neighbours_decide_between_candidates(spark):
    spots = spots_of(spark, "java", "coffee", "code", candidates={
        "java": [("/island", 0.7), ("/drink", 0.2), ("/language", 0.1)], "coffee": [("/coffee", 1.0)], "code": [("/code", 1.0)]})
    edges = [(p, t) for p in ("p1", "p2") for t in ("/drink", "/coffee")] + [(p, t) for p in ("p3", "p4") for t in ("/language", "/code")]
    graph = spark.createDataFrame([*edges, ("p5", "/island")], "page string, target string")
    texts = texts_of(spark, a="java coffee", b="java code", c="java")
    docs = spotting.doc_mentions(texts, spots, KEY)
    found = linking.disambiguate(docs, KEY, "tagme", spots=spots, graph=graph, pages=spark.range(50))
    chosen = {(r.doc_id, r.spot): r.entity for r in annotations.annotation_rows(found, KEY).collect()}
    assert chosen[("a", "java")] == "/drink" and chosen[("b", "java")] == "/language" and chosen[("c", "java")] == "/island"
    prior = annotations.annotation_rows(linking.disambiguate(docs, KEY, "prior"), KEY).filter(F.col("spot") == "java")
    assert {r.entity for r in prior.collect()} == {"/island"}
    with pytest.raises(ValueError):
        linking.disambiguate(docs, KEY, "other")


def test_learned_scorer_prefers_what_it_saw(spark):
    rows = [(float(i % 2), 0.5, 0.9 if i % 2 else 0.1, 0.0, 1.0) for i in range(40)]
    model = linking.fit_scorer(spark.createDataFrame(rows, ["label", *linking.FEATURES]))
    new = spark.createDataFrame(
        [("d", 0, 1, "s", "x", 0.5, 0.2, 0.0, 1.0), ("d", 0, 1, "s", "y", 0.5, 0.8, 0.0, 1.0)],
        ["doc_id", "start", "end", "spot", "entity", *linking.FEATURES])
    best = linking.by_score(new, lambda f: linking.scored_by(model, f), KEY).first()
    assert [a.entity for a in best.annotations] == ["y"]


def test_spot_of_ten_words_and_few_sequences(spark):
    ten = " ".join("abcdefghij")
    spots = spots_of(spark, ten, "a b", "a", "x")
    texts = texts_of(spark, d="A b c d e f g h i j, a b; x " + "other words here " * 50, e="a b c d e f g h i", f="q w")
    found = mentions(spotting.doc_mentions(texts, spots, KEY))
    assert ("d", ten, 0, 19) in found and len(found) == 8 and not any(m[0] == "f" for m in found)
    read = spotting._with_words(texts, KEY, spotting.longest(spots))
    assert spotting._grams(read, spotting.prefixes(spots), KEY).count() <= 2 * len(found)


def test_two_records_of_one_document_stay_apart(spark):
    keys = ["stream_id", "doc_id"]
    spots = spots_of(spark, "red car", "car park", "car")
    texts = spark.createDataFrame([("1-d", "d", "a red car"), ("2-d", "d", "a car park"), ("3-d", "d", "")], "stream_id string, doc_id string, text string")
    docs = spotting.without_overlaps(spotting.doc_mentions(texts, spots, keys))
    rows = spotting.mention_rows(docs, keys)
    assert {(r.stream_id, r.spot, r.start) for r in rows.collect()} == {("1-d", "red car", 2), ("2-d", "car park", 2)}
    best = linking.disambiguate(docs, keys, "prior")
    lines = {(r.stream_id, r.line) for r in annotations.annot_mentions(texts, best, keys, "doc_id").collect()}
    assert lines == {("1-d", "d\tred car,2,/red car,0.5"), ("2-d", "d\tcar park,2,/car park,0.5"), ("3-d", "d")}
    shown = {r.stream_id: r.rendered for r in annotations.annot_render(texts, best, keys).collect()}
    assert shown["3-d"] == "" and shown["1-d"].startswith("a <a") and shown["2-d"].endswith("car park</a>")


def test_commas_in_entities_do_not_part_fields(spark):
    spots = spots_of(spark, "new", candidates={"new": [("/a,b", 1.0)]})
    texts = texts_of(spark, a="new")
    docs = linking.disambiguate(spotting.doc_mentions(texts, spots, KEY), KEY, "prior")
    assert [r.line for r in annotations.annot_lines(texts, docs, KEY).collect()] == ["a\t/a%2Cb,0.5"]


@pytest.mark.parametrize("piece", [7, 512])
def test_sliding_votes_equal_a_loop_over_neighbours(spark, monkeypatch, piece):
    """Long texts are cut to pieces; sums must be those of all neighbours within the window."""
    monkeypatch.setattr(linking, "PIECE", piece)
    draw, window = random.Random(8), 5
    names = [f"s{c}" for c in "abcdefghi"]
    spots = spots_of(spark, *names, candidates={n: [(f"/{n}{j}", 0.6 - 0.2 * j) for j in range(1 + i % 3)] for i, n in enumerate(names)})
    entities = [c.entity for r in spots.collect() for c in r.candidates]
    edges = {(f"p{draw.randrange(12)}", draw.choice(entities)) for _ in range(60)}
    graph, pages = spark.createDataFrame(sorted(edges), "page string, target string"), spark.range(40)
    texts = texts_of(spark, **{f"d{i}": " ".join(draw.choice([*names, "no"]) for _ in range(n)) for i, n in enumerate((0, 1, 2, 30, 90))})
    docs = spotting.doc_mentions(texts, spots, KEY)

    pairs = [(a, b) for a, b in itertools.combinations(sorted(entities), 2)]
    related = {(r.a, r.b): r.relatedness for r in linking.relatedness(spark.createDataFrame(pairs, "a string, b string"), graph, pages).collect()}
    assert {p for p, v in related.items() if v > 0} == {
        (r.a, r.b) for r in linking.related_pairs(graph, pages).filter("relatedness > 0").collect()}
    known = {r.spot: r for r in spots.collect()}
    got = {(r.doc_id, r.start, r.entity): r for r in linking.link_features(docs, spots, linking.vote_matrix(spots, graph, pages), KEY, window).collect()}
    want = 0
    for text in docs.collect():
        for i, m in enumerate(text.mentions):
            near = [x for j, x in enumerate(text.mentions) if j != i and abs(i - j) <= window]
            certain = [known[x.spot] for x in near if len(known[x.spot].candidates) == 1]
            weight = sum(s.link_probability for s in certain)
            for c in known[m.spot].candidates:
                want += 1
                rel = lambda e: 1.0 if e == c.entity else related.get((min(e, c.entity), max(e, c.entity)), 0.0)  # noqa: E731, B023
                mean = sum(s.link_probability * rel(s.candidates[0].entity) for s in certain) / weight if weight else 0.0
                row = got[(text.doc_id, m.start, c.entity)]
                assert row.context_weight == pytest.approx(weight) and row.context_relatedness == pytest.approx(mean)
    assert want == len(got) > 100
    met = {(r.spot_id, r.other_id) for r in linking.context_pairs(docs, KEY, window).collect()}
    assert met == {(a.spot_id, b.spot_id) for t in docs.collect() for i, a in enumerate(t.mentions)
                   for j, b in enumerate(t.mentions) if i != j and abs(i - j) <= window}


def test_relatedness_in_context_has_pairs_without_a_common_page(spark):
    spots = spots_of(spark, "java", "code", candidates={"java": [("/island", 0.6), ("/language", 0.4)], "code": [("/code", 1.0)]})
    graph = spark.createDataFrame([("p1", "/language"), ("p1", "/code"), ("p2", "/island")], "page string, target string")
    docs = spotting.doc_mentions(texts_of(spark, a="java code"), spots, KEY)
    found = linking.related_in_context(docs, spots, graph, spark.range(4), KEY)
    assert {(r.a, r.b): r.shared for r in found.collect()} == {("/code", "/language"): 1, ("/code", "/island"): 0}


def test_votes_are_the_same_whatever_the_blocks_of_the_matrix(spark, monkeypatch):
    """A piece is sent to each block of its spots; no row has the entries of a whole piece."""
    draw = random.Random(4)
    names = [f"s{c}" for c in "abcdefghi"]
    spots = spots_of(spark, *names, candidates={n: [(f"/{n}{j}", 0.6 - 0.2 * j) for j in range(1 + i % 3)] for i, n in enumerate(names)})
    entities = [c.entity for r in spots.collect() for c in r.candidates]
    graph = spark.createDataFrame(sorted({(f"p{draw.randrange(12)}", draw.choice(entities)) for _ in range(60)}), "page string, target string")
    docs = spotting.doc_mentions(texts_of(spark, **{f"d{i}": " ".join(draw.choice(names) for _ in range(5 * i)) for i in range(9)}), spots, KEY)
    matrix = linking.vote_matrix(spots, graph, spark.range(40))

    def found():
        rows = linking.link_features(docs, spots, matrix, KEY).collect()
        return sorted((r.doc_id, r.start, r.entity, round(r.context_relatedness, 9), round(r.context_weight, 9)) for r in rows)

    whole = found()
    for name, value in (("BLOCK_ENTRIES", 7), ("ROW_ENTRIES", 2), ("BLOCK_PIECES", 2), ("BLOCK_CANDIDATES", 2)):
        monkeypatch.setattr(linking, name, value)
    assert found() == whole and any(r[3] for r in whole)
    assert linking._with_received(docs, matrix.limit(0), spots, KEY, 5).filter("exists(received, c -> c.votes > 0)").count() == 0
