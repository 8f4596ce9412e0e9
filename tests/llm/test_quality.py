import math
import random
import re
import unicodedata
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.llm import pairwise_quality, quality_rules


def base_counts(text):
    """The base counts, one by one."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = {}
    for i in range(len(words) - 4):
        windows.setdefault(tuple(words[i:i + 5]), []).append(i)
    repeated = {i + k for places in windows.values() if len(places) > 1 for i in places for k in range(5)}
    lines, seen, again = text.split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    failed = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for w in words for c in w), again, len(repeated), failed


def make_docs():
    draw = random.Random(3)
    word = lambda: "".join(draw.choice("aeinorst") for _ in range(draw.randrange(2, 8)))
    rows = []
    for i in range(700):
        text = " ".join(word() for _ in range(draw.randrange(30, 120))).capitalize() + ".\n" + " ".join(word() for _ in range(20))
        if i % 20 == 7:
            text = " ".join(word() + "***" for _ in range(60))
        if i % 20 == 9:
            text = " ".join(word().upper() + "!!" for _ in range(60))
        rows.append((i, text, "en" if i % 3 else None, "a" if i % 2 else "b", "x", 1.0))
    a = "one two three four five six"
    rows += [
        (1000, None, "en", "a", None, None), (1001, "", None, None, "", 0.0), (1002, f"{a} {a} {a}", "en", "a", "x", 1.0),
        (1003, "w " * 30000, "en", "a", "x", 1.0), (1004, f"{a}\n{a}\n\n \n{a} " + " ".join(f"u{i}" for i in range(200)), "xx", "zz", "x", 1.0),
        (1005, rows[0][1], rows[0][2], rows[0][3], "x", 1.0), (None, rows[0][1], rows[0][2], rows[0][3], "x", 1.0),
        (1006, "é\x0bñ\x0c日本 $a&b<c> \t x\ty z 1 2 3 4 5 6 7 8", "en", "a", "x", 1.0), (1007, "é\x85ñ\xa0x 1 2 3 4 5 6 7 8 9", "en", "a", "x", 1.0),
    ]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(make_docs(), "doc_id long, text string, lang string, source string, cell string, distance double")


def test_base_counts_and_verdicts(docs):
    got = {r.doc_id: r for r in quality_rules.rate(docs, carry=["doc_id"]).select("row.doc_id", "*").collect()}
    rows = make_docs()
    assert len(got) == len(rows)
    for doc, text, *_ in rows:
        r = got[doc]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base_counts(text), doc
        assert not (r.kept and r.base_failed)
    for i in range(700):
        assert got[i].kept == (i % 20 not in (7, 9)), (i, got[i].distance)
    assert got[None].kept == got[1005].kept == got[0].kept and got[1005].distance == got[0].distance


def test_input_rows_come_back_whole(docs):
    kept = quality_rules.rate(docs).select("row.*")
    assert kept.columns == docs.columns
    assert sorted(map(str, kept.collect())) == sorted(map(str, docs.collect()))


def test_empty_table(spark, docs):
    assert quality_rules.rate(docs.limit(0)).count() == 0
    assert quality_rules.rate(spark.createDataFrame([(1, None, None, None)], "doc_id int, text string, lang string, source string")).first().kept is False


def mcd(z, share=quality_rules.SHARE, ridge=quality_rules.RIDGE):
    """The same estimate in numpy: two C-steps from each start, the best goes on."""
    def step(d):
        near = z[d <= np.sort(d)[math.ceil(share * len(z)) - 1]]
        center = near.mean(axis=0)
        cov = (near.T @ near / len(near) - np.outer(center, center)) * (1 - ridge) + ridge * np.eye(z.shape[1])
        return center, cov

    def distance(center, cov):
        off = z - center
        return np.einsum("ij,jk,ik->i", off, np.linalg.inv(cov), off)

    tried = []
    for d in ((z * z).sum(axis=1), (np.tanh(z) ** 2).sum(axis=1), np.abs(z).max(axis=1)):
        estimate = step(distance(*step(d)))
        tried.append((np.linalg.slogdet(estimate[1])[1], *estimate))
    _, center, cov = min(tried, key=lambda t: t[0])
    for _ in range(quality_rules.C_STEPS - 2):
        center, cov = step(distance(center, cov))
    return center, distance(center, cov)


def test_estimate_is_that_of_a_plain_version(spark):
    draw = np.random.default_rng(1)
    p = len(quality_rules.STATISTICS)
    z = draw.standard_normal((300, p)) @ draw.standard_normal((p, p))
    z[:40] += 12
    rows = spark.createDataFrame([("c", *map(float, r)) for r in z], "cell string, " + ", ".join(f"z{i} double" for i in range(p)))
    got = quality_rules.estimates(rows.repartition(4)).first()
    center, d = mcd(z)
    assert np.allclose(got.center, center)
    white, at = np.zeros((p, p)), 0
    for i in range(p):
        for j in range(i + 1):
            white[i, j], at = got.white[at], at + 1
    assert np.allclose((((z - center) @ white.T) ** 2).sum(axis=1), d)
    assert got.n == 300 and math.isclose(got.typical, np.sort(d)[149])


def quality_rows():
    draw = random.Random(11)
    word = lambda: "".join(draw.choice("aeinorst") for _ in range(draw.randrange(2, 8)))
    docs, labels = [], []
    for i in range(600):
        bad = i % 5 == 0
        words = [word() for _ in range(60)]
        text = " ".join(w + "###" if i % 2 else w.upper() + "!!" for w in words) if bad else " ".join(words).capitalize() + "."
        docs.append((i, text, 0.5))
        if i % 3:
            labels.append((i, 0 if bad else 1, 0))
    docs += [(9000, None, 0.1), (9001, "", 0.1), (None, docs[1][1], 0.1), (9002, docs[1][1], 0.1), (9003, "a " * 50000, 0.1)]
    labels += [(1, 0, 0), (2, None, 0), (None, 1, 0), (4, 7, 0)]
    return docs, labels


def test_pairwise_scores_tell_held_out_labels_apart(spark):
    docs, labels = quality_rows()
    frame = spark.createDataFrame(docs, "doc_id long, text string, score double")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = pairwise_quality.train(frame, marks)
    got = {r.doc_id: r for r in pairwise_quality.with_score(frame, model).withColumn(
        "held", pairwise_quality.held_out(F.col("doc_id"))).collect()}
    assert len(got) == len(docs)
    for i in range(600):
        assert got[i].held == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert (got[i].score >= pairwise_quality.LIMIT) == (i % 5 != 0), i
    assert all(0 <= r.score <= 1 for r in got.values())
    assert got[None].score == got[9002].score == got[1].score and got[None].held is False


def test_training_reads_no_held_out_label(spark):
    docs, labels = quality_rows()
    frame = spark.createDataFrame(docs, "doc_id long, text string, score double")
    flipped = [(d, 1 - q if d is not None and q in (0, 1) and zlib.crc32(str(d).encode()) % 4 == 2 else q, t) for d, q, t in labels]
    schema = "doc_id long, quality int, toxic int"
    one, two = (pairwise_quality.train(frame, spark.createDataFrame(x, schema)) for x in (labels, flipped))
    assert one == two


def test_one_label_or_none_scores_all_at_the_limit(spark):
    frame = spark.createDataFrame([(1, "x"), (2, None)], "doc_id long, text string")
    marks = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    for labels in (marks, marks.limit(0)):
        model = pairwise_quality.train(frame, labels)
        scores = [r.score for r in pairwise_quality.with_score(frame, model).collect()]
        assert all(abs(s - 0.7) < 1e-12 for s in scores)
    assert pairwise_quality.with_score(frame.limit(0), pairwise_quality.NEUTRAL).count() == 0


def test_fit_is_a_minimum_of_the_logistic_loss():
    draw = np.random.default_rng(2)
    good, bad = draw.standard_normal((200, 10)) + 0.5, draw.standard_normal((80, 10))
    model = pairwise_quality.fit_pairs(good, bad)
    raw = lambda x: x @ np.array(model.weights)
    assert raw(good).mean() > raw(bad).mean()
    assert (raw(good)[:, None] > raw(bad)[None, :]).mean() > 0.85
    assert 0 < model.quantile < 1


def plain_features(text):
    """The ten numbers, one character, word and line at a time."""
    solid = [c for c in text if c not in " \t\n\x0b\f\r"]
    words, word = [], ""
    for c in text + " ":
        if c in " \t\n\x0b\f\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    lines = [line for line in text.split("\n") if line.strip(" ")]
    k, n = len(solid), len(words)
    share = lambda part, whole: math.sqrt(part / (whole + 20))
    among = lambda signs: share(sum(c in signs for c in solid), k)
    return [
        math.log((k + 100) / (n + 20)), among("#*$%&|<>{}[]=@^~_/\\"), among("!?"),
        share(sum(unicodedata.category(c) == "Lu" for c in solid), k), among("0123456789"), among(".,;:"),
        math.log(len(set(words)) + 1) / math.log(n + 2), share(sum(a == b for a, b in zip(words, words[1:])), n),
        share(len(lines) - len(set(lines)), len(lines)), math.exp(-n / 10)]


def test_features_equal_plain_ones(spark):
    draw = random.Random(9)
    texts = ["", " \n\t", "A A b\x0bB\x0cé É É Ω ß\xa0x\x1c!?", "a\n a\na\n\n \t\n", "x" * 40000, "🎉 𝐀 Ǆ Ǆ ǅ", *(
        "".join(draw.choice("aAbBéÉ .,;:!?#*{}/\\019\n\t\r\x85𝐀") for _ in range(draw.randrange(200))) for _ in range(300))]
    rows = spark.createDataFrame(list(enumerate([*texts, None])), "k int, t string")
    got = [r.x for r in rows.select("k", pairwise_quality.features(F.col("t")).alias("x")).orderBy("k").collect()]
    assert np.allclose(got, [plain_features(t) for t in [*texts, ""]], rtol=1e-12, atol=0)


def test_repeated_ids_reach_the_driver_once(spark, monkeypatch):
    rows = [(1, "Good words here and there.")] * 50 + [(1, "Another text.")] * 50 + [(3, "$$$ !!! ???")]
    labels = spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(pairwise_quality, "fit_pairs", lambda good, bad: seen.append((len(good), len(bad))))
    pairwise_quality.train(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    assert seen == [(1, 1)]


def test_verdicts_change_smoothly_with_the_size_of_a_source(spark):
    """A document's distance moves little when its source grows by one row, at any size."""
    draw = random.Random(12)
    text = lambda plain: " ".join("".join(draw.choice("abcdefghij") for _ in range(draw.randrange(2, 7) if plain else 12)) for _ in range(60))
    common = [(text(True), "en", "big") for _ in range(400)]
    small = [(text(True), "en", "small") for _ in range(202)]
    odd = (text(False), "en", "small")

    def distance(n):
        frame = spark.createDataFrame([*enumerate_rows(common + small[:n - 1]), (9999, *odd)], "doc_id long, text string, lang string, source string")
        return quality_rules.rate(frame, ["doc_id"]).filter("row.doc_id = 9999").first().distance

    found = {n: distance(n) for n in (29, 30, 199, 200, 201)}
    for a, b in ((29, 30), (199, 200), (200, 201)):
        assert abs(found[a] - found[b]) < 0.15 * found[a], found


def enumerate_rows(rows):
    return [(i, *row) for i, row in enumerate(rows)]


def test_model_is_fitted_on_all_labelled_documents(spark):
    """The documents that the first weights come from change nothing; the limit is that of a plain search."""
    draw = random.Random(21)
    word = lambda odd: "".join(draw.choice("abcdefg" if not odd else "AB#*!9") for _ in range(draw.randrange(2, 8)))
    rows, marks = [], []
    for i in range(500):
        bad = draw.random() < 0.3
        rows.append((i, " ".join(word(draw.random() < (0.6 if bad else 0.3)) for _ in range(draw.randrange(3, 30)))))
        marks.append((i, int(not bad)))
    frame, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, quality int")
    one, two = (pairwise_quality.train(frame, labels, n) for n in (5, 4000))
    assert np.allclose(one.weights, two.weights, rtol=1e-6, atol=1e-9) and one.quantile == two.quantile
    known = [(np.array(pairwise_quality.features_of(t)) @ one.weights, 1 - q) for (i, t), (_, q) in zip(rows, marks) if zlib.crc32(str(i).encode()) % 4 != 2]
    known.sort()
    n_bad = sum(b for _, b in known)
    right = [sum(b for _, b in known[:k]) / n_bad + sum(1 - b for _, b in known[k:]) / (len(known) - n_bad) for k in range(len(known) + 1)]
    best = [k for k, v in enumerate(right) if v >= max(right) - 1e-12]
    k = best[len(best) // 2]
    assert one.quantile == k / len(known) and math.isclose(one.limit, (known[k - 1][0] + known[k][0]) / 2, rel_tol=1e-9)
