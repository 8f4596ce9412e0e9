import random
import re

import numpy as np
import pytest

import corpus_pipeline
from tidewell.llm import binary_codes, common, ngram_join


def components_of(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    return {i: find(i) for i in ids}


def test_components_of_chains_and_stars(spark):
    draw = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)] + [
        (draw.randrange(200, 400), draw.randrange(200, 400)) for _ in range(150)] + [(5, 5), (7, 6)]
    got = {r.node: r.component for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {x for e in edges for x in e if e[0] != e[1]}
    want = components_of(nodes, [e for e in edges if e[0] != e[1]])
    assert got == want
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_lookup_join_keeps_every_fact(spark):
    facts = spark.createDataFrame([(i, 0 if i % 3 else i) for i in range(3000)], "x int, k int")
    lookup = spark.createDataFrame([(0, 2000, "hot"), (3, 1, "cold")], "k int, n int, v string")
    got = common.lookup_join(facts, lookup, "k", "n", how="left").collect()
    assert len(got) == 3000 and sum(r.v == "hot" for r in got) == 2001 - 0 * len(got)
    assert sum(r.v == "cold" for r in got) == 1


def vector_rows():
    draw = np.random.default_rng(8)
    rows, at = [], 0
    for label in (1, 2, None):
        for v in draw.standard_normal((150, 24)):
            rows.append((at, v, label))
            at += 1
        base = draw.standard_normal(24)
        for _ in range(300):  # more than one block of near copies around the limit
            rows.append((at, base + draw.standard_normal(24) * 0.14, label))
            at += 1
        rows += [(at, base, label), (at + 1, base, label), (at + 2, base * 3, label), (at + 3, -base, label)]
        at += 4
    rows = [(i, [float(np.float32(x)) for x in v], lab) for i, v, lab in rows]
    nan, inf = float("nan"), float("inf")
    rows += [(9000 + i, v, 1) for i, v in enumerate((None, [], [0.0] * 24, [nan] * 24, [inf] + [1.0] * 23, [None] + [1.0] * 23, [1.0] * 3, [2.0] * 3, [1e38] * 24, [1e-30] * 24))]
    rows += [(None, rows[0][1], 1)]
    return rows


def test_embeddings_link_as_by_brute_force(spark):
    rows = vector_rows()
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, class string, member int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in binary_codes.link(frame.repartition(5)).collect()}
    good = [(i, np.array(v, float), lab) for i, v, lab in rows if i is not None and lab is not None and v
            and None not in v and np.isfinite(v).all() and np.any(np.array(v) != 0)]
    links = {i: set() for i, *_ in rows}
    for n, (i, v, lab) in enumerate(good):
        for j, w, other in good[:n]:
            if lab == other and len(v) == len(w):
                a, b = v / np.abs(v).max(), w / np.abs(w).max()
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.98:
                    links[i].add(j)
                    links[j].add(i)
    root = components_of([i for i in links if i is not None], [(i, j) for i in links for j in links[i]])
    assert len(got) == len(rows)
    assert got.pop(None) == (0, None, True)
    wrong = {i: (g, (len(links[i]), root[i])) for i, g in got.items() if g != (len(links[i]), root[i], root[i] == i)}
    assert not wrong


def test_no_embeddings(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert binary_codes.link(none).count() == 0
    odd = spark.createDataFrame([(1, None, 3)], "vec_id long, embedding array<float>, label int")
    assert [tuple(r) for r in binary_codes.link(odd).collect()] == [(1, 0, 1, True)]


def test_estimates_are_unbiased_within_their_bounds():
    draw = np.random.default_rng(3)
    shape = binary_codes.Plan(8, 16, 2, 64)
    v = draw.standard_normal((400, 64))
    v[200:] = v[:200] + 0.8 * draw.standard_normal((200, 64))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    bits, factors = binary_codes.coded(v, shape)
    turned = v @ binary_codes.rotations(shape).T
    signs = (bits * 2.0 - 1).reshape(400, 2, 64) / 8
    stored = (signs / factors[:, :, None]).reshape(400, -1) / 2
    error = np.einsum("ij,ij->i", turned[:200], stored[200:]) - np.einsum("ij,ij->i", v[:200], v[200:])
    spread = np.sqrt(((1 - factors ** 2) / factors ** 2).sum(axis=1) / 63) / 2
    assert abs(error.mean()) < 4 * error.std() / np.sqrt(200)
    assert (np.abs(error) <= binary_codes.DEVIATIONS * spread[200:]).all()


def test_bands_reach_the_recall():
    for rows in (10, 10_000, 10_000_000):
        shape = binary_codes.plan(rows, 64)
        same = 1 - np.arccos(0.98) / np.pi
        assert (1 - same ** shape.width) ** shape.bands <= 1 - binary_codes.RECALL + 1e-12
        assert shape.rotations * 64 >= shape.width * shape.bands
    bands = ngram_join.choose()
    assert bands.hashes <= ngram_join.HASHES
    assert (1 - ngram_join.LIMIT ** bands.rows) ** bands.count <= 1 - ngram_join.RECALL


def text_rows():
    draw = random.Random(9)
    word = lambda: "".join(draw.choice("abcdeé") for _ in range(draw.randrange(3, 8)))
    passage = [word() for _ in range(60)]
    rows = [(i, [word() for _ in range(draw.randrange(1, 150))]) for i in range(150)]
    rows += [(200 + i, [word() for _ in range(90)] + passage) for i in range(40)]
    base = [word() for _ in range(160)]
    for i in range(180):  # more than one block of near copies
        copy = list(base)
        for _ in range(draw.randrange(0, 5)):
            copy[draw.randrange(160)] = word()
        rows.append((300 + i, copy))
    rows = [(i, " ".join(w)) for i, w in rows]
    rows += [(600 + i, rows[3][1]) for i in range(30)] + [(700, rows[3][1].upper().replace(" ", "\n\t"))]
    rows += [(800, None), (801, ""), (802, " \n"), (803, "one two"), (804, "one\ttwo"), (805, "one two three"), (806, "long " * 40000), (807, "long " * 30000)]
    return rows + [(None, rows[3][1]), (5, rows[5][1])]


def test_documents_join_as_by_brute_force(spark):
    rows = text_rows()
    frame = spark.createDataFrame([(*r, "x", 3) for r in rows], "doc_id long, text string, class string, n_links int").repartition(4)
    out = ngram_join.join(frame).collect()
    assert len(out) == len(rows)
    sets = {}
    for n, (i, text) in enumerate(rows):
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
        if i is not None and words:
            sets[n] = {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))}
    links = {n: set() for n in range(len(rows))}
    for n in sets:
        for m in sets:
            if m < n and 5 * len(sets[n] & sets[m]) >= 4 * len(sets[n] | sets[m]):
                links[n].add(m)
                links[m].add(n)
    root = components_of(list(sets), [(n, m) for n in links for m in links[n]])
    least = {}
    for n in sets:
        least[root[n]] = min(least.get(root[n], 10 ** 9), rows[n][0])
    want = sorted(str((i, len(links[n]), least[root[n]] if n in sets else i, n not in sets or least[root[n]] == i)) for n, (i, _) in enumerate(rows))
    assert sorted(str((r.doc_id, r.n_links, r.component_id, r.kept)) for r in out) == want


def test_ids_that_repeat_with_other_texts(spark):
    draw = random.Random(12)
    texts = [" ".join(str(draw.randrange(10 ** 6)) for _ in range(60)) for _ in range(6)]
    near = [t + " more" for t in texts]
    want = [  # id, text, links, component
        (7, texts[0], 0, 7),
        (7, texts[1], 1, 3), (3, near[1], 1, 3),
        (7, texts[2], 1, 7), (9, near[2], 1, 7),
        (7, texts[3], 3, 7), (7, texts[3], 3, 7), (7, texts[3].replace(" ", "  "), 3, 7), (9, near[3], 3, 7),
        (8, texts[4], 1, 8), (8, near[4], 1, 8),
        (8, texts[5], 1, 8), (11, texts[5], 1, 8),
    ]
    docs = spark.createDataFrame([r[:2] for r in want], "doc_id long, text string").repartition(3)
    keys = {r.k: r.text for r in docs.select("text", ngram_join.text_key(docs.text).alias("k")).collect()}
    got = [(r.doc_id, keys[r.text_key], r.n_links, r.component_id, r.kept) for r in ngram_join.join(docs).collect()]
    assert sorted(got) == sorted((*w, w[0] == w[3]) for w in want)
    left = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    assert sorted(map(tuple, left)) == sorted(w[:2] for w in want if w[0] == w[3])


def test_ids_that_repeat_with_other_vectors(spark):
    draw = np.random.default_rng(5)
    vectors = [[float(np.float32(x)) for x in v] for v in draw.standard_normal((5, 24))]
    near = [[v[0] + 0.0625, *v[1:]] for v in vectors]
    want = [
        (7, vectors[0], 0, 7),
        (7, vectors[1], 1, 3), (3, near[1], 1, 3),
        (7, vectors[2], 2, 7), (7, vectors[2], 2, 7), (9, near[2], 2, 7),
        (8, vectors[3], 1, 8), (8, near[3], 1, 8),
        (8, vectors[4], 1, 8), (11, vectors[4], 1, 8),
    ]
    rows = spark.createDataFrame([(*w[:2], 1) for w in want], "vec_id long, embedding array<float>, label int").repartition(3)
    got = [tuple(r) for r in binary_codes.link(rows).collect()]
    assert sorted(got) == sorted((i, n, c, i == c) for i, _, n, c in want)


def test_no_documents(spark):
    assert ngram_join.join(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("text,count", [(None, 0), ("", 0), ("a b", 1), ("a b c d e", 1), ("a b c d e f", 2), ("x " * 50, 1)])
def test_shingles(text, count):
    assert len(ngram_join.shingles(text)) == count
