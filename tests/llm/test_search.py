import math
import random
import re
from collections import Counter

import numpy as np

from tidewell.llm import lexical_search as search

_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def brute(docs, items):
    """All scores by the formula, as (item row, rank, doc, score)."""
    counts = [(d, Counter(_TERM.findall((t or "").translate(_LOWER)))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        query = Counter(_TERM.findall((text or "").translate(_LOWER)))
        scored = []
        for d, c in counts:
            m = 25 + 75 * sum(c.values()) * n // total
            score = sum(k * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m))
                        for t, k in query.items() if t in c)
            if score > 0:
                scored.append((-score, d is None, d))
        out += [(item, rank, d, -s) for rank, (s, _, d) in enumerate(sorted(scored)[:10], 1)]
    return out


def corpus(n=3000, seed=1):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    topics = [draw.sample(words, 25) for _ in range(12)]
    texts = []
    for _ in range(n):
        topic = draw.choice(topics)
        texts.append(" ".join(draw.choice(topic) if draw.random() < 0.7 else words[int(draw.paretovariate(0.6)) % 400] for _ in range(draw.randrange(5, 60))))
    return texts, topics, draw


def loaded(index):
    row = index.shards.toPandas().iloc[0]
    return search.Shard(type("Row", (), {k: v if isinstance(v, bytes) or k == "vocabulary" else np.array(v) for k, v in row.items()}))


def rows_of(df):
    return sorted((str(r.item_id), r["rank"], r.doc_id, r.score) for r in df.collect())


def test_equals_brute_force_and_skips_blocks(spark, monkeypatch):
    monkeypatch.setattr(search, "SHARD_DOCS", 1500)
    texts, topics, draw = corpus()
    odd = ["", None, " ,.;", "ÉÉ éé É x́ w1", "W1 w1 W1", "日本 日本", "w3 " * 20000, "\x00w4\x7f{w4}"] + [texts[0]] * 40
    docs = [(i + 2 ** 60, t) for i, t in enumerate(texts + odd)] + [(None, texts[5]), (None, texts[6]), (7, texts[5])]
    items = [(i, " ".join(draw.choices(t, k=8) + ["w1", "w0"])) for i, t in enumerate(topics)]
    items += [(20, None), (21, ""), (22, "absent"), (23, "ÉÉ W1 日本"), (23, "w5 w6"), (None, "w7"), (24, texts[5])]
    table = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id long, text string, score string, term int").repartition(3)
    wanted = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, rank int").repartition(2)
    index = search.build_index(table)
    want = sorted((str(i), *rest) for i, *rest in brute(docs, items))
    assert rows_of(search.search(index, wanted)) == want
    assert rows_of(search.search(index, wanted, batch_terms=20)) == want

    # Blocks are skipped in a shard once ten documents are known.
    shard, best = loaded(index), []
    shard.search([(t, 1000) for t in topics[0][:8]], best)
    shard.search([(t, 1000) for t in topics[0][:8]], best)
    assert len(best) == search.TOP and shard.seen > 0 and shard.skipped > 0


def test_bounds_hold_for_every_document_of_a_block(spark):
    texts, _, _ = corpus(800, 4)
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    shard = loaded(search.build_index(table))
    assert len(shard.column) > 5
    dense = np.zeros((len(shard.docs), len(shard.place)), np.int64)
    for d in range(len(shard.docs)):
        a, b = shard.starts[d], shard.starts[d + 1]
        dense[d, shard.terms[a:b]] = shard.value[a:b]
    columns = list(shard.column)
    for block in range(len(shard.block_starts) - 1):
        members = shard.members[shard.block_starts[block]:shard.block_starts[block + 1]]
        assert len(members) and (dense[members][:, columns] <= shard.maxima[block].astype(int) * search.LEVEL).all()


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    for docs, queries in ((none, items), (some, items.limit(0)), (none, items.limit(0))):
        got = search.search(search.build_index(docs), queries)
        assert got.columns == ["item_id", "rank", "doc_id", "score"] and got.count() == 0
    assert [(r.doc_id, r["rank"]) for r in search.search(search.build_index(some), items).collect()] == [(1, 1)]
    more = spark.createDataFrame([(1, "a b"), (2, "b"), (3, "b")], "doc_id long, text string")
    assert [(r.doc_id, r["rank"]) for r in search.search(search.build_index(more), items).collect()] == [(1, 1)]
