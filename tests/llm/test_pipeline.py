import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tidewell.llm import packing


def make_tables(spark, folder):
    """Clean documents, each with what a stage is to do to it."""
    draw = random.Random(21)
    word = lambda: "".join(draw.choice("aeinorst") for _ in range(draw.randrange(2, 8)))
    docs, labels, want = [], [], {}
    for i in range(400):
        text = " ".join(word() for _ in range(draw.randrange(40, 120))).capitalize() + "."
        docs.append((i, text))
        labels.append((i, 1, 0))
        want[i] = text
    for i in range(400, 440):  # the classifier's
        docs.append((i, " ".join(word() + "***" for _ in range(50))))
        labels.append((i, 0, 0))
    for i in range(500, 510):  # the rules': a line that comes again
        docs.append((i, "\n".join([" ".join(word() for _ in range(8))] * 2) + "\n" + " ".join(word() for _ in range(20))))
    for i in range(600, 660):  # near-duplicates of document 3
        words = want[3].split(" ")
        if i % 2:
            words[0] = word()
        docs.append((i, " ".join(words)))
    docs += [(3, want[3]), (700, None), (701, "")]
    docs.append((800, "Anna " + " ".join(word() for _ in range(40)) + " mail a.b@mail.example.com or +1 (375) 555-4393."))
    want[800] = docs[-1][1].replace("a.b@mail.example.com", "[email]").replace("+1 (375) 555-4393", "[phone]")
    langs = {None: None}
    rows = [(i, t, langs.get(i, "en" if i % 5 else None), "s", 0 if t is None else len(t)) for i, t in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return rows, want


def test_pipeline_gives_what_each_stage_is_to_keep(spark, tmp_path):
    rows, want = make_tables(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, str(tmp_path))
        assert kept.columns == docs.columns and kept.schema == docs.schema, name
        kept.write.parquet(f"{tmp_path}/{name}")
        kept = spark.read.parquet(f"{tmp_path}/{name}")
    got = kept.collect()
    # Document 3 comes twice; rows that repeat an id and text stay together.
    assert sorted(r.doc_id for r in got) == sorted([*want, 3])
    assert all(r.text == want[r.doc_id] and r.n_chars == len(r.text) for r in got)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokens = {i: len(library.encode(t, add_special_tokens=False).ids) + 1 for i, t in want.items()}
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {p.doc_id: p.doc_tokens for p in pieces} == tokens
    lengths, ends = {}, {}
    for p in pieces:
        lengths[p.doc_id] = lengths.get(p.doc_id, 0) + p.length
        ends[p.sequence_id] = max(ends.get(p.sequence_id, 0), p.offset + p.length)
    assert lengths == {i: n * (2 if i == 3 else 1) for i, n in tokens.items()}
    assert max(ends.values()) <= packing.SEQUENCE and sum(ends.values()) == sum(lengths.values())
    assert np.sum([packing.SEQUENCE - e for e in ends.values()]) < packing.SEQUENCE


def test_pipeline_of_no_documents(spark, tmp_path):
    make_tables(spark, str(tmp_path / "a"))
    spark.read.parquet(f"{tmp_path}/a/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{tmp_path}/a/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
