import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewell.llm import batched_bpe, packing, token_counts
from tidewell.llm.batched_bpe import PairTable
from tidewell.llm.wordbpe import vocabulary

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None, "", " \n\t ", "don't DON'T they'LL.", "<|endoftext|>x<|ENDOFTEXT|>. <|startoftext|>.", "aaaaaaaaaaaaaa!!!!!!..,,",
    "été. É, İstanbul ΣΑΣ. ß ẞ", "x\x1cy\x85z\xa0w　v", "1234 5.6,7 ²³ ½ Ⅷ", "日本語 テキスト。 🎉🎉", "\x00\x01\x7f a\tb\r\nc\x0bd\x0ce",
    "word " * 30000, "z" * 20000, "same", "same",
]


def random_texts(n=400):
    draw = random.Random(5)
    return ["".join(draw.choice("aAbBéÉİΣς.,!'’s t<|endoftext|> \n\x1c\xa0́ñ١３") for _ in range(draw.randrange(40))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def texts():
    return [*ODD, *random_texts()]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(None if i == 3 else i, t, i, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, ids string").repartition(3)


def test_counts_are_the_librarys(docs, texts, library):
    got = {r.doc_id: r for r in token_counts.count_tokens(docs, PATH).collect()}
    for i, text in enumerate(texts):
        row = got[None if i == 3 else i]
        want = len(library.encode(text or "", add_special_tokens=False).ids)
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len((text or "").encode()), want, want > 2048), text


def test_ids_and_decoded_text_are_the_librarys(docs, texts, library):
    got = {r.doc_id: r for r in batched_bpe.encode_documents(docs, PATH).collect()}
    for i, text in enumerate(texts):
        row = got[None if i == 3 else i]
        want = library.encode(text or "", add_special_tokens=False).ids
        assert row.ids == want, text
        assert row.decoded == library.decode(want, skip_special_tokens=False)


def test_decoding_leaves_out_unknown_ids(spark):
    rows = spark.createDataFrame([([320, 999999, -1, 49407],), (None,), ([],)], "ids array<int>")
    assert [r[0] for r in rows.select(batched_bpe.decode(F.col("ids"), PATH)).collect()] == ["a</w> <|endoftext|>", None, ""]


def test_heap_merging_gives_the_symbols_of_the_rounds():
    words = vocabulary(PATH)
    table = batched_bpe.PairTable(words.merges)
    pieces = [b"banana", b"aaaaaaa", b"mississippi", b"x", "é".encode() * 5]
    for piece, ids in zip(pieces, batched_bpe.encode_pieces(pieces, words, table), strict=True):
        assert token_counts.count_piece(piece, words) == len(ids) // 4


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts.count_tokens(none, PATH).count() == 0
    assert batched_bpe.encode_documents(none, PATH).count() == 0
    assert packing.pack(none, PATH).count() == 0


def test_packing_holds_each_id_once(docs, texts, library):
    rows = packing.pack(docs, PATH, windows=4).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for i, text in enumerate(texts):
        want = [*library.encode(text or "", add_special_tokens=False).ids, packing.END]
        parts = sorted(by_doc[None if i == 3 else i], key=lambda r: r.start)
        assert np.concatenate([np.frombuffer(p.ids, "<u4") for p in parts]).tolist() == want
        assert [p.start for p in parts] == np.r_[0, np.cumsum([p.length for p in parts])[:-1]].tolist()
        assert {p.doc_tokens for p in parts} == {len(want)}
    sizes = []
    for parts in by_sequence.values():
        parts.sort(key=lambda r: r.offset)
        ends = np.cumsum([p.length for p in parts])
        assert [p.offset for p in parts] == [0, *ends[:-1].tolist()]
        sizes.append(int(ends[-1]))
    assert max(sizes) <= packing.SEQUENCE
    # Three partitions with four windows each leave little: one sequence short of full, and the windows emitted early.
    assert sum(packing.SEQUENCE - s for s in sizes) < 0.05 * packing.SEQUENCE * len(sizes) + packing.SEQUENCE


def test_packing_crc_is_of_little_endian_ids(spark):
    row = packing.pack(spark.createDataFrame([(7, "a")], "doc_id long, text string"), PATH).select(
        F.crc32("ids").alias("crc"), "length").first()
    assert (row.crc, row.length) == (zlib.crc32((320).to_bytes(4, "little") + (2).to_bytes(4, "little")), 2)


def test_windows_emit_the_fullest_when_none_fits():
    open_windows = packing.Windows(0, limit=2, size=10)
    piece = lambda n: b"\0\0\0\0" * n
    assert open_windows.add(1, piece(6)) == [] and open_windows.add(2, piece(7)) == []
    assert open_windows.add(3, piece(3))[0][0] == 2  # best fit fills the window of document 2
    open_windows.add(4, piece(8))
    assert [r[0] for r in open_windows.add(5, piece(9))] == [4]
    assert sorted(r[0] for r in open_windows.rest()) == [1, 5]


def test_a_pair_has_a_slot_of_its_own():
    draw = np.random.default_rng(2)
    merges = {(int(a) << 20) | int(b): (i, 5000 + i) for i, (a, b) in enumerate({tuple(p) for p in draw.integers(900, size=(4000, 2)).tolist()})}
    table = PairTable(merges)
    asked = np.array([*merges, *((draw.integers(900, size=5000) << 20) | draw.integers(900, size=5000)), (1 << 40) - 1])
    at, rank = table.find(asked)
    none = np.iinfo(np.int64).max
    assert rank.tolist() == [merges[k][0] if k in merges else none for k in asked.tolist()]
    assert all(table.merged[i] == merges[k][1] for k, i in zip(asked.tolist(), at.tolist()) if k in merges)
    assert PairTable({}).find(asked[:3])[1].tolist() == [none] * 3
    slots = [table.offset[k >> 20] + (k & 0xFFFFF) for k in merges]
    assert len(set(slots)) == len(merges)


def test_texts_of_a_batch_are_encoded_together(texts, library, monkeypatch):
    encoder = batched_bpe.BatchEncoder(PATH)
    more = [*texts, "Word, WORD. word wOrd,. été, ÉTÉ. ßa, x" + "y" * 99 + ".", " a,\tb.\x0b\x0c\r\nc\x1cd ", "12, (a) <|endoftext|>, ,"]
    want = [library.encode(t or "", add_special_tokens=False).ids for t in more]
    for memory in (batched_bpe.MEMORY, 10):
        monkeypatch.setattr(batched_bpe, "MEMORY", memory)
        for first in (0, 5, 0, len(more)):
            counts, ids = encoder.encode(pa.array(more[first:], pa.string()))
            assert counts.tolist() == [len(w) for w in want[first:]]
            assert ids.tolist() == [i for w in want[first:] for i in w]
    # A word is merged once, whatever its case and the sign behind it; long words and other parts are not kept.
    encoder = batched_bpe.BatchEncoder(PATH)
    encoder.encode(pa.array(["Word, WORD. word " + "y" * 99 + " (a) 12"]))
    assert list(encoder.known) == ["word"] and encoder.count == 2


def test_an_encoders_memory_does_not_grow_with_the_texts(library, monkeypatch):
    encoder = batched_bpe.BatchEncoder(PATH)
    letters = "abcdefghijklmnopqrst"
    word = lambda i: "".join(letters[i // 20**k % 20] for k in range(5))
    for first in range(0, 248_000, 31_000):
        encoder.encode(pa.array([" ".join(word(i) + end for i in range(first, first + 31_000) for end in ("", "-"))]))
        assert len(encoder.known) <= (1 << 17) + 31_000 and len(encoder.others.known) <= (1 << 17) + 70_000
    assert encoder.used < 1 << 20
    # Words that a second batch had outlast a full memory, and still have their ids.
    monkeypatch.setattr(batched_bpe, "MEMORY", 10)
    encoder = batched_bpe.BatchEncoder(PATH)
    for i, text in enumerate(["often alsooften once", "Often, alsooften " + " ".join(map(word, range(20))), "OFTEN. twice alsooften wanted"]):
        if i == 2:
            encoder._forget()
            assert list(encoder.known) == ["often", "alsooften"]
        counts, ids = encoder.encode(pa.array([text]))
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids and counts.tolist() == [len(ids)]
    assert "once" not in encoder.known and encoder.count == len(encoder.known) == 4
