import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from tidewell.llm import queries, sentencepieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "\n", "\n\n a\n", "a\nb \n c", "▁", "▁a ▁ b▁▁c", "aaaaaaaaaaaa", "日本語 テキスト。 🎉🎉",
    "\x00\x01 a\tb\r\n\x0b\x85", "</s><s><unk><0x0A>", "é ﬁ ½ �", "z" * 20000, "word " * 20000, " " * 3000 + "x", "same", "same",
]


def random_texts(n=600):
    draw = random.Random(6)
    return ["".join(draw.choice("abcde .,\n  ▁éΣ🎉\t日thin") for _ in range(draw.randrange(60))) for _ in range(n)]


def spans(message):
    found = []
    for field, value in sentencepieces._fields(message):
        if field == 2:
            piece = dict(sentencepieces._fields(value))
            found.append((piece.get(4, 0), piece.get(5, 0)))
    return found


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_ids_spans_and_text_are_the_librarys(spark, library):
    texts = [*ODD, *random_texts()]
    table = spark.createDataFrame([(i, t, i, "x", "y") for i, t in enumerate(texts)], "doc_id long, text string, ids int, decoded string, _text string")
    rows = {r.doc_id: r for r in sentencepieces.encode_documents(table.repartition(3), PATH).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        text, r = text or "", rows[i]
        want = library.encode(text, add_eos=True)
        assert r.ids == want and r.decoded == library.decode(want), repr(text)[:60]
        size = len(text.encode())
        assert list(zip(r.starts, r.stops, strict=True)) == [*spans(library.encode(text, out_type="serialized_proto")), (size, size)]


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "identity"])
def test_compiled_maps(rule):
    """The longest-prefix normaliser and its alignment against the library's maps."""
    lib = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=True, remove_extra_whitespaces=True)
    spec = lib.serialized_normalizer_spec
    spec = dict(sentencepieces._fields(spec() if callable(spec) else spec))
    own = sentencepieces.Model.__new__(sentencepieces.Model)
    own.map = sentencepieces.CharacterMap(spec.get(2, b""))
    own.prefix, own.trim, own.escape = (bool(spec.get(i, 1)) for i in (3, 4, 5))
    for text in [t or "" for t in ODD[:18]] + random_texts(200) + ["ﬁne ½ ㍿ Ａｂｃ  　 x", "ẹ́ K̊ ", "​­ a"]:
        got, align = own.normalise(text)
        assert got == lib.normalize(text)
        assert len(align) == len(got.encode()) + 1 and (align[1:] >= align[:-1]).all() and align[-1] <= len(text.encode())


def test_broken_bytes_decode_one_by_one(spark, library):
    ids = [[library.piece_to_id(f"<0x{b:02X}>") for b in data] for data in (b"\xe6\x97", b"a\xff\xe2\x96\x81", b"\x80\x80", b"\xf0\x9f\x8e\x89")]
    rows = [(i, x) for i, x in enumerate([*ids, [], None, [2, 1, 260, 29871], [29871, 29871, 5]])]
    got = spark.createDataFrame(rows, "k int, ids array<int>").select("k", sentencepieces.decode("ids", PATH).alias("t")).orderBy("k").collect()
    assert [r.t for r in got] == [None if x is None else library.decode(x) for _, x in rows]


def test_query_digests(spark, library, tmp_path):
    rows = [(1, None), (None, "a b"), (3, "Ünder the sea\n")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op11_offset_pieces(spark, str(tmp_path)).collect()}
    for doc, text in rows:
        ids = library.encode(text or "", add_eos=True)
        assert got[doc].n_tokens == len(ids)
        assert got[doc].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[doc].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert sentencepieces.encode_documents(empty, PATH).count() == 0
