import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.llm import pii


def plain_spans(text):
    """The base patterns, as written."""
    out = [(0, m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((1, m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub(r"\D", "", m.group())
        if 14 <= len(digits) <= 19:
            doubled = [int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))]
            if sum(doubled) % 10 == 0:
                out.append((2, m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.findall("[0-9]", m.group())) <= 15:
            out.append((3, m.start(), m.end()))
    return sorted(out)


def test_base_spans_are_those_of_the_patterns():
    draw = random.Random(6)
    for alphabet in ("a@.b-", "0123.", "12 -4", "+1 ().-23", "a1@.+ -)(\n", "4111 1111-"):
        for _ in range(3000):
            text = "".join(draw.choice(alphabet) for _ in range(draw.randrange(30)))
            assert sorted(pii.base_spans(text)) == plain_spans(text), text
    card = "4111111111111111"
    for text in (card, f"x{card}y", f"{card}@a.b", "4111-1111 1111-1111", "+1 (375) 555-4393", "١٢٣.1.1.1.1", "é@é.com a@b.c", "1.2.3.256 1.2.3.255"):
        assert sorted(pii.base_spans(text)) == plain_spans(text)


TEXTS = [
    None, "", "nothing here", "mail ana.b@mail.example.com or +1 (375) 555-4393 now", "host 10.20.30.40, card 4111111111111111.",
    "est +1 (569) 555-6633 4795326016703902 fin", "call (705) 555-6638 today", "write to ana (at) example (dot) com please",
    "version 1234 5678 9012 3456 of it", "x" * 200000 + " a@b.com", "a@b.com", "a@b.com", "9" * 100000,
]


def test_spans_of_documents(spark):
    rows = [(None if i == 10 else i, t, "x", i) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, kind int")
    got = {r.kind: r for r in pii.find(docs.repartition(3)).select("row.doc_id", "row.kind", F.col("spans").alias("found")).collect()}
    assert len(got) == len(TEXTS)
    found = {i: {TEXTS[i][s.start:s.stop] for s in r.found} for i, r in got.items()}
    for i, text in enumerate(TEXTS):
        base = [(s.kind, s.start, s.stop) for s in got[i].found if s.base]
        assert base == sorted(plain_spans(text or "") if i != 12 else [], key=lambda s: (s[1], s[0]))
    assert found[3] == {"ana.b@mail.example.com", "+1 (375) 555-4393"} and found[4] == {"10.20.30.40", "4111111111111111"}
    assert found[5] == {"+1 (569) 555-6633", "4795326016703902"}  # too long a run for the strict patterns
    assert found[8] == set() and found[2] == set() and found[12] == set()
    assert found[9] == found[10] == found[11] == {"a@b.com"}
    assert pii.find(docs.limit(0)).count() == 0


def test_redaction(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS[:6])), "doc_id int, text string")
    got = pii.find(docs).select("row.doc_id", pii.redact(F.col("row.text"), F.col("spans"))).collect()
    assert [text for _, text in sorted(got)] == [None, "", "nothing here", "mail [email] or [phone] now", "host [ip], card [card].", "est [phone] [card] fin"]


def test_reliabilities_are_recovered():
    """Votes drawn from known reliabilities: EM finds them, and the truth, better than a majority does."""
    draw = np.random.default_rng(4)
    truth = draw.random(20000) < 0.4
    right = np.array([0.95, 0.9, 0.6, 0.55, 0.85])
    said = np.where(draw.random((20000, 5)) < right, truth[:, None], ~truth[:, None]) * 2 - 1
    said[draw.random(said.shape) < 0.1] = 0
    posterior, rates = pii.reliabilities(said, np.zeros(len(said), int), np.ones(len(said)))
    assert np.abs(rates[:, 1, 1] - right).max() < 0.03 and np.abs(rates[:, 0, 0] - right).max() < 0.03
    assert ((posterior > 0.5) == truth).mean() > max(0.95, ((said.sum(axis=1) > 0) == truth).mean())


def test_codes_hold_kind_length_and_votes():
    draw = random.Random(2)
    cases = [(draw.randrange(4), tuple(draw.randrange(-1, 2) for _ in pii.LABELERS), draw.randrange(80)) for _ in range(500)]
    kind, length, said = pii.parts_of(np.array([pii.code_of(*c) for c in cases]))
    assert [(int(k), tuple(map(int, s)), int(n)) for k, s, n in zip(kind, said, length, strict=True)] == [
        (k, s, min(3, n // 12)) for k, s, n in cases]


def test_classifier_rejects_what_labelers_reject():
    good = pii.code_of(3, (0, 1, 1, 1, 1), 17)
    bad = pii.code_of(2, (0, -1, -1, -1, -1), 19)
    base = pii.code_of(0, (1, 1, 1, 0, 1), 20)
    assert pii.accepted_codes(np.array([good, bad, base]), np.array([20, 30, 100])) == sorted([good, base])
    assert pii.accepted_codes(np.array([], int), np.array([], int)) == []


@pytest.mark.parametrize("dot", [".", " dot ", "(dot)", " (dot) ", "[dot]", " [DOT] "])
@pytest.mark.parametrize("at", [" at ", "(at)", " (at) ", "[at]", " [AT] "])
def test_spelled_addresses_are_candidates_whatever_else_the_text_holds(at, dot):
    address = f"jane{at}example{dot}com"
    text = f"You may write to {address}, or not"
    assert [text[a:b] for _, a, b, _, _ in pii.candidates(text)] == [address]


def test_spelled_addresses_hide_nothing():
    held = lambda text: [(k, text[a:b]) for k, a, b, _, _ in pii.candidates(text)]
    assert held("reach me at jane.b at example.com now") == [(0, "jane.b at example.com")]
    assert held("call me at 705.555.6638 today") == [(3, "705.555.6638")]
    assert held("pay it at 4795.3260.1670.3902 today") == [(2, "4795.3260.1670.3902")]
    assert held("it runs at 10.20.30.40 today") == [(1, "10.20.30.40")]
    assert held("no sign at all. None") == []


def test_spelled_addresses_are_redacted(spark):
    """Labelers and the classifier take an address with a known ending, and leave one without."""
    ways = ["jane at example.com", "jane at example [dot] com", "jane at example(dot)com"]
    rows = [f"mail ana.b{i}@mail.example.com or +1 (375) 555-4393 now" for i in range(30)] + ["version 1234 5678 9012 3456 of it"] * 20
    rows += [f"please write to {way} today" for way in ways] + ["we looked at page.nowhere yesterday"] * 20
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id int, text string")
    got = dict(pii.find(docs).select("row.doc_id", pii.redact(F.col("row.text"), F.col("spans"))).collect())
    assert [got[50 + i] for i in range(3)] == ["please write to [email] today"] * 3
    assert {got[i] for i in range(53, 73)} == {"we looked at page.nowhere yesterday"}
