"""Personal data by weak supervision.

Strict patterns give the base spans; looser ones give further candidates. Labelers (pattern, check digits and
ranges, gazetteer, context words, surroundings) vote on each candidate or abstain. Expectation-maximisation over
the votes of all documents estimates how reliable each labeler is (Dawid and Skene 1979), and the posteriors train
a logistic span classifier, which decides on the candidates beyond the base spans.

A candidate's votes and features are one small number, so EM and the classifier work on counts of at most a few
thousand such numbers, whatever the size of the corpus.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm import common
from tidewell.session import materialize

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("pattern", "check", "gazetteer", "context", "surroundings")
SPAN = "array<struct<kind: int, start: int, stop: int, base: boolean, code: int>>"
#: Text before and after a candidate that the context labeler reads.
NEAR = 48

# Gazetteers and context words.
ENDINGS = frozenset("com net org edu gov mil int info biz io ai app dev me tv de fr es it uk eu nl be at ch us ca au mx ar cl co pt br pl se no dk fi ie jp cn in ru".split())
DIAL_CODES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 351 352 353 354 358 380 420 421 852 886 971 972".split())
ISSUERS = re.compile(r"4|5[1-5]|2[2-7]|3[47]|6(?:011|5)|35|62")
FOR_WORDS = re.compile(r"\b(?:e-?mails?|mail|contact|write|correo|kontakt|courriel|tel|tél|phone|call|mobile|fax|telefon|teléfono|téléphone|appel|llam|whatsapp|sms|card|visa|mastercard|amex|credit|karte|carte|tarjeta|iban|account|ip|address|adresse|dirección|host|server|login|from|reach)\b", re.I)
AGAINST_WORDS = re.compile(r"\b(?:version|release|isbn|issn|order|invoice|ticket|serial|sku|part|section|chapter|doi|hash|commit|page|figure|table|example)\b", re.I)

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
#: Looked for at every word, as the local part of an address may end another hit ("me at jane.b at example.com").
_SPELLED = re.compile(
    r"(?<![\w.+-])(?=([\w.+-]{1,64}(?: ?[(\[]at[)\]] ?| at )[\w-]{1,63}(?:(?: ?[(\[]dot[)\]] ?| dot |\.)[\w-]{1,63}){1,4}))", re.I)
_IP6 = re.compile(r"(?<![\w:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![\w:])")
_CARD_PARTS = re.compile(r"(?<![0-9])(?:[0-9]{14,19}|[0-9]{4}(?:[ ./_-][0-9]{4}){3}|3[47][0-9]{2}[ ./_-][0-9]{6}[ ./_-][0-9]{5})(?![0-9])")
_PHONE_PARTS = re.compile(
    r"(?:\+[0-9]{1,3}[ .-]?)(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-]?[0-9]{3}[ .-]?[0-9]{3,4}(?![0-9])"
    r"|(?<![\w+(])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?!\w)")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = ord(digit) - 48
        if place % 2:
            value = value * 2 - 9 * (value > 4)
        total += value
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(kind, start, stop)`` of the strict patterns, leftmost, without overlap within a kind."""
    spans = []
    at, free = text.find("@"), 0
    while at >= 0:
        # The local part is the whole run before the sign, so nothing is tried twice.
        before = text[free:at]
        start = at - (len(before) - len(before.rstrip(LOCAL)))
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            spans.append((0, start, match.end()))
        free = match.end() if match else at + 1
        at = text.find("@", free)
    if not _DIGIT.search(text):
        return spans
    spans += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(_octet(part) for part in m.group().split("."))]
    for m in _CARD.finditer(text):
        if 14 <= m.end() - m.start():
            digits = _digits(m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                spans.append((2, m.start(), m.end()))
    if "+" in text:
        spans += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 10 <= len(_digits(m.group())) <= 15]
    return spans


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def loose_spans(text: str) -> list[tuple[int, int, int]]:
    """Candidates of the looser patterns: spelled-out addresses, long IP addresses, cards and numbers within longer runs."""
    spans = []
    low = text.lower()
    if " at " in low or "(at" in low or "[at" in low:
        spans += [(0, m.start(1), m.end(1)) for m in _SPELLED.finditer(text)]
    if ":" in text:
        spans += [(1, m.start(), m.end()) for m in _IP6.finditer(text)]
    if _DIGIT.search(text):
        spans += [(2, m.start(), m.end()) for m in _CARD_PARTS.finditer(text)]
        spans += [(3, m.start(), m.end()) for m in _PHONE_PARTS.finditer(text)]
    return spans


def _ending(span: str) -> str:
    return re.split(r"[.\s(\[\])]+", span.strip(".)]"))[-1].lower()


def votes(text: str, kind: int, start: int, stop: int, base: bool) -> tuple[int, ...]:
    """Votes of :data:`LABELERS` on a candidate: 1 for, -1 against, 0 abstains."""
    span = text[start:stop]
    digits = _digits(span)
    if kind == 0:
        check = 1 if "@" in span and ".." not in span else 0
        known = 1 if _ending(span) in ENDINGS else -1
    elif kind == 1:
        check = 1 if ":" in span or len(span.split(".")) == 4 else -1
        known = -1 if span.startswith(("0.", "127.", "255.")) else 1 if "." in span else 0
    elif kind == 2:
        check = 1 if luhn(digits) else -1
        known = 1 if ISSUERS.match(digits) else -1
    else:
        check = 1 if 10 <= len(digits) <= 15 else -1
        known = (1 if any(digits[:n] in DIAL_CODES for n in (1, 2, 3)) else -1) if span[0] == "+" else 0
    around = text[max(0, start - NEAR):start] + " " + text[stop:stop + NEAR // 3]
    context = 1 if FOR_WORDS.search(around) else -1 if AGAINST_WORDS.search(around) else 0
    edge = text[start - 1:start] + text[stop:stop + 1]
    return (1 if base else 0, check, known, context, -1 if any(c.isalnum() for c in edge) else 1)


def code_of(kind: int, said: tuple[int, ...], length: int) -> int:
    """Kind, votes and a length class (of four) as one number."""
    code = kind * 4 + min(3, length // 12)
    for vote in said:
        code = code * 3 + vote + 1
    return code


def parts_of(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Kind, length class and votes of each code."""
    said = np.empty((len(codes), len(LABELERS)), np.int64)
    rest = codes.copy()
    for i in reversed(range(len(LABELERS))):
        said[:, i], rest = rest % 3 - 1, rest // 3
    return rest // 4, rest % 4, said


def candidates(text: str | None) -> list[tuple[int, int, int, bool, int]]:
    """Base spans, and looser candidates that touch none of them nor each other, by place.

    A spelled-out address of unknown ending gives way to any other: "me at 705.555.6638" hides no number.
    """
    if not text:
        return []
    base = base_spans(text)
    taken = sorted((start, stop) for _, start, stop in base)
    out = [(kind, start, stop, True) for kind, start, stop in base]
    extra: list[tuple[int, int, int]] = []
    loose = [(kind == 0 and _ending(text[start:stop]) not in ENDINGS, start, stop, kind) for kind, start, stop in loose_spans(text)]
    for _, start, stop, kind in sorted(loose):
        at = bisect.bisect(extra, (start, stop, kind))
        if (at == 0 or extra[at - 1][1] <= start) and (at == len(extra) or extra[at][0] >= stop):
            extra.insert(at, (start, stop, kind))
    i = 0
    for start, stop, kind in extra:
        while i < len(taken) and taken[i][1] <= start:
            i += 1
        if i == len(taken) or taken[i][0] >= stop:
            out.append((kind, start, stop, False))
    out.sort(key=lambda s: (s[1], s[0], s[2]))
    return [(k, a, b, is_base, code_of(k, votes(text, k, a, b, is_base), b - a)) for k, a, b, is_base in out]


def spans(text: Column) -> Column:
    """Candidates of the whole text; none for a null or empty text."""

    def find(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        names = ("kind", "start", "stop", "base", "code")
        for texts in series:
            yield pd.Series([[dict(zip(names, c, strict=True)) for c in candidates(t)] for t in texts])

    return F.pandas_udf(find, SPAN)(text)


def reliabilities(said: np.ndarray, kind: np.ndarray, count: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """EM over vote patterns: posterior of each pattern, and each labeler's vote rates given the truth.

    The start is the majority; a labeler that abstains says nothing. Rates are smoothed by one vote of each kind.
    """
    posterior = 1 / (1 + np.exp(-said.sum(axis=1).astype(float)))
    rates = np.zeros((said.shape[1], 2, 2))
    for _ in range(rounds):
        truth = np.stack([count * (1 - posterior), count * posterior])
        for j in range(said.shape[1]):
            for t in (0, 1):
                yes, no = truth[t][said[:, j] == 1].sum(), truth[t][said[:, j] == -1].sum()
                rates[j, t] = np.array([no + 1, yes + 1]) / (yes + no + 2)
            # No labeler may be worse than chance, or the two truths could change places.
            if rates[j, 1, 1] < rates[j, 0, 1]:
                rates[j, :, 1] = rates[j, :, 1].mean()
                rates[j, :, 0] = 1 - rates[j, :, 1]
        log = np.zeros((2, len(said)))
        for t in (0, 1):
            for k in np.unique(kind):
                of = kind == k
                log[t, of] = np.log((truth[t][of].sum() + 1) / (count[of].sum() + 2))
            for j in range(said.shape[1]):
                log[t] += np.where(said[:, j] == 1, np.log(rates[j, t, 1]), np.where(said[:, j] == -1, np.log(rates[j, t, 0]), 0))
        posterior = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
    return posterior, rates


def classifier_input(codes: np.ndarray) -> np.ndarray:
    """One column per kind, length class, and vote for or against of each labeler."""
    kind, length, said = parts_of(codes)
    return np.concatenate([np.eye(len(KINDS))[kind], np.eye(4)[length], said == 1, said == -1], axis=1).astype(float)


def accepted_codes(codes: np.ndarray, count: np.ndarray, penalty: float = 1.0) -> list[int]:
    """Codes that the classifier, trained on EM's posteriors of all candidates, takes for personal data."""
    if not len(codes):
        return []
    kind, _, said = parts_of(codes)
    posterior, _ = reliabilities(said, kind, count.astype(float))
    x, w = classifier_input(codes), np.zeros(len(KINDS) + 4 + 2 * len(LABELERS))
    weight = count / count.sum() * min(count.sum(), 10_000)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (posterior - p)) - penalty * w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(w))
        step = np.linalg.solve(curve, gradient)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return sorted(int(c) for c, yes in zip(codes, x @ w > 0, strict=True) if yes)


def find(docs: DataFrame, carry: list[str] | None = None, text: str = "text") -> DataFrame:
    """``row`` (a struct of the ``carry`` columns, all by default) and ``spans``, ordered by place, per input row.

    ``spans`` has ``kind`` (an index into :data:`KINDS`), ``start``, ``stop`` (code points) and ``base``. Base spans
    always stay. Whole texts are read; a null or empty text has none; repeated rows get equal spans.
    """
    common.text_batches(docs)
    table = materialize(
        docs.select(F.struct(*(carry or ["*"])).alias("row"), spans(F.col(text)).alias("spans")), "spans")
    counted = table.select(F.explode("spans.code").alias("code")).groupBy("code").agg(F.count(F.lit(1)).alias("n")).collect()
    counted.sort()
    codes, count = (np.array([r[i] for r in counted], np.int64) for i in (0, 1))
    good = F.array(*[F.lit(c) for c in accepted_codes(codes, count)]).cast("array<int>")
    return table.select("row", F.transform(
        F.filter("spans", lambda s: s["base"] | F.array_contains(good, s["code"])),
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"), s["base"].alias("base")),
    ).alias("spans"))


def redact(text: Column, found: Column) -> Column:
    """The text with each span replaced by its kind in brackets; of spans that overlap, the first is replaced."""
    names = F.array(*[F.lit(f"[{k}]") for k in KINDS])
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    return F.when(F.size(found) == 0, text).otherwise(F.aggregate(
        found, start,
        lambda a, s: F.when(s["start"] < a["at"], F.struct(a["out"], F.greatest(a["at"], s["stop"]).alias("at"))).otherwise(F.struct(
            F.concat(a["out"], F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.get(names, s["kind"])).alias("out"),
            s["stop"].alias("at"))),
        lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text)))))
