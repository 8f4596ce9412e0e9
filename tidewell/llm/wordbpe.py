"""Words, symbols and merge table of a tokenizers file of the kind "BPE with word ends".

The tokenizers library normalises (NFC, one space for white space, lower case), splits by a pattern whose
pieces hold no white space, and merges each piece alone. So a text's tokens are those of its parts between
ASCII white space, one after the other, and each distinct part needs work only once per Python worker.
"""

from __future__ import annotations

import functools
import itertools
import json
import operator
import re
from collections.abc import Callable

import numpy as np
import regex
from tokenizers import Tokenizer

#: Parts kept in a worker's memory, where no limit is given; a full memory starts anew.
MEMORY = 1 << 20
LONGEST_KEPT = 64
_PLAIN = re.compile(r"[!-~À-ÿ]+")
_PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")


def parts(text: str) -> list[str]:
    """The text's parts between ASCII white space (other white space is left to the normaliser)."""
    for sign in "\n\t\r\x0b\x0c":
        if sign in text:
            text = text.replace(sign, " ")
    return [part for part in text.split(" ") if part]


class Vocabulary:
    """Tables of one tokenizer file, loaded once per Python worker with :func:`vocabulary`."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self._special = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        ids = data["model"]["vocab"]
        suffix = data["model"]["end_of_word_suffix"]
        # One printable sign per byte: printable Latin-1 stands for itself, the others follow from 256 on.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        sign = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}
        self.byte_of = {c: b for b, c in sign.items()}
        self.inner = np.array([ids[sign[b]] for b in range(256)], np.int64)
        self.final = np.array([ids[sign[b] + suffix] for b in range(256)], np.int64)
        self.inner_ids, self.final_ids = self.inner.tolist(), self.final.tolist()
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in data["model"]["merges"]]
        self.merges = {(ids[a] << 20) | ids[b]: (rank, ids[a + b]) for rank, (a, b) in enumerate(merges)}
        self.rules = {pair: rank for pair, (rank, _) in self.merges.items()}
        self.made = [merged for _, merged in self.merges.values()]
        self.tokens: dict[int, str] = {i: t for t, i in ids.items()} | {i: t for t, i in self.special.items()}

    def pieces(self, part: str) -> list[bytes | int]:
        """The pieces of a part as UTF-8, or the id of a special token."""
        if self._special is None or "<|" not in part or not self._special.search(part):
            return self._plain(part)
        out: list[bytes | int] = []
        at = 0
        for match in self._special.finditer(part):
            out += self._plain(part[at:match.start()])
            out.append(self.special[match.group()])
            at = match.end()
        return out + self._plain(part[at:])

    def _plain(self, part: str) -> list[bytes]:
        if part.isalpha() and (part.isascii() or _PLAIN.fullmatch(part)):
            return [part.lower().encode()]
        if _PLAIN.fullmatch(part):
            return [p.encode() for p in _PIECE.findall(part.lower())]
        # Anything else goes through the library's own normaliser and splitter.
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(part))
        return [bytes(self.byte_of[c] for c in piece) for piece, _ in split]


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def stem(part: str) -> tuple[str, str]:
    """The lower-case part without a comma or full stop behind a letter, and that sign.

    The sign is a piece of its own there, so words need not be worked out again for each sign behind them.
    Only parts of Latin-1 signs, and none that may hold a special token (matched before lower-casing).
    """
    if "<|" in part or not (part.isascii() or _PLAIN.fullmatch(part)):
        return part, ""
    if part[-1] in ",." and part[-2:-1].isalpha():
        return part[:-1].lower(), part[-1]
    return part.lower(), ""


class Remembered:
    """Results per part, worked out in batches for the parts not seen before in this Python worker.

    ``work`` gives the results of a list of parts; ``+`` joins the results of neighbouring parts. Beyond ``limit`` parts
    the memory starts anew.
    """

    def __init__(self, work: Callable[[list[str]], list], limit: int = MEMORY) -> None:
        self.work, self.known, self.limit = work, {}, limit

    def learn(self, texts: list[list[str]]) -> dict:
        """Results of all parts of ``texts``, at least."""
        known = self.known
        if len(known) > self.limit:
            known.clear()
        cut = {part: stem(part) for part in set().union(*texts).difference(known)}
        missing = [s for s in {s for both in cut.values() for s in both} if s and s not in known]
        known.update(zip(missing, self.work(missing), strict=True))
        for part, (base, end) in cut.items():
            if part != base:
                known[part] = known[base] + known[end] if end else known[base]
        return known

    def results(self, texts: list[list[str]]) -> list[list]:
        """Results of the parts of each text, in order; each part is looked up once, and long ones are not kept."""
        known = self.known
        if len(known) > self.limit:
            known.clear()
        found = [list(map(known.get, words)) for words in texts]
        holes = [list(itertools.compress(itertools.count(), map(operator.not_, row))) for row in found]
        unseen = {words[i] for words, at in zip(texts, holes, strict=True) for i in at}
        cut = {part: stem(part) for part in unseen if part not in known}
        missing = [s for s in {s for both in cut.values() for s in both} if s and s not in known]
        known.update(zip(missing, self.work(missing), strict=True))
        for part, (base, end) in cut.items():
            if part != base:
                known[part] = known[base] + known[end] if end else known[base]
        for row, words, at in zip(found, texts, holes, strict=True):
            for i in at:
                row[i] = known[words[i]]
        for part, (base, _) in cut.items():
            if len(part) > LONGEST_KEPT:
                known.pop(part, None)
                known.pop(base, None)
        return found

    def forget(self, texts: list[list[str]]) -> None:
        """Drop long parts: they are hardly met again and would fill the memory."""
        for part in {p for text in texts for p in text if len(p) > LONGEST_KEPT}:
            self.known.pop(part, None)
            self.known.pop(stem(part)[0], None)
