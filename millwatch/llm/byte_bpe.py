"""Ids of a byte-level BPE vocabulary for whole texts, with a bounded memory of words."""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np

from millwatch.llm.common import forget_long, missing

#: Words a worker remembers; then it starts anew. Long ones are not remembered.
REMEMBERED = 1_500_000

#: New words that are encoded in one call.
TOGETHER = 4000

#: A word with the white space before it. The tokenizer never joins a character that is no
#: white space with white space after it, so the ids of a text are those of these parts.
_PART = re.compile(r"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+$")

#: Other characters that are white space for some readers: such texts are encoded in one go.
_UNSURE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f\u2060\u3000\ufeff]")

#: Those of them that ``str.split`` doesn't split at, and the mark of ``_AS_IT_IS``.
_UNSPLIT = "\x00\u180e\u200b\u200c\u200d\u200e\u200f\u202a\u202b\u202c\u202d\u202e\u2060\ufeff"

#: Signs at the end of a word. After a letter or digit they are never joined with it.
_SIGNS = re.compile(r"(?<=[A-Za-z0-9À-ÖØ-öø-ɏ])[!-/:-@\[-`{-~]+\Z")

_AS_IT_IS = "\x00"


def _is_even(text: str) -> bool:
    """Are the blanks between words single blanks and line feeds, with none at either end?"""
    if " ".join(text.split()) != text.replace("\n", " "):
        return False
    return "\x00" not in text if text.isascii() else not any(c in text for c in _UNSPLIT)


def parts_of(text: str) -> list[str]:
    """Names of the parts of a text: a word stands for a blank and the word, a line feed and a
    word for themselves, and what follows a zero character for itself."""
    if not text:
        return []
    if _is_even(text):
        return (_AS_IT_IS + text.replace("\n", " \n")).split(" ")
    if _UNSURE.search(text):
        return [_AS_IT_IS + text]
    return [_AS_IT_IS + p for p in _PART.findall(text)]


def _spelled(part: str) -> str:
    if part[0] == _AS_IT_IS:
        return part[1:]
    return part if part[0] == "\n" else " " + part


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The encoder of this worker."""
    return Encoder(path)


class Encoder:
    """Encodes texts exactly as the tokenizers library does without adding special tokens.

    The library cuts texts at the strings of special tokens and gives those their ids; a word
    that holds one is left to it as a whole.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        if any(a.lstrip or a.rstrip or a.normalized or re.search(r"\s", a.content) for a in added):
            raise ValueError("special tokens that take white space with them can't be encoded by words")
        self.special = [a.content for a in added]
        vocabulary = self.tokenizer.get_vocab()
        self.n_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():
            self.n_bytes[number] = len(token)  # a character of a token stands for a byte
        self.known: dict[str, bytes] = {}

    def _each(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _joined(self, words: list[str]) -> list[bytes]:
        """The ids of words that begin with white space and don't end with it, in one call: the
        bytes that the ids stand for show where each word ends."""
        text = "".join(words)
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]
        ids = np.array(found.ids, "<u4")
        ends = np.cumsum(list(map(len, words if text.isascii() else map(str.encode, words))))
        reached = np.cumsum(self.n_bytes[ids])
        last = np.minimum(np.searchsorted(reached, ends), len(ids) - 1)
        if not np.array_equal(reached[last], ends) or reached[-1] != ends[-1]:
            return self._each(words)
        raw, cuts = ids.tobytes(), (4 * (last + 1)).tolist()
        return [raw[a:b] for a, b in zip([0, *cuts[:-1]], cuts, strict=True)]

    def _learn(self, new: list[str], special: bool) -> None:
        known, plain, whole = self.known, set(), []
        signed, stems, tails = [], [], []
        for part in new:
            if special and any(s in part for s in self.special):
                whole.append(part)
                continue
            signs = None if part[-1].isalnum() else _SIGNS.search(part, max(0, len(part) - 64))
            if signs is None:
                plain.add(part)
            else:
                signed.append(part)
                stems.append(part[: signs.start()])
                tails.append(_AS_IT_IS + signs.group())
        plain.update(stems, tails)
        plain = plain.difference(known)  # looks each up; an update in place would go through all known
        alone = [p for p in plain if p[0] == _AS_IT_IS] + whole
        known.update(zip(alone, self._each([_spelled(p) for p in alone]), strict=True))
        words = [p for p in plain if p[0] != _AS_IT_IS]
        for start in range(0, len(words), TOGETHER):
            some = words[start : start + TOGETHER]
            spelled = [p if p[0] == "\n" else " " + p for p in some]
            known.update(zip(some, self._joined(spelled), strict=True))
        known.update(zip(signed, map(bytes.__add__, map(known.__getitem__, stems), map(known.__getitem__, tails)), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        parts = [parts_of(t) for t in texts]
        new = missing(self.known, set().union(*parts), REMEMBERED)
        self._learn(new, any(s in t for s in self.special for t in texts))
        look_up = self.known.__getitem__
        out = [b"".join(map(look_up, found)) for found in parts]
        forget_long(self.known, new)
        return out
