"""SentencePiece BPE ids from a table of the last token of every prefix.

Merging is deterministic, so every prefix of a text has one encoding, and a sequence of
tokens is the encoding of its text exactly if each token and each pair of neighbours encodes
to itself. An automaton gives the tokens that end at a position; of these, the one that may
follow the last token of the prefix before it is the last token here. The ids are then read
backwards from the end.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwatch.llm.common import map_slices, missing, whole_text

#: Words, and pairs of tokens, that a worker remembers; then it starts anew.
REMEMBERED, REMEMBERED_PAIRS = 300_000, 500_000

SPACE = "▁"
_NONE = -1  # a character that is no piece
_NEVER = float("-inf")


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """The codec of this worker."""
    return Codec(path)


class Codec:
    """Encodes and decodes like the library: no begin or end ids, a space put before the text."""

    def __init__(self, path: str) -> None:
        processor = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces: list[str] = []
        self.score: dict[str, float] = {}
        self.number: dict[str, int] = {}
        self.byte_ids = [0] * 256
        self.decimal: list[str] = []
        self.surface: list[bytes] = []
        self.automaton = ahocorasick.Automaton()
        for i in range(processor.get_piece_size()):
            piece = processor.id_to_piece(i)
            self.pieces.append(piece)
            self.decimal.append(str(i))
            special = processor.is_control(i) or processor.is_unknown(i) or processor.is_unused(i)
            if processor.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.surface.append(bytes([int(piece[3:5], 16)]))
            elif special:
                self.surface.append(b"")
            else:
                self.surface.append(piece.replace(SPACE, " ").encode())
                self.score[piece] = processor.get_score(i)
                self.number[piece] = i
                self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        if any(SPACE in p.lstrip(SPACE) for p in self.number):
            raise ValueError("the words of this vocabulary can't be encoded one by one")
        begins = re.escape("".join(sorted(self._beginnings())))
        self._part = re.compile(rf"{SPACE}+[{begins}]*[^{SPACE}{begins}]*|[{begins}]+[^{SPACE}{begins}]*")
        self.pairs: dict[int, bool] = {}
        self.histories: dict[int, tuple[list[float], list[str], list[str]] | None] = {}
        self.known: dict[str, tuple[int, bytes, bytes]] = {}

    def history(self, token: int) -> tuple[list[float], list[str], list[str]] | None:
        """Scores of the merges that make up a token, and its outer symbols before each and at
        the end; ``None`` if the token's text encodes to something else."""
        found = self.histories.get(token, 0)
        if found != 0:
            return found
        piece, score = self.pieces[token], self.score
        symbols, scores = list(piece), []
        lefts, rights = [symbols[0]], [symbols[-1]]
        while len(symbols) > 1:
            best, at = None, -1
            for k in range(len(symbols) - 1):
                s = score.get(symbols[k] + symbols[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if at < 0:
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            scores.append(best)
            lefts.append(symbols[0])
            rights.append(symbols[-1])
        found = self.histories[token] = (scores, lefts, rights) if symbols == [piece] else None
        return found

    def _beginnings(self) -> set[str]:
        """Characters that no piece has after one that is neither of them nor a space sign,
        so that no merge joins them to what stands before."""
        signs = [chr(c) for c in range(128) if chr(c).isprintable() and not chr(c).isalnum()]
        found = {"\n", "\t", "\r", *signs} - {" "}
        while True:
            inside = {
                b
                for p in self.number
                for a, b in zip(p, p[1:], strict=False)
                if b in found and a not in found and a != SPACE
            }
            if not inside:
                return found
            found -= inside

    def _compatible(self, left: int, right: int) -> bool:
        """Does the pair encode to itself? ``left`` may be ``_NONE``: then, does the token?

        Up to a merge across the border both sides go on as if alone, so it is enough to run
        through both histories, the better score first, and to see whether the two symbols at
        the border would merge before that.
        """
        own = self.history(right)
        if own is None or left == _NONE:
            return own is not None
        before = self.history(left)
        if before is None:
            return False
        (left_scores, _, edges), (right_scores, starts, _) = before, own
        i, j, score = 0, 0, self.score
        n, m = len(left_scores), len(right_scores)
        while True:
            across = score.get(edges[i] + starts[j])
            a = left_scores[i] if i < n else _NEVER
            b = right_scores[j] if j < m else _NEVER
            if across is not None and across > a and across >= b:  # on ties the leftmost
                return False
            if i == n and j == m:
                return True
            if a >= b:
                i += 1
            else:
                j += 1

    def tokens(self, part: str) -> list[int]:
        """Ids of a part of a text whose neighbours can't merge with it."""
        n, many, pairs = len(part), len(self.pieces), self.pairs
        if len(pairs) > REMEMBERED_PAIRS:
            pairs.clear()
        last, size, done = [_NONE] * (n + 1), [1] * (n + 1), 0
        for end, (token, length) in self.automaton.iter(part):
            i = end + 1
            if done == i:
                continue  # the last token of this prefix is unique
            left = last[i - length]
            key = left * many + token
            may_follow = pairs.get(key)
            if may_follow is None:
                may_follow = pairs[key] = self._compatible(left, token)
            if may_follow:
                last[i], size[i], done = token, length, i
        out, i = [], n
        while i:
            if last[i] == _NONE:
                out += [self.byte_ids[b] for b in reversed(part[i - 1].encode())]
            else:
                out.append(last[i])
            i -= size[i]
        out.reverse()
        return out

    def _look_up(self, part: str) -> tuple[int, bytes, bytes]:
        """Number of ids, the ids in decimal, and what they decode to."""
        ids = self.tokens(part)
        decimal = ",".join([self.decimal[i] for i in ids]).encode()
        return len(ids), decimal, b"".join([self.surface[i] for i in ids])

    def _parts(self, text: str) -> list[str]:
        return self._part.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def encode(self, text: str) -> list[int]:
        return [i for part in self._parts(text) for i in self.tokens(part)]

    def decode(self, ids: list[int]) -> str:
        """The text of ids; the space put before the text goes again."""
        data = b"".join([self.surface[i] for i in ids])
        return data.removeprefix(b" ").decode("utf-8", "replace")

    def digests(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """Number of ids, SHA-256 of the ids joined by commas, and of the decoded text."""
        parts = [self._parts(t) for t in texts]
        known, out = self.known, []
        for part in missing(known, set().union(*parts), REMEMBERED):
            known[part] = self._look_up(part)
        for each in parts:
            found = [known[p] for p in each]
            decoded = b"".join([f[2] for f in found]).removeprefix(b" ")
            out.append((
                sum([f[0] for f in found]),
                hashlib.sha256(b",".join([f[1] for f in found])).hexdigest(),
                hashlib.sha256(decoded).hexdigest(),
            ))
        return out


def encode_texts(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, ids (array of int) and the decoded text of every row.

    NULL is the empty text, which has no ids. Whole texts are encoded, however long; repeated
    rows give repeated rows, an empty table an empty result. Other columns are not read.
    """

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        own = codec(model_path)
        ids = [own.encode(t) for t in part.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(ids, pa.list_(pa.int32())), pa.array([own.decode(i) for i in ids], pa.string())],
            ["doc_id", "ids", "decoded"],
        )

    return map_slices(_source(docs), work, "doc_id bigint, ids array<int>, decoded string")


def encoded_digests(docs: DataFrame, model_path: str) -> DataFrame:
    """``encode_texts`` reduced to n_tokens, ids_sha256 and decoded_sha256 inside the tasks."""

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        own = codec(model_path)
        found = own.digests(part.column("text").to_pylist())
        columns = list(zip(*found, strict=True)) or [[], [], []]
        return pa.RecordBatch.from_arrays(
            [
                part.column("doc_id"),
                pa.array(columns[0], pa.int64()),
                pa.array(columns[1], pa.string()),
                pa.array(columns[2], pa.string()),
            ],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return map_slices(
        _source(docs), work, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )


def _source(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
