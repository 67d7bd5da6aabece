"""Numbers of greedy longest-match word pieces, without building the pieces.

A trie of the vocabulary has, at each node, a failure link and a number. When no child
matches the next character, the number says how many whole pieces the text of the node gives
up, and the link leads to the node of what is left. One step forward per character and links
that only shorten what is left make it linear in the word.
"""

from __future__ import annotations

import re
from collections import deque
from functools import lru_cache

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwatch.llm.common import SPACES, map_slices, whole_text

#: Words a worker remembers; then it starts anew.
REMEMBERED = 400_000

SPACE = "▁"
UNKNOWN = -1
_WORD = re.compile(rf"[^{SPACES}]+")


class Automaton:
    """Pieces that begin with ``▁`` begin a word, the others go on with one."""

    ROOT, REST = 0, 1  # nothing read; a whole number of pieces read

    def __init__(self, pieces: list[str]) -> None:
        self.children: list[dict[str, int]] = [{}, {}]
        whole = [False, False]
        for piece in pieces:
            node = self.ROOT if piece.startswith(SPACE) else self.REST
            for c in piece:
                child = self.children[node].get(c)
                if child is None:
                    child = self.children[node][c] = len(self.children)
                    self.children.append({})
                    whole.append(False)
                node = child
            whole[node] = True
        n = len(self.children)
        self.link, self.popped = [UNKNOWN] * n, [0] * n
        queue = deque((self.ROOT, self.REST))
        while queue:  # parents before children
            node = queue.popleft()
            for c, child in self.children[node].items():
                queue.append(child)
                if whole[child]:
                    self.link[child], self.popped[child] = self.REST, 1
                    continue
                at, n_popped = self.link[node], self.popped[node]
                while at != UNKNOWN and c not in self.children[at]:
                    n_popped += self.popped[at]
                    at = self.link[at]
                if at != UNKNOWN:
                    self.link[child], self.popped[child] = self.children[at][c], n_popped

    def count(self, word: str) -> int:
        """Pieces of the word, ``UNKNOWN`` if longest matches don't make it up."""
        children, link, popped = self.children, self.link, self.popped
        node, n = self.ROOT, 0
        for c in SPACE + word:
            child = children[node].get(c)
            while child is None:
                n += popped[node]
                node = link[node]
                if node == UNKNOWN:
                    return UNKNOWN
                child = children[node].get(c)
            node = child
        while node != self.REST:
            n += popped[node]
            node = link[node]
            if node == UNKNOWN:
                return UNKNOWN
        return n


@lru_cache(maxsize=2)
def automaton(path: str) -> Automaton:
    processor = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(processor.get_piece_size())
    special = (processor.is_control, processor.is_unknown, processor.is_byte, processor.is_unused)
    return Automaton([processor.id_to_piece(i) for i in ids if not any(f(i) for f in special)])


_KNOWN: dict[str, dict[str, int]] = {}


def word_piece_counts(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """doc_id, n_words, n_tokens, n_unknown_words of every row.

    Words are runs of characters other than the six ASCII blanks. A word that longest matches
    can't make up counts as one token, the unknown one. NULL and empty texts have no words.
    Whole texts are read; repeated rows give repeated rows, an empty table an empty result.
    Other columns are not read.
    """

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        trie, known = automaton(vocabulary_path), _KNOWN.setdefault(vocabulary_path, {})
        n_words, n_tokens, n_unknown = [], [], []
        for text in part.column("text").to_pylist():
            words = _WORD.findall(text)
            found = []
            for word in words:
                n = known.get(word)
                if n is None:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    n = known[word] = trie.count(word)
                found.append(n)
            unknown = found.count(UNKNOWN)
            n_words.append(len(words))
            n_tokens.append(sum(found) + 2 * unknown)  # -1 each becomes 1
            n_unknown.append(unknown)
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id"), *[pa.array(x, pa.int64()) for x in (n_words, n_tokens, n_unknown)]],
            ["doc_id", "n_words", "n_tokens", "n_unknown_words"],
        )

    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    return map_slices(
        source, work, "doc_id bigint, n_words bigint, n_tokens bigint, n_unknown_words bigint"
    )
