"""Language by unigram pieces, summed over all ways of cutting a word into pieces.

The vocabulary is that of a public tokenizer and stays fixed. A language is a distribution
over its pieces; the probability of a word is the sum, over all segmentations into pieces, of
the product of their probabilities, which a forward pass over the word's lattice gives. The
distributions are fitted by expectation maximisation: forward and backward passes give the
expected number of uses of each piece.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from uuid import uuid4

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwatch.llm.common import drawn_by_hash, forget_long, map_slices, missing, whole_text, written

UNDETERMINED = "und"

#: Documents per language the model is fitted on, in expectation, chosen by a hash.
TRAIN_DOCUMENTS = 2000
ROUNDS = 3

#: Words a worker remembers; then it starts anew.
REMEMBERED = 400_000

#: Weight of the shared distribution in each language's, in counts.
SMOOTHING = 200.0
#: Probability, in every language, of a letter that is no piece.
UNKNOWN_LETTER = 1e-7

_LETTERS = regex.compile(r"\p{L}+")
_START = "▁"


def words_of(text: str) -> list[str]:
    """Runs of letters (Unicode category L), in lower case."""
    return _LETTERS.findall(text.lower())


@dataclass
class Vocabulary:
    """A trie of the pieces: sorted keys (node, letter) with the node they lead to, and the
    piece that ends in each node or -1. Letters are numbered; 0 is any other."""

    letters: dict[str, int]
    keys: np.ndarray
    nodes: np.ndarray
    piece: np.ndarray
    n_pieces: int


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """Pieces of letters only, those that begin a word with the sign for a blank."""
    processor = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [processor.id_to_piece(i) for i in range(processor.get_piece_size())]
    kept = [p for p in dict.fromkeys(pieces) if _LETTERS.fullmatch(p.removeprefix(_START)) or p == _START]
    letters = {c: k for k, c in enumerate(sorted(set("".join(kept))), 1)}
    edges: dict[int, int] = {}
    ends = [-1]
    for number, piece in enumerate(kept):
        node = 0
        for c in piece:
            key = node * (len(letters) + 1) + letters[c]
            if key not in edges:
                edges[key] = len(ends)
                ends.append(-1)
            node = edges[key]
        ends[node] = number
    keys = np.array(sorted(edges), np.int64)
    return Vocabulary(letters, keys, np.array([edges[k] for k in keys.tolist()]), np.array(ends), len(kept))


@dataclass
class Lattice:
    """Edges of the lattices of several words, ordered by end and word."""

    word: np.ndarray
    start: np.ndarray
    end: np.ndarray
    piece: np.ndarray
    lengths: np.ndarray


def lattice(words: list[str], vocab: Vocabulary) -> Lattice:
    """All pieces that occur in the words; a letter that is no piece gets number ``n_pieces``.

    All positions of all words walk down the trie together, a letter at a time.
    """
    letter = vocab.letters.get
    lengths = np.array([len(w) + 1 for w in words], np.int64)
    text = np.array([letter(c, 0) for w in words for c in _START + w], np.int64)
    word = np.repeat(np.arange(len(words)), lengths)
    start = np.arange(len(text)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(text))
    at, node, size = np.arange(len(text)), np.zeros(len(text), np.int64), 0
    found = []
    while len(at):
        key = node * (len(vocab.letters) + 1) + text[at + size]
        place = np.minimum(np.searchsorted(vocab.keys, key), len(vocab.keys) - 1)
        child = np.where((vocab.keys[place] == key) & (text[at + size] > 0), vocab.nodes[place], 0)
        size += 1
        piece = vocab.piece[child]
        if size == 1:
            piece = np.where(piece < 0, vocab.n_pieces, piece)
        use = np.flatnonzero(piece >= 0)
        found.append((word[at[use]], start[at[use]], start[at[use]] + size, piece[use]))
        on = (child > 0) & (left[at] > size)
        at, node = at[on], child[on]
    w, i, j, piece = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((w, j))
    return Lattice(w[order], i[order], j[order], piece[order], lengths)


#: Up to this many letters a word's probability is far from underflow.
_SHORT = 36


def forward(cut: Lattice, probability: np.ndarray) -> np.ndarray:
    """Logarithm of each word's probability in each language: the sum over all segmentations.

    Long words are kept relative to a running scale, so nothing underflows.
    """
    n_words, longest = len(cut.lengths), int(cut.lengths.max(initial=0))
    alpha = np.zeros((n_words, longest + 1, probability.shape[1]))
    scale = np.zeros((n_words, longest + 1))  # logarithm of what a position is divided by
    alpha[:, 0] = 1
    bounds = np.searchsorted(cut.end, np.arange(longest + 2))
    for j in range(1, longest + 1):
        part = slice(bounds[j], bounds[j + 1])
        w, i = cut.word[part], cut.start[part]
        value = alpha[w, i] * probability[cut.piece[part]]
        if longest > _SHORT:
            value *= np.exp(scale[w, i] - scale[w, j - 1])[:, None]
        first = np.flatnonzero(np.concatenate(([True], w[1:] != w[:-1])))
        value, who = np.add.reduceat(value, first), w[first]
        if longest > _SHORT:
            top = value.max(axis=1)
            value /= top[:, None]
            scale[who, j] = scale[who, j - 1] + np.log(top)
        alpha[who, j] = value
    at = np.arange(n_words)
    with np.errstate(divide="ignore"):
        return np.log(alpha[at, cut.lengths]) + scale[at, cut.lengths][:, None]


def tables_of(words: list[str]) -> Iterator[list[int]]:
    """Places of as many words, short ones first, as fill a bounded table; a longer one alone."""
    order, at = sorted(range(len(words)), key=lambda k: len(words[k])), 0
    while at < len(order):
        upto = at + 1
        while upto < len(order) and upto - at < 4096 and (upto - at) * len(words[order[upto]]) < 60_000:
            upto += 1
        yield order[at:upto]
        at = upto


def _log_sums(
    word: np.ndarray, near: np.ndarray, far: np.ndarray, log_piece: np.ndarray, log: np.ndarray, step: int
) -> None:
    """Fill ``log`` [word, place, language] along edges that are ordered by the place they reach.

    What an edge brings is taken relative to the place next to the one it reaches, which is at
    most a piece away: nothing leaves the range, however long the word.
    """
    places, first = np.unique(far, return_index=True)
    bounds = [*first.tolist(), len(far)]
    for at in range(len(places)) if step > 0 else range(len(places) - 1, -1, -1):
        part = slice(bounds[at], bounds[at + 1])
        w, j = word[part], int(places[at])
        base = log[w, j - step]
        value = np.exp(log[w, near[part]] - base + log_piece[part])
        starts = np.flatnonzero(np.concatenate(([True], w[1:] != w[:-1])))
        who = w[starts]
        log[who, j] = base[starts] + np.log(np.add.reduceat(value, starts))


def expected_uses_of_long(cut: Lattice, probability: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """As ``expected_uses``, in logarithms: for words whose probability would underflow."""
    n_words, longest = len(cut.lengths), int(cut.lengths.max(initial=0))
    log_piece = np.log(probability)[cut.piece]
    alpha = np.zeros((n_words, longest + 1, probability.shape[1]))
    beta = np.zeros_like(alpha)
    _log_sums(cut.word, cut.start, cut.end, log_piece, alpha, 1)
    back = np.lexsort((cut.word, cut.start))
    _log_sums(cut.word[back], cut.end[back], cut.start[back], log_piece[back], beta, -1)
    whole = alpha[np.arange(n_words), cut.lengths]
    use = np.exp(alpha[cut.word, cut.start] + log_piece + beta[cut.word, cut.end] - whole[cut.word])
    use *= counts[cut.word]
    out = np.zeros_like(probability)
    for lang in range(probability.shape[1]):
        out[:, lang] = np.bincount(cut.piece, use[:, lang], minlength=len(probability))
    return out


def expected_uses(cut: Lattice, probability: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Expected uses of each piece in each language; counts[word, language] are occurrences."""
    n_words, longest = len(cut.lengths), int(cut.lengths.max(initial=0))
    if longest > _SHORT:
        return expected_uses_of_long(cut, probability, counts)
    alpha = np.zeros((n_words, longest + 1, probability.shape[1]))
    beta = np.zeros_like(alpha)
    alpha[:, 0] = 1
    beta[np.arange(n_words), cut.lengths] = 1
    bounds = np.searchsorted(cut.end, np.arange(longest + 2))
    for j in range(1, longest + 1):
        part = slice(bounds[j], bounds[j + 1])
        np.add.at(alpha, (cut.word[part], j), alpha[cut.word[part], cut.start[part]] * probability[cut.piece[part]])
    for j in range(longest, 0, -1):
        part = slice(bounds[j], bounds[j + 1])
        np.add.at(
            beta, (cut.word[part], cut.start[part]), beta[cut.word[part], j] * probability[cut.piece[part]]
        )
    whole = alpha[np.arange(n_words), cut.lengths]
    use = alpha[cut.word, cut.start] * probability[cut.piece] * beta[cut.word, cut.end]
    use *= (counts / np.maximum(whole, 1e-300))[cut.word]
    out = np.zeros_like(probability)
    for lang in range(probability.shape[1]):
        out[:, lang] = np.bincount(cut.piece, use[:, lang], minlength=len(probability))
    return out


@dataclass
class Model:
    """Languages and probability[piece, language]; the last row is the unknown letter."""

    languages: list[str]
    probability: np.ndarray
    vocabulary_path: str


class Scorer:
    """Scores words with a bounded memory of those seen before."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.known: dict[str, tuple[float, ...]] = {}

    def _learn(self, new: list[str]) -> None:
        vocab = vocabulary(self.model.vocabulary_path)
        for some in tables_of(new):
            words = [new[k] for k in some]
            logs = forward(lattice(words, vocab), self.model.probability)
            self.known.update(zip(words, map(tuple, logs.tolist()), strict=True))

    def score(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Summed logarithms [text, language] and the number of words of each text."""
        found = [words_of(t) for t in texts]
        new = missing(self.known, set().union(*found), REMEMBERED)
        if new:
            self._learn(new)
        known = self.known
        sums = np.zeros((len(texts), len(self.model.languages)))
        for k, words in enumerate(found):
            if words:
                sums[k] = np.array([known[w] for w in words]).sum(axis=0)
        forget_long(known, new)
        return sums, np.array([len(w) for w in found], np.int64)


def train_rows(docs: DataFrame, train: Column, per_language: int = TRAIN_DOCUMENTS) -> DataFrame:
    """text and lang of about ``per_language`` documents of each language, chosen by hash."""
    labelled = docs.filter(train & F.col("lang").isNotNull()).select("doc_id", "lang", "text")
    return drawn_by_hash(labelled, "lang", per_language, "langid").select("lang", "text")


def fit(
    docs: DataFrame,
    train: Column,
    vocabulary_path: str,
    per_language: int = TRAIN_DOCUMENTS,
    rounds: int = ROUNDS,
) -> Model:
    """Learn a distribution per language from the rows that ``train`` selects.

    Only pieces and languages come to the driver: one row per piece and language at most. Runs
    of letters of any length count. A table without labelled rows gives a model without
    languages. Rows without an id are not drawn.
    """
    sample = train_rows(docs, train, per_language)

    def cut(part: pa.RecordBatch) -> pa.RecordBatch:
        found = Counter(
            (word, lang)
            for text, lang in zip(part.column("text").to_pylist(), part.column("lang").to_pylist(), strict=True)
            for word in words_of(text)
        )
        words, langs = ([pair[k] for pair in found] for k in (0, 1))
        columns = [pa.array(words, pa.string()), pa.array(langs, pa.string()), pa.array(list(found.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["word", "lang", "n"])

    each = map_slices(
        sample.select(F.col("lang").cast("string").alias("lang"), whole_text().alias("text")),
        cut,
        "word string, lang string, n bigint",
    )
    counts = written(each.groupBy("word", "lang").agg(F.sum("n").alias("count")), "lang-words")
    languages = sorted(r[0] for r in counts.select("lang").distinct().collect())
    n_pieces = vocabulary(vocabulary_path).n_pieces
    shared = np.full(n_pieces + 1, 1 / n_pieces)
    probability = np.repeat(shared[:, None], len(languages), axis=1)
    probability[n_pieces] = UNKNOWN_LETTER
    number = {lang: k for k, lang in enumerate(languages)}
    spark = docs.sparkSession
    for _ in range(rounds if languages else 0):
        sent = spark.sparkContext.broadcast(probability)

        def work(batches, sent=sent):
            vocab = vocabulary(vocabulary_path)
            total = np.zeros_like(sent.value)
            for batch in batches:
                for start in range(0, batch.num_rows, 2048):
                    part = batch.slice(start, 2048)
                    words = part.column("word").to_pylist()
                    langs, n = part.column("lang").to_pylist(), part.column("count").to_pylist()
                    for some in tables_of(words):
                        count = np.zeros((len(some), len(number)))
                        for row, k in enumerate(some):
                            count[row, number[langs[k]]] = n[k]
                        cut_up = lattice([words[k] for k in some], vocab)
                        total += expected_uses(cut_up, sent.value, count)
            piece, lang = np.nonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(piece), pa.array(lang), pa.array(total[piece, lang])], ["piece", "lang", "uses"]
            )

        uses = np.zeros_like(probability)
        found = counts.mapInArrow(work, "piece bigint, lang bigint, uses double")
        for r in found.groupBy("piece", "lang").agg(F.sum("uses").alias("uses")).toLocalIterator():
            uses[r["piece"], r["lang"]] = r["uses"]
        uses[n_pieces] = 0
        pooled = uses.sum(axis=1) + 0.01
        pooled[n_pieces] = 0
        smoothed = uses + SMOOTHING * (pooled / pooled.sum())[:, None]
        probability = smoothed / smoothed.sum(axis=0)
        probability[n_pieces] = UNKNOWN_LETTER
        sent.unpersist()
    return Model(languages, probability, vocabulary_path)


_SCORERS: dict[str, Scorer] = {}


def identify(
    docs: DataFrame,
    model: Model,
    keep: list[str] | None = None,
    names: tuple[str, str] = ("lang_pred", "score"),
) -> DataFrame:
    """lang_pred and score of every row, beside the columns ``keep`` (``doc_id``).

    The text alone decides. ``score`` is the share of the predicted language when all are
    equally likely beforehand. NULL, empty and letterless texts, and any text when the model
    has no languages, get ``und`` and score 0. Ties go to the first language by name. Whole
    texts are read, however long. Repeated rows give repeated rows, an empty table an empty
    result.
    """
    keep = ["doc_id"] if keep is None else keep
    sent, key = docs.sparkSession.sparkContext.broadcast(model), uuid4().hex
    source = docs.select(*keep, whole_text().alias("__text"))

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        scorer = _SCORERS.get(key)
        if scorer is None:
            _SCORERS.clear()
            scorer = _SCORERS[key] = Scorer(sent.value)
        sums, n = scorer.score(part.column("__text").to_pylist())
        langs, shares = [UNDETERMINED] * len(n), np.zeros(len(n))
        if sums.shape[1]:
            best = sums.argmax(axis=1)
            weight = np.exp(sums - sums.max(axis=1, keepdims=True))
            share = weight.max(axis=1) / weight.sum(axis=1)
            for k in np.flatnonzero(n):
                langs[k], shares[k] = sent.value.languages[best[k]], share[k]
        columns = [part.column(c) for c in keep]
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array(langs, pa.string()), pa.array(shares)], [*keep, *names]
        )

    types = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return map_slices(source, work, f"{types}, `{names[0]}` string, `{names[1]}` double")


def keep_identified(docs: DataFrame, model: Model, least_score: float = 0.5) -> DataFrame:
    """The documents whose language is determined with at least ``least_score``, all columns."""
    found = identify(docs, model, docs.columns, ("__lang_pred", "__score"))
    sure = (F.col("__lang_pred") != UNDETERMINED) & (F.col("__score") >= least_score)
    return found.filter(sure).select(*docs.columns)
