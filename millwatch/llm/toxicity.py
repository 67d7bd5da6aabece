"""Toxicity from averaged subword embeddings and a linear softmax.

A text is the bag of the character n-grams of its words and of the words themselves; each
has a vector in a table of hashed buckets. The mean of the vectors goes through a linear
layer and a softmax over the two classes. Vectors and layer are trained together in numpy.
A misspelt word shares most n-grams with the word it hides.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from uuid import uuid4
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwatch.llm.common import drawn_by_hash, forget_long, map_slices, missing, whole_text

BUCKETS, DIMENSIONS = 1 << 17, 8
SHORTEST, LONGEST = 3, 5

#: Labelled documents of each class the model is fitted on, in expectation, chosen by a hash.
TRAIN_DOCUMENTS = 1500
EPOCHS, BATCH, RATE = 8, 64, 0.02

#: A bucket that a greater share of the training texts of either class has is left out: it is in
#: most texts whatever their label.
COMMON = 0.6

#: Words a worker remembers; then it starts anew.
REMEMBERED = 400_000

_WORD = re.compile(r"\w+")


def features_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each word and of the n-grams of the word between its marks, one word after
    the other, and how many each word has."""
    marked = [f"<{w}>" for w in words]
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    sizes = np.array([len(w) for w in marked], np.int64)
    owner = np.repeat(np.arange(len(words)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(codes))  # characters to the end
    whole = np.array([crc32(w.encode("utf-8", "replace")) for w in marked], np.uint64)
    found, owners = [whole % np.uint64(BUCKETS)], [np.arange(len(words))]
    mixed = codes
    for size in range(2, LONGEST + 1):
        mixed = mixed[: len(codes) - size + 1] * np.uint64(0x100000001B3) + codes[size - 1 :]
        if size >= SHORTEST:
            at = np.flatnonzero(left[: len(mixed)] >= size)
            spread = (mixed[at] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
            found.append(spread % np.uint64(BUCKETS))
            owners.append(owner[at])
    owners_ = np.concatenate(owners)
    order = np.argsort(owners_, kind="stable")
    return np.concatenate(found).astype(np.int64)[order], np.bincount(owners_, minlength=len(words))


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def bags(docs: DataFrame) -> DataFrame:
    """label, and the buckets of each text with their shares of its n-grams."""

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        buckets, shares = [], []
        for text in part.column("text").to_pylist():
            counts: dict[str, int] = {}
            for word in words_of(text):
                counts[word] = counts.get(word, 0) + 1
            flat, sizes = features_of(list(counts))
            weight = np.repeat(np.array(list(counts.values()), float), sizes)
            found, where = np.unique(flat, return_inverse=True)
            share = np.bincount(where, weight, minlength=len(found)) / max(weight.sum(), 1)
            buckets.append(found.astype(np.int32))
            shares.append(share.astype(np.float32))
        return pa.RecordBatch.from_arrays(
            [
                part.column("label"),
                pa.array(buckets, pa.list_(pa.int32())),
                pa.array(shares, pa.list_(pa.float32())),
            ],
            ["label", "buckets", "shares"],
        )

    return map_slices(docs, work, "label int, buckets array<int>, shares array<float>")


def train_rows(
    docs: DataFrame, labels: DataFrame, train: Column, per_class: int = TRAIN_DOCUMENTS
) -> DataFrame:
    """text and label of about ``per_class`` documents of each class, chosen by hash.

    At most four times as many ids are sent to the texts, so that no text is shuffled.
    """
    known = labels.filter(train & F.col("toxic").isin(0, 1)).select(
        "doc_id", F.col("toxic").cast("int").alias("label")
    )
    drawn = drawn_by_hash(known, "label", per_class, "toxicity").limit(4 * per_class)
    texts = docs.select("doc_id", whole_text().alias("text"))
    return texts.join(F.broadcast(drawn), "doc_id").select("label", "text")


@dataclass
class Model:
    """What scoring needs of the trained layers: a number per bucket, and a constant.

    The softmax of two classes depends on the difference of their outputs, and that is
    linear in the averaged vectors.
    """

    per_bucket: np.ndarray
    constant: float


def train(
    indptr: np.ndarray, buckets: np.ndarray, shares: np.ndarray, label: np.ndarray, seed: int = 7
) -> Model:
    """Vectors and layer by Adam on the cross entropy; the classes count alike."""
    if len(np.unique(label)) < 2:
        only = {0: -20.0, 1: 20.0}.get(int(label[0])) if len(label) else 0.0
        return Model(np.zeros(BUCKETS, np.float32), only)
    rng = np.random.default_rng(seed)
    # buckets that most texts of both classes have are most of the work: their vector is zero
    of = np.repeat(label, np.diff(indptr))
    told = np.zeros(BUCKETS, bool)
    for one in (0, 1):
        told |= np.bincount(buckets[of == one], minlength=BUCKETS) <= COMMON * (label == one).sum()
    use = told[buckets]
    owner = np.repeat(np.arange(len(label), dtype=np.int32), np.diff(indptr))[use]
    shares, buckets = shares[use], buckets[use]
    indptr = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(label)))))
    table = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    table[~told] = 0
    layer = rng.normal(0, 0.5, (DIMENSIONS, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    moments = [(np.zeros_like(x), np.zeros_like(x)) for x in (table, layer, bias)]
    balance = len(label) / (2 * np.bincount(label, minlength=2))
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(label))
        rate = RATE * (1 - epoch / EPOCHS)
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            sizes = indptr[chosen + 1] - indptr[chosen]
            where = np.concatenate([np.arange(indptr[d], indptr[d + 1]) for d in chosen])
            rows, share = buckets[where], shares[where][:, None]
            own = np.repeat(np.arange(len(chosen)), sizes)
            mean = np.zeros((len(chosen), DIMENSIONS), np.float32)
            np.add.at(mean, own, table[rows] * share)
            out = mean @ layer + bias
            out = np.exp(out - out.max(axis=1, keepdims=True))
            wrong = out / out.sum(axis=1, keepdims=True)
            wrong[np.arange(len(chosen)), label[chosen]] -= 1
            wrong *= (balance[label[chosen]] / len(chosen))[:, None]
            wrong = wrong.astype(np.float32)
            slope = np.zeros_like(table)
            np.add.at(slope, rows, (wrong @ layer.T)[own] * share)
            step += 1
            fix = np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for x, grad, (m, v) in zip(
                (table, layer, bias), (slope, mean.T @ wrong, wrong.sum(axis=0)), moments, strict=True
            ):
                m += 0.1 * (grad - m)
                v += 0.001 * (grad * grad - v)
                x -= rate * fix * m / (np.sqrt(v) + 1e-8)
    toward = layer[:, 1] - layer[:, 0]
    return Model(table @ toward, float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, train_on: Column, per_class: int = TRAIN_DOCUMENTS) -> Model:
    """Train on at most about ``per_class`` labelled documents of each class.

    That bounds what comes to the driver: two short arrays per document. Without labelled
    rows the model says one half for every text, with one class it says that class.
    """
    got = bags(train_rows(docs, labels, train_on, per_class)).toArrow().combine_chunks()
    label = got.column("label").to_numpy().astype(np.int64)
    lists = got.column("buckets").combine_chunks()
    if not len(label):
        return train(np.zeros(1, np.int64), np.zeros(0, np.int32), np.zeros(0), label)
    flat = lists.flatten().to_numpy()
    shares = got.column("shares").combine_chunks().flatten().to_numpy()
    sizes = np.diff(lists.offsets.to_numpy())
    # in an order of their own, so that the result doesn't hang on that of the tasks
    mark = [crc32(np.ascontiguousarray(x.values.to_numpy())) for x in lists]
    order = np.lexsort((mark, sizes, label))
    starts = np.concatenate(([0], np.cumsum(sizes)))
    flat, shares = (
        np.concatenate([x[starts[k] : starts[k + 1]] for k in order]) for x in (flat, shares)
    )
    del got, lists
    return train(np.concatenate(([0], np.cumsum(sizes[order]))), flat, shares, label[order])


class Scorer:
    """Scores texts with a bounded memory of the words seen before."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.known: dict[str, tuple[float, int]] = {}

    def score(self, texts: list[str]) -> np.ndarray:
        found = [words_of(t) for t in texts]
        used = set().union(*found)
        new = missing(self.known, used, REMEMBERED)
        if new:
            buckets, sizes = features_of(new)
            values = self.model.per_bucket[buckets].astype(float)
            sums = np.add.reduceat(values, np.concatenate(([0], np.cumsum(sizes)[:-1])))
            self.known.update(zip(new, zip(sums.tolist(), sizes.tolist(), strict=True), strict=True))
        known, out = self.known, np.zeros(len(texts))
        for k, words in enumerate(found):
            if words:
                total, n = np.array([known[w] for w in words]).sum(axis=0)
                out[k] = total / n
        forget_long(known, new)
        return 1 / (1 + np.exp(-np.clip(out + self.model.constant, -700, 700)))


_SCORERS: dict[str, Scorer] = {}


def score_texts(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 from one half up) of every row.

    The text alone decides, all of it. NULL, empty and wordless texts get the score of an
    empty bag: the model's constant. Equal texts get equal scores; repeated rows give repeated
    rows; an empty table gives an empty result. Other columns are not read.
    """
    sent, key = docs.sparkSession.sparkContext.broadcast(model), uuid4().hex

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        scorer = _SCORERS.get(key)
        if scorer is None:
            _SCORERS.clear()
            scorer = _SCORERS[key] = Scorer(sent.value)
        score = scorer.score(part.column("text").to_pylist())
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
            ["doc_id", "score", "predicted"],
        )

    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    return map_slices(source, work, "doc_id bigint, score double, predicted int")
