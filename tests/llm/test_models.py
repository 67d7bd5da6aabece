"""Language and toxicity models: the sums against enumeration, held-out accuracy, hard rows."""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from millwatch.llm import langid, toxicity
from millwatch.llm.queries import PIECES


def by_enumeration(word, probability, vocab):
    """Sum over all ways of cutting the word, one by one."""
    marked = "▁" + word
    cut = langid.lattice([word], vocab)
    edges = {(i, j): p for i, j, p in zip(cut.start, cut.end, cut.piece, strict=True)}
    total = np.zeros(probability.shape[1])
    inner = range(1, len(marked))
    for n in range(len(marked)):
        for cuts in combinations(inner, n):
            ends = [0, *cuts, len(marked)]
            parts = [edges.get(e) for e in zip(ends, ends[1:], strict=False)]
            if None not in parts:
                total += np.prod(probability[parts], axis=0)
    return total


@pytest.mark.parametrize("word", ["a", "the", "tion", "straße", "été", "漢a", "nation"])
def test_forward_sums_all_segmentations(word):
    vocab = langid.vocabulary(PIECES)
    probability = np.random.default_rng(1).random((vocab.n_pieces + 1, 3))
    got = np.exp(langid.forward(langid.lattice([word, "x" * 3], vocab), probability)[0])
    assert np.allclose(got, by_enumeration(word, probability, vocab))


def test_long_words_do_not_underflow():
    vocab = langid.vocabulary(PIECES)
    probability = np.full((vocab.n_pieces + 1, 2), 1e-5)
    words = ["tion" * 20, "ab" * 3000]
    logs = langid.forward(langid.lattice(words, vocab), probability)
    assert np.isfinite(logs).all() and logs[1, 0] < -5000
    alone = langid.forward(langid.lattice(words[:1], vocab), probability)
    assert np.allclose(logs[0], alone[0])
    short = langid.forward(langid.lattice(["tion" * 8], vocab), probability)
    beside = langid.forward(langid.lattice(["tion" * 8, "ab" * 30], vocab), probability)
    assert np.allclose(short[0], beside[0])  # with and without the running scale


def test_expected_uses_add_up():
    vocab = langid.vocabulary(PIECES)
    probability = np.random.default_rng(2).random((vocab.n_pieces + 1, 2)) / 100
    cut = langid.lattice(["nation"], vocab)
    uses = langid.expected_uses(cut, probability, np.array([[3.0, 0.0]]))
    assert uses[:, 1].sum() == 0
    letters = np.bincount(cut.piece, (cut.end - cut.start).astype(float), len(uses)) / np.maximum(
        np.bincount(cut.piece, minlength=len(uses)), 1
    )
    assert np.isclose((uses[:, 0] * letters).sum(), 3 * 7)  # every segmentation covers 7 signs


SYLLABLES = {"en": ["th", "ing", "er", "and", "wh"], "fr": ["eau", "tre", "ou", "qu", "é"], "de": ["sch", "ung", "ei", "ü", "pf"]}


def corpus(rng, n):
    rows = []
    for k in range(n):
        lang = rng.choice(list(SYLLABLES))
        words = ["".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(rng.randint(3, 30))]
        rows.append((k, " ".join(words), lang, "s"))
    return rows


def test_languages_held_out(documents):
    rows = corpus(random.Random(1), 300)
    docs = documents(*rows)
    model = langid.fit(docs, F.col("doc_id") % 2 == 0, PIECES)
    assert model.languages == ["de", "en", "fr"]
    got = {r.doc_id: r for r in langid.identify(docs, model).collect()}
    right = [got[d].lang_pred == lang for d, _, lang, _ in rows if d % 2]
    assert np.mean(right) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_of_hard_rows(hard_documents, documents, no_documents):
    model = langid.fit(documents(*corpus(random.Random(2), 40)), F.lit(True), PIECES)
    got = langid.identify(hard_documents, model).collect()
    assert len(got) == 10
    undetermined = {r.doc_id: r.score for r in got if r.lang_pred == langid.UNDETERMINED}
    assert undetermined == {2: 0, 3: 0, 4: 0, 7: 0}
    kept = langid.keep_identified(hard_documents, model)
    assert kept.columns == hard_documents.columns and kept.filter("doc_id in (2, 3, 4, 7)").count() == 0
    empty = langid.fit(no_documents, F.lit(True), PIECES)
    assert {r.lang_pred for r in langid.identify(hard_documents, empty).collect()} == {"und"}
    assert langid.identify(no_documents, model).count() == 0


def test_predictions_hang_on_text_alone(documents):
    model = langid.fit(documents(*corpus(random.Random(3), 60)), F.lit(True), PIECES)
    docs = documents((1, "the thing and", "fr", "x"), (2, "the thing and", None, None))
    first, second = langid.identify(docs, model).collect()
    assert (first.lang_pred, first.score) == (second.lang_pred, second.score)


def toxic_corpus(rng, n):
    roots, ends = ["vequ", "lowei", "chlla"], ["ta", "eu", "do", "ment", "ch", "na", "ro", "ssi", "gu"]
    plain = ["".join(rng.choices(["an", "the", "ou", "re", "ti", "on", "st", "ea"], k=3)) for _ in range(400)]
    rows, labels = [], []
    for k in range(n):
        toxic = int(rng.random() < 0.3)
        words = rng.choices(plain, k=rng.randint(30, 120))
        if toxic:
            for _ in range(max(2, len(words) // 30)):
                words[rng.randrange(len(words))] = rng.choice(roots) + "".join(rng.choices(ends, k=2))
        rows.append((k, " ".join(words)))
        labels.append((k, 1, toxic))
    return rows, labels


def auc(score, label):
    order = np.argsort(np.argsort(score))
    pos = label == 1
    return (order[pos].mean() - (pos.sum() - 1) / 2) / (~pos).sum()


def test_unseen_forms_share_ngrams(spark, documents):
    rows, labels = toxic_corpus(random.Random(4), 500)
    docs = documents(*rows)
    frame = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    model = toxicity.fit(docs, frame, F.col("doc_id") % 5 != 0)
    got = {r.doc_id: r for r in toxicity.score_texts(docs, model).collect()}
    held = [(got[d].score, t) for d, _, t in labels if d % 5 == 0]
    assert auc(np.array([s for s, _ in held]), np.array([t for _, t in held])) > 0.9
    assert all((r.score >= 0.5) == (r.predicted == 1) for r in got.values())


def test_toxicity_of_hard_rows(spark, hard_documents, no_documents):
    labels = spark.createDataFrame([(1, 1, 0), (5, 1, 1), (6, 0, None), (None, 0, 1)], "doc_id bigint, quality int, toxic int")
    model = toxicity.fit(hard_documents, labels, F.lit(True))
    got = toxicity.score_texts(hard_documents, model).collect()
    assert len(got) == 10 and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (2, 3, 4)}) == 1
    assert toxicity.score_texts(no_documents, model).count() == 0
    none = toxicity.fit(no_documents, labels.limit(0), F.lit(True))
    assert {r.score for r in toxicity.score_texts(hard_documents, none).collect()} == {0.5}


def test_features_are_those_of_each_word():
    words = ["a", "idiot", "été", "漢字"]
    buckets, sizes = toxicity.features_of(words)
    each = [toxicity.features_of([w]) for w in words]
    assert sizes.tolist() == [len(b) for b, _ in each]
    assert buckets.tolist() == [x for b, _ in each for x in b]
    shared = set(each[1][0]) & set(toxicity.features_of(["idiots"])[0])
    assert len(shared) >= 6


def test_uses_of_long_words_in_logarithms():
    vocab = langid.vocabulary(PIECES)
    probability = np.random.default_rng(3).random((vocab.n_pieces + 1, 3)) / 50
    words = ["nation", "straße", "a", "tion" * 8]
    counts = np.random.default_rng(4).random((4, 3)) * 9
    cut = langid.lattice(words, vocab)
    plain = langid.expected_uses(cut, probability, counts)
    assert np.allclose(langid.expected_uses_of_long(cut, probability, counts), plain)
    long = langid.lattice(["tion" * 3000], vocab)  # far below the smallest double
    uses = langid.expected_uses(long, probability / 100, np.array([[2.0, 0.0, 1.0]]))
    assert np.isfinite(uses).all() and uses[:, 1].sum() == 0
    sizes = np.bincount(long.piece, (long.end - long.start).astype(float), len(uses)) / np.maximum(
        np.bincount(long.piece, minlength=len(uses)), 1
    )
    assert np.allclose((uses * sizes[:, None]).sum(axis=0), [2 * 12001, 0, 12001])


def test_languages_without_blanks(documents):
    """Runs of more than 40 letters count in the fit."""
    rng = random.Random(6)
    rows = []
    for k in range(200):
        lang = ["en", "fr"][k % 2]
        runs = ["".join(rng.choices(SYLLABLES[lang], k=40)) for _ in range(3)]
        rows.append((k, " ".join(runs), lang, "s"))
    docs = documents(*rows)
    model = langid.fit(docs, F.col("doc_id") < 100, PIECES)
    got = {r.doc_id: r.lang_pred for r in langid.identify(docs, model).collect()}
    assert sum(got[d] == lang for d, _, lang, _ in rows if d >= 100) > 95


def test_signs_and_numbers_are_no_letters(documents):
    docs = documents((1, "½ ² ③ 12 Ⅷ _ ́"), (2, "the ½"), (3, "ǅord"))
    model = langid.fit(documents((9, "the thing and", "en", "a")), F.lit(True), PIECES)
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(docs, model).collect()}
    assert got == {1: ("und", 0.0), 2: ("en", 1.0), 3: ("en", 1.0)}


def plain_score(text: str, model) -> float:
    """Every n-gram by itself, in Python's integers."""
    from zlib import crc32

    total, n = 0.0, 0
    for word in toxicity.words_of(text):
        marked = f"<{word}>"
        total, n = total + model.per_bucket[crc32(marked.encode()) % toxicity.BUCKETS], n + 1
        for size in range(toxicity.SHORTEST, toxicity.LONGEST + 1):
            for at in range(len(marked) - size + 1):
                mixed = ord(marked[at])
                for c in marked[at + 1 : at + size]:
                    mixed = (mixed * 0x100000001B3 + ord(c)) % 2**64
                spread = (mixed * 0x9E3779B97F4A7C15 % 2**64) >> 40
                total, n = total + model.per_bucket[spread % toxicity.BUCKETS], n + 1
    return 1 / (1 + np.exp(-((total / n if n else 0.0) + model.constant)))


def test_scores_equal_a_plain_sum(documents):
    draw = np.random.default_rng(5)
    model = toxicity.Model(draw.normal(size=toxicity.BUCKETS).astype(np.float32), 0.3)
    texts = ["", "a", "Whole words, and Signs!", "straße über 漢字 \U0001f600x", "word " * 500, "x" * 300, "two\nlines"]
    got = {r.doc_id: r.score for r in toxicity.score_texts(documents(*enumerate(texts)), model).collect()}
    assert all(np.isclose(got[k], plain_score(t, model)) for k, t in enumerate(texts))


def test_buckets_of_one_class_stay():
    """A bucket that all toxic texts have is learned from, however rare clean ones are."""
    rows = [([1, 2], 1)] * 60 + [([1, 3], 0)] * 5
    buckets = np.array([b for r, _ in rows for b in r])
    label = np.array([c for _, c in rows])
    model = toxicity.train(np.arange(0, 2 * len(rows) + 1, 2), buckets, np.full(len(buckets), 0.5, np.float32), label)
    assert model.per_bucket[1] == 0 and model.per_bucket[2] > 0 > model.per_bucket[3]


def test_long_words_are_not_remembered():
    scorer = toxicity.Scorer(toxicity.Model(np.zeros(toxicity.BUCKETS, np.float32), 0.0))
    scorer.score([f"{k}" * 100 for k in range(1, 50)])
    assert sum(map(len, scorer.known)) < 2000
