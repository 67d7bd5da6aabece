"""The audit of filters against a plain application of every order."""

from __future__ import annotations

import re
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from millwatch.llm import filter_audit
from millwatch.llm.filter_audit import FILTERS

LABELS = "doc_id bigint, quality int, toxic int"


def failures(rows):
    out = []
    for i, text, part in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        same = [j for j, other, _ in rows if (other or "") == text and j is not None]
        earlier = bool(same) and (i is None or min(same) < i)
        fails = [
            len(words) < 200,
            100 * len(set(words)) < 50 * len(words),
            100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            bool(re.search(r"[#$%&*|]", text)),
            earlier,
        ]
        out.append((part or "", i, dict(zip(FILTERS, fails, strict=True))))
    return out


def plain_audit(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    found, out = failures(rows), []
    for part in {p for p, _, _ in found}:
        docs = [(i, fails) for p, i, fails in found if p == part]
        shapley, mine = dict.fromkeys(FILTERS, 0), []
        for order in map("".join, permutations(FILTERS)):
            left = docs
            for step, f in enumerate(order, 1):
                kept, gone = [d for d in left if not d[1][f]], [d for d in left if d[1][f]]
                failing = [d for d in docs if d[1][f]]
                shapley[f] += len(gone)
                mine.append((part, order, step, len(kept), len(gone), len(failing) - len(gone),
                             sum(sum(d[1].values()) == 1 for d in failing),
                             sum(d[0] in good for d in gone), sum(d[0] in toxic for d in gone), f))
                left = kept
        out += [(*row[:-1], shapley[row[-1]]) for row in mine]
    return sorted(out)


@pytest.fixture
def corpus():
    draw = np.random.default_rng(12)
    rows = []
    for k in range(60):
        n = int(draw.integers(150, 260))
        vocabulary = int(draw.choice([40, 90, 400]))
        words = [f"w{draw.integers(0, vocabulary)}" for _ in range(n)]
        if k % 3 == 0:
            words = [w.upper() for w in words]
        if k % 4 == 0:
            words[3] = "#$"
        rows.append((k, " ".join(words), ["en", "de", None, ""][k % 4]))
    rows += [(100 + k, rows[k][1], "fr") for k in range(8)]  # copies in another part
    rows += [(3, rows[3][1], "en"), (3, rows[3][1], "de"), (None, rows[5][1], "en"), (None, "only without ids", "en"),
             (None, "only without ids", "en"), (200, None, None), (201, "", "de"), (202, "\x1c\x85\xa0 É" * 300, "en"),
             (203, "x " * 40_000, "en")]
    return rows


def test_audit_equals_plain_filters(spark, corpus):
    labels = [(k, k % 2, int(k % 5 == 0)) for k in range(0, 120, 3)] + [(3, None, 1), (3, 1, None), (None, 1, 1)]
    docs = spark.createDataFrame(corpus, "doc_id bigint, text string, lang string").withColumns(
        {c: F.lit("x") for c in ("mask", "part", "digest", "n", "good", "labelled", "is_first", "no_id")}
    )
    told = spark.createDataFrame(labels, LABELS).withColumn("part", F.lit(1))
    found = sorted(tuple(r) for r in filter_audit.filter_audit(docs, told).collect())
    assert found == plain_audit(corpus, labels)
    assert len(found) == 600 * 4


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([], LABELS)
    assert filter_audit.filter_audit(docs, labels).collect() == []
    one = spark.createDataFrame([(1, "a", "en")], "doc_id bigint, text string, lang string")
    rows = filter_audit.filter_audit(one, labels).collect()
    assert len(rows) == 600 and {r["part"] for r in rows} == {"en"}


def test_plain_changes_reach_every_order_once():
    for n in range(1, 7):
        order, seen = list(range(n)), [tuple(range(n))]
        for at in filter_audit.plain_changes(n):
            order[at], order[at + 1] = order[at + 1], order[at]
            seen.append(tuple(order))
        assert sorted(seen) == sorted(permutations(range(n)))


def test_a_swap_equals_building_anew():
    counts = np.random.default_rng(1).integers(0, 9, size=(32, 3))
    root = filter_audit.diagram(counts)
    filter_audit.swap(root, 2)
    masks = np.arange(32)
    turned = (masks & ~12) | (masks & 4) << 1 | (masks & 8) >> 1
    other = filter_audit.diagram(counts[turned])
    steps = [filter_audit.all_pass_path(r) for r in (root, other)]
    assert all((a[0] == b[0]).all() and (a[1] == b[1]).all() for a, b in zip(*steps, strict=True))
