"""How filters interact, from decision diagrams of their failures.

A document's failures are a mask of one bit per filter. Per part, a decision diagram over the
filters holds the counts of all masks: each node tests one filter, its two edges lead to the
documents that pass and that fail, and it carries their counts. Two neighbouring levels can be
swapped by exchanging the inner two of the four subdiagrams below each upper node, so all orders
of the filters are reached by swaps of neighbours. In each order the path on which every filter
passes tells what every step keeps and removes.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwatch.llm.common import map_slices, whole_text

FILTERS = "ABCDE"
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_SIGNS = re.compile(rb"[#$%&*|]")


def own_failures(text: bytes) -> int:
    """The bits of the filters that look at one text alone: A to D."""
    words = text.split()  # bytes: the six ASCII blanks
    points = len(text) if text.isascii() else len(text.decode("utf-8"))
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    return (
        (len(words) < 200)
        | (100 * len(set(words)) < 50 * len(words)) << 1
        | (100 * capitals > 3 * points) << 2
        | bool(_SIGNS.search(text)) << 3
    )


def failure_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part and mask of failures: the documents ``n``, and of them ``good`` and ``toxic``.

    Only digests, ids and counts are shuffled. Equal texts share a digest, which alone would
    gather all copies in one task; the search for each smallest id is reduced before the
    shuffle and met again by digest and id.
    """

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        texts = part.column("text").cast(pa.binary()).to_pylist()
        return pa.RecordBatch.from_arrays(
            [
                part.column("doc_id"),
                part.column("part"),
                pa.array([own_failures(t) for t in texts], pa.int32()),
                pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
            ],
            ["doc_id", "part", "mask", "digest"],
        )

    source = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        whole_text().alias("text"),
    )
    masked = map_slices(source, work, "doc_id bigint, part string, mask int, digest binary")
    same = masked.groupBy("digest", "doc_id", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    # of equal texts the smallest id passes E; ids make the keys of this join, so copies spread
    first = same.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("is_first", F.lit(True))
    repeats = 1 << FILTERS.index("E")
    alone = same.alias("s").join(
        first.alias("f"),
        (F.col("s.digest") == F.col("f.digest")) & F.col("s.doc_id").eqNullSafe(F.col("f.doc_id")),
        "left",
    ).select(
        "s.doc_id",
        "s.part",
        F.when(F.col("is_first"), F.col("mask")).otherwise(F.col("mask") + repeats).alias("mask"),
        "s.n",
        F.when(F.col("s.doc_id").isNull(), F.col("s.digest")).alias("no_id"),
    )
    told = (
        labels.filter("doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").cast("bigint").alias("labelled"))
        .agg(F.max(F.col("quality") == 1).alias("is_good"), F.max(F.col("toxic") == 1).alias("is_toxic"))
        .withColumn("no_digest", F.lit(None).cast("binary"))
    )
    # rows without an id match no label; their digests keep them from meeting in one task
    known = alone.join(
        told, (F.col("doc_id") == F.col("labelled")) & F.col("no_id").eqNullSafe(F.col("no_digest")), "left"
    )
    return known.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("is_good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("is_toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )


@dataclass
class Node:
    """Tests one filter. ``counts`` are those of all documents below; leaves test nothing."""

    counts: np.ndarray
    passes: Node | None = None
    fails: Node | None = None


def diagram(counts: np.ndarray) -> Node:
    """The diagram in the order of FILTERS; ``counts`` has one row per mask."""

    def below(level: int, mask: int) -> Node:
        if level == len(FILTERS):
            return Node(counts[mask])
        passes, fails = below(level + 1, mask), below(level + 1, mask | 1 << level)
        return Node(passes.counts + fails.counts, passes, fails)

    return below(0, 0)


def swap(root: Node, level: int) -> None:
    """Exchange a level with the next one: only nodes of these two levels change."""
    upper = [root]
    for _ in range(level):
        upper = [child for node in upper for child in (node.passes, node.fails)]
    for node in upper:
        a, b = node.passes, node.fails
        both, first, second, none = a.passes, a.fails, b.passes, b.fails
        node.passes = Node(both.counts + second.counts, both, second)
        node.fails = Node(first.counts + none.counts, first, none)


def plain_changes(n: int) -> Iterator[int]:
    """Places of the swaps of neighbours that go through all orders of n things."""
    if n < 2:
        return
    down = True
    inner = plain_changes(n - 1)
    while True:
        yield from range(n - 2, -1, -1) if down else range(n - 1)
        at = next(inner, None)
        if at is None:
            return
        yield at + 1 if down else at
        down = not down


def all_pass_path(root: Node) -> list[tuple[np.ndarray, np.ndarray]]:
    """What each step keeps and removes."""
    steps, node = [], root
    while node.passes is not None:
        steps.append((node.passes.counts, node.fails.counts))
        node = node.passes
    return steps


def audit_part(counts: np.ndarray) -> pd.DataFrame:
    """The rows of one part from its counts (documents, good, toxic) of every mask."""
    masks = np.arange(len(counts))
    failing = [counts[masks >> f & 1 == 1, 0].sum() for f in range(len(FILTERS))]
    only = [counts[1 << f, 0] for f in range(len(FILTERS))]
    root, order, rows = diagram(counts), list(range(len(FILTERS))), []
    shapley = np.zeros(len(FILTERS), np.int64)

    def read() -> None:
        name = "".join(FILTERS[f] for f in order)
        for step, (f, (kept, removed)) in enumerate(zip(order, all_pass_path(root), strict=True), 1):
            shapley[f] += removed[0]
            rows.append((name, step, f, kept[0], removed[0], failing[f] - removed[0], only[f], removed[1], removed[2]))

    read()
    for level in plain_changes(len(FILTERS)):
        swap(root, level)
        order[level], order[level + 1] = order[level + 1], order[level]
        read()
    found = pd.DataFrame(
        rows,
        columns=["filter_order", "step", "f", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"],
    )
    found["shapley"] = shapley[found.pop("f")]
    return found


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, filter_order (all 120) and step (1 to 5), zeros included.

    Filters fail a document on its whole text (NULL: empty) if A: it has under 200 words; B:
    under half of its words are distinct; C: over 3 % of its code points are A to Z; D: it holds
    one of ``#$%&*|``; E: its text equals that of a row with a smaller id, anywhere in the table.
    A part is a value of lang; NULL is the empty string. ``kept`` and ``removed`` count this
    step; ``redundant`` fail its filter but were removed before; ``unique_fails`` fail no other;
    ``good_lost`` and ``toxic_lost`` are those removed with labels quality = 1 and toxic = 1;
    ``shapley`` is the sum of the filter's ``removed`` over all orders.

    Rows of equal id and text neither precede each other: all of them pass or fail E together. A
    row without an id comes after all that have one; rows without ids don't precede each other.
    Several labels of one id count as good or toxic if any is; labels without an id and unknown
    labels (NULL) count as neither. An empty table gives an empty result. Other columns are not read.
    """

    def audited(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        counts = np.zeros((1 << len(FILTERS), 3), np.int64)
        counts[rows["mask"].to_numpy()] = rows[["n", "good", "toxic"]].to_numpy()
        found = audit_part(counts)
        found.insert(0, "part", key[0])
        return found

    layout = (
        "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, "
        "unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint"
    )
    return failure_counts(docs, labels).groupBy("part").applyInPandas(audited, layout)  # 32 rows a part at most
