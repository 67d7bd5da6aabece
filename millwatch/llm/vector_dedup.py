"""Near-duplicate vectors by cross-polytope hashing.

A table of the index turns a vector by a few fast rotations (signs, then a Hadamard transform,
three times each) and takes the axis it comes closest to, with its sign; these axes together are
the code of its bucket. It is also placed in the buckets it almost fell into (probes). Vectors
that share a bucket are candidates.

Buckets are first compared by short sketches of signs, so that full vectors travel only to
buckets where they have likely company, and are compared there exactly. A pair is counted in
the first bucket it shares, so counts need no list of pairs. Every bucket is searched whole;
one with many members is cut into blocks, and every pair of its blocks is a group of its own.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwatch.llm.common import written
from millwatch.llm.simhash import HUB_PARTS, components
from millwatch.llm.vectors import counted, flat_components

#: Buckets of one table a vector is placed in: its own and the nearest others.
PROBES = 4

#: Share of the pairs at the least cosine that the number of tables is chosen for.
RECALL = 0.995

#: Vectors for each bucket of one table on average: more vectors, longer codes.
PER_BUCKET = 16

#: Random pairs at the least cosine from which a table's recall is measured.
_TRIED = 4000

SKETCH_BITS = 128

#: Most members of a group of sketches and of a group of whole vectors; larger buckets are cut.
SKETCH_BLOCK, VECTOR_BLOCK = 32_768, 2048

_SEED = 11


def transformed(x: np.ndarray) -> np.ndarray:
    """The Hadamard transform of each row, by additions and subtractions of halves."""
    rows, width = x.shape
    half = 1
    while half < width:
        pairs = x.reshape(rows, width // (2 * half), 2, half)
        x = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), axis=2)
        half *= 2
    return x.reshape(rows, width) / math.sqrt(width)


@dataclass(frozen=True)
class Hashing:
    """Rotations and sketch planes for vectors of one padded width."""

    width: int
    functions: int
    tables: int
    probes: int

    def signs(self, table: int) -> np.ndarray:
        draw = np.random.default_rng((_SEED, self.width, table))
        return draw.choice([-1.0, 1.0], size=(self.functions, 3, self.width))

    def codes(self, unit: np.ndarray, table: int) -> np.ndarray:
        """The codes of the buckets of each row in a table, its own first."""
        n = len(unit)
        code, cost = np.zeros((n, 1), np.int64), np.zeros((n, 1))
        for signs in self.signs(table):
            turned = unit
            for one in signs:
                turned = transformed(turned * one)
            ends = np.concatenate((turned, -turned), axis=1)
            most = min(self.probes, ends.shape[1])
            near = np.argpartition(-ends, most - 1, axis=1)[:, :most]
            height = np.take_along_axis(ends, near, axis=1)
            order = np.lexsort((near, -height), axis=1)
            near, height = (np.take_along_axis(v, order, axis=1) for v in (near, height))
            code = (code[:, :, None] * (2 * self.width) + near[:, None, :]).reshape(n, -1)
            fall = (height[:, :1] - height) ** 2
            cost = (cost[:, :, None] + fall[:, None, :]).reshape(n, -1)
            best = np.argsort(cost, axis=1, kind="stable")[:, : self.probes]
            code, cost = (np.take_along_axis(v, best, axis=1) for v in (code, cost))
        return (code % 2_147_483_647).astype(np.int32)  # shared remainders only add candidates

    def all_codes(self, unit: np.ndarray) -> np.ndarray:
        """Rows x tables x probes."""
        return np.stack([self.codes(unit, t) for t in range(self.tables)], axis=1)

    def sketches(self, unit: np.ndarray) -> np.ndarray:
        """The sides of random planes each row lies on, as two 64-bit words."""
        planes = np.random.default_rng((_SEED, self.width)).normal(size=(self.width, SKETCH_BITS))
        return np.packbits(unit @ planes > 0, axis=1).view(np.uint64)


def padded_width(components_: int) -> int:
    return 1 << max(1, (components_ - 1).bit_length())


def fitted(width: int, vectors: int, least: float, probes: int = PROBES, recall: float = RECALL) -> Hashing:
    """Codes long enough for that many vectors, and tables enough for the recall.

    The recall of one table is measured on random pairs of exactly the least cosine; closer
    pairs are found more often.
    """
    functions = max(1, math.ceil(math.log(max(1.0, vectors / PER_BUCKET), 2 * width)))
    draw = np.random.default_rng((_SEED, width, functions))
    a, b = draw.normal(size=(2, _TRIED, width))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    one = Hashing(width, functions, 1, probes)
    met = [one.codes(v, 0) for v in (a, least * a + math.sqrt(1 - least * least) * b)]
    found = (met[0][:, :, None] == met[1][:, None, :]).any(axis=(1, 2)).mean()
    found = min(max(float(found), 1 / _TRIED), 1 - 1e-9)
    tables = max(1, math.ceil(math.log(1 - recall) / math.log(1 - found)))
    return Hashing(width, functions, tables, probes)


def most_bits_apart(least: float) -> int:
    """Sketch bits in which pairs of the least cosine differ, 4.5 deviations above the mean."""
    apart = math.acos(least) / math.pi
    return math.ceil(SKETCH_BITS * apart + 4.5 * math.sqrt(SKETCH_BITS * apart * (1 - apart)))


def units(payloads: list[bytes], wide: bool, n: int) -> np.ndarray:
    """The stored vectors of ``n`` components as rows of length one, in double precision."""
    x = np.frombuffer(b"".join(payloads), "<f8" if wide else "<f4").reshape(-1, n).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # before squares can leave the range
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def padded(unit: np.ndarray) -> np.ndarray:
    return np.pad(unit, ((0, 0), (0, padded_width(unit.shape[1]) - unit.shape[1])))


def comparable(vectors: DataFrame) -> DataFrame:
    """vec_id, the bytes of the vector (``payload``), whether they are doubles (``wide``) and the
    number ``n`` of components; all but the id NULL for vectors that link with nothing."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, starts = flat_components(batch.column("embedding"))
            wide = flat.dtype == np.float64
            usable = (counted(~np.isfinite(flat), starts) == 0) & (counted(flat != 0, starts) > 0)
            octets = np.ascontiguousarray(flat).tobytes()
            ends = (starts * flat.itemsize).tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    pa.array(
                        [octets[ends[k] : ends[k + 1]] if ok else None for k, ok in enumerate(usable.tolist())],
                        pa.binary(),
                    ),
                    pa.array([wide if ok else None for ok in usable.tolist()], pa.bool_()),
                    pa.array(np.diff(starts), pa.int32(), mask=~usable),
                ],
                ["vec_id", "payload", "wide", "n"],
            )

    source = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
    return source.mapInArrow(work, "vec_id bigint, payload binary, wide boolean, n int")


def by_shape(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The rows of each number of components: their places and their unit vectors."""
    shapes = np.asarray(batch.column("n")) * 2 + np.asarray(batch.column("wide").cast(pa.int32()))
    for shape in np.unique(shapes).tolist():
        rows = np.flatnonzero(shapes == shape)
        yield rows, units(batch.column("payload").take(pa.array(rows)).to_pylist(), bool(shape % 2), shape // 2)


def coded(classes: DataFrame, hashing: dict[int, Hashing]) -> DataFrame:
    """The codes of each vector's buckets, by table, and its sketch: node, n, codes, sketch0, sketch1."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, n = np.asarray(batch.column("node")), np.asarray(batch.column("n"))
            for rows, unit in by_shape(batch):
                wide = padded(unit)
                use = hashing[wide.shape[1]]
                codes, sketch = use.all_codes(wide), use.sketches(wide)
                tables = pa.ListArray.from_arrays(
                    np.arange(codes.shape[0] * codes.shape[1] + 1, dtype=np.int32) * codes.shape[2], codes.ravel()
                )
                each = np.arange(codes.shape[0] + 1, dtype=np.int32) * codes.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(nodes[rows]),
                        pa.array(n[rows]),
                        pa.ListArray.from_arrays(each, tables),
                        *[pa.array(np.ascontiguousarray(sketch[:, k]).view(np.int64)) for k in (0, 1)],
                    ],
                    ["node", "n", "codes", "sketch0", "sketch1"],
                )

    layout = "node bigint, n int, codes array<array<int>>, sketch0 bigint, sketch1 bigint"
    return classes.select("node", "payload", "wide", "n").mapInArrow(work, layout)


def placed(codes: DataFrame) -> DataFrame:
    """Every bucket (n, slot, code) a vector is placed in, with its node and its sketch."""
    tables = codes.select("n", "node", "sketch0", "sketch1", F.posexplode("codes").alias("slot", "each"))
    return tables.select("n", "slot", F.explode("each").alias("code"), "node", "sketch0", "sketch1")


_BUCKET = ["n", "slot", "code"]
_GROUP = [*_BUCKET, "one", "other"]


def blocked(members: DataFrame, most: int) -> DataFrame:
    """The members of buckets that have company, in groups (bucket, one, other) of two blocks.

    A bucket of up to ``most`` members is one block. A hot one is cut by a hash of its members,
    and each pair of blocks is a group, so that no task holds more than two blocks of it. Members
    learn the size of their bucket by parts of it, so this gathers no hot bucket either.
    """
    members = members.withColumn("part", F.pmod(F.xxhash64("node"), F.lit(HUB_PARTS)))
    parts = members.groupBy(*_BUCKET, "part").agg(F.count(F.lit(1)).alias("members"))
    sizes = parts.groupBy(*_BUCKET).agg(F.sum("members").alias("members")).filter("members > 1")
    known = parts.select(*_BUCKET, "part").join(sizes, _BUCKET)
    cut = members.join(known, [*_BUCKET, "part"])
    return (
        cut.withColumn("blocks", F.ceil(F.col("members") / most).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("partner", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"one": F.least("block", "partner"), "other": F.greatest("block", "partner")})
        .drop("part", "members", "blocks", "partner")
    )


def per_group(
    grouped: DataFrame, work: Callable[[tuple, pa.RecordBatch], list[pa.RecordBatch]], layout: str
) -> DataFrame:
    """Apply ``work`` to every group, whose rows come sorted by node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            if rest is not None:
                batch = pa.concat_batches([rest, batch])
            keys = np.column_stack([np.asarray(batch.column(c)) for c in _GROUP])
            ends = np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1
            starts = [0, *ends.tolist()]
            for a, b in zip(starts[:-1], starts[1:], strict=True):
                if b - a > 1:
                    yield from work(tuple(keys[a].tolist()), batch.slice(a, b - a))
            rest = batch.slice(starts[-1])  # the last group may go on in the next batch
        if rest is not None and rest.num_rows > 1:
            yield from work(tuple(int(rest.column(c)[0].as_py()) for c in _GROUP), rest)

    return grouped.repartition(*_GROUP).sortWithinPartitions(*_GROUP, "node").mapInArrow(run, layout)


def likely(entries: DataFrame, least: float, block: int = SKETCH_BLOCK) -> DataFrame:
    """The entries (n, slot, code, node) whose sketch is close to another's in their bucket."""
    most = most_bits_apart(least)

    def work(key: tuple, part: pa.RecordBatch) -> list[pa.RecordBatch]:
        words = np.column_stack([np.asarray(part.column(c)).view(np.uint64) for c in ("sketch0", "sketch1")])
        size = len(words)
        company = np.zeros(size, bool)
        # members near one of the first are settled at once, so a crowd costs little
        for first, last in ((0, min(64, size)), (min(64, size), size)):
            open_ = np.flatnonzero(~company)
            step = max(1, (1 << 21) // max(1, last - first))
            for at in range(0, len(open_), step):
                rows = open_[at : at + step]
                apart = np.bitwise_count(words[rows, None, 0] ^ words[None, first:last, 0]).astype(np.int16)
                apart += np.bitwise_count(words[rows, None, 1] ^ words[None, first:last, 1])
                close = apart <= most
                own = (rows >= first) & (rows < last)
                close[np.flatnonzero(own), rows[own] - first] = False
                i, j = np.nonzero(close)
                company[rows[i]] = True
                company[first + j] = True
        kept = np.flatnonzero(company)
        if not len(kept):
            return []
        same = [pa.array(np.full(len(kept), key[k]), pa.int32()) for k in range(3)]
        return [
            pa.RecordBatch.from_arrays([*same, part.column("node").take(pa.array(kept))], [*_BUCKET, "node"])
        ]

    found = per_group(blocked(entries, block), work, "n int, slot int, code int, node bigint")
    return found.distinct()  # members of cut buckets come once per pair of blocks


def linked(
    near: DataFrame, classes: DataFrame, codes: DataFrame, least: float, block: int = VECTOR_BLOCK
) -> DataFrame:
    """Per group: (a, b, 0) joins what is linked there, (a, NULL, n) counts new links of ``a``."""
    whole = near.join(classes.select("node", "payload", "wide", "weight"), "node")
    whole = whole.join(codes.select("node", "codes"), "node")

    def work(key: tuple, part: pa.RecordBatch) -> list[pa.RecordBatch]:
        n, slot, code, one, other = key
        node, weight, blocks = (np.asarray(part.column(c)) for c in ("node", "weight", "block"))
        size = len(node)
        unit = np.zeros((size, n))
        for rows, values in by_shape(part):
            unit[rows] = values
        close = np.zeros((size, size), bool)
        for at in range(0, size, 512):
            close[at : at + 512] = unit[at : at + 512] @ unit.T >= least
        np.fill_diagonal(close, False)
        if one != other:  # pairs inside one block have a group of their own
            close &= blocks[:, None] != blocks[None, :]
        close &= close.T  # sums may differ in the last bit by order
        if not close.any():
            return []
        flat = part.column("codes").flatten().flatten().to_numpy()
        places = flat.reshape(size, len(part.column("codes")[0]), -1)
        new = np.zeros(size, np.int64)
        for at in range(0, size, 256):
            i, j = np.nonzero(close[at : at + 256])
            i += at
            for t in range(slot):  # pairs that share a bucket of an earlier table were counted there
                met = (places[i, t, :, None] == places[j, t, None, :]).any(axis=(1, 2))
                i, j = i[~met], j[~met]
            both = places[i, slot, :, None] == places[j, slot, None, :]
            before = both & (places[i, slot] < code)[:, :, None]
            first = ~before.any(axis=(1, 2))
            np.add.at(new, i[first], weight[j[first]])
        root = np.arange(size)
        while True:
            lower = root.copy()
            for at in range(0, size, 512):
                reach = np.where(close[at : at + 512], root[None, :], size).min(axis=1)
                lower[at : at + 512] = np.minimum(root[at : at + 512], reach)
            lower = lower[lower]
            if np.array_equal(lower, root):
                break
            root = lower
        moved, gained = np.flatnonzero(root != np.arange(size)), np.flatnonzero(new)
        a = np.concatenate((node[root[moved]], node[gained]))
        b = pa.array([*node[moved].tolist(), *[None] * len(gained)], pa.int64())
        count = np.concatenate((np.zeros(len(moved), np.int64), new[gained]))
        return [pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), b, pa.array(count)], ["a", "b", "links"])]

    return per_group(blocked(whole, block), work, "a bigint, b bigint, links bigint")


def near_vectors(vectors: DataFrame, least: float = 0.9, probes: int = PROBES, recall: float = RECALL) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding): vec_id, n_links, component_id, kept.

    Pairs found with a cosine of ``least`` or more, in double precision, are linked; none below
    it is. ``n_links`` counts the other rows linked directly, ``component_id`` is the smallest
    vec_id reachable, itself included, ``kept`` tells whether that is its own.

    Rows of equal vectors are one class while searching and count one by one. Vectors that are
    NULL, empty, zero or hold NULL or non-finite components link with nothing, nor do vectors of
    different numbers of components. Rows without an id belong to a component but never name it;
    where no row has one, component_id is NULL and all are kept, as are rows that repeat the
    smallest id. An empty table gives an empty result. Other columns are not read.
    """
    rows = comparable(vectors)
    classes = written(
        rows.filter("payload IS NOT NULL")
        .groupBy("payload", "wide", "n")
        .agg(F.min("vec_id").alias("least_id"), F.count(F.lit(1)).alias("weight"))
        .withColumn("digest", F.sha2("payload", 256))
        .withColumn("node", F.monotonically_increasing_id()),  # fixed by being written
        "vector-classes",
    )
    padded_to = F.pow(F.lit(2), F.ceil(F.log2(F.greatest("n", F.lit(2))))).cast("int")  # 31 values at most
    widths = classes.groupBy(padded_to.alias("width")).agg(F.count(F.lit(1)).alias("vectors")).collect()
    hashing = {w["width"]: fitted(w["width"], w["vectors"], least, probes, recall) for w in widths}
    codes = written(coded(classes, hashing), "vector-codes")
    near = written(likely(placed(codes), least), "vector-company")
    found = written(linked(near, classes, codes, least), "vector-links")
    counts = found.filter("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    roots = components(found.filter("b IS NOT NULL").select("a", "b"))
    rooted = (
        classes.select("node", "digest", "wide", "least_id", "weight")
        .join(roots, "node", "left")
        .join(counts, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    least_ids = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = rooted.join(least_ids, "root").select(
        "digest", "wide", "component_id", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("links")
    )
    source = rows.select("vec_id", F.sha2("payload", 256).alias("digest"), "wide")
    linkable = source.filter("digest IS NOT NULL").join(named, ["digest", "wide"])
    apart = source.filter("digest IS NULL").select(
        "vec_id", F.lit(0).cast("bigint").alias("links"), F.col("vec_id").alias("component_id")
    )
    return (
        linkable.select("vec_id", "links", "component_id")
        .unionByName(apart)
        .select(
            "vec_id",
            F.col("links").alias("n_links"),
            "component_id",
            F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"),
        )
    )
