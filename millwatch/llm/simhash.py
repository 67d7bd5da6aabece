"""Near duplicates by SimHash, found with counts of bits per segment.

A fingerprint has 32 segments of two bits. The numbers of set bits of its segments are a
point of a grid with 32 axes, and the Manhattan distance of two such points is at most the
number of bits in which the fingerprints differ. Fingerprints that differ in at most 4 bits
therefore agree in the counts of at least 4 of 8 blocks of four segments, so they share a
cell of the grid for one of the 70 choices of 4 blocks. Inside a cell the Manhattan distance
sorts out most pairs and the bits decide the rest.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwatch.llm.common import (
    map_slices,
    one_of_each,
    scratch_path,
    text_key,
    utf8,
    whole_text,
    written,
)

SEED = 42
BLOCKS = 8

#: Cells with more members are compared block against block, each pair of blocks by one task.
BLOCK_MEMBERS = 4096

#: Parts the neighbours of a node are dealt to while components are joined.
HUB_PARTS = 64

#: Shingles hashed at once: bounds the memory a very long text takes.
_HASHED_AT_ONCE = 1 << 16


def fingerprint(text: bytes, words: int = 4) -> int:
    """SimHash of a text in UTF-8: a bit is set if it is in over half of the shingles' hashes."""
    found = text.lower().split()  # bytes: A-Z, and the six ASCII blanks
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found])
    starts = np.concatenate(([0], ends[:-1]))
    if len(found) > words:
        starts, ends = starts[: 1 - words], ends[words - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest, total = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(starts), _HASHED_AT_ONCE):
        part = slice(at, at + _HASHED_AT_ONCE)
        hashes = [
            digest(joined[a:b], SEED)
            for a, b in zip(starts[part].tolist(), (ends[part] - 1).tolist(), strict=True)
        ]
        total += _bit_totals(np.array(hashes, "<u8"))
    return _majority(total, len(starts))


def _bit_totals(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set."""
    octets = hashes.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8)
    return np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def _majority(total: np.ndarray, n: int) -> int:
    bits = np.packbits(2 * total > n, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprint_of_set(hashes: np.ndarray) -> int:
    """SimHash of a set of shingles, given as hashes; an empty set has fingerprint zero."""
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _HASHED_AT_ONCE):
        total += _bit_totals(hashes[at : at + _HASHED_AT_ONCE].view(np.uint64))
    return _majority(total, len(hashes))


def fingerprints(docs: DataFrame, words: int = 4, keyed: bool = False) -> DataFrame:
    """doc_id and the fingerprint ``fp`` (64 bits as a signed bigint) of every row, and where
    ``keyed`` the text_key."""

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([fingerprint(t, words) for t in utf8(part.column("text"))], np.uint64)
        columns = {"doc_id": part.column("doc_id"), "fp": pa.array(found.view(np.int64))}
        if keyed:
            columns["text_key"] = part.column("text_key")
        return pa.RecordBatch.from_pydict(columns)

    key = [text_key().alias("text_key")] if keyed else []
    source = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"), *key
    )
    return map_slices(source, work, "doc_id bigint, fp bigint" + ", text_key binary" * keyed)


_LOW = 0x5555555555555555


def segment_counts(fp: Column) -> Column:
    """Bits set in each two-bit segment, written in unary: 00, 01 or 11 for 0, 1 and 2.

    The Manhattan distance of two such points is the number of bits in which they differ.
    """
    high = F.shiftrightunsigned(fp, 1)
    some = fp.bitwiseOR(high).bitwiseAND(F.lit(_LOW))
    both = fp.bitwiseAND(high).bitwiseAND(F.lit(_LOW))
    return some.bitwiseOR(F.shiftleft(both, 1))


def _unary_counts(fp: np.ndarray) -> np.ndarray:
    low, one = np.uint64(_LOW), np.uint64(1)
    return ((fp | (fp >> one)) & low) | ((fp & (fp >> one) & low) << one)


def cell_masks(bits: int, blocks: int = BLOCKS) -> list[int]:
    """For each choice of the blocks that must agree, the mask of their segments (signed)."""
    if not 0 <= bits < blocks:
        raise ValueError(f"at most {blocks - 1} bits may differ with {blocks} blocks")
    width = 64 // blocks
    masks = []
    for chosen in combinations(range(blocks), blocks - bits):
        mask = sum(((1 << width) - 1) << (width * b) for b in chosen)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    assert len(masks) == comb(blocks, bits)
    return masks


def linked_roots(fp: np.ndarray, bits: int) -> np.ndarray:
    """For the members of a cell, the smallest member each reaches over links inside it."""
    n, root, counts = len(fp), np.arange(len(fp)), _unary_counts(fp)
    rows = max(1, (1 << 20) // max(n, 1))
    while True:
        before = root.copy()
        for at in range(0, n, rows):
            part = slice(at, at + rows)
            near = np.bitwise_count(counts[part, None] ^ counts[None, :]) <= bits
            i, j = np.nonzero(near)
            true = np.bitwise_count(fp[part][i] ^ fp[j]) <= bits
            i, j = i[true], j[true]
            np.minimum.at(root, i + at, root[j])
        root = np.minimum(root, root[root])
        if np.array_equal(root, before):
            return root


def _cell_links(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Reads members sorted by cell; gives, per cell, an edge from each member to its root."""

    def links(keys: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        new = np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1
        starts = np.concatenate(([0], new))
        ends = np.concatenate((new, [len(fp)]))
        sizes, a, b = ends - starts, [], []
        pairs = starts[sizes == 2]  # most cells with company hold two
        near = np.bitwise_count(fp[pairs] ^ fp[pairs + 1]) <= bits
        a.append(fp[pairs[near]])
        b.append(fp[pairs[near] + 1])
        for s, e in zip(starts[sizes > 2].tolist(), ends[sizes > 2].tolist(), strict=True):
            root = linked_roots(fp[s:e], bits)
            moved = np.flatnonzero(root != np.arange(e - s))
            a.append(fp[s:e][root[moved]])
            b.append(fp[s:e][moved])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)], ["a", "b"]
        )

    keys, fp = np.zeros((0, 4), np.int64), np.zeros(0, np.uint64)
    for batch in batches:
        columns = [batch.column(c).to_numpy() for c in ("choice", "cell", "one", "other")]
        keys = np.concatenate((keys, np.column_stack([c.astype(np.int64) for c in columns])))
        fp = np.concatenate((fp, batch.column("fp").to_numpy().view(np.uint64)))
        whole = np.flatnonzero(np.any(keys != keys[-1], axis=1)) if len(keys) else []
        if len(whole):  # the last cell may go on in the next batch
            upto = whole[-1] + 1
            yield links(keys[:upto], fp[:upto])
            keys, fp = keys[upto:], fp[upto:]
    if len(fp):
        yield links(keys, fp)


def links(distinct: DataFrame, bits: int = 4, block_members: int = BLOCK_MEMBERS) -> DataFrame:
    """Edges (a, b) that join exactly the fingerprints reachable over links of ``bits`` bits.

    ``distinct`` holds each fingerprint ``fp`` once. Every link lies in some cell. A cell
    gives each member an edge to the smallest it reaches there, not all pairs. A cell of many
    members is cut into blocks, and every pair of its blocks is compared by its own task.
    """
    masks = F.array(*[F.lit(m).cast("bigint") for m in cell_masks(bits)])
    placed = distinct.select("fp", F.posexplode(masks).alias("choice", "mask")).select(
        "choice",
        segment_counts(F.col("fp")).bitwiseAND(F.col("mask")).alias("cell"),
        "fp",
    )
    sizes = placed.groupBy("choice", "cell").agg(F.count(F.lit(1)).alias("members"))
    shared = placed.join(sizes.filter("members > 1"), ["choice", "cell"])
    blocks = F.ceil(F.col("members") / F.lit(block_members)).cast("int")
    block = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    paired = (
        shared.withColumn("blocks", blocks)
        .withColumn("block", block)
        .withColumn("with_block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "choice",
            "cell",
            F.least("block", "with_block").alias("one"),
            F.greatest("block", "with_block").alias("other"),
            "fp",
        )
    )
    keys = ["choice", "cell", "one", "other"]
    found = (
        paired.repartition(*keys)
        .sortWithinPartitions(*keys, "fp")
        .mapInArrow(lambda batches: _cell_links(batches, bits), "a bigint, b bigint")
    )
    return found.distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node on an edge; root is the smallest node of its component.

    Alternating rounds: all larger neighbours of a node are joined to its smallest neighbour,
    then all smaller ones. Each round is a table in the shared folder, so the plan stays
    short and lost executors cost one round.
    """
    spark = edges.sparkSession

    def rewired(links_: DataFrame, larger: bool) -> DataFrame:
        """Join neighbours of each node to the smallest of node and neighbours."""
        if larger:
            both = links_.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
                links_.select(F.col("b").alias("u"), F.col("a").alias("v"))
            )
        else:  # the smaller neighbours of b are the a of its edges
            both = links_.select(F.col("b").alias("u"), F.col("a").alias("v"))
        # a node with very many neighbours meets its smallest one part by part
        both = both.withColumn("part", F.pmod(F.xxhash64("v"), F.lit(HUB_PARTS)))
        parts = both.groupBy("u", "part").agg(F.min("v").alias("m"))
        least = parts.groupBy("u").agg(F.min("m").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        joined = both.join(parts.select("u", "part").join(least, "u"), ["u", "part"])
        if larger:
            return joined.filter("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
        return joined.select(F.col("m").alias("a"), F.col("v").alias("b")).union(
            least.select(F.col("m").alias("a"), F.col("u").alias("b"))
        )

    def tidy(links_: DataFrame, name: str) -> tuple[DataFrame, tuple]:
        """The edges from smaller to larger node, each once, and a checksum of them."""
        ordered = links_.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        path = scratch_path(spark, name)
        ordered.filter("a < b").distinct().write.parquet(path)
        table = spark.read.schema("a bigint, b bigint").parquet(path)
        mark = F.xxhash64("a", "b").cast("decimal(20,0)")
        return table, tuple(table.agg(F.count(F.lit(1)), F.sum(mark)).first())

    links_, mark = tidy(edges, "links")
    while mark[0]:
        links_, after = tidy(rewired(rewired(links_, True), False), "links")
        if after == mark:
            break
        mark = after
    return links_.select(F.col("b").alias("node"), F.col("a").alias("root")).union(
        links_.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    )


def rooted_prints(prints: DataFrame, bits: int) -> DataFrame:
    """Each fingerprint once: fp, the least id of its rows, and the root of its component."""
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "distinct-fps")
    roots = components(links(distinct, bits))
    return distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root")
    )


def near_duplicates(docs: DataFrame, words: int = 4, bits: int = 4) -> DataFrame:
    """One row per row of ``docs``: doc_id, fp, component_id.

    ``fp`` is the fingerprint of the word shingles of the lower-cased (A-Z) whole text;
    fingerprints that differ in at most ``bits`` bits are linked; ``component_id`` is the
    smallest ``doc_id`` reachable over links. Copies share a fingerprint and enter the search
    once.

    NULL and empty texts have fingerprint 0, which links like any other. Fewer than ``words``
    words are one shingle. Rows without an id belong to a component but never name it; where
    no row has one, its id is NULL. Repeated rows give repeated rows. An empty table gives an
    empty result. Other columns are not read.
    """
    prints = written(fingerprints(docs, words), "fingerprints")
    rooted = rooted_prints(prints, bits)
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = rooted.select("fp", "root").join(least, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one_of_each(docs: DataFrame, words: int = 4, bits: int = 4) -> DataFrame:
    """One row of each component, with all its columns: that of the smallest id.

    Rows are told apart by id and text. Those without an id come last; of equal or lacking ids
    the smallest text key stays. Rows that repeat id and text count once.
    """
    prints = written(fingerprints(docs, words, keyed=True), "fingerprints")
    rooted = prints.join(rooted_prints(prints, bits).select("fp", "root"), "fp")
    return one_of_each(docs, rooted)


def hex16(fp: str | Column = "fp") -> Column:
    fp = F.col(fp) if isinstance(fp, str) else fp
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
