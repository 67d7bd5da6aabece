"""Packing of token sequences by bin completion over the lengths.

Documents of one length are alike, so the problem is a table of lengths and their numbers,
with one row per length up to the capacity, whatever the corpus. Bins are completed around the
largest length left: undominated fillings of the rest are enumerated, least waste first, and
used as often as the numbers allow. The search goes back while the waste allowed by the best
solution so far permits; best-fit decreasing gives the first one. The solution is patterns
with a number of uses; each document finds its place by its rank among those of its length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millwatch.llm.byte_bpe import encoder
from millwatch.llm.common import map_slices, whole_text, written

CAPACITY = 1024

#: Search limits: fillings tried per node, and nodes in all. They bound the time of the search,
#: not the documents: the best solution found so far always holds all of them.
FILLINGS, NODES = 6, 6000

#: A filling with more items than this is taken as undominated without comparing subsets.
_COMPARED = 8

#: A bin's contents as (length, times), largest first; and how many such bins there are.
Pattern = tuple[tuple[int, int], ...]
Packing = list[tuple[Pattern, int]]


def n_bins(packing: Packing) -> int:
    return sum(times for _, times in packing)


def _with(pattern: Pattern, length: int, times: int) -> Pattern:
    if pattern and pattern[-1][0] == length:
        return (*pattern[:-1], (length, pattern[-1][1] + times))
    return (*pattern, (length, times))


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> Packing:
    """Each document, largest first, into the fullest bin that holds it.

    Bins alike are handled together: a bin that is the best fit stays so until it can't take
    another of the same length.
    """
    open_: dict[int, dict[Pattern, int]] = {capacity: {}}
    for length in sorted(counts, reverse=True):
        left = counts[length]
        for room in sorted(r for r in open_ if length <= r < capacity):
            fits, group = room // length, open_.get(room, {})
            for pattern in list(group):
                if not left:
                    break
                whole = min(group[pattern], left // fits)
                moves = [(whole, fits)] if whole else []
                left -= whole * fits
                if left and whole < group[pattern]:  # one bin takes what remains
                    moves.append((1, left))
                    left = 0
                for bins, times in moves:
                    group[pattern] -= bins
                    to = open_.setdefault(room - times * length, {})
                    new = _with(pattern, length, times)
                    to[new] = to.get(new, 0) + bins
                if not group[pattern]:
                    del group[pattern]
        fits = capacity // length
        for bins, times in ((left // fits, fits), (1, left % fits)):
            if bins and times:
                to = open_.setdefault(capacity - times * length, {})
                to[((length, times),)] = to.get(((length, times),), 0) + bins
    return [(p, n) for group in open_.values() for p, n in group.items() if n]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """No packing has fewer bins: total length, and what lengths over half leave no room for."""
    total = sum(s * n for s, n in counts.items())
    best = -(-total // capacity)
    for small in [0, *sorted(s for s in counts if 2 * s <= capacity)]:
        large = sum(n for s, n in counts.items() if s > capacity - small)
        middle = {s: n for s, n in counts.items() if capacity - small >= s and 2 * s > capacity}
        room = sum(n * (capacity - s) for s, n in middle.items())
        rest = sum(s * n for s, n in counts.items() if small <= s and 2 * s <= capacity)
        best = max(best, large + sum(middle.values()) + max(0, -(-(rest - room) // capacity)))
    return best


def _dominated(filling: Pattern, counts: dict[int, int], slack: int) -> bool:
    """Could some of its documents be exchanged for one at least as long that is left?

    Exchanging a set for a longer single document (within the slack), or for one of the same
    total, leaves shorter ones for later, which fit wherever the longer one would have.
    """
    items = [s for s, times in filling for _ in range(times)]
    if len(items) > _COMPARED:
        return False
    used = dict(filling)
    for size in range(1, len(items) + 1):
        for chosen in set(combinations(items, size)):
            total = sum(chosen)
            for s in range(total + (size == 1), total + slack + 1):
                if counts.get(s, 0) > used.get(s, 0):
                    return True
    return False


def fillings(counts: dict[int, int], room: int, most_waste: int, wanted: int) -> list[tuple[int, Pattern]]:
    """Undominated fillings of ``room`` as (waste, pattern), least waste first.

    Long documents are tried first. A bit set of the sums that shorter ones can reach cuts off
    what can't lead to the waste looked for.
    """
    sizes = sorted((s for s, n in counts.items() if n and s <= room), reverse=True)
    reach = [1] * (len(sizes) + 1)  # sums from sizes[k:]
    full = (1 << (room + 1)) - 1
    for k in range(len(sizes) - 1, -1, -1):
        sums, n, s = reach[k + 1], min(counts[sizes[k]], room // sizes[k]), sizes[k]
        step = 1
        while n > 0:  # 1, 2, 4 ... of them, as any number up to n is a sum of such
            step = min(step, n)
            sums |= (sums << (s * step)) & full
            n -= step
            step *= 2
        reach[k] = sums
    found: list[tuple[int, Pattern]] = []
    budget = 2000  # steps of the enumeration

    def extend(k: int, left: int, pattern: Pattern) -> Iterator[Pattern]:
        nonlocal budget
        if not left:
            yield pattern
            return
        for j in range(k, len(sizes)):
            if not reach[j] >> left & 1 or budget <= 0:
                return
            s = sizes[j]
            for times in range(min(counts[s], left // s), 0, -1):
                budget -= 1
                if reach[j + 1] >> (left - times * s) & 1:
                    yield from extend(j + 1, left - times * s, (*pattern, (s, times)))

    for waste in range(min(most_waste, room) + 1):
        if reach[0] >> (room - waste) & 1:
            first: Pattern | None = None
            for pattern in extend(0, room - waste, ()):
                first = first if first is not None else pattern
                if not _dominated(pattern, counts, waste):
                    found.append((waste, pattern))
                if len(found) >= wanted or budget <= 0:
                    break
            if not found and first is not None and budget <= 0:
                found.append((waste, first))
        if len(found) >= wanted or (found and budget <= 0):
            break
    return found


def pack_lengths(
    counts: dict[int, int], capacity: int, wanted: int = FILLINGS, nodes: int = NODES
) -> Packing:
    """As few bins as the search finds for documents given as {length: number}."""
    counts = {s: n for s, n in counts.items() if n}
    best = best_fit_decreasing(counts, capacity)
    least, total = lower_bound(counts, capacity), sum(s * n for s, n in counts.items())
    if n_bins(best) == least:
        return best

    def allowed() -> int:
        """Waste of a solution with one bin less than the best."""
        return (n_bins(best) - 1) * capacity - total

    # a stack of alternatives instead of recursion: the depth is the number of patterns
    Node = tuple[dict[int, int], int, Packing]
    stack: list[Node] = [(dict(counts), 0, [])]
    while stack and nodes > 0 and n_bins(best) > least:
        left, waste, done = stack.pop()
        nodes -= 1
        if waste > allowed():
            continue
        if not left:
            if n_bins(done) < n_bins(best):
                best = done
            continue
        top = max(left)
        rest = dict(left)
        rest[top] -= 1
        choices = fillings(rest, capacity - top, allowed() - waste, wanted)
        follow: list[Node] = []
        for lost, filling in choices:
            pattern = _whole(top, filling)
            times = min(left[s] // n for s, n in pattern)
            if lost:
                times = min(times, (allowed() - waste) // lost)
            if times < 1:
                continue
            after = dict(left)
            for s, n in pattern:
                after[s] -= n * times
                if not after[s]:
                    del after[s]
            follow.append((after, waste + lost * times, [*done, (pattern, times)]))
        stack += reversed(follow)
    return best


def _whole(top: int, filling: Pattern) -> Pattern:
    both = dict(filling)
    both[top] = both.get(top, 0) + 1
    return tuple(sorted(both.items(), reverse=True))


@dataclass
class Places:
    """Where the documents of each length go, sorted by (length, first rank).

    A run gives the ranks from ``first`` on to bins from ``bin`` on, ``times`` to a bin, the
    first of them at ``offset``.
    """

    length: np.ndarray
    first: np.ndarray
    times: np.ndarray
    bin: np.ndarray
    offset: np.ndarray


def places(packing: Packing) -> Places:
    rows, used, bin_ = [], {}, 0
    for pattern, n in packing:
        offset = 0
        for length, times in pattern:
            rows.append((length, used.get(length, 0), times, bin_, offset))
            used[length] = used.get(length, 0) + n * times
            offset += length * times
        bin_ += n
    table = np.array(rows, np.int64).reshape(-1, 5)
    table = table[np.lexsort((table[:, 1], table[:, 0]))]
    return Places(*table.T)


def token_pieces(docs: DataFrame, vocabulary_path: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of all pieces of all texts.

    A text's ids and ``end_id`` are one piece if they fit; only longer ones are cut, into full
    pieces but for the first, which takes what is over.
    """
    end = int(end_id).to_bytes(4, "little")

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        encoded = encoder(vocabulary_path).encode(part.column("text").to_pylist())
        rows: list[tuple] = []
        for doc_id, ids in zip(part.column("doc_id").to_pylist(), encoded, strict=True):
            data = ids + end
            n = len(data) // 4
            stop = (n - 1) % capacity + 1
            start = piece = 0
            while start < n:
                rows.append((doc_id, piece, start, stop - start, crc32(data[4 * start : 4 * stop])))
                start, stop, piece = stop, stop + capacity, piece + 1
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        return pa.RecordBatch.from_arrays(
            [
                pa.array(columns[0], pa.int64()),
                pa.array(columns[1], pa.int32()),
                *[pa.array(c, pa.int64()) for c in columns[2:]],
            ],
            ["doc_id", "piece", "start", "length", "ids_crc32"],
        )

    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    return map_slices(
        source, work, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    )


def ranked(pieces: DataFrame) -> DataFrame:
    """Add ``rank``, 0 to n-1 among the pieces of a length.

    Pieces of a length are numbered inside cells dealt by a hash, and cells by running counts,
    so a length that many documents have is spread over as many tasks as there are.
    """
    cells = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = pieces.withColumn("cell", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(cells)))
    sizes = placed.groupBy("length", "cell").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select(
        "length", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ranks_before")
    )
    inside = Window.partitionBy("length", "cell").orderBy("doc_id", "piece", "ids_crc32", "start")
    return (
        placed.withColumn("nth", F.row_number().over(inside))
        .join(firsts, ["length", "cell"])
        .withColumn("rank", F.col("ranks_before") + F.col("nth") - 1)
        .drop("cell", "nth", "ranks_before")
    )


def pack_documents(
    docs: DataFrame, vocabulary_path: str, end_id: int, capacity: int = CAPACITY
) -> DataFrame:
    """All pieces of all texts with sequence_id and offset: sequences of at most ``capacity``.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Pieces of
    a sequence lie one after the other from 0 without gaps.

    NULL and empty texts are the end id alone. Rows without an id and repeated rows are packed
    like all others, each on its own. An empty table gives an empty result. Other columns are
    not read. Only the numbers of pieces of each length, at most ``capacity`` rows, come to
    the driver, and only the runs of the solution go out.
    """
    pieces = written(token_pieces(docs, vocabulary_path, end_id, capacity), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    sent = docs.sparkSession.sparkContext.broadcast(places(pack_lengths(counts, capacity)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = sent.value
        stride = int(runs.first.max(initial=0)) + 1
        keys = runs.length * stride + runs.first
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(keys, length * stride + np.minimum(rank, stride - 1), "right") - 1
            nth = rank - runs.first[at]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in columns],
                    pa.array(runs.bin[at] + nth // runs.times[at]),
                    pa.array(runs.offset[at] + nth % runs.times[at] * length),
                ],
                [*columns, "sequence_id", "offset"],
            )

    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    return ranked(pieces).mapInArrow(
        work,
        "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    )
