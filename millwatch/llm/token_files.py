"""Files of token ids: ids ranked by frequency, in one to four whole bytes each.

A file holds consecutive documents. Its header lists the ids it uses, most frequent first;
the body names each id by its place in that list. Two bits per id, four ids to a control
byte, say how many bytes a place takes; the bytes of the places follow in an area of their
own. A table with 256 rows turns control bytes into lengths, so numpy decodes without a loop.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from uuid import uuid4
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millwatch.llm.byte_bpe import encoder
from millwatch.llm.common import scratch_path, slices, whole_text, written

MAGIC = b"MWTOKEN1"
_HEADER = struct.Struct("<8sQQQQ")  # magic, documents, tokens, distinct ids, bytes of places

#: A task starts a new file beyond this many ids: bounds the memory of writing and reading.
FILE_TOKENS = 2_000_000

#: _LENGTHS[control byte] has the byte counts of its four places, one in each of its bytes.
_LENGTHS = np.array([[(c >> (2 * k) & 3) + 1 for k in range(4)] for c in range(256)], np.uint8).view("<u4").ravel()

#: Ids below this are counted in a table.
_COUNTED = 1 << 22


def encode_places(places: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and place bytes of unsigned 32-bit numbers."""
    n = len(places)
    code = (places > 0xFF).astype(np.uint8)
    if places.max(initial=0) > 0xFFFF:
        code += (places > 0xFFFF).astype(np.uint8) + (places > 0xFFFFFF)
    padded = np.zeros(-(-n // 4) * 4, np.uint8)
    padded[:n] = code
    four = padded.view("<u4")  # the codes of a control byte, two bits each, are in one number
    control = four | four >> np.uint32(6) | four >> np.uint32(12) | four >> np.uint32(18)
    starts = np.cumsum(code, dtype=np.int64)
    data = np.empty(n + (int(starts[-1]) if n else 0), np.uint8)
    starts += np.arange(n)
    starts -= code
    data[starts] = places.astype(np.uint8)
    for k in range(1, int(code.max(initial=0)) + 1):
        longer = np.flatnonzero(code >= k)
        data[starts[longer] + k] = (places[longer] >> np.uint32(8 * k)).astype(np.uint8)
    return control.astype(np.uint8).tobytes(), data.tobytes()


def decode_places(control: bytes, data: bytes, n: int) -> np.ndarray:
    lengths = _LENGTHS[np.frombuffer(control, np.uint8)].view(np.uint8)[:n]
    starts = np.cumsum(lengths, dtype=np.int64) - lengths
    octets = np.frombuffer(data, np.uint8)
    value = octets[starts].astype(np.uint32)
    for k in range(1, int(lengths.max(initial=1))):
        longer = np.flatnonzero(lengths > k)
        value[longer] |= octets[starts[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return value


@dataclass
class Documents:
    """Consecutive documents: ids (None for a missing one) and their tokens one after the other."""

    doc_ids: list[int | None]
    lengths: np.ndarray
    tokens: np.ndarray


def to_bytes(docs: Documents) -> bytes:
    """The file of some documents. Equally frequent ids are listed in ascending order."""
    tokens = docs.tokens
    if tokens.max(initial=0) < _COUNTED:  # a vocabulary's size: ids are counted without sorting them
        counts = np.bincount(tokens)
        ids = np.flatnonzero(counts)
        ids = ids[np.lexsort((ids, -counts[ids]))]
        place = np.zeros(len(counts), np.uint32)
        place[ids] = np.arange(len(ids), dtype=np.uint32)
        places = place[tokens]
    else:
        ids, where, counts = np.unique(tokens, return_inverse=True, return_counts=True)
        order = np.lexsort((ids, -counts))
        place = np.empty(len(ids), np.uint32)
        place[order] = np.arange(len(ids), dtype=np.uint32)
        ids, places = ids[order], place[where]
    control, data = encode_places(places)
    missing = np.array([d is None for d in docs.doc_ids], np.uint8)
    return b"".join([
        _HEADER.pack(MAGIC, len(docs.doc_ids), len(docs.tokens), len(ids), len(data)),
        ids.astype("<u4").tobytes(),
        np.array([d or 0 for d in docs.doc_ids], "<i8").tobytes(),
        missing.tobytes(),
        docs.lengths.astype("<u8").tobytes(),
        control,
        data,
    ])


def from_bytes(content: bytes) -> Documents:
    magic, n_docs, n_tokens, n_ids, n_data = _HEADER.unpack_from(content)
    if magic != MAGIC:
        raise ValueError("not a file of token ids")
    at = _HEADER.size

    def take(size: int) -> bytes:
        nonlocal at
        at += size
        return content[at - size : at]

    ids = np.frombuffer(take(4 * n_ids), "<u4")
    doc_ids = np.frombuffer(take(8 * n_docs), "<i8").tolist()
    missing = np.frombuffer(take(n_docs), np.uint8)
    lengths = np.frombuffer(take(8 * n_docs), "<u8").astype(np.int64)
    control = take(-(-n_tokens // 4))
    places = decode_places(control, take(n_data), n_tokens)
    return Documents([None if m else d for d, m in zip(doc_ids, missing, strict=True)], lengths, ids[places])


@lru_cache(maxsize=8)
def _store(folder: str) -> tuple[fs.FileSystem, str]:
    if "://" not in folder and not folder.startswith("file:"):
        return fs.LocalFileSystem(), folder
    return fs.FileSystem.from_uri(folder if "://" in folder else folder.replace("file:", "file://", 1))


def write_token_files(
    docs: DataFrame, vocabulary_path: str, end_id: int, folder: str, file_tokens: int = FILE_TOKENS
) -> DataFrame:
    """Write the ids of all texts, in ascending order of doc_id, as files in ``folder``.

    Returns their list: part, file_no, file, n_docs, n_tokens; (part, file_no) is the order.
    A file is listed only if the task that wrote it finished, so files of lost or repeated
    tasks are never read.

    Each text is followed by ``end_id``. Rows without an id come first; rows that repeat an id
    are ordered by their text. NULL is the empty text. An empty table gives no files. Texts are
    dealt by ranges of (doc_id, hash of text), so no id and no text makes a task larger than
    its own rows.
    """
    source = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text")
    ).withColumn("mark", F.xxhash64("text"))
    ordered = source.repartitionByRange("doc_id", "mark").sortWithinPartitions("doc_id", "mark", "text")
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, file_no = TaskContext.get().partitionId(), 0
        encode = encoder(vocabulary_path).encode
        store, base = _store(folder)
        doc_ids: list[int | None] = []
        found: list[bytes] = []
        n = 0

        def flush() -> pa.RecordBatch:
            nonlocal file_no, doc_ids, found, n
            tokens = np.frombuffer(b"".join(found), "<u4")
            content = to_bytes(Documents(doc_ids, np.array([len(f) // 4 for f in found]), tokens))
            name = f"{part:06d}-{file_no:04d}-{uuid4().hex}.tok"
            with store.open_output_stream(f"{base}/{name}") as out:
                out.write(content)
            row = {"part": part, "file_no": file_no, "file": name, "n_docs": len(doc_ids), "n_tokens": n}
            file_no, doc_ids, found, n = file_no + 1, [], [], 0
            return pa.RecordBatch.from_pylist([row], schema=listed)

        for rows in slices(batches):
            ids = encode(rows.column("text").to_pylist())
            for doc_id, data in zip(rows.column("doc_id").to_pylist(), ids, strict=True):
                doc_ids.append(doc_id)
                found.append(data + end)
                n += len(data) // 4 + 1
                if n >= file_tokens:
                    yield flush()
        if doc_ids:
            yield flush()

    listed = pa.schema(
        [("part", pa.int64()), ("file_no", pa.int64()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]
    )
    store, base = _store(folder)
    store.create_dir(base, recursive=True)
    files = ordered.mapInArrow(run, "part bigint, file_no bigint, file string, n_docs bigint, n_tokens bigint")
    return written(files, "token-file-list")


def read_token_files(files: DataFrame, folder: str) -> DataFrame:
    """Per document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    ``files`` is the list that ``write_token_files`` returned: one row per file, so running
    totals over it are over few rows.
    """
    before = Window.orderBy("part", "file_no").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.select(
        "file", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("bigint").alias("first")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_stream(f"{base}/{row['file']}") as data:
                    docs = from_bytes(data.read())
                ends = np.cumsum(docs.lengths)
                starts = ends - docs.lengths
                raw = memoryview(docs.tokens.astype("<u4").tobytes())
                marks = [
                    crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(docs.doc_ids, pa.int64()),
                        pa.array(starts + row["first"]),
                        pa.array(docs.lengths),
                        pa.array(marks, pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    n_files = max(1, files.count())
    return placed.repartition(n_files).mapInArrow(
        run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )


def token_files(docs: DataFrame, vocabulary_path: str, end_id: int) -> DataFrame:
    """Write the files into a fresh shared folder and describe what reading them back gives."""
    folder = scratch_path(docs.sparkSession, "token-files")
    return read_token_files(write_token_files(docs, vocabulary_path, end_id, folder), folder)
