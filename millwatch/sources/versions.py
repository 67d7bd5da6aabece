"""Tables that are replaced version by version, on any file system Spark can reach.

Each write goes into a folder of its own and becomes a version once its manifest is renamed into
place under the next number. Readers resolve the newest manifest (or one they name), so they see
a version whole or not at all: a write that fails half way leaves a folder nobody reads. The
rename fails if the number is taken, so of two writers that began from one version the second
is refused. A manifest lists folders and, where a version replaces only some partitions, which
partitions count in each. Only names of partitions reach the driver, never rows.

The rename must not replace a file that is there: HDFS, viewfs and local folders keep that. Object
stores without such a rename need a committer that does.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass, field
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

COMMITS, DATA = "_commits", "data"


class StaleVersion(RuntimeError):
    """Another writer committed in the meantime."""


@dataclass
class Part:
    """A folder of a version; its ``partitions`` that count, or all of it (None)."""

    folder: str
    partitions: list[str] | None = None


@dataclass
class Manifest:
    version: int
    layout: str
    keys: list[str] = field(default_factory=list)
    parts: list[Part] = field(default_factory=list)
    committed_ms: int = 0
    batch: int | None = None

    @property
    def schema(self) -> StructType:
        return StructType.fromJson(json.loads(self.layout))


class _Files:
    """The file system of a table, through Spark's own configuration."""

    def __init__(self, spark: SparkSession, table: str) -> None:
        self.jvm, self.table = spark._jvm, table.rstrip("/")
        self.conf = spark._jsc.hadoopConfiguration()
        self.fs = self.path().getFileSystem(self.conf)

    def path(self, *names: str):
        return self.jvm.org.apache.hadoop.fs.Path("/".join((self.table, *names)))

    def names(self, *names: str) -> list[str]:
        if not self.fs.exists(self.path(*names)):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.path(*names)))

    def read(self, *names: str) -> str:
        stream = self.fs.open(self.path(*names))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, text: str, *names: str) -> bool:
        """Put a file in place whole, unless there is one; tells whether it did."""
        draft = self.path(COMMITS, f".{uuid4().hex}")
        stream = self.fs.create(draft)
        stream.write(bytearray(text.encode()))
        stream.close()
        place = self.path(*names)
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), self.conf)
        rename = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
        try:  # fails if the place is taken
            context.rename(draft, place, self.jvm.java.lang.reflect.Array.newInstance(rename._java_lang_class, 0))
        except Exception as failure:
            self.fs.delete(draft, False)
            if self.fs.exists(place):
                return False
            raise failure
        return True

    def partitions(self, folder: str, depth: int) -> list[str]:
        """The partitions written under a folder, such as ``plant_id=A/event_date=2024-01-01``."""
        found = self.fs.globStatus(self.path(DATA, folder, *["*=*"] * depth)) or []
        return sorted("/".join(str(s.getPath()).split("/")[-depth:]) for s in found)

    def delete(self, *names: str) -> None:
        self.fs.delete(self.path(*names), True)

    def changed_ms(self, *names: str) -> int:
        return self.fs.getFileStatus(self.path(*names)).getModificationTime()


def versions(spark: SparkSession, table: str) -> list[int]:
    """The numbers of the versions that can be read, oldest first."""
    names = _Files(spark, table).names(COMMITS)
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))


def manifest(spark: SparkSession, table: str, version: int | None = None) -> Manifest | None:
    """The manifest of a version, by default the newest; None if the table has none."""
    known = versions(spark, table)
    if version is None and not known:
        return None
    number = known[-1] if version is None else version
    if number not in known:
        raise ValueError(f"{table} has no version {number}")
    found = json.loads(_Files(spark, table).read(COMMITS, f"{number:012d}.json"))
    return Manifest(**found | {"parts": [Part(**p) for p in found["parts"]]})


def partition_name(spark: SparkSession, values: dict[str, str | None]) -> str:
    """The folder names of a partition, as Spark writes them."""
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return "/".join(names.getPartitionPathString(key, value) for key, value in values.items())


def read_version(spark: SparkSession, table: str, version: int | None = None) -> DataFrame:
    """The rows of one version. Filters on partition columns reach every folder's scan."""
    found = manifest(spark, table, version)
    if found is None:
        raise ValueError(f"{table} has no version")
    return read_parts(spark, table, found, found.parts)


def read_parts(spark: SparkSession, table: str, of: Manifest, parts: Sequence[Part]) -> DataFrame:
    """The rows of some folders of a version."""
    frames = []
    for part in parts:
        folder = f"{table.rstrip('/')}/{DATA}/{part.folder}"
        reader = spark.read.schema(of.schema)
        if part.partitions is None:
            frames.append(reader.parquet(folder))
        else:
            places = [f"{folder}/{p}" for p in part.partitions]
            frames.append(reader.option("basePath", folder).parquet(*places))
    if not frames:
        return spark.createDataFrame([], of.schema)
    return reduce(DataFrame.unionByName, frames).select(*of.schema.names)


def commit(
    df: DataFrame,
    table: str,
    keys: Sequence[str] = (),
    only_touched: bool = False,
    gone: Iterable[str] = (),
    expected: int | None = None,
    batch: int | None = None,
) -> int:
    """Write the rows as the next version and return its number.

    With ``only_touched`` the partitions that ``df`` holds replace those of the version before,
    those named by ``gone`` are left out, and all others are taken over without being read. With
    ``expected`` the write is refused before it begins unless that version is the newest; in any
    case it is refused at the end if another writer took the number. ``batch`` is kept in the
    manifest, and in those after it until another one is given: it becomes visible with the rows.
    """
    spark, files = df.sparkSession, _Files(df.sparkSession, table)
    before = manifest(spark, table)
    newest = before.version if before else 0
    if expected is not None and expected != newest:
        raise StaleVersion(f"{table} is at version {newest}, not {expected}")
    if only_touched and not keys:
        raise ValueError("only partitions can be replaced one by one: name their columns")
    if only_touched and before and (before.keys != list(keys) or before.schema.simpleString() != df.schema.simpleString()):
        raise ValueError(f"{table} has another layout: write it whole")
    number, folder = newest + 1, f"{newest + 1:012d}-{uuid4().hex}"
    rows = df.hint("rebalance", *[F.col(k) for k in keys])
    rows.write.partitionBy(*keys).parquet(f"{table.rstrip('/')}/{DATA}/{folder}")
    parts = [Part(folder)]
    if only_touched:
        written = files.partitions(folder, len(keys))
        parts = [Part(folder, written)] if written else []
        replaced = {*written, *gone}
        for part in before.parts if before else []:
            held = part.partitions
            if held is None:
                held = files.partitions(part.folder, len(keys))
            kept = [p for p in held if p not in replaced]
            if kept:
                parts.append(Part(part.folder, kept))
    # every column may hold NULL once it is read from files
    layout = StructType.fromJson(json.loads(df.schema.json()))
    for column in layout:
        column.nullable = True
    if batch is None and before:
        batch = before.batch
    new = Manifest(number, layout.json(), list(keys), parts, int(time.time() * 1000), batch)
    if not files.publish(json.dumps(asdict(new)), COMMITS, f"{number:012d}.json"):
        raise StaleVersion(f"another writer committed version {number} of {table}")
    return number


def clean(spark: SparkSession, table: str, grace_seconds: float) -> list[str]:
    """Remove versions replaced longer than the grace time ago, and what failed writers left.

    The newest version stays, as do all folders that a remaining version lists and folders
    changed within the grace time, which may belong to a write that is under way. Returns the
    removed folders.
    """
    files, limit = _Files(spark, table), int((time.time() - grace_seconds) * 1000)
    known = versions(spark, table)
    found = {n: manifest(spark, table, n) for n in known}
    # a version was replaced when the next one was committed
    old = [a for a, b in zip(known, known[1:], strict=False) if found[b].committed_ms < limit]
    for number in old:
        files.delete(COMMITS, f"{number:012d}.json")
    used = {p.folder for n, m in found.items() if n not in old for p in m.parts}
    left = [f for f in files.names(DATA) if f not in used and files.changed_ms(DATA, f) < limit]
    for folder in left:
        files.delete(DATA, folder)
    return left


def compact(spark: SparkSession, table: str, most_folders: int = 8) -> int | None:
    """Bring a table that many partial writes have spread over folders back to a bounded number.

    The partitions of the folders with the fewest of them are written anew as one; readers of
    earlier versions go on. Returns the new version, or None if nothing was due.
    """
    before = manifest(spark, table)
    if before is None or len(before.parts) <= most_folders:
        return None
    small = sorted(before.parts, key=lambda p: len(p.partitions or []))[: len(before.parts) - most_folders + 1]
    rows = read_parts(spark, table, before, small)
    return commit(rows, table, before.keys, only_touched=True, expected=before.version)
