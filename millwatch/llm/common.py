"""What the text operators share: scratch tables, Arrow maps over texts, reading columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from uuid import uuid4

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millwatch.llm.sieve import passing, sieve
from millwatch.sources.session import shared_folder

#: Characters between words, as a class of Java and Python patterns.
SPACES = r"\x20\x09-\x0D"

#: Bits of the sieve of rows that share a group (1 MB).
MEMBER_BITS = 23

#: Rows of one Arrow slice are handled together, so that new words are looked up once.
SLICE_ROWS = 256


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh place in the shared folder for a table or files that a job leaves for the next."""
    return f"{shared_folder(spark)}/millwatch/{name}-{uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: computed once, safe from lost executors.

    The layout is handed to the reader, so tables without rows keep their columns.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def given_up(*tables: DataFrame) -> None:
    """Delete tables that ``written`` gave, once all that was made from them is written itself."""
    for table in tables:
        spark = table.sparkSession
        jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            if folder.rsplit("/", 2)[1] != "millwatch":
                raise ValueError(f"{folder} is no scratch table")
            path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
            path.getFileSystem(conf).delete(path, True)


def whole_text(text: str | Column = "text") -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def text_key() -> Column:
    """SHA-256 of the whole text: with doc_id it names a document, whatever ids repeat or lack."""
    return F.unhex(F.sha2(whole_text(), 256))


def one_of_each(docs: DataFrame, rooted: DataFrame) -> DataFrame:
    """Of the rows of ``docs`` that share a root, the one of the smallest id, with all columns.

    ``rooted`` has doc_id, text_key and root of every row. Rows without an id come last; of
    equal or lacking ids the smallest text key stays. Rows that repeat id and text count once.
    """
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    groups = rooted.groupBy("root").agg(F.min(order).alias("one"), F.count(F.lit(1)).alias("rows"))
    groups = written(groups.filter("rows > 1"), "groups")
    # rows alone in their group stay; a sieve lets most of them pass without a shuffle of texts
    members = rooted.join(groups.select("root"), "root", "left_semi")
    known = sieve(members, F.xxhash64("text_key"), MEMBER_BITS)
    keyed = docs.withColumn("__key", text_key())
    may_go = _passes(known)(F.xxhash64("__key"))
    alone = keyed.filter(~may_go).select(*docs.columns)
    alone_too = rooted.join(groups.select("root"), "root", "left_anti").select("doc_id", "text_key")
    stays = groups.select("one.doc_id", "one.text_key").union(alone_too)
    stays = stays.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__stays"))
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__stays"))
    first = Window.partitionBy("doc_id", "__key").orderBy(F.lit(0))
    told = (
        keyed.filter(may_go)
        .join(stays, same, "left_semi")
        .withColumn("__nth", F.row_number().over(first))
        .filter("__nth = 1")
        .select(*docs.columns)
    )
    return alone.unionByName(told)


def _passes(known: np.ndarray) -> Callable[[Column], Column]:
    """Whether a hash may be that of a member, as a function of a column: only hashes leave the JVM."""

    def test(keys: pd.Series) -> pd.Series:
        return pd.Series(passing(known, keys.to_numpy()))

    return F.pandas_udf(test, "boolean")


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def map_slices(
    df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str
) -> DataFrame:
    """Apply ``work`` to slices of at most ``SLICE_ROWS`` rows inside the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            out = work(part)
            if out is not None:
                yield out

    return df.mapInArrow(run, schema)


def utf8(column: pa.Array) -> list[bytes]:
    """The texts of a column as UTF-8 bytes."""
    return column.cast(pa.binary()).to_pylist()


def missing(known: dict, used: set, most: int) -> list:
    """The keys of ``used`` that ``known`` lacks. Where they would make it more than ``most``,
    it first forgets all but the keys in use now, which keeps the frequent ones."""
    new = list(used.difference(known))
    if len(known) + len(new) > most:
        kept = {k: known[k] for k in used if k in known}
        known.clear()
        known.update(kept)
    return new


#: Characters of the longest word that a worker remembers.
LONGEST_REMEMBERED = 48


def forget_long(known: dict, new: list[str]) -> None:
    """Drop the long ones of the words just learned: so the memory of words is bounded in bytes,
    even where texts without blanks are one word."""
    for word in new:
        if len(word) > LONGEST_REMEMBERED:
            known.pop(word, None)


def drawn_by_hash(df: DataFrame, classes: str, per_class: int, salt: str) -> DataFrame:
    """About ``per_class`` rows of each value of ``classes``, all of a rarer one.

    A hash of doc_id draws them, so equal runs draw the same rows. Only a count per value comes
    to the driver, and the filter needs neither a join nor a shuffle of the texts.
    """
    counts = df.groupBy(classes).agg(F.count(F.lit(1)).alias("n")).collect()
    draw = F.pmod(F.xxhash64(F.lit(salt), "doc_id"), F.lit(1_000_000)) / 1_000_000
    taken = F.lit(False)
    for row in counts:
        share = F.lit(per_class / row["n"])
        taken |= (F.col(classes) == F.lit(row[classes])) & (draw < share)
    return df.filter(taken)
