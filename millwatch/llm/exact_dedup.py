"""Exact duplicates by a tree merge of sorted digest runs.

Every document becomes one entry: the digest of its normalised text and, to choose who
stays, the length of the original text and the id. The partitions of the input are runs.
In each round the runs whose numbers differ only in the bits of that round send their
entries to the same place, where Spark's sort merges them; of the entries of one digest the
best is kept and the sizes are added. Sorting aggregates do the same inside a task before
anything is sent, so copies, however many, leave a task as one entry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millwatch.llm.common import whole_text, written

#: The partitions are dealt to 2**6 runs, and a round merges the runs that differ in 2 bits.
RUN_BITS, ROUND_BITS = 6, 2

#: Two texts are the same only if all of these agree.
VERIFIED = ["text_sha256", "norm_length", "norm_xxh64"]

_BLANKS = " \t\n\x0b\x0c\r"


def normalised(text: str | Column = "text") -> Column:
    """The text without space, tab, line feed, vertical tab, form feed and carriage return."""
    return F.regexp_replace(whole_text(text), r"[\x20\x09-\x0D]+", "")


def digest_entries(docs: DataFrame) -> DataFrame:
    """One entry per row of ``docs``: id, length in code points, digest and what verifies it."""
    text = docs.select(
        F.col("doc_id"),
        F.length(whole_text()).cast("bigint").alias("n_points"),
        normalised().alias("norm"),
    )
    return text.select(
        "doc_id",
        "n_points",
        F.sha2("norm", 256).alias("text_sha256"),
        F.length("norm").cast("bigint").alias("norm_length"),
        F.xxhash64("norm").alias("norm_xxh64"),
    )


def best_entry() -> Column:
    """Orders entries: longest text first, then smallest id, rows without an id last."""
    return F.struct(
        (-F.col("n_points")).alias("order_points"),
        F.col("doc_id").isNull().alias("order_null"),
        F.col("doc_id").alias("keep_id"),
    )


def merge_runs(entries: DataFrame) -> DataFrame:
    """Survivor and size of every distinct text, merged in rounds from runs to one run.

    Within a round the entries of a run are spread over all tasks by digest, so the last
    round, with one run, is as wide as the first.
    """
    run = F.pmod(F.spark_partition_id(), F.lit(1 << RUN_BITS))
    merged = entries.select(
        *VERIFIED, run.alias("run"), best_entry().alias("best"), F.lit(1).cast("bigint").alias("n")
    )
    for round_ in range(RUN_BITS // ROUND_BITS):
        cleared = (1 << ((round_ + 1) * ROUND_BITS)) - 1
        merged = (
            merged.withColumn("run", F.col("run").bitwiseAND(F.lit(~cleared)))
            .groupBy("run", *VERIFIED)
            .agg(F.min("best").alias("best"), F.sum("n").alias("n"))
        )
    return merged.select(*VERIFIED, "best.keep_id", F.col("n").alias("group_size"))


def exact_dedup(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are after deleting white space (``normalised``). The longest
    original text stays, among those the smallest ``doc_id``.

    NULL and empty texts are one group. A row without an id loses against rows with one; a
    group of such rows has a NULL ``keep_id``. Rows that repeat an id and a text are ties:
    ``group_size`` counts all, and all of those that carry the surviving id are marked kept
    (``keep_first_rows`` leaves one). An empty table gives an empty result. Columns other
    than ``doc_id`` and ``text`` are not read.
    """
    entries = written(digest_entries(docs), "digests")
    groups = merge_runs(entries)
    rows = entries.select("doc_id", *VERIFIED).join(groups, VERIFIED)
    return rows.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def keep_first_rows(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns, one row for each distinct text.

    Rows that repeat the surviving id and text count once. The survivors are few columns and
    are joined to the documents by digest and id; the rows of one digest and id are then
    already together for choosing the first.
    """
    entries = digest_entries(docs)
    groups = written(merge_runs(entries), "survivors").select(
        F.col("text_sha256").alias("__sha256"), F.col("keep_id").alias("__keep_id")
    )
    rows = docs.withColumn("__sha256", F.sha2(normalised(), 256))
    same = (rows["__sha256"] == groups["__sha256"]) & rows["doc_id"].eqNullSafe(groups["__keep_id"])
    first = Window.partitionBy("__sha256", "doc_id").orderBy(F.lit(0))
    stays = rows.join(groups, same, "left_semi")
    return (
        stays.withColumn("__nth", F.row_number().over(first))
        .filter("__nth = 1")
        .select(*docs.columns)
    )
