"""Time and key cells: the unit in which an ordered group is split.

An ordered group (one machine's whole history, say) may hold a third of all
rows, so no window here runs over a whole group of raw rows. Rows are windowed
inside short cells, and a second window runs over one total per cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SECOND = 1_000_000  # microseconds
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE
DAY = 24 * HOUR


def cell_start(position: str | Column, width: int) -> Column:
    """Start of the cell of ``width`` holding an integer position."""
    position = F.col(position) if isinstance(position, str) else position
    return position - F.pmod(position, F.lit(width).cast("bigint"))


def next_position(df: DataFrame, keys: list[str], position: str, width: int, out: str) -> DataFrame:
    """Add the next greater position of the same key, NULL for the last one.

    ``position`` is an integer, unique per key. Only cell minima are windowed
    over a whole key; rows are windowed inside their cell.
    """
    cell = "__cell"
    rows = df.withColumn(cell, cell_start(position, width))
    firsts = rows.groupBy(*keys, cell).agg(F.min(position).alias("__first"))
    across = Window.partitionBy(*keys).orderBy(cell)
    following = firsts.select(
        *keys, cell, F.lead("__first").over(across).alias("__first_of_next_cell")
    )
    inside = Window.partitionBy(*keys, cell).orderBy(position)
    return (
        rows.withColumn("__next_in_cell", F.lead(position).over(inside))
        .join(following, [*keys, cell])
        .withColumn(out, F.coalesce("__next_in_cell", "__first_of_next_cell"))
        .drop(cell, "__next_in_cell", "__first_of_next_cell")
    )


def global_row_number(df: DataFrame, position: str, width: int, out: str, fan: int = 1000) -> DataFrame:
    """Number all rows 1..n by a unique integer position, without a global sort.

    Rows are numbered inside cells of ``width`` positions (so at most ``width``
    rows each). The offsets are running counts over cells, taken inside blocks
    of ``fan`` cells, plus running counts over blocks; only the last, with one
    row per ``width * fan`` positions, is a window without a partition.
    """
    cell, block = "__cell", "__block"
    rows = df.withColumn(cell, cell_start(position, width))
    counts = rows.groupBy(cell).agg(F.count(F.lit(1)).alias("__n"))
    counts = counts.withColumn(block, cell_start(cell, width * fan))
    before = (Window.unboundedPreceding, -1)
    in_block = Window.partitionBy(block).orderBy(cell).rowsBetween(*before)
    over_blocks = Window.orderBy(block).rowsBetween(*before)
    blocks = counts.groupBy(block).agg(F.sum("__n").alias("__n"))
    blocks = blocks.select(block, F.sum("__n").over(over_blocks).alias("__blocks_before"))
    offsets = (
        counts.withColumn("__cells_before", F.sum("__n").over(in_block))
        .join(blocks, block)
        .select(
            cell,
            (
                F.coalesce("__cells_before", F.lit(0)) + F.coalesce("__blocks_before", F.lit(0))
            ).alias("__offset"),
        )
    )
    inside = Window.partitionBy(cell).orderBy(position)
    return (
        rows.withColumn("__rn", F.row_number().over(inside))
        .join(offsets, cell)
        .withColumn(out, F.col("__rn") + F.col("__offset"))
        .drop(cell, "__rn", "__offset")
    )
