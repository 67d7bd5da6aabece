"""Applying change feeds to tables, and type-2 history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwatch.functions import cells

DELETE = "d"

Key = str | Sequence[str]


def _names(key: Key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def flatten_changes(changes: DataFrame, key: Key) -> DataFrame:
    """Envelopes to flat rows: the key columns, the row after the change, order and op.

    A delete carries no row after the change, so its key is that of the row
    before.
    """
    row, keys = changes.schema["after"].dataType.names, _names(key)
    return changes.select(
        *[F.coalesce(f"after.{k}", f"before.{k}").alias(k) for k in keys],
        *[F.col(f"after.{c}").alias(c) for c in row if c not in keys],
        "op",
        "ts_ms",
        F.col("source.lsn").alias("lsn"),
    )


def latest_changes(flat: DataFrame, key: Key) -> DataFrame:
    """The last change of each key by (ts_ms, lsn), reduced on the map side."""
    keys = _names(key)
    values = [c for c in flat.columns if c not in keys]
    order = F.struct("ts_ms", "lsn")
    last = F.max_by(F.struct(*values), order).alias("__last")
    return flat.groupBy(*keys).agg(last).select(*keys, "__last.*")


def opened(base: DataFrame) -> DataFrame:
    """A table as a state that feeds are merged into: no change is older than its rows."""
    none = F.lit(None).cast("bigint")
    return base.withColumns({"ts_ms": none, "lsn": none, "is_deleted": F.lit(False)})


def merged_state(state: DataFrame, flat: DataFrame, key: Key) -> DataFrame:
    """The state after a batch of changes, whatever the order in which batches arrive.

    Each key keeps the place (ts_ms, lsn) of the change it shows, deleted keys too, and only a
    later change replaces it: so a batch that comes late or twice does no harm.
    """
    keys = _names(key)
    values = [c for c in state.columns if c not in keys]
    last = latest_changes(flat, keys).withColumn("is_deleted", F.col("op") == DELETE)
    new = last.select(*keys, F.struct(*values).alias("__new"))
    old = state.select(*keys, F.struct(*values).alias("__old"))
    later = F.col("__old").isNull() | (
        F.struct("__new.ts_ms", "__new.lsn") > F.struct("__old.ts_ms", "__old.lsn")
    )
    taken = F.when(F.col("__new").isNotNull() & F.coalesce(later, F.lit(True)), F.col("__new"))
    joined = old.join(new, keys, "full_outer")
    return joined.select(*keys, F.coalesce(taken, F.col("__old")).alias("__row")).select(
        *[c if c in keys else F.col(f"__row.{c}").alias(c) for c in state.columns]
    )


def current_rows(state: DataFrame) -> DataFrame:
    """The rows of a state that are not deleted, as the table they stand for."""
    return state.filter(~F.col("is_deleted")).drop("ts_ms", "lsn", "is_deleted")


def apply_changes(base: DataFrame, flat: DataFrame, key: Key) -> DataFrame:
    """The base table after a change feed; applying it again changes nothing.

    Creates, snapshot reads and updates put the row, deletes remove it, and only
    the last change of a key counts. Columns the feed lacks keep the base value.
    Both sides hold a key once, so their one full join has no hot key.
    """
    keys = _names(key)
    last = latest_changes(flat, keys).withColumn("__changed", F.lit(True))
    joined = base.alias("base").join(last.alias("feed"), keys, "full_outer")
    columns = {k: F.col(k) for k in keys}
    for name in base.columns:
        old = F.col(f"base.{name}")
        if name not in last.columns:
            columns.setdefault(name, old)
        else:
            put = F.when(F.col("feed.__changed"), F.col(f"feed.{name}"))
            columns.setdefault(name, put.otherwise(old))
    kept = joined.filter(F.coalesce(F.col("feed.op"), F.lit("")) != DELETE)
    return kept.select(*[columns[name].alias(name) for name in base.columns])


def scd2(flat: DataFrame, key: Key, cell_hours: int = 1) -> DataFrame:
    """Every version of every row with the time it held; NULL means it still does.

    Changes of one key in the same millisecond leave the last one. A delete ends
    the version before it and starts none. Versions are ordered inside cells, so
    a key with very many changes is not one task's work.
    """
    keys = _names(key)
    values = [c for c in flat.columns if c not in (*keys, "ts_ms")]
    settled = (
        flat.groupBy(*keys, "ts_ms")
        # in a struct, as max_by passes over rows whose order is NULL
        .agg(F.max_by(F.struct(*values), F.struct("lsn")).alias("__version"))
        .select(*keys, "ts_ms", "__version.*")
    )
    width = cell_hours * cells.HOUR // 1000
    versions = cells.next_position(settled, keys, "ts_ms", width, "__until")
    return versions.filter(F.col("op") != DELETE).select(
        *[c for c in flat.columns if c not in ("op", "ts_ms", "lsn")],
        F.timestamp_millis("ts_ms").alias("valid_from"),
        F.timestamp_millis("__until").alias("valid_to"),
        F.col("__until").isNull().alias("is_current"),
    )


def snapshot_history(
    history: DataFrame, current: DataFrame, key: str, updated_at: str = "updated_at"
) -> DataFrame:
    """Bring a type-2 history up to a fresh snapshot of the table.

    A row whose ``updated_at`` is newer than its open version closes that
    version and opens another; a new key opens its first; a key missing from
    the snapshot keeps its open version. The same snapshot again changes
    nothing. Closed versions stay where they are: only open ones, one per key,
    are joined with the snapshot.
    """
    columns = history.columns
    never = F.lit(None).cast("timestamp")
    fresh = current.withColumns(
        {"valid_from": F.col(updated_at), "valid_to": never, "is_current": F.lit(True)}
    )
    was_open = history.filter(F.col("valid_to").isNull())
    old = was_open.select(key, F.struct(*columns).alias("__old"))
    new = fresh.select(key, F.struct(*columns).alias("__new"))
    newer = F.col("__new.valid_from") > F.col("__old.valid_from")
    ended = F.col("__old").withField("valid_to", F.col("__new.valid_from"))
    ended = ended.withField("is_current", F.lit(False))
    versions = F.when(F.col("__old").isNull(), F.array("__new"))
    versions = versions.when(newer, F.array(ended, "__new")).otherwise(F.array("__old"))
    open_now = (
        old.join(new, key, "full_outer")
        .select(F.explode(versions).alias("__version"))
        .select("__version.*")
    )
    return history.filter(F.col("valid_to").isNotNull()).unionByName(open_now)


def open_history(table: DataFrame, updated_at: str = "updated_at") -> DataFrame:
    """A history with one open version per row of a table."""
    return table.withColumns(
        {
            "valid_from": F.col(updated_at),
            "valid_to": F.lit(None).cast("timestamp"),
            "is_current": F.lit(True),
        }
    )
