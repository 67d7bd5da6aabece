"""Reading columns of embeddings inside Arrow tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def flat_components(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The components of a column of arrays one after another, and where each row's begin.

    32-bit components stay so, all others become doubles. A NULL component becomes NaN; a NULL
    row has no components.
    """
    if not pa.types.is_float32(column.type.value_type):
        column = column.cast(pa.list_(pa.float64()))
    lengths = np.asarray(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), np.int64)
    starts = np.concatenate(([0], np.cumsum(lengths)))
    return column.flatten().to_numpy(zero_copy_only=False), starts


def counted(flags: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How many flags are set in each row."""
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[starts[1:]] - total[starts[:-1]]
