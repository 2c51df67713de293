"""Broadcast only what is proven small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of 25 bytes, one for each split of a batch: 2 PB in splits of 128 MB.
# Above it the join is left to the planner.
DEFAULT_MAX_BROADCAST_ROWS = 16_000_000

MAX_BROADCAST_BYTES = 64 << 20


def bounded_broadcast(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` when its rows take at most ``max_bytes`` as JSON text, else ``df``.

    One aggregation over the (small) side; beyond the bound the planner chooses.
    """
    size = df.select(F.sum(F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))) + 16)).first()[0]
    return F.broadcast(df) if (size or 0) <= max_bytes else df
