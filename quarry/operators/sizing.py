"""Broadcast only behind a proven size bound.

A hint is placed when ``max_rows * row_bytes`` - an upper bound known from
the operator's definition, not from the data - fits under the limit
(``quarry.broadcast.maxBoundBytes``, default 64 MiB). Otherwise no hint is
given and Catalyst/AQE decide from measured sizes (sort-merge join with skew
splitting beyond ``spark.sql.autoBroadcastJoinThreshold``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_BOUND_BYTES = 64 << 20


def broadcast_if_bounded(df: DataFrame, max_rows: int, row_bytes: int,
                         limit_bytes: int | None = None) -> DataFrame:
    if limit_bytes is None:
        limit_bytes = int(df.sparkSession.conf.get("quarry.broadcast.maxBoundBytes",
                                                   str(DEFAULT_BOUND_BYTES)))
    return F.broadcast(df) if max_rows * row_bytes <= limit_bytes else df


def row_bytes(n_fixed_width_columns: int) -> int:
    """UnsafeRow size of a row of fixed-width columns: null bits + 8 bytes each."""
    return 8 + 8 * n_fixed_width_columns
