"""Size checks before a broadcast: a side is broadcast only when its
measured size (one aggregate over it) is under the session's broadcast
threshold; otherwise the join is pinned to a sort-merge join, so no
broadcast is ever chosen from a size estimate of data that grows."""

from __future__ import annotations

import re
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Upper bound on the rows of a broadcast side, whatever their size.
MAX_BROADCAST_ROWS = 100_000

_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20,
          "g": 1 << 30, "gb": 1 << 30, "t": 1 << 40, "tb": 1 << 40}


def broadcast_limit(spark: SparkSession) -> int:
    """The session's ``spark.sql.autoBroadcastJoinThreshold`` in bytes
    (negative: broadcasting is off)."""
    raw = str(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10MB")).strip().lower()
    m = re.fullmatch(r"(-?\d+)\s*([a-z]*)", raw)
    if not m or m.group(2) not in _UNITS:
        return -1
    return int(m.group(1)) * _UNITS[m.group(2)]


def measure(df: DataFrame, columns: Sequence[str]) -> tuple[int, int]:
    """(rows, approximate bytes of ``columns``) in one aggregate pass."""
    size = sum(F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + 8 for c in columns)
    rows, nbytes = df.agg(F.count(F.lit(1)), F.sum(size)).first()
    return int(rows), int(nbytes or 0)


def fits_broadcast(spark: SparkSession, rows: int, nbytes: int, max_rows: int = MAX_BROADCAST_ROWS) -> bool:
    limit = broadcast_limit(spark)
    return limit >= 0 and rows <= max_rows and nbytes <= limit
