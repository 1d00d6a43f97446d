"""Size-checked broadcast: broadcast a side only after measuring its bytes, else keep the
shuffle join."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Ceiling of a broadcast side in bytes of rows.  On the driver it takes several times that at once
# (the rows collected, the hash relation built of them, its blocks), and the loads of a tier
# broadcast side by side.
BROADCAST_MAX_BYTES = 64 << 20


def measured_bytes(df: DataFrame) -> int:
    """Bytes of all rows: row count times the fixed widths plus the text's own bytes, as one
    aggregate (a partial row per task, so no task reads the rows of another)."""
    fixed, text = 8, []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            fixed += 16
            text.append(F.sum(F.octet_length(f.name)))
        else:
            fixed += 24 if isinstance(f.dataType, T.DecimalType) else 8
    counted = df.agg(F.count(F.lit(1)), *text).first()
    return counted[0] * fixed + sum(n or 0 for n in counted[1:])


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> tuple[DataFrame, bool]:
    """Return ``(broadcast(df), True)`` if its rows take at most ``max_bytes``, else ``(df, False)``.

    Beyond the bound the join stays a shuffle join (AQE may still convert it at runtime from
    measured shuffle sizes, and splits skewed partitions).
    """
    if measured_bytes(df) <= max_bytes:
        return F.broadcast(df), True
    return df, False
