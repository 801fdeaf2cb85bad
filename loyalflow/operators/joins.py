"""Join helpers: size-checked broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BYTES = 64 << 20
# Bytes of a value by type; strings and binaries count by their observed length, others as 64.
WIDTHS = {"boolean": 8, "byte": 8, "short": 8, "integer": 8, "long": 8, "float": 8, "double": 8, "date": 8,
          "timestamp": 8, "timestamp_ntz": 8, "decimal": 24, "string": 16, "binary": 16}


def broadcast_checked(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast-hint ``df`` only when it provably holds at most ``max_rows`` rows and
    ``MAX_BYTES``, by the width of its columns and the length of its strings.

    The check is a bounded action (a limit stops reading once the bound is exceeded), made
    each time, so that a table that has grown is not broadcast unchecked. Beyond the bound
    the frame is returned un-hinted and the join falls back to a shuffle join.
    """
    width = sum(WIDTHS.get(f.dataType.typeName(), 64) for f in df.schema.fields) + 16
    most = min(max_rows, MAX_BYTES // width)
    texts = [F.octet_length(f.name) for f in df.schema.fields if f.dataType.typeName() in ("string", "binary")]
    length = sum((F.coalesce(t, F.lit(0)) for t in texts), F.lit(0)).cast("long")
    rows, held = df.limit(most + 1).agg(F.count(F.lit(1)), F.sum(length)).first()
    return F.broadcast(df) if rows <= most and rows * width + (held or 0) <= MAX_BYTES else df
