"""Output normalization shared by the Spark check queries and their SQL twins.

Money is summed exactly as decimal and handed out as double; ratios that are
compared approximately are rounded to a fixed number of decimals on both sides,
through an exact decimal(38,10) so that Spark (which rounds a double's shortest
decimal form) and DuckDB (which rounds the binary value) agree on ties.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType


def norm(df: DataFrame, money=(), rnd: dict | None = None) -> DataFrame:
    rnd = rnd or {}
    exprs = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, DecimalType) or f.name in money:
            exprs[f.name] = F.col(f.name).cast("double")
    for c, k in rnd.items():
        # round the exact decimal (10 places) so both engines round the same number
        exprs[c] = F.round(F.col(c).cast("double").try_cast("decimal(38,10)"), k).cast("double")
    return df.withColumns(exprs) if exprs else df


def sql_norm(body: str, money=(), rnd: dict | None = None) -> str:
    rnd = rnd or {}
    repl = [f"cast({c} AS DOUBLE) AS {c}" for c in money if c not in rnd]
    repl += [f"cast(round(TRY_CAST(cast({c} AS DOUBLE) AS DECIMAL(38,10)), {k}) AS DOUBLE) AS {c}"
             for c, k in rnd.items()]
    if not repl:
        return body
    return f"SELECT * REPLACE ({', '.join(repl)}) FROM (\n{body}\n) q"
