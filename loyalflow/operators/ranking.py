"""Skew-safe ordered operators: positions within groups and lag.

The obvious Spark forms - a window partitioned by the group key, or the
``percentile`` aggregate - move a whole group into one task. When one key
holds a third of all rows that task is the job. The operators here split
every group across tasks instead:

1. range-partition on ``(group keys, order keys)`` - the sampler cuts a hot
   group into many contiguous chunks, each at most one partition,
2. running sums inside each ``(group, chunk)`` (bounded window),
3. a chunk table (one row per group x chunk, at most ``#groups + #partitions``
   rows) gives each chunk's offset inside its group,
4. one join back turns chunk-local positions into group positions.

All steps are built-in DataFrame operators. The chunked frame is written once
as a reliable checkpoint to the shared folder (``spark.checkpoint.dir``) before
its two uses, so chunk ids always agree (a recomputed range exchange could
sample different bounds) and the work survives executor loss.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage


def _parts(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return num_partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _sentinel(dt: T.DataType) -> Column:
    if isinstance(dt, T.StringType):
        return F.lit("")
    if isinstance(dt, T.BooleanType):
        return F.lit(False)
    if isinstance(dt, T.DateType):
        return F.lit("1970-01-01").cast("date")
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.lit("1970-01-01 00:00:00").cast(dt)
    return F.lit(0).cast(dt)


def _encode_keys(df: DataFrame, keys: Sequence[str]):
    """Group keys usable in plain equi-joins: each nullable key becomes
    (value-or-sentinel, is-null). NULL keys still form their own group, and the
    joins below stay plain equi-joins on the columns the frame is already
    partitioned by (a null-safe ``<=>`` join would re-key and re-shuffle it)."""
    fields = {f.name: f for f in df.schema.fields}
    cols, enc = {}, []
    for i, k in enumerate(keys):
        f = fields[k]
        if not f.nullable:
            enc.append(k)
            continue
        v, n = f"__kv{i}", f"__kn{i}"
        cols[v] = F.coalesce(F.col(k), _sentinel(f.dataType))
        cols[n] = F.col(k).isNull()
        enc += [v, n]
    return (df.withColumns(cols) if cols else df), enc, list(cols)


def _orderable(df: DataFrame, exclude) -> list[Column]:
    """Columns usable as trailing tie-breakers (map-typed columns cannot be ordered)."""
    return [F.col(f.name) for f in df.schema.fields
            if f.name not in exclude and not isinstance(f.dataType, T.MapType)]


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def positions(df: DataFrame, keys: Sequence[str], order: Sequence, weight: str | None = None,
              num_partitions: int | None = None, keep_chunk: bool = False) -> DataFrame:
    """Add ``_start`` (0-based position of the row's first unit in group order)
    and ``_n`` (total weight of the group). ``weight`` defaults to 1 per row.
    ``keep_chunk`` keeps the chunk id ``_pid`` (the task that handled the row).

    Every other (orderable) column takes part in the ordering as a trailing
    tie-breaker, so positions are reproducible even when ``order`` has ties.
    """
    keys = list(keys)
    order = _cols(order)
    n_parts = _parts(df, num_partitions)
    w = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    base, ek, added = _encode_keys(df.withColumn("_w", w), keys)
    extra = _orderable(base, set(keys) | set(added) | {"_w"})
    full_order = order + extra + [F.col("_w")]
    r = (base.repartitionByRange(n_parts, *[F.col(k) for k in ek], *order)
         .withColumn("_pid", F.spark_partition_id()))
    in_chunk = (Window.partitionBy(*ek, "_pid").orderBy(*full_order)
                .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    whole_chunk = Window.partitionBy(*ek, "_pid")
    r = r.withColumn("_cum", F.sum("_w").over(in_chunk)).withColumn("_cw", F.sum("_w").over(whole_chunk))
    # Materialize once (reliable checkpoint in the shared folder): the rows and the
    # chunk table must see the same range bounds, whatever the upstream plan is. The
    # checkpoint keeps the (keys, chunk) hash partitioning, so the join below does not
    # re-shuffle the rows.
    r = cut_lineage(r)
    chunks = r.where(F.col("_cum") == F.col("_cw")).select(*ek, "_pid", "_cw")
    before = Window.partitionBy(*ek).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select(
        *ek, "_pid",
        F.coalesce(F.sum("_cw").over(before), F.lit(0)).cast("long").alias("_off"),
        F.sum("_cw").over(Window.partitionBy(*ek)).cast("long").alias("_n"),
    )
    out = r.join(chunks, ek + ["_pid"])
    out = out.withColumn("_start", F.col("_off") + F.col("_cum") - F.col("_w"))
    return out.drop("_off", "_cum", "_cw", *added, *([] if keep_chunk else ["_pid"]))


def row_positions(df: DataFrame, keys: Sequence[str], order: Sequence,
                  num_partitions: int | None = None) -> DataFrame:
    """Exact 0-based row rank ``_rank`` and group size ``_n`` (order must be total)."""
    return positions(df, keys, order, None, num_partitions).withColumnRenamed("_start", "_rank").drop("_w")


def lag_in_order(df: DataFrame, keys: Sequence[str], order: Sequence, value: str, out: str,
                 num_partitions: int | None = None) -> DataFrame:
    """``LAG(value) OVER (PARTITION BY keys ORDER BY order)`` without sending a group to one task.

    Each range chunk computes its local lag; the first row of a chunk takes the
    last value of the previous chunk of the same group from the chunk table.
    All other (orderable) columns are trailing tie-breakers, so the result is
    reproducible even when ``order`` has ties.
    """
    keys = list(keys)
    order = _cols(order)
    n_parts = _parts(df, num_partitions)
    base, ek, added = _encode_keys(df, keys)
    extra = _orderable(df, set(keys))
    full_order = order + extra
    r = (base.repartitionByRange(n_parts, *[F.col(k) for k in ek], *order)
         .withColumn("_pid", F.spark_partition_id()))
    w = Window.partitionBy(*ek, "_pid").orderBy(*full_order)
    whole = Window.partitionBy(*ek, "_pid")
    r = (r.withColumn(out, F.lag(value).over(w)).withColumn("_rn", F.row_number().over(w))
         .withColumn("_cnt", F.count(F.lit(1)).over(whole)))
    r = cut_lineage(r)
    last = r.where(F.col("_rn") == F.col("_cnt")).select(*ek, "_pid", F.col(value).alias("_last"))
    carry = last.select(*ek, "_pid",
                        F.lag("_last").over(Window.partitionBy(*ek).orderBy("_pid")).alias("_carry"))
    j = r.join(carry, ek + ["_pid"], "left")
    return (j.withColumn(out, F.when(F.col("_rn") == 1, F.col("_carry")).otherwise(F.col(out)))
            .drop("_pid", "_rn", "_cnt", "_carry", *added))


#: Rows of a group above which its lag is taken in chunks.
HOT_ROWS = 5_000_000


def lag(df: DataFrame, keys: Sequence[str], order: Sequence, value: str, out: str,
        hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """``LAG(value) OVER (PARTITION BY keys ORDER BY order)``, as a window where groups are small.

    Groups are counted first. Those of more than ``hot_rows`` rows (at most
    rows / ``hot_rows`` of them) go through :func:`lag_in_order`, which splits them among
    tasks; all others need one hash exchange on the keys, which later aggregates on them
    or more columns use as well. ``df`` is read twice: pass a written table. Ties as there.
    ``hot_rows`` None says that no group is large: nothing is counted.
    """
    keys = list(keys)

    def windowed(rows: DataFrame) -> DataFrame:
        w = Window.partitionBy(*telling_first(keys)).orderBy(*_cols(order), *_orderable(df, set(keys)))
        return rows.withColumn(out, F.lag(value).over(w))

    rest, hot = split_hot(df, keys, hot_rows)
    return windowed(rest) if hot is None else windowed(rest).unionByName(lag_in_order(hot, keys, order, value, out))


def telling_first(keys: Sequence[str]) -> list[str]:
    """The keys with the tenant, which stands first and has few values, at the end: a sort compares its first column
    as a number beside each row, and looks into the rows only where that is equal."""
    return [*keys[1:], *keys[:1]]


def rows_per_group(rows: DataFrame, ids: DataFrame, on: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """``_rows`` of the groups of ``rows`` joined with ``ids``, for :func:`split_hot`: rows are counted per ``on``
    (columns of ``rows``) before they are joined."""
    return (rows.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows")).join(ids, list(on))
            .select(*keys, "_rows"))


def split_hot(df: DataFrame, keys: Sequence[str], hot_rows: int | None = HOT_ROWS,
              counted: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Rows of the groups of at most ``hot_rows`` rows, and those of the larger ones (None where there
    are none, or where ``hot_rows`` is None). ``counted`` (the keys and ``_rows``, one or more rows a
    group) spares the count of ``df``, where its rows can be counted before they are made."""
    from .joins import broadcast_checked

    if hot_rows is None:
        return df, None
    base, ek, _ = _encode_keys(df, keys)
    if counted is None:
        sizes = base.groupBy(*ek).agg(F.count(F.lit(1)).alias("_rows"))
    else:
        sizes = _encode_keys(counted, keys)[0].groupBy(*ek).agg(F.sum("_rows").alias("_rows"))
    hot = cut_lineage(sizes.where(F.col("_rows") > hot_rows).select(*ek))
    if hot.isEmpty():
        return df, None
    few = broadcast_checked(hot, 1_000_000)
    return base.join(few, ek, "left_anti").select(*df.columns), base.join(few, ek, "left_semi").select(*df.columns)
