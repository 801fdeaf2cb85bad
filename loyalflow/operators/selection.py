"""Exact percentiles by distributed selection.

Instead of sorting the values, each group is counted into a histogram (one
aggregate with a map-side partial; a bucket also keeps its smallest and largest
value). The running count of a group's buckets tells which bucket holds a wanted
rank. Most ranks are answered there: the first and the last rank of a bucket, and
every rank of a bucket with one value. What is left is refined: only values inside
an open bucket are counted again, one by one if they are few, else in equal-width
parts of the bucket, until no rank is open. Values are neither range-partitioned nor written; what passes between the
rounds is at most two rows per group and probability.

A window runs over the buckets of a group, whose number does not depend on its
rows (``PER_E`` buckets per factor e of magnitude, then ``PARTS``), so a group
holding a third of all rows is no larger there than any other.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .ranking import _encode_keys, telling_first

#: Buckets of the first histogram per factor e of magnitude, and parts of an open bucket in later rounds.
PER_E, PARTS = 48, 4096
#: Open buckets that may be broadcast to the values; values of an open bucket that are counted one by one.
OPEN_ROWS, SINGLE_ROWS = 1_000_000, 100_000


def _first_bucket(v: Column) -> Column:
    """A weakly rising function of the value, with ``PER_E`` steps per factor e; infinities stand outside."""
    step = F.least(F.floor(F.log1p(F.least(F.abs(v), F.lit(1e300))) * PER_E), F.lit(40_000)).cast("int")
    size = F.when(F.abs(v) == F.lit(float("inf")), F.lit(50_000)).otherwise(step)
    return F.when(v < 0, -size - 1).otherwise(size)


def _histogram(values: DataFrame, by: list, names: list[str]) -> DataFrame:
    return values.groupBy(*by).agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")) \
        .select(*names, "_b", "_c", "_lo", "_hi")


def _placed(hist: DataFrame, names: list[str]) -> DataFrame:
    """Adds ``_before``, the values of the group in smaller buckets."""
    up = Window.partitionBy(*names).orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return hist.withColumn("_before", F.sum("_c").over(up) - F.col("_c"))


def percentiles(df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float],
                num_partitions: int | None = None) -> DataFrame:
    """Exact linear-interpolation percentiles (``PERCENTILE_CONT`` / ``Series.quantile``)
    of ``value`` per group, one output column per entry of ``probs``; NULL and NaN are ignored
    and a group without a value has no row. NULL keys are a group of their own.

    ``df`` is read once per round: one, a second for ranks inside a bucket of several values, and
    one more per factor ``PARTS`` by which a bucket exceeds ``SINGLE_ROWS``.
    """
    keys = list(keys)
    raw = df.select(*keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    values, ek, added = _encode_keys(raw, keys)
    values = values.select(*ek, "_v")
    originals = [F.when(~F.col(f"__kn{i}"), F.col(f"__kv{i}")).alias(k) if f"__kv{i}" in added else F.col(k)
                 for i, k in enumerate(keys)]

    if num_partitions:  # tests: more partitions than the values need
        values = values.repartition(num_partitions)
    placed = _placed(_histogram(values, [*ek, _first_bucket(F.col("_v")).alias("_b")], ek), ek)
    whole = Window.partitionBy(*ek)
    placed = placed.withColumn("_n", F.sum("_c").over(whole))
    wanted = []
    for name, p in probs.items():
        at = F.lit(float(p)) * (F.col("_n") - 1).cast("double")
        for end, rank in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            wanted.append(F.struct(F.lit(f"{name}_{end}").alias("name"), rank.cast("long").alias("rank"),
                                   (at - F.floor(at)).alias("part")))
    here = F.filter(F.array(*wanted), lambda w: (w["rank"] >= F.col("_before")) & (w["rank"] < F.col("_before") + F.col("_c")))
    found = (placed.select(*ek, "_c", "_lo", "_hi", "_before", F.explode(here).alias("_w"))
             .select(*ek, "_c", "_lo", "_hi", F.col("_w.name").alias("_name"), F.col("_w.part").alias("_part"),
                     (F.col("_w.rank") - F.col("_before")).alias("_at")))
    found = cut_lineage(found)

    answer = F.when((F.col("_at") == 0) | (F.col("_lo") == F.col("_hi")), F.col("_lo")).when(F.col("_at") == F.col("_c") - 1, F.col("_hi"))
    answered = []
    while True:
        found = found.withColumn("_answer", answer)
        answered.append(found.where(F.col("_answer").isNotNull()).select(*ek, "_name", "_part", "_answer"))
        left = found.where(F.col("_answer").isNull()).select(
            *ek, "_name", "_part", "_at", F.col("_lo").alias("_from"), F.col("_hi").alias("_to"), F.col("_c").alias("_held"))
        size = left.agg(F.count(F.lit(1)).alias("n"), F.max("_held").alias("held")).first()
        if not size.n:
            break
        open_ = left.select(*ek, "_from", "_to").distinct()
        inside = values.join(F.broadcast(open_) if size.n <= OPEN_ROWS else open_, ek).where(
            F.col("_v").between(F.col("_from"), F.col("_to")))
        last = size.held <= SINGLE_ROWS  # few enough to count every value
        part = F.floor((F.col("_v") - F.col("_from")) / (F.col("_to") - F.col("_from")) * PARTS).cast("int")
        names = [*ek, "_from"]
        hist = _placed(_histogram(inside, [*names, (F.col("_v") if last else part).alias("_b")], names), names)
        holds = (F.col("_at") >= F.col("_before")) & (F.col("_at") < F.col("_before") + F.col("_c"))
        found = left.join(hist, names).where(holds).select(
            *ek, "_c", "_lo", "_hi", "_name", "_part", (F.col("_at") - F.col("_before")).alias("_at"))
        if last:
            answered.append(found.select(*ek, "_name", "_part", F.col("_lo").alias("_answer")))
            break
        found = cut_lineage(found)

    every = reduce(lambda a, b: a.unionByName(b), answered)
    aggs = [F.max(F.when(F.col("_name") == f"{n}_{end}", F.col("_answer"))).alias(f"_{n}_{end}") for n in probs for end in ("lo", "hi")]
    aggs += [F.max(F.when(F.col("_name") == f"{n}_lo", F.col("_part"))).alias(f"_{n}_fr") for n in probs]
    outs = [(F.col(f"_{n}_lo") + F.col(f"_{n}_fr") * (F.col(f"_{n}_hi") - F.col(f"_{n}_lo"))).alias(n) for n in probs]
    return every.groupBy(*ek).agg(*aggs).select(*originals, *outs)


def median(df: DataFrame, keys: Sequence[str], value: str, name: str | None = None,
           num_partitions: int | None = None) -> DataFrame:
    return percentiles(df, keys, value, {name or f"median_{value}": 0.5}, num_partitions)


def with_ranks(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Adds ``_v``, the value as a double, ``_r``, its rank within the group (from 0; NULL and NaN last), and
    ``_n``, the values of the group, for :func:`median_of_ranks`. A window: for groups that a task can hold, in
    frames that lie together by the keys, or some of them, already; these are not exchanged again."""
    v = F.col(value).cast("double")
    order = Window.partitionBy(*telling_first(keys)).orderBy(F.col("_v").asc_nulls_last())
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.withColumn("_v", F.when(~F.isnan(v), v)).withColumns(
        {"_r": F.row_number().over(order) - 1, "_n": F.count("_v").over(whole)})


def median_of_ranks() -> Column:
    """Aggregate: the median of a group of :func:`with_ranks`, as :func:`median` interpolates it."""
    at = F.lit(0.5) * (F.col("_n") - 1).cast("double")
    lo, hi = (F.max(F.when((F.col("_r") == r.cast("long")) & F.col("_v").isNotNull(), F.col("_v"))) for r in (F.floor(at), F.ceil(at)))
    return lo + F.max(at - F.floor(at)) * (hi - lo)
