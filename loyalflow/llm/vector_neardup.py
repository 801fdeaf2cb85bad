"""Embedding near-duplicates by randomised-rotation binary codes.

Each vector is rotated at random and kept as its sign bits with a correction
factor: the inner product of the unit vector and its code. Code and factor give
an unbiased estimate of a pair's cosine with a confidence bound; only pairs whose
bound reaches the threshold are recomputed exactly. Candidates come from buckets
of further random sign bits, whose number follows the largest label. Pairs never
leave a task: links are counted and thinned to a forest where they are found.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from loyalflow.llm.common import materialize
from loyalflow.llm.components import components
from loyalflow.llm.ngram_join import forest


def rotations(dim: int, rows: int, seed: int) -> np.ndarray:
    """``rows`` directions of ``dim`` components, taken from random rotations one after the other."""
    rng = np.random.default_rng([seed, dim])
    made = [np.linalg.qr(rng.standard_normal((dim, dim)))[0] for _ in range(-(-rows // dim))]
    return np.concatenate(made)[:rows]


def choose_tables(largest: int, threshold: float, recall: float, bucket: int = 512) -> tuple[int, int]:
    """(tables, bits): bits so that a label's buckets hold about ``bucket`` vectors, tables for the recall at ``threshold``."""
    bits = min(40, max(4, math.ceil(math.log2(max(largest, 1) / bucket)) if largest > bucket else 4))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - agree))) if agree < 1 else 1, bits


class Codes:
    """Random-rotation codes for one dimension; kept per task."""

    def __init__(self, dim: int, tables: int, bits: int, seed: int):
        self.dim, self.tables, self.bits = dim, tables, bits
        self.rotation = rotations(dim, dim, seed)
        self.planes = rotations(dim, tables * bits, seed + 1)

    def index(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bucket key of each table, packed sign bits and correction factor of unit vectors."""
        sides = (unit @ self.planes.T > 0).reshape(len(unit), self.tables, self.bits)
        keys = sides @ (np.int64(1) << np.arange(self.bits, dtype=np.int64))
        turned = unit @ self.rotation.T
        return keys, np.packbits(turned > 0, axis=1), np.abs(turned).sum(axis=1) / math.sqrt(self.dim)

    def candidates(self, code: np.ndarray, factor: np.ndarray, query: np.ndarray, threshold: float,
                   sure: float) -> np.ndarray:
        """Whether the upper confidence bound of each (coded, query) cosine reaches the threshold."""
        signs = np.unpackbits(code, axis=1, count=self.dim).astype(np.float32) * 2 - 1
        turned = (query @ self.rotation.T).astype(np.float32)
        estimate = signs @ turned.T / (math.sqrt(self.dim) * factor.astype(np.float32))[:, None]
        room = sure * np.sqrt(np.maximum(0, 1 - factor ** 2)) / factor / math.sqrt(max(1, self.dim - 1))
        return estimate >= (threshold - room - 1e-4).astype(np.float32)[:, None]


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    threshold: float = 0.93, recall: float = 0.98, sure: float = 4.5, block: int = 2048,
                    seed: int = 7) -> DataFrame:
    """One row per vector: id, n_links, component_id and kept.

    Vectors are compared when their labels are equal and not null and they have
    as many components; two link when their cosine in double precision is
    ``threshold`` or more. ``recall`` is the chance that a pair just at the
    threshold shares a bucket (closer pairs: higher); ``sure`` the width of the
    confidence bound in deviations. component_id is the smallest id reachable by
    links; kept marks that one. A vector that is null, empty or zero, or holds
    null or non-finite components, links with nothing. Equal vectors are one
    class and link with each other. Buckets of more than ``block`` classes are
    dealt out as pairs of blocks. An empty table gives no rows.
    """
    wide = isinstance(vectors.schema[vector_col].dataType.elementType, DoubleType)
    kind = "<f8" if wide else "<f4"
    rows = vectors.select(F.col(id_col).alias("_id"), F.col(vector_col).cast("array<double>" if wide else "array<float>")
                          .alias("_v"), F.col(label_col).alias("_label"))
    id_kind, label_kind = (rows.schema[c].dataType.simpleString() for c in ("_id", "_label"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            data, classes = [], []
            for v, label in zip(batch.column(1), batch.column(2), strict=True):
                x = np.asarray(v.values.to_numpy(zero_copy_only=False) if v.is_valid else [], dtype=kind) + 0
                good = (label.is_valid and len(x) and v.values.null_count == 0 and bool(np.isfinite(x).all())
                        and bool(x.any()))
                data.append(x.tobytes() if good else None)
                classes.append(xxhash.xxh3_128_digest(x.tobytes()) if good else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(classes, pa.binary()),
                                              pa.array(data, pa.binary())], names=["_id", "_label", "_class", "_data"])

    feats = materialize(rows.mapInArrow(digest, f"_id {id_kind}, _label {label_kind}, _class binary, _data binary"), "vectors")
    classes = (feats.where(F.col("_class").isNotNull()).groupBy("_label", "_class")
               .agg(F.count(F.lit(1)).alias("_copies"), F.min("_id").alias("_first"), F.min("_data").alias("_data")))
    classes = materialize(classes.withColumn("_dim", F.length("_data")), "classes")
    largest = classes.groupBy("_label", "_dim").count().agg(F.max("count")).first()[0] or 0
    tables, bits = choose_tables(largest, threshold, recall)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, Codes] = {}
        for batch in batches:
            keys: list = [None] * batch.num_rows
            codes: list = [None] * batch.num_rows
            factors = np.zeros(batch.num_rows)
            dims = batch.column("_dim").to_numpy()
            data = batch.column("_data").to_pylist()
            for d in np.unique(dims).tolist():
                at = np.flatnonzero(dims == d).tolist()
                x = unit(np.frombuffer(b"".join([data[i] for i in at]), dtype=kind).reshape(len(at), -1))
                if d not in made:
                    made[d] = Codes(x.shape[1], tables, bits, seed)
                k, c, factors[at] = made[d].index(x)
                for i, a, b in zip(at, k, c, strict=True):
                    keys[i], codes[i] = a, b.tobytes()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.list_(pa.int64())),
                                              pa.array(codes, pa.binary()), pa.array(factors)],
                                             names=[*batch.schema.names, "_keys", "_code", "_factor"])

    # one name per class: equal vectors under two labels are two classes
    name = F.concat(F.col("_class"), F.unhex(F.sha2(F.col("_label").cast("string"), 256)))
    index = (classes.mapInArrow(code, f"_label {label_kind}, _class binary, _copies long, _first {id_kind}, _data binary, "
                                      "_dim int, _keys array<bigint>, _code binary, _factor double")
             .withColumn("_name", name))
    index = materialize(index, "codes")
    bucket = ["_label", "_dim", "_table", "_key"]
    large = (index.select("_label", "_dim", F.posexplode("_keys").alias("_table", "_key")).groupBy(*bucket).count()
             .where(F.col("count") > block).select(*bucket, F.ceil(F.col("count") / block).cast("int").alias("_parts")))
    dealt = (index.select("_label", "_dim", "_name", "_copies", "_data", "_code", "_factor", "_keys",
                          F.posexplode("_keys").alias("_table", "_key"))
             .join(large, bucket, "left").withColumn("_parts", F.coalesce("_parts", F.lit(1)))
             .withColumn("_part", F.pmod(F.xxhash64("_name"), F.col("_parts")).cast("int"))
             .withColumn("_with", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
             .select(*bucket, F.least("_part", "_with").alias("_i"), F.greatest("_part", "_with").alias("_j"), "_part",
                     "_name", "_copies", "_data", "_code", "_factor", "_keys"))
    task = [*bucket, "_i", "_j"]
    pairs = (dealt.repartition(*task).sortWithinPartitions(*task)
             .mapInArrow(_compare(kind, tables, bits, seed, threshold, sure), "kind int, a binary, b binary, n long"))
    pairs = materialize(pairs, "links")
    counted = pairs.where("kind = 0").groupBy(F.col("a").alias("_name")).agg(F.sum("n").alias("_links"))
    linked = components(pairs.where("kind = 1")).select(F.col("node").alias("_name"), F.col("component").alias("_root"))
    named = (index.select("_label", "_class", "_name", "_copies", "_first").join(counted, "_name", "left")
             .join(linked, "_name", "left").withColumn("_root", F.coalesce("_root", "_name")))
    smallest = named.groupBy("_root").agg(F.min("_first").alias("_component"))
    verdicts = (named.join(smallest, "_root")
                .select("_label", "_class", (F.col("_copies") - 1 + F.coalesce("_links", F.lit(0))).alias("_links"),
                        "_component"))
    return (feats.select("_id", "_label", "_class").join(verdicts, ["_label", "_class"], "left")
            .select(F.col("_id").alias(id_col), F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("_component", "_id").alias("component_id"))
            .withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id"))))


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _compare(kind: str, tables: int, bits: int, seed: int, threshold: float, sure: float):
    """Task body: buckets sorted by key to links counted per class (kind 0) and a forest of them (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, Codes] = {}

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int32(), pa.binary(), pa.binary(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                              names=["kind", "a", "b", "n"])

        def solve(held: list[dict]) -> list[tuple]:
            table, i, j = held[0]["_table"], held[0]["_i"], held[0]["_j"]
            part = np.asarray([r["_part"] for r in held])
            left, right = np.flatnonzero(part == i), np.flatnonzero(part == j)
            if not len(left) or not len(right) or len(held) < 2:
                return []
            x = np.frombuffer(b"".join([r["_data"] for r in held]), dtype=kind).reshape(len(held), -1)
            d = x.shape[1]
            if d not in made:
                made[d] = Codes(d, tables, bits, seed)
            x = unit(x)
            code = np.frombuffer(b"".join([r["_code"] for r in held]), dtype=np.uint8).reshape(len(held), -1)
            factor = np.asarray([r["_factor"] for r in held])
            keys = np.asarray([r["_keys"][:table] for r in held], dtype=np.int64).reshape(len(held), -1)
            copies = np.asarray([r["_copies"] for r in held], dtype=np.int64)
            counts = np.zeros(len(held), dtype=np.int64)
            starts, ends = [], []
            for lo in range(0, len(left), 512):
                rows = left[lo:lo + 512]
                maybe = made[d].candidates(code[rows], factor[rows], x[right], threshold, sure)
                if i == j:
                    maybe &= rows[:, None] < right[None, :]
                a, b = np.nonzero(maybe)
                a, b = rows[a], right[b]
                for at in range(0, len(a), 1 << 15):
                    p, q = a[at:at + (1 << 15)], b[at:at + (1 << 15)]
                    new = ~(keys[p] == keys[q]).any(axis=1)  # not found in an earlier table
                    p, q = p[new], q[new]
                    link = np.einsum("ij,ij->i", x[p], x[q]) >= threshold
                    p, q = p[link], q[link]
                    np.add.at(counts, p, copies[q])
                    np.add.at(counts, q, copies[p])
                    starts.append(p)
                    ends.append(q)
            out = [(0, held[k]["_name"], None, int(counts[k])) for k in np.flatnonzero(counts).tolist()]
            if starts:
                a, b = np.concatenate(starts), np.concatenate(ends)
                out += [(1, held[p]["_name"], held[q]["_name"], None) for p, q in forest(len(held), a, b)]
            return out

        held: list[dict] = []
        out: list[tuple] = []
        key = None
        for batch in batches:
            for r in batch.to_pylist():
                this = (r["_label"], r["_dim"], r["_table"], r["_key"], r["_i"], r["_j"])
                if held and this != key:
                    out += solve(held)
                    held = []
                    if len(out) > 20_000:
                        yield batch_of(out)
                        out = []
                key = this
                held.append(r)
        if held:
            out += solve(held)
        if out:
            yield batch_of(out)

    return run
