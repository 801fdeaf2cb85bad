"""N-gram Jaccard join: MinHash bands find candidates, full n-gram sets decide.

Documents with the same set of word n-grams are one class. Classes that share a
band are chained to the smallest of the bucket; the connected groups then get
the full sets, shuffled once, and every pair of a group is compared exactly. The
links are counted and thinned to a forest where they are found, so no pair
leaves a task; large groups are dealt out as pairs of blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loyalflow.llm.common import materialize, unused
from loyalflow.llm.components import components

#: Characters that separate words.
BLANKS = " \t\n\x0b\x0c\r"


def choose_bands(threshold: float, recall: float = 0.999, most_hashes: int = 128) -> tuple[int, int]:
    """(bands, rows) with the most rows whose bands find a pair at ``threshold`` with probability ``recall``."""
    best = None
    for rows in range(1, most_hashes + 1):
        bands = max(1, math.ceil(math.log(1 - recall) / math.log1p(-threshold ** rows))) if threshold < 1 else 1
        if bands * rows > most_hashes:
            break
        best = bands, rows
    if best is None:
        raise ValueError("no bands reach this recall with so few hashes")
    return best


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit changes every output bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Shingler:
    """Sets of word n-grams as sorted 64-bit hashes; word hashes are kept in a bounded memo."""

    def __init__(self, size: int, most_words: int = 250_000):
        import xxhash

        self.size, self.most = size, most_words
        self.hash_of = xxhash.xxh3_64_intdigest
        self.known: dict[str, int] = {}
        self.blank = str.maketrans(dict.fromkeys("\x0b\x0c\r\n\t", " "))

    def words(self, text: str) -> np.ndarray:
        words = [w for w in text.translate(self.blank).split(" ") if w] if text else []
        values = list(map(self.known.get, words))
        if None in values:
            if len(self.known) > self.most:
                self.known.clear()
            for i, v in enumerate(values):
                if v is None:
                    w = words[i]
                    values[i] = self.known[w] = self.hash_of(w.encode())
        return np.asarray(values, dtype=np.uint64)

    def __call__(self, text: str) -> np.ndarray:
        """A text of fewer words is one n-gram of all of them; a text without words has none."""
        w = self.words(text)
        if not len(w):
            return w
        n = min(self.size, len(w))
        grams = np.zeros(len(w) - n + 1, dtype=np.uint64)
        for k in range(n):
            grams = mix(grams * np.uint64(0x9E3779B97F4A7C15) + w[k:len(w) - n + 1 + k])
        return np.unique(grams)


def signatures(grams: np.ndarray, seeds: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key per band: the band's minima over the set, one odd multiplier and offset per row."""
    least = np.empty(len(seeds), dtype=np.uint64)
    for lo in range(0, len(seeds), 8):  # few rows at a time bound the memory for long texts
        part = seeds[lo:lo + 8]
        values = grams[None, :] * (part[:, None] | np.uint64(1)) + (part[:, None] >> np.uint64(7))
        least[lo:lo + 8] = (values ^ (values >> np.uint64(29))).min(axis=1)
    keys = np.arange(1, bands + 1, dtype=np.uint64)
    for row in least.reshape(bands, -1).T:
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + row)
    return keys


def features(docs: DataFrame, size: int, bands: int, rows: int, id_col: str, text_col: str) -> DataFrame:
    """(_id, _class, _bands, _grams): the id, the 128-bit digest of the n-gram set, its band keys and size."""
    seeds = mix(np.arange(1, bands * rows + 1, dtype=np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        shingle = Shingler(size)
        for batch in batches:
            classes, keys, sizes = [], [], []
            for text in batch.column(1):
                grams = shingle(text.as_py() or "")
                sizes.append(len(grams))
                classes.append(xxhash.xxh3_128_digest(grams.tobytes()) if len(grams) else None)
                keys.append(signatures(grams, seeds, bands).view(np.int64) if len(grams) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(classes, pa.binary()), pa.array(keys, pa.list_(pa.int64())),
                 pa.array(sizes, pa.int64())], names=["_id", "_mark", "_class", "_bands", "_grams"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"), mark_of(text_col))
            .mapInArrow(run, f"_id {kind}, _mark long, _class binary, _bands array<bigint>, _grams long"))


def mark_of(text_col: str) -> Column:
    """What tells texts of one id, or without an id, apart."""
    return F.xxhash64(F.col(text_col).cast("string")).alias("_mark")


def gram_sets(docs: DataFrame, size: int, text_col: str) -> DataFrame:
    """(_class, _copies, _group, _set) of rows that already carry _class, _copies and _group: their full n-gram sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        last = None
        shingle = Shingler(size)
        for batch in batches:
            sets, keep = [], []
            for text, known in zip(batch.column(0), batch.column(1), strict=True):
                known = known.as_py()
                if known == last:  # copies stand together
                    keep.append(False)
                    sets.append(None)
                    continue
                data = shingle(text.as_py() or "").tobytes()
                keep.append(xxhash.xxh3_128_digest(data) == known)  # marks of different texts can be equal
                sets.append(data)
                last = known if keep[-1] else last
            batch = pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(sets, pa.binary())],
                                               names=["_class", "_copies", "_group", "_set"])
            yield batch.filter(pa.array(keep, pa.bool_()))

    return (docs.select(F.col(text_col).cast("string").alias("_text"), "_class", "_copies", "_group")
            .mapInArrow(run, "_class binary, _copies long, _group binary, _set binary"))


def links_of(sets: list[np.ndarray], rows: np.ndarray, cols: np.ndarray, threshold: float,
             columns: int = 4096) -> np.ndarray:
    """Which of ``rows`` and ``cols`` (positions in ``sets``) have a Jaccard similarity of ``threshold`` or more."""
    both = np.unique(np.concatenate([rows, cols]))
    grams = np.concatenate([sets[i] for i in both])
    owner = np.repeat(np.arange(len(both)), [len(sets[i]) for i in both])
    _, gram, count = np.unique(grams, return_inverse=True, return_counts=True)
    shared = count[gram] > 1  # the others are in no intersection
    gram, owner = np.unique(gram[shared], return_inverse=True)[1], owner[shared]
    order = np.argsort(gram, kind="stable")
    gram, owner = gram[order], owner[order]
    at_row, at_col = np.searchsorted(both, rows), np.searchsorted(both, cols)
    common = np.zeros((len(rows), len(cols)), dtype=np.float32)
    top = int(gram[-1]) + 1 if len(gram) else 0
    for lo in range(0, top, columns):
        i, j = np.searchsorted(gram, [lo, lo + columns])
        has = np.zeros((len(both), min(columns, top - lo)), dtype=np.float32)
        has[owner[i:j], gram[i:j] - lo] = 1
        common += has[at_row] @ has[at_col].T
    size = np.asarray([len(s) for s in sets], dtype=np.float64)
    # whole numbers up to 2 ** 24 are exact in float32
    return common >= threshold * (size[rows][:, None] + size[cols][None, :] - common) - 1e-9


def forest(n: int, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Of the links (a, b), those that first connect two parts."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = root(x), root(y)
        if p != q:
            parent[max(p, q)] = min(p, q)
            out.append((x, y))
    return out


def _linked(docs: DataFrame, id_col: str, text_col: str, size: int = 5, threshold: float = 0.8, recall: float = 0.999,
            block: int = 1024, block_grams: int = 4_000_000) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): _id, _mark and _class of every document; of every class its _copies, the _first id (the
    smallest, if a copy has one) and the _mark of that text, its _links to other classes and its component, _root."""
    bands, rows = choose_bands(threshold, recall)
    feats = materialize(features(docs, size, bands, rows, id_col, text_col), "grams")
    kind = feats.schema["_id"].dataType.simpleString()
    classes = materialize(feats.where(F.col("_class").isNotNull()).groupBy("_class")
                          .agg(F.count(F.lit(1)).alias("_copies"),
                               F.min(F.struct(F.col("_id").isNull().alias("_none"), "_id", "_mark")).alias("_least"))
                          .select("_class", "_copies", F.col("_least._id").alias("_first"),
                                  F.col("_least._mark").alias("_mark")), "classes")

    keys = feats.where(F.col("_class").isNotNull()).select("_class", F.explode("_bands").alias("_key"))
    buckets = (keys.groupBy("_key").agg(F.min("_class").alias("_least"), F.max("_class").alias("_most"))
               .where("_least < _most").select("_key", "_least"))
    chain = (keys.join(buckets, "_key").where(F.col("_class") > F.col("_least"))
             .select(F.col("_least").alias("a"), F.col("_class").alias("b")).distinct())
    groups = components(chain).select(F.col("node").alias("_class"), F.col("component").alias("_group"))

    # the full sets of the classes in question, each made from one text; the texts are shuffled once, at every size.
    # A row meets only the class of its own text, also where an id is null or stands on many texts
    wanted = materialize(groups.join(classes, "_class"), "wanted").hint("merge")
    text = docs.select(F.col(id_col).alias("_first"), F.col(text_col).alias("_text"), mark_of(text_col))
    same = (text["_mark"] == wanted["_mark"]) & text["_first"].eqNullSafe(wanted["_first"])
    found = text.join(wanted, same).drop(wanted["_first"])
    sets = materialize(gram_sets(found, size, "_text"), "sets")
    sums = (sets.groupBy("_group").agg(F.count(F.lit(1)).alias("_n"), F.sum(F.length("_set") / 8).alias("_sum"))
            .select("_group", F.ceil(F.greatest(F.col("_n") / block, F.col("_sum") / block_grams)).cast("int").alias("_parts")))
    dealt = (sets.join(sums, "_group")
             .withColumn("_part", F.pmod(F.xxhash64("_class"), F.col("_parts")).cast("int"))
             .withColumn("_with", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
             .select("_class", "_copies", "_group", "_set", "_part", F.least("_part", "_with").alias("_i"),
                     F.greatest("_part", "_with").alias("_j")))
    task = ["_group", "_i", "_j"]
    dealt = dealt.repartition(*task).sortWithinPartitions(*task)
    pairs = materialize(dealt.mapInArrow(_compare(threshold), "kind int, a binary, b binary, n long"), "links")

    counted = pairs.where("kind = 0").groupBy(F.col("a").alias("_class")).agg(F.sum("n").alias("_links"))
    linked = components(pairs.where("kind = 1")).select(F.col("node").alias("_class"), F.col("component").alias("_root"))
    classes = (classes.join(counted, "_class", "left").join(linked, "_class", "left")
               .withColumn("_root", F.coalesce("_root", "_class")))
    return feats.select("_id", "_mark", "_class"), classes


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: id, n_links, component_id and kept.

    n_links: other documents whose set of ``size``-word n-grams (5) has a Jaccard
    similarity of ``threshold`` (0.8) or more; component_id: the smallest id reachable
    by links, itself included; kept: whether the id is that one. Texts of fewer
    words are one n-gram. A text without words (null, empty, blank) links with
    nothing. Repeated rows of a text are links of each other; a row without an id
    takes part, but names no component unless all of it is without. An empty table
    gives no rows.
    """
    rows, classes = _linked(docs, id_col, text_col, **options)
    kind = rows.schema["_id"].dataType.simpleString()
    smallest = classes.groupBy("_root").agg(F.min("_first").alias("_component"))
    verdicts = (classes.join(smallest, "_root")
                .select("_class", (F.col("_copies") - 1 + F.coalesce("_links", F.lit(0))).alias("_links"), "_component"))
    return (rows.select("_id", "_class").join(verdicts, "_class", "left")
            .select(F.col("_id").alias(id_col), F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("_component", "_id").cast(kind).alias("component_id"))
            .withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id"))))


def _compare(threshold: float):
    """Task body: rows sorted by (_group, _i, _j) to links counted per class (kind 0) and a forest of them (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int32(), pa.binary(), pa.binary(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                              names=["kind", "a", "b", "n"])

        def solve(held: list[tuple]) -> list[tuple]:
            seen: dict[bytes, tuple] = {}
            for r in held:  # copies of one id's text give a class twice
                seen.setdefault(r[0], r)
            rows = sorted(seen.values(), key=lambda r: r[0])
            (_, i, j) = held[0][4]
            sets = [np.frombuffer(r[2], dtype=np.uint64) for r in rows]
            part = np.asarray([r[3] for r in rows])
            copies = np.asarray([r[1] for r in rows], dtype=np.int64)
            left, right = np.flatnonzero(part == i), np.flatnonzero(part == j)
            if not len(left) or not len(right):
                return []
            counts = np.zeros(len(rows), dtype=np.int64)
            starts, ends = [], []
            for lo in range(0, len(left), 256):
                block = left[lo:lo + 256]
                hit = links_of(sets, block, right, threshold)
                hit &= block[:, None] != right[None, :]
                counts[block] += hit @ copies[right]
                if i != j:
                    counts[right] += copies[block] @ hit
                x, y = np.nonzero(hit)
                starts.append(block[x])
                ends.append(right[y])
            a, b = np.concatenate(starts), np.concatenate(ends)
            out = [(0, rows[k][0], None, int(counts[k])) for k in np.flatnonzero(counts).tolist()]
            return out + [(1, rows[x][0], rows[y][0], None) for x, y in forest(len(rows), a, b)]

        held: list[tuple] = []
        out: list[tuple] = []
        for batch in batches:
            for c, n, g, s, p, i, j in zip(*[batch.column(k).to_pylist() for k in
                                             ("_class", "_copies", "_group", "_set", "_part", "_i", "_j")], strict=True):
                if held and held[0][4] != (g, i, j):
                    out += solve(held)
                    held = []
                    if len(out) > 20_000:
                        yield batch_of(out)
                        out = []
                held.append((c, n, s, p, (g, i, j)))
        if held:
            out += solve(held)
        if out:
            yield batch_of(out)

    return run


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents with one row left of each group of near duplicates.

    That of the smallest id; of several texts of that id, and in a group without
    ids, the text of the smallest hash. So repeated rows leave one, and an id that
    stands on texts of two groups can stay twice. A text without words is near to
    nothing and stays, once per id; rows with neither an id nor words all stay.
    All columns stay.
    """
    rows, classes = _linked(docs, id_col, text_col, **options)
    first = F.min(F.struct(F.col("_first").isNull().alias("_none"), "_first", "_mark")).alias("_least")
    kept = materialize(classes.groupBy("_root").agg(first)
                       .select(F.col("_least._first").alias("_kept"), F.col("_least._mark").alias("_of")), "kept")
    blank = rows.where("_class IS NULL AND _id IS NOT NULL").select("_id", "_mark").distinct()
    mark = unused(docs, "row_mark")
    docs = docs.withColumn(mark, mark_of(text_col))
    known = docs.where(F.col(id_col).isNotNull())
    stays = kept.where("_kept IS NOT NULL").union(blank).hint("merge")
    known = (known.join(stays, (known[id_col] == stays["_kept"]) & (known[mark] == stays["_of"]), "left_semi")
             .dropDuplicates([id_col, mark, text_col]))
    # copies without an id are combined before they are shuffled, however many they are
    worded = F.coalesce(F.col(text_col).cast("string").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    nameless = docs.where(F.col(id_col).isNull())
    texts = nameless.where(worded).dropDuplicates([mark, text_col])
    stays = kept.where("_kept IS NULL").hint("merge")
    texts = texts.join(stays, texts[mark] == stays["_of"], "left_semi")
    return known.unionByName(texts).unionByName(nameless.where(~worded)).drop(mark)
