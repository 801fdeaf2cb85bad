"""Phrase collocations, counted with HAT-tries.

Words are counted first; only those with enough occurrences can stand in a
phrase, so the others end a window. Each task then counts windows of up to four
words in a trie of word ids whose leaves are hash containers; a container that
grows too large bursts into a node one word deeper. A full trie spills whole
subtrees as sorted runs, dealt out by the windows' first two words (the prefix
partition), where runs are merged and the counts of all phrases with that prefix
are read off. Scores, containment and ranks are joins and aggregates.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loyalflow.llm.common import materialize
from loyalflow.operators.joins import broadcast_checked

LONGEST = 4
BITS = 21  # of a word's number within a task; three of them are a container's key
MASK = (1 << BITS) - 1
#: Separators of pieces become this byte, which UTF-8 never uses.
BREAK = b"\xff"
_TABLE = bytes(c + 32 if 65 <= c <= 90 else 0xFF if c in b".,;:!?\n\x0b\x0c\r" else c for c in range(256))
NO_LANG = "und"
SEED = 42


def tokens(text: str) -> list[bytes]:
    """Words of a text, with ``BREAK`` between pieces and at the end."""
    return (text.encode().translate(_TABLE).replace(BREAK, b" \xff ") + b" \xff").split()


def word_counts(docs: DataFrame, id_salt: str = "", text_col: str = "text", lang_col: str = "lang", flush: int = 400_000) -> DataFrame:
    """(lang, word, n, id): occurrences of every word; ``id`` is its 64-bit hash within its language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def counted() -> Iterator[pa.RecordBatch]:
            for lang, words in held.items():
                words.pop(BREAK, None)
                if words:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(words), pa.string()), pa.array(words.keys(), pa.binary()),
                         pa.array(words.values(), pa.int64())], names=["lang", "word", "n"])
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held.setdefault(lang, Counter()).update(tokens(text.as_py()))
                if sum(map(len, held.values())) > flush:
                    yield from counted()
        yield from counted()

    parts = _texts(docs, text_col, lang_col).mapInArrow(run, "lang string, word binary, n long")
    return (parts.groupBy("lang", F.col("word").cast("string").alias("word")).agg(F.sum("n").alias("n"))
            .withColumn("id", F.xxhash64(F.concat(F.lit(id_salt), "lang", F.lit("\t"), "word"))))


def _texts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


class Trie:
    """Counts windows of up to four word numbers.

    The root leads from the first word to a child. A child is a hash container
    (a dict from the packed rest of the window to its count) or, once it has more
    than ``burst`` entries, a node that leads on by the next word.
    """

    def __init__(self, burst: int = 4096):
        self.burst, self.children, self.sizes = burst, {}, {}

    def __len__(self) -> int:
        return sum(self.sizes.values())

    def add(self, first: np.ndarray, rest: np.ndarray) -> None:
        """Count windows given as first words and packed rests."""
        order = np.lexsort((rest, first))
        first, rest = first[order], rest[order]
        heads, at = np.unique(first, return_index=True)
        for head, a, b in zip(heads.tolist(), at.tolist(), [*at[1:].tolist(), len(first)], strict=True):
            child, new = self._insert(self.children.get(head), rest[a:b], 2 * BITS)
            self.children[head] = child
            self.sizes[head] = self.sizes.get(head, 0) + new

    def _insert(self, child, rest: np.ndarray, shift: int):
        """The child after counting, and how many entries are new. ``shift`` is where the next word begins."""
        if child is None:
            child = {}
        if isinstance(child, dict):
            before = len(child)
            for key in rest.tolist():
                child[key] = child.get(key, 0) + 1
            new = len(child) - before
            if shift and len(child) > self.burst:
                child = self._burst(child, shift)
            return child, new
        heads, at = np.unique(rest >> shift, return_index=True)
        new = 0
        for head, a, b in zip(heads.tolist(), at.tolist(), [*at[1:].tolist(), len(rest)], strict=True):
            child.next[head], more = self._insert(child.next.get(head), rest[a:b] & ((1 << shift) - 1), shift - BITS)
            new += more
        return child, new

    @staticmethod
    def _burst(container: dict, shift: int) -> Node:
        node = Node()
        for key, count in container.items():
            node.next.setdefault(key >> shift, {})[key & ((1 << shift) - 1)] = count
        return node

    def spill(self, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Takes out whole subtrees, largest first, until at most ``keep`` entries are left: first words, rests, counts."""
        first, rest, counts, left = [], [], [], len(self)
        for head in sorted(self.sizes, key=self.sizes.get, reverse=True):
            if left <= keep:
                break
            left -= self.sizes.pop(head)
            before = len(rest)
            self._entries(self.children.pop(head), 0, 2 * BITS, rest, counts)
            first += [head] * (len(rest) - before)
        return np.asarray(first, np.int64), np.asarray(rest, np.int64), np.asarray(counts, np.int64)

    def _entries(self, child, prefix: int, shift: int, rest: list, counts: list) -> None:
        if isinstance(child, dict):
            rest += [prefix | key for key in child]
            counts += child.values()
        else:
            for head, deeper in child.next.items():
                self._entries(deeper, prefix | head << shift, shift - BITS, rest, counts)


class Node:
    """A burst container: one level deeper by word number."""

    def __init__(self):
        self.next = {}


class _Words(dict):
    """Numbers of one language's words; 0 ends a window. Without a list of known words every word gets a number."""

    def __init__(self, lang: str, salt: str, ids: list[int], known: dict[bytes, int] | None):
        super().__init__(known or {})
        self.salt, self.ids, self.open = f"{salt}{lang}\t".encode(), ids, known is None
        self[BREAK] = 0

    def __missing__(self, word: bytes) -> int:
        if not self.open:
            return 0
        self.ids.append(xxhash.xxh64_intdigest(self.salt + word, SEED))
        self[word] = len(self.ids) - 1
        return self[word]


def _pack_run(words: np.ndarray, counts: np.ndarray) -> bytes:
    """A sorted run as columns of word ids and the counts, byte by byte (which packs better).

    Small ids stand there themselves; of 64-bit ones the run's own come first and the columns hold places in them.
    """
    if words.max() < 1 << 32:
        ids, place = np.empty(0, np.uint64), words.T.astype("<u4")
    else:
        ids, place = np.unique(words, return_inverse=True)
        place = place.reshape(words.shape).T.astype("<u4" if len(ids) > 65535 else "<u2")
    head = np.asarray([len(ids), len(counts), place.itemsize], "<i8")
    parts = [head, ids, *[_bytewise(column) for column in place], _bytewise(counts.astype("<i8"))]
    return zstandard.compress(b"".join(p.tobytes() for p in parts))


def _bytewise(column: np.ndarray) -> np.ndarray:
    """The lowest bytes of all values, then the next ones, and so on."""
    return np.ascontiguousarray(column).view(np.uint8).reshape(len(column), column.itemsize).T


def _whole(data: bytes, n: int, at: int, width: int) -> np.ndarray:
    return np.frombuffer(data, np.uint8, n * width, at).reshape(width, n).T.copy().view(f"<u{width}")[:, 0]


def _unpack_run(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zstandard.decompress(data)
    n_ids, n, width = np.frombuffer(raw, "<i8", 3).tolist()
    ids = np.frombuffer(raw, np.uint64, n_ids, 24)
    at = 24 + 8 * n_ids
    places = [_whole(raw, n, at + k * n * width, width) for k in range(LONGEST)]
    words = np.stack([ids[p] if n_ids else p.astype(np.uint64) for p in places], axis=1)
    return words, _whole(raw, n, at + LONGEST * n * width, 8).astype(np.int64)


def _mixed(words: np.ndarray) -> np.ndarray:
    out = np.zeros(len(words), np.uint64)
    for k in range(words.shape[1]):
        out = (out ^ words[:, k]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def _dealt(words: np.ndarray, counts: np.ndarray, slot: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sorted runs by slot, each in the order of its windows."""
    order = np.lexsort((words[:, 3], words[:, 2], words[:, 1], words[:, 0], slot))
    used, at = np.unique(slot[order], return_index=True)
    for s, a, b in zip(used.tolist(), at.tolist(), [*at[1:].tolist(), len(order)], strict=True):
        yield pa.RecordBatch.from_arrays(
            [pa.array([s], pa.int64()), pa.array([b - a], pa.int64()),
             pa.array([_pack_run(words[order[a:b]], counts[order[a:b]])], pa.binary())], names=["slot", "entries", "run"])


_RUN = "slot long, entries long, run binary"


def runs(docs: DataFrame, slots: int, known, id_salt: str = "", text_col: str = "text", lang_col: str = "lang",
         most_entries: int = 700_000, burst: int = 4096) -> DataFrame:
    """(slot, entries, run): counted windows as sorted runs; the slot follows from the first two words.

    ``known`` is a broadcast list of (lang, words) in the order of their numbers, from 1, which
    are their ids then; or None: then all words are counted, by their 64-bit ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = [0]
        listed: dict[str, dict[bytes, int]] = {}
        if known is not None:
            for lang, words in known.value:
                words = words.split(b"\n")
                listed[lang] = dict(zip(words, range(len(ids), len(ids) + len(words)), strict=True))
                ids.extend(range(len(ids), len(ids) + len(words)))
        by_lang: dict[str, _Words] = {}
        trie = Trie(burst)
        held: list[int] = []

        def count() -> None:
            a = np.asarray(held + [0] * (LONGEST - 1), np.int64)
            held.clear()
            n = len(a) - (LONGEST - 1)
            w1 = a[1:n + 1]
            w2 = a[2:n + 2] * (w1 > 0)
            w3 = a[3:n + 3] * (w2 > 0)
            at = np.flatnonzero((a[:n] > 0) & (w1 > 0))
            if len(at):
                trie.add(a[at], (w1[at] << 2 * BITS) | (w2[at] << BITS) | w3[at])

        def spilled(keep: int) -> Iterator[pa.RecordBatch]:
            first, rest, counts = trie.spill(keep)
            if len(first):
                numbers = np.stack([first, rest >> 2 * BITS, (rest >> BITS) & MASK, rest & MASK], axis=1)
                words = np.asarray(ids, np.uint64)[numbers]
                yield from _dealt(words, counts, (_mixed(words[:, :2]) % np.uint64(slots)).astype(np.int64))

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if lang not in by_lang:
                    by_lang[lang] = _Words(lang, id_salt, ids, None if known is None else listed.get(lang, {}))
                held.extend(map(by_lang[lang].__getitem__, tokens(text.as_py())))
                if len(held) > 250_000:
                    count()
                    if len(trie) > most_entries:
                        yield from spilled(most_entries // 2)
                    if len(ids) > MASK - 500_000 and known is None:  # numbers run out: start anew
                        yield from spilled(0)
                        del ids[1:]
                        by_lang.clear()
        count()
        yield from spilled(0)

    return _texts(docs, text_col, lang_col).mapInArrow(run, _RUN)


def merged(made: DataFrame, least: int, prefixes: bool = True) -> DataFrame:
    """(words, n): phrases of two to four word ids with at least ``least`` occurrences, from the runs of each slot.

    With ``prefixes`` a window counts for itself and all its beginnings, else only for itself.
    """

    def run(group: pa.Table) -> pa.Table:
        parts = [_unpack_run(r.as_py()) for r in group.column("run")]
        words, counts = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        order = np.lexsort((words[:, 3], words[:, 2], words[:, 1], words[:, 0]))
        words, counts = words[order], counts[order]
        new = np.zeros(len(words), bool)
        phrases, totals = [], []
        new[0] = True
        sizes = np.count_nonzero(words, axis=1)
        for k in range(1, LONGEST + 1):
            new[1:] |= words[1:, k - 1] != words[:-1, k - 1]
            if k == 1:
                continue
            first = np.flatnonzero(new)
            if prefixes:
                total, real = np.add.reduceat(counts, first), sizes[first] >= k
            else:
                total, real = np.add.reduceat(np.where(sizes == k, counts, 0), first), sizes[first] == k
            for at, n in zip(first[real & (total >= least)].tolist(), total[real & (total >= least)].tolist(), strict=True):
                phrases.append(words[at, :k].astype(np.int64).tolist())
                totals.append(n)
        return pa.table([pa.array(phrases, pa.list_(pa.int64())), pa.array(totals, pa.int64())], names=["words", "n"])

    return made.groupBy("slot").applyInArrow(run, "words array<long>, n long")


def split_hot(made: DataFrame, slots: int) -> DataFrame:
    """Runs of slots that hold too much, dealt anew: every phrase of a window by itself, by all its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("run"):
                words, counts = _unpack_run(data.as_py())
                sizes, parts, totals = np.count_nonzero(words, axis=1), [], []
                new = np.zeros(len(words), bool)
                new[0] = True
                for k in range(1, LONGEST + 1):
                    new[1:] |= words[1:, k - 1] != words[:-1, k - 1]
                    first = np.flatnonzero(new)
                    if k > 1:
                        phrase = words[first].copy()
                        phrase[:, k:] = 0
                        real = sizes[first] >= k
                        parts.append(phrase[real])
                        totals.append(np.add.reduceat(counts, first)[real])
                phrase, total = np.concatenate(parts), np.concatenate(totals)
                yield from _dealt(phrase, total, (_mixed(phrase) % np.uint64(slots)).astype(np.int64))

    return made.mapInArrow(run, _RUN)


def phrase_counts(docs: DataFrame, words: DataFrame, least: int, id_salt: str = "", text_col: str = "text",
                  lang_col: str = "lang", slot_words: int = 1_000_000, slot_most: int = 6_000_000,
                  known_rows: int = 1_000_000, known_bytes: int = 32 << 20, most_entries: int = 700_000,
                  burst: int = 4096) -> tuple[DataFrame, DataFrame]:
    """(words, n): phrases of two to four words with at least ``least`` occurrences; and (id, lang, word, n) of the words in them.

    The list of words that can stand in one is given to the tasks if it has at
    most ``known_rows`` rows and ``known_bytes``; its places are the ids then. Beyond
    that all words are counted, by hash. Slots beyond ``slot_most`` entries (a hot
    prefix) are dealt anew by whole phrases.
    """
    spark = docs.sparkSession
    can = words.where(F.col("n") >= least)
    total = words.agg(F.sum("n")).first()[0] or 0
    rows, size = can.agg(F.count(F.lit(1)), F.sum(F.octet_length("word"))).first()
    known = None
    if rows <= known_rows and (size or 0) <= known_bytes:
        table = can.select("lang", "word", "n").toArrow().sort_by("lang")
        by_lang: dict[str, list[bytes]] = {}
        for lang, word in zip(table.column("lang").to_pylist(), table.column("word").to_pylist(), strict=True):
            by_lang.setdefault(lang, []).append(word.encode())
        known = spark.sparkContext.broadcast([(lang, b"\n".join(w)) for lang, w in by_lang.items()])
        numbers = pa.array(np.arange(1, len(table) + 1), pa.int64())
        can = materialize(spark.createDataFrame(table.append_column("id", numbers)), "known") if rows else can
    made = materialize(runs(docs, 1 + total // slot_words, known, id_salt, text_col, lang_col, most_entries, burst), "runs")
    sizes = made.groupBy("slot").agg(F.sum("entries").alias("held"))
    much = broadcast_checked(materialize(sizes.where(F.col("held") > slot_most), "hot-slots"), 1_000_000)
    out = merged(made.join(much, "slot", "left_anti"), least)
    extra = much.agg(F.sum("held")).first()[0] or 0
    if extra:
        again = materialize(split_hot(made.join(much, "slot", "left_semi").select("slot", "entries", "run"),
                                      1 + 3 * extra // slot_words), "hot-runs")
        out = out.unionByName(merged(again, least, prefixes=False))
    return out, can.select("id", "lang", "word", "n")


def collocations(docs: DataFrame, least: int = 30, top: int = 2000, absorb: int = 80, scale: int = 2_000_000,
                 text_col: str = "text", lang_col: str = "lang", **sizes) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's best phrases.

    A phrase of two to four words with ``a >= least`` occurrences is cut where
    ``scale * a / (l + r)`` is smallest, l and r being the occurrences of both parts.
    Phrases inside a longer one with at least ``absorb`` percent of their
    occurrences are left out. ``n`` counts the language's words. Null texts have
    no words; a null language is ``und``. Repeated rows count each. Ranks go by
    score, then a, then the phrase's bytes; an empty table gives no rows.
    """
    salt = ""
    while True:
        words = materialize(word_counts(docs, salt, text_col, lang_col), "words")
        if words.groupBy("id").count().where("count > 1 OR id = 0").limit(1).count() == 0:
            break
        salt += "+"  # two words share a hash: draw the hashes anew
    found, single = phrase_counts(docs, words, least, salt, text_col, lang_col, **sizes)
    found = materialize(found, "phrases")
    every = found.unionByName(single.select(F.array("id").alias("words"), "n"))
    cuts = found.select("words", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    first, rest = F.slice("words", F.lit(1), F.col("k")), F.expr("slice(words, k + 1, size(words) - k)")
    cuts = (cuts.withColumn("_first", first).withColumn("_rest", rest)
            .join(every.select(F.col("words").alias("_first"), F.col("n").alias("l")), "_first")
            .join(every.select(F.col("words").alias("_rest"), F.col("n").alias("r")), "_rest"))
    score = F.expr(f"(cast({scale} as decimal(18,0)) * cast(a as decimal(19,0))) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))")
    best = (cuts.withColumn("score", score).groupBy("words", "a")
            .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")))
    inner = F.expr("flatten(transform(sequence(2, size(words) - 1), m -> "
                   "transform(sequence(1, size(words) - m + 1), i -> slice(words, i, m))))")
    longer = (found.where(F.size("words") > 2).select(F.explode(inner).alias("words"), "n")
              .groupBy("words").agg(F.max("n").alias("around")))
    eaten = F.col("around").cast("decimal(20,0)") * 100 >= F.col("a").cast("decimal(20,0)") * absorb
    left = best.join(longer, "words", "left").where(~F.coalesce(eaten, F.lit(False))).withColumn("key", F.monotonically_increasing_id())
    left = materialize(left.select("key", "words", "a", "cut.l", "cut.r", "cut.score"), "candidates")
    spelled = (left.select("key", F.posexplode("words").alias("at", "id")).join(single.select("id", "lang", "word"), "id")
               .groupBy("key").agg(F.first("lang").alias("lang"),
                                   F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ")
                                   .alias("phrase")))
    ranked = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranks = (left.join(spelled, "key").withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top))
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranks.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
