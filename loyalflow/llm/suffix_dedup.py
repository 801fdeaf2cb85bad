"""Removal of repeated byte strings by longest-previous-factor arrays.

A byte goes if a string of ``length`` bytes that covers it also starts earlier
(smaller id, or same document, earlier start). Every such string ("window") has
an anchor, the smallest hash of its inner grams; equal windows have equal
anchors at the same place. So windows are dealt out by anchor, those of an
anchor that stands alone are done, and the others meet in tasks that sort their
suffixes. There the longest previous factor of a window is the larger of its
common prefixes with the nearest suffixes on both sides, in suffix order, that
start earlier in the corpus (previous and next smaller positions).

Texts travel as compressed blocks of documents. What a block sends is
pre-aggregated: of equal stretches around an anchor only its first. An anchor
with very many different stretches is not gathered in one task: its windows are
compared by digest. A block sends their digests packed, dealt out by digest.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyalflow.llm.common import materialize

GRAM = 32
#: Odd multiplier of the polynomial hash and its inverse modulo 2**64; multiplier of the final mix.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
MIX = np.uint64(0xFF51AFD7ED558CCD)
#: Windows hashed at once; their place in such a slice fits the low bits of a hash.
SLICE, LOW = 1 << 18, np.uint64((1 << 19) - 1)
NO_ID = np.iinfo(np.int64).max
#: Windows of hot anchors that may meet in a task.
HOT_WINDOWS = 4_000_000


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Windows:
    """Anchors of a block's windows, as runs of windows with one anchor.

    ``lo`` and ``hi`` are the first and last window start of a run, ``anchor``
    the place of its gram and ``key`` that gram's hash. Windows lie in one document.
    """

    def __init__(self, data: np.ndarray, ends: np.ndarray, length: int, gram: int = GRAM):
        self.data, self.length = data, length
        gram = min(gram, length)
        wide = length - gram + 1
        n = len(data) - length + 1
        parts = []
        if n > 0:
            size = min(SLICE, n) + length
            power, inverse = _powers(BASE, size), _powers(INVERSE, size)
            starts = np.concatenate([[0], ends[:-1]])
            for a in range(0, n, SLICE):
                b = min(a + SLICE, n)
                parts.append(self._slice(a, b, gram, wide, power, inverse, starts, ends))
        if not parts:
            self.lo = self.hi = self.anchor = np.empty(0, np.int64)
            self.key = np.empty(0, np.uint64)
            return
        lo, hi, anchor, key = (np.concatenate(x) for x in zip(*parts, strict=True))
        # a run that a slice's edge cut is one again
        first = np.ones(len(lo), bool)
        first[1:] = (anchor[1:] != anchor[:-1]) | (lo[1:] != hi[:-1] + 1)
        at = np.flatnonzero(first)
        self.lo, self.anchor, self.key = lo[at], anchor[at], key[at]
        self.hi = hi[np.append(at[1:], len(lo)) - 1] if len(at) else hi

    def _slice(self, a, b, gram, wide, power, inverse, starts, ends):
        text = self.data[a:b + self.length - 1]
        sums = np.zeros(len(text) + 1, np.uint64)
        np.cumsum(text * power[:len(text)], dtype=np.uint64, out=sums[1:])
        grams = (sums[gram:] - sums[:-gram]) * inverse[:len(text) - gram + 1]
        grams ^= grams >> np.uint64(32)
        grams *= MIX
        grams ^= grams >> np.uint64(29)
        least = (grams & ~LOW) | np.arange(len(grams), dtype=np.uint64)
        held = 1
        while 2 * held <= wide:
            least = np.minimum(least[:-held], least[held:])
            held *= 2
        if held < wide:
            least = np.minimum(least[:len(least) - (wide - held)], least[wide - held:])
        at = (least & LOW).astype(np.int64)
        inside = np.ones(b - a, bool)
        first, last = np.searchsorted(ends, a, "right"), np.searchsorted(starts, b + self.length, "left")
        for k in range(first, min(last, len(ends))):  # windows that would run over the end of their document
            inside[max(0, ends[k] - self.length + 1 - a, starts[k] - a):max(0, min(b, ends[k]) - a)] = False
        turn = np.ones(b - a, bool)
        turn[1:] = (at[1:] != at[:-1]) | (inside[1:] != inside[:-1])
        lo = np.flatnonzero(turn)
        hi = np.append(lo[1:], b - a) - 1
        lo, hi = lo[inside[lo]], hi[inside[lo]]
        return lo + a, hi + a, at[lo] + a, grams[at[lo]]


def _suffixes(text: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(text, depth)[starts])


def _nearest_smaller(place: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Common prefix of each suffix with the nearest one before it, in suffix order, whose place is smaller.

    ``common[r]`` is the common prefix of ranks r - 1 and r. All ranks jump at
    once over what is larger, so rounds grow with the logarithm of the longest way.
    """
    at = np.arange(-1, len(place) - 1)
    low = common.copy()
    todo = np.flatnonzero((at >= 0) & (place[at] > place))
    while todo.size:
        over = at[todo]
        low[todo] = np.minimum(low[todo], low[over])
        at[todo] = at[over]
        todo = todo[(at[todo] >= 0) & (place[at[todo]] > place[todo])]
    low[at < 0] = 0
    return low


def longest_previous(text: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """Longest previous factor of each suffix, at most ``depth``.

    ``starts`` are in corpus order; suffixes are told apart by ``depth`` bytes.
    """
    if not len(starts):
        return np.empty(0, np.int64)
    rows = _suffixes(text, starts, depth)
    order = np.argsort(rows.view(f"S{depth}").ravel(), kind="stable")
    common = np.zeros(len(order), np.int64)
    for a in range(1, len(order), 100_000):
        b = min(a + 100_000, len(order))
        same = rows[order[a:b]] == rows[order[a - 1:b - 1]]
        common[a:b] = np.where(same.all(axis=1), depth, same.argmin(axis=1))
    back = np.append(common[1:], 0)
    found = np.maximum(_nearest_smaller(order, common), _nearest_smaller(order[::-1], back[::-1])[::-1])
    out = np.empty(len(order), np.int64)
    out[order] = found
    return out


def covered(starts: np.ndarray, ends: np.ndarray, join: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Sorted and disjoint stretches of the given ones; ``join`` also makes one of two that only touch.

    Stretches of neighbouring documents may touch, so only those of one document are joined.
    """
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    first = np.append(True, starts[1:] > ends[:-1] if join else starts[1:] >= ends[:-1])
    return starts[first], ends[np.append(np.flatnonzero(first)[1:], len(starts)) - 1]


def _groups(sorted_keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The different keys and the values of each."""
    used, at = np.unique(sorted_keys, return_index=True)
    edges = [*at.tolist(), len(values)]
    return used, [values[a:b] for a, b in zip(edges, edges[1:], strict=False) if b > a]


def store(docs: DataFrame, block_bytes: int = 1 << 22, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Blocks of documents: (block, n_bytes, ids, ends, data); a document is never cut.

    ``ends`` are the documents' cumulative ends in bytes, ``data`` their
    concatenated UTF-8, compressed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block, pack = TaskContext.get().partitionId() << 32, zstandard.ZstdCompressor(level=3)
        ids, texts, size = [], [], 0

        def made() -> pa.RecordBatch:
            nonlocal block, ids, texts, size
            ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
            out = pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([size], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                 pa.array([ends], pa.list_(pa.int64())), pa.array([pack.compress(b"".join(texts))], pa.binary())],
                names=["block", "n_bytes", "ids", "ends", "data"])
            block, ids, texts, size = block + 1, [], [], 0
            return out

        for batch in batches:
            for i, text in zip(batch.column(0), batch.column(1), strict=True):
                data = (text.as_py() or "").encode()
                ids.append(i.as_py())
                texts.append(data)
                size += len(data)
                if size >= block_bytes or len(ids) >= 50_000:
                    yield made()
        if ids:
            yield made()

    return docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text")).mapInArrow(
        run, "block long, n_bytes long, ids array<long>, ends array<long>, data binary")


def _unpacked(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, ends and order keys (null ids last) of the documents of a block."""
    ids = batch.column("ids")[i].values
    keys = ids.fill_null(NO_ID).to_numpy() if ids.null_count else ids.to_numpy()
    data = zstandard.ZstdDecompressor().decompress(batch.column("data")[i].as_buffer())
    return np.frombuffer(data, np.uint8), batch.column("ends")[i].values.to_numpy(), keys


def anchors(blocks: DataFrame, length: int, buckets: int) -> DataFrame:
    """(bucket, block, keys, counts): each block's different anchors and how often each stands there, dealt out by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data, ends, _ = _unpacked(batch, i)
                keys, counts = np.unique(Windows(data, ends, length).key, return_counts=True)
                bucket = (keys % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                used, rows = _groups(bucket[order], order)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(used, pa.int64()), pa.array(np.full(len(used), batch.column("block")[i].as_py()), pa.int64()),
                     pa.array([keys[r].tobytes() for r in rows], pa.binary()),
                     pa.array([zstandard.compress(counts[r].astype("<u4").tobytes()) for r in rows], pa.binary())],
                    names=["bucket", "block", "keys", "counts"])

    return blocks.select("block", "ids", "ends", "data").mapInArrow(run, "bucket long, block long, keys binary, counts binary")


def repeated(found: DataFrame, hot: int) -> DataFrame:
    """(block, keys, hot_keys, n_hot): the anchors of a block that stand elsewhere too, in one row per bucket.

    ``hot_keys`` are those that stand more than ``hot`` times in the corpus, ``n_hot`` how often they stand in the block.
    """

    def run(group: pa.Table) -> pa.Table:
        keys = [np.frombuffer(k.as_buffer(), np.uint64) for k in group.column("keys")]
        counts = [np.frombuffer(zstandard.decompress(c.as_buffer()), "<u4") for c in group.column("counts")]
        one, place = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(place, weights=np.concatenate(counts)).astype(np.int64)
        blocks, again, much, often, at = [], [], [], [], 0
        for block, k, c in zip(group.column("block").to_pylist(), keys, counts, strict=True):
            n = total[place[at:at + len(k)]]
            at += len(k)
            if (n > 1).any():
                blocks.append(block)
                again.append(k[(n > 1) & (n <= hot)].tobytes())
                much.append(k[n > hot].tobytes())
                often.append(int(c[n > hot].sum()))
        return pa.table([pa.array(blocks, pa.int64()), pa.array(again, pa.binary()), pa.array(much, pa.binary()),
                         pa.array(often, pa.int64())], names=["block", "keys", "hot_keys", "n_hot"])

    return found.groupBy("bucket").applyInArrow(run, "block long, keys binary, hot_keys binary, n_hot long")


_SENT = ("bucket long, block long, n_windows long, keys binary, ids binary, at binary, lead binary, size binary, data binary, "
         "starts binary, ends binary, hot_bucket long, digests binary")


def stretches(blocks: DataFrame, again: DataFrame, length: int, buckets: int, hot_buckets: int = 1) -> DataFrame:
    """What the blocks send of their repeated anchors: text stretches, digests of windows of hot anchors, and what is covered already.

    Of equal stretches of a block all but the first (in corpus order) are covered.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int64(), *[pa.binary()] * 8, pa.int64(), pa.binary()]
        names = [f.split()[0] for f in _SENT.split(", ")]

        def row(block, bucket=None, n=0, arrays=(None,) * 6, cover=(None, None), hot=(None, None)) -> pa.RecordBatch:
            values = [bucket, block, n, *arrays, *cover, *hot]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=names)

        for batch in batches:
            for i in range(batch.num_rows):
                block = batch.column("block")[i].as_py()
                data, ends, ids = _unpacked(batch, i)
                w = Windows(data, ends, length)
                raw = data.tobytes()
                wanted = np.frombuffer(b"".join(batch.column("keys")[i].as_py()), np.uint64)
                hot = np.frombuffer(b"".join(batch.column("hot_keys")[i].as_py()), np.uint64)
                order_key = ids[np.searchsorted(ends, w.lo, "right")]
                in_order = np.lexsort((w.lo, order_key))
                seen, sent, known, much = set(), [], [], []
                is_hot = np.isin(w.key, hot)
                for r in in_order[is_hot[in_order] | np.isin(w.key[in_order], wanted)].tolist():
                    mark = (w.anchor[r] - w.lo[r], raw[w.lo[r]:w.hi[r] + length])
                    if mark in seen:
                        known.append(r)
                    else:
                        seen.add(mark)
                        (much if is_hot[r] else sent).append(r)
                start, end = w.lo[known], w.hi[known] + length
                # windows of hot anchors: the first of equal ones is sent, the others are covered
                first, late, ids_of, places = {}, [], [], []
                for r in much:
                    for s in range(int(w.lo[r]), int(w.hi[r]) + 1):
                        digest = blake2b(raw[s:s + length], digest_size=16).digest()
                        if digest in first:
                            late.append(s)
                        else:
                            first[digest] = None
                            ids_of.append(order_key[r])
                            places.append(s)
                late = np.asarray(late, np.int64)
                start, end = covered(np.concatenate([start, late]), np.concatenate([end, late + length]))
                if len(start):
                    yield row(block, cover=(start.tobytes(), end.tobytes()))
                digests = np.frombuffer(b"".join(first), np.uint64).reshape(-1, 2)
                own, places = np.asarray(ids_of, np.int64), np.asarray(places, np.int64)
                bucket = (digests[:, 0] % np.uint64(hot_buckets)).astype(np.int64)
                by = np.argsort(bucket, kind="stable")
                for b, r in zip(*_groups(bucket[by], by), strict=True):
                    yield row(block, arrays=(None, own[r].tobytes(), places[r].tobytes(), None, None, None),
                              hot=(int(b), digests[r].tobytes()))
                sent = np.asarray(sent, np.int64)
                bucket = (w.key[sent] // np.uint64(7) % np.uint64(buckets)).astype(np.int64)
                by = np.argsort(bucket, kind="stable")
                for b, r in zip(*_groups(bucket[by], sent[by]), strict=True):
                    text = b"".join([raw[x:y] for x, y in zip(w.lo[r].tolist(), (w.hi[r] + length).tolist(), strict=True)])
                    yield row(block, int(b), int((w.hi[r] - w.lo[r] + 1).sum()),
                              (w.key[r].tobytes(), order_key[r].tobytes(), w.lo[r].tobytes(),
                               (w.anchor[r] - w.lo[r]).astype("<i4").tobytes(),
                               (w.hi[r] - w.lo[r]).astype("<i4").tobytes(), zstandard.compress(text)))

    again = again.groupBy("block").agg(F.collect_list("keys").alias("keys"), F.collect_list("hot_keys").alias("hot_keys"))
    return (blocks.select("block", "ids", "ends", "data").join(again, "block")
            .mapInArrow(run, _SENT))


def matches(sent: DataFrame, length: int) -> DataFrame:
    """(block, starts, ends): what earlier windows cover, from the longest previous factors of a bucket's stretches."""

    def run(group: pa.Table) -> pa.Table:
        def column(name: str, kind) -> np.ndarray:
            return np.concatenate([np.frombuffer(v.as_buffer(), kind) for v in group.column(name)])

        key, ids, at = column("keys", np.uint64), column("ids", np.int64), column("at", np.int64)
        n = column("size", "<i4").astype(np.int64) + 1
        per_row = np.asarray([len(v.as_buffer()) // 8 for v in group.column("keys")])
        block = np.repeat(group.column("block").to_numpy(), per_row)
        text = np.frombuffer(b"".join(zstandard.decompress(v.as_buffer()) for v in group.column("data")), np.uint8)
        begin = np.cumsum(n + length - 1) - (n + length - 1)
        order = np.lexsort((at, block, ids))
        starts = np.repeat(begin[order] - (np.cumsum(n[order]) - n[order]), n[order]) + np.arange(n.sum())
        again = longest_previous(text, starts, length) >= length
        member = np.repeat(order, n[order])[again]
        where = at[member] + starts[again] - begin[member]
        block = block[member]
        by = np.argsort(block, kind="stable")
        used, places = _groups(block[by], where[by])
        spans = [covered(p, p + length) for p in places]
        return pa.table([pa.array(used, pa.int64()), pa.array([s.tobytes() for s, _ in spans], pa.binary()),
                         pa.array([e.tobytes() for _, e in spans], pa.binary())], names=["block", "starts", "ends"])

    columns = ("bucket", "block", "keys", "ids", "at", "size", "data")
    return (sent.where("bucket IS NOT NULL").select(*columns).groupBy("bucket")
            .applyInArrow(run, "block long, starts binary, ends binary"))


def hot_matches(sent: DataFrame, length: int) -> DataFrame:
    """The same for windows of hot anchors: in a bucket of digests, all but the first of equal ones."""

    def run(group: pa.Table) -> pa.Table:
        digests = np.concatenate([np.frombuffer(v.as_buffer(), np.uint64).reshape(-1, 2) for v in group.column("digests")])
        ids, at = (np.concatenate([np.frombuffer(v.as_buffer(), np.int64) for v in group.column(c)]) for c in ("ids", "at"))
        block = np.repeat(group.column("block").to_numpy(), [len(v.as_buffer()) // 16 for v in group.column("digests")])
        order = np.lexsort((at, block, ids, digests[:, 1], digests[:, 0]))
        digests = digests[order]
        later = order[1:][(digests[1:] == digests[:-1]).all(axis=1)]
        later = later[np.lexsort((at[later], block[later]))]
        used, places = _groups(block[later], at[later])
        spans = [covered(p, p + length) for p in places]
        return pa.table([pa.array(used, pa.int64()), pa.array([s.tobytes() for s, _ in spans], pa.binary()),
                         pa.array([e.tobytes() for _, e in spans], pa.binary())], names=["block", "starts", "ends"])

    return (sent.where("hot_bucket IS NOT NULL").select("hot_bucket", "block", "ids", "at", "digests").groupBy("hot_bucket")
            .applyInArrow(run, "block long, starts binary, ends binary"))


def gather(sent: DataFrame, length: int) -> DataFrame:
    """All covered stretches of a block in one row."""
    parts = (sent.where("starts IS NOT NULL").select("block", "starts", "ends")
             .unionByName(matches(sent, length)).unionByName(hot_matches(sent, length)))
    return parts.groupBy("block").agg(F.collect_list("starts").alias("cut_starts"), F.collect_list("ends").alias("cut_ends"))


def dedup(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text", hot: int = 10_000,
          keep_bytes: bool = False) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_removed, n_spans, kept_sha256 (and, if asked for, the kept bytes).

    Null and empty texts have no bytes and lose none; texts below ``length``
    bytes lose none. Ids are whole numbers; null ids stand behind all others. Rows
    that share an id are documents of their own, in the order of the written
    blocks, so that of equal rows one keeps its text. Kept bytes may end within a
    character. Strings are judged on the input, and matches stay in a document.
    """
    blocks = materialize(store(docs, id_col=id_col, text_col=text_col), "blocks")
    total = blocks.agg(F.sum("n_bytes")).first()[0] or 0
    found = anchors(blocks, length, 1 + total // 16_000_000)
    again = materialize(repeated(found, hot), "anchors")
    held, n_hot = again.agg(F.coalesce(F.sum(F.octet_length("keys")), F.lit(0)), F.coalesce(F.sum("n_hot"), F.lit(0))).first()
    # a stretch of a hot anchor has at most ``length`` windows, of 32 bytes each
    sent = materialize(stretches(blocks, again, length, 1 + held // 8 // 8_000, 1 + n_hot * length // HOT_WINDOWS), "stretches")
    gone = gather(sent, length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data, ends, _ = _unpacked(batch, i)
                raw = data.tobytes()
                starts, stops = (np.frombuffer(b"".join(batch.column(c)[i].as_py() or []), np.int64) for c in ("cut_starts", "cut_ends"))
                doc = np.searchsorted(ends, starts, "right")
                by = np.argsort(doc, kind="stable")
                starts, stops, doc = starts[by], stops[by], doc[by]
                removed, spans, digests, kept = [], [], [], []
                edges = np.searchsorted(doc, np.arange(len(ends) + 1))
                begin = 0
                for k, end in enumerate(ends.tolist()):
                    s, e = covered(starts[edges[k]:edges[k + 1]], stops[edges[k]:edges[k + 1]], join=True)
                    h, at, gone_bytes, left = sha256(), begin, 0, []
                    for x, y in zip(s.tolist(), e.tolist(), strict=True):
                        left.append(raw[at:x])
                        gone_bytes += y - x
                        at = y
                    left.append(raw[at:end])
                    for part in left:
                        h.update(part)
                    removed.append(gone_bytes)
                    spans.append(len(s))
                    digests.append(h.hexdigest())
                    if keep_bytes:
                        kept.append(b"".join(left))
                    begin = end
                sizes = np.diff(ends, prepend=0)
                out = [batch.column("ids")[i].values, pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
                       pa.array(spans, pa.int64()), pa.array(digests, pa.string())]
                names = [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256"]
                if keep_bytes:
                    out, names = [*out, pa.array(kept, pa.binary())], [*names, "kept"]
                yield pa.RecordBatch.from_arrays(out, names=names)

    schema = f"`{id_col}` long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_bytes
    return blocks.select("block", "ids", "ends", "data").join(gone, "block", "left").mapInArrow(run, schema)
