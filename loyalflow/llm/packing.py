"""Best-fit packing of tokenized documents into sequences of bounded length.

Hierarchical residual packing: each partition packs its own pieces best-fit
(longest first), bins that are nearly full are final, the underfull ones travel
as items up a tree of groups, where best-fit is repeated on them.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyalflow.llm.bpe import byte_letters
from loyalflow.llm.common import materialize

_KEPT: dict[str, Callable[[str], bytes]] = {}


def tokenizer(path: str | None) -> Callable[[str], bytes]:
    """From a text to its ids (little-endian unsigned 32-bit) by a byte-level BPE file of the ``tokenizers`` library.

    The file's vocabulary is run by ``tiktoken``, which gives the same ids seven
    times as fast; a text that is too much for its pattern engine (millions of
    blanks in a row) goes to ``tokenizers`` itself. Kept for the life of a
    Python worker.
    """
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    if path not in _KEPT:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items()}
        fast = tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                 special_tokens={t["content"]: t["id"] for t in spec["added_tokens"]})
        slow = Tokenizer.from_file(path)
        slow.no_truncation()
        slow.no_padding()

        def encode(text: str) -> bytes:
            try:
                return fast.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False).tobytes()
            except ValueError:
                return np.asarray(slow.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

        _KEPT[path] = encode
    return _KEPT[path]


def pieces(docs: DataFrame, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
           vocabulary: str | None = None, keep_ids: bool = False) -> DataFrame:
    """Token pieces of every document: its ids and ``end_id``, cut only if longer than ``capacity``.

    A cut document has full pieces, but for the first, which takes the
    remainder. A null or empty text is the single id ``end_id``. Repeated rows
    stay separate. ``keep_ids`` adds the ids themselves.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(vocabulary)
        end = np.asarray([end_id], dtype="<u4").tobytes()
        for batch in batches:
            row, at, start, size, crc, kept = [], [], [], [], [], []
            for i, text in enumerate(batch.column(1)):
                ids = encode(text.as_py() or "") + end
                n = len(ids) // 4
                lo, k = 0, 0
                while lo < n:
                    hi = lo + ((n % capacity or capacity) if k == 0 else capacity)
                    part = ids[4 * lo:4 * hi]
                    row.append(i)
                    at.append(k)
                    start.append(lo)
                    size.append(hi - lo)
                    crc.append(zlib.crc32(part))
                    if keep_ids:
                        kept.append(np.frombuffer(part, dtype="<u4").astype("int32"))
                    lo, k = hi, k + 1
            out = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(at, pa.int32()), pa.array(start, pa.int64()),
                   pa.array(size, pa.int64()), pa.array(crc, pa.int64())]
            names = [id_col, "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                out, names = [*out, pa.array(kept, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(out, names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text")).mapInArrow(run, schema)


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Bin and offset of each item, and the fill of each bin: longest first, each into the fullest bin that takes it."""
    bins = np.empty(len(sizes), dtype=np.int64)
    offsets = np.empty(len(sizes), dtype=np.int64)
    fill: list[int] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms = 0  # bit r: some bin has room r
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fits = open_rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                open_rooms &= ~(1 << room)
        else:
            room, b = capacity, len(fill)
            fill.append(0)
        bins[i], offsets[i] = b, fill[b]
        fill[b] += size
        left = room - size
        if left:
            by_room[left].append(b)
            open_rooms |= 1 << left
    return bins, offsets, fill


def pack(items: DataFrame, capacity: int = 2048, nearly_full: float = 0.995, fan_in: int = 8,
         local_rows: int = 1_000_000, carry: int = 4096) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with a ``length`` of 1 to ``capacity``.

    Every row gets a place; offsets in a sequence are gapless from 0. Partitions
    pack blocks of ``local_rows`` rows by themselves. Bins filled to
    ``nearly_full`` are final. In each round ``fan_in`` groups become one, whose
    underfull bins are packed as items. A partition and a group hand on their least
    full bins, ``carry`` rows of them at most (of a partition's blocks the first
    half of it, the next a quarter, and so on), and the others are final as they
    are, so that a merge never holds more than ``fan_in * carry`` rows, whatever the
    lengths. An empty table stays empty; equal rows get places of their own.
    """
    enough = int(capacity * nearly_full)
    names = items.columns

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, made, held, rows, quota = TaskContext.get().partitionId(), 0, [], 0, carry

        def packed() -> Iterator[pa.RecordBatch]:
            nonlocal made, held, rows, quota
            quota //= 2
            block = pa.Table.from_batches(held)
            sizes = block.column("length").to_numpy()
            bins, offsets, fill = best_fit(sizes, capacity)
            full = np.asarray(fill, dtype=np.int64)
            travels = np.zeros(len(full), dtype=bool)
            travels[np.argsort(full, kind="stable")[:quota]] = True
            travels &= full < enough
            block = (block.append_column("_bin", pa.array((part << 36) + made + bins))
                     .append_column("_at", pa.array(offsets))
                     .append_column("_fill", pa.array(full[bins]))
                     .append_column("_open", pa.array(travels[bins]))
                     .append_column("_group", pa.array(np.full(len(bins), part, dtype=np.int64))))
            made, held, rows = made + len(fill), [], 0
            yield from block.to_batches(max_chunksize=50_000)

        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= local_rows:
                yield from packed()
        if rows:
            yield from packed()

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema.fields)
    placed = materialize(items.mapInArrow(local, f"{kinds}, _bin long, _at long, _fill long, _open boolean, _group long"), "packed")

    # one row per bin that travels: the root it is part of, its shift in the root, the root's fill and group
    state = (placed.where("_open").where(F.col("_at") == 0)
             .select("_bin", F.col("_bin").alias("_root"), F.lit(0).cast("long").alias("_shift"),
                     F.col("_fill").alias("_total"), "_group"))

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        roots = frame.drop_duplicates("_root").sort_values("_root")
        ids, fills = roots["_root"].to_numpy(), roots["_total"].to_numpy()
        bins, offsets, total = best_fit(fills, capacity)
        first = np.empty(len(total), dtype=np.int64)
        first[bins[::-1]] = ids[::-1]  # the smallest root names the merged one
        at = np.searchsorted(ids, frame["_root"].to_numpy())
        total_of = np.asarray(total, dtype=np.int64)
        rising = np.argsort(total_of, kind="stable")
        rows_of = np.bincount(bins[at], minlength=len(total))
        open_bin = np.zeros(len(total), dtype=bool)
        open_bin[rising[np.cumsum(rows_of[rising]) <= carry]] = True
        open_bin &= total_of < enough
        return pd.DataFrame({"_bin": frame["_bin"], "_root": first[bins[at]],
                             "_shift": frame["_shift"].to_numpy() + offsets[at], "_total": total_of[bins[at]],
                             "_group": frame["_group"], "_open": open_bin[bins[at]]})

    groups, done = (placed.agg(F.max("_group")).first()[0] or 0) + 1, None
    while True:
        groups = -(-groups // fan_in)
        state = (state.withColumn("_group", F.floor(F.col("_group") / fan_in)).groupBy("_group")
                 .applyInPandas(merge, "_bin long, _root long, _shift long, _total long, _group long, _open boolean"))
        state = materialize(state, "bins")
        over = state if groups == 1 else state.where(~F.col("_open"))
        over = over.select("_bin", "_root", "_shift")
        done = over if done is None else done.unionByName(over)
        if groups == 1:
            break
        state = state.where("_open").drop("_open")
    return (placed.join(done, "_bin", "left")
            .select(*names, F.coalesce("_root", "_bin").alias("sequence_id"),
                    (F.col("_at") + F.coalesce("_shift", F.lit(0))).alias("offset")))
