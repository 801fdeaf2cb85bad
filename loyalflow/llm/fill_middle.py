"""Fill-in-middle transformation over seekable compressed frames.

A text is stored as independent zstandard frames with cumulative counts of
units (lines), code points and bytes. A cut at a unit needs the one frame that
holds it; digests and rebuilt texts stream the frames in the order asked for, one
decompressed frame at a time.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed marks before the parts of a transformed text.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
FRAMES = "array<struct<units:bigint,chars:bigint,bytes:bigint,data:binary>>"
_ARROW = pa.list_(pa.struct([("units", pa.int64()), ("chars", pa.int64()), ("bytes", pa.int64()), ("data", pa.binary())]))
LEVEL = 3


def code_points(data: bytes) -> int:
    """Code points that begin in these bytes of UTF-8."""
    raw = np.frombuffer(data, np.uint8)
    return int(np.count_nonzero((raw & 0xC0) != 0x80))


class FrameWriter:
    """Collects the chunks of one text into frames of ``frame_bytes``; counts are cumulative, the frame's own included."""

    def __init__(self, frame_bytes: int):
        self.frame_bytes, self.frames, self.held = frame_bytes, [], bytearray()
        self.units = self.chars = self.bytes = 0
        self.packer = zstandard.ZstdCompressor(level=LEVEL)

    def add(self, chunk: bytes) -> None:
        at = 0
        while at < len(chunk):
            take = min(self.frame_bytes - len(self.held), len(chunk) - at)
            self.held += chunk[at:at + take]
            at += take
            if len(self.held) == self.frame_bytes:
                self.close_frame()

    def close_frame(self) -> None:
        data = bytes(self.held)
        self.units += data.count(b"\n")
        self.chars += code_points(data)
        self.bytes += len(data)
        self.frames.append({"units": self.units, "chars": self.chars, "bytes": self.bytes, "data": self.packer.compress(data)})
        self.held.clear()

    def done(self) -> list[dict]:
        if self.held:
            self.close_frame()
        return self.frames


def write_frames(chunks: Iterable[bytes], frame_bytes: int) -> list[dict]:
    writer = FrameWriter(frame_bytes)
    for chunk in chunks:
        writer.add(chunk)
    return writer.done()


class FrameReader:
    """Seeks in and streams one text's frames."""

    def __init__(self, frames: list[dict]):
        self.frames = frames
        self.unpacker = zstandard.ZstdDecompressor()

    def data(self, k: int) -> bytes:
        return self.unpacker.decompress(self.frames[k]["data"])

    def total(self, what: str) -> int:
        return self.frames[-1][what] if self.frames else 0

    def seek(self, unit: int) -> tuple[int, int]:
        """(bytes, code points) before the end of the first ``unit`` lines; only the frame of the cut is decompressed."""
        if unit <= 0:
            return 0, 0
        if unit > self.total("units"):  # the last line has no line end
            return self.total("bytes"), self.total("chars")
        lo, hi = 0, len(self.frames) - 1
        while lo < hi:
            mid = (lo + hi) // 2
            lo, hi = (lo, mid) if self.frames[mid]["units"] >= unit else (mid + 1, hi)
        before = self.frames[lo - 1] if lo else {"units": 0, "chars": 0, "bytes": 0}
        data = self.data(lo)
        ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 10)
        cut = int(ends[unit - before["units"] - 1]) + 1
        return before["bytes"] + cut, before["chars"] + code_points(data[:cut])

    def stream(self, start: int = 0, stop: int | None = None) -> Iterator[bytes]:
        """The bytes of [start, stop), frame by frame."""
        stop, begin = self.total("bytes") if stop is None else stop, 0
        for k, frame in enumerate(self.frames):
            end = frame["bytes"]
            if begin < stop and end > start:
                data = self.data(k)
                yield data[max(0, start - begin):stop - begin] if begin < start or end > stop else data
            begin = end

    def find(self, marks: list[bytes]) -> list[int]:
        """Places of the first of each mark, which follow one another; a mark may lie across frames."""
        places, tail, at = [], b"", 0
        for chunk in self.stream():
            window = tail + chunk
            begin = at - len(tail)
            from_ = 0
            while len(places) < len(marks):
                hit = window.find(marks[len(places)], max(0, from_))
                if hit < 0:
                    break
                places.append(begin + hit)
                from_ = hit + len(marks[len(places) - 1])
            if len(places) == len(marks):
                return places
            at += len(chunk)
            tail = window[max(from_, len(window) - 2):]
        raise ValueError(f"{marks[len(places)].decode()} is missing")


def transformed(reader: FrameReader, form: str, lo: int, hi: int) -> Iterator[bytes]:
    """The transformed text as chunks; ``lo`` and ``hi`` are the cuts in bytes."""
    if form == "plain":
        yield from reader.stream()
        return
    prefix, middle, suffix = (PREFIX, 0, lo), (MIDDLE, lo, hi), (SUFFIX, hi, None)
    for mark, start, stop in ((prefix, suffix, middle) if form == "psm" else (suffix, prefix, middle)):
        yield mark
        yield from reader.stream(start, stop)


def rebuilt(reader: FrameReader, form: str) -> Iterator[bytes]:
    """The original text as chunks, from the transformed one and its form alone."""
    if form == "plain":
        yield from reader.stream()
        return
    order = [PREFIX, SUFFIX, MIDDLE] if form == "psm" else [SUFFIX, PREFIX, MIDDLE]
    places = reader.find(order)
    ends = [*places[1:], reader.total("bytes")]
    part = {m: (p + len(m), e) for m, p, e in zip(order, places, ends, strict=True)}
    for mark in (PREFIX, MIDDLE, SUFFIX):
        yield from reader.stream(*part[mark])


def store(docs: DataFrame, frame_bytes: int = 1 << 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, marked, frames): the texts as seekable frames; one row per row of ``docs``.

    ``n`` counts units; ``marked`` tells that a mark occurs in the text. Null and
    empty texts have no frame. A unit may be longer than a frame.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, marked, frames = [], [], []
            for text in batch.column(1):
                data = (text.as_py() or "").encode()
                made = write_frames([data], frame_bytes)
                frames.append(made)
                n.append((made[-1]["units"] if made else 0) + (data[-1:] not in (b"", b"\n")))
                marked.append(any(m in data for m in (PREFIX, SUFFIX, MIDDLE)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(marked, pa.bool_()),
                                              pa.array(frames, _ARROW)], names=[id_col, "n", "marked", "frames"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text")).mapInArrow(
        run, f"`{id_col}` {kind}, n long, marked boolean, frames {FRAMES}")


def plan(stored: DataFrame, salt: str = "7", rate: int = 100, spm: int = 50, id_col: str = "doc_id") -> DataFrame:
    """Adds ``form``, ``lo`` and ``hi`` (cuts in units), which follow from id and number of units alone.

    Of 100 texts about ``rate`` are transformed, of these ``spm`` of 100 suffix
    first; the id draws them. Empty texts and those in which a mark occurs stay
    plain. A null id draws as an empty one.
    """
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)

    def drawn(k: int) -> Column:
        return F.conv(F.substring("_digest", 1 + 8 * k, 8), 16, 10).cast("long")

    cuts = [drawn(k) % (F.col("n") + 1) for k in (0, 1)]
    form = (F.when((F.col("n") == 0) | F.col("marked") | (drawn(2) % 100 >= rate), "plain")
            .when(drawn(3) % 100 < spm, "spm").otherwise("psm"))
    return (stored.withColumn("_digest", digest).withColumn("form", form)
            .withColumn("lo", F.least(*cuts)).withColumn("hi", F.greatest(*cuts)).drop("_digest", "marked"))


def transform(planned: DataFrame, frame_bytes: int = 1 << 16, id_col: str = "doc_id") -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, frames): the transformed texts, again as frames.

    Cuts are found in their own frames. Lengths are in code points, null if plain.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefix, middle, frames = [], [], []
            col = {name: batch.column(name) for name in ("form", "lo", "hi", "frames")}
            for i in range(batch.num_rows):
                form, reader = col["form"][i].as_py(), FrameReader(col["frames"][i].as_py())
                (lo, before), (hi, upto) = ((0, 0), (0, 0)) if form == "plain" else (
                    reader.seek(col["lo"][i].as_py()), reader.seek(col["hi"][i].as_py()))
                prefix.append(None if form == "plain" else before)
                middle.append(None if form == "plain" else upto - before)
                frames.append(write_frames(transformed(reader, form, lo, hi), frame_bytes))
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), batch.column("n"), col["form"], pa.array(prefix, pa.int64()),
                 pa.array(middle, pa.int64()), pa.array(frames, _ARROW)],
                names=[id_col, "n", "form", "prefix_chars", "middle_chars", "frames"])

    kind = planned.schema[id_col].dataType.simpleString()
    return planned.select(id_col, "n", "form", "lo", "hi", "frames").mapInArrow(
        run, f"`{id_col}` {kind}, n long, form string, prefix_chars long, middle_chars long, frames {FRAMES}")


def restore(changed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, text): the original texts, rebuilt from transformed frames and form."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [b"".join(rebuilt(FrameReader(f.as_py()), form.as_py())).decode()
                     for form, f in zip(batch.column(1), batch.column(2), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])

    kind = changed.schema[id_col].dataType.simpleString()
    return changed.select(id_col, "form", "frames").mapInArrow(run, f"`{id_col}` {kind}, text string")


def digests(changed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256): both digests from streamed frames."""

    def digest(chunks: Iterable[bytes]) -> str:
        h = sha256()
        for chunk in chunks:
            h.update(chunk)
        return h.hexdigest()

    names = [id_col, "n", "form", "prefix_chars", "middle_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            output, restored = [], []
            for form, frames in zip(batch.column("form"), batch.column("frames"), strict=True):
                reader = FrameReader(frames.as_py())
                output.append(digest(reader.stream()))
                restored.append(digest(rebuilt(reader, form.as_py())))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(output), pa.array(restored)],
                                             names=[*names, "output_sha256", "restored_sha256"])

    kinds = ", ".join(f"`{c}` {changed.schema[c].dataType.simpleString()}" for c in names)
    return changed.select(*names, "frames").mapInArrow(run, f"{kinds}, output_sha256 string, restored_sha256 string")
