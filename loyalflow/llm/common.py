"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession

from loyalflow.session import scratch_path

#: A word of a text: what stands between blanks, tabs and line ends.
BLANK = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as it takes to be no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder (``spark.checkpoint.dir``) and read it back.

    Cuts the lineage: what follows re-reads the files, also after an executor is lost.
    """
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_shared_file(spark: SparkSession, name: str, data: bytes) -> str:
    """A driver-made file of bounded size, written through Hadoop into the shared folder."""
    path = os.path.join(scratch_path(spark, "llm-file"), name)
    jvm, jsc = spark.sparkContext._jvm, spark.sparkContext._jsc
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(jsc.hadoopConfiguration()).create(target, True)
    try:
        for i in range(0, len(data), 1 << 20):
            out.write(bytearray(data[i:i + (1 << 20)]))
    finally:
        out.close()
    return path


def ship(spark: SparkSession) -> None:
    """Give the executors' Python this package (once per application), as ``--py-files`` would."""
    import io
    import zipfile
    from pathlib import Path

    sc = spark.sparkContext
    name = "loyalflow_package.zip"
    if name in sc._python_includes:
        return
    root = Path(__file__).resolve().parents[2]
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted((root / "loyalflow").rglob("*.py")):
            z.write(f, f.relative_to(root))
    sc.addPyFile(write_shared_file(spark, name, data.getvalue()))


class TextMemo:
    """Token ids of whole texts through a bounded memo of blank-separated chunks.

    A single blank between two non-blank characters always starts a new
    pre-token in byte-level BPE, so ``" " + chunk`` encodes the same in every
    text. ``encode_many`` encodes strings (the tokenizer itself); the memo only
    saves calls. Two generations bound the memory: a full one becomes the old one.
    """

    def __init__(self, encode_many: Callable[[list[str]], list[bytes]],
                 encode_chunks: Callable[[list[str]], list[bytes]] | None = None, limit: int = 250_000):
        import re

        self.encode_many, self.encode_chunks, self.limit = encode_many, encode_chunks or encode_many, limit
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.boundary = re.compile(r"(?<=\S) (?=\S)")

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.new) > self.limit:
            self.old, self.new = self.new, {}
        split, missing, new, old = [], {}, self.new, self.old
        for text in texts:
            chunks = text.split(" ")
            first, chunks = chunks[0], chunks[1:]
            values = list(map(new.get, chunks))
            lost = [c for c, v in zip(chunks, values, strict=True) if v is None] if None in values else []
            if first[-1:].isspace() or (not first and chunks) \
                    or [c for c in lost if not c or c.strip() != c]:
                first, *chunks = self.boundary.split(text)
                lost = [c for c in chunks if c not in new]
            for c in lost:
                known = old.get(c)
                if known is None:
                    missing[c] = None
                else:
                    new[c] = known
            split.append((first, chunks))
        todo = list(missing)
        new.update(zip(todo, self.encode_chunks([" " + c for c in todo]), strict=True))
        heads = list({first: None for first, _ in split})
        head = dict(zip(heads, self.encode_many(heads), strict=True))
        return [head[first] + b"".join(map(new.__getitem__, chunks)) for first, chunks in split]


def text_blocks(column, most: int = 2_000_000) -> Iterator[tuple[int, list[str]]]:
    """Slices of a text column as (first row, texts), each of about ``most`` characters; null counts as empty."""
    block, size, start = [], 0, 0
    for i, x in enumerate(column):
        text = x.as_py() or ""
        block.append(text)
        size += len(text)
        if size >= most:
            yield start, block
            block, size, start = [], 0, i + 1
    if block:
        yield start, block
