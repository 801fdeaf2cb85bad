"""URL filter: rules in a sorted array of 64-bit digests.

The index is one file: sorted xxhash64 keys, offsets, verdicts and the full rule
strings. Spark ships it to the executors, Python workers memory-map it. Each
url gives one key per host suffix and rule-path length; all keys of a batch are
probed by one binary search, and a hit counts only if the stored string is equal.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loyalflow.llm.common import write_shared_file

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    end = min((i for i in (rest.find("/"), rest.find("?"), rest.find("#")) if i >= 0), default=len(rest))
    host, path = rest[:end], rest[end:]
    end = min((i for i in (path.find("?"), path.find("#")) if i >= 0), default=len(path))
    return host.translate(LOWER), path[:end]


def build_index(rules: list[tuple[str, str]], most_bytes: int = 256 << 20) -> bytes:
    """Index file of (verdict, rule) pairs; a rule is a host and the path from its first ``/`` on.

    Of a rule listed with both verdicts, block stands. More than ``most_bytes``
    of index is an error: the file goes to every executor.
    """
    import xxhash

    verdicts: dict[str, str] = {}
    for verdict, rule in rules:
        if verdict not in ("allow", "block") or "/" not in rule:
            raise ValueError(f"not a rule: {verdict} {rule}")
        if verdicts.get(rule) != "block":
            verdicts[rule] = verdict
    names = list(verdicts)
    keys = np.asarray([xxhash.xxh64_intdigest(r) for r in names], dtype=np.uint64)
    order = np.argsort(keys, kind="stable")
    names = [names[i] for i in order.tolist()]
    text = [r.encode() for r in names]
    ends = np.cumsum([0, *map(len, text)]).astype(np.uint64)
    blocks = np.asarray([verdicts[r] == "block" for r in names], dtype=np.uint8)
    paths = sorted({len(r) - r.index("/") for r in names})
    head = json.dumps({"n": len(names), "path_lengths": paths,
                       "host": max((r.index("/") for r in names), default=0)}).encode()
    head = head.ljust(-(-len(head) // 8) * 8)
    data = b"".join([len(head).to_bytes(8, "little"), head, keys[order].tobytes(), ends.tobytes(), blocks.tobytes(),
                     *text])
    if len(data) > most_bytes:
        raise ValueError(f"{len(data)} bytes of rules; at most {most_bytes}")
    return data


class DigestIndex:
    """The memory-mapped index."""

    def __init__(self, path: str):
        data = np.memmap(path, dtype=np.uint8, mode="r")
        size = int.from_bytes(data[:8].tobytes(), "little")
        head = json.loads(data[8:8 + size].tobytes())
        n, at = head["n"], 8 + size
        self.path_lengths, self.longest_host = head["path_lengths"], head["host"]
        self.keys = data[at:at + 8 * n].view(np.uint64)
        self.ends = data[at + 8 * n:at + 16 * n + 8].view(np.uint64)
        self.blocks = data[at + 16 * n + 8:at + 17 * n + 8]
        self.text = data[at + 17 * n + 8:]

    def find(self, digests: np.ndarray, strings: list[str]) -> np.ndarray:
        """The rule equal to each string, -1 where there is none."""
        out = np.full(len(strings), -1, dtype=np.int64)
        if not len(self.keys) or not strings:
            return out
        lo = np.searchsorted(self.keys, digests, side="left")
        hi = np.searchsorted(self.keys, digests, side="right")
        for i in np.flatnonzero(hi > lo).tolist():
            want = strings[i].encode()
            for k in range(int(lo[i]), int(hi[i])):  # more than one only where digests collide
                if self.rule(k) == want:
                    out[i] = k
        return out

    def rule(self, k: int) -> bytes:
        return self.text[int(self.ends[k]):int(self.ends[k + 1])].tobytes()

    def match(self, urls: list[str | None]) -> list[tuple[str, str, str | None, str | None]]:
        """Host, path, rule and its verdict of each url; the longest rule wins, of equally long ones that of the longer host."""
        import xxhash

        split = [split_url(u) for u in urls]
        keys, row, rank = [], [], []
        for i, (host, path) in enumerate(split):
            at = max(0, len(host) - self.longest_host)
            if at:  # a suffix starts behind a dot
                at = host.find(".", at - 1) + 1 or len(host)
            lengths = [n for n in self.path_lengths if n <= len(path)]
            while at < len(host):
                for n in lengths:
                    keys.append(host[at:] + path[:n])
                    row.append(i)
                    rank.append((len(keys[-1]), len(host) - at))
                at = host.find(".", at) + 1 or len(host)
        digests = np.fromiter(map(xxhash.xxh64_intdigest, keys), dtype=np.uint64, count=len(keys))
        best: dict[int, tuple[tuple[int, int], int]] = {}
        found = self.find(digests, keys)
        for c in np.flatnonzero(found >= 0).tolist():
            if row[c] not in best or rank[c] > best[row[c]][0]:
                best[row[c]] = rank[c], int(found[c])
        return [(host, path, self.rule(best[i][1]).decode() if i in best else None,
                 ("block" if self.blocks[best[i][1]] else "allow") if i in best else None)
                for i, (host, path) in enumerate(split)]


_KEPT: dict[str, DigestIndex] = {}


def judge(spark: SparkSession, pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id",
          url_col: str = "url", default: str = "allow") -> DataFrame:
    """One row per url: id, host, path, rule and verdict.

    A rule fits its host and all subdomains, if the path starts with the rule's.
    Urls that no rule fits get ``default``. A url that is null or has no ``://``
    has an empty host and path and fits no rule; repeated rows are judged each.
    """
    name = f"rules-{uuid.uuid4().hex}.idx"
    spark.sparkContext.addFile(write_shared_file(spark, name, build_index(rules)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _KEPT:
            _KEPT[name] = DigestIndex(SparkFiles.get(name))
        for batch in batches:
            found = _KEPT[name].match(batch.column(1).to_pylist())
            cols = [pa.array([f[k] for f in found], pa.string()) for k in range(3)]
            verdicts = pa.array([f[3] or default for f in found], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols, verdicts],
                                             names=[id_col, "host", "path", "rule", "verdict"])

    kind = pages.schema[id_col].dataType.simpleString()
    return (pages.select(F.col(id_col), F.col(url_col).cast("string").alias("_url"))
            .mapInArrow(run, f"`{id_col}` {kind}, host string, path string, rule string, verdict string"))
