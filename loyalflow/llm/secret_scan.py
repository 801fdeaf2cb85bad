"""Secret scan: fixed patterns, and a character convolutional network for what they miss.

Every candidate (a long run of key characters with letters and digits) is read
with its surrounding context by a convolutional network in numpy. It is trained
on labelled findings: the candidates of all documents, labelled by the fixed
patterns, and generated ones of known kinds. Tasks train on shards of them, and
after every pass the shards' networks are averaged. Its logits are calibrated on
all findings kept out of the training, and the threshold is the highest that
still recalls the wanted share of them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyalflow.llm.common import materialize, text_blocks
from loyalflow.llm.toxicity import calibrate

# The base patterns, the least length of what each must hold, and their order.
ASSIGN = re.compile(r"""(?ia)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
KEYWORDS = ("passw", "secret", "token", "api")
KINDS = ("assign", "access", "hex", "network")

CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
BEFORE, INSIDE, AFTER = 24, 48, 16
SYMBOLS, EMBED, WIDTH, FILTERS = 98, 6, 5, 24
#: Findings of a shard; steps of a logit that are counted together for the calibration, and the largest logit told apart.
SHARD, LOGIT_STEPS, LOGIT_MOST = 4000, 1 << 13, 32


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns' findings: leftmost, non-overlapping per kind, failing ones dropped."""
    found = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(text: str) -> list[tuple[int, int]]:
    """Runs of 20 or more key characters with a letter and a digit."""
    return [m.span() for m in CANDIDATE.finditer(text)
            if any(c.isdigit() for c in m[0]) and any(c.isalpha() for c in m[0])]


def views(text: str, start: int, end: int) -> list[tuple[str, int]]:
    """The candidate with its context as (characters, length of the part inside); a long one in overlapping parts."""
    out = []
    for at in range(start, max(start + 1, end - INSIDE // 2), INSIDE // 2):
        stop = min(end, at + INSIDE)
        out.append((text[max(0, at - BEFORE):at].rjust(BEFORE, "\0") + text[at:stop] + text[stop:stop + AFTER], stop - at))
    return out


def encode(view: list[tuple[str, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols (0: nothing there, 96: line end, 97: beyond ASCII) and whether each lies inside the candidate."""
    size = BEFORE + INSIDE + AFTER
    symbols = np.zeros((len(view), size), dtype=np.int64)
    inside = np.zeros((len(view), size), dtype=np.float32)
    for i, (chars, n) in enumerate(view):
        codes = np.frombuffer(chars.encode("utf-32-le", "replace"), dtype="<u4").astype(np.int64)
        known = np.where((codes >= 32) & (codes < 127), codes - 31, np.where(codes == 0, 0, np.where(codes == 10, 96, 97)))
        symbols[i, :len(known)] = known
        inside[i, BEFORE:BEFORE + n] = 1
    return symbols, inside


class Network:
    """Character embedding, one convolution, rectifier, maximum over the window, logistic output."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.w = {"embed": rng.standard_normal((SYMBOLS, EMBED)) * 0.3,
                  "conv": rng.standard_normal((WIDTH * (EMBED + 1), FILTERS)) * 0.2, "bias": np.zeros(FILTERS),
                  "out": rng.standard_normal(2 * FILTERS) * 0.2, "shift": np.zeros(1)}
        self.w = {k: v.astype(np.float32) for k, v in self.w.items()}
        self.scale, self.threshold = np.asarray([1.0, 0.0]), 0.5
        self.held = np.empty(0, np.int64)  # of the generated findings, those kept out

    def forward(self, symbols: np.ndarray, inside: np.ndarray):
        """Logits: the maximum of each filter and its mean inside the candidate feed the output."""
        x = np.concatenate([self.w["embed"][symbols], inside[:, :, None]], axis=2)
        n, size, depth = x.shape
        patches = np.lib.stride_tricks.sliding_window_view(x, WIDTH, axis=1).transpose(0, 1, 3, 2).reshape(n, -1, WIDTH * depth)
        seen = np.maximum(patches @ self.w["conv"] + self.w["bias"], 0)
        best = seen.argmax(axis=1)
        top = np.take_along_axis(seen, best[:, None, :], axis=1)[:, 0]
        share = inside[:, WIDTH // 2:size - WIDTH // 2]
        share = share / np.maximum(1, share.sum(axis=1, keepdims=True))
        mean = np.einsum("ntf,nt->nf", seen, share)
        pooled = np.concatenate([top, mean], axis=1)
        return pooled @ self.w["out"] + self.w["shift"][0], (x, patches, seen, best, share, pooled)

    def gradient(self, symbols: np.ndarray, error: np.ndarray, memory) -> dict[str, np.ndarray]:
        x, patches, seen, best, share, pooled = memory
        grad = {"out": pooled.T @ error, "shift": np.asarray([error.sum()])}
        d_pooled = error[:, None] * self.w["out"]
        d_seen = share[:, :, None] * d_pooled[:, None, FILTERS:]
        np.put_along_axis(d_seen, best[:, None, :],
                          np.take_along_axis(d_seen, best[:, None, :], axis=1) + d_pooled[:, None, :FILTERS], axis=1)
        d_seen *= seen > 0
        grad["conv"] = np.einsum("ntp,ntf->pf", patches, d_seen, optimize=True)
        grad["bias"] = d_seen.sum(axis=(0, 1))
        d_patch = (d_seen @ self.w["conv"].T).reshape(len(x), -1, WIDTH, EMBED + 1)
        d_x = np.zeros_like(x)
        for k in range(WIDTH):
            d_x[:, k:k + d_patch.shape[1]] += d_patch[:, :, k]
        flat = symbols.reshape(-1)
        grad["embed"] = np.stack([np.bincount(flat, weights=d_x[:, :, k].reshape(-1), minlength=SYMBOLS)
                                  for k in range(EMBED)], axis=1)
        return grad

    def logits(self, view: list[tuple[str, int]]) -> np.ndarray:
        return np.concatenate([self.forward(*encode(view[lo:lo + 512]))[0] for lo in range(0, len(view), 512)])

    def largest(self, found: list[list[tuple[str, int]]]) -> np.ndarray:
        """The largest logit of each candidate's views."""
        if not found:
            return np.empty(0)
        logits = self.logits([v for vs in found for v in vs])
        return np.maximum.reduceat(logits, np.cumsum([0, *map(len, found)])[:-1])

    def calibrate(self, logits: np.ndarray, y: np.ndarray, recall: float, weight: np.ndarray | None = None) -> None:
        """Scale and threshold on findings that were kept out: ``recall`` of the secrets among them are found.

        A finding counts ``weight`` times (once where none are given).
        """
        weight = np.ones(len(y)) if weight is None else weight
        self.scale = calibrate(np.stack([logits, np.ones(len(y))], axis=1), y, weight)
        p = 1 / (1 + np.exp(-(self.scale[0] * logits + self.scale[1])))
        secret = np.flatnonzero(y > 0)
        secret = secret[np.argsort(p[secret], kind="stable")]
        upto = np.cumsum(weight[secret])
        self.threshold = float(p[secret[np.searchsorted(upto, int((1 - recall) * upto[-1]), "right")]]) if len(secret) else 0.5

    def score(self, found: list[list[tuple[str, int]]]) -> np.ndarray:
        """Calibrated probability of each candidate: the largest of its views."""
        if not found:
            return np.empty(0)
        top = self.largest(found)
        a, b = self.scale
        return 1 / (1 + np.exp(-np.clip(a * top + b, -60, 60)))


def generated(number: int, seed: int) -> list[tuple[str, int, int, int]]:
    """Labelled findings of known kinds: (text, start, end, label)."""
    rng = np.random.default_rng(seed)
    letters = "abcdefghijklmnopqrstuvwxyz"
    sets = ["0123456789abcdef", letters + letters.upper() + "0123456789", letters + letters.upper() + "0123456789+/",
            letters.upper() + "0123456789", letters + "0123456789"]
    parts = ["con", "ter", "ing", "able", "ment", "tion", "re", "un", "ly", "er", "pre", "man", "ver", "log", "data", "user"]

    def pick(xs, k: int) -> str:
        return "".join(xs[i] for i in rng.integers(0, len(xs), k))

    def word() -> str:
        return pick(parts, int(rng.integers(1, 4)))

    def run_of(make, join: str) -> str:
        out = make()
        while len(out) < 20 or not any(c.isdigit() for c in out):
            out += join + (make() if rng.random() < 0.6 else str(rng.integers(0, 10_000)))
        return out

    secret_lead = ["key = ", "password: ", "Authorization: Bearer ", "token=", "secret: \"", "export API_KEY=", "pw ", ""]
    plain_lead = ["see ", "file ", "https://example.com/", "path ", "id ", "in ", "#", "/usr/lib/", "commit ", ""]
    plain = [lambda: run_of(word, "-"), lambda: run_of(word, "_"), lambda: run_of(word, "/"), lambda: run_of(word, ""),
             lambda: run_of(lambda: word().title(), ""), lambda: f"{rng.integers(2000, 2030)}-01-02T{rng.integers(10, 24)}-00-00-{word()}",
             lambda: "x" + pick("0123456789", int(rng.integers(20, 40))), lambda: "a" * 12 + "1" * int(rng.integers(9, 30))]
    out = []
    for i in range(number):
        label = i % 2
        if label:
            lead = secret_lead[rng.integers(len(secret_lead))]
            value = pick(sets[rng.integers(len(sets))], int(rng.integers(20, 64)))
            if not (any(c.isdigit() for c in value) and any(c.isalpha() for c in value)):
                value += "a1"
        else:
            lead = plain_lead[rng.integers(len(plain_lead))]
            value = plain[rng.integers(len(plain))]()
        text = f"{word()} {word()} {lead}"
        out.append((f"{text}{value} {word()} {word()}.", len(text), len(text) + len(value), label))
    return out


def findings(docs: DataFrame, first: Network) -> DataFrame:
    """A row per candidate of every document: key, its view (chars, n) of the largest logit of ``first``, label by the
    fixed patterns and, of the third that is kept out of the training, the text ``around`` and where it lies there."""
    rows = docs.select(F.xxhash64("doc_id", "text").alias("row"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
        for batch in batches:
            out = []
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py() or ""
                found = candidates(text)
                base = base_spans(text) if found else []
                for start, end in found:
                    key = xxhash.xxh64_intdigest(f"{row}:{start}") >> 2
                    seen = views(text, start, end)
                    best = int(np.argmax(first.logits(seen))) if len(seen) > 1 else 0
                    label = int(any(s < end and start < e for s, _, e in base))
                    lo = max(0, start - BEFORE)
                    held = (text[lo:end + AFTER], start - lo, end - lo) if key % 3 == 0 else (None, None, None)
                    out.append((key, *seen[best], label, *held))
            cols = zip(*out, strict=True) if out else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                             names=["key", "chars", "n", "label", "around", "start", "end"])

    return rows.mapInArrow(run, "key long, chars string, n int, label int, around string, start long, end long")


def fit(docs: DataFrame, made: int = 2400, recall: float = 0.95, seed: int = 3, epochs: int = 5, per_shard: int = SHARD) -> Network:
    """Train on the findings of all documents and on ``made`` generated ones.

    A network of the generated findings alone picks one view of each candidate, in
    the tasks. A third of the findings is kept out; the others are dealt by the hash
    of id, text and place (so that files and partitions do not matter) to shards of
    about ``per_shard``. In each pass every shard trains on its findings and the
    generated ones, in a task, and the networks are averaged. Calibration and
    threshold take the largest logits over all views of all that is kept out, as
    counts per step of the logit; the generated ones among them weigh as often as
    they were trained with. The driver holds an average per square root of the
    shards, and the counts. Without candidates only the generated findings are used.
    """
    drawn = [(views(t, a, b), y) for t, a, b, y in generated(made, seed)]
    first = train(drawn, recall, seed, epochs)
    found = materialize(findings(docs, first), "secret-findings")
    number = found.count()
    if not number:
        return first
    shards = max(1, -(-number * 2 // 3 // per_shard))
    dealt = materialize(shard_rows(found.where("around IS NULL"), shards), "secret-shards")
    held, used = kept_in(made, seed)
    # where all findings are kept out, there is nothing to learn from but the generated ones
    net = first if dealt.isEmpty() else averaged(dealt, [drawn[i] for i in used.tolist()], shards, seed, epochs)
    net.held = held

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, at, to, label = (c.to_pylist() for c in batch.columns)
            top = np.asarray([net.largest([views(t, a, b)])[0] for t, a, b in zip(texts, at, to, strict=True)], dtype=np.float64)
            step = np.rint(np.clip(top, -LOGIT_MOST, LOGIT_MOST) * LOGIT_STEPS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(step, pa.int64()), pa.array(label, pa.int32())], names=["step", "label"])

    counts = (found.where("around IS NOT NULL").select("around", "start", "end", "label").mapInArrow(measured, "step long, label int")
              .groupBy("step", "label").agg(F.count(F.lit(1)).alias("n")).toArrow().sort_by([("step", "ascending"), ("label", "ascending")]))
    kept = held.tolist()
    logits = np.concatenate([counts.column("step").to_numpy() / LOGIT_STEPS, net.largest([drawn[i][0] for i in kept])])
    y = np.concatenate([counts.column("label").to_numpy(), [drawn[i][1] for i in kept]]).astype(np.float32)
    weight = np.concatenate([counts.column("n").to_numpy().astype(np.float64), np.full(len(kept), float(shards))])
    net.calibrate(logits, y, recall, weight)
    return net


def shard_rows(found: DataFrame, shards: int) -> DataFrame:
    """A row per shard: its findings' views and labels, in the order of their keys."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([(c, "ascending") for c in ("key", "chars", "n", "label")])
        return pa.table({"shard": group.column("shard")[:1], **{c: pa.array([group.column(c).to_pylist()]) for c in ("chars", "n", "label")}})

    return (found.select((F.expr("key div 3") % F.lit(shards)).alias("shard"), "key", "chars", "n", "label").groupBy("shard")
            .applyInArrow(run, "shard long, chars array<string>, n array<long>, label array<long>"))


def averaged(dealt: DataFrame, drawn: list[tuple[list[tuple[str, int]], int]], shards: int, seed: int, epochs: int) -> Network:
    """The network after ``epochs`` passes over all shards; a pass ends with the average of the shards' trainers.

    Averages are taken in the order of the shards, first of groups of them in
    tasks, so that they do not depend on partitions.
    """
    trainer = Trainer(Network(seed))
    wide = int(np.ceil(np.sqrt(shards)))
    for epoch in range(epochs):
        now = trainer.packed()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for shard, chars, n, label in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    mine = Trainer(Network(seed), now)
                    shown = [([v], y) for *v, y in zip(chars, n, label, strict=True)] + drawn
                    mine.epoch(shown, np.random.default_rng([seed, epoch, shard]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([shard // wide], pa.int64()), pa.array([shard], pa.int64()), pa.array([1], pa.int64()),
                         pa.array([mine.packed().tobytes()], pa.binary())], names=["part", "shard", "n", "state"])

        def summed(group: pa.Table) -> pa.Table:
            group = group.sort_by("shard")
            total = np.sum([np.frombuffer(v.as_buffer(), np.float64) for v in group.column("state")], axis=0)
            return pa.table({"part": group.column("part")[:1], "n": pa.array([group.num_rows], pa.int64()),
                             "state": pa.array([total.tobytes()], pa.binary())})

        parts = (dealt.select("shard", "chars", "n", "label").mapInArrow(run, "part long, shard long, n long, state binary")
                 .groupBy("part").applyInArrow(summed, "part long, n long, state binary").collect())  # a row per ``wide`` shards
        parts.sort(key=lambda r: r["part"])
        total = np.sum([np.frombuffer(r["state"], np.float64) for r in parts], axis=0)
        trainer = Trainer(Network(seed), total / sum(r["n"] for r in parts))
    return trainer.net


class Trainer:
    """A network with the running moments of its gradients (Adam), which travel between tasks as one array."""

    def __init__(self, net: Network, packed: np.ndarray | None = None):
        self.net, self.step = net, 0.0
        self.first = {k: np.zeros_like(v) for k, v in net.w.items()}
        self.second = {k: np.zeros_like(v) for k, v in net.w.items()}
        if packed is not None:
            self.step, at = float(packed[0]), 1
            for held in (net.w, self.first, self.second):
                for k, v in held.items():
                    held[k] = packed[at:at + v.size].reshape(v.shape).astype(np.float32)
                    at += v.size

    def packed(self) -> np.ndarray:
        held = [v.reshape(-1) for part in (self.net.w, self.first, self.second) for v in part.values()]
        return np.concatenate([[self.step], *held]).astype(np.float64)

    def epoch(self, found: list[tuple[list[tuple[str, int]], int]], rng: np.random.Generator) -> None:
        """A pass over candidates (all their views, label); the view of the largest logit stands for its candidate, as in scoring."""
        net = self.net
        order = rng.permutation(len(found))
        for lo in range(0, len(order), 128):
            part = [found[i] for i in order[lo:lo + 128].tolist()]
            shown = [vs[0] if len(vs) == 1 else vs[int(np.argmax(net.logits(vs)))] for vs, _ in part]
            y = np.asarray([label for _, label in part], dtype=np.float32)
            symbols, inside = encode(shown)
            logits, memory = net.forward(symbols, inside)
            error = ((1 / (1 + np.exp(-logits)) - y) / len(part)).astype(np.float32)
            self.step += 1
            for k, g in net.gradient(symbols, error, memory).items():
                m = self.first[k] = 0.9 * self.first[k] + 0.1 * g
                v = self.second[k] = 0.999 * self.second[k] + 0.001 * g * g
                net.w[k] = (net.w[k] - 0.005 * (m / (1 - 0.9 ** self.step)) /
                            (np.sqrt(v / (1 - 0.999 ** self.step)) + 1e-8)).astype(np.float32)


def kept_in(number: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Of so many findings those kept out, a third, and those trained with."""
    order = np.random.default_rng(seed).permutation(number)
    return order[::3], np.setdiff1d(order, order[::3])


def train(found: list[tuple[list[tuple[str, int]], int]], recall: float, seed: int, epochs: int) -> Network:
    """Fit on candidates (all their views, label), in one process."""
    trainer = Trainer(Network(seed))
    net, (held, used) = trainer.net, kept_in(len(found), seed)
    for epoch in range(epochs):
        trainer.epoch([found[i] for i in used.tolist()], np.random.default_rng([seed, epoch]))
    net.held = held
    net.calibrate(net.largest([found[i][0] for i in held.tolist()]),
                  np.asarray([found[i][1] for i in held.tolist()], dtype=np.float32), recall)
    return net


def spans_of(texts: list[str], net: Network) -> list[list[tuple[int, int, int]]]:
    """Base spans of each text, and the network's where they do not cover the whole candidate; (start, kind, end) in order."""
    base = [base_spans(t) for t in texts]
    new = [(i, s, e) for i, t in enumerate(texts) for s, e in candidates(t) if not covered(base[i], s, e)]
    scores = net.score([views(texts[i], s, e) for i, s, e in new])
    for (i, s, e), p in zip(new, scores.tolist(), strict=True):
        if p >= net.threshold:
            base[i].append((s, 3, e))
    return [sorted(b) for b in base]


def covered(spans: list[tuple[int, int, int]], start: int, end: int) -> bool:
    """Whether the spans (in order) leave nothing of what lies from ``start`` to ``end``."""
    for a, _, b in spans:
        if a > start:
            break
        start = max(start, b)
    return start >= end


def scan(docs: DataFrame, net: Network) -> DataFrame:
    """One row per document: doc_id and spans (array of kind, start, end; code points, end exclusive).

    Null and empty texts have none; repeated rows are scanned each; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            out = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans]
                   for _, texts in text_blocks(batch.column(1)) for spans in spans_of(texts, net)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], names=["doc_id", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select("doc_id", F.col("text").cast("string").alias("text"))
            .mapInArrow(run, f"doc_id {kind}, spans array<struct<kind:string,start:bigint,end:bigint>>"))


def redact(docs: DataFrame, net: Network, mark: str = "[SECRET]") -> DataFrame:
    """The documents with every span (overlapping ones merged) replaced by ``mark``; ``n_chars``, if there, follows.

    All rows and columns stay; a null text stays null.
    """
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for first, texts in text_blocks(batch.column(at)):
                for i, (text, spans) in enumerate(zip(texts, spans_of(texts, net), strict=True), first):
                    parts, done = [], 0
                    for s, _, e in spans:
                        if s >= done:
                            parts += [text[done:s], mark]
                        done = max(done, e)
                    out.append("".join([*parts, text[done:]]) if batch.column(at)[i].is_valid else None)
            yield batch.set_column(at, batch.schema.field(at), pa.array(out, batch.schema.field(at).type))

    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))
    return out.select(docs.columns)


def summary(docs: DataFrame, net: Network) -> DataFrame:
    """The scan as counts, a digest of the base spans, and all spans as text."""
    shown = F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    base = F.transform(F.filter("spans", lambda s: s["kind"] != KINDS[3]),
                       lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return scan(docs, net).select("doc_id", *[count(k) for k in KINDS],
                                  F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
                                  F.array_join(shown, ",").alias("spans"))
