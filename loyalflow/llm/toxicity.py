"""Toxicity scores by a bidirectional gated recurrent network, trained and run in numpy.

A word's input is its learned vector (words of the training sample) next to the
mean of its character-trigram vectors (all words). Two gated recurrent layers
read each window of words in both directions, attention pools their states, and
a logistic output gives the window's logit. All overlapping windows of a text
are scored; the largest logit, calibrated on documents kept out of the training,
is the score.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from loyalflow.llm.common import materialize, text_blocks, unused

WINDOW, STRIDE = 32, 16
HIDDEN, WORD_DIM, CHAR_DIM, ATTENTION = 8, 8, 8, 8
TRIGRAMS = 4096
LONGEST_WORD = 32
STRIPPED = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»“”„‘’…·–—¿¡"


def words_of(chunk: str) -> list[str]:
    """The word in a blank-free chunk, without punctuation around it; a very long one in overlapping pieces."""
    word = chunk.strip(STRIPPED) or chunk
    if len(word) <= LONGEST_WORD:
        return [word]
    step = LONGEST_WORD - 8
    return [word[i:i + LONGEST_WORD] for i in range(0, len(word) - 8, step)]


def trigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed character trigrams of ``<word>`` (bytes), one after the other, and where each word's begin."""
    data = [b"<%b>" % w.encode("utf-8", "replace") for w in words]
    size = np.fromiter(map(len, data), dtype=np.int64, count=len(data))
    text = np.frombuffer(b"".join(data), dtype=np.uint8).astype(np.int64)
    first = np.cumsum(size) - size
    count = size - 2
    starts = np.cumsum(count) - count
    at = np.repeat(first - starts, count) + np.arange(count.sum())
    code = (text[at] << 16) | (text[at + 1] << 8) | text[at + 2]
    return ((code * 0x9E3779B1 >> 13) & (TRIGRAMS - 1)), starts


def window_starts(n: int) -> range:
    """Starts of the overlapping windows that cover ``n`` words."""
    return range(0, max(1, n - WINDOW + STRIDE), STRIDE)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def split(gates: np.ndarray) -> list[np.ndarray]:
    """The gates of each direction."""
    return [np.ascontiguousarray(gates[:, 3 * HIDDEN * d:3 * HIDDEN * (d + 1)]) for d in (0, 1)]


class Network:
    """The weights, with forward and backward passes over windows of word rows."""

    def __init__(self, vocabulary: list[str], seed: int):
        rng = np.random.default_rng(seed)
        self.vocabulary = {w: i + 1 for i, w in enumerate(vocabulary)}
        h, x = HIDDEN, WORD_DIM + CHAR_DIM

        def new(*shape: int, scale: float = 0.3) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        self.w = {"word": new(len(vocabulary) + 1, WORD_DIM), "char": new(TRIGRAMS, CHAR_DIM),
                  "in": new(x, 6 * h), "bias": np.zeros(6 * h, dtype=np.float32),
                  "up0": new(h, 3 * h), "up1": new(h, 3 * h), "att": new(2 * h, ATTENTION), "query": new(ATTENTION),
                  "out": new(2 * h), "shift": np.zeros(1, dtype=np.float32)}
        self.w["word"][0] = 0
        self.scale = np.asarray([1.0, 0.0, 0.0])  # calibration: logit, log of the windows, constant

    def inputs(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Input vectors of words, with their vocabulary rows and trigrams."""
        rows = np.fromiter((self.vocabulary.get(w, 0) for w in words), dtype=np.int64, count=len(words))
        grams, starts = trigrams(words)
        number = np.diff(np.append(starts, len(grams)))
        chars = np.add.reduceat(self.w["char"][grams], starts, axis=0) / number[:, None]
        return np.concatenate([self.w["word"][rows], chars], axis=1).astype(np.float32), rows, grams, starts

    def project(self, words: list[str]) -> np.ndarray:
        """What each word adds to the gates of both directions."""
        return self.inputs(words)[0] @ self.w["in"] + self.w["bias"]

    def padding(self) -> np.ndarray:
        """Gates that leave the state as it is: the update gate stays shut."""
        row = np.zeros(6 * HIDDEN, dtype=np.float32)
        row[HIDDEN:2 * HIDDEN] = row[4 * HIDDEN:5 * HIDDEN] = 40
        return row

    def forward(self, tables: list[np.ndarray], rows: np.ndarray, keep: bool = False):
        """Logits of windows (rows: windows x words in the gate ``tables``; row 0 is padding), and what backward needs."""
        h, n = HIDDEN, len(rows)
        t_max = rows.shape[1]
        states = np.empty((t_max, n, 2 * h), dtype=np.float32)
        kept = []
        for d in (0, 1):
            s = np.zeros((n, h), dtype=np.float32)
            up = self.w[f"up{d}"]
            part = tables[d]
            for t in range(t_max) if d == 0 else range(t_max - 1, -1, -1):
                x = part[rows[:, t]]
                u = s @ up
                g = sigmoid(x[:, :2 * h] + u[:, :2 * h])
                r, z = g[:, :h], g[:, h:]
                c = np.tanh(x[:, 2 * h:] + r * u[:, 2 * h:])
                if keep:
                    kept.append((d, t, s, r, z, c, u[:, 2 * h:]))
                s = c + z * (s - c)
                states[t, :, h * d:h * (d + 1)] = s
        inner = np.tanh(states @ self.w["att"])
        energy = np.where(rows.T > 0, inner @ self.w["query"], -1e9)
        energy[0] = np.where(rows[:, 0] > 0, energy[0], 0)  # an empty window
        weight = np.exp(energy - energy.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = (weight[:, :, None] * states).sum(axis=0)
        logits = pooled @ self.w["out"] + self.w["shift"][0]
        return (logits, (states, inner, weight, pooled, kept)) if keep else logits

    def backward(self, rows: np.ndarray, error: np.ndarray, memory, words: int) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of the weights, and of each table row's gates, for the logits' ``error``."""
        states, inner, weight, pooled, kept = memory
        h, w = HIDDEN, self.w
        grad = {"out": pooled.T @ error, "shift": np.asarray([error.sum()])}
        d_pooled = error[:, None] * w["out"]
        d_states = weight[:, :, None] * d_pooled
        d_weight = (states * d_pooled).sum(axis=2)
        d_energy = weight * (d_weight - (weight * d_weight).sum(axis=0))
        grad["query"] = np.einsum("tna,tn->a", inner, d_energy)
        d_inner = d_energy[:, :, None] * w["query"] * (1 - inner * inner)
        grad["att"] = np.einsum("tns,tna->sa", states, d_inner)
        d_states = d_states + d_inner @ w["att"].T
        d_table = np.zeros((words, 6 * h), dtype=np.float32)
        back = {0: np.zeros((len(rows), h), dtype=np.float32), 1: np.zeros((len(rows), h), dtype=np.float32)}
        grad["up0"], grad["up1"] = np.zeros_like(w["up0"]), np.zeros_like(w["up1"])
        flat = [[], []]
        for d, t, s, r, z, c, u in reversed(kept):
            ds = back[d] + d_states[t, :, h * d:h * (d + 1)]
            dc = ds * (1 - z) * (1 - c * c)
            dz = ds * (s - c) * z * (1 - z)
            dr = dc * u * r * (1 - r)
            gates = np.concatenate([dr, dz, dc], axis=1)
            through = np.concatenate([dr, dz, dc * r], axis=1)
            grad[f"up{d}"] += s.T @ through
            back[d] = ds * z + through @ w[f"up{d}"].T
            flat[d].append((t, gates))
        for d in (0, 1):
            order = sorted(flat[d], key=lambda x: x[0])
            gates = np.stack([g for _, g in order], axis=1).reshape(-1, 3 * h)
            index = rows.reshape(-1)
            for k in range(3 * h):
                d_table[:, 3 * h * d + k] = np.bincount(index, weights=gates[:, k], minlength=words)
        d_table[0] = 0
        return grad, d_table


#: Of documents: the largest logit over all windows, the number of windows, and the words of that window.
Survey = Callable[[Network, np.ndarray], tuple[np.ndarray, np.ndarray, list[list[str]]]]


class Trainer:
    """Adam on the network's windows."""

    def __init__(self, net: Network, rate: float = 0.01):
        self.net, self.rate, self.step = net, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in net.w.items()}
        self.v = {k: np.zeros_like(v) for k, v in net.w.items()}

    def batch(self, windows: list[list[str]], target: np.ndarray, weight: np.ndarray) -> None:
        net = self.net
        words, rows = as_rows(windows)
        x, vocab, grams, starts = net.inputs(words)
        table = np.concatenate([net.padding()[None], x @ net.w["in"] + net.w["bias"]])
        logits, memory = net.forward(split(table), rows, keep=True)
        error = ((sigmoid(logits) - target) * weight / weight.sum()).astype(np.float32)
        grad, d_table = net.backward(rows, error, memory, len(table))
        d_gates = d_table[1:]
        grad["in"], grad["bias"] = x.T @ d_gates, d_gates.sum(axis=0)
        d_x = d_gates @ net.w["in"].T
        number = np.diff(np.append(starts, len(grams)))
        d_char = np.repeat(d_x[:, WORD_DIM:] / number[:, None], number, axis=0)
        grad["word"] = np.stack([np.bincount(vocab, weights=d_x[:, k], minlength=len(net.w["word"]))
                                 for k in range(WORD_DIM)], axis=1)
        grad["word"][0] = 0
        grad["char"] = np.stack([np.bincount(grams, weights=d_char[:, k], minlength=TRIGRAMS)
                                 for k in range(CHAR_DIM)], axis=1)
        self.step += 1
        for k, g in grad.items():
            g = g + 1e-5 * net.w[k]
            self.m[k] = 0.9 * self.m[k] + 0.1 * g
            self.v[k] = 0.99 * self.v[k] + 0.01 * g * g
            m, v = self.m[k] / (1 - 0.9 ** self.step), self.v[k] / (1 - 0.99 ** self.step)
            net.w[k] = (net.w[k] - self.rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32)


def as_rows(windows: list[list[str]]) -> tuple[list[str], np.ndarray]:
    """Distinct words, and the windows as rows of them counted from 1 (0: padding)."""
    known: dict[str, int] = {}
    rows = np.zeros((len(windows), WINDOW), dtype=np.int64)
    for i, ws in enumerate(windows):
        rows[i, :len(ws)] = [known.setdefault(w, len(known) + 1) for w in ws]
    return list(known) or [""], rows


class Scorer:
    """Scores whole texts; gates of words are kept in a bounded table."""

    def __init__(self, net: Network, most_words: int = 150_000):
        self.net, self.most = net, most_words
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.pieces: list[list[int]] = []  # of chunks with several words; known has -1 - their place here
        self.tables = [np.empty((1 << 16, 3 * HIDDEN), dtype=np.float32) for _ in (0, 1)]
        self.used = 0
        self.add(self.net.padding()[None])

    def add(self, gates: np.ndarray) -> None:
        need = self.used + len(gates)
        for d in (0, 1):
            if need > len(self.tables[d]):
                grown = np.empty((max(need, 2 * len(self.tables[d])), 3 * HIDDEN), dtype=np.float32)
                grown[:self.used] = self.tables[d][:self.used]
                self.tables[d] = grown
            self.tables[d][self.used:need] = gates[:, 3 * HIDDEN * d:3 * HIDDEN * (d + 1)]
        self.used = need

    def rows_of(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.known) > self.most:
            self.clear()
        chunks = [t.lower().split() for t in texts]
        rows: list = [list(map(self.known.get, cs)) for cs in chunks]
        missing = {c: None for cs, rs in zip(chunks, rows, strict=True) if None in rs
                   for c, r in zip(cs, rs, strict=True) if r is None}
        if missing:
            parts = [words_of(c) for c in missing]
            at = self.used
            self.add(self.net.project([w for p in parts for w in p]))
            for c, p in zip(missing, parts, strict=True):
                if len(p) == 1:
                    self.known[c] = at
                else:
                    self.known[c] = -1 - len(self.pieces)
                    self.pieces.append(list(range(at, at + len(p))))
                at += len(p)
        out = []
        for cs, rs in zip(chunks, rows, strict=True):
            if missing and None in rs:
                rs = list(map(self.known.__getitem__, cs))
            row = np.asarray(rs, dtype=np.int64)
            if len(row) and row.min() < 0:
                row = np.asarray([x for r in rs for x in (self.pieces[-1 - r] if r < 0 else [r])], dtype=np.int64)
            out.append(row)
        return out

    def every(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The logits of all windows of the texts, one text after the other, and each text's number of windows."""
        rows = self.rows_of(texts)
        count = np.asarray([len(window_starts(len(r))) for r in rows])
        flat = np.concatenate([np.append(r, np.zeros(WINDOW + STRIDE, dtype=np.int64)) for r in rows])
        base = np.cumsum([0, *[len(r) + WINDOW + STRIDE for r in rows]])[:-1]
        starts = np.concatenate([b + np.asarray(window_starts(len(r))) for b, r in zip(base, rows, strict=True)])
        out = np.empty(len(starts), dtype=np.float32)
        for lo in range(0, len(starts), 2048):
            at = starts[lo:lo + 2048, None] + np.arange(WINDOW)
            out[lo:lo + 2048] = self.net.forward(self.tables, flat[at])
        return out, count

    def logits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The largest window logit of each text, and its number of windows."""
        out, count = self.every(texts)
        return np.maximum.reduceat(out, np.cumsum(count) - count), count

    def __call__(self, texts: list[str]) -> np.ndarray:
        top, count = self.logits(texts)
        a, b, c = self.net.scale
        return 1 / (1 + np.exp(-np.clip(a * top + b * np.log(count) + c, -60, 60)))


def train(windows: list[list[str]], doc: np.ndarray, toxic: np.ndarray, prior: float, survey: Survey,
          words: Callable[[np.ndarray], list[str]], seed: int = 5, batch: int = 512) -> Network | None:
    """Fit on windows of documents (``doc``: the document of each window, ``toxic``: the label of each document).

    Two passes over ``windows`` with their document's label, then three in which
    a document stands for the highest-scoring of all its windows (clean ones also
    for another one). One document in four calibrates the largest logit of all its
    windows, the statistic that is scored, to the ``prior`` rate. ``survey`` finds
    that window, ``words`` the vocabulary of documents. None if a class is missing.
    """
    if len(set(toxic.tolist())) < 2:
        return None
    rng = np.random.default_rng(seed)
    held = rng.permutation(len(toxic)) % 4 == 0
    if len(set(toxic[held].tolist())) < 2 or len(set(toxic[~held].tolist())) < 2:
        held[:] = False
    used, learned = np.flatnonzero(~held[doc]), np.flatnonzero(~held)
    net = Network(words(learned), seed)
    trainer = Trainer(net)

    def run(some: list[list[str]], of: np.ndarray) -> None:
        order = rng.permutation(len(some))
        for lo in range(0, len(order), batch):
            part = order[lo:lo + batch]
            target = toxic[of[part]].astype(np.float32)
            share = max(1e-3, float(target.mean()))
            trainer.batch([some[i] for i in part.tolist()], target,
                          np.where(target > 0, 0.5 / share, 0.5 / max(1e-3, 1 - share)))

    least = -(-3000 // max(1, len(used)))  # small samples get more passes
    for _ in range(2 * min(8, least)):
        run([windows[i] for i in used.tolist()], doc[used])
    clean = used[toxic[doc[used]] == 0]
    for _ in range(3 * min(8, least)):
        best = survey(net, learned)[2]
        more = rng.permutation(clean)[:len(toxic)]
        run(best + [windows[i] for i in more.tolist()], np.concatenate([learned, doc[more]]))
    which = np.flatnonzero(held) if held.any() else learned
    logits, number, _ = survey(net, which)
    x, y = np.stack([logits, np.log(number), np.ones(len(which))], axis=1), toxic[which]
    net.scale = calibrate(x, y, np.where(y > 0, prior / y.mean(), (1 - prior) / (1 - y.mean())))
    return net


def calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression by Newton's steps, with a small ridge on all but the constant."""
    w = np.zeros(x.shape[1])
    ridge = np.diag([0.05] * (x.shape[1] - 1) + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - y)) + ridge @ w
        step = np.linalg.solve(x.T @ (x * (weight * p * (1 - p))[:, None]) + ridge, grad)
        w -= step * min(1.0, 2.0 / max(1e-9, float(np.abs(step).max())))
    return w


def learnable() -> Column:
    """Rows that labels may be learned from: crc32 of the id as text is no multiple of 5."""
    return F.crc32(F.col("doc_id").cast("string")) % 5 != 0


def survey_of(sample: DataFrame, ids: np.ndarray) -> Survey:
    """Scores all windows of the documents (``sample``: doc_id and text; of an id's rows the largest counts) in tasks.

    Only one window of each document comes to the driver.
    """

    def survey(net: Network, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[list[str]]]:
        wanted = set(ids[which].tolist())

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            scorer = Scorer(net)
            for batch in batches:
                batch = batch.filter(pa.array([i in wanted for i in batch.column(0).to_pylist()], pa.bool_()))
                top, number, best = [], [], []
                for _, texts in text_blocks(batch.column(1)):
                    logits, count = scorer.every(texts)
                    for text, lo, n in zip(texts, np.cumsum(count) - count, count.tolist(), strict=True):
                        k = int(logits[lo:lo + n].argmax())
                        words = [w for c in text.lower().split() for w in words_of(c)]
                        top.append(float(logits[lo + k]))
                        number.append(n)
                        best.append(words[k * STRIDE:k * STRIDE + WINDOW])
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(top, pa.float64()), pa.array(number, pa.int64()),
                                                  pa.array(best, pa.list_(pa.string()))], names=["doc", "top", "n", "words"])

        rows = (sample.select("doc_id", "text").mapInArrow(run, "doc long, top double, n long, words array<string>")
                .groupBy("doc").agg(F.max(F.struct("top", "n", "words")).alias("m"))
                .select("doc", "m.top", "m.n", "m.words").toArrow().sort_by("doc"))
        assert rows.column("doc").to_pylist() == sorted(wanted)  # ids are sorted, so rows stand in the order of which
        return rows.column("top").to_numpy(), rows.column("n").to_numpy(), rows.column("words").to_pylist()

    return survey


def vocabulary_of(sample: DataFrame, ids: np.ndarray, most: int = 20_000) -> Callable[[np.ndarray], list[str]]:
    """The ``most`` common words over all windows of documents, those in three windows or more."""

    def words(which: np.ndarray) -> list[str]:
        wanted = set(ids[which].tolist())

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                seen: Counter = Counter()
                for i, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                    if i in wanted:
                        ws = [w for c in (text or "").lower().split() for w in words_of(c)]
                        for at in window_starts(len(ws)):
                            seen.update(set(ws[at:at + WINDOW]))
                yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())],
                                                 names=["word", "n"])

        return [r["word"] for r in sample.select("doc_id", "text").mapInArrow(run, "word string, n long")
                .groupBy("word").agg(F.sum("n").alias("n")).where("n >= 3").orderBy(F.desc("n"), "word").limit(most).collect()]

    return words


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 1500, windows_each: int = 16, seed: int = 5) -> Network | None:
    """Train on a bounded sample: ``per_class`` documents of each label, taken by the hash of their id.

    The first passes read ``windows_each`` windows of each, evenly over the whole
    text; what stands for a document after them, and what calibrates, is the
    highest-scoring of all its windows. Labels of held-out rows
    (:func:`learnable`) are never read; of several labels of an id the largest
    counts.
    """
    labels = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).where(learnable())
              .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    rate = labels.agg(F.avg("toxic")).first()[0]
    if rate is None:
        return None
    by_hash = F.xxhash64(F.col("doc_id"), F.lit(seed))
    picked = [labels.where(F.col("toxic") == k).orderBy(by_hash, "doc_id").limit(per_class) for k in (0, 1)]
    chosen = F.broadcast(picked[0].unionByName(picked[1]))  # at most 2 * per_class rows

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks, windows = [], [], []
            for i, text, toxic in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                words = [w for c in (text or "").lower().split() for w in words_of(c)]
                starts = window_starts(len(words))
                step = max(1, len(starts) / windows_each)
                for k in range(min(windows_each, len(starts))):
                    at = starts[min(len(starts) - 1, int(k * step))]
                    ids.append(i)
                    marks.append(toxic)
                    windows.append(words[at:at + WINDOW])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(marks, pa.int32()),
                                              pa.array(windows, pa.list_(pa.string()))], names=["doc", "toxic", "words"])

    whole = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
                        .join(chosen, "doc_id").select("doc_id", "text", "toxic"), "toxicity-sample")
    sample = whole.mapInArrow(cut, "doc long, toxic int, words array<string>").toArrow()
    sample = sample.sort_by([("doc", "ascending"), ("toxic", "ascending")])
    ids, doc = np.unique(sample.column("doc").to_numpy(), return_inverse=True)
    toxic = np.zeros(len(ids), dtype=np.int64)
    toxic[doc] = sample.column("toxic").to_numpy()
    windows = sample.column("words").to_pylist()
    order = sorted(range(len(windows)), key=lambda i: (doc[i], zlib.crc32(" ".join(windows[i]).encode("utf-8", "replace"))))
    return train([windows[i] for i in order], doc[order], toxic, min(0.99, max(0.01, rate)),
                 survey_of(whole, ids), vocabulary_of(whole, ids), seed)


_KEPT: dict[int, Scorer] = {}


def score(docs: DataFrame, net: Network | None, name: str = "score") -> DataFrame:
    """The columns of ``docs`` and ``name`` (0 to 1) of the whole text; a null text is an empty one.

    Without a network (no labels of both classes) every score is 0.
    """
    token = zlib.crc32(b"".join(v.tobytes() for v in net.w.values())) if net else 0
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if net and token not in _KEPT:
            _KEPT.clear()
            _KEPT[token] = Scorer(net)
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            if net:
                for first, texts in text_blocks(batch.column(at)):
                    scores[first:first + len(texts)] = _KEPT[token](texts)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score and predicted (1 from a score of 0.5 on).

    Trained on the labelled rows that are not held out. Empty and null texts get
    the score of an empty window; repeated rows are scored each; an empty table
    gives no rows; a null id is not held out.
    """
    scored = score(docs.select("doc_id", F.col("text").cast("string").alias("text")), fit(docs, labels))
    return scored.select("doc_id", F.coalesce(~learnable(), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def clean_only(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns."""
    name = unused(docs, "score")
    return score(docs, fit(docs, labels), name).where(F.col(name) < 0.5).select(*[F.col(f"`{c}`") for c in docs.columns])
