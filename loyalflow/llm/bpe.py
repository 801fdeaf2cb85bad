"""Byte-level BPE as a tokenization automaton.

The merges are compiled, in order, into a deterministic automaton over tokens
that accepts exactly the token sequences BPE produces. Every merge (u, v) adds
one gadget: a new state w reached by the arc ``uv``, which leaves like the state
of v did, and the removal of the arc v behind every state that ends in u at that
moment. The states are kept factored (``right`` and ``left`` links plus the
rank of each gadget) because written out they have tokens x tokens arcs; an arc
is looked up by walking the links and is then kept in a transition table.

A word is encoded by running its bytes through the arc trie and the automaton
together: behind each prefix there is exactly one reachable state, so one pass
from left to right finds the only accepted path. Decoding emits the arc labels.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyalflow.llm.common import TextMemo, text_blocks

#: Pre-tokens of byte-level BPE (fixed by the vocabulary files); white space is the Unicode property.
PRE_TOKEN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
             r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabulary files."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    odd = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(odd)}


class HashTable:
    """Open-addressing table from int64 keys to int32 values, looked up for whole arrays."""

    def __init__(self, entries: dict[int, int]):
        size = 1 << max(4, (4 * len(entries)).bit_length())
        self.mask = size - 1
        self.keys = np.full(size, -1, dtype=np.int64)
        self.values = np.full(size, -1, dtype=np.int32)
        keys = np.fromiter(entries.keys(), dtype=np.int64, count=len(entries))
        values = np.fromiter(entries.values(), dtype=np.int32, count=len(entries))
        at = spread(keys) & self.mask
        while len(keys):
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[free]  # the last of those that meet stays
            stays = self.keys[at] == keys
            self.values[at[stays]] = values[stays]
            keys, values, at = keys[~stays], values[~stays], (at[~stays] + 1) & self.mask

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The values, -1 where there is none."""
        at = spread(keys) & self.mask
        held = self.keys[at]
        out = np.where(held == keys, self.values[at], -1)
        open_ = np.flatnonzero((held != keys) & (held >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & self.mask
            held = self.keys[at[open_]]
            hit = held == keys[open_]
            out[open_[hit]] = self.values[at[open_[hit]]]
            open_ = open_[~hit & (held >= 0)]
        return out


def spread(keys: np.ndarray) -> np.ndarray:
    x = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (x >> np.uint64(33)).astype(np.int64)


class BpeAutomaton:
    """Deterministic automaton of a byte-level BPE vocabulary (a ``tokenizers`` JSON file)."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        vocab: dict[str, int] = spec["model"]["vocab"]
        size = max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        self.label: list[bytes] = [b""] * size
        for token, i in vocab.items():
            self.label[i] = bytes(letters[c] for c in token)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for content, i in self.special.items():
            self.label[i] = content.encode()
        self.decimal = [str(i) for i in range(size)]
        self.pre_token = regex.compile(PRE_TOKEN)
        self.special_re = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None

        # one gadget per merge: the new state's links, its rank, and the arc that it removes
        self.rank = [-1] * size
        self.left, self.right = list(range(size)), list(range(size))
        self.gadget: dict[int, int] = {}
        for r, merge in enumerate(spec["model"]["merges"]):
            u, v = merge.split(" ") if isinstance(merge, str) else merge
            a, b, w = vocab[u], vocab[v], vocab[u + v]
            self.gadget[a << 20 | b] = r
            if self.rank[w] < 0:
                self.rank[w], self.left[w], self.right[w] = r, a, b

        # arc trie: node << 8 | byte -> node, and the arc that ends at a node
        self.trie: dict[int, int] = {}
        self.arc: list[int] = [-1]
        for token in vocab.values():
            if len(self.label[token]) > 1 and self.rank[token] < 0:
                continue  # no merge makes it
            node = 0
            for byte in self.label[token]:
                key = node << 8 | byte
                node = self.trie.get(key, -1)
                if node < 0:
                    node = self.trie[key] = len(self.arc)
                    self.arc.append(-1)
            self.arc[node] = token
        self.table: dict[int, bool] = {}

        # the same as arrays, for many words at once
        self.arcs = HashTable(self.trie)
        self.gadgets = HashTable(self.gadget)
        self.arc_of = np.asarray(self.arc, dtype=np.int64)
        self.size_of = np.asarray([len(x) for x in self.label], dtype=np.int64)
        self.ranks, self.lefts, self.rights = (np.asarray(x, dtype=np.int64) for x in (self.rank, self.left, self.right))
        self.pair_key = np.full(1 << 20, -1, dtype=np.int64)
        self.pair_ok = np.zeros(1 << 20, dtype=bool)

    def follows(self, a: int, b: int) -> bool:
        """Whether the state behind token ``a`` has an arc ``b``."""
        rank, gadget, last = self.rank, self.gadget, 1 << 60
        x, y, until_x, until_y = a, b, last, last
        while True:
            r = gadget.get(x << 20 | y)
            if r is not None and r < until_x and r <= until_y:
                return False
            rx, ry = rank[x], rank[y]
            if rx < 0 and ry < 0:
                return True
            if rx >= ry:
                until_x, x = rx, self.right[x]
            if ry >= rx:
                until_y, y = ry, self.left[y]

    def encode_word(self, word: bytes) -> list[int]:
        """Ids of one pre-token."""
        n = len(word)
        state, trie, arc, table = [-1] * (n + 1), self.trie, self.arc, self.table
        if len(table) > 2_000_000:  # a memo: it may be dropped at any time
            table.clear()
        for i in range(n):
            here, node = state[i], 0
            for j in range(i, n):
                node = trie.get(node << 8 | word[j], -1)
                if node < 0:
                    break
                token = arc[node]
                if token >= 0 and state[j + 1] < 0:
                    if i:
                        key = here << 20 | token
                        ok = table.get(key)
                        if ok is None:
                            ok = table[key] = self.follows(here, token)
                        if not ok:
                            continue
                    state[j + 1] = token
        ids, at = [], n
        while at:
            ids.append(state[at])
            at -= len(self.label[state[at]])
        return ids[::-1]

    def _follow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """:meth:`follows` for arrays, through the transition table (a direct-mapped memo)."""
        key = a << 20 | b
        at = spread(key) & (len(self.pair_key) - 1)
        ok = self.pair_ok[at]
        new = np.flatnonzero(self.pair_key[at] != key)
        if len(new):
            ok[new] = self._walk(a[new], b[new])
            self.pair_key[at[new]] = key[new]
            self.pair_ok[at[new]] = ok[new]
            clash = new[self.pair_key[at[new]] != key[new]]  # two new pairs met: the last key stays, with its own value
            if len(clash):
                self.pair_key[at[clash]] = -1
        return ok

    def _walk(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        ok = np.ones(len(x), dtype=bool)
        row = np.arange(len(x))
        until_x = np.full(len(x), 1 << 60, dtype=np.int64)
        until_y = until_x.copy()
        while len(row):
            r = self.gadgets.get(x << 20 | y)
            rx, ry = self.ranks[x], self.ranks[y]
            cut = (r >= 0) & (r < until_x) & (r <= until_y)
            ok[row[cut]] = False
            go_x, go_y = rx >= ry, ry >= rx
            on = ~cut & ((rx >= 0) | (ry >= 0))
            until_x, until_y = np.where(go_x, rx, until_x)[on], np.where(go_y, ry, until_y)[on]
            x, y, row = np.where(go_x, self.rights[x], x)[on], np.where(go_y, self.lefts[y], y)[on], row[on]
        return ok

    def encode_words(self, words: list[bytes], long: int = 48) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many pre-tokens, one after the other, and their number for each.

        All of them step through the tables together; those over ``long`` bytes go one by one.
        """
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        rows, tokens = [], []
        for i in np.flatnonzero(size > long).tolist():
            tokens.append(np.asarray(self.encode_word(words[i]), dtype=np.int64))
            rows.append(np.full(len(tokens[-1]), i, dtype=np.int64))
        order = np.flatnonzero(size <= long)
        order = order[np.argsort(-size[order], kind="stable")]
        if len(order):
            size = size[order]
            start = np.cumsum(size + 1) - size - 1  # one more place each: the state behind the last byte
            text = np.frombuffer(b"\0".join([words[i] for i in order.tolist()]) + b"\0", dtype=np.uint8).astype(np.int64)
            state = self._states(text, start, size)
            at, row, steps = start + size, np.arange(len(order)), []
            while len(row):
                token = state[at]
                steps.append((order[row], token))
                at = at - self.size_of[token]
                left = at > start[row]
                at, row = at[left], row[left]
            rows += [r for r, _ in reversed(steps)]
            tokens += [t for _, t in reversed(steps)]
        if not rows:
            return np.empty(0, dtype="<u4"), np.zeros(len(words), dtype=np.int64)
        row = np.concatenate(rows)
        return (np.concatenate(tokens).astype("<u4")[np.argsort(row, kind="stable")],
                np.bincount(row, minlength=len(words)))

    def _states(self, text: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The state behind each byte of words that lie in ``text``, the longest first."""
        state = np.full(len(text), -1, dtype=np.int64)
        for i in range(int(size[0])):
            n = int(np.searchsorted(-size, -i, side="left"))  # words longer than i
            to, ends = start[:n] + i, start[:n] + size[:n]
            here = state[to]
            node = np.zeros(n, dtype=np.int64)
            while len(to):
                node = self.arcs.get(node << 8 | text[to]).astype(np.int64)
                to = to + 1
                alive = node >= 0
                token = self.arc_of[node]
                hit = np.flatnonzero(alive & (token >= 0) & (state[to] < 0))
                if i and len(hit):
                    hit = hit[self._follow(here[hit], token[hit])]
                state[to[hit]] = token[hit]
                alive &= to < ends
                node, to, here, ends = node[alive], to[alive], here[alive], ends[alive]
        return state

    def encode_texts(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts; the strings of special tokens become their ids."""
        parts: list[tuple[int, str]] = []  # what lies between special tokens, and the special token behind it or -1
        ends = []
        for text in texts:
            at = 0
            if self.special_re is not None and any(s in text for s in self.special):
                for m in self.special_re.finditer(text):
                    parts.append((self.special[m[0]], text[at:m.start()]))
                    at = m.end()
            parts.append((-1, text[at:] if at else text))
            ends.append(len(parts))
        words = [self.pre_token.findall(p) for _, p in parts]
        known = dict.fromkeys(w for ws in words for w in ws)
        ids, count = self.encode_words([w.encode() for w in known])
        stop = np.cumsum(count)
        data = ids.tobytes()
        for w, lo, hi in zip(list(known), ((stop - count) * 4).tolist(), (stop * 4).tolist(), strict=True):
            known[w] = data[lo:hi]
        out, lo = [], 0
        for hi in ends:
            out.append(b"".join([x for (special, _), ws in zip(parts[lo:hi], words[lo:hi], strict=True)
                                 for x in [*map(known.__getitem__, ws),
                                           special.to_bytes(4, "little") if special >= 0 else b""]]))
            lo = hi
        return out

    def encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """As :meth:`encode_texts` for texts that are each a blank and then no blank at either end: split in one go."""
        plain = [c for c in chunks if not any(s in c for s in self.special)]
        if len(plain) < len(chunks) or not chunks:
            found = dict(zip(plain, self.encode_chunks(plain), strict=True)) if plain else {}
            odd = [c for c in chunks if c not in found]
            found.update(zip(odd, self.encode_texts(odd), strict=True))
            return [found[c] for c in chunks]
        words = self.pre_token.findall("".join(chunks))
        known = dict.fromkeys(words)
        ids, count = self.encode_words([w.encode() for w in known])
        known.update(zip(known, range(len(known)), strict=True))
        row = np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))
        number = count[row]
        first = np.repeat((np.cumsum(count) - count)[row], number)
        ids = ids[first + np.arange(len(first)) - np.repeat(np.cumsum(number) - number, number)]
        char_end = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)))
        chunk_end = np.cumsum(np.fromiter(map(len, chunks), dtype=np.int64, count=len(chunks)))
        stop = 4 * np.cumsum(number)[np.searchsorted(char_end, chunk_end)]
        data, ends = ids.tobytes(), stop.tolist()
        return [data[lo:hi] for lo, hi in zip([0, *ends], ends, strict=False)]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.label.__getitem__, ids)).decode("utf-8", errors="replace")


_KEPT: dict[str, tuple[BpeAutomaton, TextMemo]] = {}


def automaton(path: str | None) -> tuple[BpeAutomaton, TextMemo]:
    """The compiled automaton of a vocabulary file, kept for the life of a Python worker."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    if path not in _KEPT:
        a = BpeAutomaton(path)
        _KEPT[path] = a, TextMemo(a.encode_texts, a.encode_chunks)
    return _KEPT[path]


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """One row per document: id, ``ids`` (array<int>) and ``decoded`` (the text made from the ids).

    Null and empty texts have no ids and decode to the empty text; repeated rows
    are encoded each; other columns are not read. ``vocabulary``: path of the
    file on every machine (by default that of the installed vocabulary package).
    """
    return _map(docs, id_col, text_col, vocabulary, digest=False)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """As :func:`encode`, with the number of ids and SHA-256 digests in place of ids and text."""
    return _map(docs, id_col, text_col, vocabulary, digest=True)


def _map(docs: DataFrame, id_col: str, text_col: str, vocabulary: str | None, digest: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256

        auto, memo = automaton(vocabulary)
        for batch in batches:
            cols: list[list] = [[], [], []]
            for _, texts in text_blocks(batch.column(1)):
                for data in memo.encode(texts):
                    ids = np.frombuffer(data, dtype="<u4").tolist()
                    decoded = auto.decode(ids)
                    if digest:
                        row = (len(ids), sha256(",".join(map(auto.decimal.__getitem__, ids)).encode()).hexdigest(),
                               sha256(decoded.encode()).hexdigest())
                    else:
                        row = (len(ids), ids, decoded)
                    for col, x in zip(cols, row, strict=True):
                        col.append(x)
            kind = pa.string() if digest else pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], kind), pa.array(cols[2], pa.string())],
                names=[id_col, "n_tokens", "ids_sha256" if digest else "ids", "decoded_sha256" if digest else "decoded"])

    kind = docs.schema[id_col].dataType.simpleString()
    rest = "ids_sha256 string, decoded_sha256 string" if digest else "ids array<int>, decoded string"
    return (docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
            .mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, {rest}"))
