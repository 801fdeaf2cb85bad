"""Fill-in-middle frames, suffix-array dedup and phrase collocations against brute-force versions."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from loyalflow.llm import fill_middle, phrases, suffix_dedup


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


# --- fill-in-middle ---------------------------------------------------------

def brute_fim(doc_id, text, rate=100, spm=50):
    units = re.findall("[^\n]*\n|[^\n]+", text)
    d = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(d[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(units)
    lo, hi = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:lo], units[lo:hi], units[hi:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    form = "spm" if h[3] % 100 < spm else "psm"
    out = f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, form, len(p), len(m), sha(out), sha(text)


@pytest.fixture(scope="module")
def odd_lines(spark, odd_docs):
    r = random.Random(3)
    more = [(100 + i, "".join(r.choice("ab\n\r<é😀PSM> ") for _ in range(r.randint(0, 80))), "en", "x", 0, 1) for i in range(200)]
    more += [(400, "\n" * 500, "en", "x", 0, 1), (401, "a<P>b", "en", "x", 0, 1), (402, "no end of line", None, "x", 0, 1),
             (403, "one line\n", None, "x", 0, 1)]
    return odd_docs.unionByName(spark.createDataFrame(more, odd_docs.schema)).withColumnsRenamed({"score": "frames", "lang": "n"})


@pytest.mark.parametrize("frame_bytes", [1, 5, 64, 1 << 16])
def test_fill_in_middle_equals_brute_force(odd_lines, frame_bytes):
    stored = fill_middle.store(odd_lines if frame_bytes > 1 else odd_lines.where("length(text) < 200 OR text IS NULL"), frame_bytes)
    rows = odd_lines.collect()
    rows = [r for r in rows if frame_bytes > 1 or len(r.text or "") < 200]
    changed = fill_middle.transform(fill_middle.plan(stored), frame_bytes)
    assert Counter(map(tuple, fill_middle.digests(changed).collect())) == Counter(brute_fim(r.doc_id, r.text or "") for r in rows)
    back = Counter((r.doc_id, r.text) for r in fill_middle.restore(changed).collect())
    assert back == Counter((r.doc_id, r.text or "") for r in rows)


def test_rates_are_parameters(odd_lines):
    some = odd_lines.where("length(text) < 100")
    out = fill_middle.transform(fill_middle.plan(fill_middle.store(some), rate=40, spm=100))
    assert Counter(map(tuple, fill_middle.digests(out).collect())) == Counter(
        brute_fim(r.doc_id, r.text, 40, 100) for r in some.collect())


def test_a_cut_decompresses_its_own_frame_only(monkeypatch):
    text = "".join(f"line {i}\n" for i in range(5000))
    reader = fill_middle.FrameReader(fill_middle.write_frames([text.encode()], 1000))
    opened = []
    monkeypatch.setattr(reader, "data", lambda k, f=reader.data: opened.append(k) or f(k))
    assert reader.seek(2500) == (len("".join(f"line {i}\n" for i in range(2500))),) * 2
    assert len(opened) == 1
    list(reader.stream(10, 20))
    assert len(opened) == 2


def test_fill_in_middle_of_no_rows(docs):
    out = fill_middle.digests(fill_middle.transform(fill_middle.plan(fill_middle.store(docs.limit(0)))))
    assert out.count() == 0 and "restored_sha256" in out.columns


# --- suffix arrays ----------------------------------------------------------

def brute_longest_previous(data, depth):
    out = []
    for i in range(len(data) - depth + 1):
        best = 0
        for j in range(i):
            k = 0
            while k < depth and data[i + k] == data[j + k]:
                k += 1
            best = max(best, k)
        out.append(best)
    return out


def test_longest_previous_factors_equal_brute_force():
    for seed in range(60):
        r = random.Random(seed)
        depth = r.choice([1, 3, 8])
        data = bytes(r.choice([0, 97, 98, 255][:r.randint(1, 4)]) for _ in range(r.randint(depth, 150)))
        got = suffix_dedup.longest_previous(np.frombuffer(data, np.uint8), np.arange(len(data) - depth + 1), depth)
        assert got.tolist() == brute_longest_previous(data, depth)


def brute_dedup(rows, length):
    """Rows (id, text) in corpus order."""
    seen, out = set(), []
    for i, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for s in range(len(data) - length + 1):
            w = data[s:s + length]
            if w in seen:
                gone[s:s + length] = True
            seen.add(w)
        kept = bytes(b for b, g in zip(data, gone, strict=False) if not g)
        spans = int((gone[:-1] & ~np.append(False, gone[:-2])).sum()) if len(data) else 0
        out.append((i, len(data), int(gone.sum()), spans, sha(kept)))
    return Counter(out)


def corpus(seed, n=120):
    r = random.Random(seed)
    words = ["alpha", "béta", "γ", "delta\n", "x", "\x00", "the", "quick"]
    base = [" ".join(r.choice(words) for _ in range(r.randint(0, 40))) for _ in range(8)]
    rows = []
    for i in range(n):
        a, b = r.choice(base), r.choice(base)
        text = r.choice([a, a + b, a[:20] + b[5:], b[3:] + "tail" + str(i), "é" * r.randint(0, 50), "", None, str(i) * 9, a + "#" + a])
        rows.append((i * 7 - 300, text))
    return rows


@pytest.mark.parametrize(("length", "hot"), [(10, 10_000), (10, 3), (40, 10_000), (33, 5)])
def test_dedup_equals_brute_force(spark, length, hot):
    rows = corpus(length + hot)
    shuffled = rows[:]
    random.Random(1).shuffle(shuffled)
    docs = spark.createDataFrame(shuffled, "doc_id long, text string").repartition(7)
    got = Counter(map(tuple, suffix_dedup.dedup(docs, length, hot=hot).collect()))
    assert got == brute_dedup(rows, length)


def test_blocks_and_slices_change_nothing(spark, monkeypatch):
    rows = corpus(9, 60) + [(10_000, "ab" * 3000), (10_001, "abc" * 2000 + "z"), (10_002, "ba" * 500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    want = brute_dedup(rows, 20)
    assert Counter(map(tuple, suffix_dedup.dedup(docs, 20).collect())) == want
    monkeypatch.setattr(suffix_dedup, "SLICE", 64)
    texts = [(t or "").encode() for _, t in rows]
    data, ends = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts])
    small = suffix_dedup.Windows(data, ends, 20)
    monkeypatch.undo()
    whole = suffix_dedup.Windows(data, ends, 20)
    assert all((getattr(small, f) == getattr(whole, f)).all() for f in ("lo", "hi", "anchor", "key"))
    assert (whole.hi - whole.lo + 1).sum() == sum(max(0, len(t) - 19) for t in texts)


def test_dedup_of_odd_rows(spark, odd_docs, docs):
    out = suffix_dedup.dedup(odd_docs.withColumnRenamed("score", "block"), keep_bytes=True).collect()
    assert len(out) == odd_docs.count()
    by_id = {}
    for r in out:
        by_id.setdefault(r.doc_id, []).append(r)
    assert by_id[1][0].n_bytes == by_id[2][0].n_bytes == 0
    assert len(by_id[4]) == 2 and all(r.n_removed == 0 for r in by_id[4])  # too short
    assert by_id[5][0].n_removed == 99_999 and by_id[5][0].kept == b"a"  # all but the first string's first byte
    assert by_id[3][0].n_bytes - by_id[3][0].n_removed == len(by_id[3][0].kept) and by_id[3][0].n_spans == 1
    same = spark.createDataFrame([(None, "x" * 50 + "y" * 60)] * 2 + [(3, "x" * 50 + "y" * 60)] * 3, "doc_id long, text string")
    rows = suffix_dedup.dedup(same.repartition(3)).collect()
    assert sorted((r.doc_id is None, r.n_removed) for r in rows) == [(False, 0), (False, 110), (False, 110), (True, 110), (True, 110)]
    assert suffix_dedup.dedup(docs.limit(0)).count() == 0


# --- phrases ----------------------------------------------------------------

def brute_phrases(rows, least, top=2000):
    counts, total = {}, Counter()
    for lang, text in rows:
        lang = lang or "und"
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0A-\x0D]", text):
            w = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    counts[lang, tuple(w[i:i + k])] = counts.get((lang, tuple(w[i:i + k])), 0) + 1
    found = {p: a for p, a in counts.items() if len(p[1]) > 1 and a >= least}
    around = {}
    for (lang, w), a in found.items():
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                around[lang, w[i:i + m]] = max(a, around.get((lang, w[i:i + m]), 0))
    rows = []
    for (lang, w), a in found.items():
        if 100 * around.get((lang, w), 0) >= 80 * a:
            continue
        score, k, left, right = min((2_000_000 * a // (counts[lang, w[:k]] + counts[lang, w[k:]]), k, counts[lang, w[:k]],
                                     counts[lang, w[k:]]) for k in range(1, len(w)))
        rows.append((lang, -score, -a, " ".join(w).encode(), left, right))
    out, rank = [], Counter()
    for lang, score, a, phrase, left, right in sorted(rows):
        rank[lang] += 1
        if rank[lang] <= top:
            out.append((lang, rank[lang], phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def chatter(seed, n=300):
    r = random.Random(seed)
    words = ["The", "of", "é", "<x>", "ÀB", "a|b", "new", "york", "city", "in", "\xa0", "\x00", "z" * 40, "日本"]
    rows = []
    for i in range(n):
        text = "".join(r.choice(words) + r.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ", "]) for _ in range(r.randint(0, 40)))
        rows.append((r.choice(["en", "de", None, "und"]), text + r.choice(["", " new york city hall ", f" unique{i} of the "])))
    return [*rows, ("en", None), (None, ""), ("fr", " .,; \n"), ("en", "new york " * 2000)]


@pytest.mark.parametrize("sizes", [{}, {"known_rows": 0}, {"slot_words": 50, "slot_most": 40}, {"most_entries": 30, "burst": 3},
                                   {"known_rows": 0, "most_entries": 30, "burst": 2, "slot_words": 20, "slot_most": 10}])
def test_collocations_equal_brute_force(spark, sizes):
    rows = chatter(4)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    for least in (5, 30):
        out = sorted(map(tuple, phrases.collocations(docs, least=least, top=60, **sizes).collect()))
        assert out == brute_phrases(rows, least, 60) and out


def test_trie_counts_bursts_and_spills():
    r = np.random.default_rng(1)
    first, rest = r.integers(1, 5, 5000), (r.integers(1, 6, 5000) << 42) | (r.integers(0, 4, 5000) << 21) | r.integers(0, 4, 5000)
    trie = phrases.Trie(burst=10)
    for a in range(0, 5000, 700):
        trie.add(first[a:a + 700], rest[a:a + 700])
    want = Counter(zip(first.tolist(), rest.tolist(), strict=True))
    assert len(trie) == len(want) and any(isinstance(c, phrases.Node) for c in trie.children.values())
    got, spilled = {}, 0
    for keep in (len(want) // 2, 0):
        heads, rests, counts = trie.spill(keep)
        spilled += 1
        assert not set(heads.tolist()) & set(trie.children)  # whole subtrees go
        got |= {(h, x): n for h, x, n in zip(heads.tolist(), rests.tolist(), counts.tolist(), strict=True)}
    assert got == want and not trie.children


def test_collocations_of_odd_rows(spark, odd_docs, docs):
    rows = [(r.lang, r.text) for r in odd_docs.collect()]
    out = sorted(map(tuple, phrases.collocations(odd_docs.withColumnRenamed("score", "id").withColumnRenamed("source", "word")).collect()))
    assert out == brute_phrases(rows, 30)
    assert phrases.collocations(docs.limit(0)).count() == 0
