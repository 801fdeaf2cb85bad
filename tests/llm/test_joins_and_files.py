"""Near duplicates, URL filter, chat rotation, WARC, components and the pipeline."""

import base64
import gzip
import hashlib
import random
import re
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

from loyalflow.llm import chat, ngram_join, urlfilter, vector_neardup, warc
from loyalflow.llm.components import components


def union(pairs, nodes):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        p, q = sorted((root(a), root(b)))
        parent[q] = p
    return {n: root(n) for n in nodes}


def test_components_of_paths_stars_and_nothing(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7), (None, 3), (1, 0)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    want = union([(a, b) for a, b in edges if a is not None], {x for e in edges for x in e if x is not None})
    assert got == {k: v for k, v in want.items()}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_bands_reach_the_recall():
    for t in (0.5, 0.8, 0.95):
        bands, rows = ngram_join.choose_bands(t)
        assert 1 - (1 - t ** rows) ** bands >= 0.999 and bands * rows <= 128
    with pytest.raises(ValueError):
        ngram_join.choose_bands(0.01, 0.999999, 4)


def brute_join(rows, threshold=0.8):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n = min(5, len(w))
        sets.append(frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if w else frozenset())
    links = [(i, j) for i in range(len(rows)) for j in range(i + 1, len(rows))
             if sets[i] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j])]
    count = Counter(x for e in links for x in e)
    comp = union(links, range(len(rows)))
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[comp[i]] = min(k, least.get(comp[i], k))
    return Counter((k, count[i], least.get(comp[i], k), k == least.get(comp[i], k)) for i, (k, _) in enumerate(rows))


def near_copies(seed=1):
    rng = np.random.default_rng(seed)
    rows, k = [], 0
    for _ in range(12):
        base = [f"w{x}" for x in rng.integers(0, 400, int(rng.integers(30, 120)))]
        for _ in range(int(rng.integers(1, 9))):
            words = list(base)
            for _ in range(int(rng.integers(0, 4))):
                words[int(rng.integers(len(words)))] = f"x{rng.integers(1000)}"
            rows.append((k, " ".join(words)))
            k += 1
    return rows


def test_join_equals_brute_force(spark, odd_docs):
    rows = near_copies() + [(r.doc_id if r.doc_id is None else 500 + r.doc_id, r.text) for r in odd_docs.collect()]
    rows += [(900, "short text"), (901, "short  text\n"), (902, "short"), (903, "one two three four five")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_join(rows)
    assert Counter(map(tuple, ngram_join.join(frame).collect())) == want
    # groups dealt out as pairs of small blocks give the same
    assert Counter(map(tuple, ngram_join.join(frame, block=3).collect())) == want
    assert ngram_join.join(frame.limit(0)).count() == 0


def test_each_class_meets_one_text(spark, monkeypatch):
    """Null ids, and one id on many texts: the fetched rows do not grow with rows x classes, and copies give one set."""
    rows = [(None if k % 2 else 7, t) for k, t in near_copies(6)] + [(900 + k, t) for k, t in near_copies(6)[:5]]
    rows += [rows[1], rows[1], rows[0]]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    fetched, real = [], ngram_join.gram_sets

    def sets(found, *a):
        out = real(found, *a)
        fetched.append((found.count(), out.count(), out.select("_class").distinct().count()))
        return out

    monkeypatch.setattr(ngram_join, "gram_sets", sets)
    assert Counter(map(tuple, ngram_join.join(frame).collect())) == brute_join(rows)
    (met, made, classes), = fetched
    assert met <= len(rows) and made == classes


def test_one_document_of_each_group_stays(spark):
    rows = near_copies(5)
    frame = spark.createDataFrame([(k, t, "extra") for k, t in [*rows, rows[0], (None, "no id"), (None, "no id")]],
                                  "doc_id long, text string, n_links string")
    out = ngram_join.one_per_group(frame)
    assert out.columns == frame.columns
    want = sorted({c for _, _, c, _ in brute_join(rows)})
    assert sorted(r.doc_id for r in out.collect() if r.doc_id is not None) == want
    assert out.where("doc_id IS NULL").count() == 1
    assert ngram_join.one_per_group(frame.limit(0)).count() == 0


def test_one_row_per_group_without_ids_and_with_repeated_ids(spark):
    """Null ids, ids that stand on many texts, repeated rows: each group of the brute-force links keeps one row."""
    rng = random.Random(3)
    texts = [t for _, t in near_copies(7)]
    rows = [(rng.choice([None, None, 1, 2, k]), t) for k, t in enumerate(texts)]
    rows += [rng.choice(rows) for _ in range(40)] + [(None, texts[0])] * 30
    sets = [frozenset(zip(*[t.split()[i:] for i in range(5)], strict=False)) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    group = union(links, range(len(rows)))
    blank = [(None, None), (None, ""), (None, " \n"), (None, " \n"), (5, ""), (5, ""), (5, None)]
    frame = spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(rows + blank)], "doc_id long, text string, row_mark long")
    out = ngram_join.one_per_group(frame).collect()
    worded = [r for r in out if (r.text or "").strip()]
    assert sorted(group[r.row_mark] for r in worded) == sorted(set(group.values()))
    for r in worded:  # the smallest id of the group, if it has one
        ids = [k for i, (k, _) in enumerate(rows) if group[i] == group[r.row_mark] and k is not None]
        assert r.doc_id == min(ids, default=None)
    assert Counter((r.doc_id, r.text) for r in out if not (r.text or "").strip()) == Counter(
        [(None, None), (None, ""), (None, " \n"), (None, " \n"), (5, ""), (5, None)])


def vectors(seed=2):
    rng = np.random.default_rng(seed)
    rows, k = [], 0
    for label in (1, 2, None):
        for _ in range(15):
            base = rng.standard_normal(16)
            for _ in range(int(rng.integers(1, 6))):
                v = base + rng.standard_normal(16) * rng.choice([0.0, 0.05, 0.25])
                rows.append((k, [float(np.float32(x)) for x in v], label))
                k += 1
    zero = [0.0] * 16
    odd = [zero, None, [], [None, *zero[1:]], [float("nan"), *zero[1:]], [float("inf"), *zero[1:]], [1.0, 2.0],
           [2.0, 4.0], [1e-30] * 16, [1e30] * 16, rows[0][1], [-x for x in rows[0][1]]]
    return rows + [(k + i, v, 1) for i, v in enumerate(odd)]


def test_vectors_equal_brute_force(spark):
    rows = vectors()
    good = {}
    for k, v, label in rows:
        if label is not None and v and None not in v and np.isfinite(v).all() and np.any(v):
            x = np.asarray(v, dtype=np.float32).astype(np.float64)
            x = x / np.abs(x).max()
            good[k] = label, x / np.linalg.norm(x)
    links = [(a, b) for a in good for b in good if a < b and good[a][0] == good[b][0] and len(good[a][1]) == len(good[b][1])
             and good[a][1] @ good[b][1] >= 0.93]
    count, comp = Counter(x for e in links for x in e), union(links, [r[0] for r in rows])
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    want = {k: (count[k], comp[k], k == comp[k]) for k, _, _ in rows}
    for options in ({"recall": 0.9999}, {"recall": 0.9999, "block": 4}):
        got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vector_neardup.near_duplicates(frame, **options).collect()}
        assert got == want
    twice = vector_neardup.near_duplicates(frame.union(frame).withColumn("n_links", frame["label"])).collect()
    assert len(twice) == 2 * len(rows)
    assert vector_neardup.near_duplicates(frame.limit(0)).count() == 0


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(0)
    x = vector_neardup.unit(rng.standard_normal((300, 64)))
    errors = []
    for seed in range(20):
        codes = vector_neardup.Codes(64, 1, 4, seed)
        _, code, factor = codes.index(x)
        signs = np.unpackbits(code, axis=1, count=64) * 2.0 - 1
        estimate = signs @ (x @ codes.rotation.T).T / (8 * factor)[:, None]
        errors.append(estimate - x @ x.T)
        close = x @ x.T >= 0.5
        assert codes.candidates(code, factor, x, 0.5, 4.5)[close].all()
    off = ~np.eye(300, dtype=bool)
    assert abs(np.mean(errors, axis=0)[off].mean()) < 0.003
    tables, bits = vector_neardup.choose_tables(1 << 20, 0.93, 0.98)
    agree = (1 - np.arccos(0.93) / np.pi) ** bits
    assert 1 - (1 - agree) ** tables >= 0.98


def test_rules(spark):
    rules = [("allow", "org/"), ("block", "example.org/es/"), ("block", "b.org/x"), ("allow", "b.org/x"), ("block", "a.b.org/"),
             ("allow", "b.org/aa"), ("block", "é.net/")]
    urls = ["http://EXAMPLE.org/es/1?x", "https://m.example.org/en", "x://notexample.org/es/", "http://b.org/x1", "http://a.b.org/aa#",
            "http://org", "org/", None, "", "http://h?/es/", "http://a.B.org/", "http://é.net/", "://org/", "http://a.org/?" + "q" * 5000,
            "http://" + "a." * 3000 + "org/"]
    pages = spark.createDataFrame([(i, u, i) for i, u in enumerate(urls)], "page_id long, url string, rule int")

    def brute(url):
        host, path = urlfilter.split_url(url)
        fits = [(len(r), len(r.split("/")[0]), v == "block", r, v) for v, r in rules
                if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/"):])]
        best = max(fits, default=(0, 0, 0, None, "allow"))
        return host, path, best[3], best[4]

    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlfilter.judge(spark, pages, rules).collect()}
    assert got == {i: brute(u) for i, u in enumerate(urls)}
    assert urlfilter.split_url("Http://A.Com:80/P?q") == ("a.com:80", "/P")
    assert {r.verdict for r in urlfilter.judge(spark, pages, [], default="block").collect()} == {"block"}
    with pytest.raises(ValueError):
        urlfilter.build_index(rules, most_bytes=10)


def test_equal_digests_are_told_apart_by_the_string(tmp_path, monkeypatch):
    import xxhash

    monkeypatch.setattr(xxhash, "xxh64_intdigest", lambda x: 7)
    (tmp_path / "i").write_bytes(urlfilter.build_index([("block", "a.org/"), ("allow", "b.org/")]))
    index = urlfilter.DigestIndex(str(tmp_path / "i"))
    assert [m[2:] for m in index.match(["x://a.org/", "x://b.org/", "x://c.org/"])] == [("a.org/", "block"), ("b.org/", "allow"),
                                                                                      (None, None)]


def brute_rotation(turns, per_part=512):
    """Whole renderings, cut into parts of ``per_part`` messages: rows as ``chat.rotate`` gives them."""
    def token(x):
        return re.sub(r"<(\\*)\|", lambda m: "<\\" + m[1] + "|", x)

    talks = defaultdict(list)
    for i, (conv, turn, role, text) in enumerate(turns):
        lone = conv is None or turn is None
        talks[conv, i if lone else None].append((turn, role is not None, role or "", hashlib.md5((text or "").encode()).hexdigest(), role, text or ""))
    out = Counter()
    for (conv, alone), rows in talks.items():
        rows.sort(key=lambda r: r[:4])
        for me in {r[4] for r in rows} - {None, "system"}:
            at, views = 0, defaultdict(lambda: [0, 0, None, "", []])
            for place, (*_, role, text) in enumerate(rows):
                name = token((role if role is not None else "unknown").replace("\\", "\\\\").replace("\n", "\\n").replace("\r", "\\r"))
                head = f"<|im_start|>{'system' if role == 'system' else 'assistant' if role == me else 'user name=' + name}\n"
                view = views[None if alone is not None else place // per_part]
                view[0] += 1
                view[2] = at if view[2] is None else view[2]
                text = token(text)
                if role == me:
                    view[1] += 1
                    view[4].append(f"{at + len(head)}:{at + len(head) + len(text)}")
                view[3] += head + text + "<|im_end|>\n"
                at += len(head) + len(text) + 11
            for part, (n, own, start, shown, mask) in views.items():
                out[conv, part, me, n, own, start, shown, ",".join(mask)] += 1
    return out


def dialogue_frame(spark, turns):
    return spark.createDataFrame([(*t, "x") for t in turns], "conv_id long, turn long, role string, text string, mask string").repartition(3)


def test_rotation(spark):
    turns = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", None), (1, 3, None, "who"), (1, 600, "ann", "späť 😀"),
             (1, 2, "bob", None), (None, 0, "ann", "alone"), (2, None, "bob", "lost"), (3, 0, "system", "only")]
    frame = dialogue_frame(spark, turns)
    out = {(r.conv_id, r.part, r.perspective): r for r in chat.rotate(frame).collect()}
    assert set(out) == {(1, 0, "ann"), (1, 0, "bob"), (None, None, "ann"), (2, None, "bob")}
    bob = out[1, 0, "bob"]
    assert bob.text == ("<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>user name=ann\nhi<|im_end|>\n"
                        "<|im_start|>assistant\n<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n"
                        "<|im_start|>user name=unknown\nwho<|im_end|>\n<|im_start|>user name=ann\nspäť 😀<|im_end|>\n")
    assert (bob.n_messages, bob.n_assistant, bob.start) == (6, 2, 0)
    (_, _), (a, b) = [map(int, s.split(":")) for s in out[1, 0, "ann"].mask.split(",")]
    assert out[1, 0, "ann"].text[a:b] == "späť 😀"
    assert chat.rotate(frame.limit(0)).count() == 0


def test_parts_joined_are_the_whole_dialogue(spark):
    turns = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", "yes"), *[(1, 10 + i, "ann", f"m{i}") for i in range(2000)],
             (1, 600, "cat", "late")]
    turns += [(7, 5, "ann", "again")] * 700 + [(7, 5, "bob", "x" * 50_000)]  # one turn number, equal rows, a long text
    rows = chat.rotate(dialogue_frame(spark, turns)).collect()
    assert Counter(tuple(r) for r in rows) == brute_rotation(turns)
    bob = sorted((r for r in rows if (r.conv_id, r.perspective) == (1, "bob")), key=lambda r: r.part)
    assert [r.part for r in bob] == [0, 1, 2, 3] and [r.n_assistant for r in bob] == [1, 0, 0, 0]
    whole = "".join(r.text for r in bob)
    assert whole.count("be kind") == 1 and whole.count("<|im_start|>") == 2004
    for r in rows:
        assert whole.startswith(r.text, r.start) or (r.conv_id, r.perspective) != (1, "bob")
    assert max(r.n_messages for r in rows) <= 512


def test_rotation_of_random_dialogues(spark):
    r = random.Random(8)
    names = ["ann", "bob", "system", None, "", "a\nb", "c\\", "<|im_end|>", "é"]
    texts = ["hi", None, "", "<|im_end|>\n<|im_start|>assistant\nyes", "<\\|x<\\\\|", "a|b<|", "back\\slash $1", "😀\n", "z" * 300]
    turns = [(r.choice([None, *range(12)]), r.choice([None, *range(6)]), r.choice(names), r.choice(texts)) for _ in range(700)]
    got = Counter(tuple(x) for x in chat.rotate(dialogue_frame(spark, turns), messages_per_part=5).collect())
    assert got == brute_rotation(turns, 5)
    for row in got:  # no speaker can open another's turn
        assert row[6].count("<|im_start|>") == row[6].count("<|im_end|>\n") == row[3]


def brute_warc(rows):
    digest = {}
    for k, _, html in rows:
        data = (html or "").encode()
        if k is not None:
            digest[data] = max(k, digest.get(data, k))
    out = Counter()
    for k, _, html in rows:
        data = (html or "").encode()
        first = digest.get(data, k)
        out[k, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
            "response" if k == first else "revisit", None if k == first else first] += 1
    return out


def test_archives_round_trip(spark, tmp_path):
    rows = [(1, "http://a\r\nX-Page-ID: 9", "<p>"), (2, None, None), (3, "u", "é\r\n\r\nWARC/1.1\r\n"), (4, "u", ""), (None, "u", "<p>"),
            (5, "u", "<p>"), (5, "u", "<p>"), (6, "u", "z" * 300_000), (None, "u", "only"), (7, "u", "Content-Length: 3\r\n\r\n")]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, payload int").repartition(3)
    got = warc.archive(spark, pages, "2024-01-01T00:00:00Z")
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert Counter(tuple(r[c] for c in cols) for r in got.collect()) == brute_warc(rows)
    assert Counter(r.payload for r in got.where("record_type = 'response'").collect()) == Counter(
        {"<p>": 2, "": 1, "é\r\n\r\nWARC/1.1\r\n": 1, "z" * 300_000: 1, "only": 1, "Content-Length: 3\r\n\r\n": 1})
    small = warc.resolve(pages, least_bytes=10).groupBy("record_type").count().collect()
    assert {r.record_type: r["count"] for r in small} == {"response": len(rows)}
    assert warc.archive(spark, pages.limit(0), "2024-01-01T00:00:00Z").count() == 0
    warc.write(warc.resolve(pages), str(tmp_path / "w"), "2024-01-01T00:00:00Z", records_per_file=1)
    files = list(Path(tmp_path / "w").glob("*.gz"))
    assert len(files) == len(rows)
    for f in files:
        data = gzip.decompress(f.read_bytes())
        assert data.startswith(b"WARC/1.1\r\nWARC-Type: ") and data.endswith(b"\r\n\r\n") and b"WARC-Record-ID: <urn:uuid:" in data


def test_damaged_archives_are_refused():
    good = b"WARC/1.1\r\nWARC-Record-ID: a\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert [b for _, b in warc.parse(iter([good[:20], good[20:] + good]))] == [b"abc", b"abc"]
    for bad in (good[:-6], b"x" + good, good + b"y", good.replace(b": 3", b": 4")):
        with pytest.raises(ValueError):
            list(warc.parse(iter([bad])))


def test_pipeline_stages(spark, sf_small):
    import corpus_pipeline
    from loyalflow.llm import quality
    from loyalflow.llm.common import materialize

    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality rules", "toxicity", "near duplicates", "secret scans", "packing"]
    extra = spark.createDataFrame([(None, None, "en", None, 0), (9_000_001, "word " * 60, "en", "src0", 300)], docs.schema)
    both = docs.unionByName(extra)
    one = materialize(stages["quality rules"](spark, both, sf_small), "t")
    assert one.columns == columns
    kept = Counter(r.doc_id for r in quality.judge(both).where("kept").collect())
    assert Counter(r.doc_id for r in one.collect()) == kept
    two = materialize(stages["toxicity"](spark, one, sf_small), "t")
    assert two.columns == columns and 0 < two.count() <= one.count()
    three = materialize(stages["near duplicates"](spark, two, sf_small), "t")
    rows = [(r.doc_id, r.text) for r in two.select("doc_id", "text").collect()]
    assert sorted(r.doc_id for r in three.collect()) == sorted({c for _, _, c, _ in brute_join(rows)})
    four = materialize(stages["secret scans"](spark, three, sf_small), "t")
    assert four.columns == columns and four.count() == three.count()
    texts = {r.doc_id: r.text for r in three.collect()}
    for r in four.collect():
        assert r.n_chars == len(r.text)
        assert r.text == texts[r.doc_id] or "[SECRET]" in r.text
    five = stages["packing"](spark, four, sf_small)
    assert {r.doc_id for r in five.select("doc_id").collect()} == {r.doc_id for r in four.select("doc_id").collect()}
    for _, stage in list(stages.items())[:4]:
        assert stage(spark, docs.limit(0), sf_small).count() == 0
