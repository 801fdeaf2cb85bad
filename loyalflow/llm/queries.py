"""The operators as registered queries over whole tables, with their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loyalflow.llm import (bpe, chat, fill_middle, ngram_join, packing, phrases, quality, secret_scan, suffix_dedup,
                           toxicity, urlfilter, vector_neardup, warc)
from loyalflow.llm.common import materialize, ship, table

#: Fixed rules of the URL filter's query.
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
         ("block", "com/de/")]


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return packing.pack(materialize(packing.pieces(table(spark, sf_dir, "documents")), "pieces"))


def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    return secret_scan.summary(docs, secret_scan.fit(docs))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return urlfilter.judge(spark, table(spark, sf_dir, "pages"), RULES)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(table(spark, sf_dir, "conversations"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return bpe.digests(table(spark, sf_dir, "documents"))


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return vector_neardup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return ngram_join.join(table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return warc.archive(spark, table(spark, sf_dir, "pages"), date="2024-01-01T00:00:00Z").drop("payload")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    frames = materialize(fill_middle.store(table(spark, sf_dir, "documents")), "frames")
    return fill_middle.digests(fill_middle.transform(fill_middle.plan(frames)))


def op12_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return suffix_dedup.dedup(table(spark, sf_dir, "documents"))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return phrases.collocations(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_best_fit_packing, op2_secret_scans, op3_url_filters, op4_toxicity, op5_quality_rules,
                            op6_chat_formatting, op7_bpe, op8_embedding_near_dedup, op9_ngram_jaccard_join, op10_warc,
                            op11_fill_in_middle, op12_suffix_array_dedup, op13_phrase_collocations, pipeline)}

# The rules are written out here, apart from RULES, so that a slip in either shows.
OP3_SQL = r"""
WITH u AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), s AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM u
), r(verdict, rule, host, path) AS (
  VALUES ('allow', 'org/', 'org', '/'), ('block', 'example.org/es/', 'example.org', '/es/'),
         ('block', 'example.org/en/1', 'example.org', '/en/1'), ('allow', 'com/fr/', 'com', '/fr/'),
         ('block', 'com/de/', 'com', '/de/')
), f AS (
  SELECT s.page_id, s.host, s.path, r.rule, coalesce(r.verdict, 'allow') AS verdict,
         row_number() OVER (PARTITION BY s.page_id ORDER BY length(r.rule) DESC NULLS LAST) AS n
  FROM s LEFT JOIN r ON (s.host = r.host OR ends_with(s.host, '.' || r.host)) AND starts_with(s.path, r.path)
)
SELECT page_id, host, path, rule, verdict FROM f WHERE n = 1
"""

OP5_SQL = r"""
WITH w AS (
  SELECT row_number() OVER () AS row, doc_id, source, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), win AS (
  SELECT row, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c
  FROM (SELECT row, words, unnest(range(1, len(words) - 1)) AS i FROM w)
), again AS (
  SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, a, b, c) AS n FROM win) WHERE n > 1
), rep AS (
  SELECT row, count(DISTINCT i + k) AS n FROM again, (VALUES (0), (1), (2)) o(k) GROUP BY row
), m AS (
  SELECT w.doc_id, w.source, len(w.words)::BIGINT AS n_words, coalesce(list_sum(list_transform(w.words, lambda x: length(x))), 0)::BIGINT AS word_chars,
         (length(w.text) - length(regexp_replace(w.text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(w.lines) - len(list_distinct(w.lines)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN rep USING (row)
), j AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
h AS (SELECT source, count(*) AS host_docs, sum(base_failed::INT)::BIGINT AS host_failed FROM j WHERE source IS NOT NULL GROUP BY source),
t AS (SELECT sum(host_docs)::DOUBLE AS n, sum(host_failed)::DOUBLE AS f, count(*)::DOUBLE AS k,
             sum(host_docs * (host_failed / host_docs) * (host_failed / host_docs)) AS q FROM h),
p AS (SELECT f / n AS mean, (f / n) * (1 - f / n) AS spread,
             q / n - (f / n) * (f / n) - (f / n) * (1 - f / n) * k / n AS between_hosts FROM t),
p2 AS (SELECT mean, CASE WHEN between_hosts > spread / 1000 THEN greatest(0.01, spread / between_hosts - 1) ELSE 1000.0 END AS weight FROM p),
v AS (SELECT source, host_docs, host_failed, weight, (host_failed + mean * weight) / (host_docs + weight) AS rate FROM h, p2)
SELECT j.doc_id, j.n_words, j.word_chars, j.n_symbols, j.n_dup_lines, j.n_repeat_words, j.base_failed,
       v.host_docs, v.host_failed, v.rate AS host_rate,
       coalesce(v.rate - 3.0 * sqrt(v.rate * (1 - v.rate) / (v.host_docs + v.weight + 1)) > 0.5, false) AS host_rejected,
       NOT j.base_failed AND NOT host_rejected AS kept
FROM j LEFT JOIN v USING (source)
"""

OP6_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS raw, regexp_replace(coalesce(text, ''), '<(\\*)\|', '<\\\1|', 'g') AS text,
         regexp_replace(replace(replace(replace(coalesce(role, 'unknown'), '\', '\\'), chr(10), '\n'), chr(13), '\r'),
                        '<(\\*)\|', '<\\\1|', 'g') AS name,
         CASE WHEN conv_id IS NULL OR turn IS NULL THEN row_number() OVER () END AS alone FROM conversations
), m AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, alone ORDER BY turn, role NULLS FIRST, md5(raw)) - 1 AS place FROM t
), who AS (SELECT DISTINCT conv_id, alone, role AS perspective FROM m WHERE role <> 'system'),
shown AS (
  SELECT m.conv_id, m.alone, place, perspective, text, coalesce(role = perspective, false) AS mine,
         CASE WHEN role = 'system' THEN '<|im_start|>system' || chr(10)
              WHEN role = perspective THEN '<|im_start|>assistant' || chr(10)
              ELSE '<|im_start|>user name=' || name || chr(10) END AS head
  FROM who JOIN m ON m.conv_id IS NOT DISTINCT FROM who.conv_id AND m.alone IS NOT DISTINCT FROM who.alone
), placed AS (
  SELECT *, CASE WHEN alone IS NULL THEN place // 512 END AS part,
         coalesce(sum(length(head) + length(text) + 11) OVER (PARTITION BY conv_id, alone, perspective ORDER BY place
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos
  FROM shown
)
SELECT conv_id, part, perspective, count(*) AS n_messages, count(*) FILTER (mine) AS n_assistant, min(pos)::BIGINT AS start,
       string_agg(head || text || '<|im_end|>' || chr(10), '' ORDER BY place) AS text,
       coalesce(string_agg((pos + length(head))::BIGINT || ':' || (pos + length(head) + length(text))::BIGINT, ',' ORDER BY place) FILTER (mine), '') AS mask
FROM placed GROUP BY conv_id, alone, part, perspective
"""

_DIGITS = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(sha, {1 + 5 * k}, 5))::BIGINT >> {s}) & 31)::INT, 1)"
    for k in range(8) for s in (15, 10, 5, 0))

OP8_SQL = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
    ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.93
), r AS (SELECT vec_id AS a, vec_id AS root FROM embeddings UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.a),
c AS (SELECT a AS vec_id, min(root) AS component_id FROM r GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM l GROUP BY a)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM c LEFT JOIN n USING (vec_id)
"""

OP9_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents
), g AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS gram
  FROM (SELECT doc_id, words, unnest(range(1, greatest(2, len(words) - 3))) AS i FROM w WHERE len(words) > 0)
), s AS (SELECT doc_id, count(*) AS size FROM g GROUP BY doc_id),
p AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM g x JOIN g y ON x.gram = y.gram AND x.doc_id < y.doc_id GROUP BY ALL
), l AS (
  SELECT a, b FROM p JOIN s sa ON sa.doc_id = a JOIN s sb ON sb.doc_id = b WHERE common >= 0.8 * (sa.size + sb.size - common) - 1e-9
), e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS root FROM documents UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.a),
c AS (SELECT a AS doc_id, min(root) AS component_id FROM r GROUP BY a),
n AS (SELECT a AS doc_id, count(*) AS n_links FROM e GROUP BY a)
SELECT doc_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, doc_id = component_id AS kept
FROM c LEFT JOIN n USING (doc_id)
"""

OP10_SQL = f"""
WITH d AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS sha FROM pages
), o AS (SELECT *, {_DIGITS} AS payload_digest, max(page_id) OVER (PARTITION BY sha) AS original FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> original THEN original END AS refers_to
FROM o
"""

OP11_SQL = r"""
WITH u AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units,
         sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS d FROM documents
), h AS (
  SELECT *, len(units) AS n, [('0x' || substr(d, 1 + 8 * k, 8))::BIGINT for k in range(4)] AS h FROM u
), c AS (
  SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS lo, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS hi,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 100 THEN 'plain'
              WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM h
), p AS (
  SELECT *, array_to_string(units[1:lo], '') AS prefix, array_to_string(units[lo + 1:hi], '') AS middle,
         array_to_string(units[hi + 1:], '') AS suffix FROM c
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""

OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT row, doc_id, i, substr(h, 2 * i + 1, 200) AS s
      FROM (SELECT row, doc_id, h, unnest(range(0, length(h) // 2 - 99)) AS i FROM d WHERE length(h) >= 200)),
late AS (SELECT row, i FROM (SELECT row, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, row, i) AS n FROM w) WHERE n > 1),
runs AS (
  SELECT row, min(i) AS a, max(i) + 100 AS b
  FROM (SELECT row, i, sum(new) OVER (PARTITION BY row ORDER BY i) AS run
        FROM (SELECT row, i, (i > coalesce(lag(i) OVER (PARTITION BY row ORDER BY i), -1000) + 100)::INT AS new FROM late))
  GROUP BY row, run
), kept AS (
  SELECT row, count(*) AS n_spans, sum(b - a) AS n_removed, string_agg(before, '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS h
  FROM (SELECT row, a, b, h, substr(h, 2 * coalesce(lag(b) OVER w, 0) + 1, 2 * (a - coalesce(lag(b) OVER w, 0))) AS before
        FROM runs JOIN d USING (row) WINDOW w AS (PARTITION BY row ORDER BY a))
  GROUP BY row
)
SELECT doc_id, (length(d.h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256
FROM d LEFT JOIN kept USING (row)
"""

OP13_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
g AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (VALUES (1), (2), (3), (4)) t(k)) GROUP BY ALL
), t AS (SELECT lang, sum(f)::BIGINT AS n FROM g WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, phrase, k, string_split(phrase, ' ') AS w, f AS a FROM g WHERE k > 1 AND f >= 30),
cuts AS (
  SELECT c.lang, c.phrase, c.a, j, l.f AS l, r.f AS r, ((2000000::HUGEINT * c.a) // (l.f + r.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c
  JOIN g l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:j], ' ')
  JOIN g r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[j + 1:], ' ')
), best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
around AS (
  SELECT lang, array_to_string(w[s:s + m - 1], ' ') AS phrase, max(a) AS most
  FROM (SELECT lang, w, a, m, unnest(range(1, k - m + 2)) AS s FROM c, (VALUES (2), (3)) t(m) WHERE m < k) GROUP BY ALL
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best LEFT JOIN around USING (lang, phrase) JOIN t USING (lang)
WHERE most IS NULL OR 100::HUGEINT * most < 80::HUGEINT * a
QUALIFY rank <= 2000
"""

ORACLE_SQL: dict[str, str] = {
    "op3_url_filters": OP3_SQL, "op5_quality_rules": OP5_SQL, "op6_chat_formatting": OP6_SQL,
    "op8_embedding_near_dedup": OP8_SQL, "op9_ngram_jaccard_join": OP9_SQL, "op10_warc": OP10_SQL,
    "op11_fill_in_middle": OP11_SQL, "op12_suffix_array_dedup": OP12_SQL, "op13_phrase_collocations": OP13_SQL}
