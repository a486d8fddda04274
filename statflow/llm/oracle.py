"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from statflow.llm import mixing, quality

SPACE = r"chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
WORD = r"[^\x20\x09-\x0D]+"


def _op4_documents() -> str:
    """The replicated documents with all their columns."""
    steps = int(mixing.MEAN_PER_DRAW + 12 * mixing.MEAN_PER_DRAW**0.5 + 30) + 1
    return f"""
WITH RECURSIVE docs AS MATERIALIZED (SELECT *, row_number() OVER () AS rowid_ FROM documents),
n AS (SELECT source, count(*) AS n_docs FROM docs GROUP BY source),
total AS (SELECT sum(pow(n_docs, {mixing.ALPHA})) AS w, sum(n_docs) AS n FROM n),
rates AS (SELECT source, pow(n_docs, {mixing.ALPHA}) / w * n / n_docs AS rate FROM n, total),
parts AS (SELECT source, rate, ceil(rate / {mixing.MEAN_PER_DRAW})::INT AS m FROM rates),
cdf AS (
  SELECT source, 0 AS k, exp(-(rate / m)) AS p, exp(-(rate / m)) AS c, rate / m AS mean FROM parts WHERE rate > 0
  UNION ALL
  SELECT source, k + 1, p * mean / (k + 1), c + p * mean / (k + 1), mean FROM cdf WHERE k < {steps}),
draws AS (
  SELECT rowid_, source, j, ('0x' || substr(md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, 'null') || ':' || j), 1, 13))::BIGINT / {1 << 52}.0 AS u
  FROM (SELECT d.doc_id, d.source, d.rowid_, unnest(range(1, m + 1)) AS j
        FROM docs d JOIN parts p ON d.source IS NOT DISTINCT FROM p.source)),
counted AS (
  SELECT rowid_, sum(k)::BIGINT AS n_copies FROM (
    SELECT d.rowid_, d.j, min(c.k) AS k
    FROM draws d JOIN cdf c ON d.source IS NOT DISTINCT FROM c.source AND d.u < c.c
    GROUP BY d.rowid_, d.j)
  GROUP BY rowid_)
SELECT doc_id, text, lang, source, n_chars, copy, n_copies, round(rate, 6) AS rate,
       ('0x' || substr(md5('{mixing.SEED}:shuffle:' || coalesce(doc_id::VARCHAR, 'null') || ':' || copy), 1, 15))::BIGINT AS shuffle_key
FROM (SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, c.n_copies, r.rate, unnest(range(1, c.n_copies + 1)) AS copy
      FROM docs d JOIN counted c USING (rowid_) JOIN rates r ON d.source IS NOT DISTINCT FROM r.source)
"""


def _op5() -> str:
    stop = ", ".join(sorted({f"'{w}'" for ws in quality.STOP_WORDS.values() for w in ws}))
    kept = ["NOT base_failed"]
    for r in quality.RULES:
        x = f"{r.numerator}::DOUBLE"
        if r.denominator:
            x = f"CASE WHEN {r.denominator} > 0 THEN {x} / {r.denominator} ELSE 0 END"
        kept += [f"({x}) >= {r.low}"] * (r.low is not None) + [f"({x}) <= {r.high}"] * (r.high is not None)
    return f"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM documents),
split AS (SELECT id, doc_id, text, regexp_extract_all(text, '{WORD}') AS w,
                 [l for l in string_split(text, chr(10)) if regexp_matches(l, '[^\\x20\\x09-\\x0D]')] AS lines FROM d),
words AS (SELECT id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM split),
windows AS (SELECT id, i, word, lead(word, 1) OVER o AS b, lead(word, 2) OVER o AS c FROM words WINDOW o AS (PARTITION BY id ORDER BY i)),
repeated AS (SELECT id, i FROM windows WHERE c IS NOT NULL QUALIFY count(*) OVER (PARTITION BY id, word, b, c) > 1),
covered AS (SELECT id, count(DISTINCT j) AS n FROM (SELECT id, unnest([i, i + 1, i + 2]) AS j FROM repeated) GROUP BY id),
counts AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
         length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines,
         len([x for x in w if lower(x) IN ({stop})])::BIGINT AS n_stop_words,
         len([x for x in lines if regexp_matches(ltrim(x, ' '), '^[-*•]')])::BIGINT AS n_bullet_lines,
         len([x for x in lines if regexp_matches(rtrim(x, ' '), '(\\.\\.\\.|…)$')])::BIGINT AS n_ellipsis_lines
  FROM split LEFT JOIN covered USING (id)),
base AS (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM counts)
SELECT *, ({' AND '.join(kept)}) AS kept FROM base
"""


def _op6() -> str:
    return f"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT id, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, {SPACE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
shared AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT k.*, (s.key IS NOT NULL AND k.doc_id IS DISTINCT FROM s.keeper) AS lost FROM k LEFT JOIN shared s ON k.key = s.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (lost))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
FROM marked GROUP BY id, doc_id
"""


OP1 = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::HUGEINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.n, q.vec_id AS query_id, c.vec_id,
             list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS exact
      FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.n <> c.n AND len(q.v) = len(c.v))
SELECT query_id, row_number() OVER (PARTITION BY n ORDER BY exact DESC, vec_id)::INT AS rank, vec_id, try_cast(exact AS BIGINT) AS score
FROM s QUALIFY rank <= 10
"""

OP3 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first FROM p)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN strlen(html) >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN strlen(html) >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""



# Turns with typed parts between the halves of their text: see queries.typed_parts.
OP9_PARTS = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
         conv_id::VARCHAR || '/' || turn::VARCHAR AS ref, (conv_id + turn) % 4 AS k FROM conversations),
a AS (
  SELECT *, (n % 40 + 1) * 8 AS image, CAST(ceil((n % 60) / 2.0 * 25) AS BIGINT) AS audio, n % 5 * 256 AS document,
         substr(text, 1, n // 2) || CASE k WHEN 0 THEN '' WHEN 3 THEN '<part:0><part:1>' ELSE '<part:0>' END || substr(text, n // 2 + 1) AS content
  FROM t),
b AS (
  SELECT *, CASE k WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END AS parts,
         CASE k WHEN 0 THEN 0 WHEN 1 THEN image WHEN 2 THEN document ELSE audio + document END AS tokens,
         CASE k WHEN 0 THEN '' WHEN 1 THEN 'image' || chr(9) || ref || chr(9) || image || chr(10)
                WHEN 2 THEN 'document' || chr(9) || ref || chr(9) || document || chr(10)
                ELSE 'audio' || chr(9) || ref || chr(9) || audio || chr(10) || 'document' || chr(9) || ref || chr(9) || document || chr(10) END AS listed
  FROM a)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || content || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(content)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(content, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(parts)::BIGINT AS n_attachments, sum(tokens)::BIGINT AS expanded_tokens,
       sha256(string_agg(listed, '' ORDER BY turn)) AS attachments_sha256
FROM b GROUP BY conv_id
"""


def _op11() -> str:
    # CRC-32 of the decimal text, byte by byte, over the table of the reflected polynomial.
    return f"""
WITH crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
           lambda a, b: CASE WHEN a & 1 = 1 THEN xor(3988292384, a >> 1) ELSE a >> 1 END)) AS t),
turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
hashed AS (SELECT *, sha256(length(role) || ':' || role || text) AS tid, len(regexp_extract_all(text, '{WORD}')) AS words FROM turns),
placed AS (SELECT conv_id, tid, words, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, tid[:32]) AS pos FROM hashed),
convs AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base,
         xor(4294967295, list_reduce(list_concat([4294967295], list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
             lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM turns), crc_table),
rebuilt AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY kind, pos) AS d, tid, words FROM (
    SELECT c.conv_id, 0 AS kind, p.pos, p.tid, p.words FROM convs c JOIN placed p ON p.conv_id = c.base AND p.pos <= c.h
    UNION ALL
    SELECT c.conv_id, 1, p.pos, p.tid, p.words FROM convs c JOIN placed p ON p.conv_id = c.conv_id AND p.pos > c.h)),
paths AS (
  SELECT conv_id, 0 AS d, '' AS node, '' AS parent, 0 AS words FROM convs
  UNION ALL
  SELECT conv_id, d, node, left(node, -64) AS parent, words
  FROM (SELECT conv_id, d, words, string_agg(tid, '') OVER (PARTITION BY conv_id ORDER BY d) AS node FROM rebuilt)),
lasts AS (SELECT conv_id, max(d) AS d FROM paths GROUP BY conv_id),
nodes AS (SELECT node, any_value(parent) AS parent, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words FROM paths GROUP BY node),
kids AS (SELECT parent AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY parent),
below AS (
  SELECT a.node, sum((n.n_convs - 1) * n.words) AS saved, count(*) FILTER (k.n IS NULL) AS leaves
  FROM nodes n JOIN paths a ON a.conv_id = n.conv_id AND a.d <= n.depth LEFT JOIN kids k ON k.node = n.node
  GROUP BY a.node),
ends AS (SELECT p.node, string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id) AS ids FROM paths p JOIN lasts l ON l.conv_id = p.conv_id AND l.d = p.d GROUP BY p.node)
SELECT n.conv_id, n.depth::BIGINT AS depth, CASE WHEN n.depth > 0 THEN up.conv_id END AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
       coalesce(k.n, 0)::BIGINT AS n_children, b.leaves::BIGINT AS n_leaves, b.saved::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM nodes n JOIN below b ON b.node = n.node JOIN nodes up ON up.node = n.parent
LEFT JOIN kids k ON k.node = n.node LEFT JOIN ends e ON e.node = n.node
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_topk_search": OP1, "op3_warc": OP3, "op4_source_mix": _op4_documents(), "op4_source_mix_documents": _op4_documents(), "op5_quality_rules": _op5(), "op6_line_dedup": _op6(), "op9_chat_parts": OP9_PARTS, "op11_prefix_trie": _op11()}
