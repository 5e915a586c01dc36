"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

_WS = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_WORD = r"'[^\x20\x09-\x0D]+'"

_BITS = " | ".join(f"(CASE WHEN embedding[{i + 1}] > 0 THEN CAST({1 << i} AS UBIGINT) ELSE CAST(0 AS UBIGINT) END)" for i in range(64))

OP1 = f"""
WITH codes AS (SELECT vec_id, {_BITS} AS code FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS neighbor_id, CAST(bit_count(xor(q.code, c.code)) AS BIGINT) AS distance
  FROM codes q JOIN codes c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS rank FROM pairs)
SELECT query_id, CAST(rank AS BIGINT) AS rank, neighbor_id, distance FROM ranked WHERE rank <= 10
"""

OP2 = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
words AS (SELECT r, regexp_extract_all(text, {_WORD}) AS w FROM docs),
lines AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs),
dup AS (
  SELECT r, CAST(sum(n - 1) AS BIGINT) AS n_dup_lines
  FROM (SELECT r, line, count(*) AS n FROM lines WHERE regexp_matches(line, {_WORD}) GROUP BY r, line) GROUP BY r),
pos AS (SELECT r, unnest(w) AS w1, unnest(range(1, len(w) + 1)) AS p FROM words),
win AS (SELECT r, p, w1, lead(w1) OVER x AS w2, lead(w1, 2) OVER x AS w3 FROM pos WINDOW x AS (PARTITION BY r ORDER BY p)),
twice AS (
  SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, w1, w2, w3) AS n FROM win WHERE w3 IS NOT NULL) WHERE n > 1),
rep AS (
  SELECT r, CAST(count(*) AS BIGINT) AS n_repeat_words
  FROM (SELECT DISTINCT r, q FROM (SELECT r, unnest([p, p + 1, p + 2]) AS q FROM twice)) GROUP BY r),
base AS (
  SELECT d.doc_id, d.source AS host, CAST(len(w.w) AS BIGINT) AS n_words,
    CAST(length(d.text) - length(regexp_replace(d.text, {_WORD}, '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(d.text) - length(translate(d.text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    coalesce(dup.n_dup_lines, 0) AS n_dup_lines, coalesce(rep.n_repeat_words, 0) AS n_repeat_words
  FROM docs d JOIN words w USING (r) LEFT JOIN dup USING (r) LEFT JOIN rep USING (r)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base),
hosts AS (
  SELECT host, count(*) AS host_docs, CAST(sum(CASE WHEN base_failed THEN 1 ELSE 0 END) AS BIGINT) AS host_failed
  FROM judged WHERE host IS NOT NULL GROUP BY host),
m AS (
  SELECT count(*) AS m, sum(host_docs) AS n, sum(host_failed) / sum(host_docs) AS mean, sum(host_docs * host_docs) AS nn,
    sum(host_failed * host_failed / host_docs) AS ff FROM hosts),
spread AS (SELECT *, mean * (1 - mean) AS v, n - nn / n - (m - 1) AS b FROM m),
rho AS (
  SELECT mean, CASE WHEN m < 2 OR v <= 0 OR b <= 0 THEN NULL ELSE (ff - n * mean * mean - v * (m - 1)) / (v * b) END AS rho FROM spread),
prior AS (
  SELECT mean, CASE WHEN rho > 0 THEN least(10000.0, greatest(1.0, 1 / rho - 1)) ELSE 10000.0 END AS strength FROM rho),
rates AS (SELECT h.*, (host_failed + mean * strength) / (host_docs + strength) AS host_rate FROM hosts h, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT coalesce(host_rate > 0.5, false) AS kept, j.host, host_docs, round(host_rate, 6) AS host_rate
FROM judged j LEFT JOIN rates r ON j.host = r.host
"""

#: Keys, targets and copies of the mix; ``docs`` gives the documents' rows.
MIX = r"""
sized AS (
  SELECT r, doc_id, source, size, text FROM (
    SELECT r, doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
      coalesce(text, '') AS text FROM docs)),
weighed AS (
  SELECT *, greatest(0.05::DOUBLE, least(1.0::DOUBLE, (size + 1) / 51.0::DOUBLE) * greatest(0.05::DOUBLE,
    1.0::DOUBLE - 5.0::DOUBLE * (length(text) - length(translate(text, '#*$%&|<>', ''))) / (length(text) + 1))) AS w FROM sized),
keyed AS (
  SELECT r, doc_id, source, size, -ln((('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 12))::BIGINT
    + 0.5::DOUBLE) / 281474976710656.0::DOUBLE) / w AS key FROM weighed),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i FROM keyed GROUP BY source),
levels AS (
  SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][CAST(i % 3 AS INTEGER) + 1] AS w, 2.0::DOUBLE * source_size AS cap FROM sources),
tries AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0)) /
    (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS t
  FROM levels WINDOW before AS (ORDER BY cap / w, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (SELECT source, source_size, round(least(cap, w * max(t) OVER ()), 6) AS target FROM tries),
budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs,
    target - (CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END) * source_size AS rest FROM targets),
sums AS (
  SELECT k.*, b.source_size, b.target, b.epochs, b.rest,
    sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id NULLS FIRST, size RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS total,
    sum(size) OVER (PARTITION BY k.source, key, doc_id, size) AS tie
  FROM keyed k JOIN budgets b ON k.source IS NOT DISTINCT FROM b.source),
mixed AS (
  SELECT r, doc_id, size, source_size, target, epochs +
    CASE WHEN total - tie < rest AND total - rest <= rest - (total - tie) THEN 1 ELSE 0 END AS times FROM sums)
"""

OP3 = ("WITH docs AS (SELECT row_number() OVER () AS r, * FROM documents)," + MIX +
       "SELECT doc_id, size, source_size, target, CAST(times * size AS BIGINT) AS taken FROM mixed")

OP4 = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS doc, coalesce(text, '') AS text FROM documents),
lines AS (SELECT r, doc, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM docs),
keys AS (
  SELECT *, translate(trim(line, {_WS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
firsts AS (SELECT key, min(doc) AS first FROM keys WHERE length(key) >= 10 GROUP BY key HAVING min(doc) <> max(doc)),
marked AS (
  SELECT k.r, k.pos, k.line, f.first IS NOT NULL AND k.doc > f.first AS gone FROM keys k LEFT JOIN firsts f ON k.key = f.key),
kept AS (
  SELECT r, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
    coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS kept FROM marked GROUP BY r)
SELECT doc_id, CAST(n_lines AS BIGINT) AS n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM docs JOIN kept USING (r)
"""

OP10 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
owners AS (SELECT h, max(page_id) AS owner FROM p GROUP BY h),
j AS (SELECT page_id, html, h, owner, owner IS NOT NULL AND page_id IS DISTINCT FROM owner AS revisit FROM p JOIN owners USING (h))
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
    (('0x' || substr(h, 1 + 5 * (k // 4), 5))::INTEGER >> (15 - 5 * (k % 4))) & 31 AS INTEGER), 1)), '') AS payload_digest,
  CASE WHEN revisit THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN revisit THEN owner END AS refers_to
FROM j
"""

#: Conversation repair: crc32 by its byte table, faults by windows, edits by a recursion from each last row over the grammar's
#: states 0 to 3 (start, after s, after u, after a); a state's value is (cost, edits, lines).
_ROW_EDITS = ",\n    ".join(
    f"""list_min([struct_pack(c := 3 + w.v{s}.c, e := 'D' || w.v{s}.e, o := w.v{s}.o),
      CASE WHEN NOT f.gone THEN struct_pack(c := 2 + f.cut + w.v{t}.c, e := 'R' || w.v{t}.e, o := '{r}:' || f.text || chr(10) || w.v{t}.o) END,
      CASE WHEN NOT f.gone AND f.initial = '{r[0]}' THEN struct_pack(c := f.cut + w.v{t}.c, e := 'K' || w.v{t}.e, o := f.line || w.v{t}.o) END{extra}]) AS v{s}"""
    for s, t, r, extra in ((0, 2, "user", """,
      CASE WHEN NOT f.gone AND f.initial = 's' THEN struct_pack(c := f.cut + w.v1.c, e := 'K' || w.v1.e, o := f.line || w.v1.o) END"""),
                           (1, 2, "user", ""), (2, 3, "assistant", ""), (3, 2, "user", "")))


def _inserted(s: int, t: int, role: str) -> str:
    return f"struct_pack(c := 2 + v{t}.c, e := 'I' || v{t}.e, o := '{role}:' || chr(10) || v{t}.o)"


_TWO = "struct_pack(c := 4 + v3.c, e := 'II' || v3.e, o := 'user:' || chr(10) || 'assistant:' || chr(10) || v3.o)"
OP11 = f"""
WITH RECURSIVE bits(i, k, c) AS (
  SELECT i, 0, i FROM range(256) r(i) UNION ALL
  SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8),
byte_table AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
rows AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
hashed AS (
  SELECT rows.*, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(key, ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda h, x: xor(t[(xor(h, x) & 255) + 1], h >> 8))) % 20 AS d FROM rows, byte_table),
damaged AS (
  SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
    CASE d WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE d WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM hashed),
ordered AS (
  SELECT *, rtrim(text, {_WS}) AS bare, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text), copy) AS i FROM damaged),
faults AS (
  SELECT *, left(role, 1) AS initial, role || ':' || text || chr(10) AS line, bare = '' AS blank,
    bare <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS dup,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM ordered),
flagged AS (
  SELECT *, blank OR dup AS gone, CASE WHEN NOT blank AND NOT dup AND right(bare, 1) NOT IN ('.', '!', '?') THEN 1 ELSE 0 END AS cut FROM faults),
stats AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, sum(CASE WHEN blank THEN 1 ELSE 0 END) AS blank,
    sum(CASE WHEN dup THEN 1 ELSE 0 END) AS duplicate, sum(cut) AS truncated,
    sum(CASE WHEN before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au') THEN 1 ELSE 0 END) AS illegal FROM flagged GROUP BY conv_id),
walk AS (
  SELECT conv_id, n AS i, struct_pack(c := 0, e := '', o := '') AS v0,
    struct_pack(c := 4, e := 'II', o := 'user:' || chr(10) || 'assistant:' || chr(10)) AS v1,
    struct_pack(c := 2, e := 'I', o := 'assistant:' || chr(10)) AS v2, struct_pack(c := 0, e := '', o := '') AS v3 FROM stats
  UNION ALL
  SELECT conv_id, i, list_min([v0, {_inserted(0, 2, 'user')}, {_TWO}]), list_min([v1, {_inserted(1, 2, 'user')}, {_TWO}]),
    list_min([v2, {_inserted(2, 3, 'assistant')}]), list_min([v3, {_inserted(3, 2, 'user')}])
  FROM (SELECT w.conv_id, w.i - 1 AS i,
    {_ROW_EDITS}
    FROM walk w JOIN flagged f ON w.conv_id IS NOT DISTINCT FROM f.conv_id AND w.i = f.i)),
best AS (SELECT conv_id, v0 FROM walk WHERE i = 0)
SELECT a.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
  CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
  CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(v0.c, 0) AS BIGINT) AS cost, coalesce(v0.e, '') AS audit,
  sha256(coalesce(substr(v0.o, 1, length(v0.o) - 1), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN stats s ON a.conv_id IS NOT DISTINCT FROM s.conv_id
LEFT JOIN best b ON a.conv_id IS NOT DISTINCT FROM b.conv_id
"""

SQL = {
    "op1_hamming_top_k": OP1,
    "op2_host_quality": OP2,
    "op3_mix_sources": OP3,
    "op4_line_dedup": OP4,
    "op10_warc": OP10,
    "op11_conversation_repair": OP11,
}
