"""DuckDB SQL of the catalogue's queries."""

from __future__ import annotations

UNITS = """
docs AS (SELECT doc_id, source, lang, coalesce(text, '') AS text FROM documents),
u AS (
  SELECT doc_id AS part, source AS file_name, 0 AS unit_pos,
    CASE WHEN doc_id % 4 <> 3 THEN lang ELSE '未分类' END AS tag,
    CASE WHEN doc_id % 4 <> 3 THEN CAST(doc_id % 3 AS INTEGER) ELSE 3 END AS priority,
    'doc ' || doc_id AS title,
    rtrim(CASE WHEN doc_id % 4 <> 3 THEN '## [' || lang || '][P' || (doc_id % 3) || '] doc ' || doc_id ELSE '## doc ' || doc_id END || chr(10) || text,
      ' ' || chr(9) || chr(10) || chr(13)) AS body
  FROM docs
),
units AS (SELECT *, substr(sha256(body), 1, 16) AS fingerprint FROM u),
mapping(tag, topic) AS (VALUES ('fr', 'latin'), ('es', 'latin'), ('en', 'germanic')),
firsts AS (SELECT tag, min((file_name, part, unit_pos)) AS tag_first FROM units GROUP BY tag),
tu AS (
  SELECT units.*, coalesce(mapping.topic, '未分类') AS topic, tag_first, part % 5 <> 0 AS is_new,
    (priority, tag_first, file_name, part, unit_pos) AS pos
  FROM units LEFT JOIN mapping USING (tag) JOIN firsts USING (tag)
)"""

GRAMS = """
c AS (SELECT part, string_split(regexp_replace(regexp_replace(body, '[#*\\-|>\\[\\](){}]', '', 'g'), '\\s+', '', 'g'), '') AS c FROM tu),
g AS (SELECT part, unnest(list_distinct(list_transform(range(1, greatest(len(c) - 1, 1)), lambda i: c[i] || c[i + 1] || c[i + 2]))) AS gram FROM c),
n AS (SELECT part, count(*) AS n FROM g GROUP BY part)"""


def _intra(rule: str) -> str:
    return f"""
WITH {UNITS}, {GRAMS},
k AS (SELECT tu.part, topic, is_new, pos, n, gram FROM tu JOIN n USING (part) JOIN g USING (part)),
p AS (
  SELECT a.topic, a.part AS a, b.part AS b, count(*) AS hits, any_value(a.n) AS na, any_value(b.n) AS nb
  FROM k a JOIN k b ON a.topic = b.topic AND a.gram = b.gram AND {rule} AND least(a.n, b.n) >= 0.7 * greatest(a.n, b.n)
  GROUP BY 1, 2, 3
)
SELECT topic, a, b, round(hits / (na + nb - hits), 9) AS sim FROM p WHERE hits / (na + nb - hits) >= 0.7
"""


CROSS = f"""
WITH {UNITS}, {GRAMS},
places AS (SELECT topic, min((file_name, part, unit_pos)) AS seen FROM tu GROUP BY topic),
s AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY pos) AS rank FROM tu WHERE is_new) WHERE rank <= 50),
k AS (SELECT s.part, s.topic, seen, n, gram FROM s JOIN places USING (topic) JOIN n USING (part) JOIN g USING (part)),
p AS (
  SELECT a.topic AS topic_a, b.topic AS topic_b, a.part AS a, b.part AS b, count(*) AS hits, any_value(a.n) AS na, any_value(b.n) AS nb
  FROM k a JOIN k b ON a.seen < b.seen AND a.gram = b.gram GROUP BY 1, 2, 3, 4
),
cp AS MATERIALIZED (SELECT topic_a, topic_b, a, b, hits / (na + nb - hits) AS sim FROM p WHERE hits / (na + nb - hits) >= 0.1)"""

VECTORS = """
v AS (SELECT vec_id, label, is_new, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM
  (SELECT *, vec_id % 5 <> 0 AS is_new FROM embeddings WHERE embedding IS NOT NULL AND label IS NOT NULL)),
ci AS (
  SELECT a.label AS topic, a.vec_id AS a, b.vec_id AS b, list_cosine_similarity(a.e, b.e) AS sim
  FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND ((a.is_new AND b.is_new AND a.vec_id < b.vec_id) OR (a.is_new AND NOT b.is_new))
  WHERE list_cosine_similarity(a.e, b.e) >= 0.3
)"""

JUDGMENTS = """
pairs AS (SELECT a.part, a.fingerprint AS fp, b.fingerprint AS other, a.part % 10 AS k FROM units a JOIN units b ON b.part = a.part + 1),
j AS (
  SELECT least(fp, other) || '_' || greatest(fp, other) AS pair_key, least(fp, other) AS lo, greatest(fp, other) AS hi,
    CASE WHEN k IN (1, 6) THEN 'MERGE' WHEN k IN (2, 4) THEN 'DUPLICATE' ELSE 'KEEP_BOTH' END AS verdict,
    CASE WHEN k IN (2, 4) THEN other END AS drop_fp, CASE WHEN k = 1 THEN '## merged ' || part END AS merged_text, part AS ord
  FROM pairs WHERE k IN (1, 2, 4, 6, 8)
),
m AS (SELECT * FROM j WHERE verdict = 'MERGE' AND merged_text IS NOT NULL)"""

ITEMS = """
i AS (
  SELECT doc_id, (strlen(to_json(struct_pack(source_file := 'doc_' || doc_id || '.txt', content := coalesce(text, '')))::VARCHAR) + 3) / 1024.0::DOUBLE AS size_kb FROM documents
)"""

VERDICT_TEXT = "'1|KEEP_BOTH' || chr(10) || '2:DUPLICATE:b' || chr(10) || ' 3' || chr(9) || 'MERGE' || chr(10) || 'note: 4|MERGE' || chr(10) || (doc_id % 6) || '|dup of it|A' || chr(10) || '9|MERGE' || chr(10) || '4'"

ORACLE_SQL: dict[str, str] = {
    "unit_parse": f"WITH {UNITS} SELECT file_name, part, unit_pos, tag, priority, title, fingerprint FROM units",
    "unit_fingerprint": "SELECT doc_id, substr(sha256(coalesce(text, '')), 1, 16) AS fingerprint FROM documents",
    "exact_dedup": "SELECT substr(sha256(coalesce(text, '')), 1, 16) AS fingerprint, min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY 1",
    "topic_mapping": f"WITH {UNITS} SELECT part, tag, topic FROM tu",
    "unmapped_tags": f"WITH {UNITS} SELECT tag, count(*) AS units FROM tu WHERE topic = '未分类' GROUP BY tag",
    "topic_index": f"""WITH {UNITS} SELECT topic, '?' AS seq, count(*) AS units, count(*) FILTER (priority = 0) AS p0, count(*) FILTER (priority = 1) AS p1,
      count(*) FILTER (priority >= 2) AS p2, CASE topic WHEN 'latin' THEN 'fr、es' ELSE 'en' END AS tags FROM tu WHERE topic <> '未分类' GROUP BY topic""",
    "topic_stats": f"""WITH {UNITS} SELECT topic, count(*) AS units, round(sum(strlen(body)) / 1024.0::DOUBLE, 6) AS kb, count(*) FILTER (priority = 0) AS p0,
      count(*) FILTER (priority = 1) AS p1, count(*) FILTER (priority = 2) AS p2 FROM tu GROUP BY topic""",
    "priority_order": f"WITH {UNITS} SELECT topic, part, CAST(row_number() OVER (PARTITION BY topic ORDER BY pos) AS INTEGER) AS rank FROM tu",
    "topic_fingerprints": f"""WITH {UNITS}, h AS (SELECT topic, sha256(body) AS h FROM tu),
      s AS (SELECT topic, substr(h, 1, 3) AS slot, count(*) AS n, sha256(string_agg(h, '' ORDER BY h)) AS h FROM h GROUP BY 1, 2)
      SELECT topic, CAST(sum(n) AS BIGINT) AS units, substr(sha256(string_agg(h, '' ORDER BY slot)), 1, 16) AS fingerprint FROM s GROUP BY topic""",
    "shingle_counts": f"WITH {UNITS}, {GRAMS} SELECT part, n AS grams FROM n",
    "jaccard_intra_new_new": _intra("a.is_new AND b.is_new AND a.pos < b.pos"),
    "jaccard_intra_new_old": _intra("a.is_new AND NOT b.is_new"),
    "jaccard_cross_topic": f"{CROSS} SELECT topic_a, topic_b, a, b, round(sim, 9) AS sim FROM cp",
    "cross_topic_topk": f"""{CROSS} SELECT topic_a, topic_b, a, b, round(sim, 9) AS sim, replace(substr(x.body, 1, 80), chr(10), ' ') AS preview_a, replace(substr(y.body, 1, 80), chr(10), ' ') AS preview_b
      FROM cp JOIN tu x ON x.part = a JOIN tu y ON y.part = b ORDER BY cp.sim DESC, a, b LIMIT 50""",
    "cosine_intra": f"WITH {VECTORS} SELECT topic, a, b, round(sim, 6) AS sim FROM ci",
    "cosine_cross": f"""WITH {VECTORS}, places AS (SELECT label, min(vec_id) AS seen FROM v GROUP BY label),
      s AS (SELECT v.*, seen FROM v JOIN places USING (label) WHERE is_new QUALIFY row_number() OVER (PARTITION BY label ORDER BY vec_id) <= 50)
      SELECT a.label AS topic_a, b.label AS topic_b, a.vec_id AS a, b.vec_id AS b, round(list_cosine_similarity(a.e, b.e), 6) AS sim
      FROM s a JOIN s b ON a.seen < b.seen WHERE list_cosine_similarity(a.e, b.e) >= 0.3""",
    "comparison_counts": f"""WITH {UNITS}, c AS (SELECT topic, count(*) FILTER (is_new) AS new, count(*) FILTER (NOT is_new) AS old FROM tu GROUP BY topic)
      SELECT topic, new, old, CAST(new * (new - 1) // 2 + new * old AS BIGINT) AS comparisons FROM c""",
    "verdict_batches": f"""WITH {VECTORS}, r AS (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY a, b) - 1 AS pos FROM ci)
      SELECT topic, CAST(pos // 8 AS BIGINT) AS batch, CAST(pos % 8 + 1 AS INTEGER) AS slot, a, b FROM r""",
    "verdict_prompts": f"""WITH {UNITS}, p AS (
        SELECT a.topic, a.part AS a, row_number() OVER (PARTITION BY a.topic ORDER BY a.part) - 1 AS pos, a.priority AS ap, b.priority AS bp, a.tag AS atg, b.tag AS btg, a.title AS at1, b.title AS bt1, a.body AS ab, b.body AS bb
        FROM tu a JOIN tu b ON a.topic = b.topic AND b.part = a.part + 1),
      l AS (SELECT topic, pos // 8 AS batch, pos % 8 + 1 AS slot, chr(10) || '【对' || (pos % 8 + 1) || '】（相似度: 72%）' || chr(10) || 'A (P' || ap || '): [' || atg || '] ' || at1 || chr(10)
        || substr(ab, 1, 2000) || CASE WHEN length(ab) > 2000 THEN '...' ELSE '' END || chr(10) || chr(10) || 'B (P' || bp || '): [' || btg || '] ' || bt1 || chr(10)
        || substr(bb, 1, 2000) || CASE WHEN length(bb) > 2000 THEN '...' ELSE '' END AS x FROM p)
      SELECT topic, CAST(batch AS BIGINT) AS batch, count(*) AS num_pairs, sha256(string_agg(x, chr(10) ORDER BY slot)) AS lines FROM l GROUP BY 1, 2""",
    "merge_prompts": f"""WITH {UNITS} SELECT a.part, sha256('请将以下两条知识单元合并为一条，保留双方独特内容，消除重复部分。' || chr(10) || '输出要求：直接输出合并后的完整 Markdown 文本（以 ## 开头），不要加任何包裹或说明。' || chr(10)
      || '输出完成后，必须在最后单独一行写 <!-- END --> 作为结束标记。' || chr(10)
      || chr(10) || '【A】(P' || a.priority || '): [' || a.tag || '] ' || a.title || chr(10) || a.body || chr(10) || chr(10) || '【B】(P' || b.priority || '): [' || b.tag || '] ' || b.title || chr(10) || b.body || chr(10)) AS prompt
      FROM tu a JOIN tu b ON a.topic = b.topic AND b.part = a.part + 1""",
    "parse_verdicts": f"""WITH r AS (SELECT doc_id, {VERDICT_TEXT} AS raw FROM documents),
      l AS (SELECT doc_id, generate_subscripts(string_split(raw, chr(10)), 1) AS line, trim(unnest(string_split(raw, chr(10))), ' ' || chr(9)) AS s FROM r),
      p AS (SELECT doc_id, line, list_filter(list_transform(string_split(regexp_replace(s, '[|:\\t]+', '|', 'g'), '|'), lambda x: trim(x)), lambda x: x <> '') AS p FROM l WHERE s SIMILAR TO '[0-9].*'),
      e AS (SELECT doc_id, line, CAST(regexp_extract(p[1], '^([0-9]+)', 1) AS INTEGER) AS pair, upper(p[2]) AS w, upper(p[3]) AS side FROM p WHERE len(p) >= 2),
      f AS (SELECT *, CASE WHEN w IN ('DUPLICATE', 'MERGE', 'KEEP_BOTH') THEN w WHEN w LIKE '%DUP%' THEN 'DUPLICATE' WHEN w LIKE '%MERGE%' THEN 'MERGE' ELSE 'KEEP_BOTH' END AS verdict FROM e
        QUALIFY row_number() OVER (PARTITION BY doc_id, pair ORDER BY line DESC) = 1),
      d AS (SELECT doc_id, unnest([1, 2, 3, 4]) AS pair FROM documents)
      SELECT d.doc_id, d.pair, coalesce(verdict, 'KEEP_BOTH') AS verdict, CASE WHEN verdict = 'DUPLICATE' AND side IN ('A', 'B') THEN side END AS keep FROM d LEFT JOIN f USING (doc_id, pair)""",
    "judgments": f"WITH {VECTORS} SELECT least(a::VARCHAR, b::VARCHAR) || '_' || greatest(a::VARCHAR, b::VARCHAR) AS pair_key, CASE WHEN sim >= 0.45 THEN 'DUPLICATE' WHEN sim >= 0.35 THEN 'MERGE' ELSE 'KEEP_BOTH' END AS verdict, CASE WHEN sim >= 0.45 THEN CASE WHEN b % 3 < a % 3 THEN b::VARCHAR ELSE a::VARCHAR END END AS keep_fp, CASE WHEN sim >= 0.45 THEN CASE WHEN b % 3 < a % 3 THEN a::VARCHAR ELSE b::VARCHAR END END AS drop_fp FROM ci",
    "verdict_histogram": f"""WITH {UNITS}, {JUDGMENTS} SELECT count(*) FILTER (verdict = 'DUPLICATE') AS duplicate, count(*) FILTER (verdict = 'MERGE' AND merged_text IS NOT NULL) AS merge_done,
      count(*) FILTER (verdict = 'MERGE' AND merged_text IS NULL) AS merge_pending, count(*) FILTER (verdict = 'KEEP_BOTH') AS keep_both FROM j""",
    "resolve_reference": f"""WITH {UNITS}, {JUDGMENTS},
      best AS (SELECT m.lo, m.hi, m.ord, m.merged_text, arg_min(tu, (priority, pos)) AS w FROM m JOIN tu ON tu.fingerprint IN (m.lo, m.hi) GROUP BY ALL),
      r AS (SELECT lo, arg_max(merged_text, ord) AS text, arg_max(w, ord) AS w FROM best GROUP BY lo),
      involved AS (SELECT lo AS fp FROM m UNION SELECT hi FROM m),
      gone AS (SELECT hi AS fp FROM best UNION SELECT drop_fp FROM j WHERE verdict = 'DUPLICATE' AND drop_fp NOT IN (SELECT fp FROM involved))
      SELECT tu.part, tu.topic, coalesce(w.tag, tu.tag) AS tag, coalesce(w.priority, tu.priority) AS priority, coalesce(w.title, tu.title) AS title,
        CASE WHEN text IS NULL THEN tu.fingerprint ELSE substr(sha256(text), 1, 16) END AS fingerprint
      FROM tu LEFT JOIN r ON r.lo = tu.fingerprint WHERE tu.fingerprint NOT IN (SELECT fp FROM gone)""",
    "resolve_safe": f"""WITH RECURSIVE {UNITS}, {JUDGMENTS},
      e AS (SELECT lo AS a, hi AS b FROM j WHERE verdict <> 'KEEP_BOTH' UNION SELECT hi, lo FROM j WHERE verdict <> 'KEEP_BOTH'),
      reach(a, b) AS (SELECT a, a FROM e UNION SELECT reach.a, e.b FROM reach JOIN e ON e.a = reach.b),
      parts AS (SELECT a AS fp, min(b) AS root FROM reach GROUP BY a),
      t AS (SELECT tu.*, coalesce(root, fingerprint) AS root FROM tu LEFT JOIN parts ON fp = fingerprint),
      keep AS (SELECT root, arg_min(fingerprint, pos) AS fingerprint FROM t GROUP BY root),
      texts AS (SELECT root, arg_max(merged_text, ord) AS text FROM m JOIN parts ON fp = lo GROUP BY root)
      SELECT part, topic, tag, priority, title, CASE WHEN text IS NULL THEN t.fingerprint ELSE substr(sha256(text), 1, 16) END AS fingerprint
      FROM t JOIN keep USING (root, fingerprint) LEFT JOIN texts USING (root)""",
    "batch_packing": f"""WITH RECURSIVE {ITEMS}, o AS (SELECT *, row_number() OVER (ORDER BY size_kb, doc_id) AS rn FROM i),
      f AS (SELECT rn, doc_id, CAST(0 AS BIGINT) AS batch, 1 AS n, CASE WHEN size_kb > 127.5 THEN 0 ELSE size_kb END AS kb, size_kb <= 127.5 AS open FROM o WHERE rn = 1
        UNION ALL SELECT o.rn, o.doc_id, CASE WHEN size_kb <= 127.5 AND open AND n < 50 AND kb + size_kb <= 127.5 THEN batch ELSE batch + 1 END,
          CASE WHEN size_kb <= 127.5 AND open AND n < 50 AND kb + size_kb <= 127.5 THEN n + 1 ELSE 1 END,
          CASE WHEN size_kb > 127.5 THEN 0 WHEN open AND n < 50 AND kb + size_kb <= 127.5 THEN kb + size_kb ELSE size_kb END, size_kb <= 127.5
        FROM f JOIN o ON o.rn = f.rn + 1)
      SELECT doc_id, batch FROM f""",
    "volume_packing": f"""WITH RECURSIVE {UNITS}, w AS (SELECT topic, sum(strlen(body)) + 2 * (count(*) - 1) AS whole FROM tu GROUP BY topic),
      o AS (SELECT tu.topic, part, strlen(body) AS b, whole, row_number() OVER (PARTITION BY tu.topic ORDER BY pos) AS rn FROM tu JOIN w USING (topic)),
      f AS (SELECT topic, rn, part, 1 AS volume, b + 2 AS used FROM o WHERE rn = 1
        UNION ALL SELECT o.topic, o.rn, o.part, CASE WHEN whole > 102400 AND used + b + 2 > 102400 THEN volume + 1 ELSE volume END, CASE WHEN whole > 102400 AND used + b + 2 > 102400 THEN b + 2 ELSE used + b + 2 END
        FROM f JOIN o ON o.topic = f.topic AND o.rn = f.rn + 1)
      SELECT topic, part, volume, CASE WHEN volume = 1 THEN topic || '.md' ELSE topic || '-' || lpad(volume::VARCHAR, 3, '0') || '.md' END AS file FROM f""",
    "payload_size": f"WITH {ITEMS} SELECT doc_id, round(size_kb, 9) AS size_kb FROM i",
    "batch_names": "SELECT doc_id // 8 AS batch, 'batch_' || substr(sha256(string_agg('doc_' || doc_id || '.txt', '|' ORDER BY 'doc_' || doc_id || '.txt')), 1, 8) || '.md' AS name FROM documents GROUP BY 1",
    "safe_filename": """SELECT page_id, CASE WHEN n = '' THEN 'untitled' ELSE n END AS name FROM (SELECT page_id, regexp_replace(regexp_replace(replace(trim(regexp_replace(regexp_replace(replace(trim(url), '\\', '/'),
      '[<>:"/\\\\|?*\\x00-\\x1f]', '_', 'g'), '\\s+', ' ', 'g')), ' ', '_'), '^[._]+', ''), '[._]+$', '') AS n FROM pages)""",
    "strip_fences": """SELECT conv_id, turn, CASE WHEN turn % 3 = 1 THEN '```python' || chr(10) || t || chr(10) || '```' ELSE t END AS text
      FROM (SELECT conv_id, turn, trim(text, ' ' || chr(9) || chr(10) || chr(13)) AS t FROM conversations)""",
    "end_marker_join": "SELECT conv_id, trim(string_agg(text, '' ORDER BY turn), ' ' || chr(9) || chr(10) || chr(13)) AS text FROM conversations WHERE role = 'assistant' GROUP BY conv_id",
    "split_topics": """SELECT conv_id, turn, unnest(['01_one_' || turn || '.md', '03_a_b.md']) AS file_name, unnest(['# one ' || turn || chr(10) || 'x', '# a/b' || chr(10) || 'y']) AS content FROM conversations""",
    "scan_units": "SELECT conv_id, unnest([1, 2]) AS unit_no, unnest(['one ' || conv_id, '#x']) AS title, unnest(['## one ' || conv_id || chr(10) || 'a' || chr(10) || '### sub', '## #x' || chr(10) || 'b']) AS content FROM (SELECT DISTINCT conv_id FROM conversations)",
    "json_repair": "SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN '[1, ' || turn || ']' WHEN 1 THEN '{\"a\": ' || turn || '}' END AS json FROM conversations",
    "url_sanitize": "SELECT page_id, regexp_replace(url || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END || 'api_key=k' || page_id || '&x=1&Token=t', '([?&](?:api_key|Token)=)[^&#]*', '\\1***', 'g') AS url FROM pages",
    "error_classes": """SELECT event_id, CASE event_id % 12 WHEN 0 THEN '网络中断' WHEN 1 THEN 'HTTP超时' WHEN 2 THEN '请求限流' WHEN 3 THEN '服务端错误' WHEN 4 THEN '鉴权失败' WHEN 5 THEN '响应内容为空' WHEN 6 THEN '响应格式异常'
      WHEN 7 THEN 'Token超限' WHEN 8 THEN 'API地址错误' WHEN 9 THEN 'API地址错误' WHEN 10 THEN '网络中断' ELSE '未知错误' END AS label FROM events""",
    "exec_log_summary": "SELECT CASE WHEN event_id % 7 = 0 THEN 'error' WHEN event_id % 11 = 0 THEN 'skip' ELSE 'ok' END AS status, count(*) AS n, CAST(sum(event_id % 100) AS DOUBLE) AS seconds FROM events GROUP BY 1",
    "qa_pairs": "SELECT q.conv_id, q.turn, q.text AS question, a.text AS answer FROM conversations q JOIN conversations a ON a.conv_id = q.conv_id AND a.turn = q.turn + 1 WHERE q.role = 'user' AND a.role = 'assistant'",
    "denoise_lines": """WITH l AS (SELECT doc_id, generate_subscripts(s, 1) AS i, unnest(s) AS x FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents)),
      f AS (SELECT doc_id, x, min(i) AS i FROM l WHERE x <> '' GROUP BY 1, 2), j AS (SELECT doc_id, string_agg(x, chr(10) ORDER BY i) AS t FROM f GROUP BY doc_id)
      SELECT doc_id, sha256(coalesce(t, '')) AS text FROM documents LEFT JOIN j USING (doc_id)""",
    "drop_timestamps": "SELECT conv_id, turn, text FROM conversations",
    "drop_fillers": "SELECT conv_id, turn, text || ' so.' AS text FROM conversations",
    "correct_terms": "SELECT doc_id, sha256(replace(replace(coalesce(text, ''), 'the', 'THE'), 'THEr', 'there')) AS text FROM documents",
    "new_units": f"WITH {UNITS} SELECT part, fingerprint FROM units WHERE part % 5 <> 0",
    "changelog_by_topic": f"WITH {UNITS} SELECT topic, count(*) AS added FROM tu WHERE is_new GROUP BY topic",
    "changelog_lines": f"WITH {UNITS} SELECT topic, fingerprint, '- [' || topic || '.md](../topics/' || topic || '.md) — [' || tag || '][P' || priority || '] ' || title AS line FROM tu WHERE is_new",
    "manifest_resume": "SELECT doc_id FROM documents WHERE doc_id % 3 <> 0",
    "changed_topics": f"WITH {UNITS} SELECT topic FROM tu GROUP BY topic HAVING topic <> 'latin'",
    "cache_upsert": "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'new' ELSE 'old' END AS value FROM documents",
    "best_cached": """WITH a AS (SELECT doc_id // 10 AS name, doc_id AS fp FROM documents), b AS (SELECT (doc_id + 3) // 10 AS best, doc_id AS fp FROM documents),
      na AS (SELECT name, count(*) AS n FROM a GROUP BY 1), nb AS (SELECT best, count(*) AS m FROM b GROUP BY 1),
      p AS (SELECT name, best, count(*) / greatest(any_value(n), any_value(m)) AS overlap FROM a JOIN b USING (fp) JOIN na USING (name) JOIN nb USING (best) GROUP BY 1, 2)
      SELECT name, best, round(overlap, 9) AS overlap FROM p WHERE overlap >= 0.5 QUALIFY row_number() OVER (PARTITION BY name ORDER BY overlap DESC, best) = 1""",
    "topic_summary_after_dedup": "",
}
ORACLE_SQL["topic_summary_after_dedup"] = f"WITH r AS ({ORACLE_SQL['resolve_reference']}) SELECT topic, count(*) AS units, count(*) FILTER (priority = 0) AS p0 FROM r GROUP BY topic"


def _split(source: str, max_bytes: int) -> str:
    """CTEs that cut (id, text) of `source` into chunks (id, chunk_index, chunk_total, chunk).

    Pieces are paragraphs, or the lines of a paragraph over the limit; a fold over a text's pieces numbers their
    chunks. Kinds: 1 paragraph, 2 line, 3 line over the limit; `opens` marks the first line of a large paragraph.
    """
    m = max_bytes
    shut = f"(x.opens OR x.kind = 3 OR (x.kind = 1 AND a.held AND a.used + x.size + 2 > {m}) OR (x.kind = 2 AND a.used + x.size + 1 > {m}))"
    into = f"a.c + CAST(a.held AND {shut} AS INTEGER)"
    return f"""
large AS (SELECT id, string_split_regex(text, '\\n\\s*\\n') AS x FROM {source} WHERE strlen(text) > {m}),
par AS (SELECT id, generate_subscripts(x, 1) AS p, unnest(x) AS t FROM large),
ln AS (SELECT id, p, whole, generate_subscripts(x, 1) AS l, unnest(x) AS t FROM
  (SELECT id, p, strlen(t) <= {m} AS whole, CASE WHEN strlen(t) <= {m} THEN [t] ELSE string_split(t, chr(10)) END AS x FROM par)),
piece AS (SELECT id, p, l, t, CAST(strlen(t) AS BIGINT) AS size, CASE WHEN whole THEN 1 WHEN strlen(t) <= {m} THEN 2 ELSE 3 END AS kind, NOT whole AND l = 1 AS opens FROM ln),
lists AS (SELECT id, list(t ORDER BY p, l) AS ts,
  list(struct_pack(size := size, kind := kind, opens := opens, c := 1, used := 0::BIGINT, held := false, placed := []::INTEGER[]) ORDER BY p, l) AS xs FROM piece GROUP BY id),
folded AS (SELECT id, ts, list_reduce(list_prepend(struct_pack(size := 0::BIGINT, kind := 0, opens := false, c := 1, used := 0::BIGINT, held := false, placed := []::INTEGER[]), xs),
  lambda a, x: struct_pack(size := x.size, kind := x.kind, opens := x.opens, c := CAST({into} + CAST(x.kind = 3 AS INTEGER) AS INTEGER),
    used := CAST(CASE WHEN x.kind = 3 THEN 0 ELSE (CASE WHEN {shut} THEN 0 ELSE a.used END) + x.size + CASE WHEN x.kind = 1 THEN 2 ELSE 1 END END AS BIGINT),
    held := x.kind <> 3, placed := list_append(a.placed, CAST({into} AS INTEGER)))).placed AS placed FROM lists),
places AS (SELECT id, generate_subscripts(ts, 1) AS i, unnest(ts) AS t, unnest(placed) AS chunk_index FROM folded),
cut AS (SELECT id, chunk_index, string_agg(t, chr(10) || chr(10) ORDER BY i) AS chunk FROM places GROUP BY 1, 2),
chunks AS (SELECT id, chunk_index, CAST(count(*) OVER (PARTITION BY id) AS INTEGER) AS chunk_total, chunk FROM cut)"""


ORACLE_SQL |= {
    "split_large": f"""WITH src AS (SELECT doc_id AS id, coalesce(text, '') AS text FROM documents), {_split('src', 4096)}
      SELECT id AS doc_id, chunk_index, chunk_total, chunk FROM chunks UNION ALL SELECT id, 1, 1, text FROM src WHERE strlen(text) <= 4096""",
    "corpus_plan": f"""WITH src AS (SELECT 'doc_' || doc_id || '.txt' AS id, coalesce(text, '') AS text FROM documents), {_split('src', 17408)}
      SELECT 'normal' AS type, id AS source_name, text, round(strlen(text) / 1024.0::DOUBLE, 6) AS size_kb, NULL::INTEGER AS chunk_index, NULL::INTEGER AS chunk_total FROM src WHERE strlen(text) < 17408
      UNION ALL SELECT 'chunk', id, text, 17.0, 1, 1 FROM src WHERE strlen(text) = 17408
      UNION ALL SELECT 'chunk', id, chunk, round(strlen(chunk) / 1024.0::DOUBLE, 6), chunk_index, chunk_total FROM chunks""",
    "merge_reduce": """WITH RECURSIVE parts AS (SELECT conv_id, turn, strlen(coalesce(text, '')) / 1024.0::DOUBLE AS kb FROM conversations WHERE role = 'assistant'),
      r(conv_id, items, done, hit, ready) AS (
        SELECT conv_id, list(struct_pack(s := kb, n := 1) ORDER BY turn), []::STRUCT(s DOUBLE, n INTEGER)[], false, false FROM parts GROUP BY conv_id
        UNION ALL
        SELECT conv_id,
          CASE WHEN len(items) = 0 THEN CASE WHEN hit AND len(done) > 1 THEN done ELSE items END WHEN two THEN items[3:] ELSE items[2:] END,
          CASE WHEN len(items) = 0 THEN CASE WHEN hit AND len(done) > 1 THEN [] ELSE done END
            WHEN two THEN list_append(done, struct_pack(s := items[1].s + items[2].s, n := items[1].n + items[2].n)) ELSE list_append(done, items[1]) END,
          CASE WHEN len(items) = 0 THEN false ELSE hit OR two END,
          len(items) = 0 AND NOT (hit AND len(done) > 1)
        FROM (SELECT *, len(items) >= 2 AND items[1].s + items[2].s <= 1.0 AS two FROM r WHERE NOT ready)),
      g AS (SELECT conv_id, generate_subscripts(done, 1) - 1 AS merged, unnest(done).n AS n FROM r WHERE ready),
      span AS (SELECT conv_id, merged, sum(n) OVER w - n AS first, sum(n) OVER w AS past FROM g WINDOW w AS (PARTITION BY conv_id ORDER BY merged)),
      o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS place FROM parts)
      SELECT o.conv_id, turn, kb, CAST(merged AS INTEGER) AS merged FROM o JOIN span ON span.conv_id = o.conv_id AND place >= span.first AND place < past""",
    "model_extract_fake": f"WITH {UNITS} SELECT part AS doc_id, tag, priority, title, fingerprint FROM units",
    "topic_content_digests": f"WITH {UNITS} SELECT topic, count(*) AS units, substr(sha256(string_agg(body, '' ORDER BY pos)), 1, 16) AS fingerprint FROM tu GROUP BY topic",
    "topic_sorted_digests": f"WITH {UNITS} SELECT topic, count(*) AS units, substr(sha256(string_agg(body, '' ORDER BY body)), 1, 16) AS fingerprint FROM tu GROUP BY topic",
    "merge_pending": f"WITH {UNITS}, {JUDGMENTS} SELECT pair_key FROM j WHERE verdict = 'MERGE' AND merged_text IS NULL",
    "unit_counts": f"""WITH {UNITS}, k AS (SELECT DISTINCT fingerprint FROM units WHERE part % 5 = 0), d AS (SELECT DISTINCT fingerprint FROM units)
      SELECT (SELECT count(*) FROM d) AS total, (SELECT count(*) FROM d WHERE fingerprint NOT IN (SELECT fingerprint FROM k)) AS new, (SELECT count(*) FROM k) AS known""",
    "chunk_groups": f"""WITH src AS (SELECT doc_id AS id, coalesce(text, '') AS text FROM documents), {_split('src', 4096)}
      SELECT id AS doc_id, count(*) AS chunks, sum(strlen(chunk)) AS bytes FROM (SELECT id, chunk FROM chunks UNION ALL SELECT id, text FROM src WHERE strlen(text) <= 4096) GROUP BY 1""",
}
