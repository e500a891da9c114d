r"""ANSI SQL (DuckDB dialect) twins of the registered queries, over the driver's
tables as views. Written independently of the Spark code: pages come from list
slicing instead of spans, ordered strings from ``string_agg(... ORDER BY ...)``.
"""

from __future__ import annotations

NL = "chr(10)"
SENT = r"'[^ \t\n\r.!?][^.!?]*[.!?]*'"
SPACE_RUN = r"'[ \t\n\r]+'"
TERM = r"'[\p{L}\p{N}]+'"
BLANK_TEXT = "'[No text content on this page]'"


def pages_cte(L: int = 10, name: str = "pages_t") -> str:
    """Documents cut into pages of L lines; every seventh document has a blank page
    before them."""
    return f"""
{name}_n AS (
  SELECT doc_id, source, lines, cover, CAST(unnest(generate_series(1, (len(lines) + {L - 1}) // {L} + cover)) AS INTEGER) AS page_number
  FROM (SELECT doc_id, source, string_split(text, {NL}) AS lines, CASE WHEN doc_id % 7 = 0 THEN 1 ELSE 0 END AS cover FROM documents)
),
{name} AS (
  SELECT 'doc-' || doc_id AS document_id, doc_id, page_number,
         'raw-pdfs/' || source || '/doc-' || doc_id || '.pdf' AS blob_path,
         CASE WHEN page_number <= cover THEN ''
              ELSE array_to_string(list_slice(lines, (page_number - cover - 1) * {L} + 1, (page_number - cover) * {L}), {NL}) END AS content
  FROM {name}_n
)"""


def lead(expr: str, n: int) -> str:
    return (
        f"array_to_string(list_slice(list_transform(regexp_extract_all({expr}, {SENT}, 0), "
        f"lambda s: trim(regexp_replace(s, {SPACE_RUN}, ' ', 'g'))), 1, {n}), ' ')"
    )


def summaries_cte(src: str = "pages_t", name: str = "ps_t") -> str:
    blank = r"NOT regexp_matches(content, '[^ \t\n\r\f\v]')"
    return f"""
{name} AS (
  SELECT document_id, page_number AS page,
         CASE WHEN {blank} THEN 'skipped' ELSE 'success' END AS status,
         CASE WHEN {blank} THEN {BLANK_TEXT} ELSE {lead('content', 2)} END AS summary,
         CAST(NULL AS VARCHAR) AS error
  FROM {src}
)"""


def doc_summaries_cte(src: str = "ps_t", name: str = "ds_t", k: int = 5) -> str:
    return f"""
{name}_ok AS (
  SELECT document_id, page, summary FROM {src}
  WHERE status = 'success' AND summary IS NOT NULL AND summary <> ''
),
{name}_s AS (
  SELECT document_id, page, sidx, sentence FROM (
    SELECT document_id, page,
           unnest(generate_series(0, len(arr) - 1)) AS sidx, unnest(arr) AS sentence
    FROM (SELECT document_id, page, list_transform(regexp_extract_all(summary, {SENT}, 0),
                 lambda s: trim(regexp_replace(s, {SPACE_RUN}, ' ', 'g'))) AS arr FROM {name}_ok))
),
{name}_tok AS (
  SELECT document_id, page, sidx, unnest(regexp_extract_all(lower(sentence), {TERM}, 0)) AS term FROM {name}_s
),
{name}_w AS (SELECT document_id, term, count(DISTINCT page) AS w FROM {name}_tok GROUP BY 1, 2),
{name}_sc AS (
  SELECT t.document_id, t.page, t.sidx, sum(w.w) AS score
  FROM {name}_tok t JOIN {name}_w w ON t.document_id = w.document_id AND t.term = w.term GROUP BY 1, 2, 3
),
{name}_rk AS (
  SELECT s.document_id, s.page, s.sidx, s.sentence,
         row_number() OVER (PARTITION BY s.document_id ORDER BY coalesce(sc.score, 0) DESC, s.page, s.sidx) AS rk
  FROM {name}_s s LEFT JOIN {name}_sc sc ON s.document_id = sc.document_id AND s.page = sc.page AND s.sidx = sc.sidx
),
{name}_p AS (
  SELECT document_id, page, string_agg(sentence, ' ' ORDER BY sidx) AS para FROM {name}_rk WHERE rk <= {k} GROUP BY 1, 2
),
{name}_txt AS (
  SELECT document_id, string_agg(para, {NL} || {NL} ORDER BY page) AS summary_text FROM {name}_p GROUP BY 1
),
{name}_d AS (
  SELECT document_id,
         count(*) FILTER (WHERE status = 'success') AS n_success,
         count(*) FILTER (WHERE status = 'success' AND summary IS NOT NULL AND summary <> '') AS n_text
  FROM {src} GROUP BY 1
),
{name} AS (
  SELECT d.document_id,
         CASE WHEN n_text > 0 THEN 'success' ELSE 'failed' END AS status,
         CASE WHEN n_text > 0 THEN coalesce(t.summary_text, '') END AS summary,
         CASE WHEN n_text > 0 THEN d.document_id || '.json' END AS summary_blob,
         CASE WHEN n_text = 0 THEN 'At least one page summary with non-empty ''summary'' is required.' END AS error
  FROM {name}_d d LEFT JOIN {name}_txt t ON d.document_id = t.document_id
  WHERE n_success > 0
)"""


def totals_cte(L: int = 10, name: str = "totals_t") -> str:
    return f"""
{name} AS (
  SELECT 'doc-' || doc_id AS document_id,
         CAST((len(string_split(text, {NL})) + {L - 1}) // {L} + CASE WHEN doc_id % 7 = 0 THEN 1 ELSE 0 END AS INTEGER) AS total_pages,
         'raw-pdfs/' || source || '/doc-' || doc_id || '.pdf' AS blob_path
  FROM documents
)"""


def result_cte(ps: str = "ps_t", ds: str = "ds_t", totals: str = "totals_t", name: str = "res_t") -> str:
    return f"""
{name} AS (
  SELECT t.document_id, t.blob_path, t.total_pages AS page_count,
         CAST(coalesce(f.failed, 0) AS INTEGER) AS failed_page_count,
         coalesce(s.summary_blob, '') AS summary_blob,
         t.document_id || '.json' AS report_blob
  FROM {totals} t
  LEFT JOIN (SELECT document_id, count(*) FILTER (WHERE coalesce(status, '') <> 'success') AS failed
             FROM {ps} GROUP BY 1) f ON t.document_id = f.document_id
  LEFT JOIN (SELECT document_id, summary_blob FROM {ds} WHERE status = 'success') s ON t.document_id = s.document_id
)"""


def index_cte(res: str = "res_t", name: str = "idx_t", ts: str = "2025-01-01T00:00:00") -> str:
    return f"""
{name} AS (
  SELECT document_id AS id, document_id, string_split(blob_path, '/')[-1] AS file_name, blob_path,
         page_count, summary_blob, report_blob, failed_page_count,
         CASE WHEN failed_page_count = 0 THEN 'completed' ELSE 'completed_with_errors' END AS status,
         '{ts}' AS created_at, '{ts}' AS updated_at
  FROM {res}
)"""


def chat_ctes(ts: str) -> str:
    """L1 over the conversations table (pages pre-split)."""
    return f"""
cpg AS (
  SELECT 'conv-' || conv_id AS document_id, CAST(turn + 1 AS INTEGER) AS page_number,
         'raw-pdfs/chat/conv-' || conv_id || '.pdf' AS blob_path, text AS content
  FROM conversations
),
{summaries_cte('cpg', 'cps')},
{doc_summaries_cte('cps', 'cds')},
ctot AS (
  SELECT document_id, CAST(count(*) AS INTEGER) AS total_pages, min(blob_path) AS blob_path FROM cpg GROUP BY 1
),
{result_cte('cps', 'cds', 'ctot', 'cres')},
{index_cte('cres', 'cidx', ts)}"""


def base(L: int = 10) -> str:
    return f"""{pages_cte(L)},
{summaries_cte()},
{doc_summaries_cte()},
{totals_cte(L)},
{result_cte()},
{index_cte()}"""


REQUESTS = r"""
req AS (
  SELECT page_id,
         regexp_extract(url, '([0-9]+)([?#].*)?$', 1) AS document_id,
         regexp_extract(url, '^[a-z]+://(.*)$', 1) AS blob_path
  FROM pages
)"""


def regen_sql(lo: int | None, hi: int | None) -> str:
    cond = "TRUE" if lo is None else f"page_number BETWEEN {lo} AND {hi}"
    err = "CAST(NULL AS VARCHAR)" if lo is None else f"'No pages in range {lo}-{hi}'"
    return f"""WITH {pages_cte()},
todo AS (SELECT * FROM pages_t WHERE {cond}),
{summaries_cte('todo', 'rps')},
st AS (
  SELECT document_id, count(*) AS total_pages,
         count(*) FILTER (WHERE status = 'success') AS successful_pages,
         count(*) FILTER (WHERE status = 'skipped') AS skipped_pages,
         count(*) FILTER (WHERE status NOT IN ('success', 'skipped', 'dry-run')) AS failed_pages,
         count(*) FILTER (WHERE status = 'success' AND summary <> '') > 0 AS generated
  FROM rps GROUP BY 1
)
SELECT d.document_id,
       CASE WHEN st.document_id IS NOT NULL THEN 'success' ELSE 'failed' END AS status,
       coalesce(st.total_pages, 0) AS total_pages,
       coalesce(st.successful_pages, 0) AS successful_pages,
       coalesce(st.skipped_pages, 0) AS skipped_pages,
       coalesce(st.failed_pages, 0) AS failed_pages,
       coalesce(st.generated, false) AS document_summary_generated,
       false AS dry_run,
       CASE WHEN st.document_id IS NULL THEN {err} END AS error
FROM (SELECT DISTINCT document_id FROM pages_t) d LEFT JOIN st ON d.document_id = st.document_id"""


RENDER = f"""WITH {base()},
sec AS (
  SELECT document_id, count(*) AS total,
         count(*) FILTER (WHERE status = 'success') AS n_success,
         count(*) FILTER (WHERE status = 'skipped') AS n_skipped,
         count(*) FILTER (WHERE status = 'failed') AS n_failed,
         string_agg(CASE WHEN status = 'success' THEN '#### Page ' || page || {NL} || {NL} || trim(summary) || {NL} END, {NL} ORDER BY page) AS content_block,
         string_agg(CASE WHEN status = 'skipped' THEN CAST(page AS VARCHAR) END, ', ' ORDER BY page) AS skipped_list,
         string_agg(CASE WHEN status = 'failed' THEN '- **Page ' || page || ':** ' || coalesce(error, 'Unknown error') END, {NL} ORDER BY page) AS failed_block
  FROM ps_t GROUP BY 1
),
j AS (
  SELECT d.document_id, d.status, d.summary, d.error, CAST(NULL AS VARCHAR) AS summary_blob, s.*
  FROM ds_t d LEFT JOIN sec s ON d.document_id = s.document_id
)
SELECT document_id, concat_ws({NL},
  '# Document Summary: ' || document_id || {NL},
  '*Generated: 2025-01-01 00:00:00*' || {NL},
  '---' || {NL},
  CASE WHEN coalesce(status, 'unknown') = 'success' THEN '**Status:** ✅ Success'
       WHEN coalesce(status, 'unknown') = 'failed' THEN '**Status:** ❌ Failed'
       ELSE '**Status:** ' || coalesce(status, 'unknown') END || {NL},
  '## Executive Summary' || {NL},
  CASE WHEN coalesce(summary, '') = '' THEN '*No summary available*' || {NL}
       WHEN len(list_filter(list_transform(string_split(summary, {NL} || {NL}), lambda p: trim(p)), lambda p: p <> '')) > 0
       THEN array_to_string(list_transform(list_filter(list_transform(string_split(summary, {NL} || {NL}), lambda p: trim(p)), lambda p: p <> ''), lambda p: p || {NL}), {NL}) END,
  CASE WHEN status = 'failed' AND error IS NOT NULL THEN '## Error Details' || {NL} || {NL} || '```' || {NL} || error || {NL} || '```' || {NL} END,
  CASE WHEN coalesce(total, 0) > 0 THEN concat_ws({NL},
      '---' || {NL} || {NL} || '## Page-by-Page Summaries' || {NL},
      '**Total Pages:** ' || total,
      '- ✅ Successful: ' || n_success,
      '- ⊘ Skipped (no content): ' || n_skipped,
      '- ❌ Failed: ' || n_failed || {NL},
      CASE WHEN n_success > 0 THEN '### Content Summaries' || {NL} || {NL} || content_block END,
      CASE WHEN n_skipped > 0 THEN '### Skipped Pages' || {NL} || {NL} || 'Pages with no extractable content: ' || skipped_list || {NL} END,
      CASE WHEN n_failed > 0 THEN '### Failed Pages' || {NL} || {NL} || failed_block || {NL} END) END,
  '---' || {NL} || {NL} || '## Metadata' || {NL},
  '- **Document ID:** `' || document_id || '`',
  CASE WHEN coalesce(total, 0) > 0 THEN '- **Total Pages:** ' || total END,
  CASE WHEN summary_blob IS NOT NULL THEN '- **Summary Blob:** `' || summary_blob || '`' END,
  '') AS markdown
FROM j"""


ORACLE = {
    "intake_validation": f"""WITH {REQUESTS}
SELECT page_id, document_id, blob_path,
       CASE WHEN document_id IS NULL OR document_id = '' THEN '''documentId'' (string) is required.'
            WHEN blob_path IS NULL OR blob_path = '' THEN '''blobPath'' (string) is required.' END AS error
FROM req""",
    "blob_path_parts": f"""WITH {REQUESTS}
SELECT page_id,
       CASE WHEN contains(blob_path, '/') THEN split_part(blob_path, '/', 1) END AS container,
       CASE WHEN contains(blob_path, '/') THEN substr(blob_path, strpos(blob_path, '/') + 1) END AS blob_name,
       string_split(blob_path, '/')[-1] AS file_name,
       CASE WHEN NOT contains(blob_path, '/') THEN 'blob_path must be of the form ''container/blob-name.pdf''' END AS path_error
FROM req""",
    "split_pages": f"""WITH {pages_cte()}
SELECT document_id, page_number, blob_path, content, CAST(length(content) AS INTEGER) AS length FROM pages_t""",
    "page_count": f"""WITH {totals_cte()}
SELECT document_id, total_pages AS page_count FROM totals_t""",
    "classify_pages": rf"""WITH {pages_cte()}
SELECT document_id, page_number AS page, NOT regexp_matches(content, '[^ \t\n\r\f\v]') AS blank FROM pages_t""",
    "page_summaries": f"""WITH {pages_cte()}, {summaries_cte()}
SELECT document_id, page, status, summary FROM ps_t""",
    "pending_pages": f"""WITH {pages_cte(10)}, {pages_cte(20, 'pages20')}
SELECT p.document_id, p.page_number FROM pages_t p
WHERE NOT EXISTS (SELECT 1 FROM pages20 q WHERE q.document_id = p.document_id AND q.page_number = p.page_number)""",
    "page_range": regen_sql(3, 8),
    "regeneration_stats": regen_sql(None, None),
    "doc_input": f"""WITH {pages_cte()}, {summaries_cte()}
SELECT document_id, count(*) AS n_parts,
       string_agg('Page ' || page || ': ' || summary, {NL} ORDER BY page) AS doc_input
FROM ps_t WHERE status = 'success' AND summary IS NOT NULL AND summary <> '' GROUP BY 1""",
    "doc_summaries": f"""WITH {pages_cte()}, {summaries_cte()}, {doc_summaries_cte()}
SELECT * FROM ds_t""",
    "processing_report": f"""WITH {pages_cte()}, {summaries_cte()}, {totals_cte()}
SELECT t.document_id, t.total_pages,
       coalesce(a.successful_pages, 0) AS successful_pages, coalesce(a.failed_pages, 0) AS failed_pages,
       coalesce(a.failed_page_list, '') AS failed_page_list, t.document_id || '.json' AS report_blob
FROM totals_t t LEFT JOIN (
  SELECT document_id, count(*) FILTER (WHERE status = 'success') AS successful_pages,
         count(*) FILTER (WHERE coalesce(status, '') <> 'success') AS failed_pages,
         string_agg(CASE WHEN coalesce(status, '') <> 'success' THEN CAST(page AS VARCHAR) END, ',' ORDER BY page) AS failed_page_list
  FROM ps_t GROUP BY 1) a ON t.document_id = a.document_id""",
    "pipeline_result": f"""WITH {base()}
SELECT * FROM res_t""",
    "progress_batches": f"""WITH {pages_cte()}, {summaries_cte()},
b AS (SELECT document_id, CAST((page - 1) // 4 + 1 AS INTEGER) AS batch, count(*) AS n FROM ps_t GROUP BY 1, 2)
SELECT document_id, batch, 'page_summary' AS stage,
       CAST(sum(n) OVER (PARTITION BY document_id ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS completed_pages,
       CAST(sum(n) OVER (PARTITION BY document_id) AS BIGINT) AS total_pages
FROM b""",
    "doc_index": f"""WITH {base()}
SELECT * FROM idx_t""",
    "index_upsert": f"""WITH {base()},
{pages_cte(20, 'p20')},
{summaries_cte('p20', 'ps20')},
{doc_summaries_cte('ps20', 'ds20')},
{totals_cte(20, 'tot20')},
{result_cte('ps20', 'ds20', 'tot20', 'res20')},
{index_cte('res20', 'idx20', '2025-02-01T12:00:00')},
{chat_ctes('2025-02-01T12:00:00')},
u AS (
  SELECT *, 0 AS src FROM idx_t UNION ALL SELECT *, 1 AS src FROM idx20 UNION ALL SELECT *, 1 AS src FROM cidx
),
r AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated_at DESC, src DESC) AS rk,
         min(created_at) OVER (PARTITION BY id) AS first_created
  FROM u
)
SELECT id, page_count, failed_page_count, status, first_created AS created_at, updated_at FROM r WHERE rk = 1""",
    "page_index": f"""WITH {pages_cte()}, {summaries_cte()}
SELECT document_id || '-' || printf('%03d', page) AS id, document_id, page, summary,
       'parsed-pages/' || document_id || '/' || page || '.json' AS text_blob
FROM ps_t""",
    "summary_index": f"""WITH {pages_cte()}, {summaries_cte()}, {doc_summaries_cte()}
SELECT d.document_id AS id, d.document_id, d.summary_blob AS final_summary_blob, coalesce(u.units, 0) AS units
FROM ds_t d LEFT JOIN (SELECT document_id, count(*) AS units FROM ps_t GROUP BY 1) u ON d.document_id = u.document_id""",
    "corpus_overview": f"""WITH {base()}
SELECT status, count(*) AS documents, CAST(sum(page_count) AS BIGINT) AS pages,
       CAST(sum(failed_page_count) AS BIGINT) AS failed_pages
FROM idx_t GROUP BY 1""",
    "render_markdown": RENDER,
}


# ---------------------------------------------------------------- chunks, records, retrieval

DIM = 1 << 18


def chunks_cte(src: str, name: str = "ch", max_tokens: int = 100, overlap: int = 20) -> str:
    step = max_tokens - overlap
    return rf"""
{name}_t AS (
  SELECT document_id, page_number,
         list_filter(regexp_split_to_array(content, '[ \t\n\r]+'), lambda x: x <> '') AS toks
  FROM {src}
),
{name}_s AS (
  SELECT document_id, page_number, toks, len(toks) AS n,
         unnest(generate_series(0, greatest(0, len(toks) - {overlap} - 1), {step})) AS start_token
  FROM {name}_t WHERE len(toks) > 0
),
{name} AS (
  SELECT document_id, page_number, CAST(start_token // {step} AS INTEGER) AS chunk_number,
         array_to_string(list_slice(toks, start_token + 1, start_token + {max_tokens}), ' ') AS text,
         CAST(least({max_tokens}, n - start_token) AS INTEGER) AS token_count,
         CAST(start_token AS INTEGER) AS start_token,
         CAST(least(start_token + {max_tokens}, n) AS INTEGER) AS end_token,
         CAST(coalesce(list_sum(list_transform(list_slice(toks, 1, start_token), lambda x: length(x))), 0) + start_token AS INTEGER) AS start_offset
  FROM {name}_s
)"""


RECORDS = f"""
ok_pages AS (
  SELECT document_id, page AS page_number, summary FROM ps_t
  WHERE status = 'success' AND summary IS NOT NULL AND summary <> ''
),
chunk_src AS (
  SELECT p.document_id, p.page_number, p.content FROM pages_t p
  JOIN ok_pages o ON p.document_id = o.document_id AND p.page_number = o.page_number
  WHERE p.content IS NOT NULL AND p.content <> ''
),
{chunks_cte('chunk_src', 'rch')},
recs AS (
  SELECT document_id || '_doc' AS id, 'document' AS level, document_id, CAST(NULL AS INTEGER) AS page_number,
         CAST(NULL AS INTEGER) AS paragraph_number, summary AS text FROM ds_t WHERE status = 'success'
  UNION ALL
  SELECT document_id || '_page_' || page_number, 'page', document_id, page_number, NULL, summary FROM ok_pages
  UNION ALL
  SELECT document_id || '_page_' || page_number || '_para_' || chunk_number, 'paragraph', document_id, page_number,
         chunk_number, text FROM rch
)"""


def tv_cte(src: str, key: str, name: str) -> str:
    """Hashed term counts and squared norms of ``src(key, text)``."""
    return f"""
{name} AS (
  SELECT {key}, bucket, count(*) AS tf FROM (
    SELECT {key}, ('0x' || substr(md5(t), 1, 8))::BIGINT % {DIM} AS bucket
    FROM (SELECT {key}, unnest(regexp_extract_all(lower(text), {TERM}, 0)) AS t FROM {src}))
  GROUP BY 1, 2
),
{name}_n AS (SELECT {key}, sum(tf * tf) AS n2 FROM {name} GROUP BY 1)"""


def scores_cte(q: str = "qv", d: str = "dv", name: str = "sc") -> str:
    """Cosine of every (question, record) pair sharing a bucket, with record columns."""
    return f"""
{name} AS (
  SELECT x.qid, x.id, x.dot / (sqrt(qn.n2) * sqrt(dn.n2)) AS score,
         r.level, r.document_id, r.page_number, r.paragraph_number, r.text
  FROM (SELECT q.qid, d.id, sum(q.tf * d.tf) AS dot FROM {q} q JOIN {d} d ON q.bucket = d.bucket GROUP BY 1, 2) x
  JOIN {q}_n qn ON x.qid = qn.qid JOIN {d}_n dn ON x.id = dn.id JOIN recs r ON x.id = r.id
)"""


QUESTIONS = "qs AS (SELECT item_id AS qid, text FROM benchmark)"


def search_base() -> str:
    return f"""WITH {base()},
{RECORDS},
{tv_cte('recs', 'id', 'dv')},
{QUESTIONS},
{tv_cte('qs', 'qid', 'qv')},
{scores_cte()}"""


def ranked(src: str, where: str, k: int, per: str = "qid") -> str:
    return f"""(SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY {per} ORDER BY score DESC, id) AS INTEGER) AS rank
   FROM {src} WHERE {where}) WHERE rank <= {k})"""


SECTIONS = r"""
heads AS (
  SELECT document_id, page_number, trim(regexp_extract(content, '^([^\n]*)', 1), ' ') AS section,
         max(page_number) OVER (PARTITION BY document_id) AS last_page FROM pages_t),
sections AS (
  SELECT document_id, section, page_number AS start_page,
         CAST(coalesce(lead(page_number) OVER (PARTITION BY document_id ORDER BY page_number), last_page + 1) AS INTEGER) AS end_page
  FROM heads WHERE len(regexp_extract_all(section, '[^ \t\r]+')) BETWEEN 1 AND 6)"""

TARGETS = f"""
best_doc AS {ranked('sc', "level = 'document'", 1)},
tg AS (SELECT qid, document_id FROM best_doc)"""

DENSE = """WITH v AS (
  SELECT 'vec-' || label || '_page_' || vec_id AS id, 'vec-' || label AS document_id, embedding FROM embeddings
),
cm AS (
  SELECT document_id, pos, avg(CAST(x AS DOUBLE)) AS m FROM (
    SELECT document_id, unnest(generate_series(1, len(embedding))) AS pos, unnest(embedding) AS x FROM v) GROUP BY 1, 2
),
cq AS (SELECT document_id AS qid, list(m ORDER BY pos) AS q FROM cm GROUP BY 1),
pv AS (
  SELECT id, document_id, embedding,
         sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) AS vn FROM v
),
qn AS (SELECT qid, q, sqrt(list_sum(list_transform(q, lambda x: x * x))) AS qn FROM cq),
sc AS (
  SELECT qn.qid, pv.id, pv.document_id,
         CASE WHEN pv.vn = 0 OR qn.qn = 0 THEN 0.0
              ELSE list_sum(list_transform(generate_series(1, len(q)), lambda i: CAST(pv.embedding[i] AS DOUBLE) * q[i])) / (pv.vn * qn.qn) END AS score
  FROM pv, qn
)
SELECT qid, rank, id, document_id, round(score, 6) AS score FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS INTEGER) AS rank FROM sc) WHERE rank <= 5"""

MULTI_LEVEL = f"""{search_base()},
d3 AS {ranked('sc', "level = 'document' AND score >= 0", 3)},
p5 AS {ranked('sc', "level = 'page' AND score >= 0 AND (qid, document_id) IN (SELECT qid, document_id FROM d3)", 5)},
a3 AS {ranked('sc', "level = 'paragraph' AND score >= 0 AND (qid, document_id, page_number) IN (SELECT qid, document_id, page_number FROM p5)", 3)}
SELECT a.qid, a.rank, a.id, a.document_id, a.page_number, a.paragraph_number, round(a.score, 6) AS score,
       round(p.score, 6) AS page_score, round(d.score, 6) AS doc_score
FROM a3 a JOIN p5 p ON a.qid = p.qid AND a.document_id = p.document_id AND a.page_number = p.page_number
JOIN d3 d ON a.qid = d.qid AND a.document_id = d.document_id"""

ANSWER = f"""{search_base()},
{TARGETS},
p5 AS {ranked('sc', "level = 'page' AND (qid, document_id) IN (SELECT qid, document_id FROM tg)", 5)},
dec AS (
  SELECT q.qid, b.top_score,
         CASE WHEN b.top_score IS NULL THEN NULL WHEN b.top_score > 0.85 THEN 'summary' ELSE 'detailed' END AS detail_level
  FROM qs q LEFT JOIN (SELECT qid, max(score) AS top_score FROM p5 GROUP BY 1) b ON q.qid = b.qid
),
a8 AS {ranked('sc', "level = 'paragraph' AND (qid, document_id, page_number) IN (SELECT qid, document_id, page_number FROM p5)", 8)},
items AS (
  SELECT qid, rank, text, 'Page ' || page_number || ': ' || text AS item, 'Page ' || page_number AS source, 'summary' AS kind
  FROM p5 WHERE rank <= 3
  UNION ALL
  SELECT qid, rank, text, '[Page ' || page_number || ', ¶' || paragraph_number || ']' || {NL} || text,
         'Page ' || page_number || ', ¶' || paragraph_number, 'detailed' FROM a8
),
chosen AS (SELECT i.* FROM items i JOIN dec d ON i.qid = d.qid AND i.kind = d.detail_level),
agg AS (
  SELECT qid, string_agg(item, {NL} || {NL} ORDER BY rank) AS context, string_agg(source, '; ' ORDER BY rank) AS sources,
         max(CASE WHEN rank = 1 THEN {lead('text', 2)} END) AS lead
  FROM chosen GROUP BY 1
)
SELECT d.qid, d.detail_level, round(coalesce(d.top_score, 0.0), 6) AS confidence,
       CASE WHEN d.top_score IS NULL THEN 'No relevant information found.' ELSE a.lead END AS answer,
       coalesce(a.context, '') AS context, coalesce(a.sources, '') AS sources
FROM dec d LEFT JOIN agg a ON d.qid = a.qid"""

COMPARE = f"""WITH {base()},
{RECORDS},
{tv_cte('recs', 'id', 'dv')},
qa AS (SELECT item_id AS qid, {lead('text', 1)} AS text FROM benchmark),
qb AS (SELECT item_id AS qid, text FROM benchmark),
{tv_cte('qa', 'qid', 'qav')},
{tv_cte('qb', 'qid', 'qbv')},
{scores_cte('qav', 'dv', 'sca')},
{scores_cte('qbv', 'dv', 'scb')},
pa AS {ranked('sca', "level = 'page'", 10)},
ra AS {ranked('sca', "level = 'paragraph' AND (qid, document_id, page_number) IN (SELECT qid, document_id, page_number FROM pa)", 5)},
rb AS {ranked('scb', "level = 'paragraph' AND (qid, document_id, page_number) IN (SELECT qid, document_id, page_number FROM pa)", 5)}
SELECT coalesce(ra.qid, rb.qid) AS qid, coalesce(ra.rank, rb.rank) AS rank, ra.id AS id_a, round(ra.score, 6) AS score_a,
       rb.id AS id_b, round(rb.score, 6) AS score_b
FROM ra FULL OUTER JOIN rb ON ra.qid = rb.qid AND ra.rank = rb.rank"""

DOC_TERMS = f"d AS (SELECT 'doc-' || doc_id AS document_id, text FROM documents)"

PASSAGES = f"""{pages_cte()},
pt AS (
  SELECT document_id, page_number, unnest(ts) AS term, generate_subscripts(ts, 1) AS k
  FROM (SELECT document_id, page_number, regexp_extract_all(lower(content), {TERM}, 0) AS ts FROM pages_t)),
tt AS (SELECT document_id, page_number, term, row_number() OVER (PARTITION BY document_id ORDER BY page_number, k) - 1 AS pos FROM pt),
gr AS (
  SELECT document_id, pos, page_number, seed, h, max(pos) OVER (PARTITION BY document_id) AS last FROM (
    SELECT document_id, pos, page_number, ('0x' || substr(md5(string_agg(term, ' ') OVER f), 1, 15))::BIGINT AS seed,
           ('0x' || substr(md5(term), 1, 8))::BIGINT AS h, count(*) OVER f AS n
    FROM tt WINDOW f AS (PARTITION BY document_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 11 FOLLOWING)) WHERE n = 12),
wi AS (
  SELECT document_id, pos, last, min({{'h': h, 'pos': pos}}) OVER (
    PARTITION BY document_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 8 FOLLOWING) AS least FROM gr),
ch AS (SELECT DISTINCT document_id, least.pos AS pos FROM wi WHERE pos <= greatest(0, last - 8)),
fo AS (
  SELECT document_id, pos, page_number, seed, lag(seed) OVER d AS before, pos - lag(pos) OVER d AS gap_before,
         lead(seed) OVER d AS after, lead(pos) OVER d - pos AS gap_after
  FROM ch JOIN gr USING (document_id, pos) WINDOW d AS (PARTITION BY document_id ORDER BY pos)),
cl AS (
  SELECT seed, count(*) AS n_members, min({{'d': document_id, 'p': pos}}) AS first,
         CASE WHEN count(before) = count(*) AND min(before) = max(before) AND min(gap_before) = max(gap_before) THEN min(before) END AS before,
         CASE WHEN count(after) = count(*) AND min(after) = max(after) AND min(gap_after) = max(gap_after) THEN min(after) END AS after
  FROM fo GROUP BY seed HAVING count(*) > 1),
pa AS (
  SELECT *, coalesce(lag(seed) OVER l = before AND lag(after) OVER l = seed, FALSE) AS goes_on
  FROM cl WINDOW l AS (PARTITION BY first.d ORDER BY first.p)),
cn AS (SELECT *, count(*) FILTER (NOT goes_on) OVER (PARTITION BY first.d ORDER BY first.p) AS chain FROM pa),
passages AS (
  SELECT first.d || '@' || min(first.p) AS passage_id, max(n_members) AS n_members,
         CAST(max(first.p) - min(first.p) + 12 AS INTEGER) AS n_terms, arg_min(seed, first.p) AS seed
  FROM cn GROUP BY first.d, chain)"""

SIMILAR = f"""
{DOC_TERMS},
keyed AS (
  SELECT document_id, s, md5(array_to_string(list_sort(s), ' ')) AS set_key
  FROM (SELECT document_id, list_distinct(regexp_extract_all(lower(text), {TERM}, 0)) AS s FROM d)
  WHERE len(s) > 0
),
grp AS (SELECT set_key, min(document_id) AS rep, count(*) AS copies FROM keyed GROUP BY 1),
sets AS (SELECT k.document_id, k.s, g.copies FROM keyed k JOIN grp g ON k.document_id = g.rep),
flat AS (SELECT document_id, unnest(s) AS term FROM sets),
inter AS (
  SELECT a.document_id AS id_a, b.document_id AS id_b, count(*) AS shared
  FROM flat a JOIN flat b ON a.term = b.term AND a.document_id < b.document_id GROUP BY 1, 2
),
sim AS (
  SELECT i.id_a, i.id_b, CAST(i.shared AS INTEGER) AS shared,
         CAST(len(sa.s) + len(sb.s) - i.shared AS INTEGER) AS union_size,
         i.shared / (len(sa.s) + len(sb.s) - i.shared) AS jaccard,
         sa.copies AS copies_a, sb.copies AS copies_b
  FROM inter i JOIN sets sa ON i.id_a = sa.document_id JOIN sets sb ON i.id_b = sb.document_id
  WHERE i.shared / (len(sa.s) + len(sb.s) - i.shared) >= 0.8
)"""

#: The same pairs by length and prefix bounds first, so few term sets are compared.
SIMILAR_BY_PREFIX = SIMILAR[:SIMILAR.index("flat AS")] + """flat AS (SELECT document_id, unnest(s) AS term, len(s) AS n FROM sets),
freq AS (SELECT term, count(*) AS f FROM flat GROUP BY 1),
pre AS MATERIALIZED (
  SELECT document_id, term, n FROM flat JOIN freq USING (term)
  QUALIFY row_number() OVER (PARTITION BY document_id ORDER BY f, term) <= n - ceil(0.8 * n - 1e-9) + 1),
cand AS MATERIALIZED (
  SELECT DISTINCT a.document_id AS id_a, b.document_id AS id_b FROM pre a JOIN pre b ON a.term = b.term AND a.document_id < b.document_id
  WHERE least(a.n, b.n) >= 0.8 * greatest(a.n, b.n) - 1e-9),
inter AS (
  SELECT id_a, id_b, len(list_intersect(x.s, y.s)) AS shared FROM cand JOIN sets x ON x.document_id = id_a JOIN sets y ON y.document_id = id_b),
""" + SIMILAR[SIMILAR.index("sim AS ("):].replace("sim AS (", "sim AS MATERIALIZED (")

#: The same of every record instead of one per term set: identical sets are pairs as well.
SIMILAR_RECORDS = SIMILAR_BY_PREFIX.replace("JOIN grp g ON k.document_id = g.rep", "JOIN grp g ON k.set_key = g.set_key")


TOPICS = f"""
tpt AS (SELECT document_id, unnest(regexp_extract_all(lower(content), {TERM}, 0)) AS term FROM pages_t),
tptf AS (SELECT document_id, term, count(*) AS tf FROM tpt GROUP BY 1, 2),
tpdf AS (SELECT term, count(*) AS df FROM tptf GROUP BY 1),
tpn AS (SELECT count(DISTINCT document_id) AS n FROM pages_t),
tp AS (
  SELECT * FROM (
    SELECT tptf.document_id, tptf.term,
           row_number() OVER (PARTITION BY tptf.document_id ORDER BY tf * ln(tpn.n / tpdf.df) DESC, tptf.term) AS rank
    FROM tptf JOIN tpdf ON tptf.term = tpdf.term CROSS JOIN tpn) WHERE rank <= 5
),
about AS (
  SELECT document_id FROM tp
  WHERE term = (SELECT term FROM tp GROUP BY term ORDER BY count(*) DESC, term LIMIT 1)
)"""

ORACLE.update(
    {
        "document_topics": f"""WITH {pages_cte()}, {TOPICS}
SELECT document_id, string_agg(term, ',' ORDER BY rank) AS topics FROM tp GROUP BY 1""",
        "metadata_topic": f"""{search_base()}, {TOPICS}
SELECT qid, rank, id, round(score, 6) AS score
FROM {ranked('sc', "level = 'page' AND document_id IN (SELECT document_id FROM about)", 5)}""",
        "metadata_section": f"""{search_base()}, {SECTIONS},
inside AS (
  SELECT DISTINCT p.document_id, p.page_number FROM pages_t p
  JOIN sections s ON p.document_id = s.document_id AND p.page_number >= start_page AND p.page_number < end_page
  WHERE contains(lower(section), 'the'))
SELECT qid, rank, id, round(score, 6) AS score
FROM {ranked('sc', "level = 'page' AND (document_id, page_number) IN (SELECT document_id, page_number FROM inside)", 5)}""",
        "page_sections": f"""WITH {pages_cte()}, {SECTIONS}
SELECT document_id, section, start_page, end_page FROM sections""",
        "metadata_tables": rf"""{search_base()},
tb AS (SELECT document_id, page_number FROM pages_t WHERE regexp_matches(content, '(?m)^[^|\n]*\|[^|\n]*\|[^\n]*$')),
hit AS {ranked('sc', "level = 'paragraph' AND (document_id, page_number) IN (SELECT document_id, page_number FROM tb)", 5)}
SELECT h.qid, h.rank, h.id, round(h.score, 6) AS score, true AS has_tables, regexp_matches(h.text, '[0-9]') AS contains_numbers,
       c.start_offset, CAST(c.start_offset + length(c.text) AS INTEGER) AS end_offset
FROM hit h JOIN rch c ON h.document_id = c.document_id AND h.page_number = c.page_number AND h.paragraph_number = c.chunk_number""",
        "compare_topic": COMPARE.replace("pa AS (SELECT", TOPICS.strip() + ",\npa AS (SELECT", 1)
        .replace("level = 'page'", "level = 'page' AND document_id IN (SELECT document_id FROM about)"),
        "chunks": f"""WITH {pages_cte()}, {chunks_cte('pages_t', 'ch')}
SELECT document_id, page_number, chunk_number, text, token_count, start_token, end_token FROM ch""",
        "chunk_metadata": f"""WITH {pages_cte()}, {chunks_cte('pages_t', 'ch')}
SELECT document_id, page_number, chunk_number, regexp_matches(text, '[0-9]') AS contains_numbers,
       CAST(length(text) AS INTEGER) AS char_count, start_offset, CAST(start_offset + length(text) AS INTEGER) AS end_offset
FROM ch""",
        "page_metadata": rf"""WITH {pages_cte()}
SELECT document_id, page_number,
       coalesce(regexp_matches(content, '(?m)^[^|\n]*\|[^|\n]*\|[^\n]*$'), false) AS has_tables,
       coalesce(regexp_matches(content, '[=≈≤≥±∑∫√]|\$[^$\n]+\$'), false) AS has_formulas
FROM pages_t""",
        "embedding_levels": f"""WITH {base()}, {RECORDS}
SELECT document_id, count(*) AS embedding_count,
       count(*) FILTER (WHERE level = 'document') AS document_level,
       count(*) FILTER (WHERE level = 'page') AS page_level,
       count(*) FILTER (WHERE level = 'paragraph') AS paragraph_level
FROM recs GROUP BY 1""",
        "token_cost_rollup": rf"""WITH {base()}, {RECORDS},
tk AS (SELECT level, document_id, len(list_filter(regexp_split_to_array(text, '[ \t\n\r]+'), lambda x: x <> '')) AS tokens FROM recs)
SELECT level, document_id, CAST(sum(tokens) AS BIGINT) AS tokens,
       CAST(CAST(CAST(sum(tokens) AS DECIMAL(38,0)) * 130000 / 1000000 AS DECIMAL(38,6)) AS VARCHAR) AS cost_micro_usd,
       count(*) AS records
FROM tk GROUP BY ROLLUP (level, document_id)""",
        "sparse_search": f"""{search_base()}
SELECT qid, rank, id, document_id, page_number, round(score, 6) AS score FROM {ranked('sc', "level = 'page'", 5)}""",
        "dense_topk": DENSE,
        "multi_level_search": MULTI_LEVEL,
        "discover": f"""{search_base()}
SELECT qid, document_id, round(score, 6) AS score FROM {ranked('sc', "level = 'document'", 1)}""",
        "localize_topic": f"""{search_base()}, {TARGETS}
SELECT qid, rank, document_id, page_number, round(score, 6) AS score
FROM {ranked('sc', "level = 'page' AND (qid, document_id) IN (SELECT qid, document_id FROM tg)", 10)}""",
        "cite": f"""{search_base()}, {TARGETS},
p5 AS {ranked('sc', "level = 'page' AND (qid, document_id) IN (SELECT qid, document_id FROM tg)", 5)}
SELECT qid, rank, document_id, page_number, paragraph_number, text, round(score, 6) AS score
FROM {ranked('sc', "level = 'paragraph' AND (qid, document_id, page_number) IN (SELECT qid, document_id, page_number FROM p5)", 3)}""",
        "compare": COMPARE,
        "compare_documents": f"""{search_base()},
good AS (SELECT 'doc-' || doc_id AS document_id FROM labels WHERE quality = 1)
SELECT qid, document_id, rank, id, round(score, 6) AS score
FROM {ranked('sc', "level = 'page' AND document_id IN (SELECT document_id FROM good)", 2, 'qid, document_id')}""",
        "rank_documents": f"""{search_base()}
SELECT qid, rank, document_id, round(score, 6) AS score, substr(text, 1, 200) AS excerpt
FROM {ranked('sc', "level = 'document'", 5)}""",
        "metadata_search": f"""{search_base()}
SELECT qid, rank, id, round(score, 6) AS score FROM {ranked('sc', "level = 'page' AND page_number BETWEEN 2 AND 5", 5)}""",
        "choose_detail": f"""{search_base()}, {TARGETS},
p5 AS {ranked('sc', "level = 'page' AND (qid, document_id) IN (SELECT qid, document_id FROM tg)", 5)}
SELECT q.qid,
       CASE WHEN b.top_score IS NULL THEN NULL WHEN b.top_score > 0.85 THEN 'summary' ELSE 'detailed' END AS detail_level,
       round(coalesce(b.top_score, 0.0), 6) AS confidence,
       CASE WHEN b.top_score IS NULL THEN 'No relevant information found.' END AS fixed_answer
FROM qs q LEFT JOIN (SELECT qid, max(score) AS top_score FROM p5 GROUP BY 1) b ON q.qid = b.qid""",
        "answer_context": ANSWER,
        "mentions": f"""WITH {pages_cte()}, ph AS (SELECT item_id AS pid, regexp_extract_all(lower(text), {TERM}, 0) AS pt FROM benchmark),
dd AS (SELECT 'doc-' || doc_id AS document_id, regexp_extract_all(lower(text), {TERM}, 0) AS dt FROM documents),
ends AS (
  SELECT document_id, sum(n) OVER (PARTITION BY document_id ORDER BY page_number) - n AS first
  FROM (SELECT document_id, page_number, len(regexp_extract_all(lower(content), {TERM}, 0)) AS n FROM pages_t)
),
c AS (
  SELECT pid, document_id, pt, dt, unnest(generate_series(0, len(dt) - len(pt))) AS pos
  FROM ph JOIN dd ON len(pt) > 0 AND len(dt) >= len(pt)
   AND contains(' ' || array_to_string(dt, ' ') || ' ', ' ' || array_to_string(pt, ' ') || ' ')
)
SELECT pid, c.document_id, CAST(pos AS INTEGER) AS term_position,
       (SELECT CAST(count(*) AS INTEGER) FROM ends e WHERE e.document_id = c.document_id AND e.first <= c.pos) AS page_number,
       array_to_string(list_slice(dt, greatest(1, pos + 1 - 5), pos + len(pt) + 5), ' ') AS context
FROM c WHERE list_slice(dt, pos + 1, pos + len(pt)) = pt""",
        "amounts": rf"""WITH {pages_cte()},
m AS (SELECT document_id, TRY_CAST(replace(unnest(regexp_extract_all(content, '[0-9]{{1,3}}(?:,[0-9]{{3}})+(?:\.[0-9]+)?|[0-9]+(?:\.[0-9]+)?', 0)), ',', '') AS DECIMAL(38,4)) AS amount FROM pages_t)
SELECT document_id, count(*) AS n_amounts, count(*) FILTER (WHERE amount IS NULL) AS n_unparsed,
       CAST(CAST(sum(amount) AS DECIMAL(38,4)) AS VARCHAR) AS total, CAST(max(amount) AS VARCHAR) AS largest
FROM m GROUP BY 1""",
        "similar_sections": f"""WITH {SIMILAR.strip()}
SELECT id_a, id_b, shared, union_size, round(jaccard, 6) AS jaccard, copies_a, copies_b FROM sim""",
        "duplicate_groups": f"""WITH {SIMILAR.strip()}
SELECT k.document_id AS member, g.rep AS representative, g.copies
FROM keyed k JOIN grp g ON k.set_key = g.set_key WHERE g.copies > 1""",
        "shared_passages": f"""WITH {PASSAGES} SELECT passage_id, n_members, n_terms FROM passages""",
        "passage_members": f"""WITH {PASSAGES}
SELECT passage_id, document_id, CAST(pos AS INTEGER) AS start_term, page_number FROM fo JOIN passages USING (seed)""",
        "amounts_by_year": rf"""WITH {pages_cte()},
m AS (
  SELECT document_id, page_number, unnest(ms) AS mention, generate_subscripts(ms, 1) AS k
  FROM (SELECT document_id, page_number, regexp_extract_all(content, '[0-9]{{1,3}}(?:,[0-9]{{3}})+(?:\.[0-9]+)?|[0-9]+(?:\.[0-9]+)?', 0) AS ms FROM pages_t)),
y AS (
  SELECT *, regexp_full_match(mention, '(?:19|20)[0-9]{{2}}') AS is_year FROM m),
z AS (
  SELECT document_id, is_year, TRY_CAST(replace(mention, ',', '') AS DECIMAL(38,4)) AS amount,
         last_value(CASE WHEN is_year THEN CAST(mention AS INTEGER) END IGNORE NULLS) OVER (
           PARTITION BY document_id ORDER BY page_number, k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS year FROM y)
SELECT document_id, year, count(*) AS n_amounts, count(*) FILTER (WHERE amount IS NULL) AS n_unparsed,
       CAST(CAST(sum(amount) AS DECIMAL(38,4)) AS VARCHAR) AS total
FROM z WHERE NOT is_year GROUP BY 1, 2""",
        "version_lines": f"""WITH RECURSIVE {SIMILAR_RECORDS.strip()},
sides AS (SELECT id_a AS v1, id_b AS v2, 1 AS side, id_a AS document_id FROM sim UNION ALL SELECT id_a, id_b, 2, id_b FROM sim),
ln AS (SELECT document_id, unnest(ls) AS content, CAST(generate_subscripts(ls, 1) AS INTEGER) AS line
       FROM (SELECT document_id, string_split(text, {NL}) AS ls FROM d)),
r AS MATERIALIZED (SELECT v1, v2, side, line, md5(content) AS h FROM sides JOIN ln USING (document_id)),
an AS MATERIALIZED (
  SELECT v1, v2, max(line) FILTER (side = 1) AS line1, max(line) FILTER (side = 2) AS line2
  FROM r GROUP BY v1, v2, h HAVING count(*) FILTER (side = 1) = 1 AND count(*) FILTER (side = 2) = 1),
lv AS (
  SELECT v1, v2, line1, line2, 1 AS k FROM an
  UNION SELECT b.v1, b.v2, b.line1, b.line2, a.k + 1 FROM lv a JOIN an b ON a.v1 = b.v1 AND a.v2 = b.v2 AND b.line1 > a.line1 AND b.line2 > a.line2),
pile AS MATERIALIZED (SELECT v1, v2, line1, line2, max(k) AS k FROM lv GROUP BY ALL),
pred AS MATERIALIZED (
  SELECT b.v1, b.v2, b.line1, max(a.line1) AS before FROM pile b
  JOIN pile a ON a.v1 = b.v1 AND a.v2 = b.v2 AND a.k = b.k - 1 AND a.line1 < b.line1 GROUP BY 1, 2, 3),
spine AS (
  SELECT v1, v2, max(line1) AS line1 FROM pile WHERE (v1, v2, k) IN (SELECT (v1, v2, max(k)) FROM pile GROUP BY v1, v2) GROUP BY 1, 2
  UNION ALL SELECT s.v1, s.v2, p.before FROM spine s JOIN pred p ON p.v1 = s.v1 AND p.v2 = s.v2 AND p.line1 = s.line1),
marked AS (SELECT an.*, spine.line1 IS NOT NULL AS in_order FROM an LEFT JOIN spine USING (v1, v2, line1)),
placed AS (
  SELECT r.*, m.in_order, count(*) FILTER (coalesce(m.in_order, FALSE)) OVER (PARTITION BY r.v1, r.v2, side ORDER BY line) AS gap
  FROM r LEFT JOIN marked m ON m.v1 = r.v1 AND m.v2 = r.v2 AND line = CASE WHEN side = 1 THEN m.line1 ELSE m.line2 END),
rest AS (SELECT *, row_number() OVER (PARTITION BY v1, v2, side, gap ORDER BY line) AS k FROM placed WHERE in_order IS NULL),
x AS (SELECT v1, v2, gap, k, line AS line1, h AS h1 FROM rest WHERE side = 1),
y AS (SELECT v1, v2, gap, k, line AS line2, h AS h2 FROM rest WHERE side = 2)
SELECT v1, v2, CASE WHEN h1 IS NULL THEN 'inserted' WHEN h2 IS NULL THEN 'deleted' ELSE 'changed' END AS change, line1, line2
FROM x FULL JOIN y USING (v1, v2, gap, k) WHERE h1 IS DISTINCT FROM h2
UNION ALL SELECT v1, v2, 'moved', line1, line2 FROM marked WHERE NOT in_order""",
        "version_diff": f"""WITH {pages_cte()}, {SIMILAR_RECORDS.strip()},
l AS (SELECT s.id_a AS v1, s.id_b AS v2, g.page_number, md5(g.content) AS h1 FROM sim s JOIN pages_t g ON g.document_id = s.id_a),
r AS (SELECT s.id_a AS v1, s.id_b AS v2, g.page_number, md5(g.content) AS h2 FROM sim s JOIN pages_t g ON g.document_id = s.id_b)
SELECT coalesce(l.v1, r.v1) AS v1, coalesce(l.v2, r.v2) AS v2, coalesce(l.page_number, r.page_number) AS page_number,
       CASE WHEN l.h1 IS NULL THEN 'added' WHEN r.h2 IS NULL THEN 'removed' WHEN l.h1 = r.h2 THEN 'same' ELSE 'changed' END AS change
FROM l FULL OUTER JOIN r ON l.v1 = r.v1 AND l.v2 = r.v2 AND l.page_number = r.page_number""",
        "topics": f"""WITH {DOC_TERMS},
t AS (SELECT document_id, unnest(regexp_extract_all(lower(text), {TERM}, 0)) AS term FROM d),
tf AS (SELECT document_id, term, count(*) AS tf FROM t GROUP BY 1, 2),
dfq AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
n AS (SELECT count(DISTINCT document_id) AS n FROM d),
s AS (SELECT tf.document_id, tf.term, tf.tf * ln(n.n / dfq.df) AS score FROM tf JOIN dfq ON tf.term = dfq.term CROSS JOIN n)
SELECT document_id, rank, term, round(score, 6) AS score FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY document_id ORDER BY score DESC, term) AS INTEGER) AS rank FROM s)
WHERE rank <= 5""",
        "section_of_page": """WITH r AS (
  SELECT regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS document_id, page_id AS page_number,
         regexp_extract(html, '<h1[^>]*>([^<]*)</h1>', 1) AS h FROM pages
)
SELECT document_id, page_number,
       last_value(nullif(h, '') IGNORE NULLS)
         OVER (PARTITION BY document_id ORDER BY page_number ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS section
FROM r""",
        "audit_trail": f"""WITH {base()},
{pages_cte(20, 'p20')},
{summaries_cte('p20', 'ps20')},
{doc_summaries_cte('ps20', 'ds20')},
{totals_cte(20, 'tot20')},
{result_cte('ps20', 'ds20', 'tot20', 'res20')},
{index_cte('res20', 'idx20', '2025-02-01T12:00:00')},
{chat_ctes('2025-02-01T12:00:00')},
runs AS (
  SELECT id, status, updated_at, CAST(1 AS INTEGER) AS run FROM idx_t
  UNION ALL SELECT id, status, updated_at, 2 FROM idx20
  UNION ALL SELECT id, status, updated_at, 3 FROM cidx
)
SELECT id, run, status,
       CAST(row_number() OVER (PARTITION BY id ORDER BY updated_at, run) AS INTEGER) AS attempt,
       lag(status) OVER (PARTITION BY id ORDER BY updated_at, run) AS previous_status,
       row_number() OVER (PARTITION BY id ORDER BY updated_at DESC, run DESC) = 1 AS is_latest
FROM runs""",
    }
)


ORACLE.update(
    {
        "stream_intake": ORACLE["page_summaries"],
        "stream_upsert": ORACLE["doc_index"],
        "stream_progress": f"""WITH {pages_cte()}
SELECT document_id, count(*) AS completed_pages, count(*) AS total_pages FROM pages_t GROUP BY 1""",
        "page_progress": f"""WITH {pages_cte()},
w AS (SELECT document_id, unnest([0, 1, 2]) AS wave, page_number FROM pages_t)
SELECT document_id, wave, count(*) FILTER (page_number % 3 <= wave) AS completed_pages, count(*) AS total_pages,
       CASE WHEN count(*) FILTER (page_number % 3 <= wave) = count(*) THEN 'complete' ELSE 'running' END AS status
FROM w GROUP BY 1, 2""",
        "stream_dedupe": "SELECT DISTINCT 'doc-' || doc_id AS document_id, CAST(length(text) AS INTEGER) AS n_chars FROM documents",
        "summarize_with_retry": rf"""WITH {pages_cte()},
c AS (SELECT document_id, page_number AS page, content, NOT regexp_matches(content, '[^ \t\n\r\f\v]') AS blank,
             ('0x' || substr(md5(content), 1, 8))::BIGINT % 7 AS failures FROM pages_t)
SELECT document_id, page,
       CASE WHEN blank THEN 'skipped' WHEN failures >= 5 THEN 'failed' ELSE 'success' END AS status,
       CASE WHEN blank THEN {BLANK_TEXT} WHEN failures >= 5 THEN NULL
            ELSE trim(regexp_replace(coalesce(regexp_extract(content, {SENT}, 0), ''), {SPACE_RUN}, ' ', 'g')) END AS summary,
       CASE WHEN NOT blank AND failures >= 5 THEN 'invalid model response' END AS error,
       CASE WHEN NOT blank AND failures >= 5 THEN 'permanent' ELSE 'unknown' END AS error_category,
       CAST(CASE WHEN blank THEN 0 ELSE least(failures + 1, 5) END AS INTEGER) AS attempts
FROM c""",
    }
)
