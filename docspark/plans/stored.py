"""Registered queries over stored files, legacy results, regenerated and failed pages,
with their SQL twins. Every input is derived from a whole given table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import embed as X
from ..operators import index
from ..operators import pages as P
from ..operators import render as R
from ..operators import report as A
from ..operators import summarize as Z
from ..session import ensure_checkpoint_dir, materialize, table
from ..sources import corpus, files, intake
from . import oracle as O
from .incremental import update_corpus
from .process import process_corpus, store_processed
from .regenerate import regenerate_corpus

GENERATED_AT = "2025-01-01 00:00:00"
LINES = 10
DENSE_DIM = 64


def _pages(spark, sf_dir):
    return P.split_pages(corpus.documents_corpus(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), LINES))


def _folder(spark, name):
    import uuid

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/files/{name}-{uuid.uuid4().hex}"


def flaky_model():
    """A stand-in for a hosted model: each text fails as many times as its content hash
    says (0 to 6), with a transient error below three and a permanent one from there on,
    then answers with its first sentence. Any text can be of any length."""
    import hashlib
    import re

    calls: dict[str, int] = {}

    def model(text: str) -> str:
        key = hashlib.md5(text.encode()).hexdigest()
        failures, call = int(key[:8], 16) % 7, calls.get(key, 0)
        calls[key] = (call + 1) % min(failures + 1, 5)  # the next page with this text starts anew
        if call < failures:
            raise ValueError("model unavailable" if call < 3 else "invalid model response")
        m = re.search(r"[^ \t\n\r.!?][^.!?]*[.!?]*", text)
        return "" if m is None else re.sub(r"[ \t\n\r]+", " ", m.group(0))

    return model


def _flaky_summaries(spark, sf_dir):
    return materialize(Z.summarize_with(_pages(spark, sf_dir), flaky_model(), max_attempts=5))


# ------------------------------------------------------------------ files

def q_page_files(spark, sf_dir):
    """Every page written as JSON by key, the first pages rewritten, read back."""
    root = _folder(spark, "pages")
    rows = _pages(spark, sf_dir)
    old = rows.withColumn("content", F.when(F.col("page_number") == 1, F.lit("old")).otherwise(F.col("content")))
    files.write_json(old, root, buckets=8)
    files.write_json(rows.where("page_number = 1"), root, buckets=8)
    stored = spark.read.schema(rows.schema).json(root)
    return stored.select("document_id", "page_number", "blob_path", "content", "length")


def _second_run(spark, sf_dir):
    """A run over an earlier state of the pages (of a hundred, one differs, one is missing
    and one document has a page more), then a run over the pages as they are."""
    root, now = _folder(spark, "incremental"), _pages(spark, sf_dir).select("document_id", "page_number", "content")
    part = F.conv(F.substring(F.md5(F.concat_ws("-", "document_id", "page_number").cast("binary")), 1, 8), 16, 10).cast("long") % 100
    before = now.withColumn("part", part)
    extra = before.where("part = 3").withColumns({"page_number": F.col("page_number") + 100_000, "content": F.lit("A page more.")})
    before = before.where("part <> 2").withColumn("content", F.when(F.col("part") == 0, F.concat(F.lit("Old. "), "content"))
                                                  .otherwise(F.col("content"))).unionByName(extra).drop("part")
    update_corpus(before, root, buckets=8)
    return update_corpus(now, root, buckets=8)


def q_incremental_documents(spark, sf_dir):
    """Document summaries after a run over changed pages only: those of a full run."""
    return _second_run(spark, sf_dir).doc_summaries


def q_incremental_pages(spark, sf_dir):
    """All page summaries after that run, and whether it made them."""
    run = _second_run(spark, sf_dir)
    made = run.changed.withColumn("made", F.lit(True))
    return run.page_summaries.join(made, ["document_id", "page"], "left").select(
        "document_id", "page", "status", "summary", F.coalesce("made", F.lit(False)).alias("made"))


def q_read_pages(spark, sf_dir):
    """Every page as parsed-page JSON, one in three with its text under ``text``, read
    back with its file."""
    root, odd = _folder(spark, "parsed-pages"), F.col("page_number") % 3 == 0
    _pages(spark, sf_dir).select(
        F.col("document_id").alias("documentId"), F.col("page_number").alias("pageNumber"), F.col("blob_path").alias("blobPath"),
        F.when(~odd, F.col("content")).alias("content"), F.when(odd, F.col("content")).alias("text"), "length").write.json(root)
    read = files.read_pages(spark, root)
    return read.select("document_id", "page_number", "blob_path", "content", "length", F.col("file_path").endswith(".json").alias("from_json"))


def q_source_files(spark, sf_dir):
    """S3: documents stored as text files by language; the bytes of each language as the
    manifest lists them, no file opened."""
    root = _folder(spark, "sources")
    docs = table(spark, sf_dir, "documents").select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    docs.write.partitionBy("lang").text(root)
    found = intake.source_manifest(spark, root).where("document_id LIKE 'part-%'")
    lang = F.regexp_extract("path", "/lang=([^/]+)/", 1)
    return found.groupBy(lang.alias("lang")).agg(F.sum("length").alias("n_bytes"), F.min(F.col("modified").isNotNull()).alias("dated"))


def q_stored_markdown(spark, sf_dir):
    """Every document's report stored by key, some first in an older form, read back."""
    from .queries import q_render_markdown

    root = _folder(spark, "markdown")
    rendered = materialize(q_render_markdown(spark, sf_dir))
    old = rendered.where("markdown LIKE '%e%'").select(
        *[F.lit("old").alias(c) if c == "markdown" else F.col(c) for c in rendered.columns])
    files.write_markdown(old, root, buckets=8)
    files.write_markdown(rendered, root, buckets=8)
    return spark.read.parquet(root).select(*rendered.columns)


def q_stored_levels(spark, sf_dir):
    """The embedding records stored by level; records and characters of each level."""
    from .queries import _index

    root = _folder(spark, "embeddings")
    files.write_embeddings(_index(spark, sf_dir).records, root)
    per = spark.read.parquet(root).groupBy("level").agg(F.count("*").alias("records"), F.sum(F.length("text")).cast("long").alias("chars"))
    return per


def q_index_versions(spark, sf_dir):
    """S11 stored: the first run's index as version 1, the second run and the
    conversations merged into what is current as version 2, which is then read."""
    from . import queries as C

    root = _folder(spark, "index")
    index.append_version(C._processed(spark, sf_dir).index, root, 1)
    second = C._processed(spark, sf_dir, lines_per_page=20, run_time=C.RUN_TIME_2).index
    chats = C.process_corpus_pages(spark, sf_dir, C.RUN_TIME_2).index
    index.append_version(index.upsert_index(index.read_current(spark, root), second.unionByName(chats), keep_created=True), root, 2)
    return index.read_current(spark, root).select(
        "id", "page_count", "failed_page_count", "status", C._ts("created_at"), C._ts("updated_at"))


def q_enumerate_pages(spark, sf_dir):
    """Page numbers recovered from the names of page files."""
    name = F.concat(F.lit("parsed-pages/"), "document_id", F.lit("/"), F.col("page_number").cast("string"), F.lit(".json"))
    return files.enumerate_pages(_pages(spark, sf_dir).select(name.alias("path")))


def q_list_documents(spark, sf_dir):
    """Ids of stored summaries among all names of a container."""
    docs = table(spark, sf_dir, "documents").select(F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("d"), "source")
    names = F.array(F.concat("d", F.lit(".json")), F.concat("d", F.lit("/1.json")), F.concat("d", F.lit(".pdf")))
    return files.list_documents(docs.select(F.explode(names).alias("path")))


def _listed(spark, sf_dir):
    good = table(spark, sf_dir, "labels").where("quality = 1")
    return good.select(F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("document_id")).distinct()


def q_fetch_page_summaries(spark, sf_dir):
    """Page summaries of the documents labelled high quality."""
    ps = Z.summarize_pages(_pages(spark, sf_dir))
    return files.fetch_page_summaries(ps, _listed(spark, sf_dir)).select("document_id", "page", "status", "summary", "sort_page")


def q_fetch_doc_summary(spark, sf_dir):
    """The stored document summary of each document labelled high quality."""
    ds = Z.summarize_documents(Z.summarize_pages(_pages(spark, sf_dir)))
    return files.fetch_doc_summary(_listed(spark, sf_dir), ds.select("document_id", "status", "summary"))


def q_stored_corpus(spark, sf_dir):
    """L1 with its outputs stored twice (the second run replaces the first), read back:
    index record and document summary of every document."""
    root = _folder(spark, "corpus")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    done = process_corpus(corpus.documents_corpus(docs, LINES), persist_all=True, totals=corpus.documents_totals(docs, LINES))
    for _ in range(2):
        store_processed(done, root)
    index = spark.read.parquet(f"{root}/index").select("document_id", "page_count", "failed_page_count", "status")
    summary = spark.read.parquet(f"{root}/doc_summaries").select("document_id", "summary")
    pages = spark.read.parquet(f"{root}/page_summaries").groupBy("document_id").agg(F.count("*").alias("stored_pages"))
    return index.join(summary, "document_id", "left").join(pages, "document_id", "left")


# ------------------------------------------------------------------ legacy results

def _legacy(spark, sf_dir):
    """Conversations as legacy results: one content item per turn, the assistant's with
    Markdown and a figure, the first system text as summary, turn 0 as metadata."""
    rows = table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("conv-"), F.col("conv_id").cast("string")).alias("document_id"), "turn", "role", "text")
    page = (F.col("turn") + 1).cast("int")
    by_bot = F.col("role") == "assistant"
    item = F.struct(page.alias("pageNumber"), F.when(by_bot, F.concat(F.lit("# "), "text")).alias("markdown"), F.col("text").alias("text"))
    figure = F.struct(page.alias("pageNumber"), F.col("text").alias("description"))
    return rows.groupBy("document_id").agg(
        F.array_sort(F.collect_list(item)).alias("contents"), F.collect_list(F.when(by_bot, figure)).alias("figures"),
        F.min(F.when(F.col("role") == "system", F.col("text"))).alias("summary"),
        F.min(F.when(F.col("turn") == 0, F.col("text"))).alias("first"),
    ).withColumn("pages", F.array().cast("array<struct<pageNumber:int>>"))


def q_legacy_pages(spark, sf_dir):
    """Pages of legacy results."""
    return P.legacy_pages(_legacy(spark, sf_dir))


def q_document_abstract(spark, sf_dir):
    """Summary, else the metadata's."""
    return _legacy(spark, sf_dir).select("document_id", P.document_abstract(F.col("summary"), F.col("first")).alias("abstract"))


def q_figures(spark, sf_dir):
    """One row per figure."""
    return P.figures(_legacy(spark, sf_dir))


def q_page_figures(spark, sf_dir):
    """The figures of page 2 of every document."""
    return P.page_figures(_legacy(spark, sf_dir), 2)


# ------------------------------------------------------------------ pages, summaries

def q_truncate_page(spark, sf_dir):
    """The first 500 characters of every page, the feature's limit."""
    return _pages(spark, sf_dir).select("document_id", "page_number", P.truncate_page(F.col("content"), 500).alias("excerpt"))


def q_page_range_parts(spark, sf_dir):
    """Page ranges as requests write them, good and bad, one per document."""
    d = F.col("doc_id")
    text = (F.when(d % 6 == 0, F.concat(d.cast("string"), F.lit("-"), (d + 4).cast("string")))
            .when(d % 6 == 1, F.concat(F.lit(" "), d.cast("string"), F.lit(" - "), (d * 2).cast("string")))
            .when(d % 6 == 2, d.cast("string")).when(d % 6 == 3, F.concat(d.cast("string"), F.lit("-2-3")))
            .when(d % 6 == 4, F.concat(F.lit("a-"), d.cast("string")))
            .otherwise(F.concat(d.cast("string"), F.lit("-2"))))
    p = P.parse_page_range(F.col("range"))
    return table(spark, sf_dir, "documents").select("doc_id", text.alias("range")).select(
        "doc_id", p["start"].alias("start"), p["end"].alias("end"), p["error"].alias("error"))


def q_normalize_summary(spark, sf_dir):
    """Every conversation text as a summary that ends like a sentence."""
    rows = table(spark, sf_dir, "conversations")
    return rows.select("conv_id", "turn", Z.normalize_summary(F.regexp_replace("text", r"[.]$", " ")).alias("summary"))


def q_dry_run_plan(spark, sf_dir):
    """The pages a run would process."""
    return Z.dry_run_plan(_pages(spark, sf_dir)).select("document_id", "page", "status", "summary")


def q_regenerated_pages(spark, sf_dir):
    """Pages 3-8 summarised again by a caller's function, stored over the summaries
    of a first run and read back with the pages outside the range."""
    root = _folder(spark, "regenerated")
    rows = _pages(spark, sf_dir)
    files.write_pages(Z.summarize_pages(rows), f"{root}/page_summaries", keys=("document_id", "page"))
    regenerate_corpus(rows, page_range="3-8", scope="range", summarizer=flaky_model(), root=root)
    return spark.read.parquet(f"{root}/page_summaries").select("document_id", "page", "status", "summary", "attempts")


def q_regenerated_documents(spark, sf_dir):
    """Document summaries rebuilt from pages 3-8 only."""
    return regenerate_corpus(_pages(spark, sf_dir), page_range="3-8", scope="range").doc_summaries


# ------------------------------------------------------------------ failures, dense vectors

def q_render_stats(spark, sf_dir):
    """A4: page counts by status where pages fail."""
    return A.render_stats(_flaky_summaries(spark, sf_dir))


def q_render_failures(spark, sf_dir):
    """R1-R7 with failed pages and failed documents (R3, R5); documents whose pages all
    failed are reported as failed."""
    ps = _flaky_summaries(spark, sf_dir)
    ds = R.stored_doc_summaries(Z.summarize_documents(ps))
    lost = ps.join(ds, "document_id", "left_anti").select("document_id").distinct().select(
        "document_id", F.lit("failed").alias("status"), F.lit(None).cast("string").alias("summary"),
        F.lit(None).cast("string").alias("summary_blob"), F.lit(Z.NO_PAGE_SUMMARIES).alias("error"))
    return R.render_markdown(ds.select(*lost.columns).unionByName(lost), ps, GENERATED_AT)


def q_dense_vectors(spark, sf_dir):
    """X2 dense: hashed, normalised vectors of every benchmark passage, by component."""
    rows = table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("id"), "text")
    dense = X.dense_vectors(X.term_vectors(rows, "id", "text", DENSE_DIM), "id", DENSE_DIM)
    return dense.select("id", F.posexplode("embedding").alias("pos", "v")).select("id", "pos", F.round(F.col("v").cast("double"), 5).alias("v"))


STORED_QUERIES = {name[2:]: f for name, f in list(globals().items()) if name.startswith("q_")}


def _flaky_cte(src: str = "pages_t", name: str = "ps_t", where: str = "TRUE") -> str:
    return rf"""
{name} AS (
  SELECT document_id, page_number AS page,
         CASE WHEN blank THEN 'skipped' WHEN failures >= 5 THEN 'failed' ELSE 'success' END AS status,
         CASE WHEN blank THEN {O.BLANK_TEXT} WHEN failures >= 5 THEN NULL
              ELSE trim(regexp_replace(coalesce(regexp_extract(content, {O.SENT}, 0), ''), {O.SPACE_RUN}, ' ', 'g')) END AS summary,
         CASE WHEN NOT blank AND failures >= 5 THEN 'invalid model response' END AS error,
         CASE WHEN NOT blank AND failures >= 5 THEN 'permanent' ELSE 'unknown' END AS error_category,
         CAST(CASE WHEN blank THEN 0 ELSE least(failures + 1, 5) END AS INTEGER) AS attempts
  FROM (SELECT *, NOT regexp_matches(content, '[^ \t\n\r\f\v]') AS blank,
               ('0x' || substr(md5(content), 1, 8))::BIGINT % 7 AS failures FROM {src} WHERE {where})
)"""


PAGES = O.pages_cte(LINES)
_CONV = "c AS (SELECT 'conv-' || conv_id AS document_id, CAST(turn + 1 AS INTEGER) AS page_number, role, text, turn FROM conversations)"

STORED_ORACLE = {
    "page_files": f"""WITH {PAGES}
SELECT document_id, page_number, blob_path, content, CAST(length(content) AS INTEGER) AS length FROM pages_t""",
    "incremental_documents": O.ORACLE["doc_summaries"],
    "incremental_pages": f"""WITH {PAGES}, {O.summaries_cte()}
SELECT document_id, page, status, summary,
       ('0x' || substr(md5(document_id || '-' || page), 1, 8))::BIGINT % 100 IN (0, 2) AS made FROM ps_t""",
    "read_pages": f"""WITH {PAGES}
SELECT document_id, page_number, blob_path, content, CAST(length(content) AS INTEGER) AS length, true AS from_json FROM pages_t""",
    "source_files": """SELECT coalesce(lang, 'und') AS lang, CAST(sum(strlen(coalesce(text, '')) + 1) AS BIGINT) AS n_bytes, true AS dated
FROM documents GROUP BY 1""",
    "stored_markdown": O.ORACLE["render_markdown"],
    "stored_levels": f"""WITH {O.base(LINES)}, {O.RECORDS}
SELECT level, count(*) AS records, CAST(sum(length(text)) AS BIGINT) AS chars FROM recs GROUP BY 1""",
    "index_versions": O.ORACLE["index_upsert"],
    "enumerate_pages": f"WITH {PAGES} SELECT document_id, page_number AS page FROM pages_t",
    "list_documents": "SELECT DISTINCT 'doc-' || doc_id AS document_id FROM documents",
    "fetch_page_summaries": f"""WITH {PAGES}, {O.summaries_cte()}
SELECT document_id, page, status, summary, page AS sort_page FROM ps_t
WHERE document_id IN (SELECT 'doc-' || doc_id FROM labels WHERE quality = 1)""",
    "fetch_doc_summary": f"""WITH {PAGES}, {O.summaries_cte()}, {O.doc_summaries_cte()},
l AS (SELECT DISTINCT 'doc-' || doc_id AS document_id FROM labels WHERE quality = 1)
SELECT l.document_id, d.status, d.summary FROM l LEFT JOIN ds_t d ON l.document_id = d.document_id""",
    "stored_corpus": f"""WITH {O.base(LINES)}
SELECT i.document_id, i.page_count, i.failed_page_count, i.status, d.summary, i.page_count::BIGINT AS stored_pages
FROM idx_t i LEFT JOIN ds_t d ON i.document_id = d.document_id""",
    "legacy_pages": f"""WITH {_CONV},
n AS (SELECT document_id, CAST(unnest(generate_series(1, max(page_number))) AS INTEGER) AS page_number FROM c GROUP BY document_id)
SELECT n.document_id, n.page_number,
       coalesce((SELECT string_agg(t, chr(10) || chr(10)) FROM (
         SELECT CASE WHEN role = 'assistant' THEN '# ' || text ELSE coalesce(text, '') END AS t FROM c
         WHERE c.document_id = n.document_id AND c.page_number = n.page_number) WHERE t <> ''), '') AS content
FROM n""",
    "document_abstract": f"""WITH {_CONV}
SELECT document_id, coalesce(nullif(min(text) FILTER (role = 'system'), ''), nullif(min(text) FILTER (turn = 0), '')) AS abstract
FROM c GROUP BY 1""",
    "figures": f"WITH {_CONV} SELECT document_id, page_number, text AS description FROM c WHERE role = 'assistant'",
    "page_figures": f"""WITH {_CONV}
SELECT document_id, page_number, text AS description FROM c WHERE role = 'assistant' AND page_number = 2""",
    "truncate_page": f"WITH {PAGES} SELECT document_id, page_number, substr(content, 1, 500) AS excerpt FROM pages_t",
    "page_range_parts": """
SELECT doc_id, CASE WHEN error IS NULL THEN s END AS "start", CASE WHEN error IS NULL THEN e END AS "end", error FROM (
  SELECT doc_id, s, e, CASE
    WHEN k = 2 THEN 'Page range must be in format ''start-end'' (e.g., ''1-50'')'
    WHEN k = 3 THEN 'Page range must have exactly one hyphen'
    WHEN k = 4 THEN 'Page range start and end must be integers'
    WHEN s < 1 OR e < 1 THEN 'Page numbers must be positive integers'
    WHEN s > e THEN 'Invalid range: start (' || s || ') > end (' || e || ')' END AS error
  FROM (SELECT doc_id, doc_id % 6 AS k, CAST(doc_id AS INTEGER) AS s,
               CAST(CASE doc_id % 6 WHEN 0 THEN doc_id + 4 WHEN 1 THEN doc_id * 2 ELSE 2 END AS INTEGER) AS e FROM documents))""",
    "normalize_summary": r"""
SELECT conv_id, turn, CASE WHEN s <> '' AND NOT regexp_matches(s, '[.!?]$') THEN s || '.' ELSE s END AS summary
FROM (SELECT conv_id, turn, regexp_replace(regexp_replace(text, '[.]$', ' '), '^[ \t\n\r]+|[ \t\n\r]+$', '', 'g') AS s FROM conversations)""",
    "dry_run_plan": f"""WITH {PAGES}
SELECT document_id, page_number AS page, 'dry-run' AS status, '[Dry run - not actually processed]' AS summary FROM pages_t""",
    "regenerated_pages": f"""WITH {PAGES}, {O.summaries_cte()}, {_flaky_cte(name='fl_t', where='page_number BETWEEN 3 AND 8')}
SELECT document_id, page, status, summary, attempts FROM fl_t
UNION ALL
SELECT document_id, page, status, summary, CAST(CASE WHEN status = 'skipped' THEN 0 ELSE 1 END AS INTEGER)
FROM ps_t WHERE page NOT BETWEEN 3 AND 8""",
    "regenerated_documents": f"""WITH {PAGES}, todo AS (SELECT * FROM pages_t WHERE page_number BETWEEN 3 AND 8),
{O.summaries_cte('todo', 'ps_t')}, {O.doc_summaries_cte()}
SELECT * FROM ds_t""",
    "render_stats": f"""WITH {PAGES}, {_flaky_cte()}
SELECT document_id, count(*) AS total_pages, count(*) FILTER (WHERE status = 'success') AS successful_pages,
       count(*) FILTER (WHERE status = 'skipped') AS skipped_pages, count(*) FILTER (WHERE status = 'failed') AS failed_pages
FROM ps_t GROUP BY 1""",
    "render_failures": O.RENDER.replace(O.summaries_cte(), _flaky_cte()).replace(
        "FROM ds_t d LEFT JOIN sec", """FROM (
    SELECT document_id, status, summary, error FROM ds_t
    UNION ALL
    SELECT DISTINCT document_id, 'failed', NULL, 'At least one page summary with non-empty ''summary'' is required.'
    FROM ps_t WHERE document_id NOT IN (SELECT document_id FROM ds_t)) d LEFT JOIN sec"""),
    "dense_vectors": f"""WITH b AS (SELECT CAST(item_id AS VARCHAR) AS id, unnest(regexp_extract_all(lower(text), {O.TERM}, 0)) AS t FROM benchmark),
tf AS (SELECT id, ('0x' || substr(md5(t), 1, 8))::BIGINT % {DENSE_DIM} AS pos, count(*) AS tf FROM b GROUP BY 1, 2),
n AS (SELECT id, sqrt(sum(tf * tf)) AS n FROM tf GROUP BY 1),
g AS (SELECT id, n, CAST(unnest(generate_series(0, {DENSE_DIM - 1})) AS INTEGER) AS pos FROM n)
SELECT g.id, g.pos, round(coalesce(tf.tf, 0) / g.n, 5) AS v FROM g LEFT JOIN tf ON g.id = tf.id AND g.pos = tf.pos""",
}
