"""Retrieval (Q1-Q9, Q12): filtered top-k, hierarchical search, document ranking.

Sparse (hashed term) search keeps a record's vector in one row. A flat search deals
these rows to shards, which score the questions against all their records and return
their best few, so no pair of a question and a record is a row. Hierarchical search
narrows each level to the previous level's winners with a join on (question,
document[, page]) *before* scoring, so deeper levels only touch the vectors they need.

Dense search (Q1 over stored float vectors) is a flat exact scan in blocks: each shard
of vectors scores the query set and returns its best few.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .embed import DEFAULT_DIM, LEVEL_DOCUMENT, LEVEL_PAGE, LEVEL_PARAGRAPH, record_vectors
from .sections import PAGE, pages_within

RECORD_COLS = ["id", "level", "document_id", "page_number", "paragraph_number", "text",
               "has_tables", "contains_numbers", "start_offset", "end_offset"]


@dataclass
class SparseIndex:
    records: DataFrame  # RECORD_COLS
    rows: DataFrame     # (id, level, buckets, tfs, n2): one row per record
    dim: int
    topics: DataFrame | None = None  # (document_id, topics): the documents' topic terms
    sections: DataFrame | None = None  # (document_id, section, start_page, end_page)
    years: DataFrame | None = None  # (document_id, page_number, year)

    @property
    def vectors(self) -> DataFrame:
        """(id, level, bucket, tf, n2)"""
        return self.rows.select("id", "level", *_entries(), "n2")

    @property
    def norms(self) -> DataFrame:
        """(id, level, n2)"""
        return self.rows.select("id", "level", "n2")

    def about(self, topic: str | Column) -> DataFrame:
        """The documents that have ``topic`` among their topics."""
        return self.topics.where(F.array_contains("topics", topic)).select("document_id")

    def pages_in(self, section: Column | None, years: tuple[int, int] | None) -> DataFrame | None:
        """The pages that lie in a section for which ``section`` holds and mention a year
        from the first to the last of ``years``; None: no such condition."""
        if section is None and years is None:
            return None
        pages = self.records.where(F.col("level") == LEVEL_PAGE).select(*PAGE)
        if section is not None:
            pages = pages_within(pages, self.sections.where(section))
        if years is not None:
            pages = pages.join(self.years.where(F.col("year").between(*years)), PAGE, "left_semi")
        return pages


def _entries() -> list[Column]:
    """The entries of a record's vector as rows (bucket, tf)."""
    return [F.inline(F.arrays_zip(F.col("buckets").alias("bucket"), F.col("tfs").alias("tf"))).alias("bucket", "tf")]


def sparse_index(records: DataFrame, dim: int = DEFAULT_DIM, persist: bool = False) -> SparseIndex:
    """Q2 index: hashed term vectors of every record with their squared norms, one row
    per record, carrying the record level.

    ``persist`` writes the tables once (the shared checkpoint folder), vectors
    partitioned by level, as a stored index would be: a level filter then
    prunes whole folders, and searches never re-derive the records' lineage."""
    recs = records.select(*[c for c in RECORD_COLS if c in records.columns])
    if persist:
        recs = materialize(recs)
    rows = record_vectors(recs, "id", "text", dim, keep=("level",))
    if persist:
        rows = materialize(rows, partition_by=["level"])
    return SparseIndex(recs, rows, dim)


def _questions(questions: DataFrame, dim: int) -> DataFrame:
    """(qid, buckets, tfs, n2) of the questions that have terms."""
    return record_vectors(questions, "qid", "text", dim)


def _chosen(
    index: SparseIndex,
    level: str | None = None,
    where: Column | None = None,
    documents: DataFrame | None = None,
    pages: DataFrame | None = None,
) -> DataFrame:
    """The vectors (one row per record) of the records that meet all conditions."""
    recs, rows = index.records, index.rows
    if level is not None:  # prunes level folders of the stored vectors
        recs = recs.filter(F.col("level") == level)
        rows = rows.filter(F.col("level") == level)
    if where is not None:
        recs = recs.filter(where)
    if documents is not None:
        recs = recs.join(documents.select("document_id").distinct(), "document_id", "left_semi")
    if pages is not None:
        recs = recs.join(pages, PAGE, "left_semi")
    if where is not None or documents is not None or pages is not None:
        rows = rows.join(recs.select("id"), "id", "left_semi")  # column pruning keeps text out of the scan
    return rows.select("id", "buckets", "tfs", "n2")


def score(questions: DataFrame, index: SparseIndex, candidates: DataFrame, level: str | None = None) -> DataFrame:
    """Cosine of the pairs of ``candidates(qid, id)`` that share a term: ``(qid, id,
    score)``. Record columns are not carried: attach them to the winners with
    :func:`with_record` and :func:`with_text`."""
    rows = candidates.select("qid", "id").join(_chosen(index, level), "id")
    q = _questions(questions, index.dim).select("qid", F.col("n2").alias("qn2"), *_entries()).withColumnRenamed("tf", "qtf")
    pairs = rows.select("qid", "id", "n2", *_entries()).join(q, ["qid", "bucket"])
    dots = pairs.groupBy("qid", "id").agg(F.sum(F.col("qtf") * F.col("tf")).alias("dot"), F.first("qn2").alias("qn2"),
                                          F.first("n2").alias("n2"))
    return dots.select("qid", "id", (F.col("dot") / (F.sqrt("qn2") * F.sqrt("n2"))).alias("score"))


def _scorer(top: int, group: str | None, cells: int = 2_000_000, block: int = 4_000_000):
    """The step of one shard: its records' vectors against all questions, ``cells`` pairs
    of a question and a record at a time, terms that meet in blocks of about ``block``. Per question (and ``group`` value) the
    best ``top`` go on, and all that tie with the last of them."""
    def entries(df, np):
        size = df["buckets"].map(len).to_numpy()
        return (np.repeat(np.arange(len(df)), size), np.concatenate(df["buckets"].to_list()).astype(np.int64),
                np.concatenate(df["tfs"].to_list()).astype(np.float64))

    def step(vec, qs):
        import numpy as np
        import pandas as pd

        out = []
        if len(vec) and len(qs):
            code = np.zeros(len(vec), dtype=np.int64) if group is None else pd.factorize(vec[group], use_na_sentinel=False)[0]
            rec, bucket, tf = entries(vec, np)
            length, n = np.sqrt(vec["n2"].to_numpy(dtype=np.float64)), len(vec)
            wide = max(1, cells // n)
            for first in range(0, len(qs), wide):
                some = qs.iloc[first:first + wide]
                q, qbucket, qtf = entries(some, np)
                order = np.argsort(qbucket, kind="stable")
                q, qbucket, qtf = q[order], qbucket[order], qtf[order]
                lo = np.searchsorted(qbucket, bucket)
                met = np.searchsorted(qbucket, bucket, side="right") - lo
                shared = np.flatnonzero(met)
                dot, ends = np.zeros(len(some) * n), np.cumsum(met[shared])
                at = 0
                while at < len(shared):  # blocks of whole entries
                    done = ends[at - 1] if at else 0
                    to = max(at + 1, int(np.searchsorted(ends, done + block, side="right")))
                    mine = shared[at:to]
                    times = met[mine]
                    of = np.repeat(mine, times)
                    place = lo[of] + np.arange(len(of)) - np.repeat(np.cumsum(times) - times, times)
                    dot += np.bincount(q[place] * n + rec[of], weights=qtf[place] * tf[of], minlength=len(dot))
                    at = to
                qlength = np.sqrt(some["n2"].to_numpy(dtype=np.float64))
                hit = np.flatnonzero(dot)
                if not len(hit):
                    continue
                hq, hr = hit // n, hit % n
                cos = dot[hit] / (qlength[hq] * length[hr])
                if group is None:
                    keep = np.zeros(len(hit), dtype=bool)
                    edges = np.searchsorted(hq, np.arange(len(some) + 1))
                    for a, b in zip(edges[:-1], edges[1:]):
                        keep[a:b] = cos[a:b] >= (np.partition(cos[a:b], -top)[-top] if b - a > top else -np.inf)
                else:
                    order = np.lexsort((-cos, code[hr], hq))
                    hq, hr, cos = hq[order], hr[order], cos[order]
                    new = np.ones(len(hq), dtype=bool)
                    new[1:] = (hq[1:] != hq[:-1]) | (code[hr][1:] != code[hr][:-1])
                    start = np.flatnonzero(new)
                    last = np.minimum(start + top, np.append(start[1:], len(hq))) - 1
                    keep = cos >= cos[last][np.cumsum(new) - 1]
                chosen = {"qid": some["qid"].to_numpy()[hq[keep]], "id": vec["id"].to_numpy()[hr[keep]], "score": cos[keep]}
                if group is not None:
                    chosen[group] = vec[group].to_numpy()[hr[keep]]
                out.append(pd.DataFrame(chosen))
        columns = ["qid", "id", "score", *([group] if group else [])]
        return pd.concat(out, ignore_index=True)[columns] if out else pd.DataFrame(columns=columns)

    return step


def best(questions: DataFrame, index: SparseIndex, rows: DataFrame, top: int, group: str | None = None) -> DataFrame:
    """The best ``top`` of the vectors ``rows(id, buckets, tfs, n2[, group])`` per question
    (and value of ``group``) by cosine, of those that share a term with it, ties broken by
    ``id``: ``(qid, id, score, [group,] rank)``.

    As in :func:`search_dense`, vectors are hashed to shards (four per shuffle partition)
    and the questions go to each of them by an equi-join on the shard; a pair of a
    question and a record never becomes a row. Dot products are whole numbers, so exact."""
    n = 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    v = rows.withColumn("shard", F.pmod(F.xxhash64(group or "id"), F.lit(n)).cast("int"))
    q = _questions(questions, index.dim).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    schema = T.StructType([q.schema["qid"], rows.schema["id"], T.StructField("score", T.DoubleType()),
                           *([rows.schema[group]] if group else [])])
    scored = v.groupBy("shard").cogroup(q.groupBy("shard")).applyInPandas(_scorer(top, group), schema)
    return top_k(scored, top, per=("qid", group) if group else ("qid",))


def with_record(hits: DataFrame, index: SparseIndex) -> DataFrame:
    """Attach the record columns but its text to ranked hits."""
    return hits.join(index.records.drop("text"), "id")


def with_text(hits: DataFrame, index: SparseIndex) -> DataFrame:
    """Attach record text to (few) ranked hits."""
    return hits.join(index.records.select("id", "text"), "id")


def top_k(scored: DataFrame, k: int, per: tuple[str, ...] = ("qid",)) -> DataFrame:
    """Best ``k`` per group, ties broken by ``id``; adds ``rank``."""
    w = Window.partitionBy(*per).orderBy(F.col("score").desc(), F.col("id"))
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def winners(index: SparseIndex, ranked: DataFrame) -> DataFrame:
    """Ranked hits with their record columns. The hits are few and written first: their
    size is then known, so the records are met where they lie."""
    return with_record(materialize(ranked), index)


def search(
    questions: DataFrame,
    index: SparseIndex,
    level: str,
    top: int = 5,
    document_id: str | None = None,
    where: Column | None = None,
) -> DataFrame:
    """Q1/Q2 API: level always applied, optional document and extra filter ANDed."""
    cond = where
    if document_id is not None:
        c = F.col("document_id") == document_id
        cond = c if cond is None else (cond & c)
    return winners(index, best(questions, index, _chosen(index, level, cond), top))


def search_within(questions: DataFrame, index: SparseIndex, allowed: DataFrame, level: str, keys: list[str], top: int) -> DataFrame:
    """The best ``top`` records of ``level`` per question among those whose ``keys`` are
    ``allowed(qid, *keys)`` for it."""
    return winners(index, top_k(score(questions, index, _within(allowed, index, level, keys), level), top))


def _within(allowed: DataFrame, index: SparseIndex, level: str, keys: list[str]) -> DataFrame:
    """(qid, id) pairs of ``level`` records whose ``keys`` are allowed for the question."""
    recs = index.records.filter(F.col("level") == level).select("id", *keys)
    return materialize(allowed.select("qid", *keys).distinct().join(recs, keys).select("qid", "id"))


def search_multi_level(
    questions: DataFrame,
    index: SparseIndex,
    k_doc: int = 3,
    k_page: int = 5,
    k_para: int = 3,
    min_score: float = 0.0,
) -> DataFrame:
    """Q3: documents -> pages of those documents -> paragraphs of those pages; top-k
    and a score threshold per level. One row per paragraph hit with the scores of
    its document and page."""
    docs = search(questions, index, LEVEL_DOCUMENT, k_doc).filter(F.col("score") >= min_score)
    docs = materialize(docs)  # read by the next level and by the result
    pages = search_within(questions, index, docs, LEVEL_PAGE, ["document_id"], k_page).filter(F.col("score") >= min_score)
    pages = materialize(pages)
    paras = search_within(questions, index, pages, LEVEL_PARAGRAPH, PAGE, k_para).filter(F.col("score") >= min_score)
    d = docs.select("qid", "document_id", F.col("score").alias("doc_score"))
    p = pages.select("qid", "document_id", "page_number", F.col("score").alias("page_score"))
    return paras.join(p, ["qid", "document_id", "page_number"]).join(d, ["qid", "document_id"])


def discover(questions: DataFrame, index: SparseIndex) -> DataFrame:
    """Q4: the single best document per question."""
    return search(questions, index, LEVEL_DOCUMENT, 1)


def localize_topic(targets: DataFrame, index: SparseIndex, top: int = 10) -> DataFrame:
    """Q5: best pages inside each question's target document
    (``targets(qid, text, document_id)``)."""
    return search_within(targets.select("qid", "text"), index, targets, LEVEL_PAGE, ["document_id"], top)


def cite(targets: DataFrame, index: SparseIndex, k_page: int = 5, k_para: int = 3) -> DataFrame:
    """Q6: page search in the target document, then paragraphs on those pages;
    returns text, page, paragraph and score."""
    pages = localize_topic(targets, index, k_page)
    hits = search_within(targets.select("qid", "text"), index, pages, LEVEL_PARAGRAPH, PAGE, k_para)
    return with_text(materialize(hits), index)


def compare(pairs: DataFrame, index: SparseIndex, k_page: int = 10, k: int = 5, topic: str | None = None) -> DataFrame:
    """Q7: two sub-queries (``pairs(qid, text_a, text_b)``) answered side by side on
    the pages found for ``text_a``: paragraphs of each, full outer join on rank.
    ``topic`` keeps only records of documents that have it among their topics."""
    qa = pairs.select("qid", F.col("text_a").alias("text"))
    qb = pairs.select("qid", F.col("text_b").alias("text"))
    documents = index.about(topic) if topic is not None else None
    pages = winners(index, best(qa, index, _chosen(index, LEVEL_PAGE, documents=documents), k_page))
    cand = _within(pages, index, LEVEL_PARAGRAPH, PAGE)
    a = top_k(score(qa, index, cand, LEVEL_PARAGRAPH), k)
    b = top_k(score(qb, index, cand, LEVEL_PARAGRAPH), k)
    a = a.select("qid", "rank", F.col("id").alias("id_a"), F.col("score").alias("score_a"))
    b = b.select("qid", "rank", F.col("id").alias("id_b"), F.col("score").alias("score_b"))
    return a.join(b, ["qid", "rank"], "full_outer")


def compare_documents(questions: DataFrame, index: SparseIndex, documents: DataFrame, level: str = LEVEL_PAGE,
                      top: int = 2) -> DataFrame:
    """Q8: the best ``top`` hits of each question inside each listed document."""
    rows = _chosen(index, level, documents=documents).join(index.records.select("id", "document_id"), "id")
    return with_record(best(questions, index, rows, top, group="document_id").drop("document_id"), index)


def rank_documents(questions: DataFrame, index: SparseIndex, top: int = 5, excerpt_chars: int = 200) -> DataFrame:
    """Q9: cross-document ranked list with an excerpt of each document summary."""
    hits = with_text(materialize(search(questions, index, LEVEL_DOCUMENT, top)), index)
    return hits.withColumn("excerpt", F.substring("text", 1, excerpt_chars))


def metadata_search(questions: DataFrame, index: SparseIndex, where: Column | None = None, level: str = LEVEL_PAGE,
                    top: int = 5, topic: str | None = None, section: Column | None = None,
                    year_range: tuple[int, int] | None = None) -> DataFrame:
    """Q12: a predicate on the record columns (tables, numbers, pages, offsets ...), a
    topic of the document, a predicate on the ``section`` that the page lies in and a
    range of years (both ends included) that the page mentions one of, ANDed with the
    level, then top-k. Records of whole documents are in no section and mention no year."""
    documents = index.about(topic) if topic is not None else None
    pages = index.pages_in(section, year_range)
    return winners(index, best(questions, index, _chosen(index, level, where, documents, pages), top))


# ---------------------------------------------------------------------- dense (Q1)

def search_dense(
    queries: DataFrame,
    vectors: DataFrame,
    top: int = 5,
    level: str | None = None,
    document_id: str | None = None,
    where: Column | None = None,
    shards: int | None = None,
) -> DataFrame:
    """Q1 exact cosine top-k of ``queries(qid, embedding)`` over
    ``vectors(id, ..., embedding)``; level, document and extra filter are ANDed.

    Vectors are hashed to ``shards`` groups (default: four per shuffle partition) and
    the query set goes to each of them by an equi-join on the shard; a task scores one
    shard against the queries, one query at a time over a matrix, and returns its best
    ``top`` of each, which are ranked together. Nothing is broadcast and no pair of a
    query and a vector becomes a row. Columns other than the embedding are joined to
    the winners. An all-zero vector has score 0."""
    for name, value in (("level", level), ("document_id", document_id)):
        if value is not None:
            vectors = vectors.filter(F.col(name) == value)
    if where is not None:
        vectors = vectors.filter(where)
    n = shards or 4 * int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    v = vectors.select("id", "embedding", F.pmod(F.xxhash64("id"), F.lit(n)).cast("int").alias("shard"))
    q = queries.select("qid", "embedding", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("shard"))
    schema = T.StructType([queries.schema["qid"], vectors.schema["id"], T.StructField("score", T.DoubleType())])

    def score_shard(vec, qs):
        import numpy as np
        import pandas as pd

        out = []
        if len(vec) and len(qs):
            matrix = np.stack([np.asarray(x, dtype=np.float64) for x in vec["embedding"]])
            length, ids = np.sqrt((matrix * matrix).sum(axis=1)), vec["id"].to_numpy()
            for qid, x in zip(qs["qid"], qs["embedding"]):
                x = np.asarray(x, dtype=np.float64)
                norm = length * np.sqrt((x * x).sum())
                cos = np.divide(matrix @ x, norm, out=np.zeros(len(norm)), where=norm != 0)
                # all that tie with the last place go on; the ranking settles them
                bar = np.partition(cos, -top)[-top] if top < len(cos) else -np.inf
                out += [(qid, ids[i], float(cos[i])) for i in np.flatnonzero(cos >= bar - 1e-12)]
        return pd.DataFrame(out, columns=["qid", "id", "score"])

    scored = v.groupBy("shard").cogroup(q.groupBy("shard")).applyInPandas(score_shard, schema)
    return top_k(scored, top).join(vectors.drop("embedding"), "id")


def centroids(vectors: DataFrame, key: str, dim: int) -> DataFrame:
    """Mean vector per ``key`` (document-level vector from its page vectors)."""
    ex = vectors.select(key, F.posexplode("embedding").alias("pos", "v"))
    means = ex.groupBy(key, "pos").agg(F.avg(F.col("v").cast("double")).alias("m"))
    per = means.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "m"))).alias("_a"))
    return per.select(key, F.transform("_a", lambda x: x["m"]).alias("embedding"))
