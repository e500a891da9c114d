"""Corpus adapters: turn plain tables into the engine's inputs.

``paginate`` (S14) stands in for the external text-extraction service: a plain text
document becomes an analysis result (E2) whose pages carry code-point spans into the
document text, so page extraction (P2/P3) runs on real data. All work is per row
(higher-order array functions), so a long document never moves through a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import bind, prefix_sums


def paginate(
    documents: DataFrame,
    lines_per_page: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    id_prefix: str = "doc-",
    blob_path: Column | None = None,
    cover: Column | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """S14. Documents -> E2 ``(document_id, blob_path, content, pages)``.

    Page ``p`` (0-based) holds lines ``[p*L, (p+1)*L)`` of ``split(text, '\\n')`` and one
    span ``(offset, length)`` covering them without the separating newline. ``cover``
    marks documents that have an image-only page before these: it has no spans and no
    lines, so extraction yields ''. All text stays on the other pages.

    The text is split once per row and offsets come from two-level sums, so the work
    follows the number of lines."""
    if lines_per_page < 1:
        raise ValueError("lines_per_page must be >= 1")
    L = lines_per_page
    doc_id = F.concat(F.lit(id_prefix), F.col(id_col).cast("string"))
    path = blob_path if blob_path is not None else F.concat(F.lit("raw-pdfs/"), doc_id, F.lit(".pdf"))

    def cut(lines: Column) -> Column:
        last = F.floor((F.size(lines) - 1) / L).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda p: F.slice(lines, p * L + 1, L))

    def laid_out(page_lines: Column) -> Column:
        sizes = F.transform(page_lines, lambda ls: F.aggregate(ls, F.lit(0), lambda n, x: n + F.length(x) + 1))
        return bind(sizes, lambda size: bind(prefix_sums(size), lambda offset: F.transform(
            page_lines, lambda ls, p: F.struct(
                F.array(F.struct(F.get(offset, p).alias("offset"), (F.get(size, p) - 1).alias("length"))).alias("spans"),
                F.transform(ls, lambda x: F.struct(x.alias("content"))).alias("lines")))))

    text = F.col(text_col)
    pages = F.when(text.isNotNull(), bind(F.split(text, "\n", -1), lambda lines: bind(cut(lines), laid_out)))
    if cover is not None:
        blank = F.array(F.struct(F.array().cast("array<struct<offset:int,length:int>>").alias("spans"),
                                 F.array().cast("array<struct<content:string>>").alias("lines")))
        pages = F.when(F.coalesce(cover, F.lit(False)), F.concat(blank, pages)).otherwise(pages)
    return documents.select(
        doc_id.alias("document_id"),
        path.alias("blob_path"),
        text.alias("content"),
        pages.alias("pages"),
        *keep,
    )


def has_cover() -> Column:
    """The documented derivation of blank pages: every seventh document of the driver's
    table (``doc_id % 7 = 0``) has an image-only cover before its text (FIXTURES.md)."""
    return F.col("doc_id") % 7 == 0


def document_path() -> Column:
    return F.concat(F.lit("raw-pdfs/"), F.col("source"), F.lit("/doc-"), F.col("doc_id").cast("string"), F.lit(".pdf"))


def documents_corpus(documents: DataFrame, lines_per_page: int = 10, keep: tuple[str, ...] = ()) -> DataFrame:
    """The driver's ``documents`` table as analysis results, covers included."""
    return paginate(documents, lines_per_page=lines_per_page, blob_path=document_path(), cover=has_cover(), keep=keep)


def documents_totals(documents: DataFrame, lines_per_page: int = 10, keep: tuple[str, ...] = ()) -> DataFrame:
    """P1 of :func:`documents_corpus` from the number of line ends, without any page:
    ``(document_id, total_pages)``."""
    ends = F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    n = F.floor(ends / lines_per_page) + 1 + F.coalesce(has_cover(), F.lit(False)).cast("int")
    doc_id = F.concat(F.lit("doc-"), F.col("doc_id").cast("string"))
    return documents.select(doc_id.alias("document_id"), F.coalesce(n, F.lit(0)).cast("int").alias("total_pages"), *keep)


def conversation_pages(conversations: DataFrame) -> DataFrame:
    """Pre-split pages (E4): document = ``conv-{conv_id}``, page = ``turn + 1``."""
    doc_id = F.concat(F.lit("conv-"), F.col("conv_id").cast("string"))
    return conversations.select(
        doc_id.alias("document_id"),
        (F.col("turn") + 1).cast("int").alias("page_number"),
        F.concat(F.lit("raw-pdfs/chat/"), doc_id, F.lit(".pdf")).alias("blob_path"),
        F.col("text").alias("content"),
        F.length("text").cast("int").alias("length"),
    )


def vector_records(embeddings: DataFrame) -> DataFrame:
    """The driver's ``embeddings`` table as page-level E11 records:
    document = ``label``, page = ``vec_id``."""
    return embeddings.select(
        F.concat(F.lit("vec-"), F.col("label").cast("string"), F.lit("_page_"), F.col("vec_id").cast("string")).alias("id"),
        F.lit("page").alias("level"),
        F.concat(F.lit("vec-"), F.col("label").cast("string")).alias("document_id"),
        F.col("vec_id").cast("int").alias("page_number"),
        F.col("embedding"),
    )
