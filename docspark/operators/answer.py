"""Question answering (Q10, Q11): choose the detail level from the best page score,
build the cited context, and answer extractively (or with a caller's function
through Z3). A batch of questions is one table and one job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import lead_sentences
from ..session import materialize
from .embed import LEVEL_PAGE, LEVEL_PARAGRAPH
from .search import SparseIndex, search_within, with_text

# Fixed values of the answering protocol.
HIGH_CONFIDENCE = 0.85
NO_ANSWER = "No relevant information found."
SUMMARY, DETAILED = "summary", "detailed"


def choose_detail(questions: DataFrame, page_hits: DataFrame, mode: str = "auto", threshold: float = HIGH_CONFIDENCE) -> DataFrame:
    """Q10: per question, ``confidence`` = best page score; ``auto`` picks ``summary``
    when it is strictly above ``threshold``, else ``detailed``. A question without
    hits keeps its row: confidence 0.0, the fixed answer, no detail level."""
    if mode not in ("auto", SUMMARY, DETAILED):
        raise ValueError("mode must be auto, summary or detailed")
    best = page_hits.groupBy("qid").agg(F.max("score").alias("top_score"))
    j = questions.select("qid").join(best, "qid", "left")
    has = F.col("top_score").isNotNull()
    level = F.lit(mode) if mode != "auto" else F.when(F.col("top_score") > threshold, F.lit(SUMMARY)).otherwise(F.lit(DETAILED))
    return j.select(
        "qid",
        F.when(has, level).alias("detail_level"),
        F.coalesce(F.col("top_score"), F.lit(0.0)).alias("confidence"),
        F.when(~has, F.lit(NO_ANSWER)).alias("fixed_answer"),
    )


def answer_context(targets: DataFrame, index: SparseIndex, mode: str = "auto", k_page: int = 5, k_summary: int = 3,
                   k_para: int = 8, persist: bool = True) -> DataFrame:
    """Q11 for ``targets(qid, text, document_id)``.

    summary: the top ``k_summary`` pages as ``Page n: text``; detailed: the top
    ``k_para`` paragraphs on the top ``k_page`` pages as ``[Page n, ¶k]`` + newline
    + text. Context items are separated by a blank line, sources by '; '. The answer
    is the first two sentences of the best context item.

    The page hits feed the decision, the paragraph candidates and the summary items,
    so with ``persist`` they are written once (a small table: questions x k_page)."""
    q = targets.select("qid", "text")
    pages = with_text(materialize(search_within(q, index, targets, LEVEL_PAGE, ["document_id"], k_page)), index)
    if persist:
        pages = materialize(pages)
    decision = choose_detail(q, pages, mode)
    paras = with_text(materialize(search_within(q, index, pages, LEVEL_PARAGRAPH, ["document_id", "page_number"], k_para)), index)
    page_no = F.col("page_number").cast("string")
    summ_items = pages.filter(F.col("rank") <= k_summary).select(
        "qid", "rank", "text",
        F.concat(F.lit("Page "), page_no, F.lit(": "), F.col("text")).alias("item"),
        F.concat(F.lit("Page "), page_no).alias("source"),
        F.lit(SUMMARY).alias("kind"),
    )
    para_no = F.col("paragraph_number").cast("string")
    det_items = paras.select(
        "qid", "rank", "text",
        F.concat(F.lit("[Page "), page_no, F.lit(", ¶"), para_no, F.lit("]\n"), F.col("text")).alias("item"),
        F.concat(F.lit("Page "), page_no, F.lit(", ¶"), para_no).alias("source"),
        F.lit(DETAILED).alias("kind"),
    )
    items = summ_items.unionByName(det_items).join(
        decision.select("qid", F.col("detail_level").alias("kind")), ["qid", "kind"], "left_semi"
    )
    # one ordered aggregation gives context, sources and the lead item together
    per_q = items.groupBy("qid").agg(
        F.array_sort(F.collect_list(F.struct("rank", "item", "source", "text"))).alias("_it")
    ).select(
        "qid",
        F.array_join(F.transform("_it", lambda x: x["item"]), "\n\n").alias("context"),
        F.array_join(F.transform("_it", lambda x: x["source"]), "; ").alias("sources"),
        lead_sentences(F.element_at("_it", 1)["text"], 2).alias("lead"),
    )
    return decision.join(per_q, "qid", "left").select(
        "qid",
        "detail_level",
        "confidence",
        F.coalesce(F.col("fixed_answer"), F.col("lead")).alias("answer"),
        F.coalesce(F.col("context"), F.lit("")).alias("context"),
        F.coalesce(F.col("sources"), F.lit("")).alias("sources"),
    )
