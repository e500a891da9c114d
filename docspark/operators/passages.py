"""Q15: passages that documents share, found by winnowed fingerprints of their terms."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrays import bind
from ..functions.text import terms
from ..session import materialize


PLACES = 1 << 30  # more than an array of terms can hold


def seeds(docs: DataFrame, gram: int = 12, window: int = 9) -> DataFrame:
    """Winnowed fingerprints of ``docs(document_id, texts)``, the texts of a document's
    pages in order: of every ``window`` neighbouring grams of ``gram`` terms the one whose
    first term has the least hash (the first of several). One row per chosen gram:
    ``seed`` (60 bits of its md5), its first term ``pos``, page, and the chosen grams
    before and after it with their distances.

    All of it is made inside the document's row, in time linear in its terms; terms are
    hashed, grams only where chosen. A document of fewer terms than a gram has no row."""
    per_page = F.transform("texts", lambda t: terms(t))

    def number(text, digits):
        return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")

    def chosen(t):
        hashes = F.transform(F.slice(t, 1, F.size(t) - (gram - 1)), lambda x, i: number(x, 8) * PLACES + i)
        least = bind(hashes, lambda h: F.transform(
            F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(h) - window)),
            lambda i: (F.array_min(F.slice(h, i + 1, window)) % PLACES).cast("int")))
        places = bind(least, lambda x: F.filter(x, lambda p, i: (i == 0) | (F.get(x, i - 1) != p)))
        return F.transform(places, lambda p: F.struct(
            number(F.array_join(F.slice(t, p + 1, gram), " "), 15).alias("seed"), p.alias("pos")))

    def linked(found, page_of):
        return F.transform(found, lambda g, i: F.struct(
            g["seed"].alias("seed"), g["pos"].alias("pos"), F.get(page_of, g["pos"]).alias("page_number"),
            F.get(found, i - 1)["seed"].alias("before"), (g["pos"] - F.get(found, i - 1)["pos"]).alias("gap_before"),
            F.get(found, i + 1)["seed"].alias("after"), (F.get(found, i + 1)["pos"] - g["pos"]).alias("gap_after")))

    def of_document(pages):  # a text's terms are found once, however often they are used
        page_of = F.flatten(F.transform(pages, lambda t, p: F.transform(t, lambda _: p + 1)))
        return bind(F.flatten(pages), lambda t: F.when(F.size(t) >= gram, bind(
            page_of, lambda page: bind(chosen(t), lambda found: linked(found, page)))))

    return docs.select("document_id", F.inline(bind(per_page, of_document)))


def shared_passages(docs: DataFrame, gram: int = 12, window: int = 9) -> tuple[DataFrame, DataFrame]:
    """Q15: the passages that occur more than once in a corpus, whole, as classes: a
    passage in very many documents is one row and its members, never their pairs.

    Two occurrences of a run of at least ``gram + window - 1`` terms choose the same
    grams in it, so every such run is found, whatever its pages are. Chosen grams that
    follow each other at one distance wherever either of them occurs are chained; a chain
    is a passage, which changes where the set of its members does. Its first and last
    gram lie within ``window - 1`` terms of the ends of the run.

    Returns passages (passage_id, n_members, n_terms: from the first gram's first to the
    last gram's last term) and members (passage_id, document_id, start_term, page_number).
    The id names the first occurrence, by document id and term. Counting is one
    aggregate by gram, combined before its shuffle; chains are put together over one
    row per different gram, in the document of its first occurrence."""
    found = materialize(seeds(docs, gram, window))
    always = {}
    for side in ("before", "after"):
        step = F.struct(side, f"gap_{side}")
        same = (F.min(step) == F.max(step)) & (F.count(side) == F.count(F.lit(1)))
        always[side] = F.when(same, F.min(step)).alias(side)  # null: not the same everywhere
    classes = found.groupBy("seed").agg(
        F.count(F.lit(1)).alias("n_members"), F.min(F.struct("document_id", "pos")).alias("first"),
        always["before"], always["after"]).filter(F.col("n_members") > 1)
    line = Window.partitionBy("first.document_id").orderBy("first.pos")
    goes_on = (F.lag("seed").over(line) == F.col("before.before")) & (F.lag("after.after").over(line) == F.col("seed"))
    parts = classes.withColumn("goes_on", F.coalesce(goes_on, F.lit(False)))
    parts = parts.withColumn("chain", F.count_if(~F.col("goes_on")).over(line.rowsBetween(Window.unboundedPreceding, 0)))
    chains = parts.groupBy(F.col("first.document_id").alias("d"), "chain").agg(
        F.min("first.pos").alias("start"), F.max("first.pos").alias("end"), F.max("n_members").alias("n_members"),
        F.min_by("seed", "first.pos").alias("seed"))
    passages = materialize(chains.select(
        F.concat_ws("@", "d", F.col("start").cast("string")).alias("passage_id"), "n_members",
        (F.col("end") - F.col("start") + gram).cast("int").alias("n_terms"), "seed"))
    members = found.select("seed", "document_id", F.col("pos").alias("start_term"), "page_number").join(
        passages.select("seed", "passage_id"), "seed").drop("seed")
    return passages.drop("seed"), members
