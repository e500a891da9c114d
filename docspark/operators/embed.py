"""Chunking and embeddings.

The default embedder is a hashed term-frequency vector: term -> md5 bucket in
``[0, dim)``, counts per bucket, cosine over the counts. It is stored sparse as
``(id, bucket, tf)`` rows -- which is what lets retrieval run as an equi-join on
``bucket`` instead of a cross product -- and can be densified for small ``dim``.
A caller's own embedding function plugs in through :func:`embed_with`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.arrays import bind, prefix_sums
from ..functions.hashing import bucket
from ..functions.text import terms, word_tokens
from ..session import materialize

DEFAULT_DIM = 1 << 18
LEVEL_DOCUMENT, LEVEL_PAGE, LEVEL_PARAGRAPH = "document", "page", "paragraph"


def chunk_text(
    df: DataFrame,
    text_col: str = "content",
    max_tokens: int = 500,
    overlap: int = 50,
    keys: tuple[str, ...] = ("document_id", "page_number"),
) -> DataFrame:
    """X1 (M22, M25): overlapping windows of whitespace tokens.

    Window starts are ``0, step, 2*step, ...`` (``step = max_tokens - overlap``) up to
    the first window that reaches the end -- the proposed loop never stops there.
    ``chunk_number`` is 0-based. Empty text gives no chunk."""
    if not (0 <= overlap < max_tokens):
        raise ValueError("require 0 <= overlap < max_tokens")
    step = max_tokens - overlap

    def windows(tokens):
        n = F.size(tokens)
        starts = F.when(n > 0, F.sequence(F.lit(0), F.greatest(F.lit(0), n - overlap - 1), F.lit(step)))
        # offsets in the space-joined tokens: running sums over the windows' steps only
        steps = F.transform(starts, lambda s: F.length(F.array_join(F.slice(tokens, s + 1, F.lit(step)), " ")) + 1)
        return bind(starts, lambda starts: bind(prefix_sums(steps), lambda offset: F.transform(starts, lambda s, i: F.struct(
            i.alias("chunk_number"),
            F.array_join(F.slice(tokens, s + 1, F.lit(max_tokens)), " ").alias("text"),
            F.least(F.lit(max_tokens), n - s).cast("int").alias("token_count"),
            s.cast("int").alias("start_token"),
            F.least(s + max_tokens, n).cast("int").alias("end_token"),
            F.get(offset, i).cast("int").alias("start_offset")))))

    # the windows are cut inside the row: no window row carries the page's tokens
    return df.select(*keys, F.inline(bind(word_tokens(text_col), windows)))


def chunk_metadata(chunks: DataFrame) -> DataFrame:
    """``contains_numbers``, ``char_count``, ``end_offset`` next to the token range."""
    return chunks.withColumn("contains_numbers", F.col("text").rlike("[0-9]")).withColumn(
        "char_count", F.length("text").cast("int")
    ).withColumn("end_offset", (F.col("start_offset") + F.col("char_count")).cast("int"))


# Our page-feature rules.
TABLE_ROW = r"(?m)^[^|\n]*\|[^|\n]*\|[^\n]*$"
FORMULA = r"[=≈≤≥±∑∫√]|\$[^$\n]+\$"


def page_metadata(pages: DataFrame, text_col: str = "content") -> DataFrame:
    """``has_tables`` (a line with two or more cell bars) and ``has_formulas`` (a relation or
    maths sign, or inline ``$...$``)."""
    return pages.withColumn("has_tables", F.coalesce(F.col(text_col).rlike(TABLE_ROW), F.lit(False))).withColumn(
        "has_formulas", F.coalesce(F.col(text_col).rlike(FORMULA), F.lit(False))
    )


def term_vectors(df: DataFrame, id_col: str, text_col: str, dim: int = DEFAULT_DIM, keep: tuple[str, ...] = ()) -> DataFrame:
    """X2 sparse: ``(id, *keep, bucket, tf)``; ``keep`` are columns fixed per id
    (such as the level) carried along without a join."""
    t = df.select(F.col(id_col), *keep, F.explode(terms(text_col)).alias("_term"))
    # count distinct (id, term) first, so the hash runs once per distinct term of a
    # record rather than once per occurrence; colliding terms then merge per bucket
    per_term = t.groupBy(id_col, *keep, "_term").agg(F.count(F.lit(1)).alias("_c"))
    return per_term.groupBy(id_col, *keep, bucket("_term", dim).alias("bucket")).agg(F.sum("_c").alias("tf"))


def _by_record(df: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    """(*keys, _terms) with rows of equal keys next to each other in one task."""
    rows = df.select(*keys, F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    return rows.repartition(keys[0]).sortWithinPartitions(*reversed(keys)).select(*keys, terms("_text").alias("_terms"))


def _term_counts(batches, n_keys: int):
    """The terms of the records that pass in Arrow batches of :func:`_by_record`, counted.
    Yields ``(keys, owner, code, words, tf)``: the records' key columns and, of each entry,
    its record's place, its term as a place in ``words`` and its count, by record and code."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    held = None  # the last record, which the next batch may go on with
    for batch in batches:
        if not batch.num_rows:
            continue
        lists = batch.column(n_keys)
        size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        words, row = lists.flatten(), np.repeat(np.arange(len(size)), size)
        tf, keys = np.ones(len(words), dtype=np.int64), [batch.column(i) for i in range(n_keys)]
        if held is not None:
            keys = [pa.concat_arrays([a, b]) for a, b in zip(held[0], keys)]
            row = np.concatenate([np.zeros(len(held[1]), dtype=np.int64), row + 1])
            words, tf = pa.concat_arrays([held[1], words]), np.concatenate([held[2], tf])
        words = words.dictionary_encode()
        differs = np.zeros(len(keys[0]), dtype=bool)
        differs[0] = True
        for a in keys:
            at = a.dictionary_encode("encode").indices.to_numpy()
            differs[1:] |= at[1:] != at[:-1]
        records, n_words = pa.array(np.flatnonzero(differs)), max(1, len(words.dictionary))
        entry, place = np.unique((np.cumsum(differs) - 1)[row] * n_words + words.indices.to_numpy(), return_inverse=True)
        tf = np.bincount(place, weights=tf, minlength=len(entry)).astype(np.int64)
        keys, owner, code, done = [a.take(records) for a in keys], entry // n_words, entry % n_words, len(records) - 1
        cut = int(np.searchsorted(owner, done))
        if done:
            yield [a.slice(0, done) for a in keys], owner[:cut], code[:cut], words.dictionary, tf[:cut]
        held = [a.slice(done, 1) for a in keys], words.dictionary.take(pa.array(code[cut:])), tf[cut:]
    if held is not None:
        yield held[0], np.zeros(len(held[1]), dtype=np.int64), np.arange(len(held[1])), held[1], held[2]


def record_vectors(records: DataFrame, id_col: str, text_col: str, dim: int = DEFAULT_DIM, keep: tuple[str, ...] = ()) -> DataFrame:
    """The sparse vectors of :func:`term_vectors`, one row per record instead of one per
    term: ``(id, *keep, buckets, tfs, n2)``, buckets ascending, ``n2`` their squared norm.
    Records without an id are left out, those without terms too.

    Rows meet by id and come to the task in that order, so records that repeat an id
    are added up as they pass; a term never is a row of its own."""
    keys = [id_col, *keep]
    rows = _by_record(records.filter(F.col(id_col).isNotNull()), keys, text_col)
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("buckets", T.ArrayType(T.IntegerType())),
                           T.StructField("tfs", T.ArrayType(T.LongType())), T.StructField("n2", T.LongType())])

    def run(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        for names, owner, code, words, tf in _term_counts(batches, len(keys)):
            hashed = np.array([int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % dim for w in words.to_pylist()], dtype=np.int64)
            entry, place = np.unique(owner * dim + (hashed[code] if len(code) else 0), return_inverse=True)
            n, total = len(names[0]), np.bincount(place, weights=tf, minlength=len(entry)).astype(np.int64)
            owner = entry // dim
            n2 = np.zeros(n, dtype=np.int64)
            np.add.at(n2, owner, total * total)
            ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))]).astype(np.int32)
            out = pa.RecordBatch.from_arrays(
                [*names, pa.ListArray.from_arrays(ends, (entry % dim).astype(np.int32)), pa.ListArray.from_arrays(ends, total), pa.array(n2)],
                names=[*keys, "buckets", "tfs", "n2"])
            yield out.filter(pc.greater(out.column("n2"), 0))

    return rows.mapInArrow(run, schema)


def record_terms(records: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The different terms of each record with their counts, one row per id (null too):
    ``(id, terms, tfs)``."""
    rows = _by_record(records, [id_col], text_col)
    schema = T.StructType([rows.schema[id_col], T.StructField("terms", T.ArrayType(T.StringType())),
                           T.StructField("tfs", T.ArrayType(T.LongType()))])

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for names, owner, code, words, tf in _term_counts(batches, 1):
            ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(names[0])))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*names, pa.ListArray.from_arrays(ends, words.take(pa.array(code))), pa.ListArray.from_arrays(ends, tf)],
                names=[id_col, "terms", "tfs"])

    return rows.mapInArrow(run, schema)


def vector_norms(vectors: DataFrame, id_col: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Squared L2 norm per id (an integer for term counts, so exact)."""
    return vectors.groupBy(id_col, *keep).agg(F.sum(F.col("tf") * F.col("tf")).alias("n2"))


def dense_vectors(vectors: DataFrame, id_col: str, dim: int) -> DataFrame:
    """X2 dense: L2-normalised ``array<float>`` of length ``dim`` (for small ``dim``)."""
    per = vectors.groupBy(id_col).agg(
        F.map_from_entries(F.collect_list(F.struct("bucket", "tf"))).alias("_m"),
        F.sqrt(F.sum(F.col("tf") * F.col("tf"))).alias("_norm"),
    )
    vec = F.transform(
        F.sequence(F.lit(0), F.lit(dim - 1)),
        lambda i: (F.coalesce(F.element_at("_m", i), F.lit(0)) / F.col("_norm")).cast("float"),
    )
    return per.select(id_col, vec.alias("embedding"))


def embed_with(df: DataFrame, fn: Callable[[list[str]], list[list[float]]], id_col: str = "id", text_col: str = "text") -> DataFrame:
    """X2 with a caller's embedder, called once per Arrow batch (size set by
    ``spark.sql.execution.arrow.maxRecordsPerBatch``, 100 in the original design)."""
    schema = T.StructType([T.StructField(id_col, T.StringType()), T.StructField("embedding", T.ArrayType(T.FloatType()))])

    def run(batches):
        import pandas as pd

        for pdf in batches:
            vecs = fn([("" if t is None else str(t)) for t in pdf[text_col]])
            yield pd.DataFrame({id_col: pdf[id_col].astype(str), "embedding": [list(map(float, v)) for v in vecs]})

    return df.select(F.col(id_col).cast("string").alias(id_col), text_col).mapInPandas(run, schema)


def build_embeddings(
    doc_summaries: DataFrame,
    page_summaries: DataFrame,
    pages: DataFrame,
    max_tokens: int = 500,
    overlap: int = 50,
) -> DataFrame:
    """X3 (M23-M25): the three levels in one table.

    document: the successful document summary, id ``{doc}_doc``;
    page: successful pages with a non-empty summary, id ``{doc}_page_{n}``;
    paragraph: chunks of those pages' text, id ``{doc}_page_{n}_para_{k}``
    (actual page numbers, not ``1..count``).

    Records carry has_tables (of their page), contains_numbers and, for paragraphs,
    their character offsets."""
    none = F.lit(None).cast("int")
    has_numbers = F.col("text").rlike("[0-9]").alias("contains_numbers")
    docs = doc_summaries.filter(F.col("status") == "success").select(
        F.concat(F.col("document_id"), F.lit("_doc")).alias("id"),
        F.lit(LEVEL_DOCUMENT).alias("level"),
        "document_id",
        none.alias("page_number"),
        none.alias("paragraph_number"),
        F.col("summary").alias("text"),
        F.lit(None).cast("boolean").alias("has_tables"),
        F.col("summary").rlike("[0-9]").alias("contains_numbers"),
        none.alias("start_offset"),
        none.alias("end_offset"),
    )
    ok_pages = page_summaries.filter(
        (F.col("status") == "success") & F.col("summary").isNotNull() & (F.col("summary") != "")
    )
    flags = page_metadata(pages).select("document_id", F.col("page_number").alias("page"), "has_tables")
    pgs = ok_pages.join(flags, ["document_id", "page"], "left").select(
        F.concat(F.col("document_id"), F.lit("_page_"), F.col("page").cast("string")).alias("id"),
        F.lit(LEVEL_PAGE).alias("level"),
        "document_id",
        F.col("page").alias("page_number"),
        none.alias("paragraph_number"),
        F.col("summary").alias("text"),
        "has_tables",
        F.col("summary").rlike("[0-9]").alias("contains_numbers"),
        none.alias("start_offset"),
        none.alias("end_offset"),
    )
    content = page_metadata(pages).join(
        ok_pages.select("document_id", F.col("page").alias("page_number")), ["document_id", "page_number"], "left_semi"
    ).filter(F.col("content").isNotNull() & (F.col("content") != ""))
    ch = chunk_metadata(chunk_text(content, "content", max_tokens, overlap, keys=("document_id", "page_number", "has_tables")))
    paras = ch.select(
        F.concat(
            F.col("document_id"), F.lit("_page_"), F.col("page_number").cast("string"),
            F.lit("_para_"), F.col("chunk_number").cast("string"),
        ).alias("id"),
        F.lit(LEVEL_PARAGRAPH).alias("level"),
        "document_id",
        "page_number",
        F.col("chunk_number").alias("paragraph_number"),
        "text",
        "has_tables",
        has_numbers,
        "start_offset",
        "end_offset",
    )
    return docs.unionByName(pgs).unionByName(paras)


def document_topics(pages: DataFrame, k: int = 5) -> DataFrame:
    """The topic terms (X6) of each document over all its pages: (document_id, topics),
    best first."""
    best = topics(pages, "document_id", "content", k)
    ordered = F.array_sort(F.collect_list(F.struct("rank", "term")))  # k terms at most
    return best.groupBy("document_id").agg(F.transform(ordered, lambda t: t["term"]).alias("topics"))


def embedding_stats(records: DataFrame) -> DataFrame:
    """Records per level and document (conditional counts, one shuffle)."""
    return records.groupBy("document_id").agg(
        F.count(F.lit(1)).alias("embedding_count"),
        F.count_if(F.col("level") == LEVEL_DOCUMENT).alias("document_level"),
        F.count_if(F.col("level") == LEVEL_PAGE).alias("page_level"),
        F.count_if(F.col("level") == LEVEL_PARAGRAPH).alias("paragraph_level"),
    )


def token_and_cost(records: DataFrame, price_per_million: float = 0.13) -> DataFrame:
    """Whitespace tokens and cost per level and document, with level subtotals
    and a grand total (``rollup``). Cost in micro-dollars is exact (integer tokens
    times the integer price in micro-dollars per million tokens)."""
    micro = int(round(price_per_million * 1_000_000))
    tok = records.select("level", "document_id", F.size(word_tokens("text")).alias("tokens"))
    return tok.rollup("level", "document_id").agg(
        F.sum("tokens").cast("bigint").alias("tokens"),
        (F.sum("tokens").cast("decimal(38,0)") * F.lit(micro) / F.lit(1_000_000)).cast("decimal(38,6)").alias("cost_micro_usd"),
        F.count(F.lit(1)).alias("records"),
    )


def topics(df: DataFrame, id_col: str, text_col: str, k: int = 5) -> DataFrame:
    """Top ``k`` TF-IDF terms per record (ties: term order), as ``(id, rank, term,
    score)``. ``rank <= k`` sits directly over the window, so Spark plans a group
    limit and does not carry whole groups through the shuffle.

    A record's terms and counts are one row, written once; they become rows of their own
    only to meet the terms that more than one record has, a table written too, so that
    its size is known and Spark can send a small one to the rows instead of both to a
    shuffle."""
    counted = materialize(record_terms(df, id_col, text_col))
    dfreq = materialize(counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).filter("df > 1"))
    # corpus size as a scalar subquery: computed once, used as a value (no join)
    n_docs = counted.agg(F.count(F.lit(1))).scalar()
    tf = counted.select(id_col, F.inline(F.arrays_zip(F.col("terms").alias("term"), F.col("tfs").alias("tf"))).alias("term", "tf"))
    scored = tf.join(dfreq, "term", "left").withColumn("score", F.col("tf") * F.log(n_docs / F.coalesce("df", F.lit(1))))
    w = Window.partitionBy(id_col).orderBy(F.col("score").desc(), "term")
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select(
        id_col, "rank", "term", "score"
    )


def section_of_page(pages: DataFrame, heading_col: str = "heading", key: str = "document_id", order: str = "page_number",
                    block: int = 1024) -> DataFrame:
    """The nearest non-null heading at or before each page of a document.

    A running "last non-null" over a document would put a huge document in one task,
    so it runs in two levels: within blocks of ``block`` pages (spread over tasks),
    then a carry from earlier blocks computed over one row per block."""
    b = pages.withColumn("_blk", F.floor(F.col(order) / block))
    w_in = Window.partitionBy(key, "_blk").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    b = b.withColumn("_last_in", F.last(heading_col, ignorenulls=True).over(w_in))
    per_block = b.filter(F.col(heading_col).isNotNull()).groupBy(key, "_blk").agg(
        F.max_by(heading_col, order).alias("_blk_last")
    )
    w_b = Window.partitionBy(key).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    # blocks without any heading still need the carry from earlier blocks
    blocks = b.select(key, "_blk").distinct()
    carry_all = blocks.join(per_block, [key, "_blk"], "left").withColumn(
        "_carry", F.last("_blk_last", ignorenulls=True).over(w_b)
    )
    return (
        b.join(carry_all.select(key, "_blk", "_carry"), [key, "_blk"], "left")
        .withColumn("section", F.coalesce(F.col("_last_in"), F.col("_carry")))
        .drop("_blk", "_last_in", "_carry")
    )
