"""Corpus analytics (Q13-Q18): mentions, amounts, near-duplicate sections, topic
clusters, version diffs and audit trails."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrays import bind, prefix_sums
from ..functions.hashing import content_hash
from ..functions.text import terms
from ..session import materialize
from .blocks import meet

# Fixed value: a number mention, digits grouped by commas or plain, then decimals.
NUMBER_PATTERN = r"[0-9]{1,3}(?:,[0-9]{3})+(?:\.[0-9]+)?|[0-9]+(?:\.[0-9]+)?"


def mentions(phrases: DataFrame, docs: DataFrame, window: int = 5, key_gram: int = 3, block: int = 512) -> DataFrame:
    """Q13: every occurrence of each phrase's whole term sequence in each document, with
    the page, a context window of ``window`` terms each side and the term position.

    ``phrases(pid, text)``, ``docs(document_id, texts)`` with the texts of a document's
    pages in order; a phrase may run over a page's end. Candidates come from an
    equi-join of the phrase's first ``key_gram`` terms (all, if fewer) with the grams
    of the documents that are as long as some phrase's, rows of position and gram only. A candidate meets one block of
    ``block`` terms (with the overlap that a phrase and its context need), where the
    whole phrase is compared, so no row ever holds a document's terms."""
    ph = phrases.select("pid", terms("text").alias("pt")).filter(F.size("pt") > 0)
    ph = ph.withColumn("key", F.array_join(F.slice("pt", 1, key_gram), " "))
    longest, sizes = ph.agg(F.coalesce(F.max(F.size("pt")), F.lit(0)),
                            F.collect_set(F.least(F.size("pt"), F.lit(key_gram)))).first()  # a number, and at most key_gram
    if not sizes:
        sizes = [key_gram]
    per_page = F.transform("texts", lambda t: terms(t))
    d = docs.select("document_id", F.flatten(per_page).alias("dt"),
                    prefix_sums(F.transform(per_page, lambda t: F.size(t))).alias("starts"))
    span = longest + window  # a block reaches this far beyond its own terms
    n = F.size("dt")
    blocks = d.filter(n > 0).select(
        "document_id", F.col("starts"), n.alias("n"),
        F.posexplode(bind(F.col("dt"), lambda t: F.transform(
            F.sequence(F.lit(0), F.floor((n - 1) / block).cast("int")),
            lambda b: F.slice(t, F.greatest(F.lit(1), b * block + 1 - window), block + span + F.least(b * block, F.lit(window))))))
        .alias("blk", "part"))
    first = F.least(F.col("blk") * block, F.lit(window))  # where the block's own terms begin in `part`
    own = F.least(F.lit(block), F.col("n") - F.col("blk") * block)
    grams = F.flatten(F.transform(
        F.sequence(F.lit(0), own - 1),
        lambda i: F.transform(F.array(*[F.lit(g) for g in sorted(sizes)]), lambda g: F.struct(
            i.alias("i"), F.array_join(F.slice("part", first + i + 1, g), " ").alias("gram"),
            (F.col("blk") * block + i + g <= F.col("n")).alias("whole")))))
    found = (blocks.select("document_id", "blk", F.inline(grams)).filter("whole")
             .join(ph.select("pid", "key", "pt"), F.col("gram") == F.col("key"))
             .select("pid", "pt", "document_id", "blk", "i"))
    at = first + F.col("i")
    hits = found.join(blocks, ["document_id", "blk"]).filter(F.slice("part", at + 1, F.size("pt")) == F.col("pt"))
    pos = F.col("blk") * block + F.col("i")
    left = F.least(at, F.lit(window))
    return hits.select(
        "pid", "document_id", pos.cast("int").alias("term_position"),
        F.size(F.filter("starts", lambda s: s <= pos)).alias("page_number"),
        F.array_join(F.slice("part", at - left + 1, left + F.size("pt") + window), " ").alias("context"))


def extract_amounts(pages: DataFrame, text_col: str = "content") -> DataFrame:
    """Q14: number mentions per page as exact decimals. A mention too long for the
    decimal type is reported with a null amount."""
    ex = pages.select("document_id", "page_number", F.explode(F.regexp_extract_all(F.col(text_col), F.lit(NUMBER_PATTERN), 0)).alias("mention"))
    return ex.withColumn("amount", F.replace(F.col("mention"), F.lit(","), F.lit("")).try_cast("decimal(38,4)"))


def amounts_by_document(pages: DataFrame, text_col: str = "content") -> DataFrame:
    """Q14 roll-up: count, unparsable mentions, exact sum and maximum per document."""
    return extract_amounts(pages, text_col).groupBy("document_id").agg(
        F.count(F.lit(1)).alias("n_amounts"),
        F.count_if(F.col("amount").isNull()).alias("n_unparsed"),
        F.sum("amount").cast("decimal(38,4)").alias("total"),
        F.max("amount").alias("largest"),
    )


# Fixed value: a number mention that is a year.
YEAR_PATTERN = r"^(?:19|20)[0-9]{2}$"


def amounts_by_year(pages: DataFrame, text_col: str = "content") -> DataFrame:
    """Q14 per year: an amount belongs to the nearest year mention before it in its
    document (null: none), a positional as-of join. Returns (document_id, year,
    n_amounts, n_unparsed, total).

    Mentions are matched within their page; a page hands only its last year on to the
    next ones, so a document's window holds one row per page, not its mentions."""
    at = pages.select("document_id", "page_number", F.posexplode(
        F.regexp_extract_all(F.col(text_col), F.lit(NUMBER_PATTERN), 0)).alias("pos", "mention"))
    year = F.when(F.col("mention").rlike(YEAR_PATTERN), F.col("mention").cast("int"))
    page = Window.partitionBy("document_id", "page_number").orderBy("pos")
    at = at.withColumn("own", year).withColumn("year", F.last("own", ignorenulls=True).over(
        page.rowsBetween(Window.unboundedPreceding, 0)))
    ends = at.groupBy("document_id", "page_number").agg(F.max_by("own", F.when(F.col("own").isNotNull(), F.col("pos"))).alias("last_year"))
    earlier = Window.partitionBy("document_id").orderBy("page_number").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("document_id", "page_number", F.last("last_year", ignorenulls=True).over(earlier).alias("carried"))
    amount = F.replace(F.col("mention"), F.lit(","), F.lit("")).try_cast("decimal(38,4)")
    return (at.filter(F.col("own").isNull()).join(carried, ["document_id", "page_number"])
            .select("document_id", F.coalesce("year", "carried").alias("year"), amount.alias("amount"))
            .groupBy("document_id", "year").agg(
                F.count(F.lit(1)).alias("n_amounts"), F.count_if(F.col("amount").isNull()).alias("n_unparsed"),
                F.sum("amount").cast("decimal(38,4)").alias("total")))


def term_sets(records: DataFrame, id_col: str = "document_id", text_col: str = "text") -> DataFrame:
    """Distinct terms of each record with a key of the set (md5 of the sorted terms)."""
    s = records.select(F.col(id_col).alias("rid"), F.array_distinct(terms(text_col)).alias("s")).filter(F.size("s") > 0)
    return s.withColumn("set_key", F.md5(F.array_join(F.sort_array("s"), " ")))


def duplicate_groups(records: DataFrame, id_col: str = "document_id", text_col: str = "text") -> DataFrame:
    """Records with identical term sets: one row per member ``(member, representative,
    copies)``, the smallest id as representative, for groups of two or more. A group is
    its members, however large, instead of all its pairs."""
    sets = term_sets(records, id_col, text_col)
    groups = (sets.groupBy("set_key").agg(F.min("rid").alias("representative"), F.count(F.lit(1)).alias("copies"))
              .filter(F.col("copies") > 1))
    return sets.select(F.col("rid").alias("member"), "set_key").join(groups, "set_key").select("member", "representative", "copies")


#: A prefix term's row carries a sketch of so many bits, if the set has no more terms than this.
SKETCH, SKETCHED = 256, 640


def parity_bits(term, owner, width):
    """Parity sketches, packed: bit b of a set of ``width`` bits (numpy, one entry per set;
    ``owner``: the terms' sets) tells whether an odd number of its terms falls on b. Sketches
    of two sets differ in no more bits than the sets in terms. Widths are powers of two of 8 at
    least; halves added up give the sketch of half the width. Returns bytes and their ends."""
    import numpy as np

    ends = np.concatenate([[0], np.cumsum(width)])
    used = width[owner] > 0
    at = ends[owner[used]] + ((term[used] >> 32) & (width[owner[used]] - 1))
    odd = (np.bincount(at, minlength=ends[-1]) & 1).astype(np.uint8)
    return np.packbits(odd), (ends // 8).astype(np.int32)


def rarest_terms(sets: DataFrame, threshold: float, slots: int = 1 << 20, kept: dict | None = None) -> DataFrame:
    """The prefix terms of each set ``(rid, h)`` of hashed terms, rarest first: ``(rid,
    term, n, r, prev, bits)`` with the set's size, the term's place from 1, the term
    before it (0 at first) and the set's :func:`parity_bits`.

    The order is by a sketch of the frequencies, one counter for each of ``slots``
    remainders of the hash, then by hash. Any order that all sets share gives the same
    pairs; the sketch, of fixed size, gives nearly that of the true frequencies, and a
    set is ordered where it lies. Terms of equal hash keep their places in the set.
    ``kept`` (a bit map, by blocks of 32,768 rids) says which sets count, if not all."""
    import numpy as np

    def count(batches):
        import pyarrow as pa

        total = np.zeros(slots, dtype=np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy() % slots, minlength=slots)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["slot", "count"])

    found = sets.select("h").mapInArrow(count, "slot int, count long").groupBy("slot").agg(F.sum("count").alias("count")).toArrow()
    sketch = np.zeros(slots, dtype=np.int32)  # bounded: ``slots`` counters
    sketch[found["slot"].to_numpy()] = np.minimum(found["count"].to_numpy(), 2**31 - 1)
    del found

    def prefixes(batches):
        import pyarrow as pa

        for batch in batches:
            if kept is not None:
                batch = batch.filter(pa.array(in_bit_map(kept, batch.column(0).to_numpy())))
            lists = batch.column(1)
            size = lists.value_lengths().to_numpy().astype(np.int64)
            term, owner = lists.flatten().to_numpy(), np.repeat(np.arange(len(size)), size)
            order = np.lexsort((term, sketch[term % slots], owner))
            term, owner = term[order], owner[order]
            first = np.cumsum(size) - size
            r = np.arange(len(term)) - np.repeat(first, size) + 1
            prev = np.concatenate([[0], term[:-1]])
            prev[r == 1] = 0
            data, ends = parity_bits(term, owner, np.where(size <= SKETCHED, SKETCH, 0))
            packed = pa.BinaryArray.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(data)])
            keep = r <= (size - np.ceil(threshold * size - 1e-9).astype(np.int64) + 1)[owner]
            of = pa.array(owner[keep])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(of), pa.array(term[keep]), pa.array(size[owner[keep]].astype(np.int32)), pa.array(r[keep].astype(np.int32)),
                 pa.array(prev[keep]), packed.take(of)],
                names=["rid", "term", "n", "r", "prev", "bits"])

    return sets.select("rid", "h").mapInArrow(
        prefixes, f"rid {dict(sets.dtypes)['rid']}, term long, n int, r int, prev long, bits binary")


def bit_map(refs: DataFrame) -> dict[int, bytes]:
    """``refs(ref, ...)`` as bits, by blocks of 32,768 of them: a bit per record on the driver."""
    bits = F.bitmap_construct_agg(F.col("ref").bitwiseAND(F.lit(32767).cast("long"))).alias("bits")
    return {r.block: bytes(r.bits) for r in refs.groupBy(F.shiftright("ref", 15).alias("block")).agg(bits).collect()}


def in_bit_map(bits: dict[int, bytes], refs):
    """Which of ``refs`` have their bit in a :func:`bit_map`."""
    import numpy as np

    out = np.zeros(len(refs), dtype=bool)
    for block in np.unique(refs >> 15).tolist():
        if block in bits:
            mine = refs >> 15 == block
            at = refs[mine] & 32767
            out[mine] = np.frombuffer(bits[block], dtype=np.uint8)[at >> 3] >> (at & 7).astype(np.uint8) & 1
    return out


def meeting_pairs(threshold: float, most: int = 1 << 19):
    """The step over rows ``(term, n, rid, r, prev, bits)`` by term and n that gives pairs
    ``(a, b, n)`` of sets that may reach the threshold, with the larger one's size; ``most``
    pairs at a time.

    Two sets follow one order, so the first term that they share leaves at least all but one of
    the shared ones behind it in either, and its predecessors differ: a term that cannot be
    the first shared one gives no pair. Sets whose sketches differ in more bits
    than sets of their sizes may differ in terms give none either."""
    def step(batches):
        import numpy as np
        import pyarrow as pa

        def columns(batch):
            c = {k: batch.column(k).to_numpy() for k in ("term", "n", "rid", "r", "prev")}
            c["n"], c["r"] = c["n"].astype(np.int64), c["r"].astype(np.int64)
            c["bits"] = np.zeros((len(batch), SKETCH // 64), dtype=np.uint64)
            c["bits"][c["n"] <= SKETCHED] = np.frombuffer(b"".join(batch.column("bits").to_pylist()), dtype=np.uint64).reshape(-1, SKETCH // 64)
            return c

        def some(c, i, j):
            nx, ny = c["n"][i], c["n"][j]
            need = np.ceil(threshold / (1.0 + threshold) * (nx + ny) - 1e-9).astype(np.int64)
            ok = (c["r"][i] <= nx - need + 1) & (c["r"][j] <= ny - need + 1)
            ok &= (c["prev"][i] != c["prev"][j]) | (c["r"][i] == 1) | (c["r"][j] == 1)
            i, j, may = i[ok], j[ok], (nx + ny - 2 * need)[ok]
            both = np.flatnonzero(c["n"][j] <= SKETCHED)
            differ = np.zeros(len(both), dtype=np.int64)
            for w in range(SKETCH // 64):
                differ += np.bitwise_count(c["bits"][i[both], w] ^ c["bits"][j[both], w])
            ok = np.ones(len(i), dtype=bool)
            ok[both[differ > may[both]]] = False
            i, j = i[ok], j[ok]
            a, b = c["rid"][i], c["rid"][j]
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(c["n"][j])], names=["a", "b", "n"])

        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            c = columns(batch)
            old = 0
            if held is not None and held["term"][-1] == c["term"][0]:
                old = len(held["term"])
                c = {k: np.concatenate([held[k], c[k]]) for k in c}
            total = len(c["term"])
            # rows by term and size: a row's partners follow it, up to its size / threshold
            starts = np.flatnonzero(np.concatenate([[True], c["term"][1:] != c["term"][:-1]]))
            run = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, total)))
            span = int(c["n"].max() / threshold) + 3
            end = np.searchsorted(run * span + c["n"], run * span + np.floor(c["n"] / threshold + 1e-9).astype(np.int64), "right")
            begin = np.maximum(np.arange(total) + 1, old)  # pairs of held rows were looked at before
            pairs = np.cumsum(np.maximum(end - begin, 0))
            at = 0
            while at < total:
                to = max(at + 1, int(np.searchsorted(pairs, (pairs[at - 1] if at else 0) + most, "right")))
                size = np.maximum(end[at:to] - begin[at:to], 0)
                i = np.repeat(np.arange(at, to), size)
                j = np.arange(len(i)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(begin[at:to], size)
                if len(i):
                    yield some(c, i, j)
                at = to
            last = (c["term"] == c["term"][-1]) & (c["n"] >= threshold * c["n"][-1] - 1e-9)
            held = {k: v[last] for k, v in c.items()}

    return step


#: A wider sketch for pairs with a set of more terms than this, which are tried by it before their terms meet.
WIDE_SKETCH, WIDE_OVER = 2048, 320


def wide_sketches(threshold: float):
    """The step that gives sets ``(ref, h)`` that may have a partner of more than
    :data:`WIDE_OVER` terms a sketch of :data:`WIDE_SKETCH` bits: ``(ref, n, bits)``."""
    least = int(threshold * WIDE_OVER)

    def step(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            batch = batch.filter(pa.array(batch.column(1).value_lengths().to_numpy() >= least))
            lists = batch.column(1)
            size = lists.value_lengths().to_numpy().astype(np.int64)
            data, ends = parity_bits(lists.flatten().to_numpy(), np.repeat(np.arange(len(size)), size), np.full(len(size), WIDE_SKETCH))
            packed = pa.BinaryArray.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size), packed], names=["ref", "n", "bits"])

    return step


def near_sketches(threshold: float):
    """The step of a group that keeps pairs whose wide sketches are near enough."""
    def run(rows, pairs):
        import numpy as np
        import pyarrow as pa

        ref, n = rows["ref"].to_numpy(), rows["n"].to_numpy()
        bits = np.frombuffer(b"".join(rows["bits"].to_pylist()), dtype=np.uint64).reshape(len(ref), -1)
        for batch in pairs.to_batches(100_000):
            a, b = (np.searchsorted(ref, batch.column(k).to_numpy()) for k in (0, 1))
            need = np.ceil(threshold / (1.0 + threshold) * (n[a] + n[b]) - 1e-9).astype(np.int64)
            differ = np.zeros(len(a), dtype=np.int64)
            for w in range(bits.shape[1]):
                differ += np.bitwise_count(bits[a, w] ^ bits[b, w])
            yield batch.filter(pa.array(differ <= n[a] + n[b] - 2 * need))

    return run


def shared_terms(threshold: float, most: int = 1 << 21):
    """The step of a group that counts the terms that the sets of its pairs share, a set's
    partners in one go (``most`` terms of them at a time)."""
    def run(rows, pairs):
        import numpy as np
        import pyarrow as pa

        rows = rows.to_batches()[0] if rows.num_rows else None
        ref, lists = rows.column("ref").to_numpy(), rows.column("h")
        size = lists.value_lengths().to_numpy().astype(np.int64)
        start = np.cumsum(size) - size
        codes = np.unique(lists.flatten().to_numpy(), return_inverse=True)[1]
        a, b = (np.searchsorted(ref, pairs[k].to_numpy()) for k in ("a", "b"))
        shared = np.zeros(len(a), dtype=np.int64)
        mark = np.zeros(len(codes), dtype=bool)
        at = 0
        ends = np.append(np.flatnonzero(a[1:] != a[:-1]) + 1, len(a))
        for end in ends.tolist():
            mine = codes[start[a[at]]:start[a[at]] + size[a[at]]]
            mark[mine] = True
            while at < end:
                to = at + max(1, int(np.searchsorted(np.cumsum(size[b[at:end]]), most, "right")))
                with_ = b[at:to]
                first = np.cumsum(size[with_]) - size[with_]
                place = np.arange(size[with_].sum()) + np.repeat(start[with_] - first, size[with_])
                shared[at:to] = np.add.reduceat(mark[codes[place]].astype(np.int64), first)
                at = to
            mark[mine] = False
        union = size[a] + size[b] - shared
        near = np.flatnonzero(shared / union >= threshold)
        a, b, shared, union = a[near], b[near], shared[near], union[near]
        for i in range(0, len(a), 50_000):
            x, y = (pa.array(k[i:i + 50_000]) for k in (a, b))
            out = [rows.column(c).take(k) for k in (x, y) for c in ("rid", "own", "size", "copies")]
            yield pa.RecordBatch.from_arrays(
                [*out, pa.array(shared[i:i + 50_000].astype(np.int32)), pa.array(union[i:i + 50_000].astype(np.int32))],
                names=[c + s for s in ("_a", "_b") for c in ("rid", "own", "size", "copies")] + ["shared", "union_size"])

    return run


def _similar(records: DataFrame, threshold: float, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The records as ``(ref, rid, own, size)`` -- ``own`` names a record's term set, which
    ``size`` records have -- and the pairs of sets that reach the threshold, once each:
    ``(rid_a, own_a, size_a, copies_a, rid_b, ..., shared, union_size)``."""
    if not (0.0 < threshold <= 1.0):
        raise ValueError("threshold must be in (0, 1]")
    # written once: terms as hashes, of which a file's dictionary holds the different ones
    sets = materialize(
        term_sets(records, id_col, text_col).select(
            F.monotonically_increasing_id().alias("ref"), "rid", "set_key", F.transform("s", lambda t: F.xxhash64(t)).alias("h")),
        options={"parquet.dictionary.page.size": str(16 << 20)})
    groups = sets.groupBy("set_key").agg(F.min("ref").alias("own"), F.min("rid").alias("least"), F.count(F.lit(1)).alias("size"))
    rows = materialize(sets.select("ref", "rid", "set_key").join(groups, "set_key").select("ref", "rid", "own", "size", "least"))
    copies = rows.select("own", "least", "size").distinct().groupBy("least").agg(F.collect_list("size").alias("copies"))
    chosen = materialize(rows.join(copies.withColumnRenamed("least", "rid"), "rid").select("ref", "rid", "own", "size", "copies"))
    pref = rarest_terms(sets.select(F.col("ref").alias("rid"), "h"), threshold, kept=bit_map(chosen))
    found = pref.select("term", "n", "rid", "r", "prev", "bits").repartition("term").sortWithinPartitions("term", "n").mapInArrow(
        meeting_pairs(threshold), "a long, b long, n long")
    pairs = materialize(found.groupBy("a", "b").agg(F.max("n").alias("n")))
    tried = materialize(meet(pairs.filter(F.col("n") > WIDE_OVER), sets.select("ref", "h").mapInArrow(
        wide_sketches(threshold), "ref long, n long, bits binary"), near_sketches(threshold), "a long, b long", per=400_000, labels=False))
    pairs = pairs.filter(F.col("n") <= WIDE_OVER).select("a", "b").unionAll(tried)
    paired = bit_map(pairs.select(F.explode(F.array("a", "b")).alias("ref")))  # so only these sets' terms are dealt

    def of_pairs(batches):
        import pyarrow as pa

        for batch in batches:
            yield batch.filter(pa.array(in_bit_map(paired, batch.column(0).to_numpy())))

    terms_of = sets.select("ref", "h").mapInArrow(of_pairs, "ref long, h array<long>")
    side = "rid{0} {1}, own{0} long, size{0} long, copies{0} array<long>, "
    kind = dict(rows.dtypes)["rid"]
    near = meet(pairs, chosen.join(terms_of, "ref"), shared_terms(threshold),
                side.format("_a", kind) + side.format("_b", kind) + "shared int, union_size int")
    return rows, near


def similar_sections(records: DataFrame, threshold: float = 0.8, id_col: str = "document_id", text_col: str = "text") -> DataFrame:
    """Q15: pairs of distinct term sets with Jaccard similarity >= ``threshold``,
    exactly, by prefix filtering; ``copies_a``/``copies_b`` say how many records
    share each set; :func:`duplicate_groups` lists them with their representative, and
    :func:`similar_records` gives every record's pairs.

    Exact copies are collapsed first (one representative per identical set), so a
    huge group of copies costs one row, not all its pairs. Terms, by 64-bit hashes, are then ordered by
    global frequency (rarest first, see :func:`rarest_terms`); two sets with Jaccard >= t must share a term
    among the first ``|x| - ceil(t*|x|) + 1`` terms of each, so candidates are
    sets that meet at such a term (:func:`meeting_pairs`); sizes, places and sketches
    prune them where they meet, and survivors are verified on the full sets, which go to the
    groups of their pairs (:func:`..blocks.meet`)."""
    near = _similar(records, threshold, id_col, text_col)[1]
    swap = F.col("rid_a") > F.col("rid_b")
    near = near.filter(F.col("rid_a") != F.col("rid_b")).select(
        *[F.when(swap, F.col(x)).otherwise(F.col(y)).alias(as_) for x, y, as_ in (
            ("rid_b", "rid_a", "id_a"), ("rid_a", "rid_b", "id_b"), ("copies_b", "copies_a", "copies_a"), ("copies_a", "copies_b", "copies_b"))],
        "shared", "union_size")
    return near.select("id_a", "id_b", "shared", "union_size", F.explode("copies_a").alias("copies_a"), "copies_b").select(
        "id_a", "id_b", "shared", "union_size", "copies_a", F.explode("copies_b").alias("copies_b"),
        (F.col("shared") / F.col("union_size")).alias("jaccard"))


def similar_records(records: DataFrame, threshold: float = 0.8, id_col: str = "document_id", text_col: str = "text", chunk: int = 256) -> DataFrame:
    """Q15 by record: every pair ``(id_a, id_b)``, ``id_a < id_b``, of records whose term sets
    reach the threshold, those with identical sets included; all its pairs are the result,
    so a group of n copies has n * (n - 1) / 2.

    Pairs come from :func:`similar_sections`' sets. A set with several records is cut
    into chunks of about ``chunk``, and chunks meet, so no task holds a group's pairs."""
    rows, near = _similar(records, threshold, id_col, text_col)
    near = materialize(near.select("rid_a", "own_a", "size_a", "rid_b", "own_b", "size_b"))
    alone = near.filter("size_a = 1 AND size_b = 1").select("rid_a", "rid_b")
    rows = rows.filter(F.col("rid").isNotNull())
    chunks = F.ceil(F.col("size") / chunk).cast("int")
    units = rows.select("own", F.pmod(F.xxhash64("ref"), chunks).cast("int").alias("chunk"), "rid").groupBy("own", "chunk").agg(
        F.collect_list("rid").alias("rids"))
    # records that repeat an id may give a pair of sets several times
    many = near.filter("(size_a > 1 OR size_b > 1) AND own_a != own_b").select(
        F.least("own_a", "own_b").alias("x"), F.greatest("own_a", "own_b").alias("y"),
        F.when(F.col("own_a") < F.col("own_b"), F.col("size_a")).otherwise(F.col("size_b")).alias("nx"),
        F.when(F.col("own_a") < F.col("own_b"), F.col("size_b")).otherwise(F.col("size_a")).alias("ny")).distinct()
    same = rows.filter("size > 1").select(F.col("own").alias("x"), F.col("own").alias("y"), F.col("size").alias("nx"), F.col("size").alias("ny")).distinct()

    def counted(n):
        return F.explode(F.sequence(F.lit(0), F.ceil(F.col(n) / chunk).cast("int") - 1))

    met = many.unionAll(same).select("*", counted("nx").alias("cx")).select("x", "cx", "y", counted("ny").alias("cy"))
    met = met.filter("x != y OR cx <= cy")
    met = met.join(units.toDF("x", "cx", "xs"), ["x", "cx"]).join(units.toDF("y", "cy", "ys"), ["y", "cy"])
    each = met.select("x", "cx", "y", "cy", "ys", F.explode("xs").alias("rid_a")).select(
        "x", "cx", "y", "cy", "rid_a", F.explode("ys").alias("rid_b"))
    each = each.filter("x != y OR cx != cy OR rid_a < rid_b").select("rid_a", "rid_b")
    return alone.unionAll(each).filter("rid_a != rid_b").select(
        F.least("rid_a", "rid_b").alias("id_a"), F.greatest("rid_a", "rid_b").alias("id_b"))


def cluster_topics(vectors: DataFrame, k: int = 10, seed: int = 7, id_col: str = "id", features: str = "embedding") -> DataFrame:
    """Q16: k-means over document vectors (``pyspark.ml``), fixed seed."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    data = vectors.select(id_col, array_to_vector(F.col(features)).alias("features"))
    model = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(data)
    return model.transform(data).select(id_col, F.col("cluster").cast("int").alias("cluster"))


def page_changes(kinds: list[str]):
    """The step of a group that compares the pages ``(page_number, h)`` of its pairs'
    documents. Repeated pairs and pages give their rows as a full outer join would; pages
    without a number have no counterpart."""
    def run(rows, pairs):
        import numpy as np
        import pyarrow as pa

        types = [pairs.schema.field(0).type, pa.int64()]
        held = [(d, [(p["page_number"], p["h"]) for p in v]) for d, v in zip(rows["ref"].to_pylist(), rows["pages"].to_pylist())]
        by_id, plain, same = {}, {}, {}
        for d, v in held:
            by_id[d] = v
            numbers = [n for n, _ in v]
            plain[d] = None not in numbers and len(set(numbers)) == len(numbers)
            same[d] = frozenset(v)
        out: list = [[], [], [], []]

        def batch():
            b = pa.RecordBatch.from_arrays([pa.array(out[0], types[0]), pa.array(out[1], types[0]), pa.array(out[2], types[1]).cast(page), pa.array(out[3], pa.string())],
                                           names=["v1", "v2", "page_number", "change"])
            for column in out:
                column.clear()
            return b

        page = {"int": pa.int32(), "bigint": pa.int64(), "smallint": pa.int16(), "tinyint": pa.int8()}[kinds[1]]
        ids = list(zip(pairs["a"].to_pylist(), pairs["b"].to_pylist()))
        at = 0
        while at < len(ids):
            (a, b), to = ids[at], at + 1
            while to < len(ids) and ids[to] == ids[at]:
                to += 1
            times, at = to - at, to
            x, y = by_id.get(a, ()), by_id.get(b, ())
            if times == 1 and plain.get(a, True) and plain.get(b, True):
                if a in same and same[a] == same.get(b):
                    changes = [(n, "same") for n, _ in x]
                else:
                    other = dict(y)
                    changes = [(n, "removed" if n not in other else "same" if other.pop(n) == h else "changed") for n, h in x]
                    changes += [(n, "added") for n in other]
            else:
                left, right = {}, {}
                for side, pages in ((left, x), (right, y)):
                    for n, h in pages:
                        side.setdefault(n, []).append(h)
                changes = []
                for n, hs in left.items():
                    met = right.get(n, ()) if n is not None else ()
                    changes += [(n, "same" if h == g else "changed") for h in hs for g in met] * times * times if met else [(n, "removed")] * len(hs) * times
                changes += [(n, "added") for n, hs in right.items() if n is None or n not in left for _ in hs] * times
            out[0] += [a] * len(changes)
            out[1] += [b] * len(changes)
            out[2] += [c[0] for c in changes]
            out[3] += [c[1] for c in changes]
            if len(out[0]) >= 50_000:
                yield batch()
        if out[0]:
            yield batch()

    return run


def diff_versions(pairs: DataFrame, pages: DataFrame) -> DataFrame:
    """Q17: page-level diff of document versions ``pairs(v1, v2)``: each page is
    ``added``, ``removed``, ``changed`` or ``same`` by content hash (full outer join
    on page number).

    A document's page hashes are one row, which goes to the groups of its pairs
    (:func:`..blocks.meet`); neither pairs nor pages are rows for each other."""
    h = F.unhex(content_hash("content")).alias("h")
    of = pages.groupBy(F.col("document_id").alias("ref")).agg(F.collect_list(F.struct("page_number", h)).alias("pages"))
    kinds = [dict(pairs.dtypes)["v1"], dict(pages.dtypes)["page_number"]]
    stored = materialize(pairs.select(F.col("v1").alias("a"), F.col("v2").alias("b")))
    return meet(stored, of, page_changes(kinds), f"v1 {kinds[0]}, v2 {kinds[0]}, page_number {kinds[1]}, change string")


def audit_trail(runs: DataFrame) -> DataFrame:
    """Q18: attempt history per document: attempt number, previous status and whether
    the record is the latest (``runs`` are index records of several runs)."""
    w = Window.partitionBy("id").orderBy("updated_at", "run")
    wl = Window.partitionBy("id").orderBy(F.col("updated_at").desc(), F.col("run").desc())
    return runs.select(
        "id",
        "run",
        "status",
        "updated_at",
        F.row_number().over(w).alias("attempt"),
        F.lag("status").over(w).alias("previous_status"),
        (F.row_number().over(wl) == 1).alias("is_latest"),
    )
