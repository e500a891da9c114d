"""The registered queries of the training-data operators and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, knn, lm, mixture, neardup, packing, phrases, prefixes, quality, radix, sharding, suffixes, unigram
from .common import read, stored


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixture.mix(docs)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.classify(docs, read(spark, sf_dir, "labels"))


def op3_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = sharding.shard(docs)
    return out.select(
        "doc.doc_id", "size", F.crc32(F.col("doc.text").cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return unigram.count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op5_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"), size=4)


def op6_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(stored(packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    out = chat.parse(chat.render(chat.fold(chat.as_events(rows.unionByName(extra)))))
    said_all = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said_all.cast("binary"), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn.top_k(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op9_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return radix.exact_groups(docs)


def op10_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return lm.score(docs, public_tokenizers.path("piece_bpe_32k.model"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read(spark, sf_dir, "documents").select("lang", "text"))


def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return prefixes.trie(prefixes.rebuilt(rows))


def op13_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = suffixes.remove_repeats(docs)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["length"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


LLM_QUERIES = {
    "op1_mix": op1_mix,
    "op2_quality": op2_quality,
    "op3_shards": op3_shards,
    "op4_tokens": op4_tokens,
    "op5_neardup": op5_neardup,
    "op6_pack": op6_pack,
    "op7_chat": op7_chat,
    "op8_topk": op8_topk,
    "op9_exact": op9_exact,
    "op10_lm": op10_lm,
    "op11_phrases": op11_phrases,
    "op12_trie": op12_trie,
    "op13_repeats": op13_repeats,
}

LLM_ORACLE = {
    "op7_chat": r"""
        WITH c AS (
          SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
          UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
          UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
        e AS (
          SELECT *, replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS esc_text,
                 replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS esc_role FROM c)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(length(esc_role) + length(esc_text) + 16)::BIGINT AS formatted_chars
        FROM e GROUP BY conv_id""",
    "op8_topk": """
        WITH ok AS (
          SELECT vec_id, row_number() OVER () AS rid,
                 list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
          FROM embeddings
          WHERE embedding IS NOT NULL AND len(embedding) > 0
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
          SELECT q.rid, q.vec_id AS query_id, c.vec_id,
                 list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
          FROM ok q JOIN ok c ON q.vec_id % 100 = 0 AND c.rid <> q.rid AND len(c.v) = len(q.v)),
        r AS (
          SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS rank FROM s)
        SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 10""",
    "op9_exact": r"""
        WITH n AS (
          SELECT doc_id, length(coalesce(text, '')) AS cp,
                 regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
          FROM documents),
        g AS (
          SELECT doc_id, cp, norm, count(*) OVER (PARTITION BY norm) AS group_size,
                 row_number() OVER (PARTITION BY norm ORDER BY cp DESC, doc_id) AS rn,
                 first_value(doc_id) OVER (PARTITION BY norm ORDER BY cp DESC, doc_id) AS keep_id
          FROM n)
        SELECT doc_id, keep_id, group_size, rn = 1 AS kept, sha256(norm) AS text_sha256 FROM g""",
    "op11_phrases": r"""
        WITH w AS (
          SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws
          FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
                FROM documents)),
        g AS (
          SELECT lang, m, unnest(list_transform(range(1, len(ws) - m + 2), lambda i: array_to_string(ws[i:i + m - 1], ' '))) AS phrase
          FROM w, (SELECT unnest([1, 2, 3]) AS m) WHERE len(ws) >= m),
        f AS (SELECT lang, m, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 10),
        n AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
        c AS (
          SELECT lang, m, phrase, f AS a, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS head,
                 array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS tail
          FROM f, (SELECT unnest([1, 2]) AS k) WHERE k < m),
        s AS (
          SELECT c.lang, c.m, c.phrase, a, k, x.f AS l, y.f AS r,
                 (1000000::HUGEINT * a * a // (x.f::HUGEINT * y.f))::BIGINT AS score
          FROM c JOIN f x ON x.lang = c.lang AND x.phrase = c.head JOIN f y ON y.lang = c.lang AND y.phrase = c.tail),
        b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        i AS (
          SELECT lang, inner_phrase, max(a) AS longer FROM (
            SELECT lang, a, unnest([array_to_string(string_split(phrase, ' ')[1:2], ' '),
                                    array_to_string(string_split(phrase, ' ')[2:3], ' ')]) AS inner_phrase FROM b WHERE m = 3)
          GROUP BY ALL)
        SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
        FROM b JOIN n ON n.lang = b.lang LEFT JOIN i ON i.lang = b.lang AND inner_phrase = phrase
        WHERE longer IS NULL OR 100 * longer < 50 * a
        QUALIFY rank <= 2000""",
    "op12_trie": r"""
        WITH t AS (
          SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                 row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS place
          FROM conversations WHERE conv_id IS NOT NULL),
        bits AS (
          SELECT b.range AS start, list_reduce(list_concat([b.range], range(8)),
                   lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS word
          FROM range(256) b),
        word AS (SELECT list(word ORDER BY start) AS w FROM bits),
        c AS (
          SELECT conv_id, conv_id - conv_id % 5 AS base,
                 xor(list_reduce(list_concat([4294967295], list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                   lambda c, x: xor(c >> 8, w[(xor(c, x) & 255) + 1])), 4294967295) % 9 AS h
          FROM (SELECT DISTINCT conv_id FROM t), word),
        r AS (
          SELECT c.conv_id, 0 AS part, t.place, t.role, t.text FROM c JOIN t ON t.conv_id = c.base AND t.place < c.h
          UNION ALL SELECT c.conv_id, 1, t.place, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.place >= c.h),
        n AS (
          SELECT conv_id, strlen(text) AS n_bytes, length(role) || ':' || role || text AS turn,
                 row_number() OVER (PARTITION BY conv_id ORDER BY part, place) AS depth FROM r),
        p AS (
          SELECT conv_id, 0 AS depth, '' AS key, 0 AS n_bytes FROM c
          UNION ALL SELECT conv_id, depth, sha256(string_agg(sha256(turn), ',') OVER (PARTITION BY conv_id ORDER BY depth)), n_bytes FROM n),
        e AS (
          SELECT key, string_agg(conv_id, ',' ORDER BY conv_id) AS ids
          FROM (SELECT conv_id, arg_max(key, depth) AS key FROM p GROUP BY conv_id) GROUP BY key),
        nodes AS (
          SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(n_bytes) AS own FROM p GROUP BY key, depth),
        up AS (
          SELECT x.key AS below, x.own, a.key AS key, a.depth, x.depth AS depth_below
          FROM nodes x JOIN p a ON a.conv_id = x.conv_id AND a.depth <= x.depth),
        kids AS (SELECT key, count(*) AS n_children FROM up WHERE depth_below = depth + 1 GROUP BY key),
        sums AS (
          SELECT up.key, sum(own)::BIGINT AS saved_tokens, count(*) FILTER (kids.key IS NULL) AS n_leaves
          FROM up LEFT JOIN kids ON kids.key = up.below GROUP BY up.key)
        SELECT x.conv_id, x.depth, y.conv_id AS parent_conv_id, x.n_convs, coalesce(n_children, 0) AS n_children,
               n_leaves, saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
        FROM nodes x
        LEFT JOIN up ON up.below = x.key AND up.depth = x.depth - 1 LEFT JOIN nodes y ON y.key = up.key
        LEFT JOIN kids ON kids.key = x.key LEFT JOIN sums ON sums.key = x.key LEFT JOIN e ON e.key = x.key""",
}
