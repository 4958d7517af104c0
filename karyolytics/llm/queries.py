"""The queries of the operators, and SQL for those that SQL can express. Each reads its whole table."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, collocations, conversation_trie, exact_dedup, html_extract, licenses, line_dedup, maxent_lm, media, ngram_join, packing, quality, sharding
from .common import Scratch, documents, gathered

#: Folder of the tokenizer files; unset, the installed package of public tokenizers.
TOKENIZERS = "KARYOLYTICS_TOKENIZERS"


def tokenizer(name: str) -> str:
    if folder := os.environ.get(TOKENIZERS):
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.exact_dedup(spark, f"{sf_dir}/documents.parquet")
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(spark, documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(documents(spark, sf_dir), tokenizer("byte_bpe_50k.tiktoken")).withColumnRenamed("id", "doc_id")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    out = line_dedup.dedup_lines(spark, docs)
    return gathered(out.select("doc_id", F.col("_line_count").alias("n_lines"), F.col("_line_drops").alias("n_dropped"), "text"), docs.count(), 50_000)


def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(documents(spark, sf_dir, "pages"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.assess(spark, documents(spark, sf_dir).select("doc_id", "text"))
    names = {"f_n": "n_words", "f_word_chars": "word_chars", "f_symbols": "n_symbols", "f_dup_lines": "n_dup_lines", "f_repeat_words": "n_repeat_words"}
    return out.select("doc_id", *(F.col(k).alias(v) for k, v in names.items()), "base_failed", "kept", "posterior")


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard(spark, documents(spark, sf_dir), 16)
    return out.select(F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent_lm.score(spark, documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack_documents(spark, documents(spark, sf_dir), tokenizer("byte_bpe_50k.json"))
    return out.select(F.col("id").alias("doc_id"), "piece", "start", "length", F.col("crc").alias("ids_crc32"), "sequence_id", "offset")


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "conversations")
    turns = scratch.table(conversation_trie.turn_rows(documents(spark, sf_dir, "conversations")), "turns", dealt=True)
    return conversation_trie.trie(spark, conversation_trie.rebuilt(turns), scratch)


def op12_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.stored_texts(spark, documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(spark, documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (op1_exact_dedup, op2_ngram_join, op3_byte_bpe, op4_line_dedup, op5_html_extract, op6_quality, op7_licenses, op8_sharding, op9_maxent_lm, op10_packing, op11_conversation_trie, op12_media, op13_collocations)}

SQL = {
    "op1_exact_dedup": r"""
        WITH n AS (
            SELECT doc_id, length(coalesce(text, '')) AS points,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
            FROM documents)
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
               row_number() OVER w = 1 AS kept, text_sha256
        FROM n WINDOW w AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id)""",
    # crc32 bit by bit: each byte of the decimal id is a list entry, followed by seven zeros for its other bits
    "op11_conversation_trie": r"""
        WITH t AS (
            SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
                   coalesce(role, '') AS role, coalesce(text, '') AS text
            FROM conversations WHERE conv_id IS NOT NULL),
        c AS (
            SELECT conv_id, conv_id - conv_id % 100 AS base,
                   xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
                       regexp_extract_all(conv_id::VARCHAR, '.'), lambda x: [ascii(x)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
                       lambda s, e: xor(xor(s, e) >> 1, (xor(s, e) & 1) * 3988292384))) % 6 AS h
            FROM (SELECT DISTINCT conv_id FROM t)),
        n AS (SELECT c.*, (SELECT count(*) FROM t WHERE t.conv_id = c.base AND pos <= h) AS took FROM c),
        r AS (
            SELECT n.conv_id, pos, role, text FROM n JOIN t ON t.conv_id = n.base AND pos <= h
            UNION ALL SELECT n.conv_id, pos - h + took, role, text FROM n JOIN t ON t.conv_id = n.conv_id AND pos > h),
        k AS (
            SELECT conv_id, pos AS depth, length(text) AS points,
                   list({'role': role, 'text': text}) OVER (PARTITION BY conv_id ORDER BY pos) AS key
            FROM r),
        p AS (
            SELECT conv_id, depth, points, key, key[:-2] AS parent FROM k
            UNION ALL SELECT conv_id, 0, 0, [], NULL FROM n),
        s AS (SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS ends FROM p),
        nodes AS (
            SELECT key, depth, first(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, first(points) AS points,
                   sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
            FROM s GROUP BY key, depth),
        kids AS (SELECT parent AS key, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY parent),
        full_nodes AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (key)),
        sums AS (
            SELECT a.key, count(*) FILTER (WHERE d.n_children = 0) AS n_leaves, sum((d.n_convs - 1) * d.points)::BIGINT AS saved_tokens
            FROM full_nodes d JOIN p a ON a.conv_id = d.conv_id AND a.depth <= d.depth GROUP BY a.key)
        SELECT f.conv_id, f.depth, u.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens, f.ends_sha256
        FROM full_nodes f JOIN sums USING (key) LEFT JOIN nodes u ON f.depth > 0 AND u.key = f.parent""",
    "op13_collocations": r"""
        WITH p AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents),
        w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
        u AS (SELECT lang, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c FROM (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w)),
        f1 AS (SELECT lang, a, count(*) AS f FROM u GROUP BY ALL),
        f2 AS (SELECT lang, a, b, count(*) AS f FROM u WHERE b IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
        f3 AS (SELECT lang, a, b, c, count(*) AS f FROM u WHERE c IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
        two AS (
            SELECT f2.lang, f2.a || ' ' || f2.b AS phrase, f2.f AS a, x.f AS l, y.f AS r,
                   (1000000::HUGEINT * f2.f * f2.f) // (x.f::HUGEINT * y.f) AS score
            FROM f2 JOIN f1 x ON x.lang = f2.lang AND x.a = f2.a JOIN f1 y ON y.lang = f2.lang AND y.a = f2.b
            WHERE NOT EXISTS (SELECT 1 FROM f3 WHERE f3.lang = f2.lang AND 100 * f3.f >= 50 * f2.f AND f3.a = f2.a AND f3.b = f2.b)
              AND NOT EXISTS (SELECT 1 FROM f3 WHERE f3.lang = f2.lang AND 100 * f3.f >= 50 * f2.f AND f3.b = f2.a AND f3.c = f2.b)),
        cuts AS (
            SELECT f3.lang, f3.a || ' ' || f3.b || ' ' || f3.c AS phrase, f3.f AS a, 1 AS k, x.f AS l, y.f AS r
            FROM f3 JOIN f1 x ON x.lang = f3.lang AND x.a = f3.a JOIN f2 y ON y.lang = f3.lang AND y.a = f3.b AND y.b = f3.c
            UNION ALL
            SELECT f3.lang, f3.a || ' ' || f3.b || ' ' || f3.c, f3.f, 2, x.f, y.f
            FROM f3 JOIN f2 x ON x.lang = f3.lang AND x.a = f3.a AND x.b = f3.b JOIN f1 y ON y.lang = f3.lang AND y.a = f3.c),
        three AS (
            SELECT lang, phrase, a, l, r, (1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS score FROM cuts
            QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY (1000000::HUGEINT * a * a) // (l::HUGEINT * r), k) = 1),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
            FROM (SELECT * FROM two UNION ALL SELECT * FROM three))
        SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score
        FROM ranked JOIN (SELECT lang, sum(f)::BIGINT AS n FROM f1 GROUP BY lang) USING (lang) WHERE rank <= 2000""",
}
