"""Registered queries of the operators: each over its whole table, with the parameters of production."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm import (
    decontaminate,
    huffman,
    nbsvm,
    order_minhash,
    piece_chunks,
    pivots,
    prefix_bpe,
    prefix_trie,
    secrets,
    sharding,
    token_files,
    whitening,
    zstd_toxicity,
)
from pagemill.llm.common import row_bucket, table

Query = Callable[[SparkSession, str], DataFrame]

BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
BYTE_END, WORD_END = 50_256, 2
SHARDS = 24


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, found by patterns and by a character model trained on all documents."""
    docs = table(spark, sf_dir, "documents")
    return secrets.digest(secrets.scan(docs, secrets.train(docs)))


def op2_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and place of every document in flat token files."""
    docs = table(spark, sf_dir, "documents")
    stored = token_files.store(docs, BYTE_RANKS, public_tokenizers.PATTERN, BYTE_END)
    found = token_files.named(token_files.documents(stored, BYTE_END), stored)
    return found.select("doc_id", "file", "ordinal", "start", "n_tokens", "ended")


def op3_permutation_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest vectors found for every hundredth vector."""
    return pivots.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op4_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, and its shard if there were one more."""
    return sharding.assign(table(spark, sf_dir, "documents"), sharding.balanced(SHARDS))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learnt from four fifths of the labels."""
    docs = table(spark, sf_dir, "documents")
    held = row_bucket(F.col("doc_id"), 5) == 0
    model = nbsvm.train(docs, table(spark, sf_dir, "labels"), ~held)
    scored = nbsvm.with_score(docs.select("doc_id", "text"), model)
    return _scores(scored, held, nbsvm.THRESHOLD)


def _scores(scored: DataFrame, held, threshold: float) -> DataFrame:
    predicted = F.when(F.col("score") >= threshold, 1).otherwise(0)
    return scored.select("doc_id", held.alias("held_out"), "score").withColumn("predicted", predicted)


def op6_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of what they decode to."""
    return prefix_bpe.digest(table(spark, sf_dir, "documents"), BYTE_RANKS, public_tokenizers.PATTERN)


def op7_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near-duplicates of every document."""
    return order_minhash.classes(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that stand in the benchmark, and the items they come from."""
    found = decontaminate.hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.digest(found)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from three quarters of the labels."""
    docs = table(spark, sf_dir, "documents")
    held = row_bucket(F.col("doc_id"), 4) == 2
    model = zstd_toxicity.train(docs, table(spark, sf_dir, "labels"), ~held)
    scored = zstd_toxicity.with_score(docs.select("doc_id", "text"), model)
    return _scores(scored, held, zstd_toxicity.THRESHOLD)


def op10_huffman(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, size and checksum of every document's ids, read back from coded blocks."""
    blocks, book = huffman.store(table(spark, sf_dir, "documents"), WORD_VOCABULARY, WORD_END)
    return huffman.checksums(blocks, book)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First components of every vector, whitened over the distinct vectors."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_piece_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of what they decode to."""
    return piece_chunks.digest(table(spark, sf_dir, "documents"), PIECE_MODEL)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of all conversations, rebuilt on the first one of their hundred."""
    return prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.turns(table(spark, sf_dir, "conversations"))))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_secret_scan,
        op2_separator_scan,
        op3_permutation_search,
        op4_hash_tree,
        op5_quality,
        op6_prefix_bpe,
        op7_order_minhash,
        op8_decontamination,
        op9_toxicity,
        op10_huffman,
        op11_whitening,
        op12_piece_chunks,
        op13_prefix_trie,
    )
}

# Counterparts in DuckDB. The others hold models, vocabularies or hashes that SQL has no functions for.
ORACLE = {
    "op8_decontamination": r"""
        WITH lowered AS (
            SELECT 'd' AS kind, doc_id AS id, row_number() OVER () AS row,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents
        ), items AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark
        ), windows AS (
            SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS x
            FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM items WHERE len(w) > 0)
        ), sizes AS (
            SELECT DISTINCT n FROM windows
        ), places AS (
            SELECT row, n, i, array_to_string(w[i : i + n - 1], ' ') AS x
            FROM (SELECT row, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM lowered, sizes WHERE len(w) >= n)
        ), found AS (
            SELECT row, p.n, i, item_id FROM places p JOIN windows USING (n, x)
        ), hit AS (
            SELECT row, count(DISTINCT i) AS n_hit
            FROM (SELECT row, unnest(range(i, i + n)) AS i FROM (SELECT DISTINCT row, n, i FROM found)) GROUP BY row
        ), named AS (
            SELECT row, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
            FROM (SELECT DISTINCT row, CAST(item_id AS VARCHAR) AS x FROM found WHERE item_id IS NOT NULL) GROUP BY row
        )
        SELECT id AS doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
               CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM lowered LEFT JOIN hit USING (row) LEFT JOIN named USING (row)
    """,
    "op13_prefix_trie": r"""
        WITH t AS (
            SELECT conv_id, r, x,
                   row_number() OVER (PARTITION BY conv_id
                                      ORDER BY turn NULLS FIRST, substr(sha256(length(r) || ':' || r || x), 1, 32)) AS p
            FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations)
            WHERE conv_id IS NOT NULL
        ), c AS (
            SELECT conv_id, conv_id - conv_id % 100 AS base, CAST(xor(crc, 4294967295) % 6 AS BIGINT) AS h
            FROM (
                SELECT conv_id, list_reduce(
                    list_concat([CAST(4294967295 AS UBIGINT)],
                                list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS UBIGINT))),
                    lambda a, b: list_reduce(
                        list_concat([xor(a, b)], list_transform(range(8), lambda i: CAST(i AS UBIGINT))),
                        lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v // 2, CAST(3988292384 AS UBIGINT)) ELSE v // 2 END)) AS crc
                FROM (SELECT DISTINCT conv_id FROM t)
            )
        ), head AS (
            SELECT c.conv_id, t.p, t.r, t.x FROM c JOIN t ON t.conv_id = c.base AND t.p <= c.h
        ), heads AS (
            SELECT conv_id, count(*) AS k FROM head GROUP BY conv_id
        ), s AS (
            SELECT * FROM head
            UNION ALL
            SELECT c.conv_id, t.p - c.h + coalesce(k, 0), t.r, t.x
            FROM c JOIN t ON t.conv_id = c.conv_id AND t.p > c.h LEFT JOIN heads ON heads.conv_id = c.conv_id
        ), l AS (
            SELECT c.conv_id, coalesce(list({'r': r, 'x': x} ORDER BY p) FILTER (WHERE p IS NOT NULL), []) AS q
            FROM c LEFT JOIN s ON s.conv_id = c.conv_id GROUP BY c.conv_id
        ), pre AS (
            SELECT conv_id, d, q[1:d] AS node, CASE WHEN d > 0 THEN length(q[d].x) ELSE 0 END AS chars, d = len(q) AS ends
            FROM (SELECT conv_id, q, unnest(range(0, len(q) + 1)) AS d FROM l)
        ), places AS (
            SELECT conv_id, d, chars, ends, min(conv_id) OVER (PARTITION BY d, node) AS m FROM pre
        ), n AS (
            SELECT m, d, count(*) AS n_convs, any_value(chars) AS chars,
                   string_agg(CASE WHEN ends THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id) AS e
            FROM places GROUP BY m, d
        ), up AS (
            SELECT n.*, a.m AS parent FROM n LEFT JOIN places a ON a.conv_id = n.m AND a.d = n.d - 1
        ), kids AS (
            SELECT parent AS m, d - 1 AS d, count(*) AS k FROM up WHERE d > 0 GROUP BY ALL
        ), sums AS (
            SELECT a.m, a.d, count(*) FILTER (WHERE kids.k IS NULL) AS n_leaves,
                   sum((up.n_convs - 1) * up.chars) AS saved
            FROM up LEFT JOIN kids ON kids.m = up.m AND kids.d = up.d JOIN places a ON a.conv_id = up.m AND a.d <= up.d
            GROUP BY a.m, a.d
        )
        SELECT up.m AS conv_id, up.d AS depth, up.parent AS parent_conv_id, up.n_convs,
               CAST(coalesce(kids.k, 0) AS BIGINT) AS n_children, n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
               sha256(coalesce(e, '')) AS ends_sha256
        FROM up LEFT JOIN kids ON kids.m = up.m AND kids.d = up.d JOIN sums ON sums.m = up.m AND sums.d = up.d
    """,
}
