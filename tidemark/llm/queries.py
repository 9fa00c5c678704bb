"""The numbered queries: each operator over its whole table, with production settings."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe,
    common,
    html_text,
    id_files,
    minhash,
    packing,
    periods,
    prefixes,
    projection,
    quality,
    repeats,
    token_counts,
    topk,
    toxicity,
)
from tidemark.llm.common import scratch, stored, table


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_verdicts(table(spark, sf_dir, "documents"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest_texts(table(spark, sf_dir, "documents"), "byte_bpe_50k.tiktoken")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.count_tokens(table(spark, sf_dir, "documents"), "word_bpe_49k.json")
    return counts.selectExpr("doc_id", "n_bytes", "n_tokens", "n_tokens > 2048 AS over_limit")


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.main_text(table(spark, sf_dir, "pages"))
    return found.selectExpr("page_id", "url", "text", "CAST(char_length(text) AS BIGINT) AS n_chars")


def op6_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "ids")
    id_files.write_ids(table(spark, sf_dir, "documents"), path, "byte_bpe_50k.json", 2)
    return id_files.read_digests(spark, path)


def op7_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection.link_vectors(table(spark, sf_dir, "embeddings"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeat_digests(table(spark, sf_dir, "documents"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = stored(prefixes.turns_of(table(spark, sf_dir, "conversations")), "turns")
    return prefixes.prefix_trie(stored(prefixes.with_shared_starts(turns), "rebuilt"))


def op12_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op13_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.periodic_runs(table(spark, sf_dir, "documents"), plant=True)


def _shipped(query):
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        common.ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {
    f.__name__: _shipped(f)
    for f in (
        op1_packing,
        op2_quality,
        op3_bpe,
        op4_token_counts,
        op5_html_text,
        op6_id_files,
        op7_projection,
        op8_toxicity,
        op9_repeats,
        op10_minhash,
        op11_prefix_trie,
        op12_topk,
        op13_periods,
    )
}

#: Bit by bit, crc32 of the decimal id, before its last exclusive-or.
_CRC = """list_reduce(
    list_prepend(4294967295, list_transform(range(1, length(c::VARCHAR) + 1), lambda i: ascii(substr(c::VARCHAR, i, 1))::BIGINT)),
    lambda crc, byte: list_reduce(
        list_prepend(xor(crc, byte), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1))
    )
)"""

#: SQL of those that SQL can express.
ORACLES: dict[str, str] = {
    "op11_prefix_trie": f"""
        WITH t AS (
            SELECT conv_id AS c, coalesce(text, '') AS x, strlen(coalesce(role, '')) || ':' || coalesce(role, '') AS r,
                row_number() OVER (
                    PARTITION BY conv_id
                    ORDER BY turn NULLS FIRST, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))
                ) - 1 AS position
            FROM conversations WHERE conv_id IS NOT NULL
        ), ids AS (
            SELECT c, c - c % 20 AS base, (4294967295 - {_CRC}) % 4 AS h FROM (SELECT DISTINCT c FROM t)
        ), given AS (
            SELECT ids.c, t.position, r, x FROM ids JOIN t ON t.c = ids.base AND t.position < ids.h
        ), given_sizes AS (
            SELECT c, count(*) AS k FROM given GROUP BY c
        ), rebuilt AS (
            SELECT * FROM given UNION ALL
            SELECT t.c, t.position - h + coalesce(k, 0), r, x
            FROM t JOIN ids USING (c) LEFT JOIN given_sizes USING (c) WHERE t.position >= h
        ), paths AS (
            SELECT c, position + 1 AS depth, len(regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+')) AS words,
                md5(string_agg(md5(r || x), '') OVER (PARTITION BY c ORDER BY position)) AS node
            FROM rebuilt
            UNION ALL SELECT c, 0, 0, '' FROM ids
        ), linked AS (
            SELECT *, lag(node) OVER w AS parent, lead(node) OVER w IS NULL AS ends
            FROM paths WINDOW w AS (PARTITION BY c ORDER BY depth)
        ), nodes AS (
            SELECT depth, node, any_value(parent) AS parent, any_value(words) AS words, count(*) AS n_convs,
                min(c) AS conv_id, sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
            FROM linked GROUP BY depth, node
        ), below AS (
            SELECT depth - 1 AS depth, parent AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1, 2
        ), whole AS (
            SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN below USING (depth, node)
        ), sums AS (
            SELECT p.depth, p.node, sum((u.n_children = 0)::BIGINT) AS n_leaves, sum((u.n_convs - 1) * u.words) AS saved
            FROM whole u JOIN paths p ON p.c = u.conv_id AND p.depth <= u.depth GROUP BY 1, 2
        )
        SELECT w.conv_id, w.depth, up.conv_id AS parent_conv_id, w.n_convs, w.n_children,
            n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, w.ends_sha256
        FROM whole w JOIN sums USING (depth, node)
        LEFT JOIN whole up ON up.depth = w.depth - 1 AND up.node = w.parent
    """,
    "op12_topk": """
        WITH whole AS (
            SELECT vec_id, min(list_transform(embedding, lambda x: CAST(floor(1024 * x::DOUBLE) AS BIGINT))) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            GROUP BY vec_id, len(embedding)
        ), scored AS (
            SELECT q.vec_id AS query_id, w.vec_id,
                coalesce(list_sum(list_transform(list_zip(q.v, w.v), lambda p: p[1] * p[2])), 0)::BIGINT AS score
            FROM whole q JOIN whole w ON q.vec_id <> w.vec_id AND len(q.v) = len(w.v)
            WHERE q.vec_id % 100 = 0
        )
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
            vec_id, score
        FROM scored
        QUALIFY rank <= 10
    """,
}
