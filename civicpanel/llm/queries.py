"""One query for each operator of the subpackage, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from civicpanel.llm.bpe_stream import token_digests
from civicpanel.llm.decontaminate import contamination
from civicpanel.llm.importance import resample
from civicpanel.llm.katz import score_corpus
from civicpanel.llm.language_id import identify
from civicpanel.llm.near_dedup import near_duplicates
from civicpanel.llm.packing import pack
from civicpanel.llm.quality_rules import judged
from civicpanel.llm.shards import shard_by_bytes
from civicpanel.llm.substring_dedup import repeated_paragraphs
from civicpanel.llm.tables import table
from civicpanel.llm.toxicity import toxicity
from civicpanel.llm.warc_archive import archive_pages
from civicpanel.llm.whitening import whiten


def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_paragraphs(table(spark, folder, "documents"))


def op2_katz(spark: SparkSession, folder: str) -> DataFrame:
    return score_corpus(table(spark, folder, "documents"))


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    rows = judged(table(spark, folder, "documents").select("doc_id", "text", "lang", "source"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op4_archive(spark: SparkSession, folder: str) -> DataFrame:
    return archive_pages(table(spark, folder, "pages"))


def op5_shards(spark: SparkSession, folder: str) -> DataFrame:
    return shard_by_bytes(table(spark, folder, "documents"), shards=40)


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op8_language(spark: SparkSession, folder: str) -> DataFrame:
    return identify(table(spark, folder, "documents"))


def op9_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), width=3, percent=85)


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"), capacity=2048)


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten(table(spark, folder, "embeddings"))


def op12_bpe_stream(spark: SparkSession, folder: str) -> DataFrame:
    return token_digests(table(spark, folder, "documents"))


def op13_importance(spark: SparkSession, folder: str) -> DataFrame:
    return resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_katz": op2_katz,
    "op3_quality": op3_quality,
    "op4_archive": op4_archive,
    "op5_shards": op5_shards,
    "op6_decontamination": op6_decontamination,
    "op7_toxicity": op7_toxicity,
    "op8_language": op8_language,
    "op9_near_dedup": op9_near_dedup,
    "op10_packing": op10_packing,
    "op11_whitening": op11_whitening,
    "op12_bpe_stream": op12_bpe_stream,
    "op13_importance": op13_importance,
}

#: DuckDB SQL for the rows of a query, where SQL can express them.
ORACLES: dict[str, str] = {
    "op4_archive": """
        WITH p AS (
            SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
        ), d AS (
            SELECT page_id, octet_length(payload) AS payload_bytes, sha256(payload) AS payload_digest FROM p
        ), f AS (
            SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d
        )
        SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
        FROM f
    """,
    "op6_decontamination": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents
        ), b AS (
            SELECT item_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark
        ), n AS (
            SELECT DISTINCT least(10, len(w)) AS k FROM b WHERE len(w) > 0
        ), r AS (
            SELECT false AS doc, item_id AS id, len(w) AS n, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM b
            UNION ALL
            SELECT true, doc_id, len(w), unnest(w), unnest(range(1, len(w) + 1)) FROM d
        ), l AS (
            SELECT doc, id, n, i, [word, lead(word, 1) OVER p, lead(word, 2) OVER p, lead(word, 3) OVER p,
                   lead(word, 4) OVER p, lead(word, 5) OVER p, lead(word, 6) OVER p, lead(word, 7) OVER p,
                   lead(word, 8) OVER p, lead(word, 9) OVER p] AS ahead
            FROM r WINDOW p AS (PARTITION BY doc, id ORDER BY i)
        ), bw AS (
            SELECT DISTINCT id AS item_id, k, array_to_string(ahead[1:k], ' ') AS win
            FROM (SELECT *, least(10, n) AS k FROM l WHERE NOT doc) WHERE i + k - 1 <= n
        ), dw AS (
            SELECT id AS doc_id, k, i, array_to_string(ahead[1:k], ' ') AS win
            FROM l JOIN n ON doc AND i + n.k - 1 <= l.n
        ), m AS (
            SELECT doc_id, i, dw.k, item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.k = bw.k
        ), h AS (
            SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT doc_id, i, k FROM m)) GROUP BY doc_id
        ), t AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY doc_id
        )
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
               CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
    """,
    "op13_importance": r"""
        WITH tab AS (
            SELECT list(c ORDER BY i) AS t FROM (
                SELECT i, list_reduce(list_prepend(CAST(i AS BIGINT), range(8)),
                    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c
                FROM range(256) r(i))
        ), d AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents
        ), b AS (
            SELECT regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark
        ), dw AS (
            SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(w) AS word FROM d) GROUP BY ALL
        ), bw AS (
            SELECT word, count(*) AS n FROM (SELECT unnest(w) AS word FROM b) GROUP BY ALL
        ), h AS (
            SELECT word, xor(4294967295, list_reduce(
                list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, strlen(word) * 2, 2),
                    lambda k: CAST(concat('0x', substr(hex(encode(word)), k, 2)) AS BIGINT))),
                lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8))) % 10000 AS bucket
            FROM (SELECT word FROM dw UNION SELECT word FROM bw), tab
        ), s AS (
            SELECT bucket, sum(n) AS n FROM dw JOIN h USING (word) GROUP BY bucket
        ), t AS (
            SELECT bucket, sum(n) AS n FROM bw JOIN h USING (word) GROUP BY bucket
        ), a AS (
            SELECT (SELECT coalesce(sum(n), 0) FROM s) AS all_s, (SELECT coalesce(sum(n), 0) FROM t) AS all_t
        ), g AS (
            SELECT i AS bucket, CAST(floor(1000 * ln(
                CAST((coalesce(t.n, 0) + 1) * (all_s + 10000) AS DOUBLE) / CAST((coalesce(s.n, 0) + 1) * (all_t + 10000) AS DOUBLE))) AS BIGINT) AS gain
            FROM range(10000) r(i) LEFT JOIN s ON s.bucket = i LEFT JOIN t ON t.bucket = i, a
        ), m AS (
            SELECT doc_id, sum(n * gain) AS total FROM dw JOIN h USING (word) JOIN g USING (bucket) GROUP BY doc_id
        ), w AS (
            SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_features,
                   CASE WHEN len(w) = 0 THEN 0 ELSE CAST(floor(CAST(total AS DOUBLE) / len(w)) AS BIGINT) END AS weight
            FROM d LEFT JOIN m USING (doc_id)
        ), z AS (
            SELECT *, weight + CAST(floor(-1000 * ln(-ln((
                CAST(concat('0x', substr(sha256(concat('2024:', doc_id)), 1, 8)) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
            FROM w
        ), r AS (
            SELECT *, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM z WHERE n_features >= 20
        )
        SELECT z.doc_id, z.n_features, z.weight, z.score, CASE WHEN place <= n * 10 // 100 THEN place END AS rank
        FROM z LEFT JOIN r USING (doc_id)
    """,
}
