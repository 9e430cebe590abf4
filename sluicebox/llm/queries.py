"""The registered queries of this package, each over its whole tables, and their results as SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicebox.llm.alignment import alignment_digest
from sluicebox.llm.chat import chat_digest, format_chats
from sluicebox.llm.codes import vector_codes
from sluicebox.llm.common import read_table
from sluicebox.llm.decontaminate import find_leaks
from sluicebox.llm.exact_dedup import copy_groups
from sluicebox.llm.near_dup import near_duplicates
from sluicebox.llm.neighbours import nearest
from sluicebox.llm.pieces import piece_digest
from sluicebox.llm.quality import score_quality
from sluicebox.llm.secrets import find_secrets, secret_digest
from sluicebox.llm.sharding import shard_documents
from sluicebox.llm.suffix_dedup import repeat_digest
from sluicebox.llm.toxicity import score_toxicity

Query = Callable[[SparkSession, str], DataFrame]


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_digest(read_table(spark, sf_dir, "documents"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"))


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    hard = "\\### Assistant: </turn> ok"
    added = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(hard).alias("text"),
    )
    conversations = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionAll(added)
    return chat_digest(format_chats(conversations))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digest(read_table(spark, sf_dir, "documents"))


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digest(find_secrets(read_table(spark, sf_dir, "documents")))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(read_table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copy_groups(read_table(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(read_table(spark, sf_dir, "embeddings"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_digest(read_table(spark, sf_dir, "documents"))


LLM_QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_suffix_array_dedup, op2_quality_classifier, op3_minhash_near_dedup, op4_nearest_neighbours, op5_chat_formatting, op6_sentencepiece,
        op7_secret_scans, op8_sharding, op9_toxicity,
        op10_decontamination, op11_exact_dedup, op12_vector_codes, op13_token_alignment,
    )
}

def _codes_sql(entries: int = 256, rounds: int = 4) -> str:
    """Each round as two statements: the nearest entry of every part, and the entries that follow from it."""
    def nearest_of(book: str) -> str:
        return f"""(
            SELECT id, part, arg_min(entry, distance * {entries} + entry) AS entry, min(distance) AS distance
            FROM (SELECT p.id, p.part, b.entry, sum((p.v - b.v) * (p.v - b.v))::BIGINT AS distance
                  FROM points AS p JOIN {book} AS b ON p.part = b.part AND p.place = b.place GROUP BY ALL)
            GROUP BY id, part)"""

    steps = [f"book0 AS MATERIALIZED (SELECT part, id AS entry, place, v FROM points WHERE id < {entries})"]
    for n in range(rounds):
        steps.append(f"near{n} AS MATERIALIZED {nearest_of(f'book{n}')}")
        steps.append(f"""book{n + 1} AS MATERIALIZED (
            SELECT b.part, b.entry, b.place, coalesce(m.v, b.v) AS v
            FROM book{n} AS b LEFT JOIN (
                SELECT part, entry, place, ((sum(v) - ((sum(v) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS v
                FROM points JOIN near{n} USING (id, part) GROUP BY part, entry, place
            ) AS m USING (part, entry, place))""")
    return f"""
        WITH kept AS (
            SELECT vec_id, label, embedding, row_number() OVER (ORDER BY vec_id, embedding) - 1 AS id FROM embeddings
            WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), spread AS (
            SELECT id, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS spot, len(embedding) // 4 AS width FROM kept
        ), points AS MATERIALIZED (
            SELECT id, spot // width AS part, spot % width AS place, floor(1024 * x::DOUBLE)::BIGINT AS v FROM spread
        ), {", ".join(steps)}, last AS MATERIALIZED {nearest_of(f"book{rounds}")}, coded AS (
            SELECT vec_id, label, string_agg(lower(printf('%02x', entry)), '' ORDER BY part) AS code, sum(distance)::BIGINT AS error
            FROM last JOIN kept USING (id) GROUP BY id, vec_id, label
        )
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
            (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY part, entry, place)) FROM book{rounds}) AS codebooks_sha256
        FROM coded"""


LLM_ORACLE: dict[str, str] = {
    "op8_sharding": r"""
        WITH content AS (
            SELECT row_number() OVER () AS id, doc_id, coalesce(doc_id::VARCHAR, '') AS key, encode(coalesce(text, '')) AS raw FROM documents
        ), bytes AS (
            SELECT list(list_reduce(list_prepend(v, range(8)), lambda c, bit: xor(c >> 1, (c & 1) * 3988292384)) ORDER BY v) AS crcs
            FROM range(256) AS each_byte(v)
        ), summed AS (
            SELECT id, doc_id, key, (octet_length(raw) + 1)::BIGINT AS size,
                xor(list_reduce(
                    list_prepend(4294967295, list_transform(regexp_extract_all(hex(raw), '..'), lambda h: ('0x' || h)::BIGINT)),
                    lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])
                ), 4294967295)::BIGINT AS text_crc32
            FROM content, bytes
        ), leaves AS (
            SELECT n::INTEGER AS shard, n % 2 AS region, n // 2 % 2 AS rack, n // 4 AS place FROM range(17) AS numbers(n)
        ), draws AS (
            SELECT id, shard, region, rack,
                ('0x' || substr(md5(key || '/' || region || '/' || rack || '/' || (place // 4)), (place % 4 * 8 + 1)::BIGINT, 8))::BIGINT AS drawn
            FROM content, leaves
        ), placed AS (
            SELECT id, first(shard ORDER BY drawn DESC, region, rack, shard) FILTER (shard < 16) AS shard,
                first(shard ORDER BY drawn DESC, region, rack, shard) AS grown_shard
            FROM draws GROUP BY id
        )
        SELECT doc_id, size, text_crc32, 'key' AS law, shard,
            row_number() OVER (PARTITION BY shard ORDER BY substr(md5(key), 1, 3), doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, grown_shard
        FROM summed JOIN placed USING (id)""",
    "op11_exact_dedup": r"""
        WITH content AS (
            SELECT doc_id, length(coalesce(text, '')) AS points, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS raw
            FROM documents
        )
        SELECT doc_id, first_value(doc_id) OVER copies AS keep_id, count(*) OVER (PARTITION BY raw) AS group_size,
            row_number() OVER copies = 1 AS kept, sha256(raw) AS text_sha256
        FROM content WINDOW copies AS (PARTITION BY raw ORDER BY points DESC, doc_id)""",
    "op12_vector_codes": _codes_sql(),
    "op5_chat_formatting": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
        ), marked AS (
            SELECT *, row_number() OVER w AS n, lag(role, 1, 'start') OVER w AS before,
                length(replace(replace(replace(text, '\', '\b'), '<', '\l'), '>', '\g')) AS text_chars,
                length(replace(replace(replace(role, '\', '\b'), '<', '\l'), '>', '\g')) AS role_chars
            FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
        ), checked AS (
            SELECT *, CASE WHEN (before, role) IN (('start', 'system'), ('start', 'user'), ('user', 'assistant'), ('assistant', 'user'))
                OR (before = 'system' AND role = 'user' AND n = 2) THEN NULL ELSE n - 1 END AS wrong
            FROM marked
        )
        SELECT conv_id, count(*)::BIGINT AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
            coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
            sum(role_chars + text_chars + 6 + 1 + 8)::BIGINT AS formatted_chars,
            (min(wrong) IS NULL AND arg_max(role, n) = 'assistant') AS valid,
            coalesce(min(wrong), -1)::INTEGER AS wrong_at
        FROM checked GROUP BY conv_id""",
}
