"""The registered queries of this subpackage, each over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from eventcanon.llm import chat, decontaminate, html_text, language_id, mixing, packing, periodic, secrets, sharding, simhash, stream_dedup, structure, toxicity
from eventcanon.llm.common import table


def op1_secrets(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf, "documents"))


def op2_stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return stream_dedup.dedup(spark, f"{sf}/documents.parquet")


def op3_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.report(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op4_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf, "documents"))


def op5_language(spark: SparkSession, sf: str) -> DataFrame:
    return language_id.identify(table(spark, sf, "documents"))


def op6_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.report(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op7_html_text(spark: SparkSession, sf: str) -> DataFrame:
    return html_text.extract(table(spark, sf, "pages"))


def op8_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    return chat.repair(table(spark, sf, "conversations"))


def op9_mixing(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "source", "text")
    return mixing.replicate(docs).select("doc_id", "source", "copy", "n_copies", "shuffle_key")


def op10_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.linked_components(table(spark, sf, "documents"))


def op11_structure(spark: SparkSession, sf: str) -> DataFrame:
    return structure.report(table(spark, sf, "conversations"))


def op12_periodic(spark: SparkSession, sf: str) -> DataFrame:
    return periodic.report(table(spark, sf, "documents"))


def op13_packing(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    return packing.pack_documents(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_secrets, op2_stream_dedup, op3_toxicity, op4_sharding, op5_language, op6_decontaminate, op7_html_text, op8_chat_format, op9_mixing, op10_simhash,
        op11_structure, op12_periodic, op13_packing)
}

DEDUP_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""

LEAKS_SQL = """
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents
), b AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark
), asked AS (
  SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS said
  FROM (SELECT item, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), held AS (
  SELECT rid, i, n, array_to_string(w[i:i + n - 1], ' ') AS said
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM asked) WHERE len(w) >= n)
), found AS (
  SELECT DISTINCT rid, i, n, item FROM held JOIN asked USING (n, said)
), items AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM found) GROUP BY rid
), places AS (
  SELECT rid, p, p - row_number() OVER (PARTITION BY rid ORDER BY p) AS run FROM (SELECT DISTINCT rid, unnest(range(i - 1, i - 1 + n)) AS p FROM found)
), runs AS (
  SELECT rid, min(p) AS a, max(p) + 1 AS b FROM places GROUP BY rid, run
), spans AS (
  SELECT rid, sum(b - a) AS n_hit, string_agg(a || ':' || b, ',' ORDER BY a) AS spans FROM runs GROUP BY rid
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated, coalesce(spans, '') AS spans
FROM d LEFT JOIN items USING (rid) LEFT JOIN spans USING (rid)
"""

ORACLES = {"op2_stream_dedup": DEDUP_SQL, "op6_decontaminate": LEAKS_SQL, "op9_mixing": mixing.MIX_SQL, "op11_structure": structure.REPAIR_SQL}
