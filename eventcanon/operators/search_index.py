"""Text search by a posting table kept beside the texts.

The index is a table of (token, row bucket, key), laid out by a bucket of the token and sorted in its files; the texts are laid out by a bucket
of their key. A search reads the postings of its words only, keeps the keys that have all of them, reads the texts of those keys' buckets and
verifies them. New rows are appended to both tables; postings of texts that changed are kept, and verification drops what no
longer holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventcanon.functions.text import contains_terms, search_terms, text_words
from eventcanon.sources.catalog import SnapshotTable

TOKEN_BUCKET, ROW_BUCKET = "token_bucket", "row_bucket"


def _bucket(value: str | Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(buckets)).cast("int")


def _postings(rows: DataFrame, key: str, column: str, token_buckets: int, row_buckets: int) -> DataFrame:
    """What `postings` gives, with repeats where rows repeat a key."""
    words = rows.select(F.col(key).alias("key"), F.explode(F.array_distinct(text_words(column))).alias("token"))
    return words.where("token <> ''").select("token", "key", _bucket("key", row_buckets).alias(ROW_BUCKET), _bucket("token", token_buckets).alias(TOKEN_BUCKET))


def postings(rows: DataFrame, key: str, column: str, token_buckets: int = 256, row_buckets: int = 256) -> DataFrame:
    """token, key, row bucket and token bucket: a row for each different word of each text. NULL texts have none; NULL is a key like any other."""
    return _postings(rows, key, column, token_buckets, row_buckets).distinct()


def add_rows(texts: SnapshotTable, index: SnapshotTable, rows: DataFrame, key: str, column: str, token_buckets: int = 256, row_buckets: int = 256) -> None:
    """Append rows to the texts and their words to the index. Both tables are made on first use, which settles the numbers of buckets.

    `texts` is partitioned by ``row_bucket``, `index` by ``token_bucket`` and sorted by token, or by token and key, which cuts the
    postings of a word that most texts have into several tasks and files.
    """
    if index.exists():
        settled = index.properties()
        token_buckets, row_buckets = settled["token_buckets"], settled["row_buckets"]
    settled = {"token_buckets": token_buckets, "row_buckets": row_buckets}
    # Texts first: a posting without its text finds nothing, a text without postings would be missed by readers of the index.
    texts.append(rows.withColumn(ROW_BUCKET, _bucket(key, row_buckets)), settled)
    index.append(_postings(rows, key, column, token_buckets, row_buckets), settled, distinct=True)


def candidates(index: SnapshotTable, words: Sequence[str]) -> DataFrame:
    """key and row bucket of the rows that hold every word; only the words' buckets are read."""
    wanted = sorted(set(words))
    spark, buckets = index.spark, index.properties()["token_buckets"]
    of = spark.range(1).select(F.array(*[_bucket(F.lit(w), buckets) for w in wanted])).first()[0]
    found = index.read().where(F.col(TOKEN_BUCKET).isin(*sorted(set(of))) & F.col("token").isin(*wanted))
    return found.groupBy("key", ROW_BUCKET).agg(F.count_distinct("token").alias("n")).where(F.col("n") == len(wanted)).select("key", ROW_BUCKET)


def search(texts: SnapshotTable, index: SnapshotTable, text: str, key: str, column: str) -> DataFrame:
    """The rows of `texts` that `contains_terms` finds, by the index. Only directories of buckets with a candidate are read.

    Which buckets those are is asked before: at most as many numbers as the texts have buckets.
    """
    hits = candidates(index, search_terms(text)).select(F.col("key").alias("__key"), F.col(ROW_BUCKET).alias("__bucket"))
    buckets = sorted(r[0] for r in hits.select("__bucket").distinct().collect())
    rows = texts.read().where(F.col(ROW_BUCKET).isin(*buckets))
    met = rows.join(hits, (F.col(ROW_BUCKET) == F.col("__bucket")) & F.col(key).eqNullSafe(F.col("__key")), "left_semi")
    return met.where(contains_terms(column, text)).drop(ROW_BUCKET)
