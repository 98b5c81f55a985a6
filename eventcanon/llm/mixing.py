"""Mixing sources to target weights by Poisson replication.

A source's mean repetition rate is its share of the byte budget over its bytes. Each document is repeated as often as a
Poisson variable with that mean says; the variable is found by inverting the distribution at a number in (0, 1) made of a
hash of the seed, the source, the doc_id and the text, so that the same document always gets the same count, whichever task asks.
Means above MOST_MEAN are split into equal parts, each inverted with a hash of its own, and summed. Copies are then ordered
by a hash of their own, across all sources. Everything is SQL functions; the only shuffles are the sum of bytes
per source, the lookup of the source's rate (split by the engine where a source is hot) and the global order.

A NULL source is a source of its own, NULL text counts as empty, a size is the text's UTF-8 bytes plus 1. Identical
rows get identical counts. Sources that a weight table lacks, or whose weight is NULL, zero or negative, get rate 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventcanon.llm.common import text_of

MOST_MEAN = 16.0
HEX_DIGITS = 13
TAIL = 100


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) from an MD5 of the parts."""
    said = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return (F.conv(F.substring(F.md5(said), 1, HEX_DIGITS), 16, 10).cast("double") + 0.5) / float(16**HEX_DIGITS)


def rates(sizes: DataFrame, weights: DataFrame | None, epochs: float, temperature: float) -> DataFrame:
    """`sizes` (source_key, n_docs, n_bytes) -> with rate, parts and the cumulative probabilities of one part.

    Weights come from `weights` (source, weight); without it they are bytes to the power of `temperature`. The budget is
    `epochs` times all bytes.
    """
    if weights is None:
        weighed = sizes.withColumn("weight", F.pow(F.col("n_bytes").cast("double"), F.lit(temperature)))
    else:
        own = weights.select(_key("source").alias("source_key"), F.col("weight").cast("double").alias("weight")).groupBy("source_key").agg(F.sum("weight").alias("weight"))
        weighed = sizes.join(own, "source_key", "left").withColumn("weight", F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0)))
    all_weight = weighed.agg(F.sum("weight")).scalar()
    all_bytes = sizes.agg(F.sum("n_bytes")).scalar()
    share = F.when(all_weight > 0, F.col("weight") / all_weight).otherwise(F.lit(0.0))
    rated = weighed.withColumn("rate", share * F.lit(float(epochs)) * all_bytes / F.col("n_bytes"))
    parts = F.greatest(F.ceil(F.col("rate") / MOST_MEAN), F.lit(1)).cast("int")
    mean = F.col("rate") / F.col("parts")
    first = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("upto"))
    steps = F.aggregate(
        F.sequence(F.lit(1), F.lit(TAIL)), first,
        lambda acc, k: F.struct(
            (acc["p"] * mean / k).alias("p"),
            F.concat(acc["upto"], F.array(F.element_at(acc["upto"], -1) + acc["p"] * mean / k)).alias("upto"),
        ),
        lambda acc: acc["upto"],
    )
    return rated.withColumn("parts", parts).withColumn("upto", steps).select("source_key", "rate", "parts", "upto")


def _key(name: str) -> Column:
    """Source as a key: NULL and text never meet."""
    return F.when(F.col(name).isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), F.col(name).cast("string")))


def replicate(
    docs: DataFrame, weights: DataFrame | None = None, epochs: float = 1.0, temperature: float = 0.5, seed: int = 7, source: str = "source",
) -> DataFrame:
    """Every column of `docs`, repeated, with `copy` (from 0), `n_copies`, `rate` and `shuffle_key`, in global random order.

    Input columns of those names are replaced.
    """
    new = ("copy", "n_copies", "rate", "shuffle_key")
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in new]
    mixed = docs.select(*kept, F.col("doc_id").cast("string").alias("__id"), _key(source).alias("__source"), F.md5(text_of().cast("binary")).alias("__text"))
    sizes = docs.select(_key(source).alias("source_key"), (F.octet_length(text_of()) + 1).cast("long").alias("size")).groupBy("source_key").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("n_bytes"))
    rated = rates(sizes, weights, epochs, temperature).select(*[F.col(c).alias(f"__{c}") for c in ("source_key", "rate", "parts", "upto")])
    known = mixed.join(rated, F.col("__source") == F.col("__source_key"), "left")
    # One draw a part; the search among the probabilities then compares numbers only.
    draws = F.transform(F.sequence(F.lit(1), F.col("__parts")), lambda part: uniform(F.lit(seed), F.col("__source"), F.col("__id"), F.col("__text"), part))
    count = F.aggregate(draws, F.lit(0), lambda acc, u: acc + F.size(F.filter("__upto", lambda c: c <= u)))
    counted = known.withColumn("__n", F.when(F.col("__rate") > 0, count).otherwise(F.lit(0)))
    copies = counted.where("__n > 0").withColumn("__copy", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)))
    said = F.concat_ws("|", F.lit(str(seed)), F.lit("order"), F.coalesce("__id", F.lit("null")), "__text", F.col("__copy").cast("string"))
    key = F.conv(F.substring(F.md5(said), 1, 15), 16, 10).cast("long")
    return copies.select(*kept, *[v.alias(n) for n, v in zip(new, (F.col("__copy"), F.col("__n"), F.col("__rate"), key))]).orderBy("shuffle_key")


MIX_SQL = """
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t, CASE WHEN source IS NULL THEN '-' ELSE '=' || source END AS sk FROM documents
), z AS (
  SELECT sk, sum(strlen(t) + 1)::DOUBLE AS b FROM d GROUP BY sk
), r AS (
  SELECT sk, pow(b, 0.5) / sum(pow(b, 0.5)) OVER () * (SELECT sum(b) FROM z) / b AS rate FROM z
), p AS (
  SELECT sk, rate, greatest(ceil(rate / 16.0), 1)::INT AS parts FROM r
), terms AS (
  SELECT sk, k, exp(-rate / parts + k * ln(rate / parts) - lgamma(k + 1)) AS term FROM p, range(0, 101) AS q(k)
), c AS (
  SELECT sk, list(upto ORDER BY k) AS upto FROM (
    SELECT sk, k, sum(term) OVER (PARTITION BY sk ORDER BY k ROWS UNBOUNDED PRECEDING) AS upto FROM terms) GROUP BY sk
), n AS (
  SELECT d.doc_id, d.source, d.t, list_sum(list_transform(range(1, p.parts + 1), lambda part: len(list_filter(c.upto, lambda v: v <=
    (('0x' || substr(md5('7|' || p.sk || '|' || coalesce(d.doc_id::VARCHAR, 'null') || '|' || md5(d.t) || '|' || part), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0))))::INT AS n_copies
  FROM d JOIN p USING (sk) JOIN c USING (sk)
)
SELECT n.doc_id, n.source, e.copy::INT AS copy, n.n_copies,
  ('0x' || substr(md5('7|order|' || coalesce(n.doc_id::VARCHAR, 'null') || '|' || md5(n.t) || '|' || e.copy), 1, 15))::BIGINT AS shuffle_key
FROM n, LATERAL (SELECT unnest(range(0, n.n_copies)) AS copy) AS e
"""
