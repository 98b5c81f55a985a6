"""Byte-balanced shards by Karmarkar-Karp differencing.

Documents of equal text form an indivisible group. Every group starts as a partial partition (its bytes in one of k slots, nothing in the
others); the two partial partitions with the largest spread are combined, one's largest slot with the other's smallest, until one is left.

This runs in three rounds, none of which gathers what grows with the data in one task. Groups of more than 1 / LARGE of a shard (fewer than
k * LARGE) are combined first. The others are dealt by hash into cells of bounded size; each cell combines its
groups with its share of the large groups' slots, so that all cells together fill what those leave. A last cell of about
CELL_GROUPS groups, drawn by hash, is combined with the sums of all that is placed and evens out what the cells leave.
A group larger than a shard ends alone in its slot and the others are balanced around it.

Law: ``bytes``. Sizes are UTF-8 bytes of the text (NULL: none) plus 8. Slots are numbered from 0 without gaps in each shard, by
buckets of the doc_id's hash and then by doc_id. Repeated rows get slots of their own. Columns of the input beside
doc_id and text are left out; with ``keep=True`` they stay, and those named like a result column are replaced.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventcanon.llm.common import cut, text_of

SHARDS = 24
CELL_GROUPS = 2048
LARGE = 64
BUCKET_ROWS = 20_000


def difference(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Combine partial partitions (n x k sums) into one: each one's map from its slots to the result's, and the result's sums.

    Ties are decided by the order of the rows.
    """
    n, k = vectors.shape
    nodes: list[tuple] = []  # (order of slots by falling sum) of a row, or (left, right, order)
    heap = []
    for i, v in enumerate(vectors):
        order = np.argsort(-v, kind="stable")
        sums = v[order]
        nodes.append((None, None, order))
        heap.append((int(sums[-1] - sums[0]), i, sums))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a, left = heapq.heappop(heap)
        _, b, right = heapq.heappop(heap)
        sums = left + right[::-1]
        order = np.argsort(-sums, kind="stable")
        sums = sums[order]
        nodes.append((a, b, order))
        heapq.heappush(heap, (int(sums[-1] - sums[0]), len(nodes) - 1, sums))
    maps = np.zeros((n, k), np.int32)
    todo = [(len(nodes) - 1, np.arange(k, dtype=np.int32))]
    while todo:
        at, to = todo.pop()  # to[j]: where the j-th largest slot of this node goes
        a, b, order = nodes[at]
        if a is None:
            maps[at, order] = to
        else:
            left = np.empty(k, np.int32)
            left[order] = to
            todo.append((a, left))
            todo.append((b, left[::-1]))
    return maps, heap[0][2]


def _cell(placed: list[int], of_bytes: int | None):
    """Combines a cell's groups with sums placed before: all of them, or the cell's share where it is one of many."""

    def solve(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["bytes", "key"], ascending=[False, True], kind="stable")
        size = frame["bytes"].to_numpy()
        vectors = np.zeros((len(frame) + 1, len(placed)), np.int64)
        vectors[0] = placed if of_bytes is None else [int(p * int(size.sum()) // of_bytes) for p in placed]
        vectors[1:, 0] = size
        maps, _ = difference(vectors)
        shard_of = np.empty(len(placed), np.int32)
        shard_of[maps[0]] = np.arange(len(placed))
        return pd.DataFrame({"key": frame["key"], "bytes": size, "shard": shard_of[maps[1:, 0]]})

    return solve


def _sums(placed: DataFrame, shards: int) -> list[int]:
    """Bytes of each shard: as many rows as there are shards."""
    out = [0] * shards
    for r in placed.groupBy("shard").agg(F.sum("bytes").alias("n")).collect():
        out[r.shard] = r.n
    return out


def shard_groups(groups: DataFrame, shards: int = SHARDS, cell_groups: int = CELL_GROUPS) -> DataFrame:
    """`groups` (key string, bytes long) -> key, bytes, shard."""
    groups = cut(groups)
    n, total = groups.agg(F.count(F.lit(1)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    large = F.col("bytes") > total // (shards * LARGE)
    last = F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < (1 << 30) * cell_groups // max(n, 1)
    cells = max(1, n // cell_groups)
    dealt = groups.withColumn("cell", F.when(large, F.lit(-2)).when(last, F.lit(-1)).otherwise(F.pmod(F.xxhash64(F.lit("cell"), "key"), F.lit(cells))))
    schema = "key string, bytes long, shard int"
    first = cut(dealt.where("cell = -2").groupBy("cell").applyInPandas(_cell([0] * shards, None), schema))
    placed = _sums(first, shards)
    body = dealt.where("cell >= 0")
    of_bytes = body.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    middle = cut(body.groupBy("cell").applyInPandas(_cell(placed, max(1, of_bytes)), schema))
    placed = [a + b for a, b in zip(placed, _sums(middle, shards))]
    end = cut(dealt.where("cell = -1").groupBy("cell").applyInPandas(_cell(placed, None), schema))
    return first.union(middle).union(end)


def shard_documents(docs: DataFrame, shards: int = SHARDS, keep: bool = False, cell_groups: int = CELL_GROUPS) -> DataFrame:
    """Each document's shard and its place in it; see the module."""
    size = (F.octet_length(text_of()) + 8).cast("long")
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns]) if keep else F.lit(None).cast("string")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), size.alias("size"), F.crc32(text_of().cast("binary")).alias("text_crc32"),
        F.sha2(text_of(), 256).alias("key"), rest.alias("rest"),
    )
    groups = rows.groupBy("key").agg(F.sum("size").alias("bytes"))
    placed = rows.join(shard_groups(groups, shards, cell_groups).select("key", "shard"), "key").drop("key")
    n = docs.count()
    buckets = max(16, n // (shards * BUCKET_ROWS))
    placed = placed.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(buckets)))
    counted = placed.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counted.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    own = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32")
    numbered = placed.withColumn("nth", F.row_number().over(own)).join(starts, ["shard", "bucket"])
    columns = {
        "doc_id": F.col("doc_id"), "size": F.col("size"), "text_crc32": F.col("text_crc32"), "law": F.lit("bytes"), "shard": F.col("shard"),
        "slot": (F.col("start") + F.col("nth") - 1).cast("long"), "grown_shard": F.lit(None).cast("int"),
    }
    if keep:
        taken = {c.lower() for c in columns}
        columns |= {c: F.col("rest").getField(c) for c in docs.columns if c.lower() not in taken}
    return numbered.select(*[v.alias(c) for c, v in columns.items()])


def shard_balance(placed: DataFrame) -> DataFrame:
    """Rows and bytes of each shard."""
    return placed.groupBy("shard").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("size").alias("n_bytes"))


