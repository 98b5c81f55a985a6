"""Continuous fold with keyed state: the newest non-NULL value of each field lives in the state store, not in a table.

Every field of a key has a value state of its own with its place in the log order. An event changes a state only if it comes later
in that order, so late, shuffled and repeated events are harmless, and a restart goes on from the checkpoint. A batch costs what its
keys cost, whatever the number of keys known. Rows that cannot be a key's newest are dropped in the tasks that read them, before
the shuffle, so a key that holds most of a batch sends at most one row per field and Arrow batch.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from eventcanon.operators.latest import latest_per_key
from eventcanon.session import checkpoint_root
from eventcanon.sources.catalog import SnapshotTable

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
BATCH = "fold_batch"


def _may_count(events: DataFrame, key: str, fields: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows that are, among those of their key in an Arrow batch, the newest with some field, or the newest of all."""
    names = [key, *order, *fields]
    rows = events.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(names)])
    by = [(f"c{i + 1}", "ascending") for i in range(len(order))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch]).append_column("__row", pa.array(range(batch.num_rows)))
            keep: set[int] = set()
            for field in [None, *(f"c{i}" for i in range(1 + len(order), len(names)))]:
                held = table if field is None else table.filter(pc.is_valid(table[field]))
                at = pc.sort_indices(held, sort_keys=by if field is None else [*by, (field, "ascending")], null_placement="at_start")
                keep.update(held.take(at).group_by("c0", use_threads=False).aggregate([("__row", "last")])["__row_last"].to_pylist())
            yield batch.take(pa.array(sorted(keep), pa.int64()))

    return rows.mapInArrow(run, rows.schema)


def _place(values: Sequence) -> tuple:
    """Sorts NULLs first."""
    return tuple((v is not None, v) for v in values)


class FoldState(StatefulProcessor):
    """Keeps (order, value) of each field, and of the version, in value states; gives a key's row when one of them changed."""

    def __init__(self, names: list[str], fields: list[T.StructField], order: list[T.StructField], version: int):
        self.names, self.fields, self.order, self.version = names, fields, order, version

    def init(self, handle: StatefulProcessorHandle) -> None:
        at = [T.StructField(f"o{i}", f.dataType) for i, f in enumerate(self.order)]
        of = [*self.fields, self.order[self.version]]
        self.states = [handle.getValueState(f"f{i}", T.StructType([*at, T.StructField("value", f.dataType)])) for i, f in enumerate(of)]

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        n = len(self.order)
        held = [s.get() if s.exists() else None for s in self.states]
        best = [tuple(h) if h is not None else None for h in held]
        for row in rows:
            at = tuple(row[1 : 1 + n])
            for i, value in enumerate((*row[1 + n :], at[self.version])):
                last = i == len(self.fields)  # the version counts for every event
                if (value is not None or last) and (best[i] is None or _place((*at, value)) > _place(best[i])):
                    best[i] = (*at, value)
        changed = False
        for state, old, new in zip(self.states, held, best):
            if new is not None and (old is None or tuple(old) != new):
                state.update(new)
                changed = True
        if changed:
            yield Row(*self.names)(key[0], *(b[-1] if b else None for b in best))

    def close(self) -> None:
        pass


def fold_stream(events: DataFrame, key: str, fields: Sequence[str], order: Sequence[str] = ("occurred_at", "event_id"), version: str = "event_id") -> DataFrame:
    """A streaming DataFrame of the keys whose state changed: key, fields, row_version. `version` is one of `order`.

    Run it in update mode; the session's state store has to be RocksDB when it is started (see `start_keyed_fold`).
    """
    types = events.schema
    counted = _may_count(events, key, fields, order)
    of = T.StructType([T.StructField(key, types[key].dataType), *(T.StructField(f, types[f].dataType) for f in fields), T.StructField("row_version", types[version].dataType)])
    processor = FoldState(of.names, [types[f] for f in fields], [types[o] for o in order], list(order).index(version))
    return counted.groupBy("c0").transformWithState(processor, of, "update", "none")


def start_keyed_fold(
    events: DataFrame, table: SnapshotTable, key: str, fields: Sequence[str], order: Sequence[str] = ("occurred_at", "event_id"),
    version: str = "event_id", checkpoint: str | None = None,
) -> StreamingQuery:
    """Fold a stream until its input is used up; the rows that changed are appended to `table`, and nothing of it is rewritten or read.

    A batch that is run again appends the same rows under the same batch number.
    """
    spark = events.sparkSession

    def each(batch: DataFrame, batch_id: int) -> None:
        table.append(batch.withColumn(BATCH, F.lit(batch_id).cast("long")))

    where = checkpoint or f"{checkpoint_root(spark).rstrip('/')}/keyed{table.path.replace(':', '')}"
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        folded = fold_stream(events, key, fields, order, version)
        return folded.writeStream.outputMode("update").foreachBatch(each).option("checkpointLocation", where).trigger(availableNow=True).start()
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


def current_rows(table: SnapshotTable, key: str) -> DataFrame:
    """The state of every key, as `fold_latest` gives it: the row of the key's last batch."""
    last = latest_per_key(table.read(), [key], [BATCH]).drop(BATCH)
    return last.withColumns({"row_id": F.col(key), "row_state": F.lit("synced")})


def settle(table: SnapshotTable, key: str) -> int:
    """Publish the table with the last row of each key only. Runs only when called, between runs of the stream."""
    base = table.version()
    return table.replace(latest_per_key(table.read(base), [key], [BATCH]), expect=base)
