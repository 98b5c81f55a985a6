"""Row-level changes between two versions of a table, and cursors that make incremental runs read nothing but those.

Manifests list the directories of every version, so what a version left alone is known without reading it: only directories that one
version lists and the next does not are opened. A compaction says in its manifest that it changed no row. A run over a table
with no new version reads no data at all, and neither does the target: a consumer's cursor (the version it has read up to)
is kept in the properties of the table it writes, published together with the rows made from that version, so a run that fails
before publishing is simply run again.
"""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventcanon.sources.catalog import SnapshotTable
from eventcanon.sources.reads import Filters, predicate

CHANGE = "_change"
INSERT, UPDATE, DELETE = "insert", "update", "delete"


def _nothing(table: SnapshotTable, schema: T.StructType) -> DataFrame:
    return table.spark.createDataFrame([], T.StructType([*schema.fields, T.StructField(CHANGE, T.StringType())]))


def changes(table: SnapshotTable, since: int | None, keys: Sequence[str] | None = None, until: int | None = None) -> DataFrame:
    """Net changes of rows from version `since` (None: before the first) to `until` (default: the newest), with ``_change``.

    insert and update rows are as they are in `until`, delete rows as they were in `since`. A key that came and went in between, and a row that
    was only written again, is no change. `keys` are unique in every version; a NULL is a key value like any other. Without keys only rows
    of added directories can be told, so a version that dropped directories raises.
    """
    newest = table.version()
    if newest is None:
        raise FileNotFoundError(f"no version of {table.path}")
    until = newest if until is None else until
    schema = table.schema(until)
    if since is None:
        return table.read(until).withColumn(CHANGE, F.lit(INSERT))
    steps = table.steps(since, until)
    if not steps:
        return _nothing(table, schema)
    if not any(left for _, left, _ in steps):
        return table.read_dirs([d for _, _, new in steps for d in new], schema).withColumn(CHANGE, F.lit(INSERT))
    if not keys:
        raise ValueError(f"{table.path}: rows were rewritten after version {since}; name the keys to compare them by")
    sides = []
    for version, left, new in steps:
        for side, dirs in enumerate((left, new)):
            if dirs:
                rows = table.read_dirs(dirs, schema)
                sides.append(rows.select(*keys, F.struct(F.lit(version).alias("v"), F.lit(side).alias("s")).alias("__at"), F.struct(*schema.names).alias("__row")))
    both = reduce(lambda a, b: a.unionAll(b), sides)
    # States of a key follow each other, so its first old and last new state are all that counts. An old side sorts before the new one.
    ends = both.groupBy(*keys).agg(
        F.min("__at").alias("__first"), F.max("__at").alias("__last"),
        F.min_by("__row", "__at").alias("__before"), F.max_by("__row", "__at").alias("__after"))
    was, now = F.col("__first.s") == 0, F.col("__last.s") == 1
    differs = ~reduce(operator.and_, [_same(schema[c].dataType, f"__before.{c}", f"__after.{c}") for c in schema.names])
    kind = F.when(~was & now, INSERT).when(was & ~now, DELETE).when(was & now & differs, UPDATE)
    row = F.when(now, F.col("__after")).otherwise(F.col("__before"))
    named = ends.select(kind.alias(CHANGE), row.alias("__row")).where(F.col(CHANGE).isNotNull())
    return named.select("__row.*", CHANGE)


def _same(kind: T.DataType, a: str, b: str):
    """Equality with NULLs; values that do not compare (maps, variants) are the same if their JSON text is."""
    text = kind.simpleString()
    if "map<" in text or "variant" in text:
        return F.to_json(F.struct(F.col(a).alias("x"))).eqNullSafe(F.to_json(F.struct(F.col(b).alias("x"))))
    return F.col(a).eqNullSafe(F.col(b))


def _name(source: SnapshotTable, reader: str) -> str:
    return f"cursor/{reader}/{source.path}"


def cursor(target: SnapshotTable, source: SnapshotTable, reader: str = "") -> int | None:
    """The version of `source` up to which `target` holds what came of it; None before the first run."""
    return target.properties().get(_name(source, reader)) if target.exists() else None


def advanced(source: SnapshotTable, until: int, reader: str = "") -> dict:
    """Properties to publish with the rows made from `source` up to version `until`: ``target.append(rows, advanced(source, until))``."""
    return {_name(source, reader): until}


def new_rows(
    source: SnapshotTable, target: SnapshotTable, keys: Sequence[str] | None = None, filters: Filters | None = None,
    reader: str = "", columns: Sequence[str] | None = None,
) -> tuple[DataFrame, int]:
    """Rows of `source` that are new or changed since the last run into `target`, and the version to advance the cursor to.

    Rows that were deleted are not read; `changes` tells them.
    """
    until = source.version()
    if until is None:
        raise FileNotFoundError(f"no version of {source.path}")
    found = changes(source, cursor(target, source, reader), keys, until)
    rows = found.where(F.col(CHANGE) != DELETE).drop(CHANGE)
    rows = rows.where(predicate(rows, filters))
    return (rows.select(*columns) if columns else rows), until


def run_once(source: SnapshotTable, target: SnapshotTable, make, publish, keys: Sequence[str] | None = None, filters: Filters | None = None, reader: str = "") -> int | None:
    """One incremental run: ``make(rows)`` of the new rows, handed to ``publish(made, properties)``; returns the version published.

    With no new version of the source nothing is read, written or published, and None is returned. A source that has
    new versions but the same rows only moves the cursor.
    """
    since, until = cursor(target, source, reader), source.version()
    if until is not None and since == until:
        return None
    if since is not None and target.exists() and not source.steps(since, until):
        return target.set_properties(advanced(source, until, reader))
    rows, until = new_rows(source, target, keys, filters, reader)
    return publish(make(rows), advanced(source, until, reader))
