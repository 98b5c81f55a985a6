"""Named tables on a shared folder, kept as immutable snapshots.

A table is a folder of Parquet directories ``snapshot_version=N-id/part=value/...`` and a small JSON manifest per
version that lists the directories which make up that version. A new version may list directories
of earlier ones, so a merge rewrites only the partitions it touches; files are never changed in
place, and readers keep the version they started with. All file access goes through Spark's own
file-system layer, so any storage Spark can reach will do.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Logical data set names and the folder each stands for unless configured otherwise.
LOGICAL_DATASETS = {"raw": "raw", "canonical": "canonical", "derived": "derived"}


class ConcurrentWrite(RuntimeError):
    """Another writer published the version this writer was about to publish."""


@dataclass(frozen=True)
class Catalog:
    """Resolves ``dataset.table`` names to folders; `prefix` isolates test and trial runs."""

    spark: SparkSession
    root: str
    prefix: str = ""
    datasets: dict[str, str] = field(default_factory=dict)

    def dataset(self, name: str) -> str:
        """Logical name to folder name; unknown names pass through unchanged."""
        return {**LOGICAL_DATASETS, **self.datasets}.get(name, name)

    def isolated(self, namespace: str) -> "Catalog":
        """The same catalog with every data set and table routed to a name of its own."""
        return Catalog(self.spark, self.root, f"trial_{namespace}__", dict(self.datasets))

    def table(
        self, dataset: str, name: str, partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()
    ) -> "SnapshotTable":
        folder = self.dataset(dataset)
        if self.prefix:
            folder = self.prefix.rstrip("_")
            name = name if name.startswith(self.prefix) else self.prefix + name
        return SnapshotTable(
            self.spark, f"{self.root.rstrip('/')}/{folder}/{name}", tuple(partition_by), tuple(sort_by)
        )


@dataclass(frozen=True)
class SnapshotTable:
    spark: SparkSession
    path: str
    partition_by: tuple[str, ...] = ()
    sort_by: tuple[str, ...] = ()

    # --- manifest ---------------------------------------------------------------------------

    def _fs(self, path: str):
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), hadoop

    def versions(self) -> list[int]:
        fs, folder = self._fs(f"{self.path}/_manifest")
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def _manifest(self, version: int) -> dict:
        fs, file = self._fs(f"{self.path}/_manifest/{version:012d}.json")
        stream = fs.open(file)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def _publish(self, version: int, manifest: dict) -> None:
        fs, file = self._fs(f"{self.path}/_manifest/{version:012d}.json")
        try:
            stream = fs.create(file, False)  # never overwrites: the first writer of a version wins
        except Exception as error:
            if fs.exists(file):
                raise ConcurrentWrite(f"{self.path}: version {version} exists") from error
            raise
        try:
            stream.write(bytearray(json.dumps(manifest).encode()))
        finally:
            stream.close()

    def version(self) -> int | None:
        known = self.versions()
        return known[-1] if known else None

    def exists(self) -> bool:
        return self.version() is not None

    # --- reading ----------------------------------------------------------------------------

    def read(self, version: int | None = None) -> DataFrame:
        """The newest (or a given) version. Partition columns prune as usual."""
        version = self.version() if version is None else version
        if version is None:
            raise FileNotFoundError(f"no version of {self.path}")
        manifest = self._manifest(version)
        schema = T.StructType.fromJson(manifest["schema"])
        if not manifest["dirs"]:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.path}/{d}" for d in manifest["dirs"]]
        with_version = T.StructType([*schema.fields, T.StructField("snapshot_version", T.StringType())])
        raw = self.spark.read.schema(with_version).option("basePath", self.path).parquet(*paths)
        return raw.select(*schema.names)

    # --- writing ----------------------------------------------------------------------------

    def _layout(self, df: DataFrame, distinct: bool = False) -> DataFrame:
        """Arrange rows so that a write makes few, well-sized files.

        With cluster columns: a range exchange over partition and cluster columns, sorted inside
        files, so row groups can be skipped on read and one big partition is cut into several files.
        Without: a rebalance on the partition columns, which AQE splits where a partition is large
        and joins where partitions are small; otherwise every task would write to every partition.
        With both, `distinct` drops repeated rows behind the range exchange, where they lie together, so that it needs no exchange of its own.
        """
        if self.sort_by:
            keys = [*self.partition_by, *self.sort_by]
            dealt = df.repartitionByRange(*keys)
            return (dealt.distinct() if distinct else dealt).sortWithinPartitions(*keys)
        df = df.distinct() if distinct else df
        if self.partition_by:
            return df.hint("rebalance", *self.partition_by)
        return df

    def _write_dirs(self, df: DataFrame, version: int, columns: list[str], distinct: bool = False) -> list[str]:
        # A folder of its own per attempt: a writer that loses the race never touches the winner's files.
        folder = f"snapshot_version={version}-{uuid.uuid4().hex[:12]}"
        writer = self._layout(df.select(*columns), distinct).write.mode("overwrite")
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        writer.parquet(f"{self.path}/{folder}")
        return self._leaf_dirs(folder, len(self.partition_by))

    def _leaf_dirs(self, folder: str, depth: int) -> list[str]:
        if depth == 0:
            return [folder]
        fs, path = self._fs(f"{self.path}/{folder}")
        found: list[str] = []
        for status in fs.listStatus(path):
            name = status.getPath().getName()
            if status.isDirectory() and "=" in name:
                found += self._leaf_dirs(f"{folder}/{name}", depth - 1)
        return sorted(found)

    def replace(self, df: DataFrame, expect: int | None = None, properties: dict | None = None, distinct: bool = False) -> int:
        """Publish `df` (its different rows, if `distinct`) as the whole next version. `expect` is the version `df` was made from."""
        base = self.version() if expect is None else expect
        version = 0 if base is None else base + 1
        dirs = self._write_dirs(df, version, df.columns, distinct)
        kept = {} if base is None else self._manifest(base).get("properties", {})
        self._publish(version, {"schema": _nullable(df).jsonValue(), "dirs": dirs, "properties": {**kept, **(properties or {})}})
        return version

    def properties(self) -> dict:
        """Settings that stay with the table from version to version."""
        known = self.version()
        return {} if known is None else self._manifest(known).get("properties", {})

    def append(self, df: DataFrame, properties: dict | None = None, distinct: bool = False) -> int:
        """Publish the next version as the current directories plus `df` (its different rows, if `distinct`)."""
        base = self.version()
        if base is None:
            return self.replace(df, properties=properties, distinct=distinct)
        manifest = self._manifest(base)
        columns = T.StructType.fromJson(manifest["schema"]).names
        dirs = self._write_dirs(df, base + 1, columns, distinct)
        self._publish(base + 1, _next(manifest, manifest["dirs"] + dirs, properties))
        return base + 1

    def set_properties(self, properties: dict) -> int:
        """Publish the newest version again with other settings; no data is written or read."""
        base = self.version()
        if base is None:
            raise FileNotFoundError(f"no version of {self.path}")
        manifest = self._manifest(base)
        self._publish(base + 1, _next(manifest, manifest["dirs"], properties))
        return base + 1

    def compact(self) -> int:
        """Publish the newest version again with few files per partition. Runs only when called.

        The manifest says that the rows are those of the version before, so change feeds need not read them.
        """
        base = self.version()
        manifest = self._manifest(base)
        df = self.read(base)
        dirs = self._write_dirs(df, base + 1, df.columns)
        self._publish(base + 1, {**_next(manifest, dirs), "same_rows": True})
        return base + 1

    def steps(self, since: int, until: int) -> list[tuple[int, list[str], list[str]]]:
        """(version, directories left, directories new) for each version after `since` that changes rows, up to `until`.

        Read from the manifests alone. Versions that were removed in between are passed over in one step, which has to compare
        what the versions around them list.
        """
        known = [v for v in self.versions() if since <= v <= until]
        if not known or known[0] != since or known[-1] != until:
            raise FileNotFoundError(f"{self.path}: versions {since} and {until} are not both kept")
        manifests = [self._manifest(v) for v in known]
        out = []
        for before, after, a, b in zip(known, known[1:], manifests, manifests[1:]):
            if b.get("same_rows") and after == before + 1:
                continue
            old, new = set(a["dirs"]), set(b["dirs"])
            if old != new:
                out.append((after, sorted(old - new), sorted(new - old)))
        return out

    def schema(self, version: int | None = None) -> T.StructType:
        """Columns of the newest (or a given) version; no data is read."""
        version = self.version() if version is None else version
        return T.StructType.fromJson(self._manifest(version)["schema"])

    def read_dirs(self, dirs: Sequence[str], schema: T.StructType | None = None) -> DataFrame:
        """Rows of some of the directories that versions list."""
        return self._read_dirs(list(dirs), schema or self.schema())

    def expire(self, keep: int = 1) -> list[int]:
        """Remove all but the newest `keep` versions, and the directories that only they list. Returns the versions removed.

        Readers of removed versions fail from then on. Directories of writers that have not published are left alone.
        """
        if keep < 1:
            raise ValueError("keep at least one version")
        known = self.versions()
        gone, kept = known[:-keep], known[-keep:]
        held = {d for v in kept for d in self._manifest(v)["dirs"]}
        for version in gone:
            dirs = set(self._manifest(version)["dirs"]) - held
            for name in [f"_manifest/{version:012d}.json", *sorted(dirs)]:
                fs, path = self._fs(f"{self.path}/{name}")
                fs.delete(path, True)
        return gone

    def replace_touched(self, make, batch: DataFrame, keys: Sequence[str] | None = None, properties: dict | None = None) -> int:
        """Rewrite only the partitions that occur in `batch`; keep the other directories.

        `make(current)` gets the current rows of those partitions and returns their new rows. With `keys`, the partitions
        where the batch's keys are now are rewritten too, so that a row may move to another partition; that reads the key
        and partition columns of the whole table. Without, partitions are to be a function of the key, and a row that leaves the
        batch's partitions fails. `batch` is read for the list of partition values, of which there are at most as many
        as directories in the next manifest, and by `make`.
        """
        base = self.version()
        if base is None:
            raise FileNotFoundError(f"no version of {self.path}")
        current = self.read(base)
        if not self.partition_by:
            return self.replace(make(current), expect=base, properties=properties)
        touched = self._touched(batch)
        if keys:
            touched |= self._touched(current.select(*dict.fromkeys([*keys, *self.partition_by])).join(batch.select(*keys).distinct(), list(keys), "left_semi"))
        manifest = self._manifest(base)
        schema = T.StructType.fromJson(manifest["schema"])
        keep = [d for d in manifest["dirs"] if _partition_of(d) not in touched]
        mine = [d for d in manifest["dirs"] if _partition_of(d) in touched]
        rows = self.read(base) if not keep else self._read_dirs(mine, schema)
        dirs = self._write_dirs(make(rows), base + 1, schema.names)
        moved = {_partition_of(d) for d in dirs} - touched
        if moved:
            raise ValueError(f"rows left the partitions of the batch: {sorted(moved)[:3]}")
        self._publish(base + 1, _next(manifest, keep + dirs, properties))
        return base + 1

    def _read_dirs(self, dirs: list[str], schema: T.StructType) -> DataFrame:
        if not dirs:
            return self.spark.createDataFrame([], schema)
        with_version = T.StructType([*schema.fields, T.StructField("snapshot_version", T.StringType())])
        paths = [f"{self.path}/{d}" for d in dirs]
        raw = self.spark.read.schema(with_version).option("basePath", self.path).parquet(*paths)
        return raw.select(*schema.names)

    def _touched(self, batch: DataFrame) -> set[str]:
        """Directory spellings of the batch's partition values. As many as the directories one version of the table may list."""
        names = [
            F.concat(F.lit(f"{c}="), _escaped(F.col(c).cast("string"))) for c in self.partition_by
        ]
        return {r.p for r in batch.select(F.concat_ws("/", *names).alias("p")).distinct().toLocalIterator()}


def _next(manifest: dict, dirs: list[str], properties: dict | None = None) -> dict:
    """The manifest of the version after `manifest`."""
    kept = {k: v for k, v in manifest.items() if k != "same_rows"}
    return {**kept, "dirs": dirs, "properties": {**manifest.get("properties", {}), **(properties or {})}}


def _partition_of(directory: str) -> str:
    return directory.split("/", 1)[1] if "/" in directory else ""


def _escaped(value):
    """The directory spelling of a partition value, for the characters Spark escapes in paths."""
    value = F.coalesce(F.when(value == "", F.lit(None)).otherwise(value), F.lit("__HIVE_DEFAULT_PARTITION__"))
    for char in "%\"#'*/:=?\\{[]^":
        value = F.replace(value, F.lit(char), F.lit(f"%{ord(char):02X}"))
    return value


def _nullable(df: DataFrame) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])
