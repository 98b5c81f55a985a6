"""What the operators share: reading tables, text as bytes, Arrow batches in tasks, cuts of the lineage."""

from __future__ import annotations

import ctypes
import functools
import gc
import re
import sys
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Functions of this subpackage travel with their code, so executors need no copy of the repository.
cloudpickle.register_pickle_by_value(sys.modules["eventcanon.llm"])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``. Where that is unset, one of our own if all tasks run in this process (tests); else it fails."""
    root = spark.conf.get("spark.checkpoint.dir", None) or getattr(spark, "_llm_shared_folder", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = spark._llm_shared_folder = tempfile.mkdtemp(prefix="llm-shared-")
    return root.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """The same rows from files in the shared folder, so that a lost executor costs no recomputation and plans stay short."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


def text_of(name: str = "text") -> Column:
    """Text with NULL as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def fresh(df: DataFrame, **columns: Column | str) -> DataFrame:
    """Only the named columns, under names of our own, whatever else the table holds."""
    return df.select(*[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in columns.items()])


def with_new(df: DataFrame, **columns: Column) -> DataFrame:
    """`df` with the given columns; columns of those names (in either case) are replaced."""
    taken = {n.lower() for n in columns}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken], *[v.alias(n) for n, v in columns.items()])


def give_back() -> None:
    """Returns freed memory to the system: a worker is used again by the next stage and would keep what this one grew to."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim:
        trim(0)


def modest(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """`run`, which gives its memory back when the task's rows are done."""

    @functools.wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def map_batches(df: DataFrame, start: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema) -> DataFrame:
    """What ``start()`` returns, called for each Arrow batch of `df` in the tasks that hold the rows; `start` runs once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            out = work(batch)
            if out.num_rows:
                yield out

    return df.mapInArrow(modest(run), schema)


def parts(batch: pa.RecordBatch, column: int, most: int) -> Iterator[pa.RecordBatch]:
    """`batch` in parts of about `most` bytes of text in a column, at least one row each, so that few texts are Python strings at a time."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield batch.slice(start)


def blocks(texts: list[str], most: int = 8_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of `texts` of about `most` characters, at least one text each: bounds what a task works on at once."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > most:
            yield start, i
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield start, len(texts)


def learning_rows(df: DataFrame, doc_id: str, modulus: int, held_out: int) -> DataFrame:
    """Rows whose crc32 of the doc_id as text does not leave the held-out remainder."""
    return df.where(remainder(doc_id, modulus) != held_out)


def remainder(doc_id: str, modulus: int) -> Column:
    """crc32(doc_id as text) modulo `modulus`; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)
