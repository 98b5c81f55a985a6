from collections import defaultdict

from pyspark.sql import functions as F

from eventcanon.llm import stream_dedup

ROWS = [(1, "a"), (2, "b"), (3, "a"), (4, None), (5, ""), (6, "c"), (6, "c"), (None, "b"), (None, "d"), (7, "x" * 200_000), (8, "x" * 200_000), (9, "A")]
ROWS += [(100 + i, "hot") for i in range(300)]


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(-1 if i is None else i)
    return sorted((-1 if i is None else i, max(groups[t or ""]), len(groups[t or ""])) for i, t in rows)


def found(df):
    return sorted((-1 if r.doc_id is None else r.doc_id, -1 if r.keep_id is None else r.keep_id, r.group_size) for r in df.collect())


def test_groups_whatever_the_digest(spark, docs_of, tmp_path):
    path = str(tmp_path / "docs.parquet")
    docs_of(ROWS, "digest FILE content").repartition(3).write.parquet(path)
    out = stream_dedup.dedup(spark, path)
    assert found(out) == brute(ROWS)
    kept = out.where("kept")
    assert kept.count() == len({t or "" for _, t in ROWS}) and kept.where("not (keep_id <=> doc_id)").count() == 0
    assert out.where("text_sha256 = sha2('', 256)").count() == 2
    weak = stream_dedup.dedup(spark, path, digest=lambda t: F.substring(F.sha2(t, 256), 1, 1))  # digests meet: bytes decide
    assert found(weak) == brute(ROWS) and weak.where("kept").count() == kept.count()


def test_state_goes_on_with_new_files(spark, docs_of, tmp_path):
    path, folder = str(tmp_path / "docs.parquet"), str(tmp_path / "state")
    docs_of(ROWS).coalesce(1).write.parquet(path)
    stream_dedup.run_stream(spark, path, folder, files_per_batch=1)
    more = [(5000, "a"), (5001, "new")]
    docs_of(more).coalesce(1).write.mode("append").parquet(path)
    states = stream_dedup.run_stream(spark, path, folder, files_per_batch=1)
    assert found(stream_dedup.resolve(spark.read.parquet(path), states)) == brute(ROWS + more)


def test_empty_table(spark, docs_of, tmp_path):
    path = str(tmp_path / "docs.parquet")
    docs_of([]).write.parquet(path)
    assert stream_dedup.dedup(spark, path).count() == 0
