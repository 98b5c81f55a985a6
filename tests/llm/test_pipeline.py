import os
import sys

import pytest
from conftest import SF

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402

COLUMNS = sorted(corpus_pipeline.COLUMNS)


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert sorted(docs.columns) == COLUMNS, name
        assert name == "source_mixing" or 0.7 * before < docs.count() <= before
        before = docs.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.count() == before and {"doc_id", "shard", "text"} <= set(last.columns)


@pytest.mark.parametrize("at", range(len(corpus_pipeline.STAGES)))
def test_stage_on_odd_rows(spark, docs_of, at):
    name, stage = corpus_pipeline.STAGES[at]
    rows = [(1, None), (2, ""), (None, "x"), (3, "same"), (3, "same"), (4, "word " * 60_000, "en", "s")]
    out = stage(spark, docs_of(rows, "score shard SIZE fp"), SF)
    assert out.count() >= 1 or name == "source_mixing"
    assert stage(spark, docs_of([]), SF).count() == 0


def test_registered():
    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
