import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text[, lang, source]) tuples."""

    def make(rows, extra=""):
        full = [(*r, *(None,) * (4 - len(r)), None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, "doc_id bigint, text string, lang string, source string, n_chars bigint")
        for c in extra.split():
            df = df.selectExpr("*", f"'x' AS {c}")
        return df

    return make


@pytest.fixture(scope="session")
def sample(spark):
    """Documents of the smallest data as (doc_id, text)."""
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
