import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
SF = "/root/testdata/sf0.001"


@pytest.fixture()
def docs(spark):
    """A documents table from texts, its ids counted up from 0, with columns whose names clash with results."""

    def make(texts, ids=None):
        ids = list(range(len(texts))) if ids is None else ids
        rows = [(i, t, "en", "src0", -1, "x", 7, None) for i, t in zip(ids, texts)]
        schema = "doc_id long, text string, lang string, source string, n_chars long, key string, n_removed long, id string"
        return spark.createDataFrame(rows, schema)

    return make


@pytest.fixture()
def sf_dir(tmp_path):
    """Writes tables into a folder like those of the test data."""

    def write(**tables):
        for name, df in tables.items():
            df.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write
