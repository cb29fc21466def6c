import zlib

import pytest
from pyspark.sql import functions as F

from panelspark.llm import quality
from panelspark.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    out = QUERIES["op5_quality_rules"](spark, SF)
    rows = {r.doc_id: r for r in out.collect()}
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    assert len(rows) == documents.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values())
    labels = [(r.quality, rows[r.doc_id]) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()]
    held = [(q, r) for q, r in labels if r.held_out]
    assert len(held) > 80
    assert sum(q == r.predicted for q, r in held) / len(held) > 0.95
    bad = [r for q, r in held if q == 0]
    assert sum(r.predicted == 0 for r in bad) / len(bad) > 0.85


def test_paths_and_compiled_rules(spark):
    tree = """DecisionTreeClassificationModel: depth=2
  If (feature 3 <= 0.5)
   If (feature 1 <= 2.0)
    Predict: 0.0
   Else (feature 1 > 2.0)
    Predict: 1.0
  Else (feature 3 > 0.5)
   Predict: 1.0
"""
    low, high = (3, True, 0.5), (3, False, 0.5)
    found = quality.paths(tree)
    assert found == {(low,), (high,), ((1, True, 2.0), low), ((1, False, 2.0), low)}
    model = quality.Model(-1.0, ((((1, True, 2.0), low), 3.0), ((high,), -2.0)))
    rows = spark.createDataFrame([([0.0, 1.0, 0.0, 0.2],), ([0.0, 3.0, 0.0, 0.2],), ([0.0, 1.0, 0.0, 0.9],)], "stats array<double>")
    got = [r.s for r in rows.select(F.round(F.log(model.score(F.col("stats")) / (1 - model.score(F.col("stats")))), 9).alias("s")).collect()]
    assert got == [2.0, -1.0, -3.0]


TEXTS = ["", None, " \n\t", "A!! B!! C!!", "word " * 30000, "Ein Satz. Noch einer.", "é", "a\n\na"]


@pytest.mark.parametrize("labels", [[], [(0, 1), (1, 1)], [(0, None), (3, 0), (3, 1), (5, 1), (6, 1), (99, 0), (None, 1)]])
def test_odd_texts_and_labels(spark, docs, labels):
    ids = [*range(len(TEXTS) - 1), None]
    table = spark.createDataFrame(labels, "doc_id long, quality int")
    out = quality.scored(docs(TEXTS, ids), table).collect()
    assert len(out) == len(TEXTS) and all(0 <= r.score <= 1 and r.held_out is not None for r in out)
    kept = quality.accepted(docs(TEXTS, ids), table)
    assert kept.columns == docs(TEXTS).columns
    assert kept.count() == sum(r.predicted for r in out)


def test_empty_table(spark, docs):
    assert quality.scored(docs([]), spark.createDataFrame([], "doc_id long, quality int")).count() == 0
