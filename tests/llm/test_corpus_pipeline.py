import hashlib
import re

import corpus_pipeline
from panelspark.llm import quality
from tests.llm.test_bpe import REFERENCE
from tests.llm.test_decontam import brute as contaminated
from tests.llm.test_simhash import brute as grouped

SF = "/root/testdata/sf0.001"


def without_repeats(texts, window=corpus_pipeline.REPEAT_BYTES):
    seen, out = {}, []
    for t in texts:
        u = t.encode()
        for i in range(len(u) - window + 1):
            seen[u[i : i + window]] = seen.get(u[i : i + window], 0) + 1
    for t in texts:
        u = t.encode()
        gone = bytearray(len(u))
        for i in range(len(u) - window + 1):
            if seen[u[i : i + window]] > 1:
                gone[i : i + window] = b"\x01" * window
        stretches = [u[m.start() : m.end()] for m in re.finditer(b"\x00+", bytes(gone))]
        out.append("".join(x.decode(errors="ignore") for x in stretches))
    return out


def test_stages_equal_brute_force(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    extra = documents.limit(0)
    for where in (documents, extra):
        assert corpus_pipeline.STAGES[1][1](spark, where, SF).columns == documents.columns
    kept = quality.accepted(documents, spark.read.parquet(f"{SF}/labels.parquet")).select("doc_id", "text").collect()
    assert 0 < len(kept) < documents.count()
    rows = sorted((r.doc_id, r.text) for r in kept)
    first = {d for d, _, c in grouped(*map(list, zip(*rows))) if d == c}
    rows = [(d, t) for d, t in rows if d in first]
    rows = list(zip([d for d, _ in rows], without_repeats([t for _, t in rows])))
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = {r[0] for r in contaminated(rows, items)}
    want = []
    for d, t in rows:
        if d not in bad:
            ids = REFERENCE.encode_ordinary(t)
            want.append((d, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == want


ODD = [(0, None), (1, ""), (2, "x " * 40000), (3, "one two three four five six"), (3, "one two three four five six"), (None, "a b"), (None, "a b"), (4, None)]


def test_odd_rows_and_empty_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, extra int, key string"
    labels = spark.read.parquet(f"{SF}/labels.parquet").schema
    import tempfile

    folder = tempfile.mkdtemp()
    spark.createDataFrame([], labels).write.parquet(f"{folder}/labels.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(d, t, None, None, None, 1, "k") for d, t in ODD], schema).write.parquet(f"{folder}/documents.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    near = corpus_pipeline.STAGES[1][1](spark, docs, folder)
    assert near.columns == docs.columns
    assert sorted(((r.doc_id, r.text and r.text[:3]) for r in near.collect()), key=str) == [(0, None), (2, "x x"), (3, "one"), (None, "a b")]
    for _, stage in corpus_pipeline.STAGES[2:4]:
        assert stage(spark, docs, folder).count() == len(ODD)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), folder).count() == 0
