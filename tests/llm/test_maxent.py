import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelspark.llm import maxent
from panelspark.llm.queries import QUERIES
from tests.llm.conftest import SF

SMALL = maxent.Settings(first=4, second=4, rows=1 << 10, slices=8, rounds=2, batch=64, tokens_per_task=2000)


def words_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    word, out = "", []
    for c in lowered:
        if c in " \t\n\x0b\x0c\r":
            out += [word] if word else []
            word = ""
        else:
            word += c
    return out + ([word] if word else []) + ["\n"]


def is_held(key):
    return key is not None and zlib.crc32(str(key).encode()) % 5 == 1


def brute(rows):
    """{row number: (held_out, n_tokens, n_known, train_tokens, base_score)}"""
    counts = Counter(w for key, text in rows if not is_held(key) for w in words_of(text))
    n, v = sum(counts.values()), len(counts)
    out = []
    for key, text in rows:
        words = words_of(text)
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        out.append((key, is_held(key), len(words), sum(counts[w] > 0 for w in words), n, base))
    return out


def same(got, want):
    order = lambda r: (r[0] is not None, r[0] or 0, r[2], r[5])
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=order), sorted(want, key=order)):
        assert tuple(g)[:5] == w[:5] and g.base_score == pytest.approx(w[5], abs=1e-9)


TEXTS = [
    "The cat sat on the mat .",
    "the CAT ran\x0bto\x0cthe\rmat",
    "",
    None,
    "  \t\n ",
    "unseen\x1cword É é x y  z 漢字 漢字",
    "a " * 3000,
    "wörter und Wörter\x00mit null",
    "tie tie tie",
    "tie tie tie",
]


def test_counts_and_base_scores(spark, docs):
    texts = TEXTS * 3
    got = maxent.scored(docs(texts).repartition(5), settings=SMALL).collect()
    same(got, brute(list(enumerate(texts))))


def test_null_and_repeated_keys(spark, docs):
    keys = [None, None, 3, 3, 8, 12, 15, 19, 20, 21]
    got = maxent.scored(docs(TEXTS, keys).repartition(3), settings=SMALL).collect()
    same(got, brute(list(zip(keys, TEXTS))))


def test_empty_table_and_nothing_to_learn_from(spark, docs):
    assert maxent.scored(docs([]), settings=SMALL).collect() == []
    held = [k for k in range(60) if is_held(k)]
    got = maxent.scored(docs(["some words", None][: len(held)], held[:2]), settings=SMALL).collect()
    assert [(r.n_known, r.train_tokens, r.base_score, r.score) for r in got] == [(0, 0, 0.0, 0.0)] * 2


def test_probabilities_add_up_after_every_history(spark, docs):
    texts = [f"w{i % 7} x{i % 5} the the y{i % 11}z w{i % 3}" for i in range(120)]
    df = docs(texts).select(F.col("doc_id").alias("key"), "text", maxent.held_out(F.col("doc_id")).alias("held"))
    made = maxent.stored(maxent.blocks(df, SMALL), "blocks")
    words = maxent.stored(maxent.lexicon(made), "words")
    known = words.filter("first and n > 0")
    counts = {bytes(r.word): r.n for r in known.collect()}
    n, v = sum(counts.values()), len(counts)
    found = maxent.leaves(known.select("word", (F.col("n") + 0.5).alias("mass")), n + v / 2, SMALL)
    assert found.mass.sum() == pytest.approx(n + v / 2 + 0.5 * len(found.cut_leaf))
    assert len(found.alone) <= SMALL.leaves // 2 and len(found.alone) + len(found.cut_leaf) <= SMALL.leaves
    tokens = maxent.stored(maxent.ready(made, words, found, n, v, "bigint"), "tokens")
    weights = maxent.trained(tokens, found.mass, n, SMALL)
    assert np.abs(weights.first).sum() > 0 and weights.first_hits.sum() == 3 * n and weights.second_hits.sum() == 2 * n
    model = maxent.Model(weights, found.mass, SMALL)
    for history in (["the"], ["w1", "x1"], ["the", "the"], []):
        total = 0.0
        outcomes = [(found.of(w), c + 0.5) for w, c in counts.items()] + [(leaf, 0.5) for leaf in found.cut_leaf]
        for leaf, mass in outcomes:
            codes = np.array([found.of(w.encode()) for w in history] + [leaf], np.uint16)
            hashes = np.array([maxent.crc32(w.encode()) & 0xFFFF for w in history] + [0], np.uint16)
            p = 10 ** model.log10(hashes, codes, np.array([len(codes)]))[-1]
            total += p * mass / found.mass[leaf]
        assert total == pytest.approx(1.0, abs=1e-4)


def test_scores_do_not_depend_on_the_place_of_a_document(spark, docs):
    """With weights and leaves given, tokens of other documents are no history."""
    rng = np.random.default_rng(3)
    sizes = np.array([5, 1, 1, 2, 9, 3])
    n = int(sizes.sum())
    hashes, codes = rng.integers(0, 1 << 16, n).astype(np.uint16), rng.integers(0, 16, n).astype(np.uint16)
    weights = maxent.Weights.none(SMALL)
    weights.first += rng.normal(size=weights.first.shape)
    weights.second += rng.normal(size=weights.second.shape)
    model = maxent.Model(weights, np.ones(16), SMALL)
    whole, at = model.log10(hashes, codes, sizes), 0
    for size in sizes:
        one = slice(at, at + size)
        assert np.allclose(whole[one], model.log10(hashes[one], codes[one], np.array([size])))
        at += size


def test_gradient_against_differences():
    """A step moves weights along the slope of the log-likelihood of a batch."""
    rng = np.random.default_rng(5)
    weights = rng.normal(size=(6, 4)).astype(np.float32)
    fired, target = [np.array([0, 1, 1]), np.array([3, 4, 3])], np.array([2, 0, 3])
    mass = np.log(np.array([0.1, 0.2, 0.3, 0.4], np.float32))
    value = lambda w: np.log(maxent.Model.shares(w, fired, mass)[np.arange(3), target].astype(np.float64)).sum()
    model = maxent.Model(maxent.Weights.none(SMALL), np.ones(16), SMALL)
    moved, hits = weights.copy(), np.zeros(6)
    model.step(moved, hits, fired, maxent.Model.shares(moved, fired, mass), target)
    assert hits.tolist() == [1, 2, 0, 2, 1, 0]
    for row in (0, 1, 3, 4):
        for column in range(4):
            up, down = weights.copy(), weights.copy()
            up[row, column] += 1e-2
            down[row, column] -= 1e-2
            slope = (value(up) - value(down)) / 2e-2
            assert (moved - weights)[row, column] == pytest.approx(SMALL.rate * slope / math.sqrt(hits[row]), abs=2e-3)


def test_packed_round_trip():
    values = np.random.default_rng(1).integers(0, 1 << 32, 1000).astype(np.uint32)
    assert (maxent.unpacked(maxent.packed(values), np.uint32, 1000) == values).all()
    assert len(maxent.unpacked(maxent.packed(values[:0]), np.uint32, 0)) == 0


def test_query_on_given_documents(spark):
    """Counts and base scores as by brute force; held-out texts are likelier under the model than under the counts."""
    got = QUERIES["op12_maxent"](spark, SF).collect()
    given = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    same(got, brute([tuple(r) for r in given]))
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
