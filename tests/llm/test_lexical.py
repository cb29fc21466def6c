import math
import re
from collections import Counter

import numpy as np
import pytest

from panelspark.llm import lexical
from panelspark.llm.queries import QUERIES
from tests.llm.conftest import SF

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms_of(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    """docs and items: (key, text). Scores every document for every item."""
    found = [(key, Counter(terms_of(text))) for key, text in docs]
    found = [(key, c) for key, c in found if c]
    n, total = len(found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    asked = {}
    for key, text in items:
        asked.setdefault(key, Counter()).update(terms_of(text))
    out = []
    for item, times in asked.items():
        scores = []
        for key, c in found:
            m = 100 - 75 + (75 * sum(c.values()) * n) // total
            score = 0
            for t, q in times.items():
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    score += q * w * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, key is None, key))
        for rank, (s, _, key) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1):
            out.append((item, rank, key, -s))
    return out


def order(r):
    return (r[0] is not None, r[0] or 0, r[1])


def compare(spark, docs_rows, items_rows, **settings):
    docs = spark.createDataFrame(docs_rows, "doc_id long, text string").repartition(4)
    items = spark.createDataFrame(items_rows, "item_id long, text string")
    got = [tuple(r) for r in lexical.ranked(docs, items, **settings).collect()]
    want = brute(docs_rows, items_rows, settings.get("k", 10))
    assert sorted(got, key=order) == sorted(want, key=order)
    return got


def corpus(seed, n=400, vocabulary=60):
    rng = np.random.default_rng(seed)
    words = np.array([f"w{i}" for i in range(vocabulary)])
    p = 1 / np.arange(1, vocabulary + 1)
    return [(i, " ".join(rng.choice(words, rng.integers(0, 60), p=p / p.sum()))) for i in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(lexical, "DOCUMENTS_AT_ONCE", 64)
    compare(spark, corpus(seed), [(i, t) for i, t in corpus(seed + 50, 25)], k=5)


def test_edge_cases(spark):
    docs = [
        (1, "Été été ÉTÉ 漢字-漢字 x_y a1b2"),
        (2, None),
        (3, ""),
        (4, " ,.;"),
        (5, "same text here"),
        (5, "same text here"),
        (6, "same text here"),
        (None, "same text here"),
        (None, None),
        (7, "THE the The " * 5000),
        (8, " x y"),
    ]
    items = [(1, "same text"), (2, "the É été x"), (3, None), (4, "nothing like it"), (5, "漢字 a1b2 y"), (None, "text"), (1, "here here"), (6, "")]
    compare(spark, docs, items)
    compare(spark, docs, items, k=1)


def test_ties_go_by_id(spark):
    got = compare(spark, [(i, "alpha beta") for i in range(50)] + [(100 + i, "gamma") for i in range(70)], [(0, "alpha"), (1, "beta alpha")], k=7)
    assert [r[2] for r in sorted(got)] == [*range(7)] * 2


def test_empty_tables(spark):
    assert compare(spark, [], [(1, "a")]) == []
    assert compare(spark, [(1, "a")], []) == []
    assert compare(spark, [(1, None)], [(1, None)]) == []


def test_blocks_of_items_give_the_same(spark):
    docs, items = corpus(7, 150), [(i, t) for i, t in corpus(8, 30)]
    compare(spark, docs, items, pairs_at_once=40)
    pairs = lexical.item_terms(spark.createDataFrame(items, "item_id long, text string"), "item_id", "text")
    dealt, blocks = lexical.blocks_of(pairs, 40)
    sizes = dealt.groupBy("block").count().collect()
    assert len(blocks) == len(sizes) > 5
    whole = dealt.groupBy("item").agg({"block": "count"}).count()
    assert whole == dealt.select("item", "block").distinct().count()


def test_columns_that_clash(spark):
    docs = spark.createDataFrame([(1, "a b", "x", "y", 3), (2, "b", "x", "y", 3)], "doc_id long, text string, item string, key string, score int")
    items = spark.createDataFrame([(9, "b", 1, 2)], "item_id long, text string, rank int, block int")
    assert [(r.item_id, r.rank, r.doc_id) for r in lexical.ranked(docs, items).collect()] == [(9, 1, 2), (9, 2, 1)]


def test_accumulators_stop_being_opened():
    """A rare term settles the first places, so documents that hold only frequent ones get no accumulator."""
    n = 2000
    term = np.concatenate([np.zeros(12, np.int32), np.ones(n, np.int32)])
    doc = np.concatenate([np.arange(12), np.arange(n)]).astype(np.int32)
    times = np.ones(len(doc), np.int32)
    group = lexical.Group(list(range(n)), np.full(n, 20), doc, term, times, n, 20 * n, 2)
    holding = np.array([12, 1800])
    best = group.best(np.array([0, 1]), lexical.weights(n, holding), holding, 10)
    assert [k for k, _ in best] == list(range(10)) and group.opened == 12
    assert len({s for _, s in best}) == 1
    both = lexical.weights(n, holding).sum() * int(group.adds[0])
    assert best[0][1] == both


def test_query_on_given_tables(spark):
    got = [tuple(r) for r in QUERIES["op13_lexical_search"](spark, SF).collect()]
    docs, items = ([tuple(r) for r in spark.read.parquet(f"{SF}/{t}.parquet").select(k, "text").collect()] for t, k in (("documents", "doc_id"), ("benchmark", "item_id")))
    assert sorted(got) == sorted(brute(docs, items))
