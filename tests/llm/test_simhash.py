import random

import numpy as np
import pytest
import xxhash

from panelspark.llm import simhash
from panelspark.llm.components import components
from panelspark.llm.queries import QUERIES
from panelspark.llm.tables import stored


def brute(ids, texts, width=4, distance=4):
    prints = []
    for t in texts:
        words = (t or "").encode().lower().split()
        runs = [words[i : i + width] for i in range(max(1, len(words) - width + 1))] if words else []
        hashes = [xxhash.xxh64_intdigest(b" ".join(r), 42) for r in runs]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= distance:
                root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted([(d, f"{p:016x}", least.get(find(i))) for i, (d, p) in enumerate(zip(ids, prints))], key=str)


def corpus(n=120, seed=3):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh É") for _ in range(r.randrange(1, 6))).replace(" ", "x")
    texts = [" ".join(word() for _ in range(r.randrange(1, 300))) for _ in range(n)]
    for t in texts[: n // 2]:
        words = t.split()
        for _ in range(r.randrange(3)):
            words[r.randrange(len(words))] = word()
        texts.append("\n".join(words))
    return [*texts, "", None, "  \t ", "A b", "a B", "a  b", " ", "Z" * 5000, texts[0], texts[0].upper()]


def test_query_equals_brute_force(docs, sf_dir, spark):
    texts = corpus()
    ids = [*range(len(texts) - 2), 3, None]
    out = QUERIES["op1_simhash"](spark, sf_dir(documents=docs(texts, ids)))
    assert sorted(map(tuple, out.collect()), key=str) == brute(ids, texts)


def test_long_texts_are_hashed_in_parts(monkeypatch):
    text = " ".join(map(str, range(1000)))
    whole = simhash.shingle_hashes(text, 4)
    monkeypatch.setattr(simhash, "WORDS_AT_ONCE", 7)
    assert (simhash.shingle_hashes(text, 4) == whole).all() and len(whole) == 997


@pytest.mark.parametrize("parts", [2, 3, 5])
def test_no_pair_is_lost(spark, parts):
    r = random.Random(parts)
    prints = {0, 2**64 - 1}
    for _ in range(60):
        p = r.getrandbits(64) & r.getrandbits(64)
        for _ in range(6):
            prints.add(p)
            for _ in range(r.randrange(4)):
                p ^= 1 << r.randrange(64)
    signed = sorted(np.array(sorted(prints), np.uint64).view(np.int64).tolist())
    found = simhash.links(spark.createDataFrame([(x,) for x in signed], "fingerprint long"), 4, parts)
    want = {(a, b) for a in signed for b in signed if a < b and bin((a ^ b) & (2**64 - 1)).count("1") <= 4}
    assert set(map(tuple, found.collect())) == want and want


def test_thresholds_are_the_cheapest():
    cost = [[0, 1, 50, 900], [0, 5, 9, 10], [0, 2, 40, 800]]
    best = simhash.thresholds(cost, 3)
    assert sum(best) == 3 - 3 + 1
    every = [(a, b, c) for a in range(-1, 3) for b in range(-1, 3) for c in range(-1, 3) if a + b + c == 1]
    price = lambda t: sum(own[x + 1] for own, x in zip(cost, t))
    assert price(best) == min(map(price, every))


def test_correlated_bits_share_a_part():
    r = np.random.default_rng(1)
    bits = r.integers(0, 2, (4000, 64))
    bits[:, 40] = bits[:, 3]
    bits[:, 63] = bits[:, 3]
    own = simhash.grouped_bits(len(bits), bits.T @ bits, 3)
    assert sorted(b for g in own for b in g) == list(range(64))
    assert any({3, 40, 63} <= set(g) for g in own)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, x) for x in range(101, 140)] + [(7, 7), (200, 199)]
    out = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert out == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 140)}, 199: 199, 200: 199}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_columns_that_clash(docs):
    df = docs(["one two three four five", "one two three four five", "quite another text than this one"])
    for name in ("uid", "__uid", "row", "component_id", "fingerprint"):
        df = df.withColumn(name, df.text)
    kept = simhash.one_of_each(df, width=4, distance=4)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [0, 2]


def test_empty_table(docs):
    assert simhash.groups(docs([])).count() == 0


def test_probes_are_not_sent_through_the_driver(spark):
    """Small files have many probes, which Spark's estimate leaves out."""
    r = random.Random(7)
    prints = stored(spark.createDataFrame([(r.getrandbits(63),) for _ in range(300)], "fingerprint long"))
    plan = simhash.links(prints)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
