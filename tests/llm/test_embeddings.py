import numpy as np
import pyarrow as pa
import pytest

from panelspark.llm import embeddings
from panelspark.llm.queries import QUERIES


def brute(ids, vectors, least=0.9):
    def unit(v):
        if not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v, np.float64) / max(abs(x) for x in v)
        return v / np.sqrt((v * v).sum())

    units = [unit(v) for v in vectors]
    near = [
        [j for j, w in enumerate(units) if j != i and v is not None and w is not None and len(v) == len(w) and v @ w >= least]
        for i, v in enumerate(units)
    ]
    out = []
    for i in range(len(ids)):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        first = min((ids[j] for j in seen if ids[j] is not None), default=None)
        out.append((ids[i], len(near[i]), first, ids[i] == first))
    return sorted(out, key=str)


def vectors(n=300, dim=16, seed=1):
    r = np.random.default_rng(seed)
    base = r.standard_normal((n, dim))
    near = np.repeat(base[:40], 5, axis=0) + 0.05 * r.standard_normal((200, dim))
    hot = base[0] + 0.03 * r.standard_normal((150, dim))
    turn = np.linspace(0, 2, 60)[:, None]  # a chain in which only neighbours link
    arc = np.cos(turn) * base[1] / np.linalg.norm(base[1]) + np.sin(turn) * np.eye(dim)[0]
    return np.concatenate([base, near, hot, base[:3], arc]).astype(np.float32).tolist()


ODD = [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] * 16, [None] + [1.0] * 15, [1.0, 2.0], [2.0, 4.0], [1e-30] * 16, [1e30] * 16]


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, 0, "x", 1) for i, v in rows], f"vec_id long, embedding array<{kind}>, label int, class string, n long")


@pytest.mark.parametrize("kind", ["float", "double"])
def test_query_equals_brute_force(spark, sf_dir, kind):
    rows = list(enumerate([*vectors(), *ODD]))
    rows += [rows[5], (None, rows[7][1])]
    out = QUERIES["op4_embedding_neighbours"](spark, sf_dir(embeddings=frame(spark, rows, kind)))
    assert sorted(map(tuple, out.collect()), key=str) == brute(*map(list, zip(*rows)))


def test_small_blocks_and_borders_lose_nothing(spark):
    rows = list(enumerate(vectors(60)))
    out = embeddings.near_duplicates(frame(spark, rows), window=20, block=8, component_block=16)
    assert sorted(map(tuple, out.collect()), key=str) == brute(*map(list, zip(*rows)))


def test_empty_table(spark):
    assert embeddings.near_duplicates(frame(spark, [])).count() == 0


def lone_pairs(n, pairs, cosine=0.9, dim=64, seed=3):
    """Evenly spread unit vectors; those with the first ids divisible by 100 have a partner at the cosine, at the end."""
    r = np.random.default_rng(seed)
    base = r.standard_normal((n - pairs, dim))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    one = base[: 100 * pairs : 100]
    side = r.standard_normal((pairs, dim))
    side -= (side * one).sum(axis=1, keepdims=True) * one
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    cosine += 1e-6  # rounding to single precision leaves it above
    return np.concatenate([base, cosine * one + np.sqrt(1 - cosine**2) * side]).astype(np.float32)


def test_passes_follow_the_number_of_classes():
    many = [embeddings.passes_for(n, 0.9, embeddings.WINDOW) for n in (0, 600, 20_000, 100_000, 400_000, 2_000_000)]
    assert many[:2] == [embeddings.PASSES] * 2 and many == sorted(many) and len(set(many[2:])) == 4


def test_recall_at_100_000_vectors(spark):
    all_vectors = lone_pairs(100_000, 900)
    rows = pa.table({"vec_id": pa.array(np.arange(len(all_vectors))), "embedding": pa.FixedSizeListArray.from_arrays(pa.array(all_vectors.ravel()), 64).cast(pa.list_(pa.float32()))})
    out = embeddings.near_duplicates(spark.createDataFrame(rows)).filter("vec_id % 100 = 0").select("vec_id", "n_links")
    found = dict(map(tuple, out.collect()))
    exact = embeddings.unit(all_vectors.astype(np.float64))
    queries = np.arange(0, len(exact), 100)
    links = (exact[queries] @ exact.T >= 0.9).sum(axis=1) - 1
    recall = sum(found[i] for i in queries.tolist()) / links.sum()
    print(f"recall at 100,000 vectors: {recall:.4f} of {links.sum()} links")
    assert links.sum() >= 900 and recall >= 0.97
