"""SimHash near duplicates by the generalised pigeonhole principle.

1. A 64-bit fingerprint for each document; equal fingerprints count once from here on.
2. Bits that go together are grouped into the same part, by their correlation over all fingerprints.
3. Dynamic programming gives each part its own threshold t (from -1, which leaves a part out), so that the thresholds
   sum to distance - parts + 1 and the estimated number of candidates is least. Any two fingerprints within the distance
   then agree up to t bits in some part.
4. Every fingerprint probes all values within t bits of its own in each part; candidates are verified on all 64 bits.
5. Components of the links.

Defined results: null and empty texts have no words and the fingerprint zero, linked like any other; repeated rows each
get a row; a component whose ids are all null has a null id. Only the named columns are read.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.components import components
from panelspark.llm.tables import stored

BITS = 64
SEED = 42
#: Words hashed at a time, so that the memory of a very long text is bounded.
WORDS_AT_ONCE = 1 << 16
#: Eight counters of one byte each for every value of a byte.
LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view(np.uint64)[:, 0]


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """XXH64 of each run of ``width`` words of the text, A-Z lower-cased; of the whole sequence if there are fewer."""
    words = (text or "").encode().lower().split()
    digest, out = xxhash.xxh64_digest, []
    for at in range(0, max(1, len(words) - width + 1), WORDS_AT_ONCE):
        some = words[at : at + WORDS_AT_ONCE + width - 1]
        if not some:
            break
        joined = b" ".join(some)
        ends = np.cumsum([len(w) + 1 for w in some])
        starts = np.concatenate([[0], ends[:-1]]).tolist()
        ends = (ends - 1).tolist()[width - 1 :] or [len(joined)]
        found = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts, ends)])
        out.append(np.frombuffer(found, ">u8").astype(np.uint64))
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each stretch of ``counts`` hashes, the bits that are set in over half of them."""
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    ends = np.cumsum(counts[full])
    starts = ends - counts[full]
    groups = -(-counts[full] // 255)  # one-byte counters hold 255
    cuts = np.concatenate([s + 255 * np.arange(g) for s, g in zip(starts, groups)])
    lanes = np.add.reduceat(LANES[hashes.view(np.uint8).reshape(-1, 8)], cuts, axis=0)
    sums = lanes.view(np.uint8).reshape(len(cuts), BITS).astype(np.int64)
    sums = np.add.reduceat(sums, np.concatenate([[0], np.cumsum(groups)[:-1]]), axis=0)
    bits = (2 * sums > counts[full][:, None]).astype(np.uint8)
    out[full] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 4) -> DataFrame:
    """Rows (key, fingerprint as a signed long)."""

    def run(batches):
        for batch in batches:
            texts = batch.column("text")
            found, counts, keys = [], [], batch.column("key")
            out, held = [], 0
            for t in texts:
                found.append(shingle_hashes(t.as_py(), width))
                counts.append(len(found[-1]))
                held += counts[-1]
                if held > 1 << 18:
                    out.append(majority(np.concatenate(found), np.array(counts)))
                    found, counts, held = [], [], 0
            if counts:
                out.append(majority(np.concatenate(found), np.array(counts)))
            prints = np.concatenate(out).view(np.int64) if out else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([keys, pa.array(prints)], ["key", "fingerprint"])

    rows = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, fingerprint long").withColumnRenamed("key", key)


def bit_counts(prints: DataFrame) -> tuple[int, np.ndarray]:
    """Over all fingerprints: how many there are, and for every two bits how many have both (4,096 sums)."""

    def run(batches):
        total, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            raw = np.ascontiguousarray(batch.column(0).to_numpy(zero_copy_only=False))
            bits = np.unpackbits(raw.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            for at in range(0, len(bits), 1 << 14):
                total += bits[at : at + (1 << 14)].T @ bits[at : at + (1 << 14)]
            n += len(raw)
        cells = np.append(total.ravel().astype(np.int64), n)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells))), pa.array(cells)], ["cell", "n"])

    sums = prints.select("fingerprint").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    found = np.zeros(BITS * BITS + 1, np.int64)
    for r in sums.collect():
        found[r.cell] = r.n
    return int(found[-1]), found[:-1].reshape(BITS, BITS)


def grouped_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """The bits in parts of nearly equal size: each part starts at the free bit with the strongest ties left and takes
    the free bits that correlate most with those it has."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.outer(p * (1 - p), p * (1 - p)))
    tie = np.abs(both / max(n, 1) - np.outer(p, p)) / np.where(spread > 0, spread, 1)
    np.fill_diagonal(tie, 0)
    free, out = list(range(BITS)), []
    for k in range(parts):
        size = (BITS + parts - 1 - k) // parts
        own = [max(free, key=lambda b: (tie[b, free].sum(), -b))]
        free.remove(own[0])
        while len(own) < size:
            own.append(max(free, key=lambda b: (tie[b, own].sum(), -b)))
            free.remove(own[-1])
        out.append(sorted(own))
    return out


def thresholds(cost: list[list[float]], distance: int) -> list[int]:
    """The cheapest thresholds whose sum is distance - parts + 1; cost[i][t + 1] is that of part i at threshold t."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for own in cost:
        after: dict[int, tuple[float, list[int]]] = {}
        for used, (spent, chosen) in best.items():
            for t, c in enumerate(own, -1):
                total = used + t + 1
                if total <= distance + 1 and (total not in after or spent + c < after[total][0]):
                    after[total] = (spent + c, [*chosen, t])
        best = after
    return best[distance + 1][1]


def allocation(prints: DataFrame, distance: int, parts: int) -> list[tuple[int, int, list[int]]]:
    """For each part that is probed: its mask, its threshold, and the bits.

    Candidates at threshold t are estimated from all fingerprints: the pairs that agree on the whole part are counted,
    and grow with t as they would if the bits differed independently of each other. A probe costs as much as a candidate.
    """
    n, both = bit_counts(prints)
    p = np.diag(both) / max(n, 1)
    groups = grouped_bits(n, both, parts)
    masks = [sum(1 << b for b in own) for own in groups]
    signed = [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]
    cost = []
    for own, mask in zip(groups, signed):
        same = prints.groupBy(F.col("fingerprint").bitwiseAND(F.lit(mask)).alias("v")).agg(F.count("*").cast("double").alias("c"))
        pairs = same.agg(F.sum(F.expr("c * (c - 1) / 2"))).first()[0] or 0.0
        differ = np.zeros(distance + 1)
        differ[0] = 1.0
        for b in own:
            q = 2 * p[b] * (1 - p[b])
            differ = differ * (1 - q) + np.append(0, differ[:-1]) * q
        chance = n * (n - 1) / 2 * np.cumsum(differ)
        lift = max(1.0, pairs / chance[0]) if chance[0] > 0 else 1.0
        probes = np.cumsum([comb(len(own), k) for k in range(distance + 1)]) * n
        cost.append([0.0, *(np.minimum(chance * lift, n * n / 2 + 1) + probes).tolist()])
    return [(m, t, own) for m, t, own in zip(signed, thresholds(cost, distance), groups) if t >= 0]


def links(prints: DataFrame, distance: int = 4, parts: int = 3) -> DataFrame:
    """Rows (a, b), a < b: distinct fingerprints that differ in at most ``distance`` bits, each pair once."""
    plan = allocation(prints, distance, parts)  # thresholds sum to more than -parts, so one at least is probed
    probes, index = None, None
    for k, (mask, t, own) in enumerate(plan):
        flips = [sum(1 << b for b in some) for r in range(t + 1) for some in combinations(own, r)]
        flips = [f - (1 << BITS) if f >> (BITS - 1) else f for f in flips]
        part = F.col("fingerprint").bitwiseAND(F.lit(mask))
        near = F.explode(F.lit(np.array(flips, np.int64))).alias("flip")
        p = prints.select(F.lit(k).alias("part"), F.col("fingerprint").alias("a"), part.alias("v"), near)
        p = p.select("part", "a", F.col("v").bitwiseXOR(F.col("flip")).alias("v"))
        i = prints.select(F.lit(k).alias("part"), F.col("fingerprint").alias("b"), part.alias("v"))
        probes, index = (p, i) if probes is None else (probes.union(p), index.union(i))
    # Spark takes a table with its probes for as small as the table, and would send them all through the driver.
    met = probes.hint("merge").join(index, ["part", "v"]).filter("a < b").filter(F.expr(f"bit_count(a ^ b) <= {int(distance)}"))
    return met.select("a", "b").distinct()


def groups(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 4, distance: int = 4, parts: int = 3) -> DataFrame:
    """Rows (key, fingerprint, component_id): one for each row of the table; component_id is the smallest key reachable
    over links of at most ``distance`` differing bits."""
    prints = stored(fingerprints(df, key, text, width).withColumnRenamed(key, "key"), "fingerprints")
    classes = stored(prints.groupBy("fingerprint").agg(F.min("key").alias("first")), "classes")
    roots = components(links(classes, distance, parts))
    tied = classes.join(roots, F.col("fingerprint") == F.col("node"))
    smallest = tied.groupBy("root").agg(F.min("first").alias("component_id"))
    of_class = roots.join(smallest, "root").select(F.col("node").alias("fingerprint"), "component_id")
    every = classes.join(of_class, "fingerprint", "left").select(
        "fingerprint", F.coalesce("component_id", "first").alias("component_id")
    )
    return prints.join(every, "fingerprint").select(F.col("key").alias(key), "fingerprint", "component_id")


def one_of_each(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 4, distance: int = 4, parts: int = 3) -> DataFrame:
    """The rows of the table, all columns, that represent their component: the smallest key, null last, then the smallest
    digest of the text; rows that are equal in both stay once."""
    whole = F.col(text).cast("string")
    uid = F.md5(F.coalesce(whole, F.lit("")).cast("binary"))
    rows = df.select(F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), uid.alias("uid")).alias("id"), whole.alias("text"))
    found = groups(rows, "id", "text", width, distance, parts).filter(F.col("id") == F.col("component_id"))
    first = found.select("id.key", "id.uid").distinct()
    own = df.select(F.struct("*").alias("row"), uid.alias("uid"), F.col(key).alias("key"))
    kept = own.join(first, (own["uid"] == first["uid"]) & own["key"].eqNullSafe(first["key"]), "left_semi")
    return kept.dropDuplicates(["uid", "key"]).select("row.*")


def hexadecimal(fingerprint) -> F.Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")
