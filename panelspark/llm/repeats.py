"""Windows of text that occur more than once: what the two substring operators share.

A window is a run of W symbols (bytes or words) of one text. Sorting every suffix of a corpus would move W symbols for
each symbol, so suffixes are sampled by content: the anchor of a window is the gram of k symbols in it whose hash is
least (the leftmost of equals). Equal windows have their anchors at the same offset, so two windows can only be equal if
their anchors' grams are; and neighbouring windows mostly share an anchor, so there is one about every (W - k + 2) / 2
symbols. An anchor p stands for the windows that start in [a, b]; its context is the symbols [a, b + W).

1. Equal texts count once. If such a text has a window, each of its windows occurs elsewhere.
2. Anchors of all texts; grams that occur once drop out, and with them most of the corpus.
3. The contexts of the others, grouped by gram, go to a solver that finds the equal windows of a group exactly.
4. A gram that occurs very often is split: its windows are dealt to blocks of neighbouring offsets, whose common core is
   longer than the gram and takes its place. Equal contexts are joined into one before. Blocks shrink until groups are
   small; at blocks of one window the core is the window and counting is enough. So no task gets an unbounded group.

Everything that is needed twice is a table in the shared folder. Texts are stored by hash of their digest, so that later
joins move only anchors and spans.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.bpe import parts
from panelspark.llm.tables import released, stored
from panelspark.session import scratch_table

#: Contexts of one key that a task may hold; more are split.
GROUP = 4096
#: Window starts handled at a time, so that the memory of a very long text is bounded.
STARTS_AT_ONCE = 1 << 18
#: Bytes of contexts after which a task hands on a batch or solves what it holds.
BATCH_BYTES = 4 << 20
SOLVE_BYTES = 8 << 20

_random = np.random.default_rng(20)
BYTE_CODES = _random.integers(0, 1 << 64, 256, dtype=np.uint64)
FACTOR = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(FACTOR), -1, 1 << 64))
with np.errstate(over="ignore"):
    _length = STARTS_AT_ONCE + (1 << 12)
    POWERS = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(_length, FACTOR)]))
    INVERSES = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(_length, INVERSE)]))


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def run_hashes(codes: np.ndarray, length: int) -> np.ndarray:
    """A hash of each run of ``length`` codes (at most len(POWERS) codes)."""
    n = len(codes)
    if n < length:
        return np.empty(0, np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(codes * POWERS[:n], out=sums[1:])
    return mixed((sums[length:] - sums[:-length]) * INVERSES[: n - length + 1])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each run of ``width`` values."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[: n - width + 1], before[width - 1 : n])


@dataclass(frozen=True)
class Symbols:
    """What a text is made of, the window, the gram, and the sizes of the blocks that split frequent grams."""

    window: int
    gram: int
    blocks: tuple[int, ...]
    words: bool

    def of(self, data: bytes):
        return data.split() if self.words else data

    def codes(self, symbols) -> np.ndarray:
        if self.words:
            return np.fromiter(map(xxhash.xxh64_intdigest, symbols), np.uint64, len(symbols))
        return BYTE_CODES[np.frombuffer(symbols, np.uint8)]

    def joined(self, symbols) -> bytes:
        return b" ".join(symbols) if self.words else bytes(symbols)

    def anchors(self, data: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(hash, p, a, b) of the anchors of a text, in parts."""
        symbols = self.of(data)
        reach = self.window - self.gram + 1
        for at in range(0, len(symbols) - self.window + 1, STARTS_AT_ONCE):
            grams = run_hashes(self.codes(symbols[at : at + STARTS_AT_ONCE + self.window - 1]), self.gram)
            order = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
            p = (sliding_min(order, reach) & np.uint64(0xFFFFFFFF)).astype(np.int64)
            a = np.concatenate([[0], np.flatnonzero(np.diff(p)) + 1])
            b = np.concatenate([a[1:] - 1, [len(p) - 1]])
            yield grams[p[a]].view(np.int64), p[a] + at, a + at, b + at


def texts_of(df: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(key, uid, n_bytes, sha256) for every row; and (uid, data, copies) for each different text, stored by uid."""
    spark = df.sparkSession
    data = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    rows = df.select(F.col(key).alias("key"), data.alias("data")).withColumn("uid", F.unhex(F.md5("data")))
    marks = stored(rows.select("key", "uid", F.length("data").cast("long").alias("n_bytes"), F.sha2("data", 256).alias("sha256")), "marks")
    copies = marks.groupBy("uid").agg(F.min("key").alias("first"), F.count("*").alias("copies"))
    one = rows.join(copies.withColumnRenamed("uid", "u"), (F.col("uid") == F.col("u")) & F.col("key").eqNullSafe(F.col("first")))
    one = one.dropDuplicates(["uid"])  # rows that are equal in key and text
    name, path = scratch_table(spark, "texts")
    buckets = min(100_000, int(spark.conf.get("spark.sql.shuffle.partitions")))  # Spark has no more
    writer = one.select("uid", "data", "copies").write.format("parquet").bucketBy(buckets, "uid").sortBy("uid")
    writer.option("path", path).saveAsTable(name)
    return marks, spark.table(name)


def anchors_of(texts: DataFrame, symbols: Symbols) -> DataFrame:
    """(uid, h, p, a, b, n) of the anchors whose gram occurs more than once, n times."""

    def run(batches):
        for batch in batches:
            rows, parts, held = [], [], 0
            for i, data in enumerate(batch.column("data")):
                for part in symbols.anchors(data.as_py()):
                    rows.append(np.full(len(part[0]), i))
                    parts.append(part)
                    held += len(part[0])
                if held > 100_000:
                    yield anchor_rows(batch, rows, parts)
                    rows, parts, held = [], [], 0
            if rows:
                yield anchor_rows(batch, rows, parts)

    def anchor_rows(batch, rows, parts):
        uids = batch.column("uid").take(pa.array(np.concatenate(rows)))
        h, p, a, b = (np.concatenate(c) for c in zip(*parts))
        back, on = (p - a).astype(np.int32), (b - p).astype(np.int32)
        return pa.RecordBatch.from_arrays([uids, pa.array(h), pa.array(p), pa.array(back), pa.array(on)], ["uid", "h", "p", "back", "on"])

    found = stored(texts.select("uid", "data").mapInArrow(run, "uid binary, h long, p long, back int, on int"), "anchors")
    # Written first: a join of two shuffled tables may split a hot gram, one with an aggregate may not.
    counts = stored(found.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1"), "grams")
    out = stored(found.join(counts, "h").select("uid", "h", "p", (F.col("p") - F.col("back")).alias("a"), (F.col("p") + F.col("on")).alias("b"), "n"), "anchors")
    released(found, counts)
    return out


CONTEXT = "key binary, uid binary, p long, a long, b long, context binary, solved boolean"
NAMES = ["key", "uid", "p", "a", "b", "context", "solved"]
KINDS = [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.bool_()]


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 64 + len(row[5] or b"")
        if size > BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), KINDS)], NAMES)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), KINDS)], NAMES)


def contexts_of(texts: DataFrame, anchors: DataFrame, symbols: Symbols) -> DataFrame:
    """The contexts of the anchors. Of equal contexts in one text the first is kept as solved; the others are rows
    without context, solved too."""

    def rows(batches):
        for batch in batches:
            for uid, data, own in zip(*(batch.column(c) for c in ("uid", "data", "own"))):
                uid, units, seen, first = uid.as_py(), symbols.of(data.as_py()), {}, {}
                for x in own.as_py():
                    context = symbols.joined(units[x["a"] : x["b"] + symbols.window])
                    same = (x["h"], x["p"] - x["a"], context)
                    seen[same] = seen.get(same, 0) + 1
                    if seen[same] == 1:
                        first[same] = x
                    else:
                        yield None, uid, x["p"], x["a"], x["b"], None, True
                for (h, _, context), x in first.items():
                    count = seen[h, x["p"] - x["a"], context]
                    yield h.to_bytes(8, "little", signed=True), uid, x["p"], x["a"], x["b"], context, count > 1

    lists = anchors.groupBy("uid").agg(F.collect_list(F.struct("h", "p", "a", "b")).alias("own"))
    return texts.select("uid", "data").join(lists, "uid").mapInArrow(lambda batches: _batches(rows(batches)), CONTEXT)


#: Takes the contexts of whole groups, the offsets of their anchors and their numbers of windows; marks the windows that
#: occur in another place, as one array of 0 and 1 for each context.
Solver = Callable[[list[bytes], np.ndarray, np.ndarray], list[np.ndarray]]


def split_rows(rows: DataFrame, symbols: Symbols, block: int) -> DataFrame:
    """Each context cut into blocks of ``block`` offsets, with the core of the block as the key."""

    def cut(batches):
        for batch in (part for whole in batches for part in parts(whole, "context", BATCH_BYTES)):
            for r in batch.to_pylist():
                units, p, a, b = symbols.of(r["context"]), r["p"], r["a"], r["b"]
                for k in range((a - p) // block, (b - p) // block + 1):
                    low, high = p + k * block, p + k * block + block - 1
                    start, end = max(a, low), min(b, high)
                    core = symbols.joined(units[high - a : low + symbols.window - a])
                    key = hashlib.blake2b(core, digest_size=16, salt=(k % (1 << 32)).to_bytes(4, "little")).digest()
                    yield key, r["uid"], p, start, end, symbols.joined(units[start - a : end + symbols.window - a]), r["solved"]

    return rows.mapInArrow(lambda batches: _batches(cut(batches)), CONTEXT)


def one_of_each(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of rows with equal key and context: (uid, a, b) of all that have others, and one of each, solved if it has."""
    rows = rows.withColumn("same", F.md5("context")).withColumn("back", F.col("p") - F.col("a"))
    by = ["key", "back", "same"]
    classes = rows.groupBy(*by).agg(F.count("*").alias("n"), F.min(F.struct("uid", "p", "a")).alias("first"))
    met = rows.join(classes, by)
    is_first = (F.col("first.uid") == F.col("uid")) & (F.col("first.p") == F.col("p")) & (F.col("first.a") == F.col("a"))
    met = stored(met.withColumn("is_first", is_first), "classes")
    kept = met.filter("is_first").withColumn("solved", F.col("solved") | (F.col("n") > 1))
    return met.filter("n > 1").select("uid", "a", "b"), kept.select(*NAMES)


def repeated_windows(texts: DataFrame, symbols: Symbols, place: Callable[[DataFrame], DataFrame], solver: Solver, group: int = GROUP) -> DataFrame:
    """(uid, a, b): ranges of starts of windows that also start elsewhere.

    ``place`` partitions contexts so that equal keys meet, in order; ``solver`` takes the contexts of whole groups, the
    offsets of their anchors and their numbers of windows, and marks the windows that occur in another place.
    """
    anchors = anchors_of(texts, symbols)
    few = contexts_of(texts, anchors.filter(F.col("n") <= group), symbols)
    parts = [solve_all(few, symbols, place, solver)]
    many = anchors.filter(F.col("n") > group)
    if not many.isEmpty():
        rows = stored(contexts_of(texts, many, symbols), "frequent")
        parts.append(rows.filter("solved").select("uid", "a", "b"))
        rows = rows.filter("context is not null")
        for block in symbols.blocks:
            equal, rows = one_of_each(rows)
            parts.append(equal)
            rows = stored(split_rows(rows, symbols, block), "blocks")
            counts = stored(rows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "cores")
            rows = stored(rows.join(counts, "key").select(*NAMES, "n"), "blocks")
            parts.append(solve_all(rows.filter(F.col("n") <= group).select(*NAMES), symbols, place, solver))
            rows = rows.filter(F.col("n") > group).select(*NAMES)
            if rows.isEmpty():
                break
        else:
            parts.append(rows.select("uid", "a", "b"))  # blocks of one window: rows of one key are equal windows
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def solve_all(contexts: DataFrame, symbols: Symbols, place, solver: Solver) -> DataFrame:
    """Solves every group of the contexts; rows without context pass as ranges already solved."""
    rows = place(contexts.withColumn("key", F.coalesce("key", F.substring("uid", 1, 8))))

    def run(batches):
        held, size = [], 0
        for batch in (part for whole in batches for part in parts(whole, "context", BATCH_BYTES)):
            done = []
            for r in batch.to_pylist():
                if r["solved"]:
                    done.append((r["uid"], r["a"], r["b"]))
                if r["context"] is None:
                    continue
                if size > SOLVE_BYTES and r["key"] != held[-1]["key"]:
                    done += _solve(held, solver)
                    held, size = [], 0
                held.append(r)
                size += len(r["context"])
            if done:
                yield _ranges(done)
        if held:
            yield _ranges(_solve(held, solver))

    return rows.mapInArrow(run, "uid binary, a long, b long")


def _ranges(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else ((), (), ())
    kinds = (pa.binary(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["uid", "a", "b"])


def _solve(held: list[dict], solver: Solver) -> list[tuple]:
    a = np.array([r["a"] for r in held])
    p, counts = np.array([r["p"] for r in held]) - a, np.array([r["b"] for r in held]) - a + 1
    out = []
    for r, flags in zip(held, solver([r["context"] for r in held], p, counts)):
        if not r["solved"]:
            edges = np.flatnonzero(np.diff(np.concatenate([[0], flags, [0]])))
            out += [(r["uid"], r["a"] + int(s), r["a"] + int(e) - 1) for s, e in zip(edges[::2], edges[1::2])]
    return out


def merged(ranges: list, window: int) -> list[tuple[int, int]]:
    """Symbols [start, end) covered by the windows that start in the ranges, as maximal runs."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((r["a"], r["b"]) for r in ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b + window))
        else:
            out.append((a, b + window))
    return out


def removed(
    df: DataFrame,
    symbols: Symbols,
    place: Callable[[DataFrame], DataFrame],
    solver: Solver,
    key: str = "doc_id",
    text: str = "text",
    group: int = GROUP,
) -> tuple[DataFrame, DataFrame]:
    """(key, uid, n_bytes, sha256) for every row, and (uid, kept, n_symbols, n_removed, spans) for each different text
    that has something removed or several copies; spans are in symbols, kept is the rest."""
    marks, texts = texts_of(df, key, text)
    ranges = repeated_windows(texts, symbols, place, solver, group)
    lists = ranges.groupBy("uid").agg(F.collect_list(F.struct("a", "b")).alias("ranges"))

    def run(batches):
        for batch in batches:
            rows, size = [], 0
            for uid, data, copies, own in zip(*(batch.column(c) for c in ("uid", "data", "copies", "ranges"))):
                units = symbols.of(data.as_py())
                spans = merged(own.as_py() or [], symbols.window)
                if copies.as_py() > 1 and len(units) >= symbols.window:
                    spans = [(0, len(units))]
                cuts = [0, *(x for s in spans for x in s), len(units)]
                pieces = [units[s:e] for s, e in zip(cuts[::2], cuts[1::2])]
                kept = b" ".join(w for p in pieces for w in p) if symbols.words else b"".join(pieces)
                rows.append((uid.as_py(), kept, len(units), sum(e - s for s, e in spans), [{"start": s, "end": e} for s, e in spans]))
                size += len(kept)
                if size > BATCH_BYTES:
                    yield _texts(rows)
                    rows, size = [], 0
            if rows:
                yield _texts(rows)

    out = texts.join(lists, "uid", "left").filter(F.lit(symbols.words) | F.col("ranges").isNotNull() | (F.col("copies") > 1))
    schema = "uid binary, kept binary, n_symbols long, n_removed long, spans array<struct<start: long, end: long>>"
    return marks, out.mapInArrow(run, schema)


def _texts(rows: list[tuple]) -> pa.RecordBatch:
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    kinds = (pa.binary(), pa.binary(), pa.int64(), pa.int64(), span)
    names = ["uid", "kept", "n_symbols", "n_removed", "spans"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
