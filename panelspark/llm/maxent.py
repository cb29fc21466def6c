"""Language-model scoring by a hashed maximum-entropy model with a class-factored softmax.

P(word | history) = P(class | history) * P(leaf | class, history) * P(word | leaf). The first two are softmaxes over sums
of hashed weights on top of the training masses; the features of a history are the pair of words before (n-gram), the
leaf of the word before, and the leaf of the word before that (skip). The third is the share of the word's mass c + 0.5 in its leaf.

1. Documents are cut into words in blocks of bounded size, in Arrow; a block keeps its different words and one number for
   each token. Only the different words of the blocks are shuffled, to be counted and to get their counts.
2. Leaves: a word with twice a leaf's share of all mass is a leaf by itself (so at most half of them are); the others
   are sorted by their last letters and cut into leaves of equal mass, by one range partitioning and running sums. Sorted
   by last letters, some ``second`` leaves each make a class. What a task needs of it is bounded by the number of leaves.
   Words unseen in training fall into the leaf of their ending, where together they weigh 0.5. So the probabilities of all
   training words and of an unseen word in each cut leaf add up to 1 after every history.
3. Training is one pass over all training tokens in ``rounds`` parts. In a round every task starts from the common
   weights and updates its own by gradients of batches of tokens; rows of weights are then averaged over the
   tasks, each by the number of times it fired there, in a shuffle. Weights have a fixed size, whatever the corpus.
4. Every block is scored in numpy batches: gather the rows of weights that fire, add, exponentiate.

Defined results: null texts are empty and consist of the end alone; rows with a null id train; repeated rows count and
are scored each; without training texts every token has probability 1 in base and model; other columns are left behind.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm.bpe import parts
from panelspark.llm.tables import released, stored

#: Bytes of text in a block, whose words are counted together, and in one of its pieces, which are handled one by one; a
#: longer document is a piece by itself.
BLOCK_BYTES = 8 << 20
PIECE_BYTES = 1 << 20
#: The end of a document as a word; no word holds a blank.
END = b"\n"


@dataclass(frozen=True)
class Settings:
    """Sizes and steps of the model. ``rows`` is a power of two: hashed rows of weights of each factor."""

    first: int = 32
    second: int = 32
    rows: int = 1 << 16
    rounds: int = 2
    rate: float = 0.5
    batch: int = 4096
    tokens_per_task: int = 1 << 22
    slices: int = 64  # in which weights are averaged

    @property
    def leaves(self) -> int:
        return self.first * self.second


def packed(values: np.ndarray) -> bytes:
    """An array in compressed planes of bytes."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T)
    return pa.Codec("zstd", 1).compress(planes.tobytes(), asbytes=True)


def unpacked(data: bytes, kind: type, n: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = pa.Codec("zstd", 1).decompress(data, n * size, asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(size, n).T).view(kind).ravel()


def sealed(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def opened(data: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(data).read_next_batch()


def held_out(key: Column) -> Column:
    """Whether the row is kept from training: crc32 of the id as text leaves 1 when divided by 5."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 1, F.lit(False))


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(numbers, words, sizes): for each token the number of its word, and for each text its tokens. Lower-cases A-Z; each
    text ends with END, whose number is 0. Texts are split a piece at a time, so that little is held beside the result."""
    chunks, sizes = [], [np.empty(0, np.int64)]
    for batch in parts(pa.RecordBatch.from_arrays([texts], ["text"]), "text", PIECE_BYTES):
        split = pc.ascii_split_whitespace(pc.ascii_lower(batch.column(0)))
        words = split.flatten()
        text = np.repeat(np.arange(batch.num_rows, dtype=np.int32), np.diff(split.offsets.to_numpy()))
        full = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
        chunks.append(words.filter(pa.array(full)).dictionary_encode())
        sizes.append(np.bincount(text[full], minlength=batch.num_rows) + 1)
    chunks = pa.chunked_array(chunks, pa.dictionary(pa.int32(), pa.string())).unify_dictionaries().chunks
    sizes = np.concatenate(sizes)
    ends = np.cumsum(sizes) - 1
    inside = np.ones(int(sizes.sum()), bool)
    inside[ends] = False
    numbers = np.zeros(len(inside), np.int32)
    if chunks:
        numbers[inside] = np.concatenate([c.indices.to_numpy(zero_copy_only=False) for c in chunks]) + 1
    known = [chunks[0].dictionary.cast(pa.binary())] if chunks else []
    return numbers, pa.concat_arrays([pa.array([END], pa.binary()), *known]), sizes


def blocks(docs: DataFrame, settings: Settings) -> DataFrame:
    """Blocks of documents in pieces, each one sealed batch: their keys, which of them train, their sizes, and the numbers of
    their tokens' words, frequent words first; the first piece has the words of the block and how often each occurs
    in training. Spark sees no long arrays: it would measure them anew with every row that it hands to Python."""
    names = ["part", "keys", "train", "sizes", "numbers", "words", "counts"]
    kinds = [pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64())]

    def run(batches):
        at = TaskContext.get().partitionId() << 32
        for batch in (part for whole in batches for part in parts(whole, "text", BLOCK_BYTES)):
            texts = pc.fill_null(batch.column("text"), "")
            numbers, words, sizes = tokens_of(texts)
            order = np.argsort(-np.bincount(numbers, minlength=len(words)), kind="stable")
            place = np.empty(len(order), np.uint32)
            place[order] = np.arange(len(order))
            numbers = place[numbers]
            train = ~batch.column("held").to_numpy(zero_copy_only=False)
            counts = np.bincount(numbers[np.repeat(train, sizes)], minlength=len(words))
            lexicon = [words.take(pa.array(order)), counts]
            ends, length = np.cumsum(sizes), np.cumsum(pc.binary_length(texts).to_numpy())
            cuts = [0, *(np.flatnonzero(np.diff(length // PIECE_BYTES)) + 1).tolist(), len(sizes)]
            for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
                own = numbers[ends[a] - sizes[a] : ends[b - 1]]
                blobs = [[train[a:b].tobytes()], [sizes[a:b].astype(np.int32).tobytes()], [packed(own)]]
                keys = pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), batch.column("key").slice(a, b - a))
                lists = [[c] if not piece else [None] for c in lexicon]
                columns = [pa.array([crc32(at.to_bytes(8, "big")) % settings.rounds]), keys, *(pa.array(c, k) for c, k in zip([*blobs, *lists], kinds))]
                whole = sealed(pa.RecordBatch.from_arrays(columns, names))
                yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([piece]), pa.array([whole], pa.binary())], ["block", "piece", "whole"])
            at += 1
            pa.default_memory_pool().release_unused()

    return docs.mapInArrow(run, "block long, piece long, whole binary")


def lexicon(made: DataFrame) -> DataFrame:
    """(word, block, place, n, first): the words of every block with their counts in training over all blocks; the first of
    the rows of a word is marked."""

    def run(batches):
        for batch in batches:
            for block, data in zip(batch.column("block").to_pylist(), batch.column("whole")):
                own = opened(data.as_py())
                words, counts = own.column("words").values, own.column("counts").values
                columns = [words, pa.array(np.full(len(words), block)), pa.array(np.arange(len(words))), counts]
                yield pa.RecordBatch.from_arrays(columns, ["word", "block", "place", "n"])

    made = made.filter("piece = 0").select("block", "whole")
    rows = made.mapInArrow(run, "word binary, block long, place long, n long")
    same = Window.partitionBy("word")
    return rows.select("word", "block", "place", F.sum("n").over(same).alias("n"), (F.min("block").over(same) == F.col("block")).alias("first"))


@dataclass(frozen=True)
class Leaves:
    """Which leaf a word belongs to, and the mass of every leaf: bounded by the number of leaves."""

    alone: dict[bytes, int]
    cuts: list[bytes]  # words backwards, each the first of a cut leaf
    cut_leaf: list[int]
    mass: np.ndarray

    def of(self, word: bytes) -> int:
        leaf = self.alone.get(word)
        return self.cut_leaf[bisect_right(self.cuts, word[::-1])] if leaf is None else leaf


def leaves(vocabulary: DataFrame, total: float, settings: Settings) -> Leaves:
    """Leaves of the words (word, mass) of the training texts, whose masses add up to ``total``."""
    n = settings.leaves
    alone = {bytes(r.word): r.mass for r in vocabulary.filter(F.col("mass") >= 2 * total / n).collect()} if total else {}
    rest = vocabulary.filter(F.col("mass") < 2 * total / n)

    def backwards(batches):
        for batch in batches:
            words = pc.binary_reverse(batch.column("word"))
            yield pa.RecordBatch.from_arrays([words, batch.column("mass")], ["back", "mass"])

    placed = rest.select("word", "mass").mapInArrow(backwards, "back binary, mass double").repartitionByRange("back")
    placed = stored(placed.withColumn("range", F.spark_partition_id()), "endings")
    before, offsets = 0.0, []
    for r in sorted(placed.groupBy("range").agg(F.sum("mass").alias("mass")).collect(), key=lambda r: r["range"]):
        offsets.append((r["range"], before))
        before += r["mass"]
    step = before / max(n - len(alone), 1)
    cuts: list[bytes] = []
    if step:
        upto = F.sum("mass").over(Window.partitionBy("range").orderBy("back"))
        summed = placed.withColumn("upto", upto).join(placed.sparkSession.createDataFrame(offsets, "range int, before double"), "range")
        upto = F.col("upto") + F.col("before")
        crossing = summed.filter(F.floor(upto / step) > F.floor((upto - F.col("mass")) / step))
        cuts = sorted(bytes(r.back) for r in crossing.select("back").collect())[: n - len(alone) - 1]

    def cut_masses(batches):
        found = np.zeros(len(cuts) + 1)
        for batch in batches:
            at = [bisect_right(cuts, w) for w in batch.column("back").to_pylist()]
            found += np.bincount(at, weights=batch.column("mass").to_numpy(), minlength=len(found))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(found))), pa.array(found)], ["cut", "mass"])

    in_order = sorted([(b"", -1, i) if not i else (cuts[i - 1], 0, i) for i in range(len(cuts) + 1)] + [(w[::-1], 1, w) for w in alone])
    mass, cut_leaf, of_word = np.zeros(n), [0] * (len(cuts) + 1), {}
    for leaf, (_, kind, what) in enumerate(in_order):
        if kind == 1:
            of_word[what], mass[leaf] = leaf, alone[what]
        else:
            cut_leaf[what], mass[leaf] = leaf, 0.5  # an unseen word
    for r in placed.mapInArrow(cut_masses, "cut long, mass double").groupBy("cut").agg(F.sum("mass").alias("mass")).collect():
        mass[cut_leaf[r["cut"]]] += r["mass"]
    return Leaves(of_word, cuts, cut_leaf, mass)


def ready(made: DataFrame, words: DataFrame, found: Leaves, n: int, v: int, key_type: str) -> DataFrame:
    """Blocks with what the model needs: for each token a hash of its word and its leaf; for each document the tokens known,
    the base score, and the part of the score inside leaves. A block meets its words sorted, so a task holds the words of one block and a piece of it."""
    names = ["part", "keys", "train", "sizes", "known", "base", "inside", "hashes", "leaves"]
    floor = np.log10(n + 0.5 * (v + 1))

    def of_words(members: list[bytes], counts: np.ndarray) -> tuple[np.ndarray, ...]:
        leaf = np.array([found.of(w) for w in members], np.uint16)
        hashes = np.array([crc32(w) & 0xFFFF for w in members], np.uint16)
        mass = np.log10(counts + 0.5)
        return leaf, hashes, counts > 0, mass - floor, mass - np.log10(found.mass[leaf])

    def piece(own: pa.RecordBatch, leaf, hashes, known, base, inside) -> pa.RecordBatch:
        sizes = np.frombuffer(own.column("sizes")[0].as_py(), np.int32)
        starts = np.cumsum(sizes) - sizes
        at = unpacked(own.column("numbers")[0].as_py(), np.uint32, int(sizes.sum()))
        sums = [np.add.reduceat(c[at], starts).tobytes() for c in (known.astype(np.int64), base, inside)]
        blobs = [*sums, packed(hashes[at]), packed(leaf[at])]
        given = [own.column(c) for c in names[:4]]
        return pa.RecordBatch.from_arrays([*given, *(pa.array([b], pa.binary()) for b in blobs)], names)

    def run(batches):
        held: list[np.ndarray] = []
        lexicon: tuple = ()
        for batch in batches:
            counts, start = batch.column("n").to_numpy(zero_copy_only=False), 0
            for i in np.flatnonzero(batch.column("whole").is_valid().to_numpy(zero_copy_only=False)).tolist():
                held.append(counts[start:i])
                start, own = i + 1, opened(batch.column("whole")[i].as_py())
                if own.column("words").null_count == 0:
                    lexicon = of_words(own.column("words").values.to_pylist(), np.concatenate(held).astype(np.int64))
                held = []
                yield piece(own, *lexicon)
            held.append(counts[start:].copy())

    entries = words.select("block", "place", "n", F.lit(None).cast("binary").alias("whole"))
    wholes = made.select("block", (F.col("piece") + (1 << 62)).alias("place"), F.lit(None).cast("long").alias("n"), "whole")
    placed = entries.union(wholes).repartition("block").sortWithinPartitions("block", "place").select("n", "whole")
    return placed.mapInArrow(run, f"part long, keys array<{key_type}>, " + ", ".join(f"{n} binary" for n in names[2:]))


@dataclass
class Weights:
    """Rows of weights of both factors and how often each has fired."""

    first: np.ndarray
    second: np.ndarray
    first_hits: np.ndarray
    second_hits: np.ndarray

    @classmethod
    def none(cls, settings: Settings) -> Weights:
        n = settings.rows
        return cls(np.zeros((n, settings.first), np.float32), np.zeros((n, settings.second), np.float32), np.zeros(n), np.zeros(n))

    def copy(self) -> Weights:
        return Weights(*(a.copy() for a in (self.first, self.second, self.first_hits, self.second_hits)))


_SALTS = np.random.default_rng(12).integers(1, 1 << 62, 8, dtype=np.uint64)


def hashed(values: np.ndarray, kind: int, rows: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        z = (values.astype(np.uint64) + _SALTS[kind]) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((z ^ (z >> np.uint64(32))) & np.uint64(rows - 1)).astype(np.int64)


def before(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, k: int, none: int) -> np.ndarray:
    """For each token the value of the k-th token before it in its text."""
    out = np.full(len(values), none, np.int64)
    out[k:] = values[: len(values) - k]
    for j in range(k):
        out[np.minimum(starts + j, ends)] = none
    return out


class Model:
    """Both factors over the tokens of a block."""

    def __init__(self, weights: Weights, mass: np.ndarray, settings: Settings):
        self.weights, self.settings = weights, settings
        by_class = mass.reshape(settings.first, settings.second)
        whole = by_class.sum(1)
        with np.errstate(divide="ignore", invalid="ignore"):
            self.first_mass = np.log(whole / whole.sum()).astype(np.float32)
            share = np.log(by_class / whole[:, None])
        share[whole == 0] = 0.0
        self.second_mass = share.astype(np.float32)

    def features(self, hashes: np.ndarray, leaf: np.ndarray, sizes: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Rows of weights that fire for each token, in the first factor and in the second, given the class."""
        rows, ends = self.settings.rows, np.cumsum(sizes) - 1
        starts = ends - sizes + 1
        one, two = (before(hashes, starts, ends, k, 1 << 16) for k in (1, 2))
        leaf_one, leaf_two = (before(leaf, starts, ends, k, self.settings.leaves) for k in (1, 2))
        first = [hashed(one * ((1 << 16) + 1) + two, 0, rows), hashed(leaf_one, 1, rows), hashed(leaf_two, 2, rows)]
        inside = (leaf // self.settings.second).astype(np.int64)
        second = [hashed(v * self.settings.first + inside, k, rows) for k, v in ((3, leaf_one), (4, leaf_two))]
        return first, second

    @staticmethod
    def masses(weights: np.ndarray, fired: list[np.ndarray], mass: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """exp of the rows that fired on top of the masses, for each token, and its sum. Exponents are kept within +-60,
        which keeps floats finite; a leaf without mass gets e^-60 of its class."""
        out = np.take(weights, fired[0], axis=0, mode="clip")
        more = np.empty_like(out)
        for f in fired[1:]:
            out += np.take(weights, f, axis=0, out=more, mode="clip")
        out += mass
        np.clip(out, -60.0, 60.0, out=out)
        np.exp(out, out=out)
        return out, out.sum(1)

    @staticmethod
    def shares(weights: np.ndarray, fired: list[np.ndarray], mass: np.ndarray) -> np.ndarray:
        """The softmax for each token."""
        out, whole = Model.masses(weights, fired, mass)
        out /= whole[:, None]
        return out

    def step(self, weights: np.ndarray, hits: np.ndarray, fired: list[np.ndarray], shares: np.ndarray, target: np.ndarray) -> None:
        """One gradient update from a batch of tokens; rows that have fired often move less."""
        n, width = shares.shape
        shares[np.arange(n), target] -= 1.0
        flat, columns = weights.reshape(-1), np.arange(width)
        moved = np.empty_like(shares)
        for f in fired:
            times = np.bincount(f)
            hits[: len(times)] += times
            pace = (-self.settings.rate / np.sqrt(hits[f])).astype(np.float32)
            np.multiply(shares, pace[:, None], out=moved)
            np.add.at(flat, (f[:, None] * width + columns).ravel(), moved.ravel())

    def train(self, hashes: np.ndarray, leaf: np.ndarray, sizes: np.ndarray) -> None:
        first, second = self.features(hashes, leaf, sizes)
        inside, member = np.divmod(leaf.astype(np.int64), self.settings.second)
        w = self.weights
        for at in range(0, len(leaf), self.settings.batch):
            now = slice(at, at + self.settings.batch)
            fired = [f[now] for f in first]
            self.step(w.first, w.first_hits, fired, self.shares(w.first, fired, self.first_mass), inside[now])
            fired = [f[now] for f in second]
            self.step(w.second, w.second_hits, fired, self.shares(w.second, fired, self.second_mass[inside[now]]), member[now])

    def log10(self, hashes: np.ndarray, leaf: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """For each token log10 of the probability of its leaf."""
        first, second = self.features(hashes, leaf, sizes)
        inside, member = np.divmod(leaf.astype(np.int64), self.settings.second)
        out = np.empty(len(leaf))
        for at in range(0, len(leaf), self.settings.batch):
            now = slice(at, at + self.settings.batch)
            n = np.arange(len(leaf[now]))
            a, whole = self.masses(self.weights.first, [f[now] for f in first], self.first_mass)
            b, part = self.masses(self.weights.second, [f[now] for f in second], self.second_mass[inside[now]])
            out[now] = np.log10(a[n, inside[now]] / whole) + np.log10(b[n, member[now]] / part)
        return out


def trained(blocks: DataFrame, mass: np.ndarray, tokens: int, settings: Settings) -> Weights:
    """Weights after one pass over the training tokens in rounds."""
    weights, spark = Weights.none(settings), blocks.sparkSession
    tasks = max(1, -(-tokens // (settings.rounds * settings.tokens_per_task)))
    for part in range(settings.rounds):
        sent = spark.sparkContext.broadcast(weights)
        moved = blocks.filter(F.col("part") == part).select("train", "sizes", "hashes", "leaves").coalesce(tasks)
        moved = moved.mapInArrow(_trainer(sent, mass, settings), "slice int, factor int, hits binary, move binary")
        merged = moved.repartition("slice", "factor").sortWithinPartitions("slice", "factor").mapInArrow(_merged, "slice int, factor int, hits binary, move binary")
        size = settings.rows // settings.slices
        for r in merged.collect():
            rows = slice(r["slice"] * size, (r["slice"] + 1) * size)
            to, hits = ((weights.first, weights.first_hits), (weights.second, weights.second_hits))[r.factor]
            to[rows] += np.frombuffer(r.move, np.float32).reshape(size, -1)
            hits[rows] += np.frombuffer(r.hits, np.float64)
        sent.destroy()
    return weights


def _trainer(sent, mass: np.ndarray, settings: Settings):
    def run(batches):
        start = sent.value
        model = Model(start.copy(), mass, settings)
        for batch in batches:
            for i in range(batch.num_rows):
                train, sizes, hashes, leaf = (batch.column(c)[i].as_py() for c in ("train", "sizes", "hashes", "leaves"))
                train, sizes = np.frombuffer(train, bool), np.frombuffer(sizes, np.int32).astype(np.int64)
                n, chosen = int(sizes.sum()), np.repeat(train, sizes)
                if chosen.any():
                    model.train(unpacked(hashes, np.uint16, n)[chosen], unpacked(leaf, np.uint16, n)[chosen], sizes[train])
        own, size = model.weights, settings.rows // settings.slices
        for factor, (now, then, hits, hits_then) in enumerate(
            ((own.first, start.first, own.first_hits, start.first_hits), (own.second, start.second, own.second_hits, start.second_hits))
        ):
            for at in range(settings.slices):
                rows = slice(at * size, (at + 1) * size)
                times = (hits[rows] - hits_then[rows]).astype(np.float32)
                if times.any():
                    row = [at, factor, times.tobytes(), (now[rows] - then[rows]).astype(np.float16).tobytes()]
                    types = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], ["slice", "factor", "hits", "move"])

    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by slice and factor: hits added up, moves averaged by hits."""
    now, hits, moved = None, None, None

    def closed():
        move = (moved / np.maximum(hits, 1.0)[:, None]).astype(np.float32)
        row = [*now, hits.tobytes(), move.tobytes()]
        types = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], ["slice", "factor", "hits", "move"])

    for batch in batches:
        for i in range(batch.num_rows):
            at, factor, times, move = (batch.column(c)[i].as_py() for c in ("slice", "factor", "hits", "move"))
            times = np.frombuffer(times, np.float32).astype(np.float64)
            move = np.frombuffer(move, np.float16).reshape(len(times), -1).astype(np.float64) * times[:, None]
            if now != (at, factor):
                if now is not None:
                    yield closed()
                now, hits, moved = (at, factor), times, move
            else:
                hits, moved = hits + times, moved + move
    if now is not None:
        yield closed()


def _scorer(sent, mass: np.ndarray, settings: Settings):
    def run(batches):
        model = Model(sent.value, mass, settings)
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in ("train", "sizes", "known", "base", "inside", "hashes", "leaves")}
                sizes = np.frombuffer(row["sizes"], np.int32).astype(np.int64)
                n = int(sizes.sum())
                found = model.log10(unpacked(row["hashes"], np.uint16, n), unpacked(row["leaves"], np.uint16, n), sizes)
                score = np.add.reduceat(found, np.cumsum(sizes) - sizes) + np.frombuffer(row["inside"], np.float64)
                held = ~np.frombuffer(row["train"], bool)
                columns = [held, sizes, np.frombuffer(row["known"], np.int64), np.frombuffer(row["base"], np.float64), score]
                yield pa.RecordBatch.from_arrays([batch.column("keys")[i].values, *map(pa.array, columns)], ["key", "held_out", "n_tokens", "n_known", "base_score", "score"])

    return run


def scored(df: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """Rows (key, held_out, n_tokens, n_known, train_tokens, base_score, score), one for each row of the table."""
    spark = df.sparkSession
    docs = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"), held_out(F.col(key)).alias("held"))
    made = stored(blocks(docs, settings), "blocks")
    words = stored(lexicon(made), "lexicon")
    known = stored(words.filter(F.col("first") & (F.col("n") > 0)).select("word", "n"), "vocabulary")
    v, n = known.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    found = leaves(known.select("word", (F.col("n") + 0.5).alias("mass")), n + 0.5 * v, settings)
    kind = docs.schema["key"].dataType.simpleString()
    tokens = stored(ready(made, words, found, n, v, kind), "tokens")
    released(made, words, known)
    weights = spark.sparkContext.broadcast(trained(tokens, found.mass, n, settings))
    out = tokens.mapInArrow(_scorer(weights, found.mass, settings), f"key {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return out.select(F.col("key").alias(key), "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")
