"""Near duplicates among vectors by sorted projection passes.

1. Equal vectors count once: a class with its number of rows.
2. A pass gives each class a key of random hyperplane signs, read as one long bit string, and sorts all classes by it.
   Each class is compared with its next neighbours in that order, in blocks that also hold the first rows of the block
   after them. The passes use different hyperplanes, and there are as many as the number of classes asks for: a lone pair
   that just links is predicted to meet in some pass with the same probability at every size (see ``passes_for``). A pair
   that meets in none, and that no third vector ties, is missed.
3. Verified pairs of all passes are united into components.
4. Inside a component the links are counted exactly, so that their numbers are whole however many neighbours a class
   has. Classes within half the linking angle of one of them all link with each other, so a group of near copies takes
   one comparison for each; the others are compared with all, block against block. A task holds two blocks, never a
   component.

Cosines are computed in double precision. Defined results: a vector that is null, empty, zero, or holds a null or
non-finite component links with nothing; vectors of different lengths do not link; repeated rows are copies and link
with each other; a component whose ids are all null has a null id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm.components import components
from panelspark.llm.tables import stored

#: Passes of a small table, and the share of lone pairs at the linking cosine that larger ones must keep.
PASSES = 12
RECALL = 0.99
KEY_BITS = 48
WINDOW = 48
#: Classes in a block of a sorted pass and of a component; a short block compares little that is outside the window.
BLOCK = 256
COMPONENT_BLOCK = 1024


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled by the largest component first, so that squares neither overflow nor vanish."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _matrix(packed: pa.RecordBatch | pa.Table) -> np.ndarray:
    """Packed vectors of equal length as rows of doubles."""
    dims, rows = packed.column("dim"), packed.column("packed").to_pylist()
    kind = np.float32 if len(rows[0]) == 4 * dims[0].as_py() else np.float64
    return np.frombuffer(b"".join(rows), kind).reshape(len(rows), -1).astype(np.float64)


def classes_of(df: DataFrame, key: str, vector: str) -> tuple[DataFrame, DataFrame]:
    """(key, class) for every row, class null if it links with nothing; and (class, dim, first, n, packed)."""
    given = df.select(F.col(vector).alias("v")).schema["v"].dataType.simpleString()
    kind, width = ("float", np.float32) if given == "array<float>" else ("double", np.float64)
    values = F.col(vector).cast(f"array<{kind}>")
    sound = values.isNotNull() & (F.size(values) > 0) & F.forall(
        values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    ) & F.exists(values, lambda x: x != 0)
    rows = df.select(F.col(key).alias("key"), F.when(sound, F.transform(values, lambda x: x + F.lit(0.0).cast(kind))).alias("vector"))

    def pack(batches):
        for batch in batches:
            vectors = [np.array(v, width) if v else None for v in batch.column("vector").to_pylist()]
            packed = pa.array([None if v is None else v.tobytes() for v in vectors], pa.binary())
            dims = pa.array([None if v is None else len(v) for v in vectors], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("key"), dims, packed], ["key", "dim", "packed"])

    key_kind = rows.schema["key"].dataType.simpleString()
    packed = rows.mapInArrow(pack, f"key {key_kind}, dim int, packed binary")
    packed = packed.withColumn("class", F.concat_ws(":", "dim", F.md5("packed")))
    packed = packed.withColumn("class", F.when(F.col("packed").isNotNull(), F.col("class")))
    packed = stored(packed, "vectors")
    found = packed.filter("class is not null").groupBy("class", "dim", "packed").agg(F.min("key").alias("first"), F.count("*").alias("n"))
    return packed.select("key", "class"), stored(found, "classes")


def passes_for(n: int, least: float, window: int, recall: float = RECALL) -> int:
    """How many passes find a pair at the cosine ``least`` among ``n`` evenly spread classes with probability ``recall``.

    A hyperplane leaves the pair on one side with probability p. Both are within the window of a pass about when they
    share the first log2(n / window) signs. Classes crowded just below the threshold share more signs than evenly spread
    ones, and then fewer pairs are found than this says.
    """
    together = 1 - np.arccos(np.clip(least, -1, 1)) / np.pi
    if n <= window or together >= 1:
        return PASSES
    met = together ** np.log2(n / window)
    return max(PASSES, int(np.ceil(np.log1p(-recall) / np.log1p(-met))))


def projected(classes: DataFrame, passes: int, bits: int, seed: int) -> DataFrame:
    """(pass, dim, bits as text of bytes, class, packed): the sort keys of every class in every pass."""

    def run(batches):
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                own = batch.filter(pa.array(dims == dim))
                if dim not in planes:
                    planes[dim] = np.random.default_rng([seed, dim]).standard_normal((dim, passes * bits))
                signs = (unit(_matrix(own)) @ planes[dim]) > 0
                for k in range(passes):
                    words = np.packbits(signs[:, k * bits : (k + 1) * bits], axis=1)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(own.num_rows, k, np.int32)),
                            own.column("dim"),
                            pa.array([w.tobytes() for w in words], pa.binary()),
                            own.column("class"),
                            own.column("packed"),
                        ],
                        ["pass", "dim", "bits", "class", "packed"],
                    )

    return classes.select("dim", "class", "packed").mapInArrow(run, "pass int, dim int, bits binary, class string, packed binary")


def neighbour_pairs(classes: DataFrame, least: float, passes: int, bits: int, window: int, block: int, seed: int) -> DataFrame:
    """(a, b), a < b: verified pairs at most ``window`` places apart in some pass, enough to tie all of them together.

    Rows are placed by ranges of the sort key and blocked there. The first ``window`` rows of a partition also go to the
    partition before it, so that no pair is lost at a border.
    """
    spark = classes.sparkSession
    many = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keys = projected(classes, passes, bits, seed)
    placed = keys.repartitionByRange(many, "pass", "dim", "bits", "class").sortWithinPartitions("pass", "dim", "bits", "class")
    placed = stored(placed.withColumn("place", F.spark_partition_id()), "passes")

    def head(batches):  # the first rows of each pass and length in a partition
        seen: dict = {}
        for batch in batches:
            take = []
            for place, p, d in zip(*(batch.column(c).to_pylist() for c in ("place", "pass", "dim"))):
                seen[place, p, d] = seen.get((place, p, d), 0) + 1
                take.append(seen[place, p, d] <= window)
            yield batch.filter(pa.array(take, pa.bool_()))

    schema = placed.schema
    # A file holds one partition in its order, and a large file may be read in several parts: then more rows are taken.
    heads = placed.mapInArrow(head, schema)
    places = placed.select("pass", "dim", "place").distinct()
    before = F.lag("place").over(Window.partitionBy("pass", "dim").orderBy("place"))
    following = heads.join(places.withColumn("own", before).filter("own is not null"), ["pass", "dim", "place"])
    rows = placed.withColumn("own", F.col("place")).withColumn("extra", F.lit(False))
    rows = rows.unionByName(following.withColumn("extra", F.lit(True)).select(*rows.columns))

    def compare(batches):
        for (a, b) in _windows(batches, least, window, block):
            yield pa.RecordBatch.from_arrays([a, b], ["a", "b"])

    ordered = rows.repartition(many, "own").sortWithinPartitions("own", "pass", "dim", "bits", "class")
    return ordered.mapInArrow(compare, "a string, b string").distinct()


def _windows(batches, least, window, block):
    """Compares each row with the ``window`` rows before it, as long as they are of the same place, pass and length.

    Of the pairs found in one pass of one place, those that close a circle are left out: the others already tie the same
    classes together, and the links themselves are counted later.
    """
    tail_names: list = []
    tail: np.ndarray | None = None
    tail_group = None
    above: dict[str, str] = {}

    def top(x: str) -> str:
        while (y := above.get(x, x)) != x:
            above[x] = above.get(y, y)
            x = y
        return x

    for whole in batches:
        for at in range(0, whole.num_rows, block):
            batch = whole.slice(at, block)
            groups = list(zip(*(batch.column(c).to_pylist() for c in ("own", "pass", "dim"))))
            names = batch.column("class").to_pylist()
            cuts = [0, *[i for i in range(1, len(groups)) if groups[i] != groups[i - 1]], len(groups)]
            for s, e in zip(cuts, cuts[1:]):
                if e == s:
                    continue
                own = unit(_matrix(batch.slice(s, e - s)))
                if tail_group == groups[s]:
                    vectors, ids = np.concatenate([tail, own]), tail_names + names[s:e]
                else:
                    vectors, ids = own, names[s:e]
                    above.clear()
                old = len(ids) - (e - s)
                near = vectors[old:] @ vectors.T
                row, col = np.nonzero(near >= least)
                row += old
                keep = (col < row) & (row - col <= window)
                pairs = []
                for i, j in zip(row[keep].tolist(), col[keep].tolist()):
                    x, y = top(ids[i]), top(ids[j])
                    if x != y:
                        above[x] = y
                        pairs.append(sorted((ids[i], ids[j])))
                tail, tail_names, tail_group = vectors[-window:], ids[-window:], groups[s]
                if pairs:
                    yield pa.array([p[0] for p in pairs]), pa.array([p[1] for p in pairs])


def flagged(members: DataFrame, least: float) -> DataFrame:
    """The members with ``core``: whether the angle to the class that names the component is at most half of what links.
    Any two such classes link, whatever their number."""
    pivots = members.filter("class = root").select("root", F.col("packed").alias("pivot"))
    half = float(np.sqrt((1 + least) / 2)) + 1e-9  # with room for rounding
    rows = members.join(pivots, "root")

    def run(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            core = np.zeros(batch.num_rows, bool)
            for dim in np.unique(dims):
                take = np.flatnonzero(dims == dim)
                own = batch.take(pa.array(take))
                pivot = own.drop_columns(["packed"]).rename_columns({"pivot": "packed"})
                core[take] = (unit(_matrix(own)) * unit(_matrix(pivot))).sum(axis=1) >= half
            yield batch.drop_columns(["pivot"]).append_column("core", pa.array(core))

    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in rows.drop("pivot").schema]
    return rows.mapInArrow(run, ", ".join([*kinds, "core boolean"]))


def inner_links(members: DataFrame, least: float, block: int) -> DataFrame:
    """(class, n_links): rows of other classes of the same component that link with the class.

    ``members`` has (root, class, n, dim, packed). Classes of the core link with each other and are only counted. The
    others are compared with all: they and the core are cut into blocks of about ``block`` classes by a hash, and each
    block of the others meets every block once.
    """
    rows = stored(flagged(members, least), "flagged")
    size = lambda which: F.ceil(F.count_if(which) / block).cast("long")
    sizes = rows.groupBy("root").agg(
        size(~F.col("core")).alias("loose"), size(F.col("core")).alias("cores"), F.sum(F.when(F.col("core"), F.col("n"))).alias("core_n")
    )
    met = rows.join(sizes, "root")
    counted = met.filter("core").select("class", (F.col("core_n") - F.col("n")).alias("n_links"))
    place = F.xxhash64("class")
    own = F.when(F.col("core"), F.col("loose") + F.pmod(place, "cores")).otherwise(F.pmod(place, "loose"))
    last = F.when(F.col("core"), F.col("loose")).otherwise(F.col("loose") + F.col("cores")) - 1
    dealt = met.filter("loose > 0").withColumn("own", own)
    sent = dealt.select("root", "own", "class", "n", "dim", "packed", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("other"))
    sent = sent.select(
        "root", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "class", "n", "dim", "packed"
    )

    def compare(key, table):
        low, high = key[1].as_py(), key[2].as_py()
        vectors, own = unit(_matrix(table)), table.column("own").to_numpy()
        n, names = table.column("n").to_numpy(), table.column("class").combine_chunks()
        left, right = np.flatnonzero(own == low), np.flatnonzero(own == high)
        linked = vectors[left] @ vectors[right].T >= least
        if low == high:
            np.fill_diagonal(linked, False)
            return pa.table({"class": names.take(pa.array(left)), "n_links": linked @ n[right]})
        both = np.concatenate([left, right])
        return pa.table({"class": names.take(pa.array(both)), "n_links": np.concatenate([linked @ n[right], linked.T @ n[left]])})

    found = sent.groupBy("root", "low", "high").applyInArrow(compare, "class string, n_links long")
    return counted.union(found).groupBy("class").agg(F.sum("n_links").alias("n_links"))


def near_duplicates(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    least: float = 0.9,
    passes: int | None = None,
    bits: int = KEY_BITS,
    window: int = WINDOW,
    block: int = BLOCK,
    component_block: int = COMPONENT_BLOCK,
    seed: int = 7,
) -> DataFrame:
    """Rows (key, n_links, component_id, kept), one for each row of the table. ``passes`` follows the number of classes
    if it is not given."""
    rows, classes = classes_of(df, key, vector)
    passes = passes_for(classes.count(), least, window) if passes is None else passes
    pairs = neighbour_pairs(classes, least, passes, bits, window, block, seed)
    roots = components(pairs)
    members = stored(classes.join(roots, F.col("class") == F.col("node")).select("root", "class", "first", "n", "dim", "packed"), "members")
    ids = members.groupBy("root").agg(F.min("first").alias("component_id"))
    tied = members.select("root", "class").join(ids, "root").join(inner_links(members, least, component_block), "class", "left")
    every = classes.select("class", "first", "n").join(tied.select("class", "component_id", "n_links"), "class", "left")
    every = every.select(
        "class",
        F.coalesce("component_id", "first").alias("component_id"),
        (F.coalesce("n_links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
    )
    out = rows.join(every, "class", "left").select(
        "key", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("class").isNull(), F.col("key")).otherwise(F.col("component_id")).alias("component_id")
    )
    return out.select(F.col("key").alias(key), "n_links", "component_id", F.col("key").eqNullSafe(F.col("component_id")).alias("kept"))
