"""Ranked lexical search, term at a time, with limited accumulators.

Terms are runs of digits, letters and characters beyond ASCII, only A-Z lower-cased. All documents are ranked for every
item of a stated query set by integer weights, so that sums do not depend on their order.

1. The items' terms are read in blocks of bounded size. For a block of them one pass over all documents keeps the number
   of terms of every document and the postings of the block's terms, packed by group of documents; counts over all
   documents (documents, terms, documents of each term) are sums over these.
2. In each group of documents an item's terms are taken rarest first. A posting opens an accumulator for its document
   until the bounds of the terms that are left, each the largest that any posting of the group adds, together no longer
   reach the k-th best partial score: no document without an accumulator can then get among the best of its group, let
   alone of all. From there on postings only add to the accumulators there are, exactly.
3. The best of each group compete for the places of the item.

Defined results: null texts have no terms and documents without terms count nowhere; documents that come in several rows
compete with each row; rows of items with one id are one item with the terms of all; items that share no term with any
document have no rows, nor have scores of zero; equal scores go by ascending document id, null ids last. Other columns
are left behind.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from panelspark.llm.bpe import parts
from panelspark.llm.tables import stored

#: (item, term) pairs that are sent to the tasks at once; a single item may have more.
PAIRS_AT_ONCE = 1 << 17
#: Postings and documents that a task ranks at once.
POSTINGS_AT_ONCE = 1 << 21
DOCUMENTS_AT_ONCE = 1 << 15

_TERM = {*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)}
FOLDED = bytes(ord(chr(b).lower()) if 0x41 <= b < 0x5B else b if b in _TERM else 0x20 for b in range(256))


def terms_of(data: bytes | None) -> list[bytes]:
    return (data or b"").translate(FOLDED).split()


def item_terms(items: DataFrame, key: str, text: str) -> DataFrame:
    """(item, term, times) for the terms of each item."""

    def run(batches):
        for batch in batches:
            for part in parts(batch, "data"):
                found = [(k, t) for k, d in zip(part.column("item").to_pylist(), part.column("data").to_pylist()) for t in terms_of(d)]
                keys, terms = zip(*found) if found else ((), ())
                yield pa.RecordBatch.from_arrays([pa.array(keys, part.schema.field("item").type), pa.array(terms, pa.binary())], ["item", "term"])

    rows = items.select(F.col(key).alias("item"), F.col(text).cast("string").cast("binary").alias("data"))
    kind = rows.schema["item"].dataType.simpleString()
    return rows.mapInArrow(run, f"item {kind}, term binary").groupBy("item", "term").agg(F.count("*").alias("times"))


def blocks_of(pairs: DataFrame, most: int) -> tuple[DataFrame, list[int]]:
    """The pairs with a block number, whole items together, and the blocks there are: at most ``most`` pairs in each that
    holds more than one item."""
    total, blocks = pairs.count(), 1
    while True:
        dealt = pairs.withColumn("block", F.pmod(F.xxhash64("item", F.lit(blocks)), F.lit(blocks)))
        sizes = dealt.groupBy("block").agg(F.count("*").alias("n"), F.count_distinct("item").alias("items"))
        if blocks * most >= total and not sizes.filter((F.col("n") > most) & (F.col("items") > 1)).take(1):
            return dealt, sorted(r.block for r in sizes.collect())
        blocks = max(2 * blocks, -(-2 * total // most))


@dataclass(frozen=True)
class Asked:
    """A block of items: their ids, the distinct terms, and for each item the numbers of its terms and their times."""

    items: list
    terms: list[bytes]
    of_item: list[tuple[np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, rows: list) -> Asked:
        terms = sorted({bytes(r.term) for r in rows})
        number = {t: i for i, t in enumerate(terms)}
        by_item: dict = {}
        for r in rows:
            by_item.setdefault(r.item, []).append((number[bytes(r.term)], r.times))
        pairs = [tuple(np.array(v, np.int64).T) for v in by_item.values()]
        return cls(list(by_item), terms, pairs)


def postings(docs: DataFrame, asked, terms: int) -> DataFrame:
    """One row for each group of documents: their keys, numbers of terms, and the postings (document, term, times) of the
    terms asked for, as packed arrays."""

    def run(batches):
        number = {t: i for i, t in enumerate(asked.value.terms)}
        for batch in (part for whole in batches for part in parts(whole, "data", 1 << 22)):
            lists = [terms_of(d) for d in batch.column("data").to_pylist()]
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            get = number.get
            ids = np.fromiter((get(t, -1) for ts in lists for t in ts), np.int64, int(sizes.sum()))
            doc = np.repeat(np.arange(len(lists)), sizes)
            hit = ids >= 0
            pair, times = np.unique(doc[hit] * terms + ids[hit], return_counts=True)
            packed = [sizes, (pair // terms).astype(np.int32), (pair % terms).astype(np.int32), times.astype(np.int32)]
            column = batch.column("key")
            keys = pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column)
            blobs = [pa.array([a.tobytes()], pa.binary()) for a in packed]
            yield pa.RecordBatch.from_arrays([keys, *blobs], ["keys", "sizes", "doc", "term", "times"])

    kind = docs.schema["key"].dataType.simpleString()
    return docs.mapInArrow(run, f"keys array<{kind}>, sizes binary, doc binary, term binary, times binary")


def counted(groups: DataFrame, terms: int) -> tuple[int, int, np.ndarray]:
    """Documents with terms, their terms, and for each term asked for the documents that hold it."""

    def run(batches):
        total = np.zeros(terms + 2, np.int64)
        for batch in batches:
            for sizes, term in zip(batch.column("sizes"), batch.column("term")):
                n = np.frombuffer(sizes.as_py(), np.int64)
                total[:2] += (n > 0).sum(), n.sum()
                total[2:] += np.bincount(np.frombuffer(term.as_py(), np.int32), minlength=terms)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])

    out = np.zeros(terms + 2, np.int64)
    for r in groups.select("sizes", "term").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        out[r["at"]] = r["n"]
    return int(out[0]), int(out[1]), out[2:]


def weights(documents: int, holding: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df) + 1))) for df in holding], np.int64)


class Group:
    """Postings of a group of documents by term, each with what one occurrence of the term in an item adds, but for the
    term's weight."""

    def __init__(self, keys: list, sizes: np.ndarray, doc: np.ndarray, term: np.ndarray, times: np.ndarray, documents: int, total: int, terms: int):
        self.keys, self.n = keys, len(keys)
        most = 75 * int(sizes.max(initial=0)) * documents
        scaled = sizes * (75 * documents) if most < 1 << 63 else sizes.astype(object) * (75 * documents)
        length = (25 + scaled // max(total, 1)).astype(np.int64)
        order = np.argsort(term, kind="stable")
        self.doc, times = doc[order], times[order].astype(np.int64)
        self.adds = (1_000_000_000 * times) // (1000 * times + 8 * length[self.doc])
        self.at = np.searchsorted(term[order], np.arange(terms + 1))
        self.most = np.zeros(terms, np.int64)
        full = np.flatnonzero(np.diff(self.at))
        if len(full):
            self.most[full] = np.maximum.reduceat(self.adds, self.at[full])
        by_key = sorted(range(self.n), key=lambda i: (keys[i] is None, keys[i] if keys[i] is not None else 0))
        self.place = np.empty(self.n, np.int64)
        self.place[by_key] = np.arange(self.n)
        self.scores = np.zeros(self.n, np.int64)
        self.opened = 0  # accumulators so far, of all items

    def best(self, terms: np.ndarray, weight: np.ndarray, holding: np.ndarray, k: int) -> list[tuple[object, int]]:
        """The k best (key, score) of the group for one item."""
        order = np.lexsort((terms, holding[terms]))
        terms, weight = terms[order], weight[order]
        bounds = weight * self.most[terms]
        left = np.cumsum(bounds[::-1])[::-1]
        scores, opening = self.scores, True
        scores[:] = 0
        open_docs = np.empty(0, np.int64)
        for j, (t, w) in enumerate(zip(terms, weight)):
            if not bounds[j]:
                continue
            if opening and len(open_docs) >= k:
                partial = scores[open_docs]
                opening = np.partition(partial, len(partial) - k)[-k] <= left[j]
            doc, adds = self.doc[self.at[t] : self.at[t + 1]], self.adds[self.at[t] : self.at[t + 1]]
            if opening:
                scores[doc] += w * adds
                open_docs = np.flatnonzero(scores)
            else:
                has = scores[doc] > 0
                scores[doc[has]] += w * adds[has]
        self.opened += len(open_docs)
        found = scores[open_docs]
        if len(found) > k:
            kept = found >= np.partition(found, len(found) - k)[-k]
            open_docs, found = open_docs[kept], found[kept]
        first = np.lexsort((self.place[open_docs], -found))[:k]
        return [(self.keys[d], int(s)) for d, s in zip(open_docs[first], found[first])]


def groups_of(batches: Iterator[pa.RecordBatch], documents: int, total: int, terms: int) -> Iterator[Group]:
    """Packed rows put together to groups of bounded size."""
    held: list[tuple] = []

    def joined() -> Group:
        keys, sizes, doc, term, times = zip(*held)
        shift = np.cumsum([0, *map(len, keys)])
        doc = np.concatenate([d + s for d, s in zip(doc, shift)])
        flat = [k for part in keys for k in part]
        return Group(flat, np.concatenate(sizes), doc, np.concatenate(term), np.concatenate(times), documents, total, terms)

    n = docs = 0
    for batch in batches:
        for i in range(batch.num_rows):
            keys, sizes, *blobs = (batch.column(c)[i].as_py() for c in ("keys", "sizes", "doc", "term", "times"))
            held.append((keys, np.frombuffer(sizes, np.int64), *(np.frombuffer(b, np.int32) for b in blobs)))
            n += len(held[-1][2])
            docs += len(keys)
            if n >= POSTINGS_AT_ONCE or docs >= DOCUMENTS_AT_ONCE:
                yield joined()
                held, n, docs = [], 0, 0
    if held:
        yield joined()


def ranked(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    pairs_at_once: int = PAIRS_AT_ONCE,
) -> DataFrame:
    """Rows (item, rank, document, score): for each item the k documents with the highest scores above zero."""
    spark = docs.sparkSession
    pairs = stored(item_terms(items, item_key, item_text), "pairs")
    dealt, blocks = blocks_of(pairs, pairs_at_once)
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").cast("binary").alias("data"))
    kinds = [t.simpleString() for t in (pairs.schema["item"].dataType, rows.schema["key"].dataType)]
    schema = f"item {kinds[0]}, key {kinds[1]}, score long"
    found = spark.createDataFrame([], schema)
    for block in blocks:
        asked = Asked.of(dealt.filter(F.col("block") == block).select("item", "term", "times").collect())
        sent, terms = spark.sparkContext.broadcast(asked), len(asked.terms)
        groups = stored(postings(rows, sent, terms), "postings")
        found = found.union(stored(_best(groups, sent, terms, k, schema), "ranked"))
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("key")))
    out = found.withColumn("rank", place).filter(F.col("rank") <= k)
    return out.select(F.col("item").alias(item_key), "rank", F.col("key").alias(key), "score")


def _best(groups: DataFrame, asked, terms: int, k: int, schema: str) -> DataFrame:
    """The best of every group of documents for the items of a block."""
    documents, total, holding = counted(groups, terms)
    weight = weights(documents, holding)

    def run(batches):
        own = asked.value
        for group in groups_of(batches, documents, total, terms):
            rows = [
                (item, key, score)
                for item, (numbers, times) in zip(own.items, own.of_item)
                for key, score in group.best(numbers, weight[numbers] * times, holding, k)
            ]
            columns = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["item", "key", "score"])

    kinds = [to_arrow_type(f.dataType) for f in groups.sparkSession.createDataFrame([], schema).schema]
    return groups.mapInArrow(run, schema)


#: The same in SQL, every document scored for every item.
ORACLE = r"""
WITH tokens AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), sizes AS (
  SELECT doc_id, count(*) AS n FROM tokens GROUP BY 1
), corpus AS (
  SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM sizes
), hits AS (
  SELECT doc_id, term, count(*) AS tf FROM tokens GROUP BY 1, 2
), asked AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), pairs AS (
  SELECT item_id, term, count(*) AS times FROM asked GROUP BY 1, 2
), weighted AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM hits, corpus GROUP BY term, docs
), scored AS (
  SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // total))))::BIGINT AS score
  FROM pairs JOIN hits USING (term) JOIN weighted USING (term) JOIN sizes USING (doc_id), corpus GROUP BY 1, 2
), places AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place, doc_id, score FROM scored WHERE score > 0
)
SELECT item_id, place::INTEGER AS rank, doc_id, score FROM places WHERE place <= 10
"""
