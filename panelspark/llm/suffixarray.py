"""Suffix-array deduplication: bytes covered by a string of a fixed length that also starts anywhere else.

Suffixes start at content-sampled anchors (see ``repeats``). Spark's sampled splitters range-partition them by their
leading bytes. A bucket sorts its suffixes level by level, eight bytes at a time; the longest common prefix with
a neighbour bounds how far to the right any other suffix can agree, which leaves the windows that end before it. Those
decide: hashes propose equal ones, bytes check them. Splitters fall between different leading grams, and windows with different leading grams differ,
so neighbours across a boundary have nothing in common that counts; a gram so frequent that it would fill a bucket is
split by longer cores first.

Defined results: matches never cross documents; a null text counts as empty; repeated rows are copies of each other, so
whatever holds a whole window is removed in all of them; texts shorter than the window are left alone.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.repeats import BYTE_CODES, GROUP, STARTS_AT_ONCE, Symbols, removed, run_hashes

WINDOW = 400


def byte_symbols(window: int = WINDOW) -> Symbols:
    gram = max(1, window // 4)
    return Symbols(window, gram, tuple(b for b in (64, 8) if b < window - gram + 1) + (1,), words=False)


def multikey_sorted(suffixes: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The order of the suffixes, and for each place in it the common prefix with the place before.

    Characters are words of eight bytes: rows that agree so far are sorted by their next word, and only groups of more
    than one row go on.
    """
    n = len(suffixes)
    sizes = np.array([len(s) for s in suffixes], np.int64)
    words = -(-sizes // 8) + 1  # the last word is zero, or ends in zeros
    first = np.cumsum(words) - words
    flat = np.frombuffer(b"".join(s + bytes(8 * w - len(s)) for s, w in zip(suffixes, words.tolist())), ">u8")
    order, common = np.argsort(sizes, kind="stable"), np.zeros(n, np.int64)  # an end goes before the zeros of a text
    start, end = np.array([0]), np.array([n])  # groups that still tie, as places in the order
    depth = 0
    while len(start):
        counts = end - start
        places = np.repeat(start - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        group = np.repeat(np.arange(len(start)), counts)
        rows = order[places]
        word = flat[first[rows] + np.minimum(depth, words[rows] - 1)]
        by = np.lexsort((word, group))
        order[places], word = rows[by], word[by]
        same_group = np.concatenate([[False], group[1:] == group[:-1]])
        equal = np.concatenate([[False], word[1:] == word[:-1]]) & same_group
        ends = same_group & ~equal
        if ends.any():
            differ = np.ascontiguousarray((word[1:] ^ word[:-1])[ends[1:]].astype(">u8")).view(np.uint8).reshape(-1, 8)
            common[places[ends]] = 8 * depth + np.argmax(differ != 0, axis=1)
        common[places[equal]] = 8 * (depth + 1)
        depth += 1
        heads = np.flatnonzero(~equal)
        tails = np.append(heads[1:], len(equal))
        # A group whose rows have all ended is one of equal suffixes.
        going = (tails - heads > 1) & (np.maximum.reduceat(words[order[places]], heads) > depth)
        start, end = places[heads[going]], places[tails[going] - 1] + 1
    common[1:] = np.minimum(common[1:], np.minimum(sizes[order[1:]], sizes[order[:-1]]))
    return order, common


def hashes_of_runs(codes: np.ndarray, length: int) -> np.ndarray:
    """run_hashes of any number of codes."""
    parts = [run_hashes(codes[i : i + STARTS_AT_ONCE + length - 1], length) for i in range(0, max(1, len(codes) - length + 1), STARTS_AT_ONCE)]
    return np.concatenate(parts)


def equal_windows(data: bytes, starts: np.ndarray, window: int) -> np.ndarray:
    """Which of the windows at different ``starts`` have an equal among them. Hashes propose, bytes decide."""
    raw = np.frombuffer(data, np.uint8)
    h = hashes_of_runs(BYTE_CODES[raw], window)[starts]
    by = np.argsort(h, kind="stable")
    same = np.flatnonzero(h[by[1:]] == h[by[:-1]])
    left, right = starts[by[same]], starts[by[same + 1]]
    out = np.zeros(len(starts), bool)
    out[by[same]] = out[by[same + 1]] = True
    # Windows that follow a verified pair, one byte on in both places, need only their last byte compared.
    along = np.lexsort((left, right - left))
    left, right = left[along], right[along]
    follows = np.concatenate([[False], (np.diff(left) == 1) & (np.diff(right) == 1)]) if len(left) else np.zeros(0, bool)
    sound = bool((raw[left + window - 1] == raw[right + window - 1]).all())
    for i in np.flatnonzero(~follows):
        sound = sound and data[left[i] : left[i] + window] == data[right[i] : right[i] + window]
    if not sound:  # two different windows share a hash
        found: dict[bytes, int] = {}
        for s in starts.tolist():
            found[data[s : s + window]] = found.get(data[s : s + window], 0) + 1
        return np.array([found[data[s : s + window]] > 1 for s in starts.tolist()], bool)
    return out


def solve(contexts: list[bytes], anchors: np.ndarray, counts: np.ndarray, window: int) -> list[np.ndarray]:
    """For each context, which of its first windows occur in another context."""
    order, common = multikey_sorted([c[p:] for c, p in zip(contexts, anchors.tolist())])
    right = np.zeros(len(contexts), np.int64)
    right[order] = np.maximum(common, np.append(common[1:], 0))
    few = np.clip(anchors + right - window + 1, 0, counts)
    first = np.cumsum([0, *(len(c) for c in contexts[:-1])])
    ends = np.cumsum(few)
    starts = np.repeat(first - (ends - few), few) + np.arange(ends[-1])
    flags = np.zeros(0, bool)
    if len(starts):
        flags = equal_windows(b"".join(contexts), starts, window)
    return [np.append(flags[e - n : e], np.zeros(c - n, bool)).astype(np.int8) for e, n, c in zip(ends, few, counts)]


def placed_by(symbols: Symbols) -> Callable[[DataFrame], DataFrame]:
    """Ranges of the leading bytes of the suffixes, at splitters that Spark samples; whole keys, in order. Equal keys agree
    in a gram, so no more than a gram leads."""

    def place(contexts: DataFrame) -> DataFrame:
        lead = F.expr(f"substring(context, cast(p - a + 1 as int), {min(16, symbols.gram)})")
        rows = contexts.withColumn("lead", F.coalesce(lead, F.substring("key", 1, 16)))
        return rows.repartitionByRange("lead", "key").sortWithinPartitions("lead", "key").drop("lead")

    return place


def without_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, group: int = GROUP) -> tuple[DataFrame, DataFrame]:
    """(key, uid, n_bytes, sha256) for every row; and (uid, kept, n_symbols, n_removed, spans) for each different text
    from which something is removed."""
    symbols = byte_symbols(window)
    return removed(df, symbols, placed_by(symbols), lambda c, p, n: solve(c, p, n, window), key, text, group)


def report(df: DataFrame, window: int = WINDOW, group: int = GROUP) -> DataFrame:
    """Rows (doc_id, n_bytes, n_removed, n_spans, kept_sha256), one for each row of the table."""
    marks, texts = without_repeats(df, window=window, group=group)
    changed = texts.select("uid", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
    return marks.join(changed, "uid", "left").select(
        F.col("key").alias("doc_id"),
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "sha256").alias("kept_sha256"),
    )


def cleaned(df: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """The table with the repeated bytes taken out of its texts; characters that are cut apart go whole."""
    _, texts = without_repeats(df, key, text, window)
    uid = F.unhex(F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary"))).alias("uid")
    rows = df.select(F.struct("*").alias("row"), uid)

    def whole_characters(batches):  # each stretch by itself: ends of two cut characters make none
        for batch in batches:
            kept = []
            for data, n, spans in zip(*(batch.column(c).to_pylist() for c in ("kept", "n_symbols", "spans"))):
                cuts, at, stretches = [0, *(x for s in spans for x in (s["start"], s["end"])), n], 0, []
                for start, end in zip(cuts[::2], cuts[1::2]):
                    stretches.append(data[at : at + end - start].decode("utf-8", "ignore"))
                    at += end - start
                kept.append("".join(stretches))
            yield pa.RecordBatch.from_arrays([batch.column("uid"), pa.array(kept, pa.string())], ["changed", "kept"])

    changed = texts.filter("n_removed > 0").select("uid", "kept", "n_symbols", "spans")
    changed = changed.mapInArrow(whole_characters, "changed binary, kept string")
    out = rows.join(changed, rows["uid"] == changed["changed"], "left")
    whole = F.coalesce("kept", F.col("row").getField(text))
    return out.select(F.col("row").withField(text, whole).alias("row")).select("row.*")
