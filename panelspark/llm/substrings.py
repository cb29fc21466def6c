"""Substring deduplication: words covered by a window of words that also starts anywhere else.

Suffixes start at content-sampled anchors (see ``repeats``) and are grouped by a prefix of words: the gram of the
anchor, or, where a gram is too frequent for one task, a longer prefix that is common to a block of windows, so prefixes
have as many words as it takes for a group to fit in memory. Prefix doubling replaces the groups' suffix trees: runs of
1, 2, 4 .. words are numbered level by level over all contexts of a batch, and runs that occur once are not followed. A
run of a window's length that occurs twice is what a deep internal node would show; longer repeats are not built.

Words are compared as words, never by hash alone. Defined results: matches never cross documents; a null text has no
words; repeated rows are copies of each other; texts of fewer words than the window are left alone.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.repeats import GROUP, Symbols, removed

WINDOW = 35


def word_symbols(window: int = WINDOW) -> Symbols:
    gram = max(1, window // 5)
    return Symbols(window, gram, tuple(b for b in (6,) if b < window - gram + 1) + (1,), words=True)


def deep_nodes(words: np.ndarray, ends: np.ndarray, depth: int) -> np.ndarray:
    """For each place, the node of the subtree at ``depth`` words that its suffix passes through; -1 where the suffix is
    shorter, or shares no node of more than one leaf.

    ``ends`` says where the text of each place ends. A level doubles the depth: a node's children are the pairs of the
    nodes at a place and as many words on.
    """
    node, reached = words.astype(np.int64), 1
    at = np.arange(len(words))
    while reached < depth:
        step = min(reached, depth - reached)
        live = at[(node >= 0) & (at + reached + step <= ends)]
        live = live[node[live + step] >= 0]
        below = np.full(len(words), -1, np.int64)
        if len(live):
            pair = node[live] * (int(node.max()) + 1) + node[live + step]
            _, child, leaves = np.unique(pair, return_inverse=True, return_counts=True)
            below[live] = np.where(leaves[child] > 1, child, -1)
        node, reached = below, reached + step
    return node


def solve(contexts: list[bytes], anchors: np.ndarray, counts: np.ndarray, window: int) -> list[np.ndarray]:
    """For each context, which of its first windows occur in another context."""
    split = [c.split() for c in contexts]
    sizes = np.array([len(s) for s in split], np.int64)
    numbers: dict[bytes, int] = {}
    words = np.fromiter((numbers.setdefault(w, len(numbers)) for s in split for w in s), np.int64, int(sizes.sum()))
    ends = np.cumsum(sizes)
    node = deep_nodes(words, np.repeat(ends, sizes), window)
    # A node counts if two windows of the contexts' own ranges pass through it.
    totals = np.cumsum(counts)
    starts = np.repeat(ends - sizes - (totals - counts), counts) + np.arange(totals[-1])
    own = node[starts]
    _, inverse, leaves = np.unique(own, return_inverse=True, return_counts=True)
    flags = ((own >= 0) & (leaves[inverse] > 1)).astype(np.int8)
    return np.split(flags, totals[:-1])


def place(contexts: DataFrame) -> DataFrame:
    return contexts.repartition("key").sortWithinPartitions("key")


def without_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, group: int = GROUP) -> tuple[DataFrame, DataFrame]:
    """(key, uid, n_bytes, sha256) for every row; and (uid, kept, n_symbols, n_removed, spans) for each different text."""
    return removed(df, word_symbols(window), place, lambda c, p, n: solve(c, p, n, window), key, text, group)


def report(df: DataFrame, window: int = WINDOW, group: int = GROUP) -> DataFrame:
    """Rows (doc_id, n_words, n_removed, kept_sha256), one for each row of the table."""
    marks, texts = without_repeats(df, window=window, group=group)
    every = texts.select("uid", F.col("n_symbols").alias("n_words"), "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
    return marks.join(every, "uid").select(F.col("key").alias("doc_id"), "n_words", "n_removed", "kept_sha256")
