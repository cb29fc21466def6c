"""Token counts of the fields and sections of a document, from one encoding of the whole.

The fields are put together into one text, each ended by a line break, and that text is encoded once. Token spans are
then joined with section spans: both are sorted intervals over the same characters, so the join is one search. A token
that crosses a border goes where the rule says:

- ``start``: the section of its first character (a character that several tokens share counts for each of them);
- ``end``: the section of its last character;
- ``majority``: the section with most of its characters, the first of them at a tie;
- ``share``: to every section by its share of the characters.

The last field may be cut into sections of its own: its first line and the rest. Defined results: a null field counts as
empty; a section without characters has no tokens; repeated rows each get their rows; extra columns are left behind.
"""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm import bpe

RULES = ("start", "end", "majority", "share")


def allotted(first: np.ndarray, last: np.ndarray, bounds: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """For each section, its tokens by the rule and the tokens that cross its end.

    ``first`` and ``last`` are the first and last characters of the tokens; sections start at bounds[:-1], in order.
    """
    n = len(bounds) - 1
    low = np.searchsorted(bounds, first, "right") - 1
    high = np.searchsorted(bounds, last, "right") - 1
    crossing = low != high
    crossed = np.bincount(low[crossing], minlength=n)
    if rule in ("start", "end"):
        return np.bincount(low if rule == "start" else high, minlength=n).astype(float), crossed
    counts = np.bincount(low[~crossing], minlength=n).astype(float)
    for a, b, s, e in zip(first[crossing], last[crossing], low[crossing], high[crossing]):
        cuts = np.clip(bounds[s : e + 2], a, b + 1)
        parts = np.diff(cuts) / (b + 1 - a)
        if rule == "share":
            counts[s : e + 1] += parts
        else:
            counts[s + int(np.argmax(parts))] += 1
    return counts, crossed


def token_counts(
    df: DataFrame,
    key: str = "doc_id",
    fields: tuple[str, ...] = ("source", "lang", "text"),
    first_line: bool = True,
    rule: str = "start",
    ranks_path: str = bpe.RANKS,
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """Rows (key, section, n_chars, n_tokens, n_crossing): for each row of the table its fields in order, and with
    ``first_line`` the last field as ``<field>_first_line`` and ``<field>_rest``."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {', '.join(RULES)}")
    sections = [*fields[:-1], *([f"{fields[-1]}_first_line", f"{fields[-1]}_rest"] if first_line else fields[-1:])]
    columns = [f"f{i}" for i in range(len(fields))]

    def spans(values: list[str]) -> list[str]:
        out = [v + "\n" for v in values]
        if first_line:
            cut = out[-1].index("\n") + 1
            out[-1:] = [out[-1][:cut], out[-1][cut:]]
        return out

    def run(batches):
        own = bpe.codec(ranks_path, pattern)
        for whole in batches:
            for batch in bpe.parts(whole, columns[-1]):
                given = zip(*(batch.column(c).to_pylist() for c in columns))
                split = [spans([v or "" for v in row]) for row in given]
                texts = ["".join(s) for s in split]
                ids, _ = own.encode(texts)
                ends = own.byte_ends(ids)
                characters = bpe.character_of_byte("".join(texts).encode())
                first, last = characters[ends - own.length[ids]], characters[ends - 1]
                sizes = np.array([len(part) for row in split for part in row], np.int64)
                bounds = np.concatenate([[0], np.cumsum(sizes)])
                counts, crossed = allotted(first, last, bounds, rule)
                keys = batch.column("key").take(pa.array(np.repeat(np.arange(batch.num_rows), len(sections))))
                names = pa.array(sections * batch.num_rows, pa.string())
                arrays = [keys, names, pa.array(sizes), pa.array(counts), pa.array(crossed.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(arrays, ["key", "section", "n_chars", "n_tokens", "n_crossing"])

    rows = df.select(F.col(key).alias("key"), *(F.col(f).cast("string").alias(c) for f, c in zip(fields, columns)))
    kind = rows.schema["key"].dataType.simpleString()
    out = rows.mapInArrow(run, f"key {kind}, section string, n_chars long, n_tokens double, n_crossing long")
    return out.withColumnRenamed("key", key)
