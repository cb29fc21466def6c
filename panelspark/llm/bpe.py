"""Byte-level BPE over Arrow batches: ids, byte and character offsets, and decoding.

The tokenizers library is built from a rank file (base64 token, rank). Every pair of tokens whose bytes join to a token
is a merge whose priority is the rank of the result, which is how rank files are meant to be read.

Defined results: a null text counts as empty and has no tokens; ids unknown to the table make decoding fail with
``ValueError``; a token may end inside a character, and decoding joins bytes before it turns them into text.
"""

from __future__ import annotations

import base64
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Bytes of text encoded in one call, so that the memory of a task does not depend on the rows of a batch.
CALL_BYTES = 1 << 20
#: Pieces that a worker remembers before it starts anew.
KNOWN_PIECES = 1 << 19


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself where it is printable, else one from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(others)) for b in range(256)]


def taken(pool: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The stretches pool[first : first + count], one after another."""
    ends = np.cumsum(count)
    total = int(ends[-1]) if len(ends) else 0
    return pool[np.repeat(first - (ends - count), count) + np.arange(total)]


def narrow_pattern(pattern: str) -> re.Pattern | None:
    """The usual pattern for texts of characters below 256, its classes written out, for the plain regex module; none for
    any other pattern, whose classes may not be as simple."""
    if pattern != public_tokenizers.PATTERN:
        return None
    named = lambda kind: "".join(re.escape(chr(c)) for c in range(256) if unicodedata.category(chr(c))[0] == kind)
    blank = "".join(re.escape(chr(c)) for c in range(256) if regex.match(r"\s", chr(c)))
    out = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{blank}{named('L')}{named('N')}]")
    out = out.replace(r"\p{L}", f"[{named('L')}]").replace(r"\p{N}", f"[{named('N')}]")
    return re.compile(out.replace(r"\S", f"[^{blank}]").replace(r"\s", f"[{blank}]"))


class Codec:
    """Encoder and decoder of one rank file, split by one pattern.

    Pieces of the pattern that were met before are looked up; the library encodes the others.
    """

    def __init__(self, ranks_path: str, pattern: str):
        from tokenizers import Tokenizer, models, pre_tokenizers

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        size = max(ranks.values()) + 1
        self.length = np.zeros(size, np.int64)
        for t, i in ranks.items():
            self.length[i] = len(t)
        in_order = sorted(ranks, key=ranks.__getitem__)
        self.bytes = np.frombuffer(b"".join(in_order), np.uint8)
        self.first = np.cumsum(self.length) - self.length
        shown = byte_characters()
        text = {t: "".join(map(shown.__getitem__, t)) for t in ranks}
        merges = [
            (text[t[:k]], text[t[k:]]) for t in in_order for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks
        ]
        self.library = Tokenizer(models.BPE({text[t]: i for t, i in ranks.items()}, merges, fuse_unk=False))
        self.library.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.wide, self.narrow = regex.compile(pattern), narrow_pattern(pattern)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.pool, self.used = np.empty(1 << 16, np.int32), 0
        self.at, self.n = np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int64)

    def split(self, text: str) -> list[str]:
        if self.narrow:
            try:
                text.encode("latin-1")
                return self.narrow.findall(text)
            except UnicodeEncodeError:
                pass
        return self.wide.findall(text)

    def learn(self, pieces: list[str]) -> None:
        found = self.library.encode_batch_fast([pieces], is_pretokenized=True, add_special_tokens=False)[0]
        ids = np.array(found.ids, np.int32)
        bounds = np.cumsum([len(p.encode()) for p in pieces])  # no token crosses the end of a piece
        counts = np.diff(np.searchsorted(np.cumsum(self.length[ids]), bounds, "right"), prepend=0)
        k, n, end = len(self.known), len(pieces), self.used + len(ids)
        if k + n > len(self.at):
            self.at, self.n = np.resize(self.at, 2 * (k + n)), np.resize(self.n, 2 * (k + n))
        if end > len(self.pool):
            self.pool = np.resize(self.pool, 2 * end)
        self.pool[self.used : end] = ids
        self.n[k : k + n] = counts
        self.at[k : k + n] = self.used + np.cumsum(counts) - counts
        self.used = end
        self.known.update(zip(pieces, range(k, k + n)))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and where each text's ids begin and the last end."""
        if len(self.known) > KNOWN_PIECES or self.used > 8 * KNOWN_PIECES:
            self.forget()
        pieces = [self.split(t) for t in texts]
        flat = list(chain.from_iterable(pieces))
        if new := set(flat).difference(self.known):
            self.learn(list(new))
        k = np.fromiter(map(self.known.__getitem__, flat), np.int64, len(flat))
        counts = self.n[k]
        ends = np.concatenate([[0], np.cumsum(counts)])
        offsets = ends[np.concatenate([[0], np.cumsum([len(p) for p in pieces])]).astype(np.int64)]
        return taken(self.pool, self.at[k], counts), offsets

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids by the reversed table; a character split over tokens becomes whole again here."""
        ids = np.asarray(ids, np.int64)
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.length) or not self.length[ids].all()):
            raise ValueError("an id has no token")
        return taken(self.bytes, self.first[ids], self.length[ids]).tobytes()

    def byte_ends(self, ids: np.ndarray) -> np.ndarray:
        return np.cumsum(self.length[ids])


def character_of_byte(data: bytes) -> np.ndarray:
    """The character that each byte of a UTF-8 text belongs to, and at the end the number of characters."""
    raw = np.frombuffer(data, np.uint8)
    out = np.empty(len(raw) + 1, np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=out[:-1])
    out[:-1] -= 1
    out[-1] = out[-2] + 1 if len(raw) else 0
    return out


@lru_cache(maxsize=4)
def codec(ranks_path: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> Codec:
    """One codec for each worker process."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the cores
    return Codec(ranks_path, pattern)


def parts(batch: pa.RecordBatch, column: str, most: int = CALL_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about ``most`` bytes of one text column, one row at least."""
    if batch.num_rows:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        cuts = [0, *(np.flatnonzero(np.diff(sizes // most)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def _lists(flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat.astype(np.int32)))


def encode(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    ranks_path: str = RANKS,
    pattern: str = public_tokenizers.PATTERN,
    offsets: bool = False,
    decoded: bool = False,
) -> DataFrame:
    """Rows (key, ids); with ``offsets`` also the first byte and the first character of every token, and with
    ``decoded`` the bytes that the ids decode to. Other columns are left behind."""

    def run(batches):
        own = codec(ranks_path, pattern)
        for whole in batches:
            for batch in parts(whole, "text"):
                texts = [t or "" for t in batch.column("text").to_pylist()]
                ids, at = own.encode(texts)
                out = [batch.column("key"), _lists(ids, at)]
                ends = np.concatenate([[0], own.byte_ends(ids)])
                if offsets:
                    data = "".join(texts).encode()
                    row = np.repeat(np.arange(len(texts)), np.diff(at))
                    chars = character_of_byte(data)
                    out.append(_lists(ends[:-1] - ends[at[:-1]][row], at))
                    out.append(_lists(chars[ends[:-1]] - chars[ends[at[:-1]]][row], at))
                if decoded:
                    cuts = pa.py_buffer(ends[at].astype(np.int32).tobytes())
                    data = pa.py_buffer(own.decode(ids))
                    out.append(pa.Array.from_buffers(pa.binary(), len(texts), [None, cuts, data]))
                yield pa.RecordBatch.from_arrays(out, names)
        own.forget()  # the worker may go on to tasks of another kind

    names = ["key", "ids"] + ["byte_starts", "char_starts"] * offsets + ["decoded"] * decoded
    rows = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    more = ", byte_starts array<int>, char_starts array<int>" * offsets + ", decoded binary" * decoded
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, ids array<int>{more}").withColumnRenamed("key", key)


def decode(df: DataFrame, key: str = "doc_id", ids: str = "ids", ranks_path: str = RANKS) -> DataFrame:
    """Rows (key, decoded): the bytes of the ids, put together before anything reads them as text. Null ids are none."""

    def run(batches):
        own = codec(ranks_path)
        for batch in batches:
            rows = [own.decode(i or ()) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(rows, pa.binary())], ["key", "decoded"])

    rows = df.select(F.col(key).alias("key"), F.col(ids).alias("ids"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, decoded binary").withColumnRenamed("key", key)


def digests(df: DataFrame) -> DataFrame:
    """From encoded rows with decoded bytes: n_tokens, ids_sha256 over decimal ids joined by one space, decoded_sha256."""
    joined = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return df.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined, 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
