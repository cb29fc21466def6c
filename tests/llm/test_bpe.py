import base64
import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from panelspark.llm import bpe
from panelspark.llm.queries import QUERIES


def reference():
    with open(bpe.RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


REFERENCE = reference()
ODD = ["", None, "a", "  ", "don't we'll I'S", "é" * 3000, "naïve ½ Ⅷ 𝒳 日本語 \x85\x1c\xa0 x", "<|endoftext|>", "a" * 20000, "x\n\n  y", "= " * 50]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=4))
def test_ids_are_those_of_tiktoken(texts):
    ids, at = bpe.codec().encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [REFERENCE.encode_ordinary(t) for t in texts]
    assert bpe.codec().decode(ids) == "".join(texts).encode()


def test_another_pattern():
    pattern = r"[^\r\n\p{L}\p{N}]?\p{L}+|\p{N}{1,3}| ?[^\s\p{L}\p{N}]+[\r\n]*|\s+"
    other = tiktoken.Encoding("other", pat_str=pattern, mergeable_ranks=REFERENCE._mergeable_ranks, special_tokens={})
    texts = ["It's 12345 (é) naïve\n\n  x", "日本 ½"]
    ids, at = bpe.codec(bpe.RANKS, pattern).encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [other.encode_ordinary(t) for t in texts]


def test_query_matches_digests(docs, sf_dir, spark, rows):
    out = QUERIES["op3_byte_bpe"](spark, sf_dir(documents=docs(ODD)))
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for i, t in enumerate(ODD):
        ids = REFERENCE.encode_ordinary(t or "")
        want.append((i, len(ids), sha(" ".join(map(str, ids)).encode()), sha((t or "").encode())))
    assert rows(out) == want


def test_offsets_and_decoding(docs):
    encoded = bpe.encode(docs(ODD), offsets=True)
    back = {r.doc_id: bytes(r.decoded) for r in bpe.decode(encoded).collect()}
    for r in encoded.collect():
        text = ODD[r.doc_id] or ""
        data = text.encode()
        assert back[r.doc_id] == data
        pieces = [REFERENCE.decode_single_token_bytes(i) for i in r.ids]
        starts = [sum(map(len, pieces[:k])) for k in range(len(pieces))] if len(pieces) < 200 else r.byte_starts
        assert list(r.byte_starts) == list(starts)
        if len(pieces) < 200:
            assert list(r.char_starts) == [len(data[:s].decode(errors="ignore")) for s in starts]


def test_empty_table_and_unknown_ids(spark, docs):
    assert bpe.encode(docs([])).count() == 0
    with pytest.raises(Exception, match="no token"):
        bpe.decode(spark.createDataFrame([(1, [50256])], "doc_id long, ids array<int>")).collect()
