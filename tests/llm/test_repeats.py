import collections
import hashlib
import itertools
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from panelspark.llm import repeats, substrings, suffixarray
from panelspark.llm.queries import QUERIES


def brute(texts, window, words):
    """(symbols, removed, maximal runs, digest of the rest) of each text."""
    split = [(t or "").encode().split() if words else (t or "").encode() for t in texts]
    piece = (lambda u, i: tuple(u[i : i + window])) if words else (lambda u, i: u[i : i + window])
    counts = collections.Counter(piece(u, i) for u in split for i in range(len(u) - window + 1))
    out = []
    for u in split:
        gone = [False] * len(u)
        for i in range(len(u) - window + 1):
            if counts[piece(u, i)] > 1:
                gone[i : i + window] = [True] * window
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = b" ".join(w for w, g in zip(u, gone) if not g) if words else bytes(b for b, g in zip(u, gone) if not g)
        out.append((len(u), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed, unit, n=60):
    """Texts that share passages of many lengths at many places, with copies, near copies and runs of one word."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randrange(1, 7)))
    passages = [" ".join(word() for _ in range(r.randrange(unit // 2, 3 * unit))) for _ in range(6)]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(r.randrange(1, 5)):
            parts.append(" ".join(word() for _ in range(r.randrange(2 * unit))))
            p = r.choice(passages)
            cut = r.randrange(len(p) // 2)
            parts.append(p[cut : len(p) - r.randrange(len(p) // 2)])
        texts.append("\n".join(parts))
    near = texts[0].split(" ")
    for _ in range(40):
        some = list(near)
        some[r.randrange(len(some))] = word()
        texts.append(" ".join(some))
    return [*texts, texts[1], texts[2], texts[2], "ab " * 5 * unit, "ba " * 3 * unit, "a" * 20 * unit, "", None, " ", "x", "é" * 7 * unit]


@pytest.mark.parametrize("group", [repeats.GROUP, 6])
def test_bytes_equal_brute_force(docs, group):
    texts = corpus(5, 40)
    out = {r.doc_id: tuple(r)[1:] for r in suffixarray.report(docs(texts), window=60, group=group).collect()}
    assert out == dict(enumerate(brute(texts, 60, False)))


@pytest.mark.parametrize("group", [repeats.GROUP, 6])
def test_words_equal_brute_force(docs, group):
    texts = corpus(6, 20)
    out = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substrings.report(docs(texts), window=10, group=group).collect()}
    assert out == {i: (n, g, sha) for i, (n, g, _, sha) in enumerate(brute(texts, 10, True))}


def test_queries_equal_brute_force(spark, docs, sf_dir):
    texts = corpus(7, 100, 30)
    texts += [texts[0], texts[0], texts[4], texts[4]]
    folder = sf_dir(documents=docs(texts, [*range(len(texts) - 6), None, 3, 0, 0, None, None]))
    got = sorted((tuple(r)[1:] for r in QUERIES["op6_suffix_array"](spark, folder).collect()), key=str)
    assert got == sorted(brute(texts, 400, False), key=str)
    got = sorted((tuple(r)[1:] for r in QUERIES["op10_substrings"](spark, folder).collect()), key=str)
    assert got == sorted(((n, g, sha) for n, g, _, sha in brute(texts, 35, True)), key=str)


def test_cleaned_texts_keep_rows_and_columns(docs):
    texts = ["é" + "x" * 50 + "日本" + str(i) for i in range(3)] + [None, "short"]
    table = docs(texts)
    out = {r.doc_id: r for r in suffixarray.cleaned(table, window=40).collect()}
    assert len(out) == 5 and suffixarray.cleaned(table, window=40).columns == table.columns
    assert [out[i].text for i in range(5)] == ["0", "1", "2", None, "short"]


def test_cleaned_texts_keep_their_own_replacement_characters(docs):
    texts = ["\ufffdé" + "x" * 50 + "日本" + str(i) + "\ufffd" for i in range(2)] + [b.decode() for b in ("a\ufffdè".encode() + b"y" * 50, "b\ufffdé".encode() + b"y" * 50)]
    out = {r.doc_id: r.text for r in suffixarray.cleaned(docs(texts), window=40).collect()}
    assert out == {0: "0\ufffd", 1: "1\ufffd", 2: "a\ufffdè", 3: "b\ufffdé"}


def test_ends_of_two_cut_characters_make_none(docs):
    """Texts that share all but the first and the last byte keep C3 and A8, and C4 and A8, of different characters."""
    between = "\u00e9" + "y" * 60 + "\u00e8"  # C3 A9 .. C3 A8
    other = "\u0129" + "y" * 60 + "\u00e9"  # C4 A9 .. C3 A9
    assert between.encode()[1:-1] == other.encode()[1:-1]
    out = {r.doc_id: r.text for r in suffixarray.cleaned(docs([between, other]), window=40).collect()}
    assert out == {0: "", 1: ""}


@pytest.mark.parametrize("window", [4, 20, 33])
def test_small_windows_over_many_partitions(spark, docs, window):
    texts = corpus(window, 12)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        out = {r.doc_id: tuple(r)[1:] for r in suffixarray.report(docs(texts), window=window).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert out == dict(enumerate(brute(texts, window, False)))


def test_columns_that_clash(docs):
    df = docs(["a" * 60 + "1", "a" * 60 + "2", None])
    for name in ("uid", "__uid", "__kept", "kept", "changed", "row", "spans"):
        df = df.withColumn(name, df.text)
    out = suffixarray.cleaned(df, window=40)
    assert out.columns == df.columns
    assert sorted((r.doc_id, r.text, r.kept and len(r.kept)) for r in out.collect()) == [(0, "1", 61), (1, "2", 61), (2, None, None)]


def test_empty_table(docs):
    assert suffixarray.report(docs([])).count() == 0
    assert substrings.report(docs([])).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(max_size=40) | st.text("ab", max_size=40).map(str.encode), min_size=1, max_size=30))
def test_multikey_order(suffixes):
    order, common = suffixarray.multikey_sorted(suffixes)
    padded = [s + bytes(80 - len(s)) for s in suffixes]
    ordered = [padded[i] for i in order]
    assert sorted(order) == list(range(len(suffixes))) and ordered == sorted(padded)
    for k in range(1, len(order)):
        a, b = suffixes[order[k - 1]], suffixes[order[k]]
        same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert common[k] == same


@pytest.mark.parametrize("rows", list(itertools.permutations(range(3))))
def test_shorter_contexts_between_those_that_end_in_nul(rows):
    passage = bytes(random.Random(3).choices(range(97, 123), k=405)) + bytes(95)
    contexts = [(passage[:450], passage[:410], passage[:450])[i] for i in rows]
    counts = np.array([len(c) - 399 for c in contexts])
    assert [int(flags.sum()) for flags in suffixarray.solve(contexts, np.full(3, 50), counts, 400)] == counts.tolist()


def test_texts_with_nul_equal_brute_force(docs):
    r, texts = random.Random(8), []
    for i in range(60):
        passage = "".join(r.choices("abcdefgh", k=62)) + "\0" * 20
        texts += [passage, f"{i}{passage}", f"{i} {passage[: 64 + r.randrange(10)]}x"]
    out = {row.doc_id: tuple(row)[1:] for row in suffixarray.report(docs(texts), window=60).collect()}
    assert out == dict(enumerate(brute(texts, 60, False)))


def test_sliding_minimum_and_anchors(monkeypatch):
    r = np.random.default_rng(2)
    values = r.integers(0, 50, 200).astype(np.uint64)
    assert (repeats.sliding_min(values, 7) == [values[i : i + 7].min() for i in range(194)]).all()
    symbols = suffixarray.byte_symbols(20)
    data = r.integers(97, 100, 700).astype(np.uint8).tobytes()
    whole = [np.concatenate(c) for c in zip(*symbols.anchors(data))]
    assert sum(whole[3] - whole[2] + 1) == len(data) - 19
    monkeypatch.setattr(repeats, "STARTS_AT_ONCE", 64)
    parts = [np.concatenate(c) for c in zip(*symbols.anchors(data))]
    spread = lambda x: [(h, p) for h, p, a, b in zip(*x) for _ in range(a, b + 1)]
    assert spread(whole) == spread(parts)


def test_equal_hashes_of_different_windows_are_told_apart(monkeypatch):
    monkeypatch.setattr(suffixarray, "hashes_of_runs", lambda codes, length: np.zeros(len(codes) - length + 1, np.uint64))
    data = b"abcdxxabcdyy"
    assert suffixarray.equal_windows(data, np.arange(9), 4).tolist() == [True, False, False, False, False, False, True, False, False]
