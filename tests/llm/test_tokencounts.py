import collections

import pytest

from panelspark.llm import bpe, tokencounts
from panelspark.llm.queries import QUERIES
from tests.llm.test_bpe import REFERENCE

TEXTS = ["Title here\nbody text, é日本\n more", "", None, "\n\n\n", "one line", "日本語" * 2000 + "\nx", "a\n  \n b", "Title here\nbody text, é日本\n more"]


def brute(fields, rule):
    """Counts and crossings of one document, token by token."""
    values = [f or "" for f in fields]
    parts = [v + "\n" for v in values]
    cut = parts[-1].index("\n") + 1
    parts[-1:] = [parts[-1][:cut], parts[-1][cut:]]
    section = [i for i, p in enumerate(parts) for _ in p]
    whole = "".join(parts)
    data, at = whole.encode(), 0
    owner = [i for i, c in enumerate(whole) for _ in c.encode()]
    counts, crossing = collections.Counter(), collections.Counter()
    for t in REFERENCE.encode_ordinary(whole):
        n = len(REFERENCE.decode_single_token_bytes(t))
        own = [section[c] for c in range(owner[at], owner[at + n - 1] + 1)]
        at += n
        if own[0] != own[-1]:
            crossing[own[0]] += 1
        if rule == "share":
            for s in own:
                counts[s] += 1 / len(own)
        elif rule == "majority":
            counts[max(sorted(set(own)), key=own.count)] += 1
        else:
            counts[own[0 if rule == "start" else -1]] += 1
    assert at == len(data)
    return [(len(p), round(counts[i], 6), crossing[i]) for i, p in enumerate(parts)]


@pytest.mark.parametrize("rule", tokencounts.RULES)
def test_equals_brute_force(docs, rule):
    out = tokencounts.token_counts(docs(TEXTS), rule=rule).collect()
    names = ["source", "lang", "text_first_line", "text_rest"]
    got = {(r.doc_id, r.section): (r.n_chars, round(r.n_tokens, 6), r.n_crossing) for r in out}
    want = {(i, n): v for i, t in enumerate(TEXTS) for n, v in zip(names, brute(("src0", "en", t), rule))}
    assert len(out) == 4 * len(TEXTS) and got == want


def test_query_counts_every_token_once(spark, docs, sf_dir):
    out = QUERIES["op9_token_counts"](spark, sf_dir(documents=docs(TEXTS)))
    total = {r.doc_id: r["sum(n_tokens)"] for r in out.groupBy("doc_id").sum("n_tokens").collect()}
    assert total == {i: len(REFERENCE.encode_ordinary(f"src0\nen\n{t or ''}\n")) for i, t in enumerate(TEXTS)}


def test_empty_table_and_wrong_rule(docs):
    assert tokencounts.token_counts(docs([])).count() == 0
    with pytest.raises(ValueError, match="rule"):
        tokencounts.token_counts(docs([]), rule="first")
    assert bpe.RANKS
