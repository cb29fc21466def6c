import hashlib
import itertools
import re
import zlib

import pytest

from panelspark.llm import dialogues
from panelspark.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
ROW = re.compile(r"(s?(ua)+)?")


def cheapest(rows):
    """(cost, audit, result) by trying all edits: for each row K, R or D, and up to two inserted rows before each and at
    the end. Rows are (role, text, fault)."""
    found = []
    for edits in itertools.product("DKR", repeat=len(rows)):
        if any(f in ("blank", "duplicate") and e != "D" for e, (_, _, f) in zip(edits, rows)):
            continue
        for gaps in itertools.product(("", "I", "II"), repeat=len(rows) + 1):
            audit = "".join(g + e for g, e in itertools.zip_longest(gaps, edits, fillvalue=""))
            cost, out = 0, []
            feed = iter(rows)
            for edit in audit:
                role, text, fault = next(feed) if edit != "I" else ("", "", "")
                if edit == "D":
                    cost += 3
                    continue
                state = out[-1][0][:1] if out else ""
                other = "assistant" if state == "u" else "user"
                out.append((role if edit == "K" else other, text))
                cost += {"K": 0, "R": 2, "I": 2}[edit] + (fault == "truncated")
            if ROW.fullmatch("".join(role[:1] or "?" for role, _ in out)):
                found.append((cost, audit, "\n".join(f"{r}:{t}" for r, t in out)))
    return min(found)


def brute(rows):
    """The contract row by row. ``rows``: (conv_id, turn, role, text) after damage, in order within their conversation."""
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn, role, text))
    out = {}
    for conv, members in convs.items():
        seen, marked = set(), []
        for _, role, text in members:
            rest = text.strip(" \t\n\x0b\x0c\r")
            if not rest:
                fault = "blank"
            elif (role, text) in seen:
                fault = "duplicate"
            else:
                fault = "" if rest[-1] in ".!?" else "truncated"
            seen.add((role, text))
            marked.append((role, text, fault))
        turns = [t for t, _, _ in members if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = zip(members, members[1:])
        illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in pairs)
        cost, audit, whole = cheapest(marked)
        count = lambda f: sum(m[2] == f for m in marked)
        digest = hashlib.sha256(whole.encode()).hexdigest()
        out[conv] = (conv, gaps, count("blank"), count("duplicate"), count("truncated"), illegal, cost, audit, digest)
    return out


def order(row):
    """Conversation, turn with nulls first, digest of role and text."""
    conv, turn, role, text = row
    digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
    return (conv is not None, conv or 0, turn is not None, turn or 0, digest)


def clean(rows):
    return sorted(((c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows), key=order)


CASES = [
    [("system", "a."), ("user", "b."), ("assistant", "c.")],
    [("user", "b."), ("user", "c.")],
    [("assistant", "b.")],
    [("user", "a."), ("assistant", "b."), ("assistant", "b."), ("user", "c")],
    [("user", "  \t"), ("assistant", "x"), ("system", "y!")],
    [("system", "a?")],
    [("system", "a."), ("system", "b.")],
    [(None, None), ("tool", "x."), ("user", "q?"), ("", "z.")],
    [("user", "hm \n"), ("user", "hm \n"), ("user", "hm")],
    [("User", "a."), ("ASSISTANT", "b.")],
    [("unknown", "a."), ("admin", "b.")],
]


def test_cheapest_edits_against_all_edits(spark, rows):
    given = [(i, t, r, x) for i, case in enumerate(CASES) for t, (r, x) in enumerate(case)]
    given += [(None, None, "user", "a."), (None, None, "assistant", "b"), (None, 3, None, None)]
    given += [(50, None, "user", "a."), (50, 9, "user", "c."), (50, 4, "assistant", "b."), (50, 4, "assistant", "b.")]
    df = spark.createDataFrame(given, SCHEMA).repartition(5)
    got = rows(dialogues.repair(df))
    want = brute(clean(given))
    assert {r[0]: r for r in got} == want and len(got) == len(want)


def test_random_conversations(spark, rows):
    import random

    rng = random.Random(4)
    given = []
    for conv in range(60):
        for turn in range(rng.randint(1, 4)):
            role = rng.choice(["user", "assistant", "system", "tool"])
            given.append((conv, turn, role, rng.choice(["yes.", "no", "well!", " ", ""])))
    got = rows(dialogues.repair(spark.createDataFrame(given, SCHEMA).repartition(7)))
    assert {r[0]: r for r in got} == brute(clean(given))


def test_automaton_makes_each_suffix_once():
    signatures = [b"sua", b"ua", b"uua", b"Ua", b"dua", b"ua", b"a", b"", b"oaua", b"suaua"]
    own, found = dialogues.Automaton(), {}
    for s in sorted({x[::-1] for x in signatures}):
        own.follow(s)
        found[s[::-1]] = own.best()
    suffixes = {x[i:] for x in signatures for i in range(len(x) + 1)}
    assert own.made == len(suffixes)
    for s, (cost, audit) in found.items():
        role = {"s": "system", "u": "user", "a": "assistant", "o": "tool", "d": "user"}
        members = [(role[c.lower()], f"{i}", "blank" if c == "d" else "truncated" if c.isupper() else "") for i, c in enumerate(s.decode())]
        assert (cost, audit) == cheapest(members)[:2]


def test_audits_do_not_depend_on_ranges(spark, rows):
    import random

    rng = random.Random(9)
    signatures = [("".join(rng.choice("suadoSUA") for _ in range(rng.randint(0, 40))).encode(),) for _ in range(300)]
    df = spark.createDataFrame(signatures, "signature binary")
    got = {bytes(s): (c, a) for s, c, a in rows(dialogues.audits(df))}
    own, alone = dialogues.Automaton(), {}
    for (s,) in signatures:
        own.follow(s[::-1])
        alone[s] = own.best()
    assert got == alone


def test_copies_dropped_rows_and_empty_tables(spark, rows):
    given = [(1, 0, "user", "a.", 0), (2, 0, "user", "a.", 1), (2, 1, "assistant", "b.", 3), (3, 5, "user", "x", 0), (3, 6, "user", "", 0)]
    df = spark.createDataFrame(given, f"{SCHEMA}, n int")
    nothing = hashlib.sha256(b"").hexdigest()
    kept = hashlib.sha256(b"user:a.\nassistant:b.").hexdigest()
    assert rows(dialogues.repair(df, copies=df.n)) == [
        (1, 0, 0, 0, 0, 0, 0, "", nothing),
        (2, 0, 0, 2, 0, 2, 6, "KKDD", kept),
        (3, 0, 0, 0, 0, 0, 0, "", nothing),
    ]
    empty = spark.createDataFrame([], SCHEMA)
    assert rows(dialogues.repair(empty)) == []
    assert rows(dialogues.repair(*(lambda d, c: (d,))(*dialogues.damaged(empty)))) == []


def test_long_conversation_and_clashing_names(spark, rows):
    given = [(7, i, ("user", "assistant")[i % 2], "x" * 50_000 + f"{i}.") for i in range(400)]
    given += [(8, i, "user", "same.") for i in range(2000)]
    df = spark.createDataFrame(given, SCHEMA)
    for name in ("copies", "digest", "part", "audit", "kind", "first", "c", "d", "signature"):
        df = df.withColumn(name, df.text)
    got = {r[0]: r for r in rows(dialogues.repair(df))}
    assert got[7][1:8] == (0, 0, 0, 0, 0, 0, "K" * 400)
    whole = "\n".join(f"{r}:{t}" for _, _, r, t in given[:400])
    assert got[7][8] == hashlib.sha256(whole.encode()).hexdigest()
    assert got[8][1:7] == (0, 0, 1999, 0, 1999, 3 * 1999 + 2) and len(got[8][7]) == 2001


@pytest.fixture()
def damaged_brute():
    def run(given):
        out = []
        for conv, turn, role, text in given:
            role, text = (" " if v is None else v for v in (role, text))
            kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            row = (conv, turn, "user" if kind == 4 else role, text)
            out += [row] * {0: 0, 3: 2}.get(kind, 1)
        return out

    return run


def test_query_damages_and_repairs(spark, rows, sf_dir, damaged_brute):
    given = [(i // 4, i % 4, ("user", "assistant")[i % 2], f"Text {i}. Is it?") for i in range(240)]
    given += [(None, None, None, None), (90, None, "user", "a."), (91, 2, None, "b!"), (92, 3, "user", None)]
    df = spark.createDataFrame(given, SCHEMA)
    got = {r[0]: r for r in rows(QUERIES["op11_dialogues"](spark, sf_dir(conversations=df)))}
    assert set(got) == {r[0] for r in given}
    want = brute(clean(damaged_brute(given)))
    for conv, row in got.items():
        assert row == want.get(conv, (conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()))
