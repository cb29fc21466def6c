import collections
import itertools
import math
import random
import re

import pytest

from panelspark.llm import decontam
from panelspark.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def template(text):
    """(what stands in the template, value of a slot, whether it is a capitalised sentence start), word by word."""
    out, before = [], "end"
    for t in re.findall(r"\d+(?:[.,]\d+)*|[^\W\d_]+|[.!?\n]", text or ""):
        if t in ".!?\n":
            before = "end"
            continue
        low = t.lower()
        if t[0].isdigit() or low in decontam.NUMBER_WORDS:
            out.append(("<number>", low, False))
            before = "number"
            continue
        if len(t) > 1 and t[0].isupper() and t[1:].islower():
            out.append((low, None, True) if before == "end" else ("<name>", low, False))
        elif low in decontam.UNITS and before == "number":
            out.append(("<unit>", low, False))
        else:
            out.append((low, None, False))
        before = "word"
    return out


def grams(text, widths=None):
    """(whole, reading, values, place) of the windows of the widths, or of an item: five words, or all there are. A
    reading takes some capitalised sentence starts as names; ``whole`` is the one that takes none."""
    words = template(text)
    for n in widths or {min(5, len(words))}:
        for i in range(len(words) - n + 1 if words else 0):
            some = words[i : i + n]
            whole = tuple(w for w, _, _ in some)
            starts = [k for k, (_, _, start) in enumerate(some) if start]
            for names in itertools.chain.from_iterable(itertools.combinations(starts, k) for k in range(len(starts) + 1)):
                reading = [("<name>", some[k][0]) if k in names else some[k][:2] for k in range(n)]
                if sum(v is None for _, v in reading) >= 2 and sum(v is None for _, v, _ in some) >= 2:
                    yield whole, tuple(w for w, _ in reading), tuple(v for _, v in reading if v is not None), i


def brute(docs, items, least=0.8):
    """The rule pair by pair. Rows of one document, or of one item, count together."""
    own, index = collections.defaultdict(list), collections.defaultdict(list)
    lengths = {text: len(template(text)) for _, text in items}
    for item, text in items:
        own[item] += [(*g, text) for g in grams(text)]
    widths = {len(g[0]) for gs in own.values() for g in gs}
    for key, text in docs:
        index[key] += [(*g, text) for g in grams(text, widths or {5})]
    out = []
    for item, of_item in own.items():
        total = len({g[0] for g in of_item})
        by_reading = collections.defaultdict(list)
        for g in of_item:
            by_reading[g[1]].append(g)
        for key, of_doc in index.items():
            met = [(i, d) for d in of_doc for i in by_reading.get(d[1], ())]
            if not total or len({i[0] for i, _ in met}) / total < least:
                continue
            plain = {i[0] for i, _ in met if not i[2]}
            rows = [(i[0] == i[1] and d[0] == d[1], i[0], i[2], d[2], (d[4], i[4]), d[3] - i[3], lengths[i[4]]) for i, d in met if i[2]]
            for literal_only in (True, False):
                every = [r[1:] for r in rows if r[0] or not literal_only]
                n, differs = occurrence(every, plain)
                n += len(plain)
                if n / total >= least:
                    out.append((key, item, total, n, n / total, differs))
                    break
    return sorted(out, key=str)


def occurrence(rows, plain):
    """Mappings are made from all windows with values, and windows that also meet without values do not count again."""
    groups = collections.defaultdict(set)
    for whole, own, other, texts, off, length in rows:
        for place in (None, (texts, "at", off), (texts, "low", off // length), (texts, "high", math.floor(off / length + 0.5))):
            groups[place].add((whole, own, other))
    found = [(0, False)]
    for members in groups.values():
        counts = collections.Counter(p for _, own, other in members for p in zip(own, other))
        best = lambda side, v: min((-c, p[1 - side]) for p, c in counts.items() if p[side] == v)[1]
        good = [m for m in members if m[0] not in plain and all(best(0, s) == d and best(1, d) == s for s, d in zip(m[1], m[2]))]
        found.append((-len({m[0] for m in good}), any(m[1] != m[2] for m in good)))
    n, differs = min(found)
    return -n, differs


QUESTION = "Anyone can see how Mary had 12 apples and 3 kg of pears when Mary met John. How many apples did Mary give to John?"
OTHER = "Anyone can see how Lucy had 70 apples and 9 lb of pears when Lucy met Paul. How many apples did Lucy give to Paul?"
MIXED = "Anyone can see how Lucy had 70 apples and 9 lb of pears when Anna met Carl. How many apples did Berta give to Paul?"
ITEMS = [(0, QUESTION), (1, "alpha beta gamma delta epsilon zeta eta theta"), (2, None), (3, ""), (4, "12 13 14 15 16"), (5, "few words here"), (5, "few words here")]
TEXTS = [
    "Preface. " + QUESTION + " After.", OTHER, MIXED, "so alpha beta gamma delta epsilon zeta eta theta", "alpha beta gamma delta epsilon zeta",
    None, "", "12 13 14 15 16", "few words here", "few words there", "x " * 40000 + "Few Words here", QUESTION, "\n\n", QUESTION.lower(),
]


@pytest.mark.parametrize("most_sent", [decontam.MOST_SENT, 0])
def test_equals_brute_force(spark, docs, most_sent):
    ids = [*range(len(TEXTS) - 2), 3, None]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    out = decontam.contaminated(docs(TEXTS, ids), items, most_sent=most_sent)
    got = sorted(map(tuple, out.collect()), key=str)
    assert got == brute(list(zip(ids, TEXTS)), ITEMS[:-1])
    assert {(r[0], r[1], r[5]) for r in got} >= {(0, 0, False), (1, 0, True), (3, 1, False)}
    assert not any(r[:2] == (2, 0) for r in got)


def test_random_variants_equal_brute_force(spark, docs):
    """Items beside their variants, with names at the start of sentences and inside, put together at random."""
    rng = random.Random(11)
    story = "{a} has {n} apples. {b} buys {m} kg of pears. Then {a} eats {k} plums, says {b}. How many plums are left for {a}?"
    names = ["Mary", "John", "Lucy", "Paul", "it"]

    def variant():
        a, b = rng.sample(names, 2)
        return story.format(a=a, b=b, n=rng.randint(2, 4), m=rng.randint(2, 4), k=rng.randint(2, 4))

    items = [(0, story.format(a="Mary", b="John", n=2, m=3, k=4)), (1, variant()), (1, variant()), (2, "pears. Then"), (3, "left for Lucy Lee")]
    texts = []
    for _ in range(40):
        parts = [rng.choice([variant(), variant().lower(), variant().replace("apples", "figs"), "Well. Then", "for Lucy Ann"]) for _ in range(rng.randint(1, 3))]
        texts.append(rng.choice([" ", "\n", ". "]).join(parts))
    ids = [rng.randint(0, 30) for _ in texts]
    out = decontam.contaminated(docs(texts, ids), spark.createDataFrame(items, "item_id long, text string"))
    want = brute(list(zip(ids, texts)), items)
    assert sorted(map(tuple, out.collect()), key=str) == want and len(want) > 20


def test_query_over_the_test_tables(spark):
    out = QUERIES["op7_benchmark_templates"](spark, SF)
    read = lambda t, k: [(r[k], r.text) for r in spark.read.parquet(f"{SF}/{t}.parquet").collect()]
    want = brute(read("documents", "doc_id"), read("benchmark", "item_id"))
    assert sorted(map(tuple, out.collect()), key=str) == want and want


def test_short_items_are_found_inside_longer_texts(spark, docs):
    items = spark.createDataFrame([(0, "zebra crossing paradox"), (1, "the end"), (2, "one"), (3, "3 km"), (4, "Meet Mary")], "item_id long, text string")
    texts = ["This is the zebra crossing paradox of old.", "zebra crossing", "in the end.", "one", "it is 3 km on", "Zebra crossing paradox", "we meet Lucy", "a. Meet Lucy"]
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(docs(texts), items).collect()}
    assert got == {(0, 0), (2, 1), (5, 0)}


def test_columns_that_clash(spark, docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    df = docs([QUESTION, "all clean", None])
    for name in ("bad", "uid", "__uid", "row", "h", "item"):
        df = df.withColumn(name, df.text)
    kept = decontam.without(df, items)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2]


def test_empty_tables(spark, docs):
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontam.contaminated(docs(TEXTS[:3]), items).count() == 0
    assert decontam.contaminated(docs([]), spark.createDataFrame(ITEMS, "item_id long, text string")).count() == 0


THIRD = "Anyone can see how Anna had 5 apples and 8 g of pears when Anna met Carl. How many apples did Anna give to Carl?"


def test_each_occurrence_has_its_own_values(spark, docs):
    items = spark.createDataFrame([(0, QUESTION)], "item_id long, text string")
    texts = [QUESTION + " " + OTHER, OTHER + " " + QUESTION, OTHER + "\n" + THIRD, MIXED, QUESTION + " " + MIXED, OTHER, THIRD]
    texts += [THIRD + " And " + OTHER.replace("pears", "many very ripe pears") + " " + QUESTION.replace("apples", "plums")]
    out = decontam.contaminated(docs(texts, [0, 1, 2, 3, 4, 5, 5, 6]), items)
    got = {r.doc_id: (r.n_matched / r.n_windows, r.reparameterised) for r in out.collect()}
    assert got.pop(6)[0] >= 0.8
    assert got == {0: (1.0, False), 1: (1.0, False), 2: (1.0, True), 4: (1.0, False), 5: (1.0, True)}


def test_names_that_start_sentences(spark, docs):
    story = "Mary has 12 apples. John buys 5 pears and 7 plums. Mary eats 3 plums. How many plums and pears are left for John?"
    other = "Lucy has 70 apples. Paul buys 8 pears and 9 plums. Lucy eats 4 plums. How many plums and pears are left for Paul?"
    mixed = "Lucy has 70 apples. Paul buys 8 pears and 8 plums. Paul eats 8 plums. How many plums and pears are left for Carl?"
    texts = [story, other, "It is said that " + other.replace(". ", "; "), other + " " + story, mixed, "Yes. " + other.lower()]
    items = spark.createDataFrame([(0, story)], "item_id long, text string")
    got = {r.doc_id: (r.n_windows, r.n_matched, r.reparameterised) for r in decontam.contaminated(docs(texts), items).collect()}
    total = len({g[0] for g in grams(story)})
    assert got.pop(2)[1] >= 0.8 * total
    assert got == {0: (total, total, False), 1: (total, total, True), 3: (total, total, False)}
