"""Benchmark decontamination by template windows.

1. Canonicalisation: words lower-cased, numbers, names and units of measure replaced by typed placeholders. A name is a
   word with a capital first letter; at the start of a sentence it may be a name or not, and both readings are tried. A
   unit counts as one after a number.
2. Windows of five template tokens with at least two literal words are hash-joined with those of the benchmark items; an
   item of fewer tokens is one window, which is looked for among the windows of that width. Windows with a token that
   no item has are never made. A window with capitalised sentence starts is joined in every reading that leaves
   two literal words; an item's window is counted once, as the one in which they are all literal, whichever meets.
3. Slot consistency: the values that stood in matched slots must map one to one from item to document, each to the
   value it meets most often (ties: the smallest); windows against that mapping do not count. The mapping is made for
   every occurrence by itself, and the best one counts: all hits that start at one place of a text when aligned with the
   item; those that start within one length of the item (two overlapping rows of such stretches, so that up to half a
   length may be put in or left out); and all hits of the document, with and without the readings of sentence starts as
   names. Windows without slots agree with any mapping. Where the share is reached with all sentence starts as words,
   that count is the result.
4. A document is contaminated by an item if at least 0.8 of the item's distinct windows are found in it. Values may all
   differ from the item's, which is how re-parameterised questions are caught.

Defined results: null and empty texts match nothing; an item without a window of two literal words matches nothing;
rows with the same key count as one document; only the named columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.bpe import parts
from panelspark.llm.tables import stored

WINDOW = 5
LEAST_SHARE = 0.8
LEAST_LITERALS = 2
#: Distinct windows and words of the items up to which they go to every task; beyond it both sides are shuffled.
MOST_SENT = 1 << 20
#: Characters of text whose words are handled at once, and words that a worker remembers before it starts anew.
TEXT_AT_ONCE = 1 << 19
KNOWN_WORDS = 1 << 19

NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
    "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split()
)
UNITS = frozenset(
    "mm cm m km in ft yd mi mg g kg lb oz t ml l s sec min h hr hours hour minutes minute seconds second days day weeks "
    "week months month years year meters meter metres metre kilometers kilometer kilometres kilometre miles mile inches "
    "inch feet foot yards yard grams gram kilograms kilogram pounds pound ounces ounce liters liter litres litre degrees "
    "degree percent dollars dollar euros euro cents cent usd eur mph kmh kw kwh w v a hz".split()
)
#: Ends a text among others; in a text it means no more than a blank.
BREAK = "\x1e"
TOKEN = re.compile(rf"\d+(?:[.,]\d+)*|[^\W\d_]+|[.!?\n{BREAK}]")
LITERAL, END, NUMBER, CAPITAL, UNIT = range(5)
NUMBER_SLOT, NAME_SLOT, UNIT_SLOT = (np.uint64(xxhash.xxh64_intdigest(s)) for s in ("<number>", "<name>", "<unit>"))


class Words(dict):
    """Numbers words in the order they are met; kinds and hashes of the word with a number, and whether it may stand in a
    window of the items, whose words and slots are the vocabulary: without one any word may. All plain words
    beside the vocabulary have the number 0."""

    def __init__(self, vocabulary: frozenset[str] | None = None):
        self.vocabulary, self.n = vocabulary, 1
        self.told = None if vocabulary is None else vocabulary | NUMBER_WORDS | UNITS
        self.kinds, self.hashes, self.may = np.zeros(1 << 12, np.int8), np.zeros(1 << 12, np.uint64), np.zeros(1 << 12, bool)

    def __missing__(self, word: str) -> int:
        if self.told is not None and word not in self.told and word.islower():
            self[word] = 0
            return 0
        k, self.n = self.n, self.n + 1
        if k == len(self.kinds):
            self.kinds, self.hashes, self.may = (np.resize(a, 2 * k) for a in (self.kinds, self.hashes, self.may))
        low = word.lower()
        if word in (".", "!", "?", "\n", BREAK):
            kind, readings = END, ()
        elif word[0].isdigit() or low in NUMBER_WORDS:
            kind, readings = NUMBER, ("<number>",)
        elif len(word) > 1 and word[0].isupper() and word[1:].islower():
            kind, readings = CAPITAL, (low, "<name>")
        elif low in UNITS:
            kind, readings = UNIT, (low, "<unit>")
        else:
            kind, readings = LITERAL, (low,)
        self.kinds[k], self.hashes[k] = kind, xxhash.xxh64_intdigest(low)
        self.may[k] = self.vocabulary is None or not self.vocabulary.isdisjoint(readings)
        self[word] = k
        return k


@dataclass
class Template:
    """The templates of some texts, word by word without sentence ends: the token of each word, the hash of what stands for
    it, which are slots, which are capitalised sentence starts, literal here but perhaps names, which may stand in a window
    of the items, and the text that each belongs to."""

    tokens: list[str]
    token: np.ndarray
    hashes: np.ndarray
    slot: np.ndarray
    start: np.ndarray
    may: np.ndarray
    text: np.ndarray
    sizes: np.ndarray  # of the texts, in words

    @classmethod
    def of(cls, texts: list[str], known: Words) -> Template:
        tokens = TOKEN.findall(BREAK.join(t.replace(BREAK, " ") for t in texts))
        k = np.fromiter(map(known.__getitem__, tokens), np.int64, len(tokens))
        kinds, hashes = known.kinds[k], known.hashes[k]
        before = np.concatenate([[END], kinds[:-1]]) if len(kinds) else kinds
        number, unit, capital = kinds == NUMBER, (kinds == UNIT) & (before == NUMBER), kinds == CAPITAL
        name, start = capital & (before != END), capital & (before == END)
        hashes = np.where(number, NUMBER_SLOT, np.where(unit, UNIT_SLOT, np.where(name, NAME_SLOT, hashes)))
        word = np.flatnonzero(kinds != END)
        text = np.cumsum(k == known[BREAK])[word]
        slot = (number | unit | name)[word]
        return cls(tokens, word, hashes[word], slot, start[word], known.may[k][word], text, np.bincount(text, minlength=len(texts)))


def window_hashes(t: Template, width: int, wanted: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Hashes of the windows that hold enough literal words and only words that may stand in one, where they start, the hash
    of each with its sentence starts all literal, and which of its places are slots. A reading takes some of the sentence
    starts of a window as names. ``wanted``: the texts to look at."""
    empty = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.uint64), np.empty((0, width), bool)
    if len(t.hashes) < width:
        return empty
    summed = lambda flags: np.concatenate([[0], np.cumsum(flags)])
    allowed = summed(t.may)
    at = np.flatnonzero((allowed[width:] - allowed[:-width] == width) & (t.text[width - 1 :] == t.text[: len(t.text) - width + 1]))
    literals, starts = summed(~t.slot), summed(t.start)
    literal = literals[at + width] - literals[at]
    enough = literal >= LEAST_LITERALS
    if wanted is not None:
        enough &= wanted[t.text[at]]
    at, literal = at[enough], literal[enough]
    if not len(at):
        return empty

    def mixed(columns):
        total = np.zeros(len(columns[0]), np.uint64)
        for c in columns:
            total = (total ^ c) * np.uint64(0x9E3779B97F4A7C15)
            total ^= total >> np.uint64(29)
        return total

    places = at[:, None] + np.arange(width)
    words, slots_of = t.hashes[places], t.slot[places]
    total = mixed(list(words.T))
    found, ats, wholes, slots = [total], [at], [total], [slots_of]
    many = starts[at + width] - starts[at]
    for chosen in range(1, 1 << int(many.max())):  # which of the window's sentence starts are names, bit by bit
        own = np.flatnonzero((many >= chosen.bit_length()) & (literal - chosen.bit_count() >= LEAST_LITERALS))
        if not len(own):
            continue
        rank = starts[places[own]] - starts[at[own]][:, None]
        name = t.start[places[own]] & ((chosen >> rank) & 1 > 0)
        found.append(mixed(list(np.where(name, NAME_SLOT, words[own]).T)))
        ats.append(at[own])
        wholes.append(total[own])
        slots.append(slots_of[own] | name)
    return tuple(map(np.concatenate, (found, ats, wholes, slots)))


def words_of(items: DataFrame, text: str) -> DataFrame:
    """(word): the words of the items, lower-cased, and the kinds of slots that stand in their templates in any reading."""

    def run(batches):
        known, names = Words(), {int(NUMBER_SLOT): "<number>", int(NAME_SLOT): "<name>", int(UNIT_SLOT): "<unit>"}
        for batch in batches:
            t = Template.of([x or "" for x in batch.column("text").to_pylist()], known)
            found = {t.tokens[i].lower() for i in t.token.tolist()} | {names[h] for h in np.unique(t.hashes[t.slot]).tolist()}
            found |= {"<name>"} if t.start.any() else set()
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.string())], ["word"])

    return items.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "word string").distinct()


def windows(df: DataFrame, key: str, text: str, widths: Sequence[int] | None, wanted=None) -> DataFrame:
    """(key, h, whole, slots, row, at, length, width): every reading of every window, the window it is a reading of, and the
    values of its slots as "place value". Of those with slots, also a hash of their text, their place in it, and its
    length in words. Windows of the widths, or without any of the whole text up to WINDOW words. ``wanted``: the
    hashes of the windows to look for and the words of the items; windows with another word are never made."""

    def run(batches):
        want, vocabulary = wanted.value if wanted is not None else (None, None)
        known = Words(vocabulary)
        for batch in (part for whole in batches for part in parts(whole, "text", TEXT_AT_ONCE)):
            if len(known) > KNOWN_WORDS:
                known = Words(vocabulary)
            t = Template.of([x or "" for x in batch.column("text").to_pylist()], known)
            first = np.cumsum(t.sizes) - t.sizes
            for width in range(1, WINDOW + 1) if widths is None else widths:
                own_width = None if widths is not None else np.minimum(t.sizes, WINDOW) == width
                own, at, whole, slots = window_hashes(t, width, own_width)
                if want is not None and len(own):
                    hit = want[np.minimum(np.searchsorted(want, own), len(want) - 1)] == own if len(want) else np.zeros(len(own), bool)
                    own, at, whole, slots = own[hit], at[hit], whole[hit], slots[hit]
                for some in np.array_split(np.arange(len(own)), -(-len(own) // 50_000)) if len(own) else ():
                    yield _rows(batch, t, first, own[some], at[some], whole[some], slots[some], width)

    whole = F.col(text).cast("string")
    rows = df.select(F.col(key).alias("key"), whole.alias("text"), F.xxhash64(whole).alias("row"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, h long, whole long, slots array<string>, row long, at long, length long, width long")


def _rows(batch, t: Template, first, own, at, whole, slots, width):
    text, valued = t.text[at], slots.any(axis=1)
    plain = ~valued
    values = [
        [f"{i} {t.tokens[t.token[a + i]]}" for i in np.flatnonzero(o).tolist()] if v else []
        for a, o, v in zip(at.tolist(), slots, valued.tolist())
    ]
    take = pa.array(text)
    return pa.RecordBatch.from_arrays(
        [
            batch.column("key").take(take),
            pa.array(own.view(np.int64)),
            pa.array(whole.view(np.int64)),
            pa.array(values, pa.list_(pa.string())),
            pa.array(batch.column("row").take(take).to_numpy(), mask=plain),
            pa.array(at - first[text], mask=plain),
            pa.array(t.sizes[text], mask=plain),
            pa.array(np.full(len(at), width)),
        ],
        ["key", "h", "whole", "slots", "row", "at", "length", "width"],
    )


def contaminated(
    df: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    least_share: float = LEAST_SHARE,
    most_sent: int = MOST_SENT,
) -> DataFrame:
    """Rows (key, item, n_windows, n_matched, share, reparameterised): each document and item that it contains."""
    of_items = stored(windows(items, item, item_text, None).withColumnRenamed("key", "item").distinct(), "items")
    sizes = of_items.groupBy("item").agg(F.countDistinct("whole").alias("n_windows"))
    widths = sorted(r.width for r in of_items.select("width").distinct().collect())  # WINDOW at most
    words, wanted = stored(words_of(items, item_text), "words"), None
    sought = of_items.select("h").distinct()
    if sought.limit(most_sent + 1).count() <= most_sent and words.limit(most_sent + 1).count() <= most_sent:
        hashes = np.array([r.h for r in sought.toLocalIterator()], np.int64).view(np.uint64)
        wanted = df.sparkSession.sparkContext.broadcast((np.sort(hashes), frozenset(r.word for r in words.toLocalIterator())))
    hits = windows(df, key, text, widths, wanted).drop("length", "width").distinct()
    hits = hits.select("key", "h", F.col("whole").alias("own_whole"), F.col("slots").alias("own"), F.col("row").alias("own_row"), F.col("at").alias("own_at"))
    literal = (F.col("h") == F.col("whole")) & (F.col("h") == F.col("own_whole"))
    off = (F.col("own_at") - F.col("at")).alias("off")
    met = hits.join(of_items, "h").select("key", "item", "whole", literal.alias("literal"), "own", "slots", "own_row", "row", "length", off)
    met = stored(met.distinct(), "met")
    same = lambda a, b, *more: [a["key"].eqNullSafe(b["key"]), a["item"].eqNullSafe(b["item"]), *(a[m] == b[m] for m in more)]
    # Whatever the values, a document must hold enough windows of the item.
    held = met.groupBy("key", "item").agg(F.countDistinct("whole").alias("n_held"))
    held = held.join(sizes, held["item"].eqNullSafe(sizes["item"])).select(held["*"], "n_windows")
    held = held.filter(F.col("n_held") / F.col("n_windows") >= least_share)
    met = stored(met.join(held, same(met, held)).select(met["*"]), "held")
    # A window without slots agrees with any mapping; the others by the values that their item's slots meet most often.
    off, length = F.col("off"), F.col("length")
    none = F.lit(0).cast("long")
    group = lambda names, kind, own, row, i: F.struct(
        F.lit(names).alias("names"), F.lit(kind).alias("kind"), own.alias("own"), row.alias("row"), i.cast("long").alias("i")
    )
    places = ((1, off), (2, F.floor(off / length)), (3, F.floor(off / length + 0.5)))
    groups = lambda names: F.array(
        group(names, 0, none, none, none), *(group(names, kind, F.col("own_row"), F.col("row"), i) for kind, i in places)
    )
    groups = F.when(F.col("literal"), F.concat(groups(False), groups(True))).otherwise(groups(True))
    filled = met.filter(F.size("slots") > 0).select("key", "item", "whole", "own", "slots", F.explode(groups).alias("group")).distinct()
    filled = filled.withColumn("pair", F.explode(F.arrays_zip("slots", "own")))
    value = lambda c: F.regexp_replace(F.lower(c), r"^\d+ ", "")
    pairs = filled.select("key", "item", "group", "whole", "own", "slots", value("pair.slots").alias("s"), value("pair.own").alias("d"))
    counts = pairs.groupBy("key", "item", "group", "s", "d").agg(F.count("*").alias("c"))
    best = lambda by, other: counts.groupBy("key", "item", "group", by).agg(
        F.min(F.struct((-F.col("c")).alias("c"), F.col(other))).getField(other).alias(f"best_{other}")
    )
    forth, back = best("s", "d"), best("d", "s")
    p = pairs.join(forth, same(pairs, forth, "group", "s")).select(pairs["*"], "best_d")
    p = p.join(back, same(p, back, "group", "d")).select(p["*"], "best_s")
    agrees = (F.col("best_d") == F.col("d")) & (F.col("best_s") == F.col("s"))
    checked = p.groupBy("key", "item", "group", "whole", "own", "slots").agg(
        F.min(agrees).alias("agrees"), F.max(F.col("s") != F.col("d")).alias("differs")
    )
    plain = met.filter(F.size("slots") == 0).select("key", "item", "whole").distinct()
    good = checked.filter("agrees")
    good = good.join(plain, same(good, plain, "whole"), "left_anti")
    occurrences = good.groupBy("key", "item", "group").agg(F.countDistinct("whole").alias("n"), F.max("differs").alias("differs"))
    first = F.min(F.struct((-F.col("n")).alias("n"), "differs")).alias("first")
    most = occurrences.groupBy("key", "item", F.col("group.names").alias("names")).agg(first)
    most = most.select("key", "item", "names", (-F.col("first.n")).alias("n"), "first.differs")
    plain = plain.groupBy("key", "item").agg(F.count("*").alias("n"), F.lit(False).alias("differs"))
    plain = plain.select("key", "item", F.explode(F.array(F.lit(False), F.lit(True))).alias("names"), "n", "differs")
    matched = most.union(plain).groupBy("key", "item", "names").agg(F.sum("n").alias("n_matched"), F.max("differs").alias("reparameterised"))
    matched = matched.join(sizes, matched["item"].eqNullSafe(sizes["item"])).select(matched["*"], "n_windows")
    share = F.col("n_matched") / F.col("n_windows")
    matched = matched.withColumn("share", share).filter(F.col("share") >= least_share)
    # Sentence starts count as words where that suffices.
    out = matched.groupBy("key", "item").agg(F.min(F.struct("names", "n_windows", "n_matched", "share", "reparameterised")).alias("o"))
    out = out.select("key", "item", "o.*")
    return out.select(F.col("key").alias(key), F.col("item").alias("item_id"), "n_windows", "n_matched", "share", "reparameterised")


def without(df: DataFrame, items: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", **settings) -> DataFrame:
    """The rows of the table, all columns, whose text contains no item."""
    uid = F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")).alias("uid")
    rows = df.select(uid, F.col(text).cast("string").alias("text"))
    found = contaminated(rows, items, "uid", "text", item, item_text, **settings)
    bad = stored(found.select("uid").distinct(), "contaminated")
    own = df.select(F.struct("*").alias("row"), uid)
    return own.join(bad, "uid", "left_anti").select("row.*")
