"""Records of JSON documents of any size: a list of objects, or an object that holds the list under a name.

A JSON document is one value, so Spark's readers keep it in one task. Here it is read as text whose lines end with the
closing brace, which Spark splits like any text; pieces that cross the border of a split are put together by its reader.
A brace may stand inside a string or close a nested object, and what it means depends on all that comes before. So there
are two passes:

1. Every split tells what it does to the state of a parser - inside a string or not, how deep, under which name - for
   both ways in which it may begin. It sends one small row. The rows of a file, in order, give the state in which each
   of its splits begins, and whether the document ends as it should.
2. Every split cuts its records, given that state. A record that crosses borders comes in fragments, at most two for a
   split, which meet by their number.

Files that are no such document, or end before they should, give no records; they are told by ``malformed_files``.
Records are parsed by Spark, each by itself. A compressed file cannot be split, but is still read piece by piece.
"""

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelspark.session import written

#: States of splits that are sent to all tasks; with more, the pieces go to them.
STATES_AT_ONCE = 1 << 16

_COLON = re.compile(r"\s*:\s*\Z")
_QUOTE, _BACKSLASH, _OPEN_LIST, _CLOSE_LIST, _OPEN, _CLOSE = b'"\\[]{}'
_MATTERS = np.isin(np.arange(256), list(b'"[]{}'))


@dataclass
class Walk:
    """A parser that knows strings, depth, and the name of what was opened last at each depth, if that is a list."""

    in_string: bool = False
    depth: int = 0
    names: dict[int, str] = field(default_factory=dict)

    def over(self, marks: "Marks") -> "Steps":
        """Walk over pieces and the braces after them; returns the brackets met outside strings."""
        real = marks.told(self.in_string)
        ended = np.cumsum(real)
        outside = (ended + self.in_string) % 2 == 0
        found = np.flatnonzero(outside & ~marks.quotes)
        char = marks.chars[found]
        opens = (char == _OPEN) | (char == _OPEN_LIST)
        after = self.depth + np.cumsum(np.where(opens, 1, -1))
        steps = Steps(marks, marks.at[found], char, opens, after, marks.at[real], ended[found])
        if len(found):
            self.depth = int(after[-1])
        last = np.flatnonzero(opens)[::-1]
        depths, first = np.unique(after[last] - 1, return_index=True)
        self.names.update((d, steps.name(i)) for d, i in zip(depths.tolist(), last[first].tolist()))
        self.in_string = bool((self.in_string + len(steps.quotes)) % 2)
        return steps


class Marks:
    """Quotes and brackets of pieces that follow each other, each with the brace after it."""

    def __init__(self, pieces: pa.Array):
        one = pa.ListArray.from_arrays(pa.array([0, len(pieces)], pa.int32()), pieces)
        self.text = pc.binary_join(one, "}")[0].as_buffer().to_pybytes() + b"}"
        raw = np.frombuffer(self.text, np.uint8)
        self.at = np.flatnonzero(_MATTERS[raw])
        self.chars = raw[self.at]
        self.quotes = self.chars == _QUOTE
        self.doubtful = np.zeros(0, np.int64)  # quotes after an odd number of backslashes
        if b"\\" in self.text:
            slashes = np.flatnonzero(raw == _BACKSLASH)
            ends = np.flatnonzero(np.append(np.diff(slashes) > 1, True))
            counts = np.diff(ends, prepend=-1)
            after = slashes[ends[counts % 2 == 1]] + 1  # there is one, since a brace stands last
            after = after[raw[after] == _QUOTE]
            self.doubtful = np.searchsorted(self.at, after)

    def told(self, in_string: bool) -> np.ndarray:
        """Which of the marks are quotes that begin or end a string. A backslash counts in strings only, so a doubtful
        quote is part of a string or begins one: after it, a string goes on in both cases."""
        real = self.quotes.copy()
        if len(self.doubtful):
            real[self.doubtful] = False
            without = (in_string + np.cumsum(real)[self.doubtful]) % 2 == 1  # whether in a string, by the others alone
            turned = np.concatenate([[False], ~without[:-1]])
            real[self.doubtful] = without == turned
        return real

    def brace_after(self, places: np.ndarray) -> np.ndarray:
        """The brace, in a string or not, that ends the piece of each place."""
        braces = self.at[self.chars == _CLOSE]
        return braces[np.searchsorted(braces, places)]


@dataclass
class Steps:
    """Brackets outside strings: places, characters, which open, and the depth after each; and the places of the quotes,
    with the number of them before each bracket."""

    marks: Marks
    at: np.ndarray
    char: np.ndarray
    opens: np.ndarray
    after: np.ndarray
    quotes: np.ndarray
    ended: np.ndarray

    def name(self, i: int) -> str:
        """The name of what opens there, if it is a list, and the name and it stand in one piece."""
        n = int(self.ended[i])
        if self.char[i] != _OPEN_LIST or n < 2:
            return ""
        start, end, at = int(self.quotes[n - 2]), int(self.quotes[n - 1]), int(self.at[i])
        name = self.marks.text[start + 1 : end]
        return "" if b"}" in name or not _COLON.match(self.marks.text[end + 1 : at].decode()) else name.decode()

    def starts(self, level: int) -> np.ndarray:
        """Where objects open at the level, the last in each piece."""
        found = self.at[(self.char == _OPEN) & (self.after == level + 1)]
        piece = self.marks.brace_after(found)
        return found[np.append(piece[1:] != piece[:-1], True)] if len(found) else found

    def ends(self, level: int) -> np.ndarray:
        """The braces after which the depth is the level or less."""
        return self.at[(self.char == _CLOSE) & (self.after <= level)]

    def under(self, places: np.ndarray, name: str, before: bool) -> np.ndarray:
        """For each place, whether what was opened last at depth 1, by the end of its piece, is a list of the name."""
        first = np.flatnonzero(self.opens & (self.after == 2))
        named = np.array([before, *(self.name(i) == name for i in first.tolist())], bool)
        return named[np.searchsorted(self.at[first], self.marks.brace_after(places))]


def _splits(batches: Iterator[pa.RecordBatch], more: tuple[str, ...] = ()) -> Iterator[tuple[tuple, Iterator[Marks]]]:
    """((path, start, size, more columns), marks) for each split in turn; marks must be used up before the next."""
    columns = ("path", "start", "size", *more)

    def stretches():
        for batch in batches:
            path, start = batch.column("path"), batch.column("start")
            new = pc.or_(pc.not_equal(path[1:], path[:-1]), pc.not_equal(start[1:], start[:-1]))
            cuts = [0, *(np.flatnonzero(new.to_numpy(zero_copy_only=False)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                if a < b:
                    yield tuple(batch.column(c)[a].as_py() for c in columns), batch.column("value")[a:b]

    for key, members in groupby(stretches(), key=lambda x: x[0]):
        yield key, (Marks(pieces) for _, pieces in members)


def _pieces(spark: SparkSession, path_glob: str) -> DataFrame:
    at = F.col("_metadata")
    columns = [at["file_path"].alias("path"), at["file_block_start"].alias("start"), at["file_size"].alias("size")]
    return spark.read.option("lineSep", "}").text(path_glob).select("value", *columns)


def _told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each split: its first character, its bytes, and what it does to a parser in both states."""
    for (path, start, size), stretches in _splits(batches):
        walks, first, length = (Walk(), Walk(in_string=True)), "", 0
        for marks in stretches:
            first = first or marks.text.decode().lstrip(" \t\n\r\ufeff}")[:1]
            length += len(marks.text)
            for walk in walks:
                walk.over(marks)
        does = json.dumps([[w.in_string, w.depth, list(w.names.items())] for w in walks])
        columns = [[path], [start], [size], [first], [length], [does]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["path", "start", "size", "first", "length", "does"])


def _states(name: str):
    """From the rows of splits sorted by file and place: the state in which each begins."""

    def of_file(path: str, splits: list[tuple]) -> pa.RecordBatch:
        first = next((s[2] for s in splits if s[2]), "")
        level = {"[": 1, "{": 2}.get(first)
        in_string, depth, under, out = False, 0, None, []
        for start, _, _, _, does in splits:
            out.append([path, start, in_string, depth, level == 1 or under == name])
            ends, moved, names = json.loads(does)[in_string]
            under = dict((depth + at, n) for at, n in names).get(1, under)
            in_string, depth = ends, depth + moved
        # The reader does not say whether a brace stood after the last piece; the length of the file does.
        short = sum(s[3] for s in splits) - splits[0][1]
        ends = {0: (0,), 1: (-1,)}.get(short, (0, -1))
        valid = level is not None and not in_string and depth in ends
        columns = list(zip(*[[*row, level or 0, valid] for row in out]))
        types = [pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.bool_(), pa.int64(), pa.bool_()]
        names = ["path", "start", "in_string", "depth", "wanted", "level", "valid"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    def run(batches):
        path, splits = None, []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "size", "first", "length", "does"))):
                if row[0] != path and splits:
                    yield of_file(path, splits)
                    splits = []
                path = row[0]
                splits.append(row[1:])
        if splits:
            yield of_file(path, splits)

    return run


def _cut(name: str):
    """Records and fragments of each split: (path, start, place, kind, text). Kinds: 0 whole, 1 the rest of a record that
    began before, 2 the beginning of one that ends later, 3 neither."""
    more = ("in_string", "depth", "wanted", "level")

    def run(batches):
        out: list[tuple] = []
        held = 0

        def handed_on():
            columns = list(zip(*out)) or [()] * 5
            types = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["path", "start", "place", "kind", "text"])

        for (path, start, _, in_string, depth, wanted, level), stretches in _splits(batches, more):
            walk, place = Walk(in_string, depth, {1: name} if wanted else {}), 0
            inside = depth > level
            text: list[bytes] = []
            kind = 1
            for marks in stretches:
                before = walk.names.get(1) == name
                steps = walk.over(marks)
                starts = steps.starts(level)
                listed = steps.under(starts, name, before).tolist() if level != 1 else [True] * len(starts)
                begins, ends, at = zip(starts.tolist(), listed), iter(steps.ends(level).tolist()), 0
                while True:
                    if not inside:
                        at, wanted = next((b for b in begins if b[0] >= at), (None, wanted))
                        if at is None:
                            break
                        inside, kind = True, 0
                    end = next((e for e in ends if e >= at), None)
                    if end is None:
                        text.append(marks.text[at:])
                        break
                    if wanted:
                        text.append(marks.text[at : end + 1])
                        out.append((path, start, place, kind, b"".join(text).decode()))
                        held, place = held + len(out[-1][4]), place + 1
                    inside, text, at = False, [], end + 1
                    if held > 4 << 20:
                        yield handed_on()
                        out, held = [], 0
            if inside and wanted:
                out.append((path, start, place, 2 if kind == 0 else 3, b"".join(text).decode()))
        if out:
            yield handed_on()

    return run


def begun(spark: SparkSession, path_glob: str, name: str = "Data") -> DataFrame:
    """The state in which each split begins, for the functions below if more than one is called."""
    told = _pieces(spark, path_glob).mapInArrow(_told, "path string, start long, size long, first string, length long, does string")
    in_order = told.repartition("path").sortWithinPartitions("path", "start")
    schema = "path string, start long, in_string boolean, depth long, wanted boolean, level long, valid boolean"
    return written(in_order.mapInArrow(_states(name), schema))


def malformed_files(spark: SparkSession, path_glob: str, name: str = "Data", states: DataFrame | None = None) -> DataFrame:
    """(path) of the files that ``scan_records`` takes no records from because of their form."""
    states = begun(spark, path_glob, name) if states is None else states
    return states.filter("not valid").select("path").distinct()


def record_texts(spark: SparkSession, path_glob: str, name: str = "Data", states: DataFrame | None = None) -> DataFrame:
    """(path, text) of every record of the files: members of a list, or of the list under the name in an object."""
    states = begun(spark, path_glob, name) if states is None else states
    few = states.count() <= STATES_AT_ONCE
    states = states.filter("valid").drop("valid").withColumnsRenamed({"path": "p", "start": "s"})
    pieces = _pieces(spark, path_glob)
    here = (F.col("path") == F.col("p")) & (F.col("start") == F.col("s"))
    if few:
        placed = pieces.join(F.broadcast(states), here)  # pieces stay where and in the order they are
    else:
        placed = pieces.withColumn("at", F.monotonically_increasing_id()).join(states, here)
        placed = placed.repartition("path", "start").sortWithinPartitions("path", "start", "at")
    columns = ["value", "path", "start", "size", "in_string", "depth", "wanted", "level"]
    cut = placed.select(columns).mapInArrow(_cut(name), "path string, start long, place long, kind int, text string")
    cut = written(cut)
    number = F.count_if(F.col("kind") == 2).over(Window.partitionBy("path").orderBy("start", "place"))
    parts = cut.filter("kind > 0").withColumn("number", number)
    whole = parts.groupBy("path", "number").agg(F.sort_array(F.collect_list(F.struct("start", "place", "text"))).alias("parts"))
    whole = whole.select("path", F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"))
    return cut.filter("kind = 0").select("path", "text").union(whole)


def scan_records(
    spark: SparkSession, path_glob: str, ddl: str, name: str = "Data", states: DataFrame | None = None
) -> DataFrame:
    """The records of the files with the declared fields and the name of their file as source_file."""
    texts = record_texts(spark, path_glob, name, states)
    file = F.element_at(F.split("path", "/"), -1)
    return texts.select(F.from_json("text", ddl).alias("record"), file.alias("source_file")).select("record.*", "source_file")
