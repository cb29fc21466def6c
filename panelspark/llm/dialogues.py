"""Conversation structure repair: the cheapest edits that give every conversation a proper order of roles.

A proper order of the roles' initials is ``(s?(ua)+)?``. Every row is kept (0), given another role (R, 2), or deleted
(D, 3), and rows without text are inserted anywhere (I, 2); a truncated row that stays costs 1 more. Blank rows and
repeats of an earlier row (role and text) must be deleted. Of the cheapest edits those whose initials come first in
ASCII order are taken.

1. Each row becomes one symbol: its role's initial and its first fault. The symbols of a conversation, by turn, are its
   signature. Rows are pre-aggregated by (conversation, turn, digest of role and text) without their texts.
2. The different signatures of all conversations go into an automaton that shares suffixes: a node is what is left of a
   signature. Ranges of signatures in the order of their last symbols come sorted, so a signature shares the nodes
   of its neighbours and only the nodes after the common suffix are made. Each node gets, once and for each state of the
   grammar, its cost to go and the first edit of the best audit suffix, whose rest is the node it leads to. Nodes that lie
   on the border of two ranges are made in both: one path at most for each border.
3. Audits go back to the conversations by signature, and one pass over the texts, sorted by conversation and turn, carries
   out the edits and hashes the result without holding a conversation.

Defined results: null texts and roles count as one space, null turns come first and count for no gap, null conversation
ids are one conversation. Rows of one turn come by the digest of role and text, so equal rows are neighbours. A row that
stands no times (``copies`` 0) leaves only its conversation behind; a conversation without rows has zeros, an empty
audit and the hash of nothing. Other columns are left behind. The texts of one conversation are hashed in one task, in
order, as SHA-256 demands; nothing but the signature of the conversation (a byte for each row) is held there.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.bpe import parts
from panelspark.llm.tables import stored

BLANKS = " \t\n\x0b\x0c\r"
ROW = "conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, signature binary"

#: States of the grammar: nothing yet, after s, after u, after a. An output is proper in the first and the last.
START, SYSTEM, USER, ASSISTANT = range(4)
#: What may be put next in each state, whoever puts it: user in all but USER, where it is assistant.
NEXT = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {b"su", b"ua", b"au"}
FAR = 1 << 60

#: Symbols: s, u, a or o (another role) of a row that may stay, upper-case if it is truncated, d for one that must go.
#: For each: the state it leads to if kept in each state (-1: not allowed), what it costs to keep, what to give another role.
KEEP: dict[int, tuple[tuple[int, int, int, int], int, int]] = {}
for _symbol, _moves in (("s", (SYSTEM, -1, -1, -1)), ("u", (USER, USER, -1, USER)), ("a", (-1, -1, ASSISTANT, -1)), ("o", (-1,) * 4)):
    KEEP[ord(_symbol)] = (_moves, 0, 2)
    KEEP[ord(_symbol.upper())] = (_moves, 1, 3)

DELETE, INSERT, STAY, REROLE = map(ord, "DIKR")  # in ASCII order


class Automaton:
    """The path of suffixes of the current signature; ``follow`` keeps the nodes that the next one shares.

    ``cost`` and ``edit`` hold four entries for each node, one for each state of the grammar.
    """

    def __init__(self) -> None:
        self.made = 0
        self.path = b""  # the current signature from its end
        self.cost, self.edit = array("q"), bytearray()
        self._node([0, FAR, FAR, 0], [0, 0, 0, 0])

    def _node(self, cost: list[int], edit: list[int]) -> None:
        # An inserted row stays at the node; two in a row come back to a state after user, so two rounds settle all.
        for _ in range(2):
            for state in (USER, ASSISTANT, START, SYSTEM):
                other = (cost[NEXT[state]] + 2, INSERT)
                if other < (cost[state], edit[state]):
                    cost[state], edit[state] = other
        self.cost.extend(cost)
        self.edit.extend(edit)
        self.made += 1

    def follow(self, backwards: bytes) -> None:
        """Nodes for all suffixes of a signature, given from its end."""
        shared, most = 0, min(len(self.path), len(backwards))
        while shared < most and self.path[shared] == backwards[shared]:
            shared += 1
        del self.cost[4 * (shared + 1) :], self.edit[4 * (shared + 1) :]
        for symbol in backwards[shared:]:
            go = self.cost[-4:]
            cost, edit = [c + 3 for c in go], [DELETE] * 4
            if symbol in KEEP:
                moves, keep, rerole = KEEP[symbol]
                for state in range(4):
                    options = [(cost[state], DELETE), (go[NEXT[state]] + rerole, REROLE)]
                    if moves[state] >= 0:
                        options.append((go[moves[state]] + keep, STAY))
                    cost[state], edit[state] = min(options)
            self._node(cost, edit)
        self.path = backwards

    def best(self) -> tuple[int, str]:
        """Cost and audit of the whole signature, read along the first edits."""
        at, state, audit = len(self.path), START, bytearray()
        while edit := self.edit[4 * at + state]:
            audit.append(edit)
            if edit == INSERT:
                state = NEXT[state]
                continue
            if edit == REROLE:
                state = NEXT[state]
            elif edit == STAY:
                state = KEEP[self.path[at - 1]][0][state]
            at -= 1
        return self.cost[4 * len(self.path) + START], audit.decode()


def faults(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, digest, initial, fault, copies): rows equal in all four columns come as one, without text."""
    rest = F.rtrim(F.col("text"), F.lit(BLANKS))
    last = F.right(rest, F.lit(1))
    fault = F.when(rest == "", "blank").when(~last.isin(".", "!", "?"), "truncated").otherwise("")
    initial = F.substring("role", 1, 1)
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    narrow = rows.select("conv_id", "turn", "digest", initial.alias("initial"), fault.alias("fault"), "copies")
    return narrow.groupBy("conv_id", "turn", "digest", "initial", "fault").agg(F.sum("copies").alias("copies"))


def signatures(found: DataFrame) -> DataFrame:
    """One row for each conversation: its gaps, the number of rows of each fault, and its signature."""
    place = F.struct(F.col("turn").isNotNull(), "turn")
    again = found.filter("copies > 0").groupBy("conv_id", "digest").agg(F.min(place).alias("first"), F.count("*").alias("turns"))
    again = stored(again.filter("turns > 1").select(F.col("conv_id").alias("c"), F.col("digest").alias("d"), "first"), "again")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d"))
    rows = found.join(again, same, "left").withColumn("new", F.col("first").isNull() | (F.col("first") == place))
    rows = rows.select("conv_id", "turn", "digest", "initial", "fault", "copies", "new")
    placed = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "digest")
    kind = found.schema["conv_id"].dataType.simpleString()
    return placed.mapInArrow(_signatures, ROW.format(kind=kind))


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reads rows sorted by conversation, turn and digest; holds the signature of one conversation."""
    names = ("conv_id", "turn", "initial", "fault", "copies", "new")
    schema = None
    out: list[tuple] = []
    held = 0
    now: list | None = None

    def closed(c: list) -> tuple:
        conv_id, lowest, highest, turns, blank, duplicate, truncated, illegal, _, _, signature = c
        gaps = highest - lowest + 1 - turns if turns else 0
        return conv_id, gaps, blank, duplicate, truncated, illegal, bytes(signature)

    def handed_on() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)

    for batch in batches:
        if schema is None:
            longs = [(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal")]
            schema = pa.schema([("conv_id", batch.schema.field("conv_id").type), *longs, ("signature", pa.binary())])
        for conv_id, turn, initial, fault, copies, new in zip(*(batch.column(n).to_pylist() for n in names)):
            if now is None or now[0] != conv_id:
                if now is not None:
                    out.append(closed(now))
                    held += len(now[10])
                    if len(out) >= 4096 or held > 4 << 20:
                        yield handed_on()
                        out, held = [], 0
                now = [conv_id, None, None, 0, 0, 0, 0, 0, b"", object(), bytearray()]
            if not copies:
                continue
            if turn is not None and turn != now[9]:
                now[1] = turn if now[1] is None else now[1]
                now[2], now[9] = turn, turn
                now[3] += 1
            role = initial.encode()
            now[7] += (now[8] + role not in LEGAL) if now[8] else 0
            now[7] += (copies - 1) * (role + role not in LEGAL)
            now[8] = role
            if fault == "blank":
                now[4] += copies
                now[10] += b"d" * copies
                continue
            now[5] += copies - new
            if new:
                now[6] += fault == "truncated"
                now[10] += role.upper() if fault else role
            now[10] += b"d" * (copies - new)
    if now is not None:
        out.append(closed(now))
    if out:
        yield handed_on()


def audits(signed: DataFrame) -> DataFrame:
    """Rows (signature, cost, audit) for the different signatures, from one automaton for each range of suffixes."""

    def run(batches):
        own = Automaton()
        for batch in batches:
            found = []
            for backwards in batch.column("backwards").to_pylist():
                own.follow(backwards)
                found.append((backwards[::-1], *own.best()))
            signature, cost, audit = zip(*found) if found else ((), (), ())
            arrays = [pa.array(signature, pa.binary()), pa.array(cost, pa.int64()), pa.array(audit, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, ["signature", "cost", "audit"])

    backwards = F.reverse(F.decode("signature", "US-ASCII")).cast("binary").alias("backwards")
    once = signed.select("signature").distinct().select(backwards)
    placed = once.repartitionByRange("backwards").sortWithinPartitions("backwards")
    return placed.mapInArrow(run, "signature binary, cost long, audit string")


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reads for each conversation its audit and then its rows in order; hands on the audit's row with the hash."""
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    schema = None
    out: list[list] = []
    now: dict | None = None

    def put(role: str, text: str) -> None:
        now["hash"].update(f"\n{role}:{text}".encode() if now["any"] else f"{role}:{text}".encode())
        now["any"] = True
        now["state"] = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]]

    def inserted() -> None:
        while now["audit"][now["at"] : now["at"] + 1] == "I":
            now["at"] += 1
            put(NAMES[NEXT[now["state"]]], "")

    def closed() -> None:
        inserted()
        out.append([*now["row"], now["hash"].hexdigest()])

    def handed_on() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)

    for batch in (part for whole in batches for part in parts(whole, "text")):
        if schema is None:
            longs = [(n, pa.int64()) for n in counts]
            ends = [("audit", pa.string()), ("repaired_sha256", pa.string())]
            schema = pa.schema([("conv_id", batch.schema.field("conv_id").type), *longs, *ends])
        heads = zip(*(batch.column(n).to_pylist() for n in ("conv_id", *counts, "audit")))
        texts = zip(*(batch.column(n).to_pylist() for n in ("role", "text", "copies")))
        for head, (role, text, copies) in zip(heads, texts):
            if head[-1] is not None:
                if now is not None:
                    closed()
                    if len(out) >= 4096:
                        yield handed_on()
                        out = []
                now = {"row": head, "audit": head[-1], "at": 0, "state": START, "any": False, "hash": hashlib.sha256()}
                continue
            for _ in range(copies):
                inserted()
                edit = now["audit"][now["at"]]
                now["at"] += 1
                if edit != "D":
                    put(role if edit == "K" else NAMES[NEXT[now["state"]]], text)
    if now is not None:
        closed()
    if out:
        yield handed_on()


def repair(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", copies: Column | None = None
) -> DataFrame:
    """For each conversation its gaps, faults, cheapest edits (cost, audit) and the hash of what they leave.

    ``copies`` tells how many times a row stands, one after another; without it each stands once.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (role, text))
    times = F.lit(1).cast("long") if copies is None else copies.cast("long")
    rows = df.select(F.col(conv).alias("conv_id"), F.col(turn).cast("long").alias("turn"), role.alias("role"), text.alias("text"), times.alias("copies"))
    whole = F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")
    rows = rows.withColumn("digest", F.unhex(F.sha2(whole.cast("binary"), 256)))
    signed = stored(signatures(stored(faults(rows), "faults")), "signatures")
    found = signed.join(stored(audits(signed), "audits"), "signature").drop("signature")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    none = lambda name, kind: F.lit(None).cast(kind).alias(name)
    order = [none("turn", "long"), none("digest", "binary"), none("role", "string"), none("text", "string"), none("copies", "long")]
    heads = found.select("conv_id", F.lit(0).alias("part"), *counts, "audit", *order)
    empty = [*(none(c, "long") for c in counts), none("audit", "string")]
    texts = rows.filter("copies > 0").select("conv_id", F.lit(1).alias("part"), *empty, "turn", "digest", "role", "text", "copies")
    placed = heads.union(texts).repartition("conv_id").sortWithinPartitions("conv_id", "part", "turn", "digest")
    placed = placed.drop("part", "turn", "digest")
    kind = rows.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, {', '.join(f'{c} long' for c in counts)}, audit string, repaired_sha256 string"
    return placed.mapInArrow(_repaired, schema).withColumnRenamed("conv_id", conv)


def damaged(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, Column]:
    """The rows with every twentieth each dropped, emptied, left without ``.!?``, repeated or given to the user, by a hash
    of conversation and turn; and how many times each stands."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(name(conv), F.lit(":"), name(turn)).cast("binary")) % 20
    out = df.select(conv, turn, name(role).alias(role), name(text).alias(text), kind.alias("kind"))
    kind = F.col("kind")
    texts = F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(F.col(text))
    out = out.withColumns({text: texts, role: F.when(kind == 4, "user").otherwise(F.col(role))})
    return out, F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)


_STATES = range(4)
_REACHED = ([1, -1, -1, -1], [2, 2, -1, 2], [-1, -1, 3, -1])


def _option(child: str, cost: str, edit: str) -> str:
    return f"{{'c': {child}.c + {cost}, 'a': '{edit}' || {child}.a}}"


def _step(state: int) -> str:
    """The best of what may be done with a row in a state, as SQL over the four states after it."""
    put = 3 if state == 2 else 2
    options = [
        _option(f"b.f{state}", "3", "D"),
        f"CASE WHEN r.symbol <> 'd' THEN {_option(f'b.f{put}', '2 + r.late', 'R')} END",
    ]
    for initial, reached in zip("sua", _REACHED):
        if reached[state] >= 0:
            options.append(f"CASE WHEN r.symbol = '{initial}' THEN {_option(f'b.f{reached[state]}', 'r.late', 'K')} END")
    return f"list_min([{', '.join(options)}]) AS g{state}"


def _inserting(source: str, target: str, below: str) -> str:
    """Lets each state insert a row, given the states without."""
    to = {0: 2, 1: 2, 2: 3, 3: 2}
    columns = [f"list_min([{source}{s}, {_option(f'{source}{to[s]}', '2', 'I')}]) AS {target}{s}" for s in _STATES]
    return f"SELECT conv_id, k, {', '.join(columns)} FROM ({below})"


_END = ", ".join(f"{{'c': {c}::BIGINT, 'a': '{a}'}} AS f{s}" for s, (c, a) in enumerate([(0, ""), (4, "II"), (2, "I"), (0, "")]))

#: The same in SQL: CRC-32 from its polynomial, and one step back for each row of a conversation.
ORACLE = f"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
      lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) AS x(i)
), named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
      lambda x: ascii(x)::BIGINT) AS bytes
  FROM conversations
), hashed AS (
  SELECT conv_id, turn, role, text,
    xor(list_reduce([4294967295] || bytes, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 20 AS kind
  FROM named, crc
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM hashed
), marked AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(role) || ':' || role || text), copy) AS k,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS rest,
    CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'o' END AS initial
  FROM damaged
), faulty AS (
  SELECT *, CASE WHEN rest = '' THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 THEN 'duplicate'
      WHEN right(rest, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY k) || initial NOT IN ('su', 'ua', 'au') AS wrong
  FROM marked
), symbols AS (
  SELECT conv_id, k, role, text, CASE WHEN fault IN ('blank', 'duplicate') THEN 'd' ELSE initial END AS symbol,
    CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END AS late
  FROM faulty
), ids AS (
  SELECT conv_id, coalesce(max(k), 0) AS n FROM (SELECT conv_id, NULL AS k FROM conversations UNION ALL SELECT conv_id, k FROM symbols) GROUP BY 1
), best AS (
  SELECT conv_id, n + 1 AS k, {_END} FROM ids
  UNION ALL
  {_inserting("h", "f", _inserting("g", "h", f"SELECT r.conv_id, r.k, {', '.join(map(_step, _STATES))} FROM best b JOIN symbols r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.k = b.k - 1"))}
), chosen AS (
  SELECT conv_id, f0.c AS cost, f0.a AS audit FROM best WHERE k = 1
), edits AS (
  SELECT conv_id, unnest(string_split(audit, '')) AS edit, generate_subscripts(string_split(audit, ''), 1) AS i FROM chosen WHERE audit <> ''
), placed AS (
  SELECT *, sum(CASE WHEN edit = 'I' THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY i) AS k FROM edits
), outputs AS (
  SELECT p.conv_id, p.i, p.edit, s.role, s.text, row_number() OVER (PARTITION BY p.conv_id ORDER BY p.i) AS o
  FROM placed p LEFT JOIN symbols s ON s.conv_id IS NOT DISTINCT FROM p.conv_id AND s.k = p.k AND p.edit <> 'I'
  WHERE p.edit <> 'D'
), spoken AS (
  SELECT conv_id, i, coalesce(text, '') AS text, CASE WHEN edit = 'K' THEN role
      WHEN (o + max(CASE WHEN o = 1 AND edit = 'K' AND left(role, 1) = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id)) % 2 = 1
      THEN 'user' ELSE 'assistant' END AS role
  FROM outputs
), repaired AS (
  SELECT conv_id, string_agg(role || ':' || text, chr(10) ORDER BY i) AS whole FROM spoken GROUP BY 1
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (wrong) AS illegal
  FROM faulty GROUP BY 1
)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, cost::BIGINT AS cost, audit,
  sha256(coalesce(whole, '')) AS repaired_sha256
FROM chosen c LEFT JOIN counted f ON f.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM c.conv_id
"""
