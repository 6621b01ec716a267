"""Repair of conversations: the cheapest edits that make a conversation's roles alternate.

A sound conversation has the role initials ``(s?(ua)+)?``. Its turns are aligned by Wagner-Fischer with
the alternating string of each feasible length; a cell is looked at only inside Ukkonen's band, the
cells that a path no dearer than the incumbent can pass. Of equally cheap edits the one whose audit
(initials of Delete, Insert, Keep, Rerole in order) is least in ASCII wins, so that each alignment is
traced back and audits are compared.

Long conversations are aligned in pieces: for each state of the grammar in which a piece can be
entered and left, the cheapest audit; pieces then join like steps of a shortest path. Inserts stand
before the turn that follows, so that no audit is the beginning of an equally cheap one and an order
of audits survives whatever comes after them. Conversations above ``most_turns`` or ``most_bytes``
are dealt by ranges of turns over many tasks, and only costs and ranks of their blocks come together.
"""

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketframe.llm.common import SPACES, ship, spill

REROLE, DELETE, INSERT, CUT = 1, 2, 5, 5
PIECE = 16
BLOCK_TURNS, BLOCK_BYTES = 4096, 8 << 20
MOST_TURNS, MOST_BYTES = 4096, 8 << 20

# States of the grammar: nothing yet, after "s", after "u", after "a". The first and last may end.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
NAMES = {"u": "user", "a": "assistant"}
FAR = 1 << 60


def symbol(role: str, text: str, seen: bool) -> str:
    """A turn as one letter: ``x`` must go, else its role's initial (``o``: any other), upper-case
    where the text is cut off."""
    bare = text.rstrip(SPACES)
    if not bare or seen:
        return "x"
    kind = role[:1] if role[:1] in ("s", "u", "a") else "o"
    return kind if bare[-1] in ".!?" else kind.upper()


def _targets(entry: int, length: int) -> Iterator[tuple[str, int]]:
    """Strings of ``length`` that the grammar may write from ``entry``, and the state after each."""
    if not length:
        yield "", entry
        return
    first = "au" if entry == USER else "ua"
    plain = (first * length)[:length]
    yield plain, USER if plain[-1] == "u" else ASSISTANT
    if entry == START:
        told = "s" + ("ua" * length)[: length - 1]
        yield told, {"s": SYSTEM, "u": USER, "a": ASSISTANT}[told[-1]]


def align(rows: str, target: str, most: int) -> tuple[int, str] | None:
    """Cheapest (cost, audit) that turns ``rows`` into ``target``; None if above ``most``."""
    n, m = len(rows), len(target)

    def least(shift: int) -> int:
        return INSERT * shift if shift > 0 else -DELETE * shift

    band = [k for k in range(-n, m + 1) if least(k) + least(m - n - k) <= most]
    if not band:
        return None
    low, high = band[0], band[-1]
    table = [[FAR] * (m + 1) for _ in range(n + 1)]
    table[n][m] = 0  # nothing is inserted after the last turn here
    for i in range(n - 1, -1, -1):
        row, below, kind = table[i], table[i + 1], rows[i]
        for j in range(min(m, i + high), max(0, i + low) - 1, -1):
            best = below[j] + DELETE
            if j < m:
                best = min(best, row[j + 1] + INSERT, below[j + 1] + _match(kind, target[j]))
            row[j] = best
    cost = table[0][0]
    if cost > most:
        return None
    i = j = 0
    audit = []
    while i < n:  # the least letter among the cheapest ways on
        left = table[i][j]
        if table[i + 1][j] + DELETE == left:
            audit.append("D")
            i += 1
        elif j < m and table[i][j + 1] + INSERT == left:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if rows[i].lower() == target[j] else "R")
            i, j = i + 1, j + 1
    return cost, "".join(audit)


def _match(kind: str, wanted: str) -> int:
    if kind == "x":
        return FAR
    change = 0 if kind.lower() == wanted else REROLE if wanted in NAMES else FAR
    return change + (CUT if kind.isupper() else 0)


@lru_cache(maxsize=1 << 16)
def piece(rows: str, entry: int) -> tuple[tuple[int, int, str], ...]:
    """(exit, cost, audit) for each state that ``rows`` can lead to from ``entry``."""
    best: dict[int, tuple[int, str]] = {}
    n = len(rows)
    # Lengths near that of the rows first: they give a low incumbent.
    for length in sorted(range(0, 2 * n + 3), key=lambda m: abs(m - n)):
        for target, state in _targets(entry, length):
            found = align(rows, target, best[state][0] if state in best else FAR - 1)
            if found and (state not in best or found < best[state]):
                best[state] = found
    return tuple((state, *best[state]) for state in sorted(best))


class Paths:
    """Cheapest audits of the turns so far, by the state before them and the state after them."""

    def __init__(self, entries: Sequence[int]) -> None:
        # (cost, rank among the audits of the same entry, pieces of the audit as a chain)
        self.best = {e: {e: (0, 0, None)} for e in entries}

    def add(self, rows: str) -> None:
        for entry, ways in self.best.items():
            after: dict[int, tuple] = {}
            for middle, (cost, rank, chain) in ways.items():
                for state, more, audit in piece(rows, middle):
                    way = (cost + more, rank, audit, chain)
                    if state not in after or way[:3] < after[state][:3]:
                        after[state] = way
            order = sorted((way[1], way[2]) for way in after.values())
            self.best[entry] = {
                state: (cost, order.index((rank, audit)), (chain, audit))
                for state, (cost, rank, audit, chain) in after.items()
            }

    def audit(self, entry: int, state: int) -> str:
        chain, parts = self.best[entry][state][2], []
        while chain:
            chain, audit = chain
            parts.append(audit)
        return "".join(reversed(parts))


# What has to be inserted at the very end to leave each state in a sound conversation.
ENDING = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}


def ending(ways: dict[int, tuple]) -> int:
    """The state whose way, with what must be inserted behind it, is cheapest; then least."""
    return min(ways, key=lambda s: (ways[s][0] + INSERT * len(ENDING[s]), ways[s][1]))


def edited(turns: Sequence[tuple[str, str]], audit: str, entry: int) -> list[dict[str, str | None]]:
    """Edits of (role, text) turns by an audit: what each leaves, nothing where it deletes."""
    out, state, at = [], entry, 0
    for letter in audit:
        role, text = turns[at] if letter != "I" else (None, "")
        at += letter != "I"
        if letter == "D":
            out.append({"edit": "D", "role": None, "text": None})
            continue
        if letter == "K" and role[:1] == "s":
            state = SYSTEM
        else:
            state = ASSISTANT if state == USER else USER
        if letter != "K":
            role = "user" if state == USER else "assistant"
        out.append({"edit": letter, "role": role, "text": text})
    return out


class _Counts:
    """Figures of turns in order; two stretches of a conversation merge into one."""

    def __init__(self) -> None:
        self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = 0
        self.first_turn = self.last_turn = self.first_role = self.last_role = None

    def add(self, turn: int | None, role: str, kind: str, blank: bool) -> None:
        if kind == "x":
            self.blank += blank
            self.duplicate += not blank
        elif kind.isupper():
            self.truncated += 1
        initial = role[:1]
        if self.last_role is None:
            self.first_role = initial
        elif self.last_role + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.last_role = initial
        if turn is not None:
            if self.last_turn is None:
                self.first_turn = turn
            self.distinct += turn != self.last_turn
            self.last_turn = turn


COUNTS = ("blank", "duplicate", "truncated", "illegal")
_TURN = pa.struct([("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
_COUNT_FIELDS = [(name, pa.int64()) for name in (*COUNTS, "distinct", "first_turn", "last_turn")]


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def _repair_whole(batches: Iterable[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Batches of (conv, turn, copies, role, text) in order to one row per conversation."""
    held: list[dict] = []
    size = 0
    for conv, turns in _conversations(_rows(batches)):
        counts, paths, letters, texts, seen = _Counts(), Paths([START]), [], [], set()
        for turn, copies, role, text in turns:
            for _ in range(copies):
                kind = symbol(role, text, (role, text) in seen)
                seen.add((role, text))
                counts.add(turn, role, kind, not text.strip(SPACES))
                letters.append(kind)
                texts.append((role, text))
                size += len(text) + 64
        for at in range(0, len(letters), PIECE):
            paths.add("".join(letters[at : at + PIECE]))
        state = ending(paths.best[START])
        audit = paths.audit(START, state) + ENDING[state]
        cost = paths.best[START][state][0] + INSERT * len(ENDING[state])
        held.append({
            "conv": conv, "block": 0, "last": True, "cost": cost,
            **{name: getattr(counts, name) for name, _ in _COUNT_FIELDS},
            "turns": edited(texts, audit, START),
        })
        if size > BLOCK_BYTES or len(held) >= 4096:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _conversations(rows: Iterable[tuple]) -> Iterator[tuple[object, list[tuple]]]:
    """Rows that stand together by conversation; a conversation of dropped rows has no turns."""
    name, turns, begun = None, [], False
    for conv, *turn in rows:
        if begun and conv != name:
            yield name, turns
            turns = []
        name, begun = conv, True
        if turn[1]:
            turns.append(tuple(turn))
    if begun:
        yield name, turns


_MATRIX = pa.list_(pa.struct([
    ("entry", pa.int32()), ("state", pa.int32()), ("cost", pa.int64()), ("rank", pa.int32()),
    ("audit", pa.string()),
]))


def _blocks(
    batches: Iterable[pa.RecordBatch], schema: pa.Schema, block_turns: int
) -> Iterator[pa.RecordBatch]:
    """Sorted turns (conv, turn, copies, role, text, seen) of long conversations to blocks of
    bounded size, each with its ways from every state to every state."""
    part = TaskContext.get().partitionId()
    made = 0

    def block(conv: object, turns: list[tuple]) -> pa.RecordBatch:
        nonlocal made
        counts, paths, letters, texts = _Counts(), Paths(STATES), [], []
        for turn, role, text, kind, blank in turns:
            counts.add(turn, role, kind, blank)
            letters.append(kind)
            texts.append({"role": role, "text": text})
        for at in range(0, len(letters), PIECE):
            paths.add("".join(letters[at : at + PIECE]))
        made += 1
        ways = [
            {"entry": e, "state": s, "cost": w[0], "rank": w[1], "audit": paths.audit(e, s)}
            for e, by_state in paths.best.items() for s, w in by_state.items()
        ]
        return pa.RecordBatch.from_pylist([{
            "conv": conv, "block": (part << 32) + made,
            **{name: getattr(counts, name) for name, _ in _COUNT_FIELDS},
            "first_role": counts.first_role, "last_role": counts.last_role,
            "ways": ways, "texts": texts,
        }], schema)

    name, turns, size = None, [], 0
    for conv, turn, copies, role, text, seen in _rows(batches):
        blank = not text.strip(SPACES)
        for copy in range(copies):
            if turns and (conv != name or size > BLOCK_BYTES or len(turns) >= block_turns):
                yield block(name, turns)
                turns, size = [], 0
            name, kind = conv, symbol(role, text, bool(seen or copy))
            left = None if kind == "x" else text  # what must go takes no room
            turns.append((turn, role, left, kind, blank))
            size += len(left or "") + 64
    if turns:
        yield block(name, turns)


def best_path(blocks: Sequence[list[dict]]) -> tuple[int, list[tuple[int, int]]]:
    """The cheapest way through blocks in order: its cost, and the states around each block."""
    ways: dict[int, tuple] = {START: (0, 0, None)}
    for matrix in blocks:
        after: dict[int, tuple] = {}
        for way in matrix:
            if way["entry"] not in ways:
                continue
            cost, rank, chain = ways[way["entry"]]
            new = (cost + way["cost"], rank, way["rank"], (chain, (way["entry"], way["state"])))
            if way["state"] not in after or new[:3] < after[way["state"]][:3]:
                after[way["state"]] = new
        order = sorted(way[1:3] for way in after.values())
        ways = {s: (w[0], order.index(w[1:3]), w[3]) for s, w in after.items()}
    state = ending(ways)
    chain, steps = ways[state][2], []
    while chain:
        chain, step = chain
        steps.append(step)
    return ways[state][0] + INSERT * len(ENDING[state]), steps[::-1]


def _clean(conversations: DataFrame) -> DataFrame:
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    return conversations.select(
        F.col("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.lit(1).alias("copies"), text("role").alias("role"), text("text").alias("text"),
    )


def damage(conversations: DataFrame) -> DataFrame:
    """Rows (conv, turn, copies, role, text) as the check damages them; dropped rows have no copies.

    The fault is crc32 of ``conv_id:turn`` modulo 20; a null is one space there and in the texts.
    """
    rows = _clean(conversations)
    key = F.concat_ws(
        ":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv", "turn")]
    )
    rows = rows.withColumn("fault", F.crc32(key.cast("binary")) % 20)
    is_ = lambda k: F.col("fault") == k
    return rows.select(
        "conv",
        F.when(~is_(0), F.col("turn")).alias("turn"),
        F.when(is_(0), 0).when(is_(3), 2).otherwise(1).alias("copies"),
        F.when(is_(4), "user").when(~is_(0), F.col("role")).otherwise("").alias("role"),
        F.when(is_(1) | is_(0), "")
        .when(is_(2), F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
        .alias("text"),
    )


def _same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def repair(rows: DataFrame, **limits: int) -> DataFrame:
    """Turns (conv, turn, copies, role, text) to repaired blocks, one per conversation unless long.

    Columns: conv, block (orders the blocks), last (the conversation's last block), cost (of the whole
    conversation), blank, duplicate, truncated, illegal, gaps, and turns, the edits with what they leave.
    Turns go by number, nulls first, then role and text; rows equal in all of these are copies. A
    conversation whose rows all have no copies has one block without turns. Nulls in role or text are
    one space, a null conversation is one of its own. An empty table gives no rows; other columns are
    not read. A text is never cut. ``limits``: ``most_turns`` and ``most_bytes`` of a conversation that
    one task takes whole, and ``block_turns`` of a block of a longer one.
    """
    whole, long = repair_parts(rows, **limits)
    return whole if long is None else whole.unionByName(long)


def repair_parts(
    rows: DataFrame,
    most_turns: int = MOST_TURNS,
    most_bytes: int = MOST_BYTES,
    block_turns: int = BLOCK_TURNS,
) -> tuple[DataFrame, DataFrame | None]:
    """Blocks of ``repair``: of the conversations taken whole, and of the long ones if there are any."""
    spark = rows.sparkSession
    ship(spark)
    rows = rows.select(
        "conv", "turn", "copies",
        *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")],
    )
    sizes = rows.groupBy("conv").agg(
        F.sum("copies").alias("n"), F.sum(F.col("copies") * F.octet_length("text")).alias("b")
    )
    long = spill(
        sizes.filter((F.col("n") > most_turns) | (F.col("b") > most_bytes))
        .select(F.col("conv").alias("long_conv")), "long"
    )
    some = not long.isEmpty()
    short = rows.join(long, _same("conv", "long_conv"), "left_anti") if some else rows
    kind = rows.schema["conv"].dataType
    fields = ", ".join(f"{name} long" for name, _ in _COUNT_FIELDS)
    turns = "turns array<struct<edit:string,role:string,text:string>>"
    shape = f"conv {kind.simpleString()}, block long, last boolean, cost long, {fields}, {turns}"
    arrow = pa.schema([
        ("conv", _arrow(kind)), ("block", pa.int64()), ("last", pa.bool_()), ("cost", pa.int64()),
        *_COUNT_FIELDS, ("turns", pa.list_(_TURN)),
    ])
    order = ["conv", F.asc_nulls_first("turn"), "role", "text"]
    dealt = short.repartition("conv").sortWithinPartitions(*order)
    whole = dealt.mapInArrow(lambda batches: _repair_whole(batches, arrow), shape)
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("distinct"), F.lit(0))
    whole = whole.select("conv", "block", "last", "cost", *COUNTS, gaps.alias("gaps"), "turns")
    if not some:
        return whole, None
    hot = rows.join(long, _same("conv", "long_conv"), "left_semi").filter("copies > 0")
    return whole, _repair_long(spill(hot, "long-turns"), arrow.field("conv").type, block_turns)


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def _repair_long(rows: DataFrame, conv: pa.DataType, block_turns: int) -> DataFrame:
    """Blocks of conversations too long for one task, whose turns are dealt by ranges."""
    rows = rows.groupBy("conv", "turn", "role", "text").agg(F.sum("copies").cast("int").alias("copies"))
    text_key = F.sha2(F.concat_ws("\x00", "role", "text"), 256)
    rows = spill(rows.withColumn("text_key", text_key), "long-rows")
    # Nulls come first, so that the earliest copy is the least of (has a turn, turn).
    place = F.struct(F.col("turn").isNotNull().alias("has"), F.col("turn").alias("turn"))
    first = rows.groupBy("conv", "text_key").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    first = first.filter("n > 1").select(
        F.col("conv").alias("first_conv"), F.col("text_key").alias("first_key"), "first"
    )
    on = _same("conv", "first_conv") & (F.col("text_key") == F.col("first_key"))
    seen = F.coalesce(F.col("first") < place, F.lit(False)).alias("seen")
    flagged = rows.join(first, on, "left").select("conv", "turn", "copies", "role", "text", seen, "text_key")
    dealt = flagged.repartitionByRange("conv", F.asc_nulls_first("turn"), "role", "text_key")
    dealt = dealt.sortWithinPartitions("conv", F.asc_nulls_first("turn"), "role", "text").drop("text_key")
    arrow = pa.schema([
        ("conv", conv), ("block", pa.int64()), *_COUNT_FIELDS,
        ("first_role", pa.string()), ("last_role", pa.string()), ("ways", _MATRIX),
        ("texts", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))),
    ])
    fields = ", ".join(f"{name} long" for name, _ in _COUNT_FIELDS)
    ways = "array<struct<entry:int,state:int,cost:long,rank:int,audit:string>>"
    kind = rows.schema["conv"].dataType.simpleString()
    shape = (
        f"conv {kind}, block long, {fields}, first_role string, last_role string, ways {ways}, "
        "texts array<struct<role:string,text:string>>"
    )
    cut = dealt.mapInArrow(lambda batches: _blocks(batches, arrow, block_turns), shape)
    blocks = spill(cut, "blocks")
    # Of each block only its figures, costs and ranks: a few hundred bytes for thousands of turns.
    small = F.transform("ways", lambda w: w.dropFields("audit")).alias("ways")
    figures = [name for name, _ in _COUNT_FIELDS]
    told = F.struct("block", *figures, "first_role", "last_role", small)
    whole = blocks.groupBy("conv").agg(F.sort_array(F.collect_list(told)).alias("blocks"))
    steps = whole.select("conv", _summary(F.col("blocks")).alias("s")).select(
        F.col("conv").alias("step_conv"), "s.cost", *[f"s.{c}" for c in (*COUNTS, "gaps")],
        F.explode("s.steps").alias("step"),
    ).select("*", "step.*").drop("step")
    joined = blocks.drop(*COUNTS).join(
        steps, _same("conv", "step_conv") & (F.col("block") == F.col("step_block"))
    )
    audit = F.filter("ways", lambda w: (w["entry"] == F.col("entry")) & (w["state"] == F.col("state")))
    audit = F.concat(audit[0]["audit"], F.when(F.col("last"), _ends(F.col("state"))).otherwise(""))
    return joined.select(
        "conv", "block", "last", "cost", *COUNTS, "gaps",
        _edits(F.col("texts"), audit, F.col("entry")).alias("turns"),
    )


def _ends(state: Column) -> Column:
    return F.element_at(F.array(*[F.lit(ENDING[s]) for s in STATES]), state + 1)


_SUMMARY = pa.struct([
    ("cost", pa.int64()), *[(c, pa.int64()) for c in (*COUNTS, "gaps")],
    ("steps", pa.list_(pa.struct([
        ("step_block", pa.int64()), ("entry", pa.int32()), ("state", pa.int32()), ("last", pa.bool_()),
    ]))),
])


def summarise(blocks: Sequence[dict]) -> dict:
    """One conversation's figures and its way through its blocks, from the blocks' figures."""
    cost, steps = best_path([b["ways"] for b in blocks])
    out = {name: sum(b[name] for b in blocks) for name in COUNTS}
    for before, after in zip(blocks, blocks[1:], strict=False):
        out["illegal"] += before["last_role"] + after["first_role"] not in ("su", "ua", "au")
    distinct, first, last = 0, None, None
    for b in blocks:
        if b["first_turn"] is None:
            continue
        distinct += b["distinct"] - (b["first_turn"] == last)
        first, last = b["first_turn"] if first is None else first, b["last_turn"]
    out["gaps"] = 0 if first is None else last - first + 1 - distinct
    out["cost"] = cost
    out["steps"] = [
        {"step_block": b["block"], "entry": e, "state": s, "last": b is blocks[-1]}
        for b, (e, s) in zip(blocks, steps, strict=True)
    ]
    return out


def _summary(blocks: Column) -> Column:
    steps = "array<struct<step_block:long,entry:int,state:int,last:boolean>>"
    counts = ",".join(f"{c}:long" for c in (*COUNTS, "gaps"))

    @F.arrow_udf(f"struct<cost:long,{counts},steps:{steps}>")
    def column(groups: pa.Array) -> pa.Array:
        return pa.array([summarise(group) for group in groups.to_pylist()], type=_SUMMARY)

    return column(blocks)


def _edits(texts: Column, audit: Column, entry: Column) -> Column:
    @F.arrow_udf("array<struct<edit:string,role:string,text:string>>")
    def column(texts: pa.Array, audits: pa.Array, entries: pa.Array) -> pa.Array:
        rows = zip(texts.to_pylist(), audits.to_pylist(), entries.to_pylist(), strict=True)
        out = [edited([(t["role"], t["text"]) for t in ts], audit, e) for ts, audit, e in rows]
        return pa.array(out, type=pa.list_(_TURN))

    return column(texts, audit, entry)


def audits(rows: DataFrame, **limits: int) -> DataFrame:
    """Turns, repaired, to one row per conversation: figures, audit and repaired_sha256.

    A conversation in one block is digested in its row. Those of several blocks are read in order by
    one task each, block by block, since SHA-256 has no parts that could be put together.
    """
    lines = F.transform(
        F.filter("turns", lambda t: t["edit"] != "D"),
        lambda t: F.concat(t["role"], F.lit(":"), t["text"]),
    )
    whole, long = repair_parts(rows, **limits)
    one = whole.select(
        "conv", "cost", *COUNTS, "gaps",
        F.array_join(F.transform("turns", lambda t: t["edit"]), "").alias("audit"),
        F.sha2(F.array_join(lines, "\n"), 256).alias("repaired_sha256"),
    )
    if long is None:
        return one
    many = long.select(
        "conv", "block", "last", "cost", *COUNTS, "gaps",
        F.array_join(F.transform("turns", lambda t: t["edit"]), "").alias("audit"),
        lines.alias("lines"),
    )
    names = ["conv", "cost", *COUNTS, "gaps", "audit", "repaired_sha256"]
    arrow = pa.schema([
        ("conv", _arrow(rows.schema["conv"].dataType)), *[(c, pa.int64()) for c in names[1:-2]],
        ("audit", pa.string()), ("repaired_sha256", pa.string()),
    ])

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha, parts, begun = hashlib.sha256(), [], False
        for batch in batches:
            for row in batch.to_pylist():
                for line in row["lines"]:
                    sha.update(("\n" if begun else "").encode() + line.encode())
                    begun = True
                parts.append(row["audit"])
                if row["last"]:
                    done = {c: row[c] for c in names[:-2]}
                    done |= {"audit": "".join(parts), "repaired_sha256": sha.hexdigest()}
                    yield pa.RecordBatch.from_pylist([done], arrow)
                    sha, parts, begun = hashlib.sha256(), [], False

    ordered = many.repartition("conv").sortWithinPartitions("conv", "block")
    return one.unionByName(ordered.mapInArrow(digest, one.schema))
