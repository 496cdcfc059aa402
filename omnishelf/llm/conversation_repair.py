"""Conversation repair: the cheapest edits that make the roles of a conversation alternate.

An edit script's weight is one integer. Its high digits are the cost; its low digits are the letters
of the script, three bits each, written from the left with zeros behind the last one. So the least
integer is the cheapest script and, among equal costs, the one whose letters come first. The scripts
are the paths of a graph without cycles (row, inserts before it, state of the roles so far), and the
least path is found from the last row backwards: an edit in front of a script adds its cost to the
high digits and pushes the low digits one letter to the right.

Long conversations are cut into blocks of rows. For a block the least weight from each state to each
state is found on its own, anywhere in the cluster; the blocks of a conversation are then joined by
the same rule, with blocks in the place of rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from omnishelf.llm.common import ready, stored

# Rows that are weighed as one; a conversation of more is cut.
BLOCK = 512

# The roles so far: none, a system turn, a user turn last, an assistant turn last.
NONE, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
# Where a role's initial leads from each state (s?(ua)+)?; others lead nowhere.
STEP = {
    "s": {NONE: SYSTEM},
    "u": {NONE: USER, SYSTEM: USER, ASSISTANT: USER},
    "a": {USER: ASSISTANT},
}
ENDS = (NONE, ASSISTANT)
NAMES = {"u": "user", "a": "assistant"}
# The costs of the edits, and of a truncated row that stays.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
# Digits of the letters, in their ASCII order; 0 is the padding.
LETTERS = " DIKR"
DIGIT = {c: i for i, c in enumerate(LETTERS) if i}
BITS = 3

Weight = int | None


def _edits(initial: str, must_go: bool, truncated: bool) -> list[list[tuple[int, int, int]]]:
    """For each state the row's edits as (cost, digit, next state)."""
    out = []
    for state in STATES:
        edits = [(DELETE, DIGIT["D"], state)]
        if not must_go:
            extra = TRUNCATED if truncated else 0
            if state in STEP.get(initial, {}):
                edits.append((KEEP + extra, DIGIT["K"], STEP[initial][state]))
            edits += [
                (REROLE + extra, DIGIT["R"], STEP[to][state]) for to in NAMES if state in STEP[to]
            ]
        out.append(edits)
    return out


_EDITS = {
    (initial, must_go, truncated): _edits(initial, must_go, truncated)
    for initial in "sua?" for must_go in (False, True) for truncated in (False, True)
}
_INSERTS = [[STEP[to][state] for to in NAMES if state in STEP[to]] for state in STATES]


def _room(n_rows: int) -> int:
    """Letters that a least script over ``n_rows`` rows may need.

    Deleting all rows and inserting two turns costs 2 a row and 10, and a kept system turn at most 5
    more; so a least script has no more inserts than a fifth of that. Two more are tried in a gap.
    """
    return n_rows + (DELETE * n_rows + 15) // INSERT + 3


def _least(weights: Sequence[Weight]) -> Weight:
    return min((w for w in weights if w is not None), default=None)


def _with_inserts(after: list[Weight], room: int) -> list[Weight]:
    """The least weights where up to two turns may be inserted first; more never pay, for three
    lead where one does."""
    width = BITS * room
    low, cost, digit = (1 << width) - 1, INSERT << width, DIGIT["I"] << (width - BITS)
    for _ in range(2):
        pushed = [
            None if w is None else w - (w & low) + cost + digit + ((w & low) >> BITS) for w in after
        ]
        after = [_least([after[q], *[pushed[to] for to in _INSERTS[q]]]) for q in STATES]
    return after


def weigh(rows: Sequence[tuple[str, bool, bool]], last: list[Weight], room: int) -> list[Weight]:
    """Least weights from each state before the rows, given those behind them.

    A row is (role's initial or ``?`` if no state takes it, must be deleted, truncated).
    """
    width = BITS * room
    low = (1 << width) - 1
    after = last
    for initial, must_go, truncated in reversed(rows):
        pushed = [None if w is None else w - (w & low) + ((w & low) >> BITS) for w in after]
        here = [
            _least([
                None if pushed[to] is None
                else pushed[to] + (cost << width) + (digit << (width - BITS))
                for cost, digit, to in edits
            ])
            for edits in _EDITS[initial, must_go, truncated]
        ]
        after = _with_inserts(here, room)
    return after


def end_weights(room: int) -> list[Weight]:
    """Least weights behind the last row: inserts may still complete the roles."""
    return _with_inserts([0 if q in ENDS else None for q in STATES], room)


def script(weight: int, room: int) -> tuple[int, str]:
    """The cost and the letters that a weight stands for."""
    width = BITS * room
    digits = weight & ((1 << width) - 1)
    letters = (LETTERS[(digits >> (width - BITS * (i + 1))) & 7] for i in range(room))
    return weight >> width, "".join(letters).rstrip(" ")


def weight_of(cost: int, letters: str, room: int) -> int:
    digits = 0
    for c in letters:
        digits = digits << BITS | DIGIT[c]
    return cost << BITS * room | digits << BITS * (room - len(letters))


# Short conversations are much alike, and a block's scripts depend on nothing but its rows' kinds.
@lru_cache(maxsize=1 << 14)
def block_table(rows: tuple[tuple[str, bool, bool], ...]) -> list[list[tuple[int, str] | None]]:
    """From each state to each state over a block of rows: the least script, inserts included that
    stand before a row of the block."""
    room = _room(len(rows))
    to_state = [
        weigh(rows, [0 if q == to else None for q in STATES], room) for to in STATES
    ]
    return [
        [None if to_state[to][q] is None else script(to_state[to][q], room) for to in STATES]
        for q in STATES
    ]


def join_blocks(tables: Sequence[list[list[tuple[int, str] | None]]], n_rows: int) -> tuple[int, str]:
    """The least script over all blocks of a conversation: blocks are weighed as rows are."""
    room = _room(n_rows)
    width = BITS * room
    low = (1 << width) - 1
    after = end_weights(room)
    for table in reversed(tables):
        after = [
            _least([
                None if found is None or after[to] is None
                else weight_of(*found, room)
                + after[to] - (after[to] & low) + ((after[to] & low) >> BITS * len(found[1]))
                for to, found in enumerate(table[q])
            ])
            for q in STATES
        ]
    return script(after[NONE], room)


def repaired(rows: Iterator[tuple[str, str]], letters: Iterator[str]) -> Iterator[tuple[str, str]]:
    """The (role, text) rows that a script's letters make of ``rows``."""
    state = NONE
    for letter in letters:
        if letter == "I":
            role, text = ("assistant" if state == USER else "user"), ""
        else:
            role, text = next(rows)
            if letter == "D":
                continue
            if letter == "R":
                role = "assistant" if state == USER else "user"
        state = STEP[role[:1]][state]
        yield role, text


# ---- on Spark --------------------------------------------------------------------------------

SPACES = " \t\n\x0b\x0c\r"


def numbered(turns: DataFrame) -> DataFrame:
    """The rows in one global order by conversation, turn, role and text, with their place ``at``.

    Dealt by range, so a conversation with a third of all rows spans as many tasks as it needs.
    Written once, so that every later reader sees the same places.
    """
    rows = turns.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    )
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.col("role")]
    # The bounds of the ranges reach the driver, so they hold a text's beginning only.
    dealt = rows.repartitionByRange(*order, F.substring("text", 1, 32))
    sorted_rows = dealt.sortWithinPartitions(*order, "text")
    return stored(sorted_rows.withColumn("at", F.monotonically_increasing_id()))


def faults(rows: DataFrame) -> DataFrame:
    """``numbered`` rows without their texts: conv_id, at, turn, initial, and the row's first fault
    (blank, duplicate, truncated or null).

    A row is a duplicate if its role and text stand earlier in its conversation. Earliest places are
    counted per task before they are shuffled, and joined back on two exchanges, so that a row that
    repeats millions of times does not gather in one task.
    """
    core = F.rtrim(F.col("text"), F.lit(SPACES))
    end = F.right(core, F.lit(1))
    own = F.when(core == "", "blank").when(~end.isin(".", "!", "?"), "truncated")
    said = F.sha2(F.concat("role", F.lit("\x00"), "text"), 256)
    light = rows.select(
        "conv_id", "at", "turn", F.substring("role", 1, 1).alias("initial"), own.alias("own"),
        F.struct("conv_id", said.alias("said")).alias("row"),
    )
    firsts = light.groupBy("row").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("copies"))
    first = F.when(F.col("copies") > 0, F.col("row")).alias("row_again")
    repeated = firsts.filter("copies > 1").select(first, "first")
    joined = light.join(repeated, F.col("row").eqNullSafe(F.col("row_again")), "left")
    again = F.col("at") > F.col("first")
    fault = F.when((F.col("own") == "blank"), "blank").when(again, "duplicate").otherwise(F.col("own"))
    return joined.select("conv_id", "at", "turn", "initial", fault.alias("fault"))


_ENTRY = "array<struct<cost:long,letters:string>>"
BLOCKS = (
    "conv_id long, at long, n_rows long, blank long, duplicate long, truncated long, illegal long, "
    "first_initial string, last_initial string, first_turn long, last_turn long, n_turns long, "
    f"scripts {_ENTRY}"
)
_BLOCKS = pa.schema([
    ("conv_id", pa.int64()), ("at", pa.int64()), ("n_rows", pa.int64()), ("blank", pa.int64()),
    ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()),
    ("first_initial", pa.string()), ("last_initial", pa.string()), ("first_turn", pa.int64()),
    ("last_turn", pa.int64()), ("n_turns", pa.int64()),
    ("scripts", pa.list_(pa.struct([("cost", pa.int64()), ("letters", pa.string())]))),
])
# The pairs of neighbouring initials that a conversation may hold.
LEGAL = {"su", "ua", "au"}


class _Block:
    """Counts and rows of a stretch of one conversation."""

    def __init__(self, conv, at):
        self.conv, self.at = conv, at
        self.rows: list[tuple[str, bool, bool]] = []
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = self.n_turns = 0
        self.first_turn = self.last_turn = self.first_initial = self.initial = None

    def add(self, turn, initial, fault):
        if not self.rows:
            self.first_initial = initial
        elif self.initial + initial not in LEGAL:
            self.illegal += 1
        self.initial = initial
        if fault:
            self.counts[fault] += 1
        if turn is not None and turn != self.last_turn:
            self.n_turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        kind = initial if initial in STEP else "?"
        self.rows.append((kind, fault in ("blank", "duplicate"), fault == "truncated"))

    def result(self) -> tuple:
        entries = [
            {"cost": None, "letters": None} if e is None else {"cost": e[0], "letters": e[1]}
            for row in block_table(tuple(self.rows)) for e in row
        ]
        return (self.conv, self.at, len(self.rows), *self.counts.values(), self.illegal,
                self.first_initial, self.initial, self.first_turn, self.last_turn, self.n_turns, entries)


def blocks(faulty: DataFrame, size: int = BLOCK) -> DataFrame:
    """One row per stretch of at most ``size`` rows of a conversation: counts and least scripts."""

    def cut(batches: Iterator[pa.RecordBatch]):
        block = None
        for batch in batches:
            done = []
            for conv, at, turn, initial, fault in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                if block is not None and (block.conv != conv or len(block.rows) >= size):
                    done.append(block.result())
                    block = None
                if block is None:
                    block = _Block(conv, at)
                block.add(turn, initial, fault)
            yield _batch(done, _BLOCKS)
        if block is not None:
            yield _batch([block.result()], _BLOCKS)

    dealt = faulty.repartitionByRange("at").sortWithinPartitions("at")
    return dealt.select("conv_id", "at", "turn", "initial", "fault").mapInArrow(cut, BLOCKS)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


REPORT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string"
)
_REPORT = pa.schema([
    ("conv_id", pa.int64()), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()),
    ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()),
])


def _summary(found: list[dict]) -> tuple:
    """The report of a conversation from its blocks in order."""
    total = lambda name: sum(b[name] for b in found)
    illegal, n_turns, last = total("illegal"), total("n_turns"), None
    for before, after in zip(found, found[1:], strict=False):
        illegal += before["last_initial"] + after["first_initial"] not in LEGAL
    turned = [b for b in found if b["first_turn"] is not None]
    for b in turned:
        n_turns -= b["first_turn"] == last
        last = b["last_turn"]
    gaps = turned[-1]["last_turn"] - turned[0]["first_turn"] + 1 - n_turns if turned else 0
    tables = []
    for b in found:
        entries = [None if e["cost"] is None else (e["cost"], e["letters"]) for e in b["scripts"]]
        tables.append([entries[4 * q : 4 * q + 4] for q in STATES])
    cost, audit = join_blocks(tables, total("n_rows"))
    return (found[0]["conv_id"], gaps, total("blank"), total("duplicate"), total("truncated"),
            illegal, cost, audit)


def reports(cut: DataFrame) -> DataFrame:
    """One row per conversation from its blocks."""

    def join(batches: Iterator[pa.RecordBatch]):
        found: list[dict] = []
        for batch in batches:
            done = []
            for block in batch.to_pylist():
                if found and found[0]["conv_id"] != block["conv_id"]:
                    done.append(_summary(found))
                    found = []
                found.append(block)
            yield _batch(done, _REPORT)
        if found:
            yield _batch([_summary(found)], _REPORT)

    dealt = cut.repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), "at")
    return dealt.mapInArrow(join, REPORT)


RESULT = f"{REPORT}, repaired_sha256 string"
# Results that leave a task at a time.
RESULT_ROWS = 1024
_RESULT = _REPORT.append(pa.field("repaired_sha256", pa.string()))


def digests(report: DataFrame, rows: DataFrame) -> DataFrame:
    """The reports with the digest of each repaired conversation.

    A conversation's report goes before its rows in one sorted stream, so a task holds one script
    and one row at a time.
    """

    def walk(batches: Iterator[pa.RecordBatch]):
        done = []
        for own, stream in _conversations(batches):
            digest, first = hashlib.sha256(), True
            for role, text in repaired(stream, iter(own[-1])):
                digest.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                first = False
            for _ in stream:
                pass
            done.append((*own, digest.hexdigest()))
            if len(done) >= RESULT_ROWS:
                yield _batch(done, _RESULT)
                done = []
        yield _batch(done, _RESULT)

    fields = [f.name for f in _REPORT]
    tagged = report.withColumn("at", F.lit(-1).cast("long")).unionByName(
        rows.select("conv_id", "at", "role", "text"), allowMissingColumns=True
    ).select(*fields, "at", "role", "text")
    order = [F.asc_nulls_first("conv_id"), F.col("at")]
    dealt = tagged.repartition("conv_id").sortWithinPartitions(*order)
    return dealt.mapInArrow(walk, RESULT)


def _conversations(batches: Iterator[pa.RecordBatch]):
    """(report, iterator of its rows as (role, text)) for each conversation of a sorted stream of
    the report's columns, at, role and text."""
    cells = (
        row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True)
    )
    ahead = next(cells, None)
    while ahead is not None:
        own = ahead[:-3]

        def stream():
            nonlocal ahead
            while (ahead := next(cells, None)) is not None and ahead[-3] >= 0:
                yield ahead[-2], ahead[-1]

        yield own, stream()


def repair_conversations(turns: DataFrame, size: int = BLOCK) -> DataFrame:
    """Per conversation its faults, the cheapest edits and a digest of the repaired rows.

    Rows go by turn (nulls first), then role and text, so ties and repeated rows have one order. A
    null role or text is one space. A row's first fault counts: blank (no character but blanks),
    duplicate (role and text seen earlier), truncated (the last such character is none of ``.!?``).
    A role's initial is its first character; an empty role has none and cannot be kept. gaps are
    missing turn numbers between the least and the largest, null turns aside; illegal counts the
    neighbours whose initials are not su, ua or au. Rows without a conv_id form one conversation.
    Of other columns nothing is read; an empty table gives an empty result.
    """
    ready(turns.sparkSession)
    rows = numbered(turns)
    return digests(stored(reports(blocks(faults(rows), size))), rows)


# ---- the contract's damage -------------------------------------------------------------------


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with faults planted by a hash of conversation and turn.

    Of 20 rows one is dropped, one emptied, one loses its sentence ends, one is repeated and one
    becomes a user turn. Nulls in the hash, the role and the text are one space.
    """
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    key = F.concat(text("conv_id"), F.lit(":"), text("turn"))
    kind = F.crc32(key) % 20
    rows = turns.select(
        "conv_id", "turn", text("role").alias("role"), text("text").alias("text"), kind.alias("kind")
    )
    return rows.filter("kind <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "")
        .when(F.col("kind") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))),
    ).drop("col")


def with_all(result: DataFrame, turns: DataFrame) -> DataFrame:
    """The result with a row for every conversation of ``turns``: zeros where no row was left."""
    every: Column = F.col("conv_id").cast("long").alias("every")
    ids = turns.groupBy(every).agg(F.count(F.lit(1)).alias("n"))
    ids = ids.select(F.when(F.col("n") > 0, F.col("every")).alias("every"))
    nothing = hashlib.sha256(b"").hexdigest()
    joined = ids.join(result, F.col("every").eqNullSafe(F.col("conv_id")), "left")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return joined.select(
        F.col("every").alias("conv_id"),
        *[F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )
