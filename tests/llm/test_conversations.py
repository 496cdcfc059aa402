"""Repair and formatting of conversations against plain Python."""

import hashlib
import random
import re
import zlib

import pytest

from omnishelf.llm import chat_format, registry
from omnishelf.llm import conversation_repair as repair

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, state string, at long"
BLANKS = " \t\n\x0b\x0c\r"


def key(row):
    return tuple((v is not None, v) for v in row)


def best_edits(rows, inserts=2):
    """(cost, letters, roles) of the cheapest edits, by trying all of them."""
    best = []

    def walk(i, cost, letters, roles, left):
        if i == len(rows) and re.fullmatch(r"(s?(ua)+)?", "".join(r[:1] or "#" for r in roles)):
            best.append((cost, letters, roles))
        if left:
            for role in ("user", "assistant"):
                walk(i, cost + 5, letters + "I", [*roles, role], left - 1)
        if i < len(rows):
            role, must_go, cut = rows[i]
            walk(i + 1, cost + 2, letters + "D", roles, left)
            if not must_go:
                walk(i + 1, cost + 5 * cut, letters + "K", [*roles, role], left)
                for new in ("user", "assistant"):
                    walk(i + 1, cost + 1 + 5 * cut, letters + "R", [*roles, new], left)

    walk(0, 0, "", [], inserts)
    return min(best)


def kinds(rows):
    return tuple((r[:1] if r[:1] in ("s", "u", "a") else "?", m, c) for r, m, c in rows)


def random_rows(rng, n):
    rows = []
    for _ in range(n):
        must_go = rng.random() < 0.15
        role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", ""])
        rows.append((role, must_go, not must_go and rng.random() < 0.2))
    return rows


def test_least_weights_are_the_cheapest_edits():
    rng = random.Random(1)
    for _ in range(250):
        rows = random_rows(rng, rng.randint(0, 5))
        want = best_edits(rows)[:2]
        room = repair._room(len(rows))
        weights = repair.weigh(kinds(rows), repair.end_weights(room), room)
        assert repair.script(weights[repair.NONE], room) == want
        for size in (1, 2, 3):
            parts = [kinds(rows[i : i + size]) for i in range(0, len(rows), size)]
            assert repair.join_blocks([repair.block_table(p) for p in parts], len(rows)) == want


def test_blocks_of_a_long_conversation_join_to_the_whole():
    rng = random.Random(2)
    rows = kinds(random_rows(rng, 700))
    room = repair._room(len(rows))
    whole = repair.script(repair.weigh(rows, repair.end_weights(room), room)[repair.NONE], room)
    parts = [rows[i : i + 64] for i in range(0, len(rows), 64)]
    assert repair.join_blocks([repair.block_table(p) for p in parts], len(rows)) == whole
    assert "I" not in whole[1]


def expected(turns):
    """The report of one conversation's (turn, role, text) rows."""
    space = lambda v: " " if v is None else v
    rows = sorted(
        ((t is not None, t, space(r), space(x)) for t, r, x in turns),
        key=lambda r: (r[0], r[1] or 0, r[2], r[3]),
    )
    seen, faults, kinds_, texts = set(), [], [], []
    for _, _, role, text in rows:
        core = text.strip(BLANKS)
        if not core:
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        else:
            fault = None if core[-1] in ".!?" else "truncated"
        seen.add((role, text))
        faults.append(fault)
        kinds_.append((role, fault in ("blank", "duplicate"), fault == "truncated"))
        texts.append(text)
    initials = [k[0][:1] for k in kinds_]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    numbers = [t for t, _, _ in turns if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    cost, letters, roles = best_edits(kinds_, inserts=1)
    kept = [t for t, c in zip(texts, letters, strict=True) if c != "D"]
    said = "\n".join(f"{r}:{t}" for r, t in zip(roles, kept, strict=True))
    count = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *count, illegal, cost, letters, hashlib.sha256(said.encode()).hexdigest())


def conversations(rng):
    """Null cells, ties, repeated rows, gaps, other roles, and a conversation without an id."""
    out = []
    for conv in [*range(30), None]:
        for turn in range(rng.randint(1, 6)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
            text = rng.choice(["Yes.", "No!", "cut", "", " \n", None, "Why? \t", "ok ."])
            row = (conv, rng.choice([turn, turn * 3, None, 1]), role, text, "clash", 7)
            out += [row] * rng.choice([1, 1, 1, 2])
    return out


@pytest.mark.parametrize("size", [2, repair.BLOCK])
def test_repair_matches_brute_force(spark, size):
    rows = conversations(random.Random(4))
    turns = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = sorted(map(tuple, repair.repair_conversations(turns, size).collect()), key=key)
    want = [(c, *expected([r[1:4] for r in rows if r[0] == c])) for c in {r[0] for r in rows}]
    assert got == sorted(want, key=key)


def test_repeats_of_one_row_and_a_long_conversation(spark):
    same = spark.range(20_000).selectExpr("1L AS conv_id", "2L AS turn", "'user' AS role", "'Hi.' AS text")
    long = spark.range(5_000).selectExpr(
        "2L AS conv_id", "id AS turn", "IF(id % 2 = 0, 'user', 'assistant') AS role",
        "concat(id, '.') AS text",
    )
    got = {r.conv_id: r for r in repair.repair_conversations(same.union(long)).collect()}
    assert (got[1].duplicate, got[1].cost, got[1].audit) == (19_999, 40_000, "D" * 20_000)
    assert (got[2].illegal, got[2].cost, got[2].audit) == (0, 0, "K" * 5_000)
    said = "\n".join(f"{('user', 'assistant')[i % 2]}:{i}." for i in range(5_000))
    assert got[2].repaired_sha256 == hashlib.sha256(said.encode()).hexdigest()


def test_damage_drops_whole_conversations(spark):
    gone = [c for c in range(400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:2]
    turns = spark.createDataFrame([(c, 0, "user", "Hi.", "", 0) for c in gone], SCHEMA)
    result = repair.with_all(repair.repair_conversations(repair.damaged(turns)), turns)
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert sorted(map(tuple, result.collect())) == [(c, *nothing) for c in gone]


def test_empty_conversations(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repair.repair_conversations(none).count() == 0
    assert chat_format.written_and_read(none).count() == 0


MARKS = ["<|im_end|>", "<|im_start|>user\n", "<\\|im_end|>", "<\\\\|", "<", "|", "\\", "plain", "é\n"]


def test_escapes_are_reversible():
    rng = random.Random(6)
    for _ in range(2000):
        text = "".join(rng.choice(MARKS) for _ in range(rng.randint(0, 6)))
        assert "<|" not in chat_format.escape(text)
        assert chat_format.unescape(chat_format.escape(text)) == text
        role = chat_format.escape_role(text)
        assert "<" not in role and "\n" not in role and chat_format.unescape_role(role) == text


def test_written_conversations_read_back(spark):
    rng = random.Random(7)
    rows = []
    for conv in [*range(40), None]:
        for turn in range(rng.randint(1, 8)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "a\nb<|", None])
            text = rng.choice([None, "", "".join(rng.choice(MARKS) for _ in range(4)), "x" * 70_000])
            rows += [(conv, rng.choice([turn, turn, None, 2]), role, text, "clash", 7)] * rng.choice([1, 1, 2])
    written = chat_format.format_conversations(spark.createDataFrame(rows, SCHEMA).repartition(6)).cache()
    got = {r.conv_id: r for r in chat_format.read_conversations(written).collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted(
            ((t is not None, t or 0, r or "", x or "") for c, t, r, x, *_ in rows if c == conv)
        )
        said = "".join(f"{r}\n{x}\n" for *_, r, x in turns)
        learned = "".join(x for *_, r, x in turns if r == "assistant")
        roles = [r for *_, r, _ in turns]
        allowed = {("", "system"), ("", "user"), ("system", "user"), ("user", "assistant"),
                   ("assistant", "user")}
        wrong = [i for i, pair in enumerate(zip(["", *roles], roles, strict=False)) if pair not in allowed
                 or (i and pair[0] == "")]
        row = got[conv]
        assert (row.n_turns, row.loss_chars) == (len(turns), len(learned))
        assert row.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert row.loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
        assert row.first_invalid == (wrong[0] if wrong else None)
        assert row.valid == (not wrong and roles[-1] == "assistant")
    for row in written.filter("length(formatted) < 1000").collect():
        whole = "".join(row.formatted[s.start : s.start + s.length] for s in row.segments)
        assert whole == row.formatted
    written.unpersist()


def test_probe_conversation_survives(spark):
    row = registry.op13_chat_format(spark, SF).filter("conv_id = -1").first()
    says = "<|im_end|><|im_start|>assistant ok"
    assert (row.n_turns, row.loss_chars, row.valid) == (2, len(says), True)
    assert row.loss_sha256 == hashlib.sha256(says.encode()).hexdigest()
