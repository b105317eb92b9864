import hashlib
import random
import re
import zlib
from itertools import product

import pytest

from termscope.llm import conversations as c

WHITE = " \t\n\x0b\x0c\r"
OPERATIONS = "DIKR"


def _after_damage(rows):
    """The damaged rows of one conversation, in order."""
    out = []
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(turn, role, text)] * (kind != 0) * (2 if kind == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))


def _faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.strip(WHITE)
        if not bare:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def _moves(state, row, fault):
    """(letter, cost, new state, role) of the edits of a row that keep initials legal."""
    new = {"": "u", "s": "u", "u": "a", "a": "u"}[state]
    extra = 3 * (fault == "truncated")
    yield "D", 4, state, None
    if fault in ("blank", "duplicate"):
        return
    legal = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
    if row[1][:1] and row[1][:1] in legal:
        yield "K", extra, row[1][:1], row[1]
    yield "R", 3 + extra, new, {"u": "user", "a": "assistant"}[new]


def _cheapest(rows, faults):
    """(cost, letters, lines) by a table of whole strings."""
    new = {"": "u", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    def inserted(table):
        for _ in range(3):
            for state in ("", "s", "u", "a"):
                cost, letters, lines = table[new[state]]
                more = (cost + 3, "I" + letters, (names[new[state]] + ":",) + lines)
                table[state] = min(table[state], more)
        return table

    table = inserted({"": (0, "", ()), "a": (0, "", ()), "u": (999, "", ()), "s": (999, "", ())})
    for row, fault in zip(reversed(rows), reversed(faults)):
        now = {}
        for state in ("", "s", "u", "a"):
            now[state] = min(
                (cost + table[to][0], letter + table[to][1],
                 ((f"{role}:{row[2]}",) if role is not None else ()) + table[to][2])
                for letter, cost, to, role in _moves(state, row, fault)
            )
        table = inserted(now)
    return table[""]


def _expected(rows):
    damaged = _after_damage(rows)
    faults = _faults(damaged)
    turns = [t for t, _, _ in damaged if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(damaged, damaged[1:])]
    cost, audit, lines = _cheapest(damaged, faults)
    return (
        gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
        hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def _conversations(seed, n=120, longest=40):
    rnd = random.Random(seed)
    rows = []
    for conv in [None, *range(n)]:
        turns = list(range(rnd.choice((0, 1, 2, 3, 8, 8, longest)) + 1))
        for turn in turns:
            role = rnd.choice(("user", "assistant", "user", "assistant", "system", "tool", None, ""))
            text = rnd.choice(("Yes.", "No!", "cut off", "Why? ", "", " \t", None, f"text {rnd.random()}.", "é。"))
            turn = None if rnd.random() < 0.05 else turn
            rows += [(conv, turn, role, text)] * rnd.choice((1, 1, 1, 1, 2))
    rnd.shuffle(rows)
    return rows


SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def _found(df):
    columns = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return {r.conv_id: tuple(r[k] for k in columns) for r in df.collect()}


@pytest.mark.parametrize("segment, span", [(4096, 4096), (5, 2)])
def test_conversations_are_repaired_as_defined(spark, segment, span):
    """Also in segments of a few rows, whose summaries are combined over several levels."""
    rows = _conversations(segment)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS key", "2 AS block", "3 AS code")
    found = _found(c.repaired_conversations(df, segment, span))
    assert set(found) == {r[0] for r in rows}
    for conv in found:
        assert found[conv] == _expected([r for r in rows if r[0] == conv]), conv


def test_the_table_of_strings_equals_trying_all_edits():
    """All edit strings of short conversations, over all legal initials."""
    rnd = random.Random(7)
    for _ in range(60):
        rows = [(i, rnd.choice(("user", "assistant", "system", "x")), rnd.choice(("a.", "b", "c!", ""))) for i in range(rnd.randint(0, 3))]
        faults = _faults(rows)
        best = None
        for length in range(2 * len(rows) + 4):
            for letters in product(OPERATIONS, repeat=length):
                if sum(x != "I" for x in letters) != len(rows):
                    continue
                for names in product("ua", repeat=sum(x in "IR" for x in letters)):
                    cost, at, left, initials = 0, 0, list(names), ""
                    for x in letters:
                        if x == "I":
                            cost, initials = cost + 3, initials + left.pop(0)
                            continue
                        fault = faults[at]
                        if x == "D":
                            cost += 4
                        elif fault in ("blank", "duplicate"):
                            cost += 999
                        else:
                            cost += 3 * (x == "R") + 3 * (fault == "truncated")
                            initials += left.pop(0) if x == "R" else rows[at][1][0]
                        at += 1
                    if re.fullmatch("(s?(ua)+)?", initials):
                        best = min(best or (999, ""), (cost, "".join(letters)))
        assert _cheapest(rows, faults)[:2] == best


def test_walks_keep_square_roots_of_vectors(monkeypatch):
    """A long conversation: cost and letters against the table of strings."""
    rnd = random.Random(5)
    codes = bytes(rnd.randrange(16) for _ in range(3000))
    state, letters, cost = c.NOTHING, "", c.costs(codes, c.END)[c.NOTHING]
    for own, state in c.walk(codes, c.END, c.NOTHING):
        letters += own
    letters += "I" * len(c.tail(state))
    assert sum(x != "I" for x in letters) == len(codes)
    names = {0: "system", 1: "user", 2: "assistant", 3: "x"}
    rows = [(i, names[code >> 2], "") for i, code in enumerate(codes)]
    faults = [(None, "blank", "duplicate", "truncated")[code & 3] for code in codes]
    assert _cheapest(rows, faults)[:2] == (cost, letters)


def test_conversations_of_nothing_and_of_dropped_rows(spark):
    assert c.repaired_conversations(spark.createDataFrame([], SCHEMA)).collect() == []
    gone = next(t for t in range(1000) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    df = spark.createDataFrame([(1, gone, "user", "x.")], SCHEMA)
    nothing = hashlib.sha256(b"").hexdigest()
    assert _found(c.repaired_conversations(df)) == {1: (0, 0, 0, 0, 0, 0, "", nothing)}


def test_a_very_long_text_and_a_long_conversation(spark):
    text = "word " * 400_000 + "."
    rows = [(5, i, "user" if i % 2 == 0 else "assistant", f"{text}{i % 7}") for i in range(12)]
    rows += [(6, i, "user" if i % 3 else "assistant", f"t{i}") for i in range(1000)]
    found = _found(c.repaired_conversations(spark.createDataFrame(rows, SCHEMA), 64, 4))
    assert found == {k: _expected([r for r in rows if r[0] == k]) for k in (5, 6)}
