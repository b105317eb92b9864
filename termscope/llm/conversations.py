"""Repair of the structure of conversations by cheapest edits.

Role initials of a repaired conversation read ``(s?(ua)+)?``. Cheapest edits come from a
dynamic programme over rows and four states, which is run backward and walked forward.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from hashlib import sha256
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termscope.operators.numbering import global_rank
from termscope.sources.storage import stored

#: Costs of the edits, the signs between words and those that end a text.
RENAME, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
_WHITE = "\x20\x09\x0a\x0b\x0c\x0d"
_ENDS = (".", "!", "?")
USER, ASSISTANT = "user", "assistant"

#: Rows of one segment: what is solved as a whole in memory.
SEGMENT = 4096
#: Segments, or groups of them, whose summaries are combined at once.
SPAN = 4096

#: States: nothing yet, after a system, a user or an assistant row.
NOTHING, SYSTEM, ASKED, ANSWERED = range(4)
_AFTER_KEEP = {
    (NOTHING, 0): SYSTEM, (NOTHING, 1): ASKED, (SYSTEM, 1): ASKED,
    (ANSWERED, 1): ASKED, (ASKED, 2): ANSWERED,
}
#: The state after the only user or assistant row that may follow.
_AFTER_NEW = (ASKED, ASKED, ANSWERED, ASKED)
_NEW_ROLE = (USER, USER, ASSISTANT, USER)

#: Classes of roles and faults of rows; a row's code is class * 4 + fault.
_INITIALS = "sua"
NO_FAULT, BLANK, DUPLICATE, TRUNCATED = range(4)
_FAR = 1 << 50

Vector = tuple[int, int, int, int]


def _closed(v: Sequence[int]) -> Vector:
    """Least costs when rows may be inserted first."""
    asked, answered = min(v[ASKED], INSERT + v[ANSWERED]), min(v[ANSWERED], INSERT + v[ASKED])
    return (
        min(v[NOTHING], INSERT + asked), min(v[SYSTEM], INSERT + asked), asked, answered,
    )


#: Costs after the last row: a conversation ends empty or with an answer.
END = _closed((0, _FAR, _FAR, 0))


@lru_cache(maxsize=1 << 14)
def _back(code: int, after: Vector) -> Vector:
    role, fault = code >> 2, code & 3
    extra = CUT_OFF if fault == TRUNCATED else 0
    out = []
    for state in range(4):
        best = DELETE + after[state]
        if fault not in (BLANK, DUPLICATE):
            best = min(best, RENAME + extra + after[_AFTER_NEW[state]])
            kept = _AFTER_KEEP.get((state, role))
            if kept is not None:
                best = min(best, extra + after[kept])
        out.append(best)
    return _closed(out)


def before_row(code: int, after: Vector) -> Vector:
    """Costs to go before a row, one for each state, from those after it.

    Only differences between costs matter, and there are few of these.
    """
    low = min(after)
    found = _back(code, tuple(min(a - low, _FAR) for a in after))
    return tuple(min(a + low, _FAR) for a in found)


def costs(codes: bytes, end: Vector) -> Vector:
    """Costs to go before the first of the rows."""
    for code in reversed(codes):
        end = before_row(code, end)
    return end


def walk(codes: bytes, end: Vector, state: int) -> Iterator[tuple[str, int]]:
    """Per row the least letters of tight edits up to it, and the state after it.

    Vectors of costs are kept at every square root of the number of rows. Walking
    forward, those between two checkpoints are computed again from the later one, so
    memory is that of two square roots. D, I, K and R are delete, insert, keep and
    rename; the first one in this order whose cost is what the row before was promised
    is taken, so the letters are the least in ASCII of all cheapest edits.
    """
    step = isqrt(len(codes)) or 1
    marks = list(range(0, len(codes), step))
    kept, vector = {len(codes): end}, end
    for i in range(len(codes) - 1, -1, -1):
        vector = before_row(codes[i], vector)
        if i % step == 0:
            kept[i] = vector
    for a in marks:
        b = min(a + step, len(codes))
        rows = [kept[b]]
        for i in range(b - 1, a - 1, -1):
            rows.append(before_row(codes[i], rows[-1]))
        rows.reverse()
        for i in range(a, b):
            here, after = rows[i - a], rows[i - a + 1]
            role, fault = codes[i] >> 2, codes[i] & 3
            extra = CUT_OFF if fault == TRUNCATED else 0
            letters = ""
            while True:
                if here[state] == DELETE + after[state]:
                    letters += "D"
                    break
                new = _AFTER_NEW[state]
                if here[state] == INSERT + here[new]:
                    letters += "I"
                    state = new
                    continue
                kept_state = _AFTER_KEEP.get((state, role))
                if kept_state is not None and here[state] == extra + after[kept_state]:
                    letters += "K"
                    state = kept_state
                else:
                    letters += "R"
                    state = new
                break
            yield letters, state


def tail(state: int) -> list[str]:
    """Roles of the rows to insert after the last one."""
    out = []
    while state not in (NOTHING, ANSWERED):
        out.append(_NEW_ROLE[state])
        state = _AFTER_NEW[state]
    return out


def _damage(column: str = "_damage") -> Column:
    """What happens to a row: a number from 0 to 19."""
    name = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")),
        F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), F.lit(" ")),
    )
    return (F.crc32(name.cast("binary")) % 20).alias(column)


def damaged(conversations: DataFrame) -> DataFrame:
    """``(key, turn, role, text, copies)``: rows dropped, emptied, cut, repeated, renamed.

    ``key`` is the conversation's id as text, empty for null.
    """
    kind = F.col("_damage")
    filled = conversations.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("key"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        _damage(),
    )
    return filled.where(kind != 0).select(
        "key",
        "turn",
        F.when(kind == 4, USER).otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, "")
        .when(kind == 2, F.translate("text", "".join(_ENDS), ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def _digest() -> Column:
    return F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest")


def coded_rows(rows: DataFrame) -> DataFrame:
    """``(key, rk, turn, role, digest, code)``: rows without texts, numbered in order.

    Conversations follow one another, their rows by turn, a null one first, then by role
    and digest. Numbers come from a range partition, so one conversation may be dealt to
    many tasks.
    """
    bare = F.rtrim(F.col("text"), F.lit(_WHITE))
    initial = F.substring("role", 1, 1)
    role = F.lit(len(_INITIALS))
    for i, sign in enumerate(_INITIALS):
        role = F.when(initial == sign, i).otherwise(role)
    fault = (
        F.when(bare == "", BLANK)
        .when(~F.right(bare, F.lit(1)).isin(*_ENDS), TRUNCATED)
        .otherwise(NO_FAULT)
    )
    flat = rows.select(
        "key", "turn", "role", _digest(), role.alias("class"), fault.alias("fault"),
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"),
    ).drop("copy")
    order = [F.asc("key"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("digest")]
    ranked = stored(global_rank(stored(flat, "rows"), order), "ranked")
    firsts = ranked.groupBy("key", "role", "digest").agg(F.min("rk").alias("rk"))
    marked = ranked.join(firsts.select("rk", F.lit(True).alias("first")), "rk", "left")
    seen = F.col("first").isNull() & (F.col("fault") != BLANK)
    code = F.col("class") * 4 + F.when(seen, DUPLICATE).otherwise(F.col("fault"))
    return marked.select("key", "rk", "turn", "role", "digest", code.cast("int").alias("code"))


def _segments(coded: DataFrame, size: int) -> DataFrame:
    """``(key, block, starts, ends, rows)``: the rows of a conversation in one block.

    A block is ``size`` consecutive numbers. The rows at its edges also go to the block
    next to it, where they tell whether their conversation goes on there.
    """
    at = F.col("rk") - 1
    block = F.expr(f"(rk - 1) div {size}")
    blocks = (
        F.when(at % size == size - 1, F.array(block, block + 1) if size > 1 else F.array(block - 1, block, block + 1))
        .when(at % size == 0, F.array(block - 1, block))
        .otherwise(F.array(block))
    )
    rows = coded.select("*", F.explode(blocks).alias("block"))
    grouped = rows.groupBy("key", "block").agg(
        F.sort_array(F.collect_list(F.struct("rk", "code", "turn", "role", "digest"))).alias("all")
    )
    low, high = F.col("block") * size, (F.col("block") + 1) * size
    return grouped.select(
        "key",
        "block",
        (F.element_at("all", 1)["rk"] > low).alias("starts"),
        (F.element_at("all", -1)["rk"] <= high).alias("ends"),
        F.get(F.filter("all", lambda r: r["rk"] <= low)["code"], F.lit(0)).alias("lead"),
        F.filter("all", lambda r: (r["rk"] > low) & (r["rk"] <= high)).alias("rows"),
    ).where("size(rows) > 0")


def _codes(rows: pa.Scalar) -> bytes:
    return bytes(rows.values.field("code").to_pylist())


def _swept(
    items: DataFrame,
    first: Sequence[int],
    compose: Callable[[list], list],
    apply: Callable[[list, list], list],
    backward: bool,
    span: int,
) -> DataFrame:
    """``(key, block, value)``: what reaches each of a conversation's items from one end.

    ``items (key, block, item)`` are maps of values. Up to ``span`` neighbours are
    composed into one map, and these again, until a conversation has one; then values go
    down the same way. So no task holds more than ``span`` items of a conversation.
    """
    shape = "key string, block bigint, item array<bigint>"

    def up(batches):
        for batch in batches:
            items = [compose([r["item"] for r in rows]) for rows in batch.column("rows").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("block"), pa.array(items, pa.list_(pa.int64()))],
                ["key", "block", "item"],
            )

    def down(batches):
        for batch in batches:
            keys, blocks, values = [], [], []
            columns = (batch.column(c).to_pylist() for c in ("key", "rows", "value"))
            for key, rows, value in zip(*columns):
                for row in reversed(rows) if backward else rows:
                    keys.append(key)
                    blocks.append(row["block"])
                    values.append(value)
                    value = apply(row["item"], value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array(blocks, pa.int64()),
                 pa.array(values, pa.list_(pa.int64()))],
                ["key", "block", "value"],
            )

    def grouped(level: DataFrame) -> DataFrame:
        return level.groupBy("key", F.expr(f"block div {span}").alias("block")).agg(
            F.sort_array(F.collect_list(F.struct(level["block"], "item"))).alias("rows")
        )

    levels = [stored(items, "maps")]
    while levels[-1].groupBy("key").count().where("count > 1").limit(1).count():
        levels.append(stored(grouped(levels[-1]).mapInArrow(up, shape), "maps"))
    values = levels[-1].select("key", "block", F.lit(list(first)).cast("array<bigint>").alias("value"))
    for level in reversed(levels[:-1]):
        parents = grouped(level).join(values, ["key", "block"])
        values = stored(
            parents.mapInArrow(down, "key string, block bigint, value array<bigint>"), "values"
        )
    return values


def _compose_costs(maps: list[list[int]]) -> list[int]:
    """The product of cost matrices, the first rows' first; costs add, the least counts."""
    out = maps[-1]
    for m in reversed(maps[:-1]):
        out = [
            min(_FAR, *(m[4 * q + k] + out[4 * k + p] for k in range(4)))
            for q in range(4) for p in range(4)
        ]
    return out


def _apply_costs(m: list[int], end: list[int]) -> list[int]:
    return [min(_FAR, *(m[4 * q + p] + end[p] for p in range(4))) for q in range(4)]


def _compose_states(maps: list[list[int]]) -> list[int]:
    out = [0, 1, 2, 3]
    for m in maps:
        out = [m[s] for s in out]
    return out


def _apply_states(m: list[int], state: list[int]) -> list[int]:
    return [m[state[0]]]


def _ends_known(cut: DataFrame, span: int) -> DataFrame:
    """``(key, block, end, state)`` of the segments of conversations that have several.

    Each segment's costs are a matrix from its end to its start. Their products, from
    the last segment on, give the costs at each segment's end: the checkpoints. With
    these every segment tells into which state it leads from each state, and these maps,
    from the first segment on, give the state in which each one starts.
    """

    def matrices(batches):
        for batch in batches:
            found = []
            for rows in batch.column("rows"):
                codes = _codes(rows)
                ends = [tuple(0 if p == q else _FAR for q in range(4)) for p in range(4)]
                columns = [costs(codes, end) for end in ends]
                found.append([columns[p][q] for q in range(4) for p in range(4)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("block"), pa.array(found, pa.list_(pa.int64()))],
                ["key", "block", "item"],
            )

    def maps(batches):
        for batch in batches:
            found = []
            for rows, end in zip(batch.column("rows"), batch.column("value").to_pylist()):
                codes = _codes(rows)
                own = []
                for state in range(4):
                    for _, last in walk(codes, tuple(end), state):
                        pass
                    own.append(last)
                found.append(own)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("block"), pa.array(found, pa.list_(pa.int64()))],
                ["key", "block", "item"],
            )

    shape = "key string, block bigint, item array<bigint>"
    sums = cut.select("key", "block", "rows").mapInArrow(matrices, shape)
    ends = _swept(sums, END, _compose_costs, _apply_costs, True, span)
    known = cut.join(ends, ["key", "block"])
    leads = known.select("key", "block", "rows", "value").mapInArrow(maps, shape)
    states = _swept(leads, [NOTHING], _compose_states, _apply_states, False, span)
    return ends.withColumnRenamed("value", "end").join(
        states.select("key", "block", F.get("value", F.lit(0)).alias("state")), ["key", "block"]
    )


_EDIT = "array<struct<turn: bigint, role: string, digest: binary, before: string, name: string>>"
_SOLVED = (
    "key string, block bigint, blank bigint, duplicate bigint, truncated bigint, "
    f"illegal bigint, cost bigint, audit string, edits {_EDIT}, after string"
)


def _solved(segments: DataFrame) -> DataFrame:
    """Counts, edits and letters of segments whose end's costs and first state are known."""

    def solve(batches):
        kind = pa.list_(
            pa.struct(
                [("turn", pa.int64()), ("role", pa.string()), ("digest", pa.binary()),
                 ("before", pa.string()), ("name", pa.string())]
            )
        )
        numbers = ("blank", "duplicate", "truncated", "illegal", "cost")
        for batch in batches:
            out = {c: [] for c in (*numbers, "audit", "edits", "after")}
            columns = (batch.column(c) for c in ("rows", "starts", "ends", "lead", "end", "state"))
            for rows, starts, ends, lead, end, state in zip(*columns):
                codes = _codes(rows)
                rows = rows.as_py()
                end, state = tuple(end.as_py()), state.as_py()
                out["cost"].append(costs(codes, end)[state] if starts.as_py() else 0)
                for name, fault in (("blank", BLANK), ("duplicate", DUPLICATE), ("truncated", TRUNCATED)):
                    out[name].append(sum(c & 3 == fault for c in codes))
                whole = codes if lead.as_py() is None else bytes([lead.as_py()]) + codes
                roles = [c >> 2 for c in whole]
                legal = {(0, 1), (1, 2), (2, 1)}
                out["illegal"].append(sum(p not in legal for p in zip(roles, roles[1:])))
                audit, edits = [], []
                for row, (letters, after) in zip(rows, walk(codes, end, state)):
                    audit.append(letters)
                    before = []
                    for letter in letters[:-1]:
                        before.append(_NEW_ROLE[state])
                        state = _AFTER_NEW[state]
                    name = {"D": None, "K": row["role"], "R": _NEW_ROLE[state]}[letters[-1]]
                    if name is not None:
                        edits.append(
                            {"turn": row["turn"], "role": row["role"], "digest": row["digest"],
                             "before": ",".join(before), "name": name}
                        )
                    state = after
                last = tail(state) if ends.as_py() else []
                out["audit"].append("".join(audit) + "I" * len(last))
                out["edits"].append(edits)
                out["after"].append(",".join(last))
            arrays = [batch.column("key"), batch.column("block")]
            arrays += [pa.array(out[c], pa.int64()) for c in numbers]
            arrays += [pa.array(out["audit"], pa.string()), pa.array(out["edits"], kind)]
            arrays.append(pa.array(out["after"], pa.string()))
            yield pa.RecordBatch.from_arrays(
                arrays, ["key", "block", *numbers, "audit", "edits", "after"]
            )

    columns = ("key", "block", "starts", "ends", "lead", "rows", "end", "state")
    return segments.select(*columns).mapInArrow(solve, _SOLVED)


_LINE = ("key", "last", "turn", "role", "digest", "kind", "text", "before", "name")


def repaired_lines(rows: DataFrame, solved: DataFrame) -> DataFrame:
    """``(key, last, turn, role, digest, kind, text, before, name)`` of rows and edits.

    Sorted by these, the edit of a row that stays comes before the row itself.
    """
    nothing = F.lit(None).cast("string")
    texts = rows.select(
        "key", F.lit(0).alias("last"), "turn", "role", _digest(), F.lit(1).alias("kind"),
        "text", nothing.alias("before"), nothing.alias("name"),
    )
    edits = solved.select("key", F.inline("edits")).select(
        "key", F.lit(0).alias("last"), "turn", "role", "digest", F.lit(0).alias("kind"),
        nothing.alias("text"), "before", "name",
    )
    ends = solved.where("after <> ''").select(
        "key", F.lit(1).alias("last"), F.lit(None).cast("bigint").alias("turn"),
        F.lit("").alias("role"), F.lit(b"").alias("digest"), F.lit(0).alias("kind"),
        nothing.alias("text"), F.col("after").alias("before"), nothing.alias("name"),
    )
    return texts.unionByName(edits).unionByName(ends)


def lines_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str | None]]:
    """``(key, line)`` of sorted rows: None once for each conversation, then its lines."""
    key = wanted = None
    for batch in batches:
        columns = [batch.column(c) for c in _LINE]
        for i in range(batch.num_rows):
            own, last, turn, role, digest, kind = (c[i].as_py() for c in columns[:6])
            if own != key:
                key, wanted = own, None
                yield key, None
            if kind == 0:
                before, name = columns[7][i].as_py(), columns[8][i].as_py()
                for new in before.split(",") if before else ():
                    yield key, f"{new}:"
                wanted = None if last else (turn, role, digest, name)
            elif wanted is not None and wanted[:3] == (turn, role, digest):
                yield key, f"{wanted[3]}:{columns[6][i].as_py()}"
                wanted = None


def _hashed(lines: DataFrame) -> DataFrame:
    """``(key, repaired_sha256)``: one digest over all lines of a conversation.

    A SHA-256 is one chain, so a conversation's lines have to pass one task in order. They
    are sorted, which spills, and streamed: none is held but the one at hand.
    """

    def digest(batches):
        state = {"key": None, "sum": None, "any": False}
        done = []

        def finish():
            if state["key"] is not None:
                done.append((state["key"], state["sum"].hexdigest()))

        def flushed():
            rows = pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in done], pa.string()), pa.array([h for _, h in done], pa.string())],
                ["key", "repaired_sha256"],
            )
            done.clear()
            return rows

        for key, line in lines_of(batches):
            if line is None:
                finish()
                state.update(key=key, sum=sha256(), any=False)
                if len(done) >= 10_000:
                    yield flushed()
                continue
            if state["any"]:
                state["sum"].update(b"\n")
            state["any"] = True
            state["sum"].update(line.encode("utf-8", "surrogatepass"))
        finish()
        yield flushed()

    order = [F.asc("key"), F.asc("last"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("digest"), F.asc("kind")]
    dealt = lines.repartition("key").sortWithinPartitions(*order)
    return dealt.select(*_LINE).mapInArrow(digest, "key string, repaired_sha256 string")


def repair(conversations: DataFrame, segment: int = SEGMENT, span: int = SPAN) -> tuple[DataFrame, DataFrame]:
    """Damaged rows and the solved segments of their conversations."""
    rows = damaged(conversations)
    segments = stored(_segments(coded_rows(rows), segment), "segments")
    whole = segments.where("starts and ends").select(
        "*",
        F.lit(list(END)).cast("array<bigint>").alias("end"),
        F.lit(NOTHING).cast("bigint").alias("state"),
    )
    cut = segments.where("not (starts and ends)")
    known = cut.join(_ends_known(cut, span), ["key", "block"])
    return rows, stored(_solved(whole.unionByName(known)), "solved")


def repaired_conversations(
    conversations: DataFrame, segment: int = SEGMENT, span: int = SPAN
) -> DataFrame:
    """Faults and cheapest repair of every conversation, one row for each conv_id.

    Columns: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and
    repaired_sha256, the digest of the repaired ``role:text`` lines.

    Rows are damaged first. A null conv_id is a conversation, null roles and texts are one
    space, and a null turn comes first. Rows of one turn follow by role, then by digest of
    their text; equal ones are repeats. A role that begins with none of s, u, a cannot be
    kept. A conversation without rows has zeros, an empty audit and the digest of nothing.
    Other columns are not looked at.

    Conversations are cut into segments of at most ``segment`` rows by number, so a long
    one is solved by many tasks; summaries of its segments are combined up to ``span`` at a
    time. Only its digest has to be made in one task, as a stream. Runs jobs when called.
    """
    rows, solved = repair(conversations, segment, span)
    turns = rows.groupBy("key").agg(
        F.coalesce(
            F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)
        ).alias("gaps")
    )
    numbers = ("blank", "duplicate", "truncated", "illegal", "cost")
    pieces = solved.groupBy("key").agg(
        *(F.sum(c).alias(c) for c in numbers),
        F.array_join(
            F.sort_array(F.collect_list(F.struct("block", "audit")))["audit"], ""
        ).alias("audit"),
    )
    hashes = _hashed(repaired_lines(rows, solved))
    key = F.coalesce(F.col("conv_id").cast("string"), F.lit(""))
    known = conversations.select("conv_id").distinct().withColumn("key", key)
    found = known.join(turns, "key", "left").join(pieces, "key", "left").join(hashes, "key", "left")
    return found.select(
        "conv_id",
        *(F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", *numbers)),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


def _sql_crc(text: str) -> str:
    """An unsigned CRC-32 of ASCII text."""
    return f"""xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)),
    lambda acc, b: list_reduce(list_prepend(xor(acc, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::BIGINT) ELSE c // 2 END)))"""


def _sql_plan(cost: str, letter: str, after: str, line: str | None = None) -> str:
    """One more edit before the plan ``after``, as (cost, letters, lines)."""
    lines = f"list_prepend({line}, {after}.t)" if line else f"{after}.t"
    return f"{{'c': {after}.c + {cost}, 'l': '{letter}' || {after}.l, 't': {lines}}}"


def _sql_row(state: str, new: str, name: str, kept: dict[str, str]) -> str:
    """The best plan from a state, the row at hand included: alive is a row that may stay."""
    extra = "(CASE WHEN fault = 3 THEN 3 ELSE 0 END)"
    rename = _sql_plan(f"3 + {extra}", "R", new, f"'{name}:' || text")
    keeps = [
        f"CASE WHEN alive AND class = '{c}' THEN {_sql_plan(extra, 'K', to, 'role || chr(58) || text')} END"
        for c, to in kept.items()
    ]
    options = [_sql_plan("4", "D", state), f"CASE WHEN alive THEN {rename} END", *keeps]
    return f"least({', '.join(options)}) AS {state}"


_SQL_INSERTED = f"""
  SELECT key, i, u, a,
         least(s, {_sql_plan("3", "I", "u", "'user:'")}) AS s,
         least(e, {_sql_plan("3", "I", "u", "'user:'")}) AS e
  FROM (SELECT key, i, e, s, least(u, {_sql_plan("3", "I", "a", "'assistant:'")}) AS u,
               least(a, {_sql_plan("3", "I", "u", "'user:'")}) AS a FROM ("""

_SQL_NAME = "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"

#: The same in DuckDB: plans are kept as whole strings and lists of lines.
REPAIR_SQL = f"""
WITH RECURSIVE marked AS (
  SELECT coalesce(CAST(conv_id AS VARCHAR), '') AS key, turn, coalesce(role, ' ') AS role,
         coalesce(text, ' ') AS text, {_sql_crc(_SQL_NAME)} % 20 AS kind
  FROM conversations),
changed AS (
  SELECT key, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM marked WHERE kind <> 0),
placed AS (
  SELECT key, turn, role, text, left(role, 1) AS class,
         regexp_replace(text, '[\\x20\\x09-\\x0D]+$', '') AS bare,
         row_number() OVER (PARTITION BY key ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i
  FROM changed),
faulty AS (
  SELECT *, CASE WHEN bare = '' THEN 1
                 WHEN row_number() OVER (PARTITION BY key, role, text ORDER BY i) > 1 THEN 2
                 WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
         lag(class) OVER (PARTITION BY key ORDER BY i) || class AS pair
  FROM placed),
rows AS (SELECT *, fault IN (0, 3) AS alive FROM faulty),
counts AS (
  SELECT key, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (WHERE fault = 1) AS blank, count(*) FILTER (WHERE fault = 2) AS duplicate,
         count(*) FILTER (WHERE fault = 3) AS truncated,
         count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
  FROM rows GROUP BY key),
plans AS ({_SQL_INSERTED}
    SELECT key, n + 1 AS i,
           {{'c': 0::BIGINT, 'l': '', 't': []::VARCHAR[]}} AS e, {{'c': 9999::BIGINT, 'l': '', 't': []::VARCHAR[]}} AS s,
           {{'c': 9999::BIGINT, 'l': '', 't': []::VARCHAR[]}} AS u, {{'c': 0::BIGINT, 'l': '', 't': []::VARCHAR[]}} AS a
    FROM counts))
  UNION ALL {_SQL_INSERTED}
    SELECT p.key, p.i - 1 AS i,
           {_sql_row("e", "u", "user", {"s": "s", "u": "u"})},
           {_sql_row("s", "u", "user", {"u": "u"})},
           {_sql_row("u", "a", "assistant", {"a": "a"})},
           {_sql_row("a", "u", "user", {"u": "u"})}
    FROM plans p JOIN rows r ON r.key = p.key AND r.i = p.i - 1)))
SELECT d.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
       coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(e.c, 0) AS cost, coalesce(e.l, '') AS audit,
       sha256(coalesce(array_to_string(e.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) d
LEFT JOIN counts c ON c.key = coalesce(CAST(d.conv_id AS VARCHAR), '')
LEFT JOIN plans p ON p.key = c.key AND p.i = 1"""
