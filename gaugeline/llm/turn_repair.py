"""Repair of conversation structure by Hirschberg's divide and conquer.

A conversation should be empty, or one optional system turn followed by pairs of user and assistant. Turns are kept, given
another role, deleted, or inserted empty, at the least cost; of equal repairs the one whose edits (D, I, K, R) read
least. Where a repair stands is one of four states: nothing yet, after the system turn, after a user, after an assistant.

Within a run of turns, a forward vector of four costs from the front and a backward one from the end meet in the middle. The
states in which their sum is least are the optimal crossings; the first half is solved with those as its allowed ends, which
chooses the one with the least edits, and the second half goes on from there. Only vectors of four numbers are held.

No conversation is one task. Turns are sorted and numbered over the whole table (`ordering.order_rows`) and cut into chunks of
`CHUNK`. A conversation inside a chunk is solved there. One that reaches a chunk's border hands on, per piece, the 4 x 4 costs of
passing it (costs of pieces in a row multiply); from these each piece learns the costs behind it, finds its edits for each of the four states it may
begin in, and is told which one holds. So the one list per conversation is of one row per `CHUNK` turns.
Repaired turns are put out in order, conversation by conversation, in bounded memory; a digest of a whole conversation is
sequential by nature, so a conversation's turns pass through one task, as a stream.

Defined results: a null role or text is one space, a role other than system, user and assistant (by its first letter) is
deleted or replaced; null ids are a conversation; null turns come first; turns of equal number come in the order of a digest of
role and text, equal ones being copies; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from gaugeline.llm.common import own, rows_of, stored
from gaugeline.operators.ordering import order_rows

CHUNK = 4096
#: Costs of the edits, and of leaving a truncated turn in.
RELABEL, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
COSTS = {"K": 0, "R": RELABEL, "D": DELETE, "I": INSERT}
SPACE = " \t\n\x0b\x0c\r"

START, SYSTEM, USER, ASSISTANT = range(4)
INITIALS = "sua"
#: State after another turn of a user or an assistant, by the state before.
_NEXT = (USER, USER, ASSISTANT, USER)
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_NEVER = 1 << 40
#: A turn's code is the place of its initial in `INITIALS` (3: any other), plus four times the place of its fault here.
FAULTS = (None, "truncated", "blank", "duplicate")
FAULT_COUNTS = ("blank", "duplicate", "truncated")
_CUT, _GONE, _AGAIN = 4, 8, 12


def _edits(code: int, state: int) -> list[tuple[str, int, int]]:
    """Edits of a turn in their order, with the state that they lead to and their cost."""
    found = [("D", state, DELETE)]
    if code < _GONE:
        extra = TRUNCATED if code & _CUT else 0
        initial = code & 3
        if (initial == 0 and state == START) or (initial in (1, 2) and _NEXT[state] == initial + 1):
            found.append(("K", initial + 1, extra))
        found.append(("R", _NEXT[state], RELABEL + extra))
    return found


def _padding(state: int) -> list[tuple[int, int, str]]:
    """What inserted turns alone lead to from a state: state, cost, edits."""
    return [(state, 0, ""), (_NEXT[state], INSERT, "I"), (_NEXT[_NEXT[state]], 2 * INSERT, "II")]


#: Per code and state before: the least cost of each state after the turn, inserted turns before it included.
_STEP = [
    [
        [
            min([cost + c for now, cost, _ in _padding(state) for _, after, c in _edits(code, now) if after == to], default=_NEVER)
            for to in range(4)
        ]
        for state in range(4)
    ]
    for code in range(16)
]
#: Least cost of a proper end after the last turn, and the inserted turns that it takes.
_TAILS = [min((cost, edits) for now, cost, edits in _padding(s) if now in (START, ASSISTANT)) for s in range(4)]
END = tuple(cost for cost, _ in _TAILS)
TAIL = tuple(edits for _, edits in _TAILS)

Vector = tuple[int, int, int, int]


def _reduced(costs: list[int]) -> tuple[Vector, int]:
    low = min(costs)
    return tuple(min(c - low, _NEVER) for c in costs), low


@lru_cache(maxsize=1 << 16)
def _onward(code: int, costs: Vector) -> tuple[Vector, int]:
    return _reduced([min(costs[s] + _STEP[code][s][t] for s in range(4)) for t in range(4)])


@lru_cache(maxsize=1 << 16)
def _backward(code: int, costs: Vector) -> tuple[Vector, int]:
    return _reduced([min(_STEP[code][s][t] + costs[t] for t in range(4)) for s in range(4)])


def forward_costs(codes: bytes, costs: Vector) -> tuple[Vector, int]:
    """Costs of the states after the turns, less their least, and that."""
    total = 0
    for code in codes:
        costs, low = _onward(code, costs)
        total += low
    return costs, total


def backward_costs(codes: bytes, costs: Vector) -> tuple[Vector, int]:
    """Costs of getting from each state before the turns to the end, less their least, and that."""
    total = 0
    for code in reversed(codes):
        costs, low = _backward(code, costs)
        total += low
    return costs, total


def _begin(state: int) -> Vector:
    return tuple(0 if s == state else _NEVER for s in range(4))


@lru_cache(maxsize=1 << 16)
def _one(code: int, state: int, end: Vector) -> tuple[str, int]:
    """The least edits among the cheapest for a single turn, and the state after them."""
    togo = [min(_STEP[code][s][t] + end[t] for t in range(4)) for s in range(4)]
    edits = ""
    while True:
        options = [(edit, after, cost + end[after]) for edit, after, cost in _edits(code, state)]
        options.append(("I", _NEXT[state], INSERT + togo[_NEXT[state]]))
        edit, after = min((edit, after) for edit, after, cost in options if cost == togo[state])
        edits += edit
        state = after
        if edit != "I":
            return edits, state


def recover(codes: bytes, state: int, end: Vector) -> tuple[list[str], int]:
    """The least edits among the cheapest, a string per turn (inserted turns before it come first), and the state after them.

    `end` has the costs behind the turns; whatever can be reached at least cost in sum may be the last state.
    """
    if len(codes) == 1:
        edits, state = _one(codes[0], state, end)
        return [edits], state
    middle = len(codes) // 2
    ahead, _ = forward_costs(codes[:middle], _begin(state))
    behind, _ = backward_costs(codes[middle:], end)
    best = min(a + b for a, b in zip(ahead, behind, strict=True))
    crossing = tuple(b if a + b == best else _NEVER for a, b in zip(ahead, behind, strict=True))
    first, state = recover(codes[:middle], state, _reduced(list(crossing))[0])
    second, state = recover(codes[middle:], state, end)
    return first + second, state


@lru_cache(maxsize=1 << 14)
def _short(codes: bytes) -> tuple[str, ...]:
    edits, state = recover(codes, START, END)
    return (*edits[:-1], edits[-1] + TAIL[state])


def repair(codes: bytes) -> tuple[str, ...]:
    """The edits of a whole conversation, a string per turn."""
    return _short(codes) if len(codes) <= 32 else _short.__wrapped__(codes)


def damage(conversations: DataFrame) -> DataFrame:
    """Turns with known faults, chosen by crc32 of `conv_id:turn`: dropped, emptied, without ends of sentences, repeated, as a user."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    rows = own(conversations, "conv_id", "turn", "role", "text").withColumn(
        "_fault", F.crc32(F.concat(shown[0], F.lit(":"), shown[1]).cast("binary")) % 20
    )
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    text = F.when(F.col("_fault") == 1, "").when(F.col("_fault") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    role = F.when(F.col("_fault") == 4, "user").otherwise(role)
    times = F.when(F.col("_fault") == 3, 2).otherwise(1)
    kept = rows.filter(F.col("_fault") != 0).withColumn("_copy", F.explode(F.sequence(F.lit(1), times)))
    return kept.select("conv_id", "turn", role.alias("role"), text.alias("text"))


def _code(role: Column, text: Column) -> Column:
    core = F.rtrim(text, F.lit(SPACE))
    initial = F.lit(len(INITIALS))
    for at, letter in enumerate(INITIALS):
        initial = F.when(role.startswith(letter), at).otherwise(initial)
    state = F.when(core == "", _GONE).when(~F.substring(core, -1, 1).isin(*".!?"), _CUT).otherwise(0)
    return initial + state


def _numbered(turns: DataFrame) -> DataFrame:
    """The turns in order, with `_pos`, `_code` and `_digest`, written once."""
    text, role = (F.coalesce(c, F.lit(" ")) for c in ("text", "role"))
    rows = own(turns, "conv_id", "turn", "role", "text").select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), _code(role, text).alias("_code"),
        F.sha2(F.to_json(F.struct(role.alias("r"), text.alias("t"))), 256).alias("_digest"),
    )
    # Equal turns may stand in any order; the number only lets a large group of them be split.
    rows = rows.withColumn("_tie", F.monotonically_increasing_id())
    return order_rows(rows, ["conv_id", "turn", "_digest", "_tie"]).rows


def _marked(rows: DataFrame) -> DataFrame:
    """`conv_id, _pos, _code` with the turns that repeat an earlier one marked as such, without the texts."""
    slim = rows.select("conv_id", "_pos", "_code", "_digest")
    groups = slim.filter(F.col("_code") < _GONE).groupBy("conv_id", "_digest").agg(F.min("_pos").alias("_first"), F.count("*").alias("n"))
    # Written first: a join of two plain exchanges, which adaptive execution can split at a text that a conversation repeats.
    groups = stored(groups.filter("n > 1").select(F.col("conv_id").alias("_conv"), F.col("_digest").alias("_of"), "_first"), "repeated-turns")
    joined = slim.join(groups, slim["conv_id"].eqNullSafe(groups["_conv"]) & (slim["_digest"] == groups["_of"]), "left")
    code = F.when(F.col("_pos") > F.col("_first"), F.col("_code") % 4 + _AGAIN).otherwise(F.col("_code"))
    return joined.select("conv_id", "_pos", code.cast("int").alias("_code"))


def _solve_chunk(rows: pa.Table) -> pa.Table:
    """Per conversation in a chunk its first place, codes and edits; for the first and last one, which may go on, costs instead."""
    rows = rows.sort_by("_pos").combine_chunks()
    conv, pos = rows.column("conv_id"), rows.column("_pos").to_numpy()
    codes = rows.column("_code").to_numpy().astype(np.uint8).tobytes()
    of = conv.chunk(0).dictionary_encode(null_encoding="encode").indices.to_numpy()
    begins = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
    ends = np.r_[begins[1:], len(of)]
    parts = [codes[a:b] for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
    edits, costs = [], []
    for at, part in enumerate(parts):
        if at in (0, len(parts) - 1):
            passed = [forward_costs(part, _begin(s)) for s in range(4)]
            costs.append([min(c + low, _NEVER) for vector, low in passed for c in vector])
            edits.append(None)
        else:
            costs.append(None)
            edits.append(repair(part))
    return pa.table(
        {
            "conv_id": conv.take(pa.array(begins)),
            "first": pa.array(pos[begins]),
            "codes": pa.array(parts, pa.binary()),
            "edits": pa.array(edits, pa.list_(pa.string())),
            "costs": pa.array(costs, pa.list_(pa.int64())),
        }
    )


def _costs_behind(rows: pa.Table) -> pa.Table:
    """Of the pieces of a conversation: the costs behind each, less the least."""
    rows = rows.sort_by([("first", "descending")])
    behind, out = END, []
    for costs in rows.column("costs").to_pylist():
        out.append(list(behind))
        behind, _ = _reduced([min(costs[4 * s + t] + behind[t] for t in range(4)) for s in range(4)])
    return pa.table({"first": rows.column("first"), "behind": pa.array(out, pa.list_(pa.int64()))})


def _states_before(rows: pa.Table) -> pa.Table:
    """Of the pieces of a conversation: the state in which each begins, and what is inserted behind the last one."""
    rows = rows.sort_by("first")
    state, before = START, []
    for ends in rows.column("ends").to_pylist():
        before.append(state)
        state = ends[state]
    tails = [""] * (len(before) - 1) + [TAIL[state]]
    return pa.table({"first": rows.column("first"), "state": pa.array(before, pa.int32()), "tail": pa.array(tails, pa.string())})


def _try_states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits and last state of each piece for every state that it may begin in."""
    for batch in batches:
        tried = [
            [recover(codes, state, _reduced(behind)[0]) for state in range(4)]
            for codes, behind in zip(rows_of(batch, "codes"), rows_of(batch, "behind"), strict=True)
        ]
        ends = pa.array([[end for _, end in four] for four in tried], pa.list_(pa.int64()))
        options = pa.array([[edits for edits, _ in four] for four in tried], pa.list_(pa.list_(pa.string())))
        kept = ["conv_id", "first", "codes"]
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], ends, options], [*kept, "ends", "options"])


def _all_edits(marked: DataFrame, chunk: int) -> DataFrame:
    """`conv_id, _pos, edits, _code` for every turn."""
    longs, strings = T.ArrayType(T.LongType()), T.ArrayType(T.StringType())
    piece = [marked.schema["conv_id"], T.StructField("first", T.LongType()), T.StructField("codes", T.BinaryType())]
    solved = T.StructType([*piece, T.StructField("edits", strings), T.StructField("costs", longs)])
    tried = T.StructType([*piece, T.StructField("ends", longs), T.StructField("options", T.ArrayType(strings))])
    pieces = stored(marked.groupBy(F.expr(f"_pos div {chunk}")).applyInArrow(_solve_chunk, solved), "pieces")
    open_ = pieces.filter("costs is not null")
    behind = open_.select("conv_id", "first", "costs").groupBy("conv_id").applyInArrow(_costs_behind, "first long, behind array<bigint>")
    options = open_.select(*[f.name for f in piece]).join(behind, "first")
    options = stored(options.mapInArrow(_try_states, tried), "piece-edits")
    states = options.select("conv_id", "first", "ends").groupBy("conv_id").applyInArrow(_states_before, "first long, state int, tail string")
    chosen = options.join(states, "first").withColumn("edits", F.col("options")[F.col("state")])
    closed = pieces.filter("edits is not null").withColumn("tail", F.lit(""))
    names = [*[f.name for f in piece], "edits", "tail"]
    spread = chosen.select(names).unionByName(closed.select(names))
    spread = spread.select("conv_id", "first", "codes", "tail", F.posexplode("edits").alias("at", "edits"))
    last = F.col("at") == F.length("codes") - 1
    return spread.select(
        "conv_id",
        (F.col("first") + F.col("at")).alias("_pos"),
        F.when(last, F.concat("edits", "tail")).otherwise(F.col("edits")).alias("edits"),
        F.conv(F.hex(F.substring("codes", F.col("at") + 1, F.lit(1))), 16, 10).cast("int").alias("_code"),
    )


def repaired(turns: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """A row per edit, in order within its conversation (`place`, from 0), each conversation whole in a partition.

    `edit` is K, R, D or I, `fault` blank, duplicate, truncated or null; `turn` and `was` are number and role before
    (null if inserted), `role` and `text` those after the repair (null if deleted).
    """
    rows = _numbered(turns)
    edits = _all_edits(_marked(rows), chunk)
    turn = rows.schema["turn"]
    blank = {turn.name: turn.dataType, "role": "string", "text": "string"}
    edits = edits.select("*", F.lit(0).alias("_kind"), *[F.lit(None).cast(kind).alias(name) for name, kind in blank.items()])
    told = [F.lit(None).cast("string").alias("edits"), F.lit(None).cast("int").alias("_code"), F.lit(1).alias("_kind")]
    # The edits of a turn arrive just before it.
    both = edits.unionByName(rows.select("conv_id", "_pos", *told, *blank))
    both = both.repartition("conv_id").sortWithinPartitions("conv_id", "_pos", "_kind")
    fields = [("place", T.LongType()), ("edit", T.StringType()), ("fault", T.StringType()), ("turn", turn.dataType)]
    fields += [(name, T.StringType()) for name in ("was", "role", "text")]
    schema = T.StructType([rows.schema["conv_id"], *[T.StructField(*f) for f in fields]])
    arrow = [to_arrow_type(kind) for _, kind in fields]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, begun, state, place, edits, code = None, False, START, 0, "", 0
        for batch in batches:
            took, out = [], []
            columns = [rows_of(batch, c) for c in ("conv_id", "_kind", "edits", "_code", "turn", "role", "text")]
            for at, (now, kind, its_edits, its_code, number, role, text) in enumerate(zip(*columns, strict=True)):
                if kind == 0:
                    edits, code = its_edits, its_code
                    continue
                if not begun or now != conv:
                    conv, begun, state, place = now, True, START, 0
                for edit in edits:
                    if edit == "I":
                        state = _NEXT[state]
                        out.append((place, edit, None, None, None, _ROLE[state], ""))
                    elif edit == "D":
                        out.append((place, edit, FAULTS[code >> 2], number, role, None, None))
                    else:
                        state = (code & 3) + 1 if edit == "K" else _NEXT[state]
                        shown = role if edit == "K" else _ROLE[state]
                        out.append((place, edit, FAULTS[code >> 2], number, role, shown, text))
                    took.append(at)
                    place += 1
            if out:
                made = [pa.array(column, kind) for column, kind in zip(zip(*out, strict=True), arrow, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("conv_id").take(pa.array(took)), *made], schema.names)

    return both.mapInArrow(apply, schema)


def summary(edits: DataFrame) -> DataFrame:
    """Per conversation of `repaired`: faults found, illegal neighbours, gaps in the numbers, cost, edits, and a digest of the result."""
    names = [*FAULT_COUNTS, "gaps", "illegal", "cost"]
    fields = [T.StructField(name, T.LongType()) for name in names] + [T.StructField(n, T.StringType()) for n in ("audit", "repaired_sha256")]
    schema = T.StructType([edits.schema["conv_id"], *fields])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, kind = None, None, None
        done: list[tuple] = []

        def emitted() -> pa.RecordBatch:
            ids, *columns = zip(*done, strict=True)
            made = [pa.array(c, to_arrow_type(f.dataType)) for c, f in zip(columns, fields, strict=True)]
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(ids, kind), *made], schema.names)

        for batch in batches:
            kind = batch.schema.field("conv_id").type
            for now, *row in zip(*[rows_of(batch, c) for c in ("conv_id", "edit", "fault", "turn", "was", "role", "text")], strict=True):
                if state is None or now != conv:
                    if state is not None:
                        done.append((conv, *state.row()))
                    conv, state = now, _Summary()
                state.add(*row)
            if done:
                yield emitted()
        if state is not None:
            done.append((conv, *state.row()))
            yield emitted()

    return edits.mapInArrow(work, schema)


class _Summary:
    """What `summary` says of one conversation, turn by turn; all but the edits takes bounded memory."""

    def __init__(self):
        self.found = dict.fromkeys(FAULT_COUNTS, 0)
        self.cost = self.illegal = self.numbers = 0
        self.first = self.last = self.before = None
        self.audit: list[str] = []
        self.digest, self.empty = hashlib.sha256(), True

    def add(self, edit: str, fault: str | None, turn: int | None, was: str | None, role: str | None, text: str | None) -> None:
        self.audit.append(edit)
        self.cost += COSTS[edit] + (TRUNCATED if fault == "truncated" and edit != "D" else 0)
        if fault:
            self.found[fault] += 1
        if edit != "I":
            self.illegal += self.before is not None and self.before + was[:1] not in ("su", "ua", "au")
            self.before = was[:1]
            if turn is not None and turn != self.last:
                self.numbers += 1
                self.first, self.last = turn if self.first is None else self.first, turn
        if edit != "D":
            self.digest.update(("" if self.empty else "\n").encode() + f"{role}:{text}".encode())
            self.empty = False

    def row(self) -> tuple:
        gaps = self.last - self.first + 1 - self.numbers if self.numbers else 0
        return (*self.found.values(), gaps, self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest())


def of_all(conversations: DataFrame, found: DataFrame) -> DataFrame:
    """`found` for every conversation there is: zeros, no edits and the digest of nothing for those without a turn left."""
    ids = own(conversations, "conv_id").distinct()
    found = found.withColumnRenamed("conv_id", "_conv")
    joined = ids.join(found, ids["conv_id"].eqNullSafe(found["_conv"]), "left").drop("_conv")
    nothing = hashlib.sha256().hexdigest()
    return joined.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", *FAULT_COUNTS, "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )
