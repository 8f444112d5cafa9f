from __future__ import annotations

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from gaugeline.llm import turn_repair

ROWS = "conv_id long, turn long, role string, text string, place int, edit string"
BLANK = re.compile(r"[^\x20\x09-\x0D]")


def classed(turns):
    """Initial and fault of each turn of a conversation in order."""
    seen, out = set(), []
    for _, role, text in turns:
        marks = BLANK.findall(text)
        fault = "blank" if not marks else "duplicate" if (role, text) in seen else "truncated" if marks[-1] not in ".!?" else None
        seen.add((role, text))
        out.append((role[:1], fault))
    return out


def cheapest(turns):
    """Cost and edits of the best repair, by dynamic programming over whole edit strings."""
    kinds = classed(turns)
    following = {"": "su", "s": "u", "u": "a", "a": "u"}

    @lru_cache(None)
    def best(at, last, inserted):
        options = []
        if at == len(kinds) and last in ("", "a"):
            options.append((0, ""))
        for role in following[last].replace("s", ""):
            if inserted < 3:
                cost, edits = best(at, role, inserted + 1)
                options.append((cost + 3, "I" + edits))
        if at < len(kinds):
            initial, fault = kinds[at]
            cost, edits = best(at + 1, last, 0)
            options.append((cost + 4, "D" + edits))
            if fault not in ("blank", "duplicate"):
                extra = 3 if fault else 0
                if initial and initial in following[last]:
                    cost, edits = best(at + 1, initial, 0)
                    options.append((cost + extra, "K" + edits))
                for role in following[last].replace("s", ""):
                    cost, edits = best(at + 1, role, 0)
                    options.append((cost + extra + 3, "R" + edits))
        return min(options, default=(10**9, ""))

    for at in reversed(range(len(kinds) + 1)):  # short recursions
        for last in following:
            best(at, last, 0)
    return best(0, "", 0)


def summed(turns):
    cost, audit = cheapest(turns)
    kinds, rows, last, at = classed(turns), [], "", 0
    for edit in audit:
        role = {"": "user", "s": "user", "u": "assistant", "a": "user"}[last]
        if edit == "D":
            at += 1
            continue
        if edit == "I":
            rows.append(f"{role}:")
        else:
            role = turns[at][1] if edit == "K" else role
            rows.append(f"{role}:{turns[at][2]}")
            at += 1
        last = role[0]
    numbers = [t for t, _, _ in turns if t is not None]
    initials = [k for k, _ in kinds]
    return {
        "gaps": max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
        **{name: sum(f == name for _, f in kinds) for name in ("blank", "duplicate", "truncated")},
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)),
        "cost": cost,
        "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(rows).encode()).hexdigest(),
    }


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def expected(rows, all_ids):
    turns = {}
    for conv, turn, role, text in rows:
        turns.setdefault(conv, []).append((turn, role, text))
    for value in turns.values():
        value.sort(key=lambda t: (t[0] is not None, t[0] or 0))
    nothing = {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    zeros = dict.fromkeys(("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), 0) | nothing
    return {conv: summed(turns[conv]) if conv in turns else zeros for conv in all_ids}


def made(spark, rows):
    return spark.createDataFrame([(*r, 9, "x") for r in rows], ROWS)


def found(df, conversations, **kw):
    result = turn_repair.of_all(conversations, turn_repair.summary(turn_repair.repaired(df, **kw)))
    got = [r.asDict() for r in result.collect()]
    assert len({r["conv_id"] for r in got}) == len(got)
    return {r.pop("conv_id"): r for r in got}


def conversations(seed, n, roles=("user", "assistant", "user", "assistant", "system", "tool", "")):
    rng = random.Random(seed)
    texts = ["Yes.", "No", "", " \t\n", "So it is!", "and then", "\x0b.\x0c", "é?"]
    rows = []
    for conv in range(n):
        for turn in range(rng.randrange(1, 9)):
            rows.append((conv, turn + rng.randrange(2) * 7, rng.choice(roles), rng.choice(texts) if rng.random() < 0.5 else f"{turn} {rng.random()}."))
    # One row per number: what comes first of equal numbers is checked apart.
    return list({(r[0], r[1]): r for r in rows}.values())


def test_repair_is_the_least_of_the_cheapest():
    rng = random.Random(1)
    initials = ["s", "u", "a", "x"]
    for _ in range(3000):
        codes = bytes(rng.randrange(16) for _ in range(rng.randrange(1, 12)))
        # Texts that give the faults of the codes.
        turns, made_ = [], 0
        for k, code in enumerate(codes):
            role, fault = initials[code & 3], turn_repair.FAULTS[code >> 2]
            if fault == "duplicate":
                earlier = [t for t in turns if t[1] == role and BLANK.search(t[2])]
                if not earlier:
                    fault = None
            made_ += 1
            text = {"blank": "", "truncated": f"{k} x", None: f"{k}.", "duplicate": ""}[fault] if fault != "duplicate" else earlier[0][2]
            turns.append((k, role, text))
        kinds = classed(turns)
        codes = bytes(initials.index(i) + 4 * turn_repair.FAULTS.index(f) for i, f in kinds)
        cost, audit = cheapest(turns)
        edits = turn_repair.repair(codes)
        assert "".join(edits) == audit
        assert len(edits) == len(codes) and all(sum(e != "I" for e in edit) == 1 for edit in edits)


@pytest.mark.parametrize("chunk", [3, 4096])
def test_equals_trying_all_edits(spark, chunk):
    rows = conversations(2, 120) + [(None, 0, "user", "Hi."), (None, None, "assistant", None), (777, None, None, "Bye.")]
    df = made(spark, rows)
    assert found(df, df, chunk=chunk) == expected([(a, b, c or " ", d if d is not None else " ") for a, b, c, d in rows], {r[0] for r in rows})


def test_damage(spark):
    rows = conversations(3, 150)
    rows += [(900 + k, 0, "user", "Only.") for k in range(40)] + [(None, None, None, None)]
    df = made(spark, rows)
    broken = turn_repair.damage(df)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r) for r in broken.collect()), key=key) == sorted(damaged(rows), key=key)
    got = found(broken, df)
    assert got == expected(damaged(rows), {r[0] for r in rows})
    assert any(r["audit"] == "" for r in got.values()) and any("I" in r["audit"] for r in got.values())


def test_one_long_conversation_spans_many_chunks(spark):
    rng = random.Random(4)
    texts = lambda k: rng.choice(["A.", "b", f"{k}.", f"{k}."])
    rows = [(500, k, rng.choice(["user", "assistant"]), texts(k)) for k in range(900)] + conversations(6, 20)
    df = made(spark, rows)
    assert found(df, df, chunk=64) == expected(rows, {r[0] for r in rows})


def test_repeated_rows_and_equal_numbers(spark):
    rows = [(1, 0, "user", "Hi.")] * 3 + [(1, 1, "assistant", "Yes.")] * 2 + [(2, 4, "assistant", "One."), (2, 4, "user", "Two.")]
    got = found(made(spark, rows), made(spark, rows))
    assert got[1]["audit"] == "KDDKD" and got[1]["duplicate"] == 3 and got[1]["gaps"] == 0
    assert got == found(made(spark, rows[::-1]), made(spark, rows))


def test_long_text_and_rows_in_order(spark):
    long = "word " * 400_000 + "end"
    rows = [(1, 0, "user", long), (1, 1, "assistant", "Yes."), (1, 2, "user", "Why?"), (1, 3, "user", "Well?")]
    edits = turn_repair.repaired(made(spark, rows)).orderBy("place").collect()
    assert [r["place"] for r in edits] == list(range(len(edits)))
    kept = [(r["role"], r["text"]) for r in edits if r["edit"] != "D"]
    assert kept[0] == ("user", long) and [role for role, _ in kept] == ["user", "assistant"] * (len(kept) // 2)
    assert edits[0]["fault"] == "truncated"


def test_empty_table(spark):
    df = made(spark, [])
    assert found(turn_repair.damage(df), df) == {}
