from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from gaugeline.llm import unit_dedup

DOCS = "doc_id long, text string, spans string, n int, d1 string, kept int"


def plain_cut(text, seen, counts, breaks):
    """Units of a text, those to remove, and the words of repeated runs, step by step."""
    ends = [m.end() for m in re.finditer(breaks, text)] + [len(text)]
    units = [text[a:b] for a, b in zip([0, *ends], ends, strict=False)]
    out, removed, runs = [], 0, [0]
    for unit in units:
        plain = " ".join(unit.lower().split())
        if not plain:
            out.append(unit)
            continue
        if counts[plain] > 1:
            runs[-1] += len(plain.split())
        else:
            runs.append(0)
        if plain in seen:
            removed += 1
        else:
            out.append(unit)
        seen.add(plain)
    return {
        "kept": "".join(out),
        "n_removed": removed,
        "n_units": sum(bool(u.split()) for u in units),
        "n_passage_words": sum(r for r in runs if r >= unit_dedup.PASSAGE_WORDS),
    }


@pytest.mark.parametrize("breaks", [unit_dedup.SENTENCES, unit_dedup.LINES])
def test_earliest_stays_and_the_rest_goes(spark, breaks):
    rng = random.Random(5)
    words = lambda n: " ".join(f"w{rng.randint(0, 99)}" for _ in range(n))
    lines = [words(rng.randint(5, 9)) + rng.choice([". ", "! ", "", ".  "]) + words(rng.randint(1, 20)) for _ in range(30)]
    lines += ["", "too short", "é É. x", " \t", "Yes. No? Yes. "]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 12)))) for i in range(50)]
    rows += [(200, rows[3][1].upper().replace(" ", "  ")), (None, None), (201, ""), (3, rows[3][1]), (202, words(40))]
    rows += [(300 + i, f"{words(3)} {lines[1]}. {lines[2]}. {words(2)}") for i in range(4)]  # a passage inside a line
    docs = spark.createDataFrame([(i, t, "clash", 1, "clash", 2) for i, t in rows], DOCS).repartition(4)
    got = unit_dedup.remove_repeated_units(docs, breaks).collect()
    assert len(got) == len(rows)
    ends = lambda t: [0, *[m.end() for m in re.finditer(breaks, t)], len(t)]
    counts = Counter(" ".join(t[a:b].lower().split()) for _, t in rows if t for a, b in zip(ends(t), ends(t)[1:], strict=False))
    seen, done = set(), {}
    for r in sorted(got, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0)):
        text = r["text"]
        if text is None:
            assert r["kept"] is None and r["n_units"] == r["n_removed"] == r["n_passage_words"] == 0
            continue
        if (r["doc_id"], text) not in done:  # a repeated row gets the same answer
            done[r["doc_id"], text] = plain_cut(text, seen, counts, breaks)
        expected = done[r["doc_id"], text]
        assert {name: r[name] for name in expected} == expected
        data, pieces, at = text.encode(), [], 0
        for a, b in r["spans"]:
            pieces.append(data[at:a])
            at = b
        assert b"".join([*pieces, data[at:]]).decode() == r["kept"]


def test_paragraphs_long_text_and_empty_table(spark):
    unit = "one two three four five"
    docs = spark.createDataFrame([(1, f"{unit}\n\n" * 30_000, "", 1, "", 1), (2, f"{unit}\n\nrest", "", 1, "", 1)], DOCS)
    got = {r["doc_id"]: (r["kept"], r["n_removed"]) for r in unit_dedup.remove_repeated_units(docs, unit_dedup.PARAGRAPHS).collect()}
    assert got == {1: (f"{unit}\n\n", 29_999), 2: ("rest", 1)}
    assert unit_dedup.remove_repeated_units(docs.limit(0)).count() == 0
