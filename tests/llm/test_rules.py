from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from gaugeline.llm import rules

DOCS = "doc_id long, text string, words int, lines string, n_words string"


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall("[#*$%&|<>]", text or "")),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "base_failed": len(words) < 50 or 100 * len(covered) > 50 * len(words),
    }


def texts():
    rng = random.Random(2)
    out = [None, "", " \t\n", "one", "a b c a b c", "a a a a a", "é ü\u00a0x \u2003 y", "x\ny\nx\n\n  \nx", "#*$%&|<> !", "a b c " * 40_000]
    for _ in range(40):
        words = [rng.choice(["the", "of", "a", "bc", "déf", "#x", "über"]) for _ in range(rng.randint(0, 300))]
        out.append("".join(w + rng.choice([" ", "  ", "\n", "\t", "\r\n", "\x0b"]) for w in words))
    return out


def test_counts_equal_plain_python(spark):
    all_texts = texts()
    rows = [(i, t, 1, "clash", "clash") for i, t in enumerate(all_texts)] + [(None, "x y z", 1, "", ""), (0, None, 1, "", "")]
    got = rules.judge(spark.createDataFrame(rows, DOCS)).collect()
    assert len(got) == len(rows)
    for r in got:
        want = plain("x y z" if r["doc_id"] is None else all_texts[r["doc_id"]])
        assert {k: r[k] for k in want} == want
        assert not (r["kept"] and r["base_failed"])


@pytest.mark.parametrize(
    ("text", "failed"),
    [
        (" ".join(f"the word{i}" for i in range(40)), ""),
        (" ".join(f"word{i}" for i in range(80)), "stop_words"),
        (" ".join(f"the word{i}#" for i in range(40)), "symbols"),
        ("\n".join(f"the word number {i % 30} here" for i in range(90)), "repeated_lines"),
        (" ".join(f"the {'x' * 40}{i}" for i in range(40)), "long_or_short_words"),
    ],
)
def test_each_rule(spark, text, failed):
    row = rules.judge(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row["failed_rules"] == failed
    assert row["kept"] == (not failed and not row["base_failed"])


def test_no_user_function_and_empty_table(spark):
    judged = rules.judge(spark.createDataFrame([], DOCS))
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    assert judged.count() == 0
