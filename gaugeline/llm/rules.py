"""Quality rules: a table of thresholds compiled into one Spark projection, without user functions.

Every measure is a built-in expression over a document's own text, so a document never leaves its row: no shuffle, no
group, and memory bounded by the longest text. Thresholds are data (`RULES`), compiled by `judge`.

Defined results: a null or empty text has no words and fails the base rule; repeated rows are judged each; null ids are
returned as they are; an empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import WORD, own

#: Characters that count as symbols.
SYMBOLS = "[#*$%&|<>]"

#: What separates words.
SPACES = r"[\x20\x09-\x0D]+"

#: Base rule: at least so many words, and at most so many percent of them in repeated three-word windows.
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

#: Frequent function words of the languages that the corpus is expected to hold.
STOP_WORDS = (
    "a an and are as at be by for from has he in is it not of on or that the this to was were with "
    "au aux avec ce dans de des du elle en est et il la le les par pas pour que qui se sur un une "
    "aber als auch auf aus bei das dem den der die ein eine für im ist mit nicht sich sie und von wie zu zum "
    "al como con del el es esa ese eso los las lo más no o para pero por su sus una y"
).split()


@dataclass(frozen=True)
class Rule:
    """A document fails if the measure is below `least` or above `most`."""

    name: str
    measure: str
    least: float | None = None
    most: float | None = None

    def broken(self) -> Column:
        value = F.col(self.measure)
        found = F.lit(False)
        if self.least is not None:
            found = found | (value < F.lit(self.least))
        if self.most is not None:
            found = found | (value > F.lit(self.most))
        return found

    def sql(self) -> str:
        parts = [f"{self.measure} < {self.least!r}"] * (self.least is not None)
        parts += [f"{self.measure} > {self.most!r}"] * (self.most is not None)
        return "(" + " OR ".join(parts) + ")"


#: Measures are ratios, so that a rule means the same for any length.
RULES = (
    Rule("long_or_short_words", "word_length", least=2.0, most=16.0),
    Rule("symbols", "symbol_ratio", most=0.1),
    Rule("stop_words", "stop_ratio", least=0.02),
    Rule("repeated_lines", "dup_line_ratio", most=0.5),
)


def repeat_words(hashes: Column) -> Column:
    """Words in three-word windows that occur twice or more; `hashes` has one hash per window, in order.

    Windows sorted by (hash, place) stand next to their equals. The flagged places, again in order, each add the words
    up to the next flagged place, three at most.
    """
    order = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def places(order: Column) -> Column:
        def place(x: Column, j: Column) -> Column:
            before, after = F.get(order, j - 1)["h"], F.get(order, j + 1)["h"]
            return F.when(x["h"].eqNullSafe(before) | x["h"].eqNullSafe(after), x["i"])

        return F.sort_array(F.array_compact(F.transform(order, place)))

    def covered(places: Column) -> Column:
        steps = F.transform(places, lambda p, j: F.least(F.lit(3), F.coalesce(F.get(places, j + 1) - p, F.lit(3))))
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    # One-element arrays bind a value once, where a plain expression would be computed for each of its uses.
    bound = F.transform(F.array(order), places)
    total = F.get(F.transform(bound, covered), F.lit(0))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(total)


def words_of(text: Column) -> Column:
    """The words of a text: trimmed and split, which is cheaper than extracting each match."""
    trimmed = F.trim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACES))


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and the counts of every whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    split = own(docs, "doc_id", "text").select(
        "doc_id",
        words_of(text).alias("words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD)).alias("lines"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
    )
    words = F.col("words")
    windows = F.transform(
        F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)),
    )
    stops = F.filter(words, lambda w: F.lower(w).isin(*STOP_WORDS))
    counted = split.select(
        "doc_id",
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        "n_symbols",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(stops).cast("long").alias("n_stop_words"),
        windows.alias("windows"),
    )
    return counted.select("*", repeat_words(F.col("windows")).cast("long").alias("n_repeat_words")).drop("windows")


RATIOS = {
    "word_length": ("word_chars", "n_words"),
    "symbol_ratio": ("n_symbols", "n_words"),
    "stop_ratio": ("n_stop_words", "n_words"),
    "dup_line_ratio": ("n_dup_lines", "n_lines"),
}


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts, `base_failed`, the names of the broken rules and `kept` for every document."""
    counted = measure(docs)
    ratios = {name: F.col(a) / F.greatest(F.col(b), F.lit(1)) for name, (a, b) in RATIOS.items()}
    base = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    judged = counted.withColumns(ratios | {"base_failed": base})
    broken = F.concat_ws(",", *[F.when(rule.broken(), F.lit(rule.name)) for rule in rules])
    judged = judged.withColumn("failed_rules", broken)
    kept = ~F.col("base_failed") & (F.col("failed_rules") == "")
    return judged.withColumn("kept", kept).drop(*RATIOS, "n_lines")


def judge_sql(rules: tuple[Rule, ...] = RULES) -> str:
    """The same judgement over `documents` in DuckDB."""
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    broken = ", ".join(f"CASE WHEN {rule.sql()} THEN '{rule.name}' END" for rule in rules)
    ratios = ", ".join(f"{a}::DOUBLE / greatest({b}, 1) AS {name}" for name, (a, b) in RATIOS.items())
    return rf"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
 s AS (SELECT r, doc_id, regexp_extract_all(text, '{WORD}') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines,
    len(regexp_extract_all(text, '{SYMBOLS}')) AS n_symbols FROM t),
 g AS (SELECT r, unnest(list_transform(range(1, len(words) - 1),
      lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])) AS gram, unnest(range(1, len(words) - 1)) AS i FROM s),
 f AS (SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY r, gram) > 1),
 p AS (SELECT r, least(3, coalesce(lead(i) OVER (PARTITION BY r ORDER BY i) - i, 3)) AS step FROM f),
 w AS (SELECT r, sum(step) AS n FROM p GROUP BY r),
 c AS (SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars, n_symbols,
    len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    len(list_filter(words, lambda x: lower(x) IN ({stop}))) AS n_stop_words, coalesce(w.n, 0)::BIGINT AS n_repeat_words
    FROM s LEFT JOIN w USING (r)),
 j AS (SELECT *, {ratios}, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words AS base_failed
    FROM c),
 k AS (SELECT *, concat_ws(',', {broken}) AS failed_rules FROM j)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_stop_words, n_repeat_words, base_failed, failed_rules,
  NOT base_failed AND failed_rules = '' AS kept FROM k"""
