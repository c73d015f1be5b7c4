"""Quality rules in a short-circuit cascade.

Each rule is a predicate that rejects a text.  On a sample of rows every rule is
timed and its rejections are counted; the cascade tries rules by rejections per
second, so that most bad texts are gone before the dear rules run.  A text is kept
when no rule rejects it, whatever the order, so the sample moves time, not results.
DataFrame functions only.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skygauge.llm.common import stored, whole, words

#: Rows (at most, in expectation) on which rules are timed.
SAMPLE_ROWS = 4000


@dataclass(frozen=True)
class Rule:
    """``rejects`` is built from the text and its words; it is never null."""

    name: str
    rejects: Column


@dataclass(frozen=True)
class Measured:
    rule: Rule
    seconds: float
    rejected: int

    @property
    def worth(self) -> float:
        return self.rejected / max(self.seconds, 1e-3)


# --- measures of one text ---------------------------------------------------

def word_chars(found: Column) -> Column:
    """Code points in words."""
    return F.length(F.array_join(found, "")).cast("long")


def n_symbols(text: Column) -> Column:
    """Characters of ``#*$%&|<>``."""
    return F.length(F.regexp_replace(whole(text), r"[^#*$%&|<>]+", "")).cast("long")


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line of the text."""
    lines = F.filter(F.split(whole(text), "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def n_repeat_words(found: Column, window: int = 3) -> Column:
    """Words inside a window of ``window`` words that the text holds at least twice.

    Windows are told apart by 64-bit hashes.  A text whose windows all differ ends
    after a hash set; otherwise windows are sorted by hash and position, and the
    positions of repeated ones are measured as a union of intervals.
    """
    none = F.lit(0).cast("long")
    hashes = F.transform(
        F.sequence(F.lit(0), F.size(found) - window),
        lambda i: F.xxhash64(*[F.get(found, i + k) for k in range(window)]))

    def repeated(order: Column) -> Column:
        starts = F.sort_array(F.transform(
            F.filter(order, lambda x, k: F.get(order, k - 1)["h"].eqNullSafe(x["h"])
                     | F.get(order, k + 1)["h"].eqNullSafe(x["h"])),
            lambda x: x["i"]))
        return F.aggregate(
            starts,
            F.struct(none.alias("n"), F.lit(-window).alias("last")),
            lambda acc, i: F.struct(
                (acc["n"] + F.least(F.lit(window), i - acc["last"])).alias("n"), i.alias("last")),
            lambda acc: acc["n"])

    def covered(hs: Column) -> Column:
        order = F.sort_array(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hs)) == F.size(hs), none).otherwise(_let(order, repeated))

    return F.when(F.size(found) > window, _let(hashes, covered)).otherwise(none)


# --- the cascade ------------------------------------------------------------

def measures(text: Column, found: Column) -> list[Column]:
    """The base measures of a text and its words."""
    return [
        F.size(found).cast("long").alias("n_words"), word_chars(found).alias("word_chars"),
        n_symbols(text).alias("n_symbols"), n_dup_lines(text).alias("n_dup_lines"),
        n_repeat_words(found).alias("n_repeat_words"),
    ]


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def default_rules() -> list[Rule]:
    """Rules over ``text``, ``found`` (its words) and the base measures.

    Limits follow published filters of web text.
    """
    text, found = F.col("text"), F.col("found")
    n, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    lines = F.size(F.split(whole(text), "\n"))
    bullets = F.filter(F.split(whole(text), "\n"), lambda line: line.rlike(r"^[\x20\x09-\x0D]*[-*•]"))
    return [
        Rule("mean_word_length", (chars < 2 * n) | (chars > 14 * n)),
        Rule("symbols", 100 * F.col("n_symbols") > 5 * chars),
        Rule("duplicate_lines", 100 * F.col("n_dup_lines") > 30 * lines),
        Rule("few_distinct_words", 100 * F.size(F.array_distinct(found)) < 15 * F.least(n, F.lit(200))),
        Rule("shouting", 100 * F.length(F.regexp_replace(whole(text), r"[^\p{Lu}]+", "")) > 30 * chars),
        Rule("bullets", 100 * F.size(bullets) > 90 * lines),
    ]


def measure_rules(sample: DataFrame, rules: Sequence[Rule], settled: Column) -> list[Measured]:
    """Seconds and rejections of each rule on the sample, best worth first.

    ``sample`` holds the columns that the rules read.  The time of a bare scan is
    taken off.  Ties go by name.
    """
    def timed(condition: Column) -> tuple[float, int]:
        began = time.perf_counter()
        row = sample.agg(F.count(F.when(condition, 1)).alias("n")).first()
        return time.perf_counter() - began, row["n"]

    timed(settled)
    idle = timed(settled)[0]
    found = []
    for rule in rules:
        seconds, rejected = timed(rule.rejects & ~settled)
        found.append(Measured(rule, max(seconds - idle, 1e-3), rejected))
    return sorted(found, key=lambda m: (-m.worth, m.rule.name))


def cascade(order: Sequence[Rule]) -> Column:
    """Name of the first rule that rejects, else null; later rules are not evaluated."""
    branch = F.when(order[0].rejects, order[0].name)
    for rule in order[1:]:
        branch = branch.when(rule.rejects, rule.name)
    return branch


def judge(docs: DataFrame, rules: Sequence[Rule] | None = None,
          sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with one struct column ``quality``: measures and the verdict.

    A null or empty text has no words, so the base rule rejects it; repeated rows
    are judged alike; an empty table stays empty.  Input columns keep their names,
    whatever these are: ``quality`` replaces a column of that name.
    """
    rules = default_rules() if rules is None else rules
    others = [F.col(f"`{c}`") for c in docs.columns if c != "quality"]

    def measured_rows(rows: DataFrame) -> DataFrame:
        texts = rows.select(F.struct(*others).alias("row"), F.col("text")).withColumn(
            "found", words(F.col("text")))
        return texts.select("row", "text", "found", *measures(F.col("text"), F.col("found")))

    share = min(1.0, sample_rows / max(docs.count(), 1))
    sample = stored((docs.sample(share, seed=17) if share < 1 else docs).select(*others), "rule-sample")
    order = [m.rule for m in measure_rules(measured_rows(sample.table), rules, base_failed())]
    return measured_rows(docs).select("row.*", F.struct(
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"),
        F.when(~base_failed(), cascade(order)).alias("rejected_by")).alias("quality"))


def kept() -> Column:
    """Whether a judged row stays."""
    return ~F.col("quality.base_failed") & F.col("quality.rejected_by").isNull()


def good(docs: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, with the columns of ``docs``, whatever their names.

    A filter is moved below the measures, which are then computed once more for each
    time that the verdict names them, unless it reads something like a partition id.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole_row"), "text")
    judged = judge(rows, rules).withColumn("judged_at", F.spark_partition_id())
    return judged.filter(kept() & (F.col("judged_at") >= 0)).select("whole_row.*")
