"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger row holds the measurements and one long
whose bit ``b`` is set where rule ``b`` fails. Policies are named, versioned sets of bits applied
to the ledger afterwards; what a rule contributes to a policy is counted from the bits alone, so
neither a new policy nor an ablation reads a text again.

Built from SQL functions only. Each document is measured by itself: no shuffle, whatever the
number of copies or the size of a source; the ablation groups by the mask, which has at most
``2 ** len(RULES)`` values and is summed before the shuffle.

Defined results: a null or empty text has no words, fails ``too_short`` and nothing else; rows that
repeat are measured each; an empty table gives an empty ledger; other columns are left alone, and
columns named like the ledger's own are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from rategauge.llm.text import whole, words

WINDOW = 8
SYMBOLS = "[#*$%&|<>]+"

#: Rule name and its failure test over the measurements; the place in the tuple is the bit.
#: New rules go at the end: stored ledgers keep their meaning.
RULES: tuple[tuple[str, str], ...] = (
    ("too_short", "n_words < 20"),
    ("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("repeated_lines", "2 * n_dup_lines > n_lines"),
    ("upper_case", "10 * n_upper > 3 * word_chars"),
    ("exclamation", "5 * n_exclaim > n_words"),
    ("stutter", "100 * n_stutter > 30 * n_words"),
    ("word_length", "word_chars > 30 * n_words"),
)
MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_lines",
    "n_dup_lines",
    "n_repeat_words",
    "n_upper",
    "n_exclaim",
    "n_stutter",
)
FAILURES = "failures"


def bit(rule: str) -> int:
    return 1 << next(i for i, (name, _) in enumerate(RULES) if name == rule)


@dataclass(frozen=True)
class Policy:
    """A document is kept where no rule of the policy fails."""

    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(bit(rule) for rule in self.rules)


BASE = Policy("base", 1, ("too_short", "repeated_windows"))
STANDARD = Policy("standard", 1, tuple(name for name, _ in RULES))


def _removed(text: Column, pattern: str) -> Column:
    """How many characters of the text the pattern covers."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _doubled(column: str, span: int) -> Column:
    """Hashes of windows twice as wide, from those of width ``span``; the last ones are cut short."""
    shifted = F.slice(column, span + 1, F.greatest(F.size(column), F.lit(1)))
    return F.zip_with(column, shifted, lambda a, b: F.xxhash64(a, b))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the measurements.

    Windows are compared by a 64-bit hash, made by doubling the width. Only a document whose hashes repeat
    sorts them with their positions; the starts of repeated windows, in order, then give the words
    covered in one walk.
    """
    t = whole(text)
    df = docs.drop(*(c for c in docs.columns if c in (*MEASURES, FAILURES) or c.startswith("_q_")))
    df = df.withColumn("_q_words", words(t)).withColumn("_q_n", F.size("_q_words"))
    df = df.withColumn("_q_w2", _doubled("_q_words", 1))
    df = df.withColumn("_q_w4", _doubled("_q_w2", 2)).withColumn("_q_w8", _doubled("_q_w4", 4))
    none = F.array().cast("array<bigint>")
    whole_windows = F.slice("_q_w8", F.lit(1), F.col("_q_n") - WINDOW + 1)
    df = df.withColumn("_q_win", F.when(F.col("_q_n") >= WINDOW, whole_windows).otherwise(none))
    placed = F.sort_array(
        F.transform("_q_win", lambda h, i: F.struct(h.alias("h"), i.cast("long").alias("i")))
    )
    repeats = F.size(F.array_distinct("_q_win")) < F.size("_q_win")
    df = df.withColumn("_q_placed", F.when(repeats, placed))
    size = F.size("_q_placed")

    def twin(x: Column, i: Column) -> Column:
        before = (i > 0) & (F.get(F.col("_q_placed"), i - 1)["h"] == x["h"])
        return before | ((i < size - 1) & (F.get(F.col("_q_placed"), i + 1)["h"] == x["h"]))

    starts = F.sort_array(F.transform(F.filter("_q_placed", twin), lambda x: x["i"]))
    df = df.withColumn("_q_starts", F.when(F.col("_q_placed").isNotNull(), starts))
    covered = F.aggregate(
        "_q_starts",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).cast("long").alias("last")),
        lambda a, s: F.struct(
            (a["n"] + F.least(F.lit(WINDOW).cast("long"), s - a["last"])).alias("n"),
            s.alias("last"),
        ),
        lambda a: a["n"],
    )
    df = df.withColumn(
        "_q_lines", F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    )
    stutter = F.filter(
        "_q_words", lambda w, i: (i > 0) & (F.get(F.col("_q_words"), i - 1) == w)
    )
    df = df.withColumns(
        {
            "n_words": F.col("_q_n").cast("long"),
            "word_chars": F.length(F.array_join("_q_words", "")).cast("long"),
            "n_symbols": _removed(t, SYMBOLS).cast("long"),
            "n_lines": F.size("_q_lines").cast("long"),
            "n_dup_lines": (F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))).cast("long"),
            "n_repeat_words": F.coalesce(covered, F.lit(0).cast("long")),
            "n_upper": _removed(t, "[A-Z]+").cast("long"),
            "n_exclaim": (F.length(t) - F.length(F.replace(t, F.lit("!")))).cast("long"),
            "n_stutter": F.size(stutter).cast("long"),
        }
    )
    return df.drop(*(c for c in df.columns if c.startswith("_q_")))


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with measurements and the failure mask."""
    marks = [
        F.when(F.expr(test), F.lit(1 << b)).otherwise(F.lit(0)).cast("long")
        for b, (_, test) in enumerate(RULES)
    ]
    mask = marks[0]
    for mark in marks[1:]:
        mask = mask.bitwiseOR(mark)
    return measured(docs, text).withColumn(FAILURES, mask)


def fails(policy: Policy) -> Column:
    return F.col(FAILURES).bitwiseAND(F.lit(policy.mask).cast("long")) != 0


def kept(policy: Policy) -> Column:
    return ~fails(policy)


def ablations(entries: DataFrame, *policies: Policy) -> DataFrame:
    """Per policy and rule: documents it fails, and those only it keeps out of the policy.

    Leaving the rule out of the policy would admit the second number.
    """
    masks = entries.groupBy(FAILURES).agg(F.count("*").alias("n"))
    wanted = F.array(
        *(
            F.struct(
                F.lit(p.name).alias("policy"),
                F.lit(p.version).alias("version"),
                F.lit(rule).alias("rule"),
                F.lit(p.mask).cast("long").alias("mask"),
                F.lit(bit(rule)).cast("long").alias("bit"),
            )
            for p in policies
            for rule in p.rules
        )
    )
    rows = masks.select(FAILURES, "n", F.inline(wanted))
    of_policy = F.col(FAILURES).bitwiseAND(F.col("mask"))
    return rows.groupBy("policy", "version", "rule").agg(
        F.sum(F.when(of_policy.bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("failed"),
        F.sum(F.when(of_policy == F.col("bit"), F.col("n")).otherwise(0)).alias("failed_alone"),
    )
