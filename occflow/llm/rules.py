"""Quality rules: a table of thresholds compiled into one projection.

Measures are built-in expressions over the whole text; a rule is a measure with a
least and a greatest value. ``judge`` adds the measures, a column for each rule and
the verdict. Nothing is shuffled.

Defined results: words are runs of characters other than space and the controls 9 to
13. A null or empty text has no words and measures of 0. A ratio with nothing below
the line is 0. A rule only speaks from its ``min_words`` on: 10, as fewer fail anyway,
and 20 for stop words, which a short text may lack by chance. Repeated rows get equal
results. Columns of ``docs`` that carry a name made here are replaced;
all others stay.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, WORD, boxed, quoted, unboxed

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is was for with that on are this from at by it he as an or be "
    "der die das und ist nicht mit sich auf für ein eine zu den im des dem auch von es "
    "le la les de et en un une que pour dans est pas au qui des sur du plus par "
    "el los las y que con por una para del se no su al lo como"
).split()

SYMBOLS = "#*$%&|<>"
BASE_WORDS, RATIO_WORDS = 10, 20


@dataclass(frozen=True)
class Rule:
    """A measure must lie within ``least`` and ``most``; None sets no bound."""

    name: str
    measure: str
    least: float | None = None
    most: float | None = None
    min_words: int = BASE_WORDS

    def passes(self) -> Column:
        value, ok = F.col(self.measure), F.lit(True)
        if self.least is not None:
            ok = ok & (value >= self.least)
        if self.most is not None:
            ok = ok & (value <= self.most)
        return ok | (F.col("n_words") < self.min_words)


THRESHOLDS = (
    Rule("mean_word_length", "chars_per_word", least=2.0, most=15.0),
    Rule("few_symbols", "symbols_per_word", most=0.1),
    Rule("stop_words", "stop_word_ratio", least=0.02, min_words=RATIO_WORDS),
    Rule("few_repeated_lines", "dup_line_ratio", most=0.3),
    Rule("few_shouted_words", "bang_word_ratio", most=0.3),
)


def _ratio(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))


def measures(docs: DataFrame, text: str = "text", width: int = 5) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the ratios."""
    # The input goes beside the steps as one column, so that its names can't clash with theirs.
    step = boxed(docs, text=F.coalesce(quoted(text), F.lit("")))
    has_word = lambda x: x.rlike(WORD)
    step = step.select(
        "row",
        "text",
        # Cutting at spaces is much faster than extracting words; it leaves empty parts at the ends.
        F.filter(F.split("text", SPACE, -1), lambda w: w != "").alias("words"),
        F.filter(F.split("text", "\n", -1), has_word).alias("lines"),
    )
    step = step.select(
        "row",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("words", lambda w: F.lower(w).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.size(F.filter("words", lambda w: w.endswith("!!"))).cast("long").alias("n_bang_words"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    counts = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_stop_words", "n_bang_words")
    window = lambda i: F.xxhash64(*[F.get("hashes", i + j) for j in range(width)])
    windows = F.when(F.size("hashes") > width, F.transform(F.sequence(F.lit(0), F.size("hashes") - width), window))
    step = step.select("row", *counts, windows.alias("windows"))
    # Only texts with a repeat sort their windows: equal hashes then stand together, and
    # their places, sorted again, add the words that no earlier window covers.
    repeats = F.size("windows") > F.size(F.array_distinct("windows"))
    placed = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    step = step.select("row", *counts, F.when(repeats, placed).alias("placed"))
    at = lambda i: F.get("placed", i)
    twice = F.filter(
        F.transform(
            "placed",
            lambda x, i: F.when(
                F.coalesce(at(i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(at(i + 1)["h"] == x["h"], F.lit(False)),
                x["i"],
            ),
        ),
        lambda i: i.isNotNull(),
    )
    step = step.select("row", *counts, F.sort_array(twice).alias("twice"))
    covered = F.aggregate(
        F.transform("twice", lambda p, i: F.least(F.coalesce(F.get("twice", i + 1) - p, F.lit(width)), F.lit(width))),
        F.lit(0).cast("long"),
        lambda a, b: a + b,
    )
    step = step.select("row", *counts, F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"))
    ratios = {
        "chars_per_word": ("word_chars", "n_words"),
        "symbols_per_word": ("n_symbols", "n_words"),
        "stop_word_ratio": ("n_stop_words", "n_words"),
        "bang_word_ratio": ("n_bang_words", "n_words"),
        "dup_line_ratio": ("n_dup_lines", "n_lines"),
    }
    step = step.select("*", *[_ratio(*x).alias(name) for name, x in ratios.items()])
    made = (*counts, "n_repeat_words", *ratios)
    # Columns that ``judge`` makes go as well.
    names = [c for c in docs.columns if c.lower() not in MEASURES]
    return unboxed(step, docs.columns, made).select(*[quoted(c) for c in names], *made)


MEASURES = (
    "n_words word_chars n_symbols n_lines n_dup_lines n_stop_words n_bang_words n_repeat_words "
    "chars_per_word symbols_per_word stop_word_ratio bang_word_ratio dup_line_ratio base_failed kept failed_rules"
).split()


def judge(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = THRESHOLDS) -> DataFrame:
    """``measures`` with base_failed, failed_rules (names, in table order) and kept."""
    found = measures(docs, text)
    failed = F.filter(
        F.array(*[F.when(~r.passes(), F.lit(r.name)) for r in rules] or [F.lit(None).cast("string")]),
        lambda x: x.isNotNull(),
    )
    return (
        found.withColumn("base_failed", (F.col("n_words") < BASE_WORDS) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
        .withColumn("failed_rules", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
    )
