"""Rule-based quality filter: a table of thresholds compiled into one projection.

``measures`` turns a text into numbers with built-in functions alone; ``compile_rules`` turns a
table of (rule, measure, low, high) into one boolean column per rule; ``judge`` puts both into
projections over the documents, with no shuffle and no user function.

Defined cases: a null or empty text has no words and fails on its length; ratios over no words or
no lines are 0; other columns of the table are ignored; rows are judged one by one, so repeated
rows get equal results.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelane.llm.common import BLANKS, WORD

SYMBOLS = "#*$%&|<>"

# Frequent function words of the corpus languages.
STOP_WORDS = (
    "the be to of and that have with in is it for on was as at by from or "
    "der die das und ist nicht mit von zu ein eine auch im den "
    "le la les de des et est un une du que dans pour "
    "el los las y en es una del por con para"
).split()


@dataclass(frozen=True)
class Rule:
    """A document passes if low <= measure <= high; a missing bound doesn't hold it."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


RULES = (
    Rule("enough_words", "n_words", low=50),
    Rule("few_repeats", "repeat_word_ratio", high=0.5),
    Rule("word_length", "mean_word_chars", low=2, high=15),
    Rule("few_symbols", "symbol_word_ratio", high=0.3),
    Rule("stop_words", "stop_word_ratio", low=0.02),
    Rule("few_repeated_lines", "dup_line_ratio", high=0.5),
)
BASE_RULES = ("enough_words", "few_repeats")


def _ratio(part: F.Column, whole: F.Column) -> F.Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def measures(docs: DataFrame, stop_words: list[str] = STOP_WORDS) -> DataFrame:
    """doc_id and the measures of every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    split = docs.select(
        "doc_id",
        text.alias("_text"),
        F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1)).alias("_words"),
        F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD)).alias("_lines"),
    )
    words = F.col("_words")
    # each 3-word window as hash-free text with its place; equal windows are neighbours once sorted
    windows = F.when(
        F.size(words) >= 3,
        F.sort_array(
            F.transform(
                F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))),
                lambda word, i: F.struct(
                    F.concat_ws(" ", word, F.get(words, i + 1), F.get(words, i + 2)).alias("w"), i.alias("i")
                ),
            )
        ),
    )
    split = split.withColumn("_windows", windows)
    sorted_windows = F.col("_windows")
    repeated = F.filter(
        sorted_windows,
        lambda x, i: (x["w"] == F.get(sorted_windows, i - 1)["w"]).eqNullSafe(True)
        | (x["w"] == F.get(sorted_windows, i + 1)["w"]).eqNullSafe(True),
    )
    covered = F.array_distinct(F.flatten(F.transform(repeated, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))))
    n_words = F.size(words).cast("long")
    counted = split.select(
        "doc_id",
        n_words.alias("n_words"),
        F.length(F.translate("_text", BLANKS, "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.size(covered), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.regexp_count(
            F.concat(F.lit(" "), F.regexp_replace(F.lower("_text"), r"[ \t-\r.,]+", "  "), F.lit(" ")),
            F.lit(" (?:" + "|".join(dict.fromkeys(stop_words)) + ") "),
        ).cast("long").alias("n_stop_words"),
    )
    n = F.col("n_words")
    return counted.select(
        "*",
        _ratio(F.col("word_chars"), n).alias("mean_word_chars"),
        _ratio(F.col("n_symbols"), n).alias("symbol_word_ratio"),
        _ratio(F.col("n_stop_words"), n).alias("stop_word_ratio"),
        _ratio(F.col("n_dup_lines"), F.col("n_lines")).alias("dup_line_ratio"),
        _ratio(F.col("n_repeat_words"), n).alias("repeat_word_ratio"),
    )


def compile_rules(rules: tuple[Rule, ...]) -> dict[str, F.Column]:
    """One boolean column per rule: does a document pass it."""
    compiled = {}
    for rule in rules:
        value, test = F.col(rule.measure), F.lit(True)
        if rule.low is not None:
            test = test & (value >= rule.low)
        if rule.high is not None:
            test = test & (value <= rule.high)
        compiled[rule.name] = test
    return compiled


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, base: tuple[str, ...] = BASE_RULES) -> DataFrame:
    """The measures, base_failed, kept, and the names of the rules that a document failed."""
    tests = compile_rules(rules)
    failed = F.filter(
        F.array(*[F.when(~test, F.lit(name)) for name, test in tests.items()]), lambda name: name.isNotNull()
    )
    judged = measures(docs).withColumn("failed_rules", failed)
    return judged.withColumn(
        "base_failed", F.arrays_overlap("failed_rules", F.array(*[F.lit(b) for b in base]))
    ).withColumn("kept", F.size("failed_rules") == 0)
