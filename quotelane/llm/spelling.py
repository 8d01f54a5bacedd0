"""Spelling variants: words that differ by one edited letter, and the form each leads to.

A word is marked by a terminator and rotated in all ways. A word with one letter skipped is a
rotation that begins behind the letter and ends before it: all words that have some letter in that
place, and the word that has none there, share this beginning. So the rotations are sorted, each
without the letter at its end and each whole, and every run of equal beginnings holds words near each
other: words with a letter there are replacements of one another, the word without is an indel of
each. A run has a word per letter of the alphabet at most, and is scanned with windows: how many
others it has, and which of them is the most frequent. No pairs are made.

An indel within a doubled letter is found in each place of the doubling; it counts where the letter
is the first of its kind.

A rotation is sorted by its first 24 letters and, beyond them, by a hash of 122 bits of the rest, and
stands for its word by the word's number, so that a long word has rotations of fixed size.

Defined cases: a null text has no words; a null id is written as nothing; an empty table gives an
empty result; a long run of letters is a word like any other; words of equal count are ordered by code
points; repeated rows count again; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotelane.llm.common import pieces, written
from quotelane.operators.numbering import numbered

LEAST_LENGTH = 5
LEAST_COUNT = 3
SLIPS = 97
HEAD = 24
WORDS_PER_TASK = 20_000
MARK = "$"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PRIMES = ((1 << 61) - 1, (1 << 61) - 31)
_BASES = (1_000_003, 92_821)
ROTATION = "head string, rest1 long, rest2 long, number long, n long, whole boolean, counts boolean"


def slipped(doc_id: Column, run: Column, every: int = SLIPS) -> Column:
    """The run, without one of its letters where a hash of id and run says so."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    short = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % every == 0, short).otherwise(run)


def vocabulary(docs: DataFrame, least: int = LEAST_LENGTH, often: int = LEAST_COUNT, slips: int = SLIPS) -> DataFrame:
    """word and n of the words of all texts that are long and frequent enough."""
    lowered = F.translate(F.col("text").cast("string"), _UPPER, _LOWER)
    # a slip only shortens a run, so runs below the least length are no words
    runs = docs.select(
        F.col("doc_id").alias("id"), F.explode(F.regexp_extract_all(lowered, F.lit(rf"([a-zÀ-ÿ]{{{least},}})"), F.lit(1))).alias("run")
    )
    counted = runs.groupBy(slipped(F.col("id"), F.col("run"), slips).alias("word")).agg(F.count("*").alias("n"))
    return counted.where((F.col("n") >= often) & (F.length("word") >= least))


def _rest_hashes(text: str) -> list[tuple[int, list[int], list[int]]]:
    """Per modulus: the hash of every beginning of a text and the powers needed to cut pieces."""
    out = []
    for prime, base in zip(_PRIMES, _BASES, strict=True):
        sums, powers = [0], [1]
        for c in text:
            sums.append((sums[-1] * base + ord(c) + 1) % prime)
            powers.append(powers[-1] * base % prime)
        out.append((prime, sums, powers))
    return out


def rotations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (number, word, n): every whole rotation, and every rotation without its last letter."""
    names = [f.split()[0] for f in ROTATION.split(", ")]
    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_()]
    for batch in batches:
        columns: list[list] = [[] for _ in names]
        for number, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            size = len(word)
            round_ = word + MARK + word
            hashes = _rest_hashes(round_) if size > HEAD - 1 else []

            def put(start: int, length: int, whole: bool, counts: bool) -> None:
                end = start + length
                rest = (0, 0)
                if length > HEAD:
                    rest = tuple((s[end] - s[start + HEAD] * w[length - HEAD]) % p for p, s, w in hashes)
                values = (round_[start : min(end, start + HEAD)], *rest, number, n, whole, counts)
                for column, value in zip(columns, values, strict=True):
                    column.append(value)

            for i in range(size + 1):
                put(i, size + 1, True, False)
                if i < size:
                    put(i + 1, size, False, i == 0 or word[i] != word[i - 1])
                if len(columns[0]) >= 1 << 16:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)
                    columns = [[] for _ in names]
        if columns[0]:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def neighbours(words: DataFrame) -> DataFrame:
    """Of words (number, word, n): n_near and the best near word (form_n, form_number) of each that has any."""
    # by count, as the file of a vocabulary may be one small split
    dealt = words.select("number", "word", "n").repartition(pieces(words.count(), WORDS_PER_TASK))
    sorted_ = dealt.mapInArrow(rotations, ROTATION)
    start = ["head", "rest1", "rest2"]
    ranged = sorted_.repartitionByRange(*start)
    run = Window.partitionBy(*start)
    ranked = run.orderBy(F.col("n").desc(), F.col("number"))
    everyone = ranked.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    pick = F.struct("n", (-F.col("number")).alias("order"))
    scanned = ranged.select(
        "number",
        "n",
        "whole",
        "counts",
        F.row_number().over(ranked).alias("rank"),
        F.nth_value(pick, 1).over(everyone).alias("first"),
        F.nth_value(pick, 2).over(everyone).alias("second"),
        F.count("*").over(everyone).alias("members"),
        F.count_if("whole").over(everyone).alias("wholes"),
        F.count_if("counts").over(everyone).alias("firsts"),
    ).where("members > 1")
    near = F.when(F.col("whole"), F.col("firsts")).otherwise(
        F.col("members") - F.col("wholes") - 1 + F.when(F.col("counts"), F.col("wholes")).otherwise(0)
    )
    best = F.when(F.col("rank") == 1, F.col("second")).otherwise(F.col("first"))
    return (
        scanned.groupBy("number")
        .agg(F.sum(near).cast("long").alias("n_near"), F.max(best).alias("best"))
        .select("number", "n_near", F.col("best.n").alias("form_n"), (-F.col("best.order")).alias("form_number"))
    )


def roots(links: DataFrame) -> DataFrame:
    """The last number reached from each by following (number, next), by doubling the steps."""
    now = written(links.select("number", F.col("next").alias("root")), "roots", light=True)
    while True:
        further = now.select(F.col("number").alias("root"), F.col("root").alias("beyond"))
        after = written(
            now.join(further, "root", "left").select(
                "number", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")
            ),
            "roots",
            light=True,
        )
        now = after.select("number", "root")
        if not after.where("moved").limit(1).count():
            return now


def variants(words: DataFrame, times: int = 2) -> DataFrame:
    """Of distinct words (word, n): word, n, n_near, form, form_n and root.

    A word's form is its most frequent near word, if that is ``times`` as frequent at least; the root is
    the last of the forms followed from the word.
    """
    if times < 2:
        raise ValueError("times must be 2 or more, as forms could go round in a circle")
    listed = written(numbered(words.select("word", "n"), [F.col("word")], "number"), "words")
    found = listed.join(neighbours(listed), "number", "left")
    fits = F.col("form_n") >= times * F.col("n")
    found = written(
        found.select(
            "number",
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(fits, F.col("form_n")).alias("form_n"),
            F.when(fits, F.col("form_number")).alias("next"),
        ),
        "forms",
    )
    ends = roots(found.where("next IS NOT NULL"))
    name = listed.select(F.col("number").alias("next"), F.col("word").alias("form"))
    last = listed.select(F.col("number").alias("root"), F.col("word").alias("last"))
    return (
        found.join(ends, "number", "left")
        .join(name, "next", "left")
        .join(last, "root", "left")
        .select("word", "n", "n_near", "form", "form_n", F.coalesce("last", "word").alias("root"))
    )
