"""Mix sources to target weights, by budgets of words.

Every document gets a hash-random key. Within a source, the documents are sorted by key in ranges
of the key space, word counts are summed per range, and a prefix sum over the ranges gives each
document the number of words before it. A source whose budget exceeds its words is repeated in
whole epochs; the rest of the budget is cut at exactly the word where it ends.

Defined cases: a null text has 0 words; a null source is a source of its own, last in order; rows
with equal keys are ordered by doc_id and size, so equal rows are interchangeable; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotelane.llm.common import pieces, written
from quotelane.operators.numbering import numbered

ROWS_PER_RANGE = 512
RANGES_PER_GROUP = 1024


def hash_key(column: str = "doc_id") -> F.Column:
    """A repeatable random number below 2^60, from the id alone."""
    digest = F.md5(F.coalesce(F.col(column).cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: int) -> DataFrame:
    """Target of each source: its weight's part of all words, at most ``most`` times its own words.

    What a stopped source leaves is shared again by weight among the others until none is above.
    ``sizes`` has a row per source: source, source_size.
    """
    order = [F.col("source").asc_nulls_last()]
    ranked = numbered(sizes, order, "_rank")
    pick = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    ranked = written(
        ranked.select("source", "source_size", pick.cast("long").alias("weight"), (F.col("source_size") * most).alias("cap")),
        "weights",
        light=True,
    )
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    # the level only rises, so a stopped source stays stopped; every turn stops one more at least
    level, stopped = 0.0, -1
    while True:
        over = F.col("weight") * F.lit(level) > F.col("cap")
        held, weight, now = ranked.agg(
            F.sum(F.when(over, F.col("cap")).otherwise(0)),
            F.sum(F.when(over, 0).otherwise(F.col("weight"))),
            F.sum(over.cast("long")),
        ).first()
        if now == stopped or not weight:
            break
        level, stopped = (total * share - held) / weight, now
    target = F.least(F.col("cap").cast("double"), F.col("weight") * F.lit(level))
    return ranked.select("source", "source_size", "weight", target.alias("target"))


def mix(
    docs: DataFrame,
    size: F.Column,
    weights: tuple[int, ...] = (1, 2, 3),
    share: float = 1.0,
    most: int = 3,
    keys: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """A row per document: its ``keys``, size, source, source_size, target, epochs and taken.

    ``taken`` are the words the mix takes of the document: ``epochs`` whole copies, and for the
    document in which the budget ends, the words up to there.
    """
    rows = docs.select(*keys, "source", size.alias("size"), hash_key().alias("key"))
    rows = written(rows, "sizes")
    ranges = pieces(rows.count(), ROWS_PER_RANGE)
    rows = rows.withColumn("range", F.shiftright(F.shiftright("key", 30) * ranges, 30))
    per_range = rows.groupBy("source", "range").agg(F.sum("size").alias("words"))
    per_range = written(per_range.withColumn("group", F.floor(F.col("range") / RANGES_PER_GROUP)), "ranges", light=True)
    per_group = per_range.groupBy("source", "group").agg(F.sum("words").alias("group_words"))

    def before(column: str, keys: list[str], order: list[str]) -> F.Column:
        window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(column).over(window), F.lit(0))

    groups = per_group.withColumn("group_before", before("group_words", ["source"], ["group"]))
    targets = source_targets(
        per_group.groupBy("source").agg(F.sum("group_words").alias("source_size")), weights, share, most
    )
    starts = _join(per_range, groups, ["source", "group"]).withColumn(
        "range_before", F.col("group_before") + before("words", ["source", "group"], ["range"])
    )
    starts = _join(starts, targets, ["source"]).select(
        "source", "range", "range_before", "source_size", "target"
    )
    within = before("size", ["source", "range"], ["key", *keys, "size"])
    placed = _join(rows.withColumn("within", within), starts, ["source", "range"])
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    rest = budget - epochs * F.col("source_size") - F.col("range_before") - F.col("within")
    cut = F.greatest(F.lit(0), F.least(F.col("size"), rest))
    return placed.select(
        *keys,
        "size",
        "source",
        "source_size",
        "target",
        epochs.cast("long").alias("epochs"),
        (epochs * F.col("size") + cut).cast("long").alias("taken"),
    )


def _join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join in which null keys are equal."""
    renamed = right.select(*[F.col(c).alias(f"_{c}" if c in keys else c) for c in right.columns])
    on = [left[k].eqNullSafe(renamed[f"_{k}"]) for k in keys]
    return left.join(renamed, on).drop(*[f"_{k}" for k in keys])
