"""Pricing positions with the prices of the same security, by arrival order.

Input is one frame of both sides: ``kind`` (position or price), ``cusip``, ``ord`` (arrival
number), ``timestamp`` (epoch ms), ``price`` on price rows and any position columns. Output rows
carry the position's columns, the price, and ``ord`` and ``timestamp`` of the row that caused them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotelane.functions import event_time, market_value
from quotelane.operators.scan import Running, running, with_segments

ACCOUNT_FIELDS = ("account", "subAccount", "quantity", "orderId")
SYMBOL_FIELDS = ("quantity",)


def tag_sides(
    positions: DataFrame, prices: DataFrame, fields: Sequence[str] = ACCOUNT_FIELDS
) -> DataFrame:
    """One frame of both sides; prices are narrowed to double as pricing does."""
    common = ["ord", "timestamp", "cusip"]
    left = positions.select(
        *common, F.lit("position").alias("kind"), *fields, F.lit(None).cast("double").alias("price")
    )
    right = prices.select(
        *common, F.lit("price").alias("kind"), F.col("price").cast("double").alias("price")
    )
    return left.unionByName(right, allowMissingColumns=True)


def _single_slot_segments(
    events: DataFrame, fields: Sequence[str], segment_rows: int | None
) -> tuple[DataFrame, DataFrame]:
    """The rows with what precedes them in their segment, and what enters each segment."""
    is_price = F.col("kind") == "price"
    # Both uses of the shuffled rows need exactly these columns, so that they share one exchange.
    rows = with_segments(events, ["cusip"], "ord", segment_rows).select(
        "cusip",
        "_seg",
        "ord",
        F.struct("kind", "timestamp", *fields).alias("_row"),
        F.when(is_price, F.col("price")).alias("_quote"),
    )
    in_segment = Window.partitionBy("cusip", "_seg").orderBy("ord")
    so_far = in_segment.rowsBetween(Window.unboundedPreceding, 0)
    previous = F.lag("_row").over(in_segment).alias("_prev")
    latest = F.last("_quote", ignorenulls=True).over(so_far).alias("_px")
    local = rows.select("*", previous, latest)
    # A segment's first and last row and its locking prices tell all; few rows reach the aggregate.
    row_is_price = F.col("_row.kind") == "price"
    locks = row_is_price & (F.col("_prev.kind") == "price")
    summary = (
        rows.select("*", previous, latest, F.lead("ord").over(in_segment).alias("_next_ord"))
        .where(F.col("_prev").isNull() | F.col("_next_ord").isNull() | locks)
        .groupBy("cusip", "_seg")
        .agg(
            F.max_by(F.struct("_row", "_px"), "ord").alias("_last"),
            F.min_by(F.col("_row.kind"), "ord").alias("_first_kind"),
            F.min("ord").alias("_first_ord"),
            F.min(F.when(locks, F.col("ord"))).alias("_lock_in"),
        )
    )
    over_segments = Window.partitionBy("cusip").orderBy("_seg")
    before = over_segments.rowsBetween(Window.unboundedPreceding, -1)
    entering = summary.select(
        "cusip",
        "_seg",
        "_first_kind",
        "_first_ord",
        "_lock_in",
        F.lag("_last._row").over(over_segments).alias("_enter"),
        F.last("_last._px", ignorenulls=True).over(before).alias("_enter_px"),
    )
    locks_at_start = (F.col("_first_kind") == "price") & (
        F.col("_enter").isNull() | (F.col("_enter.kind") == "price")
    )
    carry = entering.select(
        "cusip",
        "_seg",
        "_enter",
        "_enter_px",
        F.min(F.least("_lock_in", F.when(locks_at_start, F.col("_first_ord"))))
        .over(Window.partitionBy("cusip"))
        .alias("_lock"),
    )
    return local, carry


def price_single_slot(
    events: DataFrame, fields: Sequence[str] = ACCOUNT_FIELDS, segment_rows: int | None = None
) -> DataFrame:
    """Pair through one position slot and one price slot per security.

    A price that meets a waiting position is spent on it. The first price that meets none is kept
    for good: from that row on (``lock``) every position goes out at the latest price. Only the
    row before and the latest price matter, so segments exchange their last row, their last price
    and the earliest locking row.
    """
    local, carry = _single_slot_segments(events, fields, segment_rows)
    row_is_price = F.col("_row.kind") == "price"
    joined = local.join(carry, ["cusip", "_seg"]).withColumn("_before", F.coalesce("_prev", "_enter"))
    spent = (
        row_is_price
        & (F.col("_before.kind") == "position")
        & (F.col("_lock").isNull() | (F.col("ord") < F.col("_lock")))
    )
    cached = (F.col("_row.kind") == "position") & (F.col("ord") > F.col("_lock"))
    priced = joined.where(spent | cached).select(
        "cusip",
        F.when(row_is_price, F.col("_before")).otherwise(F.col("_row")).alias("_position"),
        F.coalesce("_quote", "_px", "_enter_px").alias("price"),
        "ord",
        F.col("_row.timestamp").alias("timestamp"),
    )
    return priced.select(
        "cusip",
        *[F.col(f"_position.{f}").alias(f) for f in fields],
        "price",
        "ord",
        "timestamp",
        event_time("timestamp").alias("ts"),
    )


def slot_state(
    events: DataFrame, fields: Sequence[str] = ACCOUNT_FIELDS, segment_rows: int | None = None
) -> DataFrame:
    """The rows of ``events`` that alone put single-slot pricing where it ends: per security the
    latest price once one is kept, else the position that waits, else none."""
    _, carry = _single_slot_segments(events, fields, segment_rows)
    locks = carry.groupBy("cusip").agg(F.min("_lock").alias("_lock"))
    row = F.struct(*events.columns)
    last = events.where(F.col("cusip").isNotNull()).groupBy("cusip").agg(
        F.max_by(row, F.col("ord")).alias("_last"),
        F.max_by(row, F.when(F.col("kind") == "price", F.col("ord"))).alias("_last_price"),
    )
    kept = F.when(F.col("_lock").isNotNull(), F.col("_last_price")).when(
        F.col("_last.kind") == "position", F.col("_last")
    )
    return last.join(locks, "cusip").select(kept.alias("_kept")).where(F.col("_kept").isNotNull()).select("_kept.*")


def with_next_price(
    events: DataFrame, fields: Sequence[str] = ACCOUNT_FIELDS, segment_rows: int | None = None
) -> DataFrame:
    """Add ``_next`` to every row: price, arrival number and time of the next price after it."""
    upcoming = F.when(F.col("kind") == "price", F.struct("price", "ord", "timestamp"))
    return running(
        events.select("cusip", "ord", "timestamp", "kind", "price", *fields),
        ["cusip"],
        "ord",
        [Running("_next", "last", upcoming)],
        backward=True,
        inclusive=False,
        segment_rows=segment_rows,
    )


def list_state(
    events: DataFrame, fields: Sequence[str] = ACCOUNT_FIELDS, segment_rows: int | None = None
) -> DataFrame:
    """The positions that still wait for a price after ``events``."""
    waiting = with_next_price(events, fields, segment_rows).where((F.col("kind") == "position") & F.col("_next").isNull())
    return waiting.drop("_next")


def value_at_next_price(scanned: DataFrame, fields: Sequence[str] = ACCOUNT_FIELDS) -> DataFrame:
    return scanned.where((F.col("kind") == "position") & F.col("_next").isNotNull()).select(
        "cusip",
        *fields,
        F.col("_next.price").alias("price"),
        market_value("quantity", "_next.price").alias("marketValue"),
        F.col("_next.ord").alias("ord"),
        F.col("_next.timestamp").alias("timestamp"),
        event_time("_next.timestamp").alias("ts"),
        F.col("ord").alias("positionOrd"),
    )


def price_list_buffer(
    events: DataFrame, fields: Sequence[str] = ACCOUNT_FIELDS, segment_rows: int | None = None
) -> DataFrame:
    """Every position waits for the next price of its security, which values it."""
    return value_at_next_price(with_next_price(events, fields, segment_rows), fields)
