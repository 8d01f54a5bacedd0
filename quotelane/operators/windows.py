"""Tumbling-window aggregates and the running total.

All but the allocation lists combine on the map side, so a hot key costs one row per task and
window. Every function but ``rolling_quantity`` works on static and streaming frames alike; a
streaming frame needs a watermark on ``ts``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from quotelane.functions import market_value
from quotelane.operators.scan import Running, running
from quotelane.streaming import counts

ACCOUNT_KEY = ("account", "subAccount", "cusip")
SYMBOL_KEY = ("cusip",)


class _Windowed:
    """Rows put into tumbling windows, ready to group.

    A streaming frame groups by the window itself, which carries the watermark. A static one
    groups by the window's start as a number, which sorts and hashes cheaper than a struct.
    """

    def __init__(self, df: DataFrame, width: str, within: str = "ts") -> None:
        self.streaming = df.isStreaming
        if self.streaming:
            self.rows = df.withColumn("_w", F.window(within, width))
            self.key = "_w"
            start, end = F.unix_millis("_w.start"), F.unix_millis("_w.end")
        else:
            # rows that were in a window before stand at its start
            at = F.timestamp_millis("windowStart") if within == "window" else F.col(within)
            self.rows = df.withColumn("_start", F.unix_millis(F.window(at, width)["start"]))
            self.key = "_start"
            start = F.col("_start")
            end = start + F.expr(f"unix_millis(timestamp_millis(0) + interval {width})")
        self.end = end
        self.bounds = [start.alias("windowStart"), end.alias("windowEnd")]
        # for a further aggregate in the same window
        self.onward = [F.col("_w").alias("window")] if self.streaming else []

    def by(self, *keys: str) -> GroupedData:
        return self.rows.groupBy(self.key, *keys)


def last_value_in_window(
    priced: DataFrame, keys: Sequence[str], carried: Sequence[str] = (), width: str = "1 minute"
) -> DataFrame:
    """Market value of the last priced position per key and window, stamped with the window end."""
    windowed = _Windowed(priced, width)
    last = windowed.by(*keys).agg(
        F.max_by(F.struct("quantity", "price", *carried), F.struct("ts", "ord")).alias("last")
    )
    return last.select(
        *windowed.bounds,
        *keys,
        *[F.col(f"last.{c}").alias(c) for c in carried],
        F.col("last.quantity").alias("quantity"),
        F.col("last.price").alias("price"),
        market_value("last.quantity", "last.price").alias("marketValue"),
        windowed.end.alias("timestamp"),
    )


def sum_in_window(
    positions: DataFrame,
    keys: Sequence[str] = ACCOUNT_KEY,
    first: Sequence[str] = ("orderId", "timestamp"),
    width: str = "10 seconds",
) -> DataFrame:
    """Quantity per key and window; the ``first`` columns are those of the window's first row."""
    windowed = _Windowed(positions, width)
    summed = windowed.by(*keys).agg(
        F.sum("quantity").alias("quantity"),
        F.min_by(F.struct("ord", *first), F.struct("ts", "ord")).alias("head"),
    )
    return summed.select(
        *windowed.onward,
        *windowed.bounds,
        *keys,
        "quantity",
        F.col("head.ord").alias("ord"),
        *[F.col(f"head.{c}").alias(c) for c in first],
    )


def total_in_window(
    positions: DataFrame, keys: Sequence[str] = ACCOUNT_KEY, width: str = "10 seconds"
) -> DataFrame:
    """Quantity per key and window as a fresh record without time or order id."""
    windowed = _Windowed(positions, width)
    return windowed.by(*keys).agg(F.sum("quantity").alias("quantity")).select(
        *windowed.onward,
        *windowed.bounds,
        *keys,
        "quantity",
        F.lit(0).cast("bigint").alias("timestamp"),
        F.lit(None).cast("string").alias("orderId"),
    )


def symbol_quantity(positions: DataFrame, width: str = "10 seconds", within: str = "ts") -> DataFrame:
    """Quantity per security and window, stamped with the window end.

    ``within="window"`` rolls up rows that come from a window aggregate.
    """
    windowed = _Windowed(positions, width, within)
    return windowed.by("cusip").agg(F.sum("quantity").alias("quantity")).select(
        *windowed.bounds, "cusip", "quantity", windowed.end.alias("timestamp")
    )


def cusip_allocations(positions: DataFrame, width: str = "10 seconds", within: str = "ts") -> DataFrame:
    """The allocations of a security and window as one list in arrival order.

    The list is the record itself, so it must fit a row.
    """
    windowed = _Windowed(positions, width, within)
    entry = F.struct("ord", "account", "subAccount", F.col("quantity").cast("bigint").alias("quantity"))
    listed = windowed.by("cusip").agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    return listed.select(
        *windowed.bounds,
        "cusip",
        F.transform(
            "entries",
            lambda e: F.struct(
                e["account"].alias("account"),
                e["subAccount"].alias("subAccount"),
                e["quantity"].alias("quantity"),
            ),
        ).alias("allocations"),
    )


def allocation_text(allocations: str | Column = "allocations") -> Column:
    """A list of allocations as flat text, for comparing and printing."""
    return F.array_join(
        F.transform(
            allocations,
            lambda a: F.concat_ws("/", a["account"], a["subAccount"], a["quantity"].cast("string")),
        ),
        ",",
    )


def word_count(words: DataFrame, width: str = "5 seconds", together: int = 1) -> DataFrame:
    """``together``: so many windows of a stream lie together in the state, as packets of counts, and are given out at
    once, where results may wait for each other, as in a replay (``streaming.counts``)."""
    windowed = _Windowed(words, width)
    if windowed.streaming and together > 1:
        width_ms = words.sparkSession.sql(f"SELECT unix_millis(timestamp_millis(0) + interval {width})").first()[0]
        starts = windowed.rows.withColumn("_start", F.unix_millis("_w.start"))
        return counts.word_count(starts, "_start", width_ms, together)
    return windowed.by("word").agg(F.count("*").alias("count")).select(*windowed.bounds, "word", "count")


def rolling_quantity(
    positions: DataFrame, keys: Sequence[str] = ACCOUNT_KEY, segment_rows: int | None = None
) -> DataFrame:
    """The key's running total, one row per input row."""
    return running(
        positions,
        list(keys),
        "ord",
        [Running("rollingQuantity", "sum", F.col("quantity"))],
        segment_rows=segment_rows,
    )
