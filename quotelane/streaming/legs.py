"""The desk's legs as streaming plans, and event-time rules."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame

from quotelane.operators import windows
from quotelane.streaming import held, keyed, spread


def with_periodic_watermark(df: DataFrame, slack_ms: int = 0) -> DataFrame:
    """Watermark at the latest time seen, less ``slack_ms``, moved once per micro-batch.

    Serves the periodic, ascending and punctuated rules, which differ only within a micro-batch.
    """
    return df.withWatermark("ts", f"{slack_ms} milliseconds")


def with_lagging_watermark(df: DataFrame, lag_ms: int = 5_000) -> DataFrame:
    """Watermark ``lag_ms`` behind the latest time seen.

    The rule it stands for lags behind the wall clock. The two agree while rows keep arriving at
    the pace of the clock; in a lull this watermark waits, where the clock's would go on.
    """
    return df.withWatermark("ts", f"{lag_ms} milliseconds")


def with_watermark_each(parts: Sequence[DataFrame], slack_ms: int = 0) -> DataFrame:
    """Streams united, each with a watermark of its own: the one that lags most holds the clock.

    A partition of a topic is in order by arrival, so with a stream per partition no row is late, whatever the
    partitions' lags. A partition that has sent nothing yet holds the clock too.
    """
    return reduce(DataFrame.unionByName, [with_periodic_watermark(p, slack_ms) for p in parts])


def account_leg(
    events: DataFrame,
    width: str = "1 minute",
    order: str | None = None,
    shards: int = 1,
    bucket_ms: int = held.BUCKET_MS,
    together: int = 1,
) -> DataFrame:
    """``order``: what orders rows that arrive in none (``held.MESSAGES`` or ``held.NUMBERED``); without it a
    security's rows must arrive in order from one micro-batch to the next. ``shards``: over how many
    tasks one security's positions are spread. ``width`` is a multiple of ``bucket_ms``."""
    priced = _priced(events, keyed.ACCOUNT_SLOT, order, shards, bucket_ms, together)
    return windows.last_value_in_window(priced, windows.ACCOUNT_KEY, ("orderId",), width)


def symbol_leg(
    events: DataFrame,
    width: str = "1 minute",
    order: str | None = None,
    shards: int = 1,
    bucket_ms: int = held.BUCKET_MS,
    together: int = 1,
) -> DataFrame:
    priced = _priced(events, keyed.SYMBOL_SLOT, order, shards, bucket_ms, together)
    return windows.last_value_in_window(priced, windows.SYMBOL_KEY, (), width)


def _priced(events: DataFrame, slot: str, order: str | None, shards: int, bucket_ms: int, together: int) -> DataFrame:
    if order is None:
        return keyed.price_single_slot(events, slot)
    if shards == 1:
        return held.price_single_slot(events, slot, order, bucket_ms, together)
    numbers = ("partition", "offset") if order == held.MESSAGES else ("ord",)
    return spread.price_single_slot(events.withColumn("seq", spread.sequence(*numbers)), slot, shards, bucket_ms, together)
