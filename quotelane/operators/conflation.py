"""Timer-conflated pricing: a price arms a timer, the timer values every waiting position.

Per security, the first price after a fire arms the next fire ``period_ms`` later. A fire emits the
latest position of every (account, sub-account) that arrived since the fire before, at the latest
price, and forgets positions and price. Rows at the very instant of a fire belong to the next one.

The fires form a chain: each depends on the one before. The chain is followed in three steps, so
that no task holds a whole security:

1. Distinct price times are grouped by security and span of ``span_ms``. A group holds at most
   ``span_ms`` times, as times are whole milliseconds. For each price time that may arm the
   span's first timer, it is worked out when the span's last timer fires.
2. These (arming time, last fire) pairs, merged where the last fire is the same, are walked in
   time order per security, one row at a time, giving each span the fire that precedes it.
3. Each span then lists its own fires.

Rows find their fire through a calendar with one row per security and ``period_ms`` of clock, since
such a stretch holds one fire at most.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotelane.functions import event_time, market_value

PERIOD_MS = 60_000
SPAN_MS = 4 * 3_600_000
LOG_START = -(1 << 62)

_PAIRS = "cusip string, span bigint, arm bigint, lastFire bigint"
_ENTRY = "cusip string, span bigint, notBefore bigint"
_FIRES = "cusip string, fire bigint"


def _spans_to_pairs(period_ms: int, span_ms: int):
    def pairs(key: tuple, times: pa.Table) -> pa.Table:
        cusip, span = (part.as_py() for part in key)
        at = np.sort(times.column("at").to_numpy())
        following = np.searchsorted(at, at + period_ms)
        last = np.where(following < len(at), following, np.arange(len(at)))
        while True:  # doubles the reach of every step
            further = last[last]
            if np.array_equal(further, last):
                break
            last = further
        # a timer armed in an earlier span fires less than one period into this one
        arming = int(np.searchsorted(at, span * span_ms + period_ms)) + 1
        arm, fire = at[:arming], at[last[:arming]] + period_ms
        keep = np.append(fire[1:] != fire[:-1], True)
        arm, fire = arm[keep], fire[keep]
        return pa.table(
            {
                "cusip": pa.array([cusip] * len(arm), pa.string()),
                "span": pa.array(np.full(len(arm), span)),
                "arm": pa.array(arm),
                "lastFire": pa.array(fire),
            }
        )

    return pairs


def _walk_pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by cusip, span and arming time."""
    cusip, not_before, done = None, LOG_START, None
    for batch in batches:
        entries = []
        for row in batch.itertuples(index=False):
            if row.cusip != cusip:
                cusip, not_before, done = row.cusip, LOG_START, None
            if row.span != done and row.arm >= not_before:
                entries.append((cusip, row.span, not_before))
                not_before, done = row.lastFire, row.span
        yield pd.DataFrame(entries, columns=["cusip", "span", "notBefore"])


def _spans_to_fires(period_ms: int):
    def fires(key: tuple, times: pa.Table) -> pa.Table:
        at = np.sort(times.column("at").to_numpy())
        found = []
        i = int(np.searchsorted(at, times.column("notBefore")[0].as_py()))
        while i < len(at):
            found.append(int(at[i]) + period_ms)
            i = int(np.searchsorted(at, found[-1]))
        cusip = key[0].as_py()
        return pa.table(
            {
                "cusip": pa.array([cusip] * len(found), pa.string()),
                "fire": pa.array(found, pa.int64()),
            }
        )

    return fires


def _floor_div(column: str, by: int) -> Column:
    """Whole-number division rounding down, also below zero."""
    return F.call_function("div", F.col(column) - F.pmod(column, F.lit(by)), F.lit(by))


def fire_times(prices: DataFrame, period_ms: int = PERIOD_MS, span_ms: int = SPAN_MS) -> DataFrame:
    """The fires (epoch ms) of every security, from price rows with ``timestamp``."""
    if span_ms < period_ms:
        raise ValueError("span_ms must not be shorter than period_ms")
    times = (
        prices.where(F.col("cusip").isNotNull() & F.col("timestamp").isNotNull())
        .select("cusip", F.col("timestamp").alias("at"))
        .distinct()
        .withColumn("span", _floor_div("at", span_ms))
        # both uses below then need the same rows and share one exchange
        .where(F.col("span").isNotNull())
    )
    pairs = times.groupBy("cusip", "span").applyInArrow(_spans_to_pairs(period_ms, span_ms), _PAIRS)
    entries = (
        pairs.repartition("cusip")
        .sortWithinPartitions("cusip", "span", "arm")
        .mapInPandas(_walk_pairs, _ENTRY)
    )
    return (
        times.join(entries, ["cusip", "span"])
        .groupBy("cusip", "span")
        .applyInArrow(_spans_to_fires(period_ms), _FIRES)
    )


def assign_fires(rows: DataFrame, fires: DataFrame, period_ms: int = PERIOD_MS) -> DataFrame:
    """Add ``fire``, the first fire after each row; rows before no fire are left out."""
    rows = rows.withColumn("stretch", _floor_div("timestamp", period_ms))
    marks = fires.select("cusip", _floor_div("fire", period_ms).alias("stretch"), "fire")
    later = (
        Window.partitionBy("cusip")
        .orderBy(F.col("stretch").desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    calendar = (
        rows.select("cusip", "stretch", F.lit(None).cast("bigint").alias("fire"))
        .unionByName(marks)
        .groupBy("cusip", "stretch")
        .agg(F.max("fire").alias("own"))
        .withColumn("later", F.last("own", ignorenulls=True).over(later))
        .where(F.col("own").isNotNull() | F.col("later").isNotNull())
    )
    return (
        rows.join(calendar, ["cusip", "stretch"])
        .withColumn("fire", F.when(F.col("own") > F.col("timestamp"), F.col("own")).otherwise(F.col("later")))
        .where(F.col("fire").isNotNull())
        .drop("stretch", "own", "later")
    )


def timer_state(
    events: DataFrame, period_ms: int = PERIOD_MS, span_ms: int = SPAN_MS
) -> DataFrame:
    """The rows of ``events`` since each security's last fire that is over, which alone put conflation where
    it ends. A timer that is armed but not over at a security's latest row is still to fire."""
    latest = events.groupBy("cusip").agg(F.max("timestamp").alias("_latest"))
    over = (
        fire_times(events.where(F.col("kind") == "price"), period_ms, span_ms)
        .join(latest, "cusip")
        .where(F.col("fire") <= F.col("_latest"))
        .groupBy("cusip")
        .agg(F.max("fire").alias("_over"))
    )
    since = events.join(over, "cusip", "left")
    return since.where(F.col("_over").isNull() | (F.col("timestamp") >= F.col("_over"))).drop("_over")


def price_timer_conflation(
    events: DataFrame,
    slot: Sequence[str] = ("account", "subAccount"),
    fields: Sequence[str] = ("quantity", "orderId"),
    period_ms: int = PERIOD_MS,
    span_ms: int = SPAN_MS,
    fires: DataFrame | None = None,
) -> DataFrame:
    """Value the latest position of every slot at each fire of its security.

    ``fires`` takes fire times already worked out from the same price rows.
    """
    is_price = F.col("kind") == "price"
    rows = events.select("cusip", "ord", "timestamp", "kind", "price", *slot, *fields)
    if fires is None:
        fires = fire_times(rows.where(is_price), period_ms, span_ms)
    timed = assign_fires(rows, fires, period_ms)
    order = F.struct("timestamp", "ord")
    held = (
        timed.where(F.col("kind") == "position")
        .groupBy("cusip", "fire", *slot)
        .agg(F.max_by(F.struct(*fields), order).alias("held"))
    )
    quoted = timed.where(is_price).groupBy("cusip", "fire").agg(F.max_by("price", order).alias("price"))
    return held.join(quoted, ["cusip", "fire"]).select(
        "cusip",
        *slot,
        *[F.col(f"held.{f}").alias(f) for f in fields],
        "price",
        market_value("held.quantity", "price").alias("marketValue"),
        F.col("fire").alias("timestamp"),
        event_time("fire").alias("ts"),
    )
