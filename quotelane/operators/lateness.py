"""Watermarks and late rows, for replaying a log in its arrival order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelane.operators.numbering import numbered
from quotelane.operators.scan import Running, running


def _flag(df: DataFrame, watermark: Column, width_ms: int) -> DataFrame:
    """A row is late when the last instant of its window is not after the watermark it met."""
    end = F.col("timestamp") - F.col("timestamp") % width_ms + width_ms
    return (
        df.withColumn("watermark", watermark)
        .withColumn("windowEnd", end)
        .withColumn("isLate", F.coalesce(F.col("windowEnd") - 1 <= F.col("watermark"), F.lit(False)))
    )


def late_by_punctuation(
    df: DataFrame,
    marks: Column | None = None,
    width_ms: int = 60_000,
    source: str = "sourcePartition",
    arrival: str = "arrival",
    segment_rows: int | None = None,
) -> DataFrame:
    """The watermark moves at the rows that carry a mark (``marks``; without it, all do), to their time.

    A row sees the marks before it; one that would go back is ignored.
    """
    marked = df.withColumn("_mark", F.col("timestamp") if marks is None else F.when(marks, F.col("timestamp")))
    seen = running(
        numbered(marked, [F.col(arrival)], "_number"),
        [source],
        "_number",
        [Running("_seen", "max", F.col("_mark"))],
        inclusive=False,
        segment_rows=segment_rows,
    )
    return _flag(seen, F.col("_seen"), width_ms).drop("_seen", "_number", "_mark")


def late_by_running_max(
    df: DataFrame,
    width_ms: int = 60_000,
    slack_ms: int = 0,
    source: str = "sourcePartition",
    arrival: str = "arrival",
    segment_rows: int | None = None,
) -> DataFrame:
    """The watermark is the latest time a source has shown, less ``slack_ms``.

    Slack 0 is the periodic rule, slack 1 the rule for ascending times, which allows for further rows of
    the latest millisecond.
    """
    # arrival numbers may be far apart; segments of dense ones are full
    seen = running(
        numbered(df, [F.col(arrival)], "_number"),
        [source],
        "_number",
        [Running("_seen", "max", F.col("timestamp"))],
        inclusive=False,
        segment_rows=segment_rows,
    )
    return _flag(seen, F.col("_seen") - slack_ms, width_ms).drop("_seen", "_number")


def late_by_time_lag(
    df: DataFrame, width_ms: int = 60_000, lag_ms: int = 5_000, clock: str = "arrivalTimestamp"
) -> DataFrame:
    """The watermark is the clock at arrival less ``lag_ms``; no other row matters."""
    return _flag(df, F.col(clock) - lag_ms, width_ms)
