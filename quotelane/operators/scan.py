"""Ordered running values over keys of any size.

A window over ``partitionBy(key)`` sorts all rows of a key in one task. Here a key is cut into
segments of consecutive arrival numbers. Arrival numbers are unique integers within a key, so a
segment of ``segment_rows`` numbers (rounded up to a power of two) never holds more than that many
rows, however skewed the key; where numbers are far apart, ``numbering.numbered`` makes dense ones
first, or else there would be a segment for every few rows. Each segment is scanned alone, a one-row summary per segment is scanned over the key,
and what enters a segment is joined back on (key, segment). The join reuses the partitioning and
order of the segment scan, so the rows are shuffled once.

Rows without a key or arrival number take no part: keyed operators have no place for them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEGMENT_ROWS = 1 << 20
SEGMENT_SETTING = "spark.quotelane.segmentRows"


def segment_rows_of(df: DataFrame, segment_rows: int | None) -> int:
    """The given size, else the session's setting, else the default."""
    if segment_rows is None:
        segment_rows = int(df.sparkSession.conf.get(SEGMENT_SETTING, str(SEGMENT_ROWS)))
    if segment_rows < 1:
        raise ValueError("segment_rows must be positive")
    return segment_rows


def with_segments(
    df: DataFrame, keys: Sequence[str], order: str, segment_rows: int | None
) -> DataFrame:
    bits = (segment_rows_of(df, segment_rows) - 1).bit_length()
    cut = df.withColumn("_seg", F.shiftright(F.col(order).cast("bigint"), bits))
    present = F.col(order).isNotNull() & F.col("_seg").isNotNull()
    for key in keys:
        present = present & F.col(key).isNotNull()
    # a join on the segment would add its null test to one side only and so part the two exchanges
    return cut.where(present)


@dataclass(frozen=True)
class Running:
    """One running value: ``kind`` is sum, max or last (nulls skipped) of ``value``."""

    name: str
    kind: str
    value: Column

    def over(self, window) -> Column:
        if self.kind == "sum":
            return F.sum(self.value).over(window)
        if self.kind == "max":
            return F.max(self.value).over(window)
        return F.last(self.value, ignorenulls=True).over(window)

    def of_segment(self, order: Column) -> Column:
        if self.kind == "sum":
            return F.sum(self.value)
        if self.kind == "max":
            return F.max(self.value)
        # order is reversed by the caller for a backward scan
        return F.max_by(self.value, F.when(self.value.isNotNull(), order))

    def carried(self, column: str, window) -> Column:
        return Running(self.name, self.kind, F.col(column)).over(window)

    def joined(self, local: Column, carry: Column) -> Column:
        if self.kind == "sum":
            return F.when(local.isNull(), carry).when(carry.isNull(), local).otherwise(local + carry)
        if self.kind == "max":
            return F.greatest(local, carry)
        return F.coalesce(local, carry)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    values: Sequence[Running],
    *,
    inclusive: bool = True,
    backward: bool = False,
    segment_rows: int | None = None,
) -> DataFrame:
    """Add running values along ``order`` within ``keys``.

    ``inclusive=False`` leaves the current row out; ``backward=True`` runs from the last row to
    the first, so that ``last`` gives the next value after a row.
    """
    keys = list(keys)
    cut = with_segments(df, keys, order, segment_rows)
    along = F.col(order).desc() if backward else F.col(order)
    along_segments = F.col("_seg").desc() if backward else F.col("_seg")
    rank = -F.col(order) if backward else F.col(order)
    upto = 0 if inclusive else -1

    in_segment = (
        Window.partitionBy(*keys, "_seg").orderBy(along).rowsBetween(Window.unboundedPreceding, upto)
    )
    before = Window.partitionBy(*keys).orderBy(along_segments).rowsBetween(Window.unboundedPreceding, -1)

    local = cut
    for v in values:
        local = local.withColumn(f"_local_{v.name}", v.over(in_segment))
    summary = cut.groupBy(*keys, "_seg").agg(
        *[v.of_segment(rank).alias(f"_part_{v.name}") for v in values]
    )
    carry = summary.select(
        *keys, "_seg", *[v.carried(f"_part_{v.name}", before).alias(f"_carry_{v.name}") for v in values]
    )
    joined = local.join(carry, [*keys, "_seg"])
    return joined.select(
        *df.columns,
        *[v.joined(F.col(f"_local_{v.name}"), F.col(f"_carry_{v.name}")).alias(v.name) for v in values],
    )
