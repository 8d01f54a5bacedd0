"""The desk's legs as batch plans: pair with prices, then value the last position per window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelane.operators import windows
from quotelane.operators.pricing import ACCOUNT_FIELDS, SYMBOL_FIELDS, price_single_slot
from quotelane.operators.projection import split_orders


def account_leg(events: DataFrame, width: str = "1 minute", segment_rows: int | None = None) -> DataFrame:
    """Market value by account, sub-account and security."""
    priced = price_single_slot(events, ACCOUNT_FIELDS, segment_rows)
    return windows.last_value_in_window(priced, windows.ACCOUNT_KEY, ("orderId",), width)


def symbol_leg(events: DataFrame, width: str = "1 minute", segment_rows: int | None = None) -> DataFrame:
    """Market value by security."""
    priced = price_single_slot(events, SYMBOL_FIELDS, segment_rows)
    return windows.last_value_in_window(priced, windows.SYMBOL_KEY, (), width)


def account_positions(orders: DataFrame) -> DataFrame:
    """Block orders to net quantity per account, sub-account and security."""
    return split_orders(orders).groupBy(*windows.ACCOUNT_KEY).agg(F.sum("quantity").alias("quantity"))


def rolled_up_quantity(positions: DataFrame, width: str = "10 seconds") -> DataFrame:
    """Window sums by account, rolled up by security in the same windows."""
    return windows.symbol_quantity(windows.sum_in_window(positions, width=width), width, "window")


def rolled_up_allocations(positions: DataFrame, width: str = "10 seconds") -> DataFrame:
    """Window sums by account, listed by security in the same windows."""
    return windows.cusip_allocations(
        windows.sum_in_window(positions, width=width), width, "window"
    )
