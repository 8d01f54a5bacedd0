"""Row-wise operators: order split, enrichment, compliance, words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelane.functions import market_value, signed_quantity, token_words, whitespace_words


def split_orders(orders: DataFrame, keep_time: bool = True) -> DataFrame:
    """One signed position per allocation; the order id is not passed on.

    An order without allocations gives none. ``keep_time=False`` is the whole-window form, whose
    positions have no time (0); being row-wise it needs no single task to gather the window.
    """
    stamp = F.col("timestamp") if keep_time else F.lit(0).cast("bigint")
    # of a plain explode Spark infers a filter on the array, for which a message would be parsed a second time
    each = orders.select(stamp.alias("timestamp"), "cusip", "buySell", F.posexplode_outer("allocations").alias("_at", "a"))
    return each.where(F.col("_at").isNotNull()).select(
        "timestamp",
        F.col("a.account").alias("account"),
        F.col("a.subAccount").alias("subAccount"),
        "cusip",
        signed_quantity("buySell", "a.quantity").alias("quantity"),
    )


def enrich_with_price(positions: DataFrame, price: Column, at: Column | None = None) -> DataFrame:
    """Set the price, narrowed to double, and optionally the time of pricing."""
    out = positions.withColumn("price", price.cast("double"))
    return out if at is None else out.withColumn("timestamp", at)


def enrich_with_value(positions: DataFrame, price: Column, at: Column | None = None) -> DataFrame:
    """Set price and market value."""
    return enrich_with_price(positions, price, at).withColumn(
        "marketValue", market_value("quantity", "price")
    )


def compliance_results(positions: DataFrame) -> DataFrame:
    """A passing result per position, with no errors."""
    return positions.select(
        "timestamp",
        "orderId",
        F.lit(True).alias("success"),
        F.lit(None).cast("array<string>").alias("errors"),
    )


def split_words(lines: DataFrame, text: str = "text") -> DataFrame:
    return lines.withColumn("word", F.explode(whitespace_words(text))).drop(text)


def split_tokens(lines: DataFrame, text: str = "text") -> DataFrame:
    return lines.withColumn("word", F.explode(token_words(text))).drop(text)
