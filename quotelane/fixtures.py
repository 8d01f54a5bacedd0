"""Desk views over the given tables; see FIXTURES.md section 3."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelane.functions import event_time
from quotelane.sources.files import spread

START_MS = 1_704_067_200_000  # 2024-01-01 UTC
STEP_MS = 250
CUSIPS = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ticks_from(events: DataFrame, cusips: int | None = CUSIPS) -> DataFrame:
    """Prices and positions in arrival order ``ord``; works on static and streaming frames.

    ``cusips=None`` gives every user a security of their own.
    """
    is_price = F.col("event_type") == "purchase"
    security = F.col("user_id") % cusips if cusips else F.col("user_id")
    stamp = F.lit(START_MS) + F.col("event_id") * STEP_MS
    return events.select(
        F.col("event_id").alias("ord"),
        stamp.alias("timestamp"),
        event_time(stamp).alias("ts"),
        F.when(is_price, "price").otherwise("position").alias("kind"),
        F.concat(F.lit("Cusip"), security).alias("cusip"),
        F.concat(F.lit("ACC"), F.col("user_id") % 3).alias("account"),
        F.concat(F.lit("S"), F.col("event_id") % 2).alias("subAccount"),
        F.when(~is_price, F.floor(F.col("value") * 10).cast("int")).alias("quantity"),
        F.when(is_price, F.col("value")).alias("price"),
        F.col("event_id").cast("string").alias("orderId"),
    )


def ticks(spark: SparkSession, sf_dir: str, cusips: int | None = CUSIPS) -> DataFrame:
    return ticks_from(table(spark, sf_dir, "events"), cusips)


def symbol_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks(spark, sf_dir).drop("account", "subAccount", "orderId")


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the position rows, without the price column."""
    return ticks(spark, sf_dir).where(F.col("kind") == "position").drop("kind", "price")


def late_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions in a shuffled arrival order over four source partitions."""
    scrambled = (F.col("ord") * 7919) % 10007
    return positions(spark, sf_dir).select(
        "*",
        # one integer that orders like (scrambled, ord)
        (F.shiftleft(scrambled, 40) + F.col("ord")).alias("arrival"),
        (F.col("timestamp") + (F.col("ord") % 11) * 1000).alias("arrivalTimestamp"),
        (F.col("ord") % 4).cast("int").alias("sourcePartition"),
    )


def block_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested block orders, one message each.

    The lines of an order are nested by one aggregation on the order key; the join with orders on
    that same key reuses its partitioning.
    """
    lines = spread(table(spark, sf_dir, "lineitem")).select(
        "l_orderkey", "l_suppkey", "l_linenumber", F.col("l_quantity").cast("int").alias("quantity")
    )
    nested = lines.groupBy("l_orderkey").agg(
        F.sum("quantity").cast("int").alias("quantity"),
        F.sort_array(
            F.collect_list(
                F.struct(
                    F.concat(F.lit("ACC"), F.col("l_suppkey") % 3).alias("account"),
                    F.concat(F.lit("S"), F.col("l_linenumber") % 2).alias("subAccount"),
                    F.col("quantity"),
                )
            )
        ).alias("allocations"),
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    stamp = F.lit(START_MS) + F.col("o_orderkey") * STEP_MS
    return nested.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        stamp.alias("timestamp"),
        F.col("o_orderkey").cast("string").alias("orderId"),
        F.concat(F.lit("Cusip"), F.col("o_orderkey") % CUSIPS).alias("cusip"),
        F.lit("Bond").alias("assetType"),
        F.when(F.col("o_orderstatus") == "F", "SELL").otherwise("BUY").alias("buySell"),
        F.lit(None).cast("decimal(38,18)").alias("bidOffer"),
        F.lit(None).cast("string").alias("currency"),
        "quantity",
        stamp.alias("orderTime"),
        "allocations",
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_from(spread(table(spark, sf_dir, "documents").select("doc_id", "text")))


def lines_from(documents: DataFrame) -> DataFrame:
    """Whole document texts, one second apart."""
    stamp = F.lit(START_MS) + F.col("doc_id") * 1000
    return documents.select("doc_id", event_time(stamp).alias("ts"), "text")
