"""Pricing against the plain-Python machines, on random cases and with tiny segments."""

import pytest
from pyspark.sql import functions as F

from quotelane.functions import event_time
from quotelane.operators import conflation, pricing, windows
from tests import machines

SCHEMA = (
    "cusip STRING, ord BIGINT, timestamp BIGINT, kind STRING, account STRING, quantity INT, price DOUBLE"
)
FIELDS = ("account", "quantity")
SEGMENTS = [1, 2, 8, 1 << 20]


@pytest.fixture(scope="module")
def rows():
    return machines.random_rows(seed=11, cases=150, longest=25)


@pytest.fixture(scope="module")
def events(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("ts", event_time("timestamp")).cache()


def _rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


@pytest.mark.parametrize("segment_rows", SEGMENTS)
def test_single_slot(events, rows, segment_rows):
    priced = pricing.price_single_slot(events, FIELDS, segment_rows)
    assert _rows(priced, "cusip", "account", "quantity", "price", "ord") == machines.single_slot(rows)


@pytest.mark.parametrize("price_share", [0.05, 0.9])
def test_single_slot_with_rare_and_frequent_prices(spark, price_share):
    rows = machines.random_rows(seed=3, cases=60, longest=20, price_share=price_share)
    priced = pricing.price_single_slot(spark.createDataFrame(rows, SCHEMA), FIELDS, 4)
    assert _rows(priced, "cusip", "account", "quantity", "price", "ord") == machines.single_slot(rows)


def test_single_slot_price_on_position_rows_is_ignored(spark):
    rows = [("C", 1, 0, "position", "A", 5, 0.0), ("C", 2, 1, "price", None, None, 2.0)]
    priced = pricing.price_single_slot(spark.createDataFrame(rows, SCHEMA), FIELDS)
    assert _rows(priced, "account", "quantity", "price", "ord") == [("A", 5, 2.0, 2)]


def test_slot_state_restores_the_machine(spark, events, rows):
    cut = sorted(r[1] for r in rows)[len(rows) // 2]
    state = pricing.slot_state(events.where(F.col("ord") <= cut), FIELDS, 4)
    resumed = state.unionByName(events.where(F.col("ord") > cut))
    priced = pricing.price_single_slot(resumed, FIELDS, 4)
    expected = [r for r in machines.single_slot(rows) if r[4] > cut]
    assert _rows(priced, "cusip", "account", "quantity", "price", "ord") == expected


@pytest.mark.parametrize("segment_rows", SEGMENTS)
def test_list_buffer(events, rows, segment_rows):
    priced = pricing.price_list_buffer(events, FIELDS, segment_rows)
    got = _rows(priced, "cusip", "account", "quantity", "price", "ord", "positionOrd")
    assert got == machines.list_buffer(rows)


@pytest.mark.parametrize(("period", "span"), [(5_000, 5_000), (7_000, 20_000), (60_000, 3_600_000)])
def test_timer_conflation(events, rows, period, span):
    priced = conflation.price_timer_conflation(events, ("account",), ("quantity",), period, span)
    got = _rows(priced, "cusip", "account", "quantity", "price", "timestamp")
    assert got == machines.timer_conflation(rows, period)


def test_timer_conflation_with_negative_times_and_gaps(spark):
    rows = [
        ("C", 1, -120_500, "position", "A", 1, None),
        ("C", 2, -120_400, "price", None, None, 1.0),
        ("C", 3, -60_400, "price", None, None, 2.0),  # at the instant of the fire: next interval
        ("C", 4, 900_000_000, "position", "B", 2, None),
        ("C", 5, 900_000_001, "price", None, None, 3.0),
        ("C", 6, 900_060_001, "position", "A", 3, None),  # after the last fire, never valued
    ]
    priced = conflation.price_timer_conflation(
        spark.createDataFrame(rows, SCHEMA), ("account",), ("quantity",)
    )
    got = _rows(priced, "cusip", "account", "quantity", "price", "timestamp")
    assert got == machines.timer_conflation(rows, 60_000)


def test_fires_of_dense_prices_across_spans(spark):
    """A price every 250 ms: a fire every period, over many spans."""
    prices = spark.range(4_000).select(
        F.lit("C").alias("cusip"), (F.col("id") * 250 + 100).alias("timestamp")
    )
    fires = sorted(r.fire for r in conflation.fire_times(prices, 60_000, 60_000).collect())
    assert fires == [100 + 60_000 * k for k in range(1, 18)]


@pytest.mark.parametrize("segment_rows", SEGMENTS)
def test_rolling_quantity(events, rows, segment_rows):
    positions = events.where(F.col("kind") == "position")
    summed = windows.rolling_quantity(positions, ["cusip"], segment_rows)
    assert _rows(summed, "cusip", "ord", "rollingQuantity") == machines.rolling(rows)


def test_tagged_sides(spark):
    positions = spark.createDataFrame(
        [(1, 0, "C", "A", "S", 5, "o")],
        "ord BIGINT, timestamp BIGINT, cusip STRING, account STRING, subAccount STRING, quantity INT, orderId STRING",
    )
    prices = spark.createDataFrame(
        [(2, 7, "C", 2)], "ord BIGINT, timestamp BIGINT, cusip STRING, price INT"
    ).withColumn("price", F.col("price").cast("decimal(38,18)"))
    priced = pricing.price_single_slot(pricing.tag_sides(positions, prices))
    assert _rows(priced, "account", "quantity", "price", "timestamp") == [("A", 5, 2.0, 7)]


def test_no_window_gathers_a_whole_security(spark, events):
    """Row windows are cut by segment; only the one-row-per-segment summaries span a security."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        priced = pricing.price_single_slot(events, FIELDS, 8)
        plan = priced._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "ReusedExchange" in plan
    assert "Exchange SinglePartition" not in plan
