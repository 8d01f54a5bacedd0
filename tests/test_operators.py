"""Row-wise operators, windows, words, lateness and fixtures on small inputs worked out by hand."""

import re

import pytest
from pyspark.sql import functions as F

from quotelane import fixtures, schemas
from quotelane.functions import event_time, signed_quantity, token_words, whitespace_words
from quotelane.operators import lateness, projection, windows
from quotelane.operators.scan import Running, running
from quotelane.plans import desk

ORDERS = [
    (1, "1", "X", "Bond", "BUY", None, None, 60, 0, [("A", "S", 10), ("A", "S", 20), ("B", "T", 30)]),
    (2, "2", "X", "Bond", "SELL", None, None, 5, 0, [("A", "S", 5)]),
    (3, "3", "Y", "Bond", None, None, None, 7, 0, [("B", "T", 7)]),
    (4, "4", "Y", "Bond", "BUY", None, None, 0, 0, []),
    (5, "5", "Y", "Bond", "BUY", None, None, 0, 0, None),
]


@pytest.fixture(scope="module")
def orders(spark):
    return spark.createDataFrame(ORDERS, schemas.ORDER)


def _rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_split_signs_by_side_and_drops_orders_without_allocations(orders):
    got = _rows(projection.split_orders(orders), "timestamp", "account", "cusip", "quantity")
    assert got == [
        (1, "A", "X", 10),
        (1, "A", "X", 20),
        (1, "B", "X", 30),
        (2, "A", "X", -5),
        (3, "B", "Y", -7),
    ]
    assert "orderId" not in projection.split_orders(orders).columns


def test_split_without_time(orders):
    assert {r.timestamp for r in projection.split_orders(orders, keep_time=False).collect()} == {0}


def test_net_positions(orders):
    got = _rows(desk.account_positions(orders), "account", "subAccount", "cusip", "quantity")
    assert got == [("A", "S", "X", 25), ("B", "T", "X", 30), ("B", "T", "Y", -7)]


def test_signed_quantity_of_an_absent_side(spark):
    df = spark.createDataFrame([("BUY", 1), ("SELL", 1), (None, 1)], "s STRING, q INT")
    assert [r[0] for r in df.select(signed_quantity("s", "q")).collect()] == [1, -1, -1]


def test_enrichment_leaves_value_alone_unless_asked(spark):
    df = spark.createDataFrame([(3, 0.0)], "quantity INT, marketValue DOUBLE")
    price = F.lit("2.5").cast("decimal(38,18)")
    assert projection.enrich_with_price(df, price).first().asDict() == {
        "quantity": 3, "marketValue": 0.0, "price": 2.5,
    }
    row = projection.enrich_with_value(df, price, F.lit(9)).first()
    assert (row.price, row.marketValue, row.timestamp) == (2.5, 7.5, 9)


# Valuations as printed by a run of the desk: quantity, price, market value.
LOGGED = [
    (105385719, 6.918014557180783, 7.290599381609634e8),
    (100368204, 6.918014557180783, 6.943486963500905e8),
    (106188665, 6.918014557180783, 7.346147302775935e8),
]


def test_value_equals_logged_valuations(spark):
    df = spark.createDataFrame(LOGGED, "quantity INT, quote DOUBLE, expected DOUBLE")
    out = projection.enrich_with_value(df, F.col("quote"))
    assert all(r.marketValue == r.expected for r in out.collect())


def _java_like_split(text):
    pieces = re.split(r"[ \t\n\x0b\f\r]", text)
    if len(pieces) > 1:
        while pieces and pieces[-1] == "":
            pieces.pop()
    return pieces


@pytest.mark.parametrize(
    "text", ["", " ", "  \t", "a", " a", "a ", "  a  b \n", "a\tb\nc", "a b", "\x0ba\x0b", "a \u0085"]
)
def test_whitespace_words(spark, text):
    got = spark.createDataFrame([(text,)], "t STRING").select(whitespace_words("t")).first()[0]
    assert got == _java_like_split(text)


def test_token_words(spark):
    df = spark.createDataFrame([("Hello, world! a_1 é x",), ("...",), ("",)], "t STRING")
    assert [r[0] for r in df.select(token_words("t")).collect()] == [["hello", "world", "a_1", "x"], [], []]


def _positions(spark, rows):
    """(ord, ms, account, cusip, quantity)"""
    return spark.createDataFrame(rows, "ord BIGINT, timestamp BIGINT, account STRING, cusip STRING, quantity INT").select(
        "*", F.lit("S").alias("subAccount"), F.col("ord").cast("string").alias("orderId"),
        event_time("timestamp").alias("ts"),
    )


@pytest.fixture(scope="module")
def positions(spark):
    return _positions(
        spark,
        [(1, 0, "A", "X", 5), (2, 9_999, "A", "X", 6), (3, 10_000, "A", "X", 7), (4, 10_000, "B", "X", -7), (5, 20_000, "B", "Y", 2**31 - 1), (6, 20_001, "B", "Y", 1)],
    )


def test_window_sum_keeps_the_first_row_and_does_not_wrap(positions):
    got = _rows(windows.sum_in_window(positions), "windowStart", "account", "quantity", "orderId", "timestamp")
    assert got == [
        (0, "A", 11, "1", 0),
        (10_000, "A", 7, "3", 10_000),
        (10_000, "B", -7, "4", 10_000),
        (20_000, "B", 2**31, "5", 20_000),
    ]


def test_symbol_roll_up(positions):
    got = _rows(desk.rolled_up_quantity(positions), "windowStart", "cusip", "quantity", "timestamp")
    assert got == [(0, "X", 11, 10_000), (10_000, "X", 0, 20_000), (20_000, "Y", 2**31, 30_000)]


def test_last_value_in_window(spark, positions):
    priced = positions.withColumn("price", F.lit(2.0))
    got = _rows(
        windows.last_value_in_window(priced, ["cusip"], ("orderId",), "1 minute"),
        "cusip", "quantity", "marketValue", "orderId", "timestamp",
    )
    assert got == [("X", -7, -14.0, "4", 60_000), ("Y", 1, 2.0, "6", 60_000)]


def test_allocation_lists_are_whole(spark):
    rows = [(i, i, f"A{i}", "X", i) for i in range(21)] + [(100, 5, "B", "Y", 1)]
    got = {r.cusip: [a.account for a in r.allocations] for r in windows.cusip_allocations(_positions(spark, rows)).collect()}
    assert got == {"X": [f"A{i}" for i in range(21)], "Y": ["B"]}


@pytest.mark.parametrize("segment_rows", [1, 3, 1 << 20])
@pytest.mark.parametrize("backward", [False, True])
@pytest.mark.parametrize("inclusive", [False, True])
def test_running_values(spark, segment_rows, backward, inclusive):
    values = [3, None, -1, 7, None, 2, 2, None]
    df = spark.createDataFrame([("k", i - 3, v) for i, v in enumerate(values)], "k STRING, n BIGINT, v INT")
    v = F.col("v")
    out = running(
        df, ["k"], "n",
        [Running("s", "sum", v), Running("m", "max", v), Running("l", "last", v)],
        inclusive=inclusive, backward=backward, segment_rows=segment_rows,
    )
    got = [(r.s, r.m, r.l) for r in out.orderBy("n").collect()]
    seq = values[::-1] if backward else values
    want = []
    for i in range(len(seq)):
        seen = [x for x in seq[: i + inclusive] if x is not None]
        want.append((sum(seen), max(seen), seen[-1]) if seen else (None, None, None))
    assert got == (want[::-1] if backward else want)


def test_late_rows(spark):
    df = spark.createDataFrame(
        [(0, 1, 5_000), (0, 2, 12_000), (0, 3, 9_000), (0, 4, 10_000), (1, 5, 1_000)],
        "sourcePartition INT, arrival BIGINT, timestamp BIGINT",
    )
    out = lateness.late_by_running_max(df, 10_000, segment_rows=1)
    assert _rows(out, "arrival", "watermark", "isLate") == [
        (1, None, False), (2, 5_000, False), (3, 12_000, True), (4, 12_000, False), (5, None, False),
    ]


def test_slack_spares_the_last_millisecond(spark):
    df = spark.createDataFrame(
        [(0, 1, 9_999), (0, 2, 9_998)], "sourcePartition INT, arrival BIGINT, timestamp BIGINT"
    )
    for slack, late in ((0, True), (1, False)):
        out = lateness.late_by_running_max(df, 10_000, slack)
        assert out.where("arrival = 2").first().isLate is late


def test_late_by_clock(spark):
    df = spark.createDataFrame([(1_000, 14_998), (1_000, 14_999)], "timestamp BIGINT, arrivalTimestamp BIGINT")
    assert _rows(lateness.late_by_time_lag(df, 10_000), "arrivalTimestamp", "isLate") == [
        (14_998, False), (14_999, True),
    ]

