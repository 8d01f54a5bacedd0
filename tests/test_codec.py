import json

import pytest
from pyspark.sql import functions as F

from quotelane import schemas
from quotelane.operators import codec, projection


def _messages(spark, *values, key=None):
    rows = [(key, v) for v in values]
    return spark.createDataFrame(rows, "key STRING, value STRING").select(
        F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value")
    )


def _json(df):
    return [json.loads(bytes(r.value)) for r in df.collect()]


def test_decode_price_keeps_all_digits(spark):
    text = '{"timestamp":5,"id":"p","cusip":"C","price":6.918014557180783,"effectiveDateTime":7}'
    row = codec.decode_prices(_messages(spark, text)).first()
    assert (row.timestamp, row.id, row.cusip, row.effectiveDateTime) == (5, "p", "C", 7)
    assert str(row.price) == "6.918014557180783000"


def test_absent_numbers_are_zero_and_unknown_fields_ignored(spark):
    row = codec.decode_positions(_messages(spark, '{"account":"A","surprise":[1,2],"price":null}')).first()
    assert row.asDict() == {
        "timestamp": 0,
        "account": "A",
        "subAccount": None,
        "cusip": None,
        "quantity": 0,
        "price": 0.0,
        "marketValue": 0.0,
        "orderId": None,
    }


def test_absent_decimal_is_null(spark):
    assert codec.decode_prices(_messages(spark, '{"cusip":"C"}')).first().price is None


@pytest.mark.parametrize("text", ['{"cusip":', "garbage", '{"cusip":"C","quantity":"many"}'])
def test_malformed_message_fails_the_strict_decoder(spark, text):
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        codec.decode_symbol_positions(_messages(spark, text)).collect()


def test_malformed_messages_are_set_aside(spark):
    values = ['{"cusip":"C","quantity":3}', '{"cusip":', "garbage"]
    good, dead = codec.decode_split(_messages(spark, *values, key="k"), schemas.SYMBOL_POSITION)
    assert [(r.cusip, r.quantity) for r in good.collect()] == [("C", 3)]
    assert sorted(bytes(r.value).decode() for r in dead.collect()) == sorted(values[1:])
    assert {bytes(r.key) for r in dead.collect()} == {b"k"}


def test_encode_writes_nulls_and_starts_with_the_time(spark):
    row = spark.createDataFrame([(9, "A", None, "C", 2, 1.5, 3.0, None)], schemas.POSITION)
    out = codec.encode_positions(row, "t").first()
    assert (bytes(out.key), out.topic) == (b"A", "t")
    assert bytes(out.value).decode() == (
        '{"timestamp":9,"account":"A","subAccount":null,"cusip":"C","quantity":2,'
        '"price":1.5,"marketValue":3.0,"orderId":null}'
    )


def test_round_trips(spark):
    position = spark.createDataFrame([(9, "A", "S", "C", 2, 1.5, 3.0, "o")], schemas.POSITION)
    assert codec.decode_positions(codec.encode_positions(position)).first() == position.first()
    symbol = position.select("timestamp", "cusip", "quantity", "price", "marketValue")
    assert codec.decode_symbol_positions(codec.encode_symbol_positions(symbol)).first() == symbol.first()
    order = spark.createDataFrame(
        [(1, "o", "C", "Bond", "SELL", None, None, 7, 0, [("A", "S", 3), ("B", "S", 4)])], schemas.ORDER
    )
    for messages in (codec.encode_orders(order, "t"), codec.encode_orders(order, key=None)):
        assert codec.decode_orders(messages).first() == order.first()


def test_order_messages_with_and_without_key(spark):
    order = spark.createDataFrame([(1, "o", "C", "Bond", "BUY", None, None, 0, 0, [])], schemas.ORDER)
    assert codec.encode_orders(order, "t").columns == ["key", "value", "topic"]
    assert codec.encode_orders(order).columns == ["key", "value"]
    assert codec.encode_orders(order, key=None).columns == ["value"]
    assert bytes(codec.encode_orders(order, key=F.lit("other")).first().key) == b"other"


def test_prices_carry_the_empty_key(spark):
    price = spark.createDataFrame([(1, "p", "C", None, 2)], schemas.PRICE)
    assert bytes(codec.encode_prices(price).first().key) == b""


def test_cusip_allocations_are_a_pair(spark):
    lists = spark.createDataFrame([("C", [("A", "S", 1)])], f"cusip STRING, allocations ARRAY<{schemas.ALLOCATION}>")
    out = codec.encode_cusip_allocations(lists)
    assert bytes(out.first().key) == b"C"
    assert _json(out) == [{"f0": "C", "f1": [{"account": "A", "subAccount": "S", "quantity": 1}]}]


def test_compliance_message(spark):
    position = spark.createDataFrame([(4, "o")], "timestamp BIGINT, orderId STRING")
    out = codec.encode_compliance(projection.compliance_results(position))
    assert bytes(out.first().key) == b"o"
    assert _json(out) == [{"timestamp": 4, "orderId": "o", "success": True, "errors": None}]
