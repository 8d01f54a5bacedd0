"""JSON messages to rows and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quotelane import schemas

_BROKEN = "_broken"


def _parsed(messages: DataFrame, schema: str) -> tuple[DataFrame, StructType]:
    fields = StructType.fromDDL(schema)
    text = F.col("value").cast("string")
    parsed = F.from_json(text, f"{schema}, {_BROKEN} STRING", {"columnNameOfCorruptRecord": _BROKEN})
    return messages.withColumn("_m", parsed), fields


def _fields(fields: StructType) -> list[Column]:
    out = []
    for f in fields:
        value = F.col(f"_m.{f.name}")
        # arbitrary-precision decimals stay null when absent, machine numbers are zero
        if f.name in schemas.ZERO_WHEN_ABSENT and not f.dataType.simpleString().startswith("decimal"):
            value = F.coalesce(value, F.lit(schemas.ZERO_WHEN_ABSENT[f.name]).cast(f.dataType))
        out.append(value.alias(f.name))
    return out


def decode(messages: DataFrame, schema: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """Rows of the messages in ``value``; a malformed or absent message fails the query.

    Unknown fields are ignored. ``extra`` names message columns to keep, such as ``offset``.
    """
    fields = StructType.fromDDL(schema)
    parsed = F.from_json(F.col("value").cast("string"), schema, {"mode": "FAILFAST"})
    whole = F.coalesce(parsed, F.raise_error(F.lit("a message has no value")).cast(fields))
    return messages.withColumn("_m", whole).select(*_fields(fields), *extra)


def broken(schema: str) -> Column:
    """Whether a message holds no record of the schema: absent, or malformed."""
    text = F.col("value").cast("string")
    parsed = F.from_json(text, f"{schema}, {_BROKEN} STRING", {"columnNameOfCorruptRecord": _BROKEN})
    return parsed.isNull() | parsed[_BROKEN].isNotNull()


def decode_split(messages: DataFrame, schema: str) -> tuple[DataFrame, DataFrame]:
    """The rows of well-formed messages, and the malformed messages as they came."""
    parsed, fields = _parsed(messages, schema)
    broken = F.col("_m").isNull() | F.col(f"_m.{_BROKEN}").isNotNull()
    return parsed.where(~broken).select(*_fields(fields)), parsed.where(broken).drop("_m")


def encode(
    rows: DataFrame, schema: str, topic: str | None = None, key: str | Column | None = None
) -> DataFrame:
    """Messages with a JSON object in ``value``, nulls written, fields in the schema's order.

    Without ``key`` the frame has no key column, without ``topic`` no topic column.
    """
    names = [f.name for f in StructType.fromDDL(schema)]
    value = F.to_json(F.struct(*names), {"ignoreNullFields": "false"}).cast("binary").alias("value")
    columns = [value]
    if key is not None:
        key = F.col(key) if isinstance(key, str) else key
        columns.insert(0, key.cast("string").cast("binary").alias("key"))
    if topic is not None:
        columns.append(F.lit(topic).alias("topic"))
    return rows.select(*columns)


def decode_prices(messages: DataFrame) -> DataFrame:
    return decode(messages, schemas.PRICE)


def decode_positions(messages: DataFrame) -> DataFrame:
    return decode(messages, schemas.POSITION)


def decode_symbol_positions(messages: DataFrame) -> DataFrame:
    return decode(messages, schemas.SYMBOL_POSITION)


def decode_orders(messages: DataFrame) -> DataFrame:
    """Orders, from full messages or from frames that hold only ``value``."""
    return decode(messages, schemas.ORDER)


def encode_prices(prices: DataFrame, topic: str = "price") -> DataFrame:
    """Prices carry the empty key."""
    return encode(prices, schemas.PRICE, topic, F.lit(""))


def encode_positions(positions: DataFrame, topic: str = "mvByAct") -> DataFrame:
    return encode(positions, schemas.POSITION, topic, "account")


def encode_symbol_positions(positions: DataFrame, topic: str = "mvBySymbol") -> DataFrame:
    return encode(positions, schemas.SYMBOL_POSITION, topic, "cusip")


def encode_cusip_allocations(lists: DataFrame, topic: str = "positionsByCusip") -> DataFrame:
    """From ``cusip`` and ``allocations`` columns."""
    pair = lists.select(F.col("cusip").alias("f0"), F.col("allocations").alias("f1"))
    return encode(pair, schemas.CUSIP_ALLOCATIONS, topic, "f0")


def encode_compliance(results: DataFrame, topic: str = "out") -> DataFrame:
    return encode(results, schemas.COMPLIANCE, topic, "orderId")


def encode_orders(
    orders: DataFrame, topic: str | None = None, key: str | Column | None = "orderId"
) -> DataFrame:
    """``key=None`` gives the value-only form."""
    return encode(orders, schemas.ORDER, topic, key)
