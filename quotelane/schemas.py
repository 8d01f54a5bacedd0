"""Record schemas, in wire field order."""

from __future__ import annotations

ALLOCATION = "STRUCT<account: STRING, subAccount: STRING, quantity: INT>"

PRICE = "timestamp BIGINT, id STRING, cusip STRING, price DECIMAL(38,18), effectiveDateTime BIGINT"

POSITION = (
    "timestamp BIGINT, account STRING, subAccount STRING, cusip STRING, quantity INT, "
    "price DOUBLE, marketValue DOUBLE, orderId STRING"
)

SYMBOL_POSITION = "timestamp BIGINT, cusip STRING, quantity INT, price DOUBLE, marketValue DOUBLE"

ORDER = (
    "timestamp BIGINT, orderId STRING, cusip STRING, assetType STRING, buySell STRING, "
    "bidOffer DECIMAL(38,18), currency STRING, quantity INT, orderTime BIGINT, "
    f"allocations ARRAY<{ALLOCATION}>"
)

COMPLIANCE = "timestamp BIGINT, orderId STRING, success BOOLEAN, errors ARRAY<STRING>"

CUSIP_ALLOCATIONS = f"f0 STRING, f1 ARRAY<{ALLOCATION}>"

TBILL = "date DATE, daily DOUBLE, monthly DOUBLE, other DOUBLE"

# Frame shape of a message topic.
MESSAGE = (
    "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"
)

# Numeric fields that hold zero, not null, when a message leaves them out.
ZERO_WHEN_ABSENT = {
    "timestamp": 0,
    "effectiveDateTime": 0,
    "orderTime": 0,
    "quantity": 0,
    "price": 0.0,
    "marketValue": 0.0,
    "success": False,
}
