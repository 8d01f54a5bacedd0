"""The queries of the catalog as plain SQL over the given tables."""

from __future__ import annotations

_START = 1704067200000

_TICK_COLUMNS = f"""event_id AS ord, {_START} + event_id * 250 AS "timestamp",
    CASE WHEN event_type = 'purchase' THEN 'price' ELSE 'position' END AS kind,
    'ACC' || (user_id % 3) AS account, 'S' || (event_id % 2) AS "subAccount",
    CASE WHEN event_type <> 'purchase' THEN CAST(floor(value * 10) AS INTEGER) END AS quantity,
    CASE WHEN event_type = 'purchase' THEN value END AS price,
    CAST(event_id AS VARCHAR) AS "orderId" """

_TICKS = f"ticks AS (SELECT 'Cusip' || (user_id % 8) AS cusip, {_TICK_COLUMNS} FROM events)"
_USER_TICKS = f"ticks AS (SELECT 'Cusip' || user_id AS cusip, {_TICK_COLUMNS} FROM events)"
_POSITIONS = f"{_TICKS}, positions AS (SELECT * FROM ticks WHERE kind = 'position')"

_LATE = f"""{_POSITIONS}, late AS (
    SELECT *, ((ord * 7919) % 10007) * 1099511627776 + ord AS arrival,
        "timestamp" + (ord % 11) * 1000 AS "arrivalTimestamp",
        CAST(ord % 4 AS INTEGER) AS "sourcePartition"
    FROM positions)"""

_ORDERS = f"""alloc AS (
    SELECT l_orderkey, 'ACC' || (l_suppkey % 3) AS account, 'S' || (l_linenumber % 2) AS sub,
        CAST(l_quantity AS INTEGER) AS q
    FROM lineitem),
nested AS (
    SELECT l_orderkey, CAST(sum(q) AS INTEGER) AS quantity,
        string_agg(account || '/' || sub || '/' || q, ',' ORDER BY account, sub, q) AS flat,
        string_agg('{{"account":"' || account || '","subAccount":"' || sub || '","quantity":' || q || '}}',
            ',' ORDER BY account, sub, q) AS json
    FROM alloc GROUP BY l_orderkey),
block_orders AS (
    SELECT {_START} + o_orderkey * 250 AS "timestamp", CAST(o_orderkey AS VARCHAR) AS "orderId",
        'Cusip' || (o_orderkey % 8) AS cusip,
        CASE WHEN o_orderstatus = 'F' THEN 'SELL' ELSE 'BUY' END AS "buySell",
        quantity, flat, json
    FROM nested JOIN orders ON o_orderkey = l_orderkey),
split AS (
    SELECT {_START} + o_orderkey * 250 AS "timestamp", account, sub AS "subAccount",
        'Cusip' || (o_orderkey % 8) AS cusip,
        CASE WHEN o_orderstatus = 'F' THEN -q ELSE q END AS quantity
    FROM alloc JOIN orders ON o_orderkey = l_orderkey)"""

_ORDER_JSON = """'{"timestamp":' || "timestamp" || ',"orderId":"' || "orderId" || '","cusip":"' || cusip
    || '","assetType":"Bond","buySell":"' || "buySell" || '","bidOffer":null,"currency":null,"quantity":'
    || quantity || ',"orderTime":' || "timestamp" || ',"allocations":[' || json || ']}'"""


def _bounds(ms: int, column: str = '"timestamp"') -> str:
    start = f"{column} - {column} % {ms}"
    return f'{start} AS "windowStart", {start} + {ms} AS "windowEnd"'


def _single_slot(fields: str) -> str:
    """CTE ``priced`` over ``ticks``; ``fields`` are the position columns."""
    names = [f.strip() for f in fields.split(",")]
    waiting = ", ".join(f"lag({n}) OVER w AS w{i}" for i, n in enumerate(names))
    chosen = ", ".join(
        f"CASE WHEN kind = 'price' THEN w{i} ELSE {n} END AS {n}" for i, n in enumerate(names)
    )
    return f"""seen AS (
    SELECT *, lag(kind) OVER w AS before_kind, {waiting},
        last_value(CASE WHEN kind = 'price' THEN price END IGNORE NULLS) OVER w AS latest
    FROM ticks WINDOW w AS (PARTITION BY cusip ORDER BY ord)),
locked AS (
    SELECT *, min(CASE WHEN kind = 'price' AND coalesce(before_kind, 'price') = 'price' THEN ord END)
        OVER (PARTITION BY cusip) AS lock_ord
    FROM seen),
priced AS (
    SELECT cusip, {chosen}, latest AS price, ord, "timestamp"
    FROM locked
    WHERE (kind = 'price' AND before_kind = 'position' AND (lock_ord IS NULL OR ord < lock_ord))
        OR (kind = 'position' AND ord > lock_ord))"""


_ACCOUNT = 'account, "subAccount", quantity, "orderId"'

def _mv(keys: str, carried: str = "") -> str:
    return f"""SELECT ws AS "windowStart", ws + 60000 AS "windowEnd", {keys}, {carried}
    arg_max(quantity, ord) AS quantity, arg_max(price, ord) AS price,
    arg_max(quantity * price, ord) AS "marketValue", ws + 60000 AS "timestamp"
FROM (SELECT *, "timestamp" - "timestamp" % 60000 AS ws FROM priced) GROUP BY ws, {keys}"""


_WINDOWED = '(SELECT *, "timestamp" - "timestamp" % 10000 AS ws FROM positions)'
_K2 = 'account, "subAccount", cusip'

_SUM_10S = f"""sums AS (
    SELECT ws, {_K2}, sum(quantity)::BIGINT AS quantity, min(ord) AS ord,
        arg_min("orderId", ord) AS "orderId", arg_min("timestamp", ord) AS "timestamp"
    FROM {_WINDOWED} GROUP BY ws, {_K2})"""

_ENTRY = """string_agg(account || '/' || "subAccount" || '/' || quantity, ',' ORDER BY ord)"""


def _late_by_max(slack: int, mark: str = '"timestamp"') -> str:
    return f"""WITH {_LATE}, marked AS (
    SELECT *, max({mark}) OVER (PARTITION BY "sourcePartition" ORDER BY arrival
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {slack} AS watermark,
        "timestamp" - "timestamp" % 10000 + 10000 AS "windowEnd"
    FROM late)
SELECT "sourcePartition", ord, arrival, "timestamp", "windowEnd", watermark,
    coalesce("windowEnd" - 1 <= watermark, false) AS "isLate" FROM marked"""


_BLANK = r"[ \t\n\x0b\f\r]"
_WORDS = rf"""words AS (
    SELECT doc_id, unnest(string_split_regex(regexp_replace(text, '{_BLANK}+\z', ''), '{_BLANK}')) AS word
    FROM documents WHERE text = '' OR regexp_replace(text, '{_BLANK}+\z', '') <> '')"""

ORACLE: dict[str, str] = {
    "kafka_decode_price": f"""WITH {_TICKS}
SELECT "timestamp", "orderId" AS id, cusip, price, "timestamp" AS "effectiveDateTime"
FROM ticks WHERE kind = 'price'""",
    "kafka_decode_position": f"""WITH {_POSITIONS}
SELECT "timestamp", account, "subAccount", cusip, quantity, 0.0::DOUBLE AS price,
    0.0::DOUBLE AS "marketValue", "orderId" FROM positions""",
    "kafka_decode_symbol": f"""WITH {_POSITIONS}
SELECT "timestamp", cusip, quantity, 0.0::DOUBLE AS price, 0.0::DOUBLE AS "marketValue" FROM positions""",
    "kafka_decode_order": f"""WITH {_ORDERS}
SELECT "timestamp", "orderId", cusip, 'Bond' AS "assetType", "buySell", NULL::DOUBLE AS "bidOffer",
    NULL::VARCHAR AS currency, quantity, "timestamp" AS "orderTime", flat AS allocations
FROM block_orders""",
    "kafka_decode_dead_letters": """SELECT
    CASE WHEN event_type = 'signup' THEN 'dead' ELSE 'row' END AS outcome,
    CASE WHEN event_type <> 'signup' THEN 'Cusip' || user_id END AS cusip,
    CASE WHEN event_type <> 'signup' THEN CAST(event_id AS INTEGER) END AS quantity,
    CASE WHEN event_type = 'signup'
        THEN substr('{"cusip":"Cusip' || user_id || '","unknown":1,"quantity":' || event_id || '}', 1, 12)
    END AS raw
FROM events""",
    "kafka_encode_position": f"""WITH {_POSITIONS}
SELECT account AS key, '{{"timestamp":' || "timestamp" || ',"account":"' || account || '","subAccount":"'
    || "subAccount" || '","cusip":"' || cusip || '","quantity":' || quantity
    || ',"price":0.0,"marketValue":0.0,"orderId":"' || "orderId" || '"}}' AS value, 'mvByAct' AS topic
FROM positions""",
    "kafka_encode_symbol": f"""WITH {_POSITIONS}
SELECT cusip AS key, '{{"timestamp":' || "timestamp" || ',"cusip":"' || cusip || '","quantity":' || quantity
    || ',"price":0.0,"marketValue":0.0}}' AS value, 'mvBySymbol' AS topic
FROM positions""",
    "kafka_encode_cusip_alloc": f"""WITH {_POSITIONS}
SELECT cusip AS key, '{{"f0":"' || cusip || '","f1":[' || string_agg('{{"account":"' || account
    || '","subAccount":"' || "subAccount" || '","quantity":' || quantity || '}}', ',' ORDER BY ord)
    || ']}}' AS value, 'positionsByCusip' AS topic
FROM {_WINDOWED} GROUP BY ws, cusip""",
    "kafka_encode_compliance": f"""WITH {_POSITIONS}
SELECT "orderId" AS key, '{{"timestamp":' || "timestamp" || ',"orderId":"' || "orderId"
    || '","success":true,"errors":null}}' AS value, 'out' AS topic
FROM positions""",
    "kafka_encode_order": f"""WITH {_ORDERS}
SELECT "orderId" AS key, {_ORDER_JSON} AS value, 'orders' AS topic FROM block_orders""",
    "kafka_encode_order_unkeyed": f"WITH {_ORDERS}\nSELECT {_ORDER_JSON} AS value FROM block_orders",
    "order_split": f"""WITH {_ORDERS}
SELECT "timestamp", account, "subAccount", cusip, quantity FROM split""",
    "order_split_windowall": f"""WITH {_ORDERS}
SELECT 0::BIGINT AS "timestamp", account, "subAccount", cusip, quantity FROM split""",
    "order_net_positions": f"""WITH {_ORDERS}
SELECT {_K2}, sum(quantity)::BIGINT AS quantity FROM split GROUP BY {_K2}""",
    "enrich_price": f"""WITH {_POSITIONS}
SELECT ord, "timestamp", account, "subAccount", cusip, quantity, quantity / 10.0::DOUBLE AS price
FROM positions""",
    "enrich_value": f"""WITH {_POSITIONS}
SELECT ord, "timestamp", account, "subAccount", cusip, quantity, quantity / 10.0::DOUBLE AS price,
    quantity * (quantity / 10.0::DOUBLE) AS "marketValue"
FROM positions""",
    "compliance_result": f"""WITH {_POSITIONS}
SELECT "timestamp", "orderId", true AS success, NULL::VARCHAR AS errors FROM positions""",
    "word_split": f"""WITH {_WORDS}
SELECT doc_id, word, count(*) AS count FROM words GROUP BY doc_id, word""",
    "token_count": r"""SELECT word, count(*) AS count
FROM (SELECT unnest(string_split_regex(lower(text), '[^A-Za-z0-9_]+')) AS word FROM documents)
WHERE word <> '' GROUP BY word""",
    "mv_by_account_1m": f"""WITH {_TICKS}, {_single_slot(_ACCOUNT)}
{_mv(_K2, 'arg_max("orderId", ord) AS "orderId",')}""",
    "mv_by_symbol_1m": f"WITH {_TICKS}, {_single_slot('quantity')}\n{_mv('cusip')}",
    "position_window_sum_10s": f"""WITH {_POSITIONS}, {_SUM_10S}
SELECT ws AS "windowStart", ws + 10000 AS "windowEnd", {_K2}, quantity, ord, "orderId", "timestamp"
FROM sums""",
    "position_window_total": f"""WITH {_POSITIONS}, {_SUM_10S}
SELECT ws AS "windowStart", ws + 10000 AS "windowEnd", {_K2}, quantity, 0::BIGINT AS "timestamp",
    NULL::VARCHAR AS "orderId" FROM sums""",
    "cusip_allocations_10s": f"""WITH {_POSITIONS}
SELECT ws AS "windowStart", ws + 10000 AS "windowEnd", cusip,
    {_ENTRY} AS allocations, count(*) AS entries FROM {_WINDOWED} GROUP BY ws, cusip""",
    "symbol_quantity_10s": f"""WITH {_POSITIONS}
SELECT ws AS "windowStart", ws + 10000 AS "windowEnd", cusip, sum(quantity)::BIGINT AS quantity,
    ws + 10000 AS "timestamp" FROM {_WINDOWED} GROUP BY ws, cusip""",
    "word_count_5s": f"""WITH {_WORDS},
timed AS (SELECT word, {_START} + doc_id * 1000 AS t FROM words)
SELECT {_bounds(5000, 't')}, word, count(*) AS count FROM timed GROUP BY 1, 2, 3""",
    "rolling_quantity": f"""WITH {_POSITIONS}
SELECT ord, "timestamp", account, "subAccount", cusip, quantity,
    (sum(quantity) OVER (PARTITION BY {_K2} ORDER BY ord))::BIGINT AS "rollingQuantity"
FROM positions""",
    "message_symbol_quantity": f"""WITH {_ORDERS}
SELECT "timestamp" - "timestamp" % 10000 + 10000 AS "timestamp", cusip, sum(quantity)::INTEGER AS quantity,
    0::DOUBLE AS price, 0::DOUBLE AS "marketValue" FROM split GROUP BY 1, 2""",
    "message_cusip_allocations": f"""WITH {_ORDERS},
sums AS (SELECT "timestamp" - "timestamp" % 10000 AS ws, {_K2}, sum(quantity)::BIGINT AS quantity
    FROM split GROUP BY 1, 2, 3, 4)
SELECT cusip AS key, '{{"f0":"' || cusip || '","f1":[' || string_agg('{{"account":"' || account
    || '","subAccount":"' || "subAccount" || '","quantity":' || quantity || '}}', ',' ORDER BY account, "subAccount")
    || ']}}' AS value, 'positionsByCusip' AS topic
FROM sums GROUP BY ws, cusip""",
    "chained_window_rollup": f"""WITH {_POSITIONS}, {_SUM_10S}
SELECT ws AS "windowStart", ws + 10000 AS "windowEnd", cusip, sum(quantity)::BIGINT AS quantity,
    ws + 10000 AS "timestamp" FROM sums GROUP BY ws, cusip""",
    "chained_window_allocations": f"""WITH {_POSITIONS}, {_SUM_10S}
SELECT ws AS "windowStart", ws + 10000 AS "windowEnd", cusip,
    {_ENTRY} AS allocations, count(*) AS entries FROM sums GROUP BY ws, cusip""",
    "price_enrich_act": f"WITH {_TICKS}, {_single_slot(_ACCOUNT)}\nSELECT * FROM priced",
    "price_enrich_act_many_cusips": f"WITH {_USER_TICKS}, {_single_slot(_ACCOUNT)}\nSELECT * FROM priced",
    "price_enrich_symbol": f"WITH {_TICKS}, {_single_slot('quantity')}\nSELECT * FROM priced",
    "price_enrich_list": f"""WITH {_TICKS}, ahead AS (
    SELECT *, first_value(price IGNORE NULLS) OVER w AS p,
        first_value(CASE WHEN kind = 'price' THEN ord END IGNORE NULLS) OVER w AS p_ord,
        first_value(CASE WHEN kind = 'price' THEN "timestamp" END IGNORE NULLS) OVER w AS p_time
    FROM ticks
    WINDOW w AS (PARTITION BY cusip ORDER BY ord ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))
SELECT cusip, {_ACCOUNT}, p AS price, quantity * p AS "marketValue", p_ord AS ord,
    p_time AS "timestamp", ord AS "positionOrd"
FROM ahead WHERE kind = 'position' AND p IS NOT NULL""",
    "price_timer_conflation": f"""WITH RECURSIVE {_TICKS},
quotes AS (SELECT cusip, "timestamp" AS t, ord, price FROM ticks WHERE kind = 'price'),
fires AS (
    SELECT cusip, CAST(-1 AS BIGINT) AS after, min(t) + 60000 AS fire FROM quotes GROUP BY cusip
    UNION ALL
    SELECT f.cusip, f.fire, min(q.t) + 60000 FROM fires f JOIN quotes q ON q.cusip = f.cusip AND q.t >= f.fire
    GROUP BY f.cusip, f.fire),
held AS (
    SELECT f.cusip, fire, account, "subAccount", arg_max(quantity, ord) AS quantity,
        arg_max("orderId", ord) AS "orderId"
    FROM fires f JOIN ticks t ON t.cusip = f.cusip AND kind = 'position'
        AND t."timestamp" >= f.after AND t."timestamp" < f.fire
    GROUP BY f.cusip, fire, account, "subAccount"),
quoted AS (
    SELECT f.cusip, fire, arg_max(price, ord) AS price
    FROM fires f JOIN quotes q ON q.cusip = f.cusip AND q.t >= f.after AND q.t < f.fire
    GROUP BY f.cusip, fire)
SELECT cusip, account, "subAccount", quantity, "orderId", price, quantity * price AS "marketValue",
    fire AS "timestamp"
FROM held JOIN quoted USING (cusip, fire)""",
    "rolling_then_priced": f"""WITH {_TICKS.replace("ticks AS", "plain AS", 1)},
ticks AS (
    SELECT * REPLACE ((CASE WHEN kind = 'position'
        THEN sum(quantity) OVER (PARTITION BY kind, {_K2} ORDER BY ord) END)::BIGINT AS quantity)
    FROM plain),
{_single_slot('account, "subAccount", quantity')}
SELECT * FROM priced""",
    "message_mv_by_account": f"""SELECT * EXCLUDE ("windowStart", "windowEnd")
FROM (WITH {_TICKS}, {_single_slot(_ACCOUNT)} {_mv(_K2, 'arg_max("orderId", ord) AS "orderId",')})""",
    "message_mv_by_symbol": f"""SELECT * EXCLUDE ("windowStart", "windowEnd")
FROM (WITH {_TICKS}, {_single_slot('quantity')} {_mv('cusip')})""",
    "source_csv": """SELECT strftime(l_shipdate, '%Y-%m-%d') AS date, count(*) AS rows,
    max(l_extendedprice) AS daily, min(l_discount) AS monthly, max(l_tax) AS other
FROM lineitem GROUP BY 1""",
    "watermark_late_periodic": _late_by_max(0),
    "watermark_late_ascending": _late_by_max(1),
    "watermark_late_punctuated": _late_by_max(0),
    "watermark_late_marked": _late_by_max(0, 'CASE WHEN ord % 4 = 0 THEN "timestamp" END'),
    "watermark_late_timelag": f"""WITH {_LATE}, marked AS (
    SELECT *, "arrivalTimestamp" - 5000 AS watermark,
        "timestamp" - "timestamp" % 10000 + 10000 AS "windowEnd"
    FROM late)
SELECT "sourcePartition", "arrivalTimestamp", ord, arrival, "timestamp", "windowEnd", watermark,
    "windowEnd" - 1 <= watermark AS "isLate" FROM marked""",
}

ORACLE["message_timer_conflation"] = ORACLE["price_timer_conflation"]
ORACLE["message_list_values"] = f"""SELECT * EXCLUDE (ord, "positionOrd") FROM ({ORACLE["price_enrich_list"]})"""
ORACLE["message_rolling_quantity"] = f"""SELECT * EXCLUDE (ord) FROM ({ORACLE["rolling_quantity"]})"""
ORACLE["message_arrivals"] = f"""WITH {_TICKS}
SELECT "timestamp", kind, (ord % 4)::INTEGER AS partition, ord AS "offset", cusip,
    CASE WHEN kind = 'position' THEN account END AS account, CASE WHEN kind = 'position' THEN "subAccount" END AS "subAccount",
    quantity, CASE WHEN kind = 'position' THEN "orderId" END AS "orderId", price FROM ticks"""
ORACLE["message_rolling_quantity_spread"] = ORACLE["message_rolling_quantity"]
ORACLE["message_mv_by_account_spread"] = ORACLE["message_mv_by_account"]
ORACLE["source_keyed_json_lines"] = ORACLE["kafka_decode_order"]
