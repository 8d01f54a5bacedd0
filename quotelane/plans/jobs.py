"""The desk's jobs from messages to messages, ready to start on topics.

Time is the time a message reached its topic: it stands for the clock of a running job and is the
same on a replay.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quotelane import schemas
from quotelane.functions import event_time
from quotelane.operators import codec, conflation, pricing, projection, windows
from quotelane.operators.numbering import numbered
from quotelane.plans import desk
from quotelane.session import stream_settings
from quotelane.sinks import writers
from quotelane.sources import files, kafka
from quotelane.streaming import held, legs, spread


# Messages are taken in this order: by time, positions before prices, then as their topic has them.
ARRIVAL = ("timestamp", "kind", "partition", "offset")
SLACK_MS = 60_000


def _arrived(messages: DataFrame, schema: str, fields: Sequence[str], kind: str) -> DataFrame:
    at = messages.select("value", "partition", "offset", F.unix_millis("timestamp").alias("_arrived"))
    records = codec.decode(at, schema, extra=("partition", "offset", "_arrived"))
    return records.drop("timestamp").select(
        F.col("_arrived").alias("timestamp"), "partition", "offset", "cusip", F.lit(kind).alias("kind"), *fields
    )


Topic = DataFrame | Sequence[DataFrame]


def _parts(topic: Topic) -> list[DataFrame]:
    return [topic] if isinstance(topic, DataFrame) else list(topic)


def leg_events(
    positions: Topic, prices: Topic, schema: str, fields: Sequence[str], slack_ms: int = SLACK_MS
) -> DataFrame:
    """Both sides of a leg as one frame, from message frames.

    Static rows get a dense arrival number. A streaming side is one stream or a stream per partition of its
    topic. Each stream gets a watermark of its own, ``slack_ms`` behind its latest message, before all
    are united: the one that lags most holds the clock. Within a partition messages are in order by
    arrival, so with a stream per partition none is late, even without slack; with one stream for a
    side, messages further out of order than ``slack_ms`` are.
    """
    left = [_arrived(p, schema, fields, "position") for p in _parts(positions)]
    right = [_arrived(p, schemas.PRICE, ("price",), "price").withColumn("price", F.col("price").cast("double")) for p in _parts(prices)]
    if left[0].isStreaming:
        timed = [[p.withColumn("ts", event_time("timestamp")) for p in side] for side in (left, right)]
        sides = [legs.with_watermark_each(side, slack_ms) for side in timed]
        return sides[0].unionByName(sides[1], allowMissingColumns=True)
    sides = [reduce(DataFrame.unionByName, side) for side in (left, right)]
    both = sides[0].unionByName(sides[1], allowMissingColumns=True)
    return numbered(both, [F.col(c) for c in ARRIVAL], "ord").withColumn("ts", event_time("timestamp"))


def account_value_messages(
    positions: Topic,
    prices: Topic,
    topic: str = kafka.ACCOUNT_VALUES,
    slack_ms: int = SLACK_MS,
    shards: int = 1,
    bucket_ms: int = held.BUCKET_MS,
    together: int = 1,
) -> DataFrame:
    """Position and price messages to market-value messages by account."""
    events = leg_events(positions, prices, schemas.POSITION, pricing.ACCOUNT_FIELDS, slack_ms)
    if events.isStreaming:
        values = legs.account_leg(events, order=held.MESSAGES, shards=shards, bucket_ms=bucket_ms, together=together)
    else:
        values = desk.account_leg(events)
    return codec.encode_positions(values, topic)


def symbol_value_messages(
    positions: Topic,
    prices: Topic,
    topic: str = kafka.SYMBOL_VALUES,
    slack_ms: int = SLACK_MS,
    bucket_ms: int = held.BUCKET_MS,
    together: int = 1,
) -> DataFrame:
    """Position and price messages to market-value messages by security."""
    events = leg_events(positions, prices, schemas.SYMBOL_POSITION, pricing.SYMBOL_FIELDS, slack_ms)
    if events.isStreaming:
        values = legs.symbol_leg(events, order=held.MESSAGES, bucket_ms=bucket_ms, together=together)
    else:
        values = desk.symbol_leg(events)
    return codec.encode_symbol_positions(values, topic)


def arrivals(positions: Topic, prices: Topic, slack_ms: int = SLACK_MS, together: int = 1) -> DataFrame:
    """Every message of a leg once: in order and numbered by security, or late. ``route`` tells which."""
    events = leg_events(positions, prices, schemas.POSITION, pricing.ACCOUNT_FIELDS, slack_ms)
    columns = "kind STRING, price DOUBLE, account STRING, subAccount STRING, quantity INT, orderId STRING"
    rows = held.in_order(events, columns, together=together)
    return _routed(rows, "taken")


def account_prices(positions: Topic, prices: Topic, slack_ms: int = SLACK_MS) -> DataFrame:
    """The account leg up to its windows: priced positions, and the messages that came too late for it."""
    events = leg_events(positions, prices, schemas.POSITION, pricing.ACCOUNT_FIELDS, slack_ms)
    return _routed(held.price_single_slot_with_late(events), "priced")


def _routed(rows: DataFrame, usual: str) -> DataFrame:
    return rows.withColumn("route", F.when(F.col("late"), "late").otherwise(usual)).drop("late")


def start_account_leg_with_late(
    spark: SparkSession, positions: Topic, prices: Topic, path: str, checkpoint: str, slack_ms: int = SLACK_MS, **trigger
) -> list[StreamingQuery]:
    """The account leg as two queries, whose late messages are kept under ``path``/routes as route ``late``.

    The second values what the first priced, minute by minute, into messages under ``path``/values.
    """
    with stream_settings(spark):
        routed = account_prices(positions, prices, slack_ms)
        first = writers.routed_writer(routed, "route", f"{path}/routes", f"{checkpoint}/prices").trigger(**trigger).start()
        priced = spark.readStream.schema(routed.schema).parquet(f"{path}/routes").where("route = 'priced'")
        values = windows.last_value_in_window(
            legs.with_periodic_watermark(priced, held.BUCKET_MS), windows.ACCOUNT_KEY, ("orderId",)
        )
        if "availableNow" in trigger:
            first.awaitTermination()
        messages = codec.encode_positions(values, kafka.ACCOUNT_VALUES)
        second = writers.file_writer(messages, f"{path}/values", f"{checkpoint}/values").trigger(**trigger).start()
    return [first, second]


def conflated_value_messages(
    positions: Topic,
    prices: Topic,
    topic: str = kafka.ACCOUNT_VALUES,
    slack_ms: int = SLACK_MS,
    period_ms: int = conflation.PERIOD_MS,
    bucket_ms: int = held.BUCKET_MS,
    together: int = 1,
) -> DataFrame:
    """Position and price messages to a message per account slot at each fire of its security's timer."""
    events = leg_events(positions, prices, schemas.POSITION, pricing.ACCOUNT_FIELDS, slack_ms)
    if events.isStreaming:
        values = held.price_timer_conflation(events, period_ms, bucket_ms=bucket_ms, together=together)
    else:
        values = conflation.price_timer_conflation(events, period_ms=period_ms)
    return codec.encode_positions(values, topic)


def listed_value_messages(
    positions: Topic,
    prices: Topic,
    topic: str = kafka.ACCOUNT_VALUES,
    slack_ms: int = SLACK_MS,
    bucket_ms: int = held.BUCKET_MS,
    together: int = 1,
) -> DataFrame:
    """Position and price messages to a message per position, valued at its security's next price."""
    events = leg_events(positions, prices, schemas.POSITION, pricing.ACCOUNT_FIELDS, slack_ms)
    if events.isStreaming:
        values = held.price_list_buffer(events, bucket_ms=bucket_ms, together=together)
    else:
        values = pricing.price_list_buffer(events)
    return codec.encode_positions(values, topic)


def running_quantities(
    positions: Topic,
    slack_ms: int = SLACK_MS,
    shards: int = 1,
    bucket_ms: int = held.BUCKET_MS,
    together: int = 1,
) -> DataFrame:
    """Position messages to running totals by account and security, in the order of arrival.

    ``shards``: over how many tasks one key's stretches of time are spread.
    """
    parts = [_arrived(p, schemas.POSITION, ("account", "subAccount", "quantity"), "position") for p in _parts(positions)]
    timed = [p.withColumn("ts", event_time("timestamp")) for p in parts]
    if timed[0].isStreaming:
        rows = legs.with_watermark_each(timed, slack_ms)
        if shards == 1:
            return held.rolling_quantity(rows, bucket_ms=bucket_ms, together=together)
        return spread.rolling_quantity(rows.withColumn("seq", spread.sequence("partition", "offset")), shards, bucket_ms, together)
    both = numbered(reduce(DataFrame.unionByName, timed), [F.col(c) for c in ARRIVAL], "ord")
    return windows.rolling_quantity(both)


def sorted_out(messages: DataFrame, schema: str, topic: str, dead_topic: str = "dead-letters") -> DataFrame:
    """Messages that hold a record of the schema, for ``topic``; the others as they are, for ``dead_topic``.

    One query on a sink that goes by each row's topic, or on ``writers.routed_writer``, has both.
    """
    return messages.withColumn("topic", F.when(codec.broken(schema), dead_topic).otherwise(topic))


def compliance_messages(positions: DataFrame, topic: str = "out") -> DataFrame:
    """Position messages to compliance messages."""
    return codec.encode_compliance(
        projection.compliance_results(codec.decode_positions(positions.select("value"))), topic
    )


def order_positions(orders: DataFrame, slack_ms: int = SLACK_MS) -> DataFrame:
    """Order messages to signed positions at the time the message arrived."""
    arrived = orders.select("value", F.unix_millis("timestamp").alias("_arrived"))
    decoded = codec.decode(arrived, schemas.ORDER, extra=("_arrived",))
    split = projection.split_orders(decoded.drop("timestamp").withColumnRenamed("_arrived", "timestamp"))
    # within a window, allocations are listed by account
    positions = split.withColumn("ts", event_time("timestamp")).withColumn("ord", F.lit(0).cast("bigint"))
    return legs.with_periodic_watermark(positions, slack_ms) if orders.isStreaming else positions


def symbol_quantity_messages(
    orders: DataFrame, topic: str = kafka.SYMBOL_POSITIONS, slack_ms: int = SLACK_MS, width: str = "10 seconds"
) -> DataFrame:
    """Order messages to quantities by security and window, rolled up from those by account."""
    rolled = windows.symbol_quantity(
        windows.sum_in_window(order_positions(orders, slack_ms), first=(), width=width), width, "window"
    )
    unpriced = F.lit(0.0)
    return codec.encode_symbol_positions(
        rolled.select(
            "timestamp", "cusip", F.col("quantity").cast("int"), unpriced.alias("price"), unpriced.alias("marketValue")
        ),
        topic,
    )


def cusip_allocation_messages(
    orders: DataFrame, topic: str = "positionsByCusip", slack_ms: int = SLACK_MS, width: str = "10 seconds"
) -> DataFrame:
    """Order messages to lists of allocations by security and window."""
    summed = windows.sum_in_window(order_positions(orders, slack_ms), first=(), width=width)
    return codec.encode_cusip_allocations(windows.cusip_allocations(summed, width, "window"), topic)


def start_roll_ups(
    spark: SparkSession, servers: str, checkpoint: str, orders: str = "orders", **source_options
) -> list[StreamingQuery]:
    """Order messages to quantities and allocation lists by security, topic to topic."""
    makers = (("symbol-quantities", symbol_quantity_messages), ("cusip-allocations", cusip_allocation_messages))
    with stream_settings(spark):
        return [
            kafka.topic_writer(make(kafka.topic_stream(spark, servers, orders, **source_options)), servers, f"{checkpoint}/{name}")
            .queryName(name)
            .start()
            for name, make in makers
        ]


def start_desk(
    spark: SparkSession,
    servers: str,
    checkpoint: str,
    prices: str = kafka.PRICES,
    account_positions: str = kafka.ACCOUNT_POSITIONS,
    symbol_positions: str = kafka.SYMBOL_POSITIONS,
    account_values: str = kafka.ACCOUNT_VALUES,
    symbol_values: str = kafka.SYMBOL_VALUES,
    trigger: str = "5 seconds",
    partitions: int | None = None,
    dead_topic: str | None = None,
    **source_options,
) -> list[StreamingQuery]:
    """Start both legs on topics. Each leg is a query of its own and reads the prices itself.

    With ``partitions``, the number of the topics' partitions, each has a clock of its own and no message is late.
    With ``dead_topic``, malformed messages go there by a query of their own and the legs leave them out;
    otherwise one stops its leg.
    """
    given = {
        prices: schemas.PRICE, account_positions: schemas.POSITION, symbol_positions: schemas.SYMBOL_POSITION
    }

    def topic(name: str) -> Topic:
        if partitions:
            parts = kafka.partition_streams(spark, servers, name, partitions, **source_options)
        else:
            parts = [kafka.topic_stream(spark, servers, name, **source_options)]
        return [p.where(~codec.broken(given[name])) for p in parts] if dead_topic else parts

    slack_ms = 0 if partitions else SLACK_MS
    started = {
        "account-leg": account_value_messages(topic(account_positions), topic(prices), account_values, slack_ms),
        "symbol-leg": symbol_value_messages(topic(symbol_positions), topic(prices), symbol_values, slack_ms),
    }
    for name, schema in given.items() if dead_topic else ():
        messages = kafka.topic_stream(spark, servers, name, **source_options)
        dead = sorted_out(messages, schema, name, dead_topic).where(F.col("topic") == dead_topic)
        started[f"dead-{name}"] = dead.select("key", "value", "topic")
    with stream_settings(spark):
        return [
            kafka.topic_writer(messages, servers, f"{checkpoint}/{name}")
            .trigger(processingTime=trigger)
            .queryName(name)
            .start()
            for name, messages in started.items()
        ]


def start_price_log(
    spark: SparkSession, servers: str, path: str, checkpoint: str, topic: str = kafka.PRICES, **source_options
) -> StreamingQuery:
    """Log every price to text files under ``path``."""
    prices = kafka.price_stream(spark, servers, topic, **source_options)
    with stream_settings(spark):
        return writers.log_writer(prices, "price {}", path, checkpoint).start()


def start_compliance(
    spark: SparkSession,
    servers: str,
    checkpoint: str,
    positions: str = kafka.ACCOUNT_POSITIONS,
    topic: str = "out",
    **source_options,
) -> StreamingQuery:
    """Position messages to compliance messages, topic to topic."""
    messages = compliance_messages(kafka.topic_stream(spark, servers, positions, **source_options), topic)
    with stream_settings(spark):
        return kafka.topic_writer(messages, servers, checkpoint).queryName("compliance").start()


def start_word_count(
    spark: SparkSession, path: str, checkpoint: str, width: str = "5 seconds", out=None
) -> StreamingQuery:
    """Print word counts of the text files that appear under ``path``."""
    lines = legs.with_periodic_watermark(files.text_stream(spark, path))
    counts = windows.word_count(projection.split_words(lines), width)
    with stream_settings(spark):
        return writers.print_writer(counts, checkpoint, out).outputMode("append").start()


def rolled_then_priced(
    positions: DataFrame, prices: DataFrame, segment_rows: int | None = None
) -> DataFrame:
    """Running totals by account, each then paired with a price of its security."""
    totals = windows.rolling_quantity(positions, segment_rows=segment_rows)
    fields = ("account", "subAccount", "quantity")
    rolled = totals.withColumn("quantity", F.col("rollingQuantity"))
    return pricing.price_single_slot(pricing.tag_sides(rolled, prices, fields), fields, segment_rows)
