"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelane import fixtures, schemas
from quotelane.operators import codec, conflation, lateness, pricing, projection, windows
from quotelane.plans import desk, jobs
from quotelane.session import work_dir
from quotelane.sources import files

Query = Callable[[SparkSession, str], DataFrame]

# The registered late-data and fixture parameters, repeated by the SQL in oracle.py.
LATE_WINDOW_MS = 10_000
PARTITIONS = 4
ARRIVAL_COLUMNS = ("timestamp", "kind", "partition", "offset", "cusip", "account", "subAccount", "quantity", "orderId", "price")
ROLLED_COLUMNS = ("timestamp", "account", "subAccount", "cusip", "quantity", "rollingQuantity")


# ---- records built from the views -------------------------------------------------------------


def price_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.ticks(spark, sf_dir).where(F.col("kind") == "price").select(
        "timestamp",
        F.col("orderId").alias("id"),
        "cusip",
        F.col("price").cast("decimal(38,18)").alias("price"),
        F.col("timestamp").alias("effectiveDateTime"),
    )


def position_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    unpriced = F.lit(0.0)
    return fixtures.positions(spark, sf_dir).select(
        "timestamp",
        "account",
        "subAccount",
        "cusip",
        "quantity",
        unpriced.alias("price"),
        unpriced.alias("marketValue"),
        "orderId",
    )


def symbol_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return position_records(spark, sf_dir).drop("account", "subAccount", "orderId")


def _readable(messages: DataFrame) -> DataFrame:
    """Message bytes as text, for comparing."""
    return messages.select(
        *[
            F.col(c).cast("string").alias(c) if c in ("key", "value") else F.col(c)
            for c in messages.columns
        ]
    )


def _flat_orders(orders: DataFrame) -> DataFrame:
    return orders.withColumn("allocations", windows.allocation_text())


# ---- codecs ------------------------------------------------------------------------------------


def kafka_decode_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = codec.decode_prices(codec.encode_prices(price_records(spark, sf_dir)))
    return decoded.withColumn("price", F.col("price").cast("double"))


def kafka_decode_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codec.decode_positions(codec.encode_positions(position_records(spark, sf_dir)))


def kafka_decode_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codec.decode_symbol_positions(codec.encode_symbol_positions(symbol_records(spark, sf_dir)))


def kafka_decode_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = codec.encode_orders(fixtures.block_orders(spark, sf_dir), "orders")
    decoded = _flat_orders(codec.decode_orders(messages))
    return decoded.withColumn("bidOffer", F.col("bidOffer").cast("double"))


def partly_cut_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A message of every event, cut short on every sign-up."""
    events = fixtures.table(spark, sf_dir, "events")
    whole = F.concat(
        F.lit('{"cusip":"Cusip'), F.col("user_id"), F.lit('","unknown":1,"quantity":'), F.col("event_id"), F.lit("}")
    )
    value = F.when(F.col("event_type") == "signup", F.substring(whole, 1, 12))
    return events.select(F.col("event_id").alias("offset"), value.otherwise(whole).cast("binary").alias("value"))


def outcomes(good: DataFrame, dead: DataFrame) -> DataFrame:
    """Decoded records and messages set aside, as one frame."""
    return good.select(
        F.lit("row").alias("outcome"), "cusip", "quantity", F.lit(None).cast("string").alias("raw")
    ).unionByName(
        dead.select(
            F.lit("dead").alias("outcome"),
            F.lit(None).cast("string").alias("cusip"),
            F.lit(None).cast("int").alias("quantity"),
            F.col("value").cast("string").alias("raw"),
        )
    )


def kafka_decode_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events' free-form messages, some cut short: sound ones parse, cut ones are set aside."""
    return outcomes(*codec.decode_split(partly_cut_messages(spark, sf_dir), schemas.SYMBOL_POSITION))


def kafka_encode_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _readable(codec.encode_positions(position_records(spark, sf_dir)))


def kafka_encode_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _readable(codec.encode_symbol_positions(symbol_records(spark, sf_dir)))


def kafka_encode_cusip_alloc(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = windows.cusip_allocations(fixtures.positions(spark, sf_dir))
    return _readable(codec.encode_cusip_allocations(lists))


def kafka_encode_compliance(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = projection.compliance_results(fixtures.positions(spark, sf_dir))
    return _readable(codec.encode_compliance(results))


def kafka_encode_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _readable(codec.encode_orders(fixtures.block_orders(spark, sf_dir), "orders"))


def kafka_encode_order_unkeyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _readable(codec.encode_orders(fixtures.block_orders(spark, sf_dir), key=None))


# ---- projections -------------------------------------------------------------------------------


def order_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection.split_orders(fixtures.block_orders(spark, sf_dir))


def order_split_windowall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection.split_orders(fixtures.block_orders(spark, sf_dir), keep_time=False)


def order_net_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return desk.account_positions(fixtures.block_orders(spark, sf_dir))


def _quoted_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each position beside a price of its own, a tenth of its quantity."""
    return fixtures.positions(spark, sf_dir).withColumn("quote", F.col("quantity") / F.lit(10.0))


def enrich_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = projection.enrich_with_price(_quoted_positions(spark, sf_dir), F.col("quote"))
    return out.select("ord", "timestamp", "account", "subAccount", "cusip", "quantity", "price")


def enrich_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = projection.enrich_with_value(_quoted_positions(spark, sf_dir), F.col("quote"))
    return out.select("ord", "timestamp", "account", "subAccount", "cusip", "quantity", "price", "marketValue")


def compliance_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = projection.compliance_results(fixtures.positions(spark, sf_dir))
    return out.withColumn("errors", F.array_join("errors", ","))


def word_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = fixtures.lines(spark, sf_dir).drop("ts")

    def counted(part: DataFrame) -> DataFrame:
        return projection.split_words(part).groupBy("doc_id", "word").agg(F.count("*").alias("count"))

    # texts move, not their words, so words are counted once, where their document is; lines of no document are in no one place
    whole = lines.where(F.col("doc_id").isNotNull()).repartition("doc_id")
    return counted(whole).unionByName(counted(lines.where(F.col("doc_id").isNull())))


def token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = projection.split_tokens(fixtures.lines(spark, sf_dir).drop("ts"))
    return words.groupBy("word").agg(F.count("*").alias("count"))


# ---- windows -----------------------------------------------------------------------------------


def mv_by_account_1m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return desk.account_leg(fixtures.ticks(spark, sf_dir))


def mv_by_symbol_1m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return desk.symbol_leg(fixtures.symbol_ticks(spark, sf_dir))


def position_window_sum_10s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.sum_in_window(fixtures.positions(spark, sf_dir))


def position_window_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.total_in_window(fixtures.positions(spark, sf_dir))


def flat_allocations(lists: DataFrame) -> DataFrame:
    return lists.withColumn("entries", F.size("allocations").cast("bigint")).withColumn(
        "allocations", windows.allocation_text()
    )


def cusip_allocations_10s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_allocations(windows.cusip_allocations(fixtures.positions(spark, sf_dir)))


def symbol_quantity_10s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.symbol_quantity(fixtures.positions(spark, sf_dir))


def word_count_5s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.word_count(projection.split_words(fixtures.lines(spark, sf_dir)))


def rolling_quantity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = windows.rolling_quantity(fixtures.positions(spark, sf_dir))
    return out.select("ord", "timestamp", "account", "subAccount", "cusip", "quantity", "rollingQuantity")


def chained_window_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return desk.rolled_up_quantity(fixtures.positions(spark, sf_dir))


def chained_window_allocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_allocations(desk.rolled_up_allocations(fixtures.positions(spark, sf_dir)))


# ---- pricing -----------------------------------------------------------------------------------


def price_enrich_act(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pricing.price_single_slot(fixtures.ticks(spark, sf_dir)).drop("ts")


def price_enrich_act_many_cusips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A security per user, where more prices meet a waiting position."""
    return pricing.price_single_slot(fixtures.ticks(spark, sf_dir, cusips=None)).drop("ts")


def price_enrich_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fixtures.symbol_ticks(spark, sf_dir)
    return pricing.price_single_slot(events, pricing.SYMBOL_FIELDS).drop("ts")


def price_enrich_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pricing.price_list_buffer(fixtures.ticks(spark, sf_dir)).drop("ts")


def price_timer_conflation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conflation.price_timer_conflation(fixtures.ticks(spark, sf_dir)).drop("ts")


def rolling_then_priced(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = fixtures.ticks(spark, sf_dir)
    prices = ticks.where(F.col("kind") == "price")
    return jobs.rolled_then_priced(fixtures.positions(spark, sf_dir), prices).drop("ts")


# ---- late data ---------------------------------------------------------------------------------

_LATE_COLUMNS = ("ord", "arrival", "timestamp", "windowEnd", "watermark", "isLate")


def watermark_late_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lateness.late_by_running_max(fixtures.late_ticks(spark, sf_dir), LATE_WINDOW_MS)
    return out.select("sourcePartition", *_LATE_COLUMNS)


def watermark_late_ascending(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lateness.late_by_running_max(fixtures.late_ticks(spark, sf_dir), LATE_WINDOW_MS, slack_ms=1)
    return out.select("sourcePartition", *_LATE_COLUMNS)


def watermark_late_punctuated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row emits a watermark; those that go back are ignored, which leaves the running latest."""
    out = lateness.late_by_punctuation(fixtures.late_ticks(spark, sf_dir), width_ms=LATE_WINDOW_MS)
    return out.select("sourcePartition", *_LATE_COLUMNS)


def watermark_late_marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only every fourth order emits a watermark."""
    marks = F.col("ord") % 4 == 0
    out = lateness.late_by_punctuation(fixtures.late_ticks(spark, sf_dir), marks, LATE_WINDOW_MS)
    return out.select("sourcePartition", *_LATE_COLUMNS)


def watermark_late_timelag(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lateness.late_by_time_lag(fixtures.late_ticks(spark, sf_dir), LATE_WINDOW_MS)
    return out.select("sourcePartition", "arrivalTimestamp", *_LATE_COLUMNS)


# ---- messages in, messages out -----------------------------------------------------------------


def position_messages(spark: SparkSession, sf_dir: str, by_symbol: bool = False) -> DataFrame:
    """Position topic of four partitions; a row's number is its offset."""
    records = symbol_records(spark, sf_dir) if by_symbol else position_records(spark, sf_dir)
    encode = codec.encode_symbol_positions if by_symbol else codec.encode_positions
    return _in_topic(encode(records), fixtures.START_MS)


def price_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _in_topic(codec.encode_prices(price_records(spark, sf_dir)), fixtures.START_MS)


def _in_topic(messages: DataFrame, start_ms: int) -> DataFrame:
    """Add the columns a topic adds; messages arrive at the time they carry."""
    at = F.get_json_object(F.col("value").cast("string"), "$.timestamp").cast("bigint")
    offset = F.floor((at - start_ms) / fixtures.STEP_MS)
    return messages.select(
        "key",
        "value",
        "topic",
        (offset % PARTITIONS).cast("int").alias("partition"),
        offset.alias("offset"),
        F.timestamp_millis(at).alias("timestamp"),
    )


def closing_messages(messages: DataFrame) -> DataFrame:
    """One message far past the others, which closes what is open on a topic."""
    return messages.limit(1).withColumn("timestamp", F.expr("timestamp'2100-01-01 00:00:00'"))


def message_mv_by_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = jobs.account_value_messages(position_messages(spark, sf_dir), price_messages(spark, sf_dir))
    return codec.decode_positions(messages)


def message_mv_by_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    positions = position_messages(spark, sf_dir, by_symbol=True)
    return codec.decode_symbol_positions(jobs.symbol_value_messages(positions, price_messages(spark, sf_dir)))


def message_timer_conflation(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = jobs.conflated_value_messages(position_messages(spark, sf_dir), price_messages(spark, sf_dir))
    return codec.decode_positions(messages)


def message_list_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = jobs.listed_value_messages(position_messages(spark, sf_dir), price_messages(spark, sf_dir))
    return codec.decode_positions(messages)


def message_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message of the account leg."""
    events = jobs.leg_events(
        position_messages(spark, sf_dir), price_messages(spark, sf_dir), schemas.POSITION, jobs.pricing.ACCOUNT_FIELDS
    )
    return events.select(*ARRIVAL_COLUMNS)


def message_rolling_quantity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.running_quantities(position_messages(spark, sf_dir)).select(*ROLLED_COLUMNS)


def order_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order topic; an order's number is its offset."""
    return _in_topic(codec.encode_orders(fixtures.block_orders(spark, sf_dir), "orders"), fixtures.START_MS)


def message_symbol_quantity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codec.decode_symbol_positions(jobs.symbol_quantity_messages(order_messages(spark, sf_dir)))


def message_cusip_allocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _readable(jobs.cusip_allocation_messages(order_messages(spark, sf_dir)))


# ---- files -------------------------------------------------------------------------------------


def source_keyed_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders written as ``key:{json}`` lines and read back."""
    messages = codec.encode_orders(fixtures.block_orders(spark, sf_dir))
    path = work_dir(spark, "lines")
    line = F.concat(F.col("key").cast("string"), F.lit(":"), F.col("value").cast("string"))
    messages.select(line.alias("value")).write.mode("append").text(path)
    decoded = _flat_orders(codec.decode_orders(files.keyed_json_lines(spark, path)))
    return decoded.withColumn("bidOffer", F.col("bidOffer").cast("double"))


def source_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A date and three numbers of every line item, written without header and read back."""
    path = work_dir(spark, "csv")
    fixtures.table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("date"), "l_extendedprice", "l_discount", "l_tax"
    ).write.mode("append").csv(path)
    rates = files.tbill_csv(spark, path)
    return rates.groupBy(F.date_format("date", "yyyy-MM-dd").alias("date")).agg(
        F.count("*").alias("rows"),
        F.max("daily").alias("daily"),
        F.min("monthly").alias("monthly"),
        F.max("other").alias("other"),
    )


BATCH: dict[str, Query] = {
    f.__name__: f
    for f in (
        kafka_decode_price,
        kafka_decode_position,
        kafka_decode_symbol,
        kafka_decode_order,
        kafka_decode_dead_letters,
        kafka_encode_position,
        kafka_encode_symbol,
        kafka_encode_cusip_alloc,
        kafka_encode_compliance,
        kafka_encode_order,
        kafka_encode_order_unkeyed,
        order_split,
        order_split_windowall,
        order_net_positions,
        enrich_price,
        enrich_value,
        compliance_result,
        word_split,
        token_count,
        mv_by_account_1m,
        mv_by_symbol_1m,
        position_window_sum_10s,
        position_window_total,
        cusip_allocations_10s,
        symbol_quantity_10s,
        word_count_5s,
        rolling_quantity,
        chained_window_rollup,
        chained_window_allocations,
        price_enrich_act,
        price_enrich_act_many_cusips,
        price_enrich_symbol,
        price_enrich_list,
        price_timer_conflation,
        rolling_then_priced,
        message_mv_by_account,
        message_mv_by_symbol,
        message_timer_conflation,
        message_list_values,
        message_rolling_quantity,
        message_arrivals,
        message_symbol_quantity,
        message_cusip_allocations,
        source_keyed_json_lines,
        source_csv,
        watermark_late_periodic,
        watermark_late_ascending,
        watermark_late_punctuated,
        watermark_late_marked,
        watermark_late_timelag,
    )
}
