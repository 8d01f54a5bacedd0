"""The streaming operators as queries over the given tables, to their end.

Each gives what its batch form gives, and shares its SQL.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelane import fixtures, schemas
from quotelane.operators import codec, projection, windows
from quotelane.plans import catalog, desk, jobs
from quotelane.plans.catalog import Query
from quotelane.session import stream_settings, work_dir
from quotelane.sinks.writers import file_writer, routed_writer
from quotelane.streaming import held, keyed, legs, spread
from quotelane.streaming.replay import disorder, replay, state_parts, timed_ticks

ROWS_PER_FILE = 2_000_000
# Files of a topic are smaller, and a micro-batch takes several, which are written and read side by side.
FILES_PER_TRIGGER = 8
DEALT_FILES = 6
ORDER = held.NUMBERED
# A replay needs no early results: its buckets are a window of the legs, or half an hour where no window follows.
WINDOW_MS = 60_000
STRETCH_MS = 1_800_000
# Buckets of four hours lie together in the state.
HELD_MS = 4 * 3_600_000
LIVE = {"slack_ms": 0, "bucket_ms": WINDOW_MS, "together": HELD_MS // WINDOW_MS}
TAKEN = {"files": FILES_PER_TRIGGER}
# Windows of words that lie together in the state: of five seconds, somewhat over five minutes.
WINDOWS_OF_WORDS = 64
STRETCHES = {"bucket_ms": STRETCH_MS, "together": HELD_MS // STRETCH_MS}


def _events(spark: SparkSession, sf_dir: str, plan, label: str) -> DataFrame:
    return replay(spark, sf_dir, "events", "event_id", lambda e, back: plan(timed_ticks(e, back)), label)


def _positions(ticks: DataFrame) -> DataFrame:
    return ticks.where(F.col("kind") == "position").drop("kind", "price")


def _account_leg(ticks: DataFrame) -> DataFrame:
    return legs.account_leg(ticks, order=ORDER, bucket_ms=WINDOW_MS, together=HELD_MS // WINDOW_MS)


def _symbol_leg(ticks: DataFrame) -> DataFrame:
    return legs.symbol_leg(ticks, order=ORDER, bucket_ms=WINDOW_MS, together=HELD_MS // WINDOW_MS)


def _slot(ticks: DataFrame) -> DataFrame:
    return held.price_single_slot(ticks, order=ORDER, **STRETCHES)


def _symbol_slot(ticks: DataFrame) -> DataFrame:
    return held.price_single_slot(ticks, keyed.SYMBOL_SLOT, ORDER, **STRETCHES)


def _list(ticks: DataFrame) -> DataFrame:
    return held.price_list_buffer(ticks, order=ORDER, **STRETCHES)


def _timer(ticks: DataFrame) -> DataFrame:
    return held.price_timer_conflation(ticks, order=ORDER, **STRETCHES)


def _rolling(ticks: DataFrame) -> DataFrame:
    return held.rolling_quantity(_positions(ticks), ORDER, **STRETCHES)


def stream_mv_by_account_1m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir, _account_leg, "mv-account")


def stream_mv_by_symbol_1m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir, _symbol_leg, "mv-symbol")


def stream_price_enrich_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir, _list, "list").drop("ts")


def stream_price_timer_conflation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir, _timer, "timer").drop("ts")


def stream_rolling_quantity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir, _rolling, "rolling").drop("ts")


def stream_position_window_sum_10s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(
        spark, sf_dir, lambda t: windows.sum_in_window(_positions(t)).drop("window"), "sum"
    )


def stream_position_window_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir, lambda t: windows.total_in_window(_positions(t)).drop("window"), "total")


def stream_symbol_quantity_10s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir, lambda t: windows.symbol_quantity(_positions(t)), "quantity")


def stream_cusip_allocations_10s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.flat_allocations(_events(spark, sf_dir, lambda t: windows.cusip_allocations(_positions(t)), "lists"))


def stream_price_enrich_act(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir, _slot, "slot").drop("ts")


def stream_price_enrich_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir, _symbol_slot, "symbol-slot").drop("ts")


def stream_chained_window_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir, lambda t: desk.rolled_up_quantity(_positions(t)), "rollup")


def stream_word_count_5s(spark: SparkSession, sf_dir: str) -> DataFrame:
    def plan(documents: DataFrame, back: int) -> DataFrame:
        # a document a second
        lines = legs.with_periodic_watermark(fixtures.lines_from(documents), (back + 1) * 1000 if back else 0)
        return windows.word_count(projection.split_words(lines), together=WINDOWS_OF_WORDS)

    return replay(spark, sf_dir, "documents", "doc_id", plan, "words", in_order=True)


def _topic_files(messages: DataFrame, path: str, rows_per_file: int) -> None:
    """A topic as files of about ``rows_per_file`` messages, cut by time where a topic is in order of it."""
    # made once, then counted, sampled for the ranges and written
    made = messages.persist(StorageLevel.DISK_ONLY)
    try:
        files = max(1, -(-made.count() // rows_per_file))
        made.repartitionByRange(files, "timestamp").write.mode("append").parquet(path)
    finally:
        made.unpersist()


def _closing(spark: SparkSession, path: str) -> DataFrame:
    return catalog.closing_messages(spark.read.schema(schemas.MESSAGE).parquet(path))


def _back(spark: SparkSession, path: str, partitions: int) -> int:
    """How far a topic's files go back in time (ms), within each partition if these have clocks of their own."""
    rows = spark.read.schema(schemas.MESSAGE).parquet(path).withColumn("_ms", F.unix_millis("timestamp"))
    if not partitions:
        return disorder(rows, "_ms")
    return disorder(rows.where(F.col("partition").between(0, partitions - 1)), "_ms", "partition")


def _parts(spark: SparkSession, work: str, names) -> int:
    """Into how many parts a replay of topics cuts its state."""
    return max(state_parts(spark, spark.read.schema(schemas.MESSAGE).parquet(f"{work}/{name}")) for name in names)


def live_messages(
    topics: dict[str, tuple[DataFrame, int]],
    make,
    label: str,
    partitions: int = 0,
    slack_ms: int = 0,
    files: int = 1,
    **options,
) -> DataFrame:
    """The messages that a live job makes of topics, each cut into files of a number of rows.

    A micro-batch takes up to ``files`` files of each topic, so topics of fewer files run ahead. With ``partitions``, a topic is given
    to the job as a stream per partition. Files of one age may come in any order; ``slack_ms`` is widened by what that
    can set a topic back. A late message on every topic closes what is open; it makes no value
    itself.
    """
    spark = next(iter(topics.values()))[0].sparkSession
    work = work_dir(spark, label)
    for name, (messages, rows_per_file) in topics.items():
        _topic_files(messages, f"{work}/{name}", rows_per_file)

    def topic(name: str):
        stream = spark.readStream.schema(schemas.MESSAGE).option("maxFilesPerTrigger", files).parquet(f"{work}/{name}")
        return [stream.where(F.col("partition") == p) for p in range(partitions)] if partitions else stream

    back = max(_back(spark, f"{work}/{name}", partitions) for name in topics)
    out = make(*[topic(name) for name in topics], slack_ms=slack_ms + (back + 1 if back else 0), **options)

    parts = _parts(spark, work, topics)

    def run(ends: bool) -> None:
        with stream_settings(spark, parts, ends):
            query = file_writer(out, f"{work}/out", f"{work}/checkpoint").trigger(availableNow=True).start()
        query.awaitTermination()

    run(ends=False)
    for name in topics:
        late = _closing(spark, f"{work}/{name}")
        if partitions:
            late = late.withColumn("partition", F.explode(F.sequence(F.lit(0), F.lit(partitions - 1))))
        late.coalesce(1).write.mode("append").parquet(f"{work}/{name}")
    run(ends=True)
    return spark.read.schema(out.schema).parquet(f"{work}/out")


def _rows_per_file() -> int:
    return max(1, ROWS_PER_FILE // FILES_PER_TRIGGER)


def _leg_topics(spark: SparkSession, sf_dir: str, by_symbol: bool = False) -> dict[str, tuple[DataFrame, int]]:
    """Positions in more files than prices, which run ahead."""
    positions = catalog.position_messages(spark, sf_dir, by_symbol)
    prices = catalog.price_messages(spark, sf_dir)
    return {name: (made, _rows_per_file()) for name, made in (("positions", positions), ("prices", prices))}


def stream_message_mv_by_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = live_messages(_leg_topics(spark, sf_dir), jobs.account_value_messages, "live-account", catalog.PARTITIONS, **TAKEN, **LIVE)
    return codec.decode_positions(made)


def stream_message_mv_by_account_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One security's positions over several tasks."""
    topics = _leg_topics(spark, sf_dir)
    options = {**LIVE, "shards": spread.SHARDS}
    made = live_messages(topics, jobs.account_value_messages, "live-spread", catalog.PARTITIONS, **TAKEN, **options)
    return codec.decode_positions(made)


def routed_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message once, in order or late, of a topic whose partitions come one after another: with one
    clock for all of them, most of the later partitions' messages are late."""
    positions = catalog.position_messages(spark, sf_dir).persist(StorageLevel.DISK_ONLY)
    work = work_dir(spark, "arrivals")
    # a partition's files are not taken with the next one's, unless it has more than a micro-batch takes
    files = 1
    for p in range(catalog.PARTITIONS):
        part = positions.where(F.col("partition") == p)
        files = max(files, -(-part.count() // _rows_per_file()))
        _topic_files(part, f"{work}/positions", _rows_per_file())
    positions.unpersist()
    _topic_files(catalog.price_messages(spark, sf_dir), f"{work}/prices", _rows_per_file())
    files = min(files, FILES_PER_TRIGGER)
    topics = [
        spark.readStream.schema(schemas.MESSAGE).option("maxFilesPerTrigger", files).parquet(f"{work}/{name}")
        for name in ("positions", "prices")
    ]
    out = jobs.arrivals(*topics, together=HELD_MS // held.BUCKET_MS)
    parts = _parts(spark, work, ("positions", "prices"))

    def run(ends: bool) -> None:
        with stream_settings(spark, parts, ends):
            writer = routed_writer(out, "route", f"{work}/out", f"{work}/checkpoint")
            writer.trigger(availableNow=True).start().awaitTermination()

    run(ends=False)
    for name in ("positions", "prices"):
        _closing(spark, f"{work}/{name}").coalesce(1).write.mode("append").parquet(f"{work}/{name}")
    run(ends=True)
    return spark.read.schema(out.schema).parquet(f"{work}/out")


def stream_message_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages on time and late messages are all messages."""
    return routed_arrivals(spark, sf_dir).select(*catalog.ARRIVAL_COLUMNS)


def stream_kafka_decode_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sound and malformed messages by one query into a folder each."""
    work = work_dir(spark, "letters")
    messages = catalog.partly_cut_messages(spark, sf_dir)
    files = max(3, -(-messages.count() // ROWS_PER_FILE))
    messages.repartition(files).write.parquet(f"{work}/topic")
    stream = spark.readStream.schema(messages.schema).option("maxFilesPerTrigger", 1).parquet(f"{work}/topic")
    out = jobs.sorted_out(stream, schemas.SYMBOL_POSITION, "positions")
    with stream_settings(spark):
        writer = routed_writer(out, "topic", f"{work}/out", f"{work}/checkpoint")
        writer.trigger(availableNow=True).start().awaitTermination()
    found = spark.read.schema(out.schema).parquet(f"{work}/out")
    good = codec.decode_symbol_positions(found.where("topic = 'positions'"))
    return catalog.outcomes(good, found.where("topic = 'dead-letters'"))


def stream_message_mv_by_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    topics = _leg_topics(spark, sf_dir, by_symbol=True)
    made = live_messages(topics, jobs.symbol_value_messages, "live-symbol", catalog.PARTITIONS, **TAKEN, **LIVE)
    return codec.decode_symbol_positions(made)


def stream_message_timer_conflation(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = live_messages(_leg_topics(spark, sf_dir), jobs.conflated_value_messages, "live-timer", catalog.PARTITIONS, **TAKEN, **LIVE)
    return codec.decode_positions(made)


def stream_message_list_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = live_messages(_leg_topics(spark, sf_dir), jobs.listed_value_messages, "live-list", catalog.PARTITIONS, **TAKEN, **LIVE)
    return codec.decode_positions(made)


def stream_message_rolling_quantity(spark: SparkSession, sf_dir: str) -> DataFrame:
    topics = {"positions": (catalog.position_messages(spark, sf_dir), _rows_per_file())}
    made = live_messages(topics, jobs.running_quantities, "live-rolling", catalog.PARTITIONS, **TAKEN, **LIVE)
    return made.select(*catalog.ROLLED_COLUMNS)


def stream_message_rolling_quantity_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One key's stretches of time over several tasks."""
    topics = {"positions": (catalog.position_messages(spark, sf_dir), _rows_per_file())}
    options = {"slack_ms": 0, "bucket_ms": 5 * WINDOW_MS, "together": HELD_MS // (5 * WINDOW_MS), "shards": spread.SHARDS}
    made = live_messages(topics, jobs.running_quantities, "live-spread-total", catalog.PARTITIONS, **TAKEN, **options)
    return made.select(*catalog.ROLLED_COLUMNS)


def stream_message_symbol_quantity(spark: SparkSession, sf_dir: str) -> DataFrame:
    topics = {"orders": (catalog.order_messages(spark, sf_dir), _rows_per_file())}
    return codec.decode_symbol_positions(live_messages(topics, jobs.symbol_quantity_messages, "live-quantity", **TAKEN))


def stream_message_cusip_allocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    topics = {"orders": (catalog.order_messages(spark, sf_dir), _rows_per_file())}
    out = live_messages(topics, jobs.cusip_allocation_messages, "live-allocations", **TAKEN)
    return out.withColumns({c: F.col(c).cast("string") for c in ("key", "value")})


def _dealt(spark: SparkSession, sf_dir: str) -> str:
    """A folder with the events dealt over files in no order, for micro-batches that go back and forth."""
    folder = work_dir(spark, "dealt")
    events = fixtures.table(spark, sf_dir, "events")
    files = max(DEALT_FILES, -(-events.count() // ROWS_PER_FILE))
    events.repartition(files, F.xxhash64("event_id")).write.parquet(f"{folder}/events.parquet")
    return folder


def batches_price_enrich_act(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_price_enrich_act(spark, _dealt(spark, sf_dir))


def batches_price_enrich_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_price_enrich_list(spark, _dealt(spark, sf_dir))


def batches_price_timer_conflation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_price_timer_conflation(spark, _dealt(spark, sf_dir))


def batches_rolling_quantity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_rolling_quantity(spark, _dealt(spark, sf_dir))


STREAMS: dict[str, Query] = {
    f.__name__: f
    for f in (
        stream_mv_by_account_1m,
        stream_mv_by_symbol_1m,
        stream_price_enrich_list,
        stream_price_timer_conflation,
        stream_rolling_quantity,
        stream_position_window_sum_10s,
        stream_position_window_total,
        stream_symbol_quantity_10s,
        stream_cusip_allocations_10s,
        stream_price_enrich_act,
        stream_price_enrich_symbol,
        stream_chained_window_rollup,
        stream_word_count_5s,
        stream_message_mv_by_account,
        stream_message_mv_by_account_spread,
        stream_message_arrivals,
        stream_kafka_decode_dead_letters,
        stream_message_mv_by_symbol,
        stream_message_timer_conflation,
        stream_message_list_values,
        stream_message_rolling_quantity,
        stream_message_rolling_quantity_spread,
        stream_message_symbol_quantity,
        stream_message_cusip_allocations,
        batches_price_enrich_act,
        batches_price_enrich_list,
        batches_price_timer_conflation,
        batches_rolling_quantity,
    )
}
