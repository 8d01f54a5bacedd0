"""Streaming forms against the batch forms, over several micro-batches."""

import os
import time

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from quotelane import fixtures, schemas
from quotelane.operators import codec, conflation, pricing, windows
from quotelane.plans import catalog, desk, jobs, streams
from quotelane.session import stream_settings
from quotelane.streaming import clock, counts, held, keyed, legs, replay, spread
from tests.compare import connect, difference

SF = "/root/testdata/sf0.001"
FILES = 4
seen_files: set = set()


def _date_new_files(folder, i):
    """Give the files just written to ``folder`` the i-th modification time."""
    for f in folder.iterdir():
        if f.suffix == ".parquet" and f not in seen_files:
            seen_files.add(f)
            os.utime(f, (1_700_000_000 + i, 1_700_000_000 + i))


@pytest.fixture(scope="module")
def cut_events(spark, tmp_path_factory):
    """The events in several files, oldest rows in the oldest file."""
    folder = tmp_path_factory.mktemp("events")
    events = spark.read.parquet(f"{SF}/events.parquet")
    n = events.count()
    target = folder / "events.parquet"
    for i in range(FILES):
        part = events.where((F.col("event_id") >= n * i // FILES) & (F.col("event_id") < n * (i + 1) // FILES))
        part.coalesce(1).write.mode("append").parquet(str(target))
        _date_new_files(target, i)
    return str(folder)


@pytest.fixture(autouse=True)
def small_batches(monkeypatch):
    monkeypatch.setattr(replay, "BYTES_PER_BATCH", 1)


def _same(a, b):
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    left = sorted(map(tuple, a.select(*columns).collect()), key=repr)
    right = sorted(map(tuple, b.select(*columns).collect()), key=repr)
    assert len(left) > 0
    assert left == right


@pytest.fixture(scope="module")
def dealt_events(spark, tmp_path_factory):
    """The events dealt over several files in no order."""
    folder = tmp_path_factory.mktemp("dealt")
    events = spark.read.parquet(f"{SF}/events.parquet")
    events.repartition(FILES, F.xxhash64("event_id")).write.parquet(str(folder / "events.parquet"))
    return str(folder)


def _stream(spark, folder, plan, cusips=fixtures.CUSIPS):
    def ticks(events, back):
        rows = fixtures.ticks_from(events, cusips)
        return plan(legs.with_periodic_watermark(rows, (back + 1) * fixtures.STEP_MS if back else 0))

    return replay.replay(spark, folder, "events", "event_id", ticks, "test")


def _positions(ticks):
    return ticks.where(F.col("kind") == "position").drop("kind", "price")


def _numbered(operator, **options):
    return lambda t: operator(t, order=held.NUMBERED, **options).drop("ts")


CASES = {
    "slot": (_numbered(held.price_single_slot), pricing.price_single_slot, None),
    "list": (_numbered(held.price_list_buffer), pricing.price_list_buffer, 8),
    # a short period and a security per user: most timers fire on keys without further rows
    "timer": (_numbered(held.price_timer_conflation, period_ms=3_000), lambda t: conflation.price_timer_conflation(t, period_ms=3_000), None),
    "long timer": (_numbered(held.price_timer_conflation), conflation.price_timer_conflation, 8),
    "rolling": (
        lambda t: held.rolling_quantity(_positions(t), held.NUMBERED).drop("ts"),
        lambda t: windows.rolling_quantity(_positions(t)).select(
            "account", "subAccount", "cusip", "ord", "timestamp", "quantity", "rollingQuantity"
        ),
        8,
    ),
}


def test_disorder_is_measured(spark, cut_events, dealt_events):
    given = spark.read.parquet(f"{cut_events}/events.parquet")
    assert replay.disorder(given, "event_id") == 0
    assert replay.disorder(given.withColumn("back", -F.col("event_id")), "back") > 0
    dealt = spark.read.parquet(f"{dealt_events}/events.parquet")
    span = dealt.agg(F.max("event_id") - F.min("event_id")).first()[0]
    assert 0 < replay.disorder(dealt, "event_id") <= span


def test_word_count_puts_files_in_order(spark, tmp_path, monkeypatch):
    """Files in no order and of one age: without ranges, no window closes before the last file."""
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    documents.repartition(16, F.xxhash64("doc_id")).write.parquet(str(tmp_path / "documents.parquet"))
    size = sum(f.stat().st_size for f in (tmp_path / "documents.parquet").glob("*.parquet"))
    monkeypatch.setattr(replay, "BYTES_PER_FILE", size // 16)
    lags, plain = [], legs.with_periodic_watermark
    monkeypatch.setattr(legs, "with_periodic_watermark", lambda rows, lag=0: lags.append(lag) or plain(rows, lag))
    _same(streams.stream_word_count_5s(spark, str(tmp_path)), catalog.word_count_5s(spark, SF))
    assert lags[0] < 1000 * documents.count() * 3 // 4


def test_word_count_state_is_smaller_than_the_text(spark, tmp_path, monkeypatch):
    """By rows, the state's change log alone is several times the text where most words stand once in their window."""
    word = lambda i: F.substring(F.md5((F.col("doc_id") * 200 + i).cast("string")), 1, 7)
    texts = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(199)), word), " ")
    documents = spark.range(1500).withColumnRenamed("id", "doc_id").withColumn("text", texts)
    documents.repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(replay, "work_dir", lambda spark, label: str(tmp_path / label))
    _same(streams.stream_word_count_5s(spark, str(tmp_path)), catalog.word_count_5s(spark, str(tmp_path)))
    state = sum(f.stat().st_size for f in (tmp_path / "words" / "checkpoint" / "state").rglob("*.changelog"))
    assert state < documents.agg(F.sum(F.length("text"))).first()[0]


def test_word_count_of_repeated_and_missing_numbers(spark, tmp_path, monkeypatch):
    """One window has most of the words, in many packets of many files; a document has no number, one no text."""
    monkeypatch.setattr(counts, "GATHERED", 50)
    rows = [(7, f"w{i} a  b{i % 9} a") for i in range(400)] + [(i, "a b\tc ") for i in range(700)]
    rows += [(None, "lost"), (3, None), (4, " "), (5, ""), (-20_000, "early")]
    documents = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    documents.repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    _same(streams.stream_word_count_5s(spark, str(tmp_path)), catalog.word_count_5s(spark, str(tmp_path)))


@pytest.mark.parametrize("layout", ["cut_events", "dealt_events"])
@pytest.mark.parametrize("case", list(CASES))
def test_held_rows_equal_batch(spark, request, layout, case):
    plan, batch, cusips = CASES[case]
    out = _stream(spark, request.getfixturevalue(layout), plan, cusips)
    _same(out, batch(fixtures.ticks(spark, SF, cusips)).drop("ts"))


def test_account_leg(spark, cut_events, dealt_events):
    batch = desk.account_leg(fixtures.ticks(spark, SF))
    _same(_stream(spark, cut_events, legs.account_leg), batch)
    _same(_stream(spark, dealt_events, lambda t: legs.account_leg(t, order=held.NUMBERED)), batch)


def test_one_security_over_many_tasks(spark, dealt_events):
    def plan(ticks):
        return spread.price_single_slot(ticks.withColumn("seq", spread.sequence("ord")), shards=5)

    for cusips in (8, None):
        out = _stream(spark, dealt_events, plan, cusips).drop("ts", "ord")
        _same(out, pricing.price_single_slot(fixtures.ticks(spark, SF, cusips)).drop("ts", "ord"))


def test_one_key_over_many_tasks_in_totals(spark, dealt_events):
    def plan(ticks):
        return spread.rolling_quantity(_positions(ticks.withColumn("seq", spread.sequence("ord"))), shards=3)

    out = _stream(spark, dealt_events, plan).drop("ts", "ord")
    batch = windows.rolling_quantity(fixtures.positions(spark, SF))
    _same(out, batch.select(*out.columns))


def test_state_of_few_securities_lies_in_many_tasks(spark, tmp_path, cut_events):
    """Eight securities, four parts each: the first step's state is in more than eight partitions."""
    ticks = fixtures.ticks(spark, SF)
    ticks.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = legs.with_periodic_watermark(spark.readStream.schema(ticks.schema).parquet(str(tmp_path / "in")))
    out = spread.price_single_slot(stream.withColumn("seq", spread.sequence("ord")), shards=4)
    with stream_settings(spark, 16):
        writer = out.writeStream.format("parquet").option("path", str(tmp_path / "out"))
        writer.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
        state = spark.read.format("statestore").option("stateVarName", "price").option("operatorId", 1).load(str(tmp_path / "c"))
        keys = {(r["key"]["cusip"], r["key"]["shard"]) for r in state.collect()}
        parts = {r["partition_id"] for r in state.collect()}
    assert len(keys) == 32 and len(parts) > 8


def test_clock_closes_windows_of_a_quiet_stream(spark, tmp_path):
    """Rows come once; the window goes out later, by the clock alone."""
    schema = "account STRING, subAccount STRING, cusip STRING, ord BIGINT, timestamp BIGINT, ts TIMESTAMP, quantity INT"
    rows = [("A", "S", "X", i, 1000 + i, None, 10 * i) for i in range(4)]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    out = clock.total(stream, width_ms=2_000)
    with stream_settings(spark, 2):
        query = (
            out.writeStream.format("memory").queryName("clocked").outputMode("append")
            .option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="500 milliseconds").start()
        )
    try:
        for _ in range(120):
            found = spark.table("clocked").collect()
            if found:
                break
            time.sleep(0.5)
    finally:
        query.stop()
    assert [(r["quantity"], r["late"], r["windowEnd"] - r["windowStart"]) for r in found] == [(60, False, 2_000)]


def test_late_messages_reach_a_route_of_their_own(spark):
    """Topic partitions one after another under one clock: what is not taken in order comes out as late."""
    rows = streams.routed_arrivals(spark, SF).collect()
    late = [r for r in rows if r["route"] == "late"]
    taken = [r for r in rows if r["route"] == "taken"]
    assert len(rows) == 1000 and len(late) > 100
    by_key = {}
    for r in sorted(taken, key=lambda r: (r["cusip"], r["ord"])):
        by_key.setdefault(r["cusip"], []).append((r["timestamp"], r["kind"], r["partition"], r["offset"]))
    assert all(order == sorted(order) for order in by_key.values())
    assert all(r["ord"] is None for r in late)


def test_account_leg_whose_late_messages_are_kept(spark, tmp_path):
    """Partitions in step: none is late, and two chained queries give what the leg gives."""
    topics = []
    for name, messages in (("positions", catalog.position_messages(spark, SF)), ("prices", catalog.price_messages(spark, SF))):
        path = str(tmp_path / name)
        messages.repartitionByRange(3, "timestamp").write.parquet(path)
        catalog.closing_messages(messages).coalesce(1).write.mode("append").parquet(path)
        topics.append(spark.readStream.schema(schemas.MESSAGE).parquet(path))
    for query in jobs.start_account_leg_with_late(spark, *topics, str(tmp_path), str(tmp_path / "c"), availableNow=True):
        query.awaitTermination()
    routes = spark.read.parquet(str(tmp_path / "routes"))
    assert routes.where("route = 'late'").count() == 0
    values = codec.decode_positions(spark.read.parquet(str(tmp_path / "values")))
    whole = catalog.message_mv_by_account(spark, SF)
    # the last windows stay open, as nothing follows them in the second query
    last = values.agg(F.max("timestamp")).first()[0]
    _same(values, whole.where(F.col("timestamp") <= last))
    latest = routes.agg(F.unix_millis(F.max("ts"))).first()[0]
    assert last == (latest - held.BUCKET_MS) // 60_000 * 60_000


ORDERED = {
    "slot": (keyed.price_single_slot, pricing.price_single_slot, pricing.slot_state),
    "list": (keyed.price_list_buffer, pricing.price_list_buffer, pricing.list_state),
    "timer": (keyed.price_timer_conflation, conflation.price_timer_conflation, conflation.timer_state),
}


@pytest.mark.parametrize("case", list(ORDERED))
def test_stream_goes_on_from_a_batch(spark, tmp_path, case):
    """Batch over the first part, live from its state over the rest: as batch over all."""
    live, batch, state = ORDERED[case]
    events = spark.read.parquet(f"{SF}/events.parquet")
    cut = events.count() * 2 // 5
    events.where(F.col("event_id") >= cut).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    first = fixtures.ticks_from(events.where(F.col("event_id") < cut))
    initial = spark.createDataFrame(state(first).collect(), state(first).schema)
    later = _stream(spark, str(tmp_path), lambda t: live(t, initial=initial)).drop("ts")
    done = batch(first)
    if case == "timer":  # what is armed at the cut fires in the stream
        latest = first.groupBy("cusip").agg(F.max("timestamp").alias("latest"))
        done = done.join(latest, "cusip").where(F.col("timestamp") <= F.col("latest")).drop("latest")
    _same(done.drop("ts").unionByName(later), batch(fixtures.ticks(spark, SF)).drop("ts"))


@pytest.mark.parametrize("lost", [False, True], ids=["stopped", "lost commit"])
def test_restart_at_every_micro_batch(spark, tmp_path, lost):
    """A query stopped after each micro-batch, or before the batch was committed, goes on as one that ran through."""
    source = tmp_path / "in"
    ticks = fixtures.ticks(spark, SF)
    rows = ticks.count()
    schema = ticks.schema
    for i in range(FILES):
        part = ticks.where((F.col("ord") >= rows * i // FILES) & (F.col("ord") < rows * (i + 1) // FILES))
        part.coalesce(1).write.mode("append").parquet(str(source))
        stream = legs.with_periodic_watermark(spark.readStream.schema(schema).parquet(str(source)))
        out = keyed.price_single_slot(stream)
        with stream_settings(spark):
            writer = out.writeStream.format("parquet").option("path", str(tmp_path / "out"))
            writer = writer.option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True)
            writer.start().awaitTermination()
        if lost:
            commits = sorted((tmp_path / "checkpoint/commits").glob("[0-9]*"), key=lambda f: int(f.name))
            commits[-1].unlink()
            (commits[-1].parent / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    _same(spark.read.parquet(str(tmp_path / "out")), pricing.price_single_slot(ticks))
    if lost:
        return
    # what the store holds is what a batch run says it must
    with stream_settings(spark):
        held_price, waiting = (
            {r["key"]["cusip"]: r["value"] for r in
             spark.read.format("statestore").option("stateVarName", name).load(str(tmp_path / "checkpoint")).collect()}
            for name in ("price", "waiting")
        )
    expected = {r["cusip"]: r for r in pricing.slot_state(ticks).collect()}
    assert {c: v["price"] for c, v in held_price.items()} == {c: r["price"] for c, r in expected.items() if r["kind"] == "price"}
    assert {c: v["orderId"] for c, v in waiting.items()} == {c: r["orderId"] for c, r in expected.items() if r["kind"] == "position"}


def test_rolling_quantity(spark, cut_events):
    out = _stream(spark, cut_events, lambda t: keyed.rolling_quantity(_positions(t)))
    batch = windows.rolling_quantity(fixtures.positions(spark, SF)).select(*out.columns)
    _same(out, batch)


def test_chained_windows(spark, cut_events):
    out = _stream(spark, cut_events, lambda t: desk.rolled_up_quantity(_positions(t)))
    _same(out, desk.rolled_up_quantity(fixtures.positions(spark, SF)))


def test_chained_allocation_lists(spark, cut_events):
    out = _stream(spark, cut_events, lambda t: desk.rolled_up_allocations(_positions(t)))
    _same(out, desk.rolled_up_allocations(fixtures.positions(spark, SF)))


def test_word_stream_equals_sql(spark):
    name = "stream_word_count_5s"
    ours = contract.queries()[name](spark, SF).toPandas()
    assert difference(ours, connect(SF).execute(contract.oracle_sql()[name]).df()) is None


def test_late_rows_are_dropped_by_the_watermark(spark, tmp_path):
    """A row behind a closed window is dropped; slack keeps it.

    A watermark moves after a micro-batch and tells late rows apart from the next but one on.
    """
    schema = "ts TIMESTAMP, quantity INT, cusip STRING"
    src = tmp_path / "in"
    batches_of_rows = (
        [("00:00:01", 1), ("00:01:00", 2)],
        [("00:01:01", 0)],
        [("00:00:02", 4)],
        [("00:05:00", 8)],
    )
    for i, rows in enumerate(batches_of_rows):
        spark.createDataFrame([(f"2024-01-01 {t}", q, "C") for t, q in rows], "t STRING, quantity INT, cusip STRING").select(
            F.col("t").cast("timestamp").alias("ts"), "quantity", "cusip"
        ).coalesce(1).write.mode("append").parquet(str(src))
        _date_new_files(src, i)
    totals = {}
    for slack in (0, 120_000):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(src))
        out = windows.symbol_quantity(legs.with_periodic_watermark(stream, slack))
        name = f"late_{slack}"
        query = (
            out.writeStream.format("memory").queryName(name).outputMode("append")
            .option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        totals[slack] = spark.table(name).agg(F.sum("quantity")).first()[0]
    assert totals == {0: 3, 120_000: 7}


def test_lagging_watermark_is_set(spark, cut_events):
    stream = spark.readStream.schema(spark.read.parquet(f"{cut_events}/events.parquet").schema).parquet(
        f"{cut_events}/events.parquet"
    )
    out = legs.with_lagging_watermark(fixtures.ticks_from(stream))
    assert "5 seconds" in out._jdf.queryExecution().analyzed().toString()


@pytest.mark.parametrize(("ttl_ms", "total"), [(None, 30), (3_600_000, 30), (1, 20)])
def test_state_may_expire(spark, tmp_path, ttl_ms, total):
    """Two positions of one account, each in a micro-batch of its own."""
    columns = "account STRING, subAccount STRING, cusip STRING, ord BIGINT, timestamp BIGINT, ts TIMESTAMP, quantity INT"
    (tmp_path / "in").mkdir()
    rows = spark.readStream.schema(columns).parquet(str(tmp_path / "in"))
    out = keyed.rolling_quantity(legs.with_periodic_watermark(rows), ttl_ms)
    query = out.writeStream.format("parquet").option("path", str(tmp_path / "out"))
    query = query.option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(once=True)
    for i, quantity in enumerate((10, 20)):
        row = spark.createDataFrame([("A", "S", "X", i, 1000 + i, None, quantity)], columns)
        row.withColumn("ts", F.timestamp_millis(F.col("timestamp"))).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        query.start().awaitTermination(60)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.where("ord = 1").first()["rollingQuantity"] == total
