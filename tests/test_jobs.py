"""Messages in, messages out; and the stream queries where files are not in row order."""

import datetime
import io
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

import __spark_entry__ as contract
from quotelane import fixtures, schemas
from quotelane.operators import codec, projection
from quotelane.plans import catalog, jobs, streams
from quotelane.sinks import writers
from quotelane.sources import files
from quotelane.streaming import replay
from tests.compare import connect, difference

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


class _Dropped(StreamingQueryListener):
    def __init__(self):
        self.rows = []

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        self.rows.extend(s.numRowsDroppedByWatermark for s in event.progress.stateOperators)

    def onQueryTerminated(self, event):
        pass


def _watched(spark, run):
    watch = _Dropped()
    spark.streams.addListener(watch)
    try:
        return run(), watch.rows
    finally:
        spark.streams.removeListener(watch)


@pytest.mark.parametrize("by_symbol", [False, True])
def test_live_leg_loses_nothing(spark, by_symbol):
    """Prices come in one file, positions in five: no row is late, and the values are the batch's."""
    make = jobs.symbol_value_messages if by_symbol else jobs.account_value_messages
    decode = codec.decode_symbol_positions if by_symbol else codec.decode_positions
    positions, prices = catalog.position_messages(spark, SF, by_symbol), catalog.price_messages(spark, SF)
    topics = {"positions": (positions, 170), "prices": (prices, 10_000)}
    got, dropped = _watched(spark, lambda: _rows(decode(streams.live_messages(topics, make, "test"))))
    assert got == _rows(decode(make(positions, prices))) and got
    assert dropped and not any(dropped)


def test_partitions_one_after_another(spark, tmp_path, monkeypatch):
    """Each partition of the position topic comes whole before the next: a clock for each loses nothing."""
    positions, prices = catalog.position_messages(spark, SF), catalog.price_messages(spark, SF)

    def by_partition(messages, path, rows_per_file):
        for p in range(catalog.PARTITIONS):
            messages.where(F.col("partition") == p).coalesce(1).write.mode("append").parquet(path)

    monkeypatch.setattr(streams, "_topic_files", by_partition)
    topics = {"positions": (positions, 0), "prices": (prices, 0)}
    make = jobs.account_value_messages
    got, dropped = _watched(
        spark, lambda: _rows(codec.decode_positions(streams.live_messages(topics, make, "test", catalog.PARTITIONS, **streams.LIVE)))
    )
    assert got == _rows(codec.decode_positions(make(positions, prices))) and len(got) == 136
    assert dropped and not any(dropped)


def test_compliance_messages(spark):
    out = jobs.compliance_messages(catalog.position_messages(spark, SF))
    assert out.count() == fixtures.positions(spark, SF).count()
    assert {r.topic for r in out.select("topic").distinct().collect()} == {"out"}


def test_messages_are_taken_in_order(spark):
    """Offsets past a power of two, and partitions past 63, of one millisecond."""
    at = datetime.datetime(2024, 1, 1)
    value = '{"timestamp": 1, "account": "A", "subAccount": "S", "cusip": "X", "quantity": %d, "price": 0, "marketValue": 0, "orderId": "%d"}'
    places = [(p, o) for p in (0, 1, 64) for o in (8190, 8191, 8192, 8193)]
    rows = [(b"k", (value % (i, i)).encode(), "t", p, o, at) for i, (p, o) in enumerate(places)]
    price = [(b"", b'{"timestamp": 1, "id": "p", "cusip": "X", "price": 2, "effectiveDateTime": 1}', "t", 9, 1, at)]
    positions, prices = (spark.createDataFrame(r, schemas.MESSAGE) for r in (rows[::-1], price))
    events = jobs.leg_events(positions, prices, schemas.POSITION, ("quantity",))
    assert [r["quantity"] for r in events.orderBy("ord").collect()] == [*range(12), None]
    assert sorted(r["ord"] for r in events.collect()) == list(range(13))


def test_an_absent_message_fails(spark):
    messages = spark.createDataFrame([(None,)], "value BINARY")
    with pytest.raises(Exception, match="no value"):
        codec.decode_positions(messages).collect()
    good, bad = codec.decode_split(messages, schemas.POSITION)
    assert (good.count(), bad.count()) == (0, 1)


def test_in_memory_demo(spark):
    """Three positions of one account, rolled up, then three prices."""
    schema = "account STRING, subAccount STRING, cusip STRING, quantity INT, timestamp BIGINT"
    positions = files.from_rows(spark, [("AC1", "SB1", "CUSIP1", q, q) for q in (100, 200, 300)], schema)
    prices = files.from_rows(spark, [("CUSIP1", p, 1000) for p in (5, 15, 25)], "cusip STRING, price INT, timestamp BIGINT")
    first = jobs.rolled_then_priced(positions, prices.withColumn("ord", F.col("ord") + 100))
    assert _rows(first.select("quantity", "price")) == [(600, 5.0)]
    second = jobs.rolled_then_priced(positions.withColumn("ord", F.col("ord") + 100), prices)
    assert _rows(second.select("quantity", "price")) == [(100, 25.0), (300, 25.0), (600, 25.0)]


def test_word_count_job(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("to be or not to be\n")
    query = jobs.start_word_count(spark, str(tmp_path / "in"), str(tmp_path / "checkpoint"))
    query.processAllAvailable()
    query.stop()
    assert query.exception() is None


def test_every_row_is_printed_and_logged(spark, tmp_path):
    spark.range(50).write.parquet(str(tmp_path / "in"))
    rows = spark.readStream.schema("id BIGINT").parquet(str(tmp_path / "in"))
    out = io.StringIO()
    for writer in (
        writers.print_writer(rows, str(tmp_path / "c1"), out),
        writers.log_writer(rows, "saw {}.", str(tmp_path / "log"), str(tmp_path / "c2")),
    ):
        writer.trigger(availableNow=True).start().awaitTermination()
    assert len(out.getvalue().splitlines()) == 50
    lines = {r[0] for r in spark.read.text(str(tmp_path / "log")).collect()}
    assert lines == {f'INFO saw {{"id":{i}}}.' for i in range(50)}


@pytest.mark.parametrize(
    "name",
    ["batches_price_enrich_act", "stream_message_timer_conflation", "stream_message_mv_by_account_spread",
     "stream_message_rolling_quantity_spread", "stream_kafka_decode_dead_letters", "stream_message_cusip_allocations"],
)
def test_registered_streams_in_a_plain_session(spark, monkeypatch, name):
    """The session's own state store can't run them; they set the one they need and put the other back."""
    monkeypatch.setattr(streams, "ROWS_PER_FILE", 400)
    key = "spark.sql.streaming.stateStore.providerClass"
    before, plain = spark.conf.get(key), "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    spark.conf.set(key, plain)
    try:
        ours = contract.queries()[name](spark, SF).toPandas()
        assert spark.conf.get(key) == plain
    finally:
        spark.conf.set(key, before)
    assert difference(ours, connect(SF).execute(contract.oracle_sql()[name]).df()) is None


def test_a_topic_is_made_once(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    rows = spark.range(600, numPartitions=2).selectExpr("id", "timestamp_millis(id) AS timestamp")
    streams._topic_files(rows.mapInArrow(counted, rows.schema), str(tmp_path / "topic"), 100)
    assert made.value == 600
    assert spark.read.parquet(str(tmp_path / "topic")).select("_metadata.file_path").distinct().count() >= 5


def test_a_micro_batch_takes_several_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(streams, "work_dir", lambda spark, label: str(tmp_path / "work"))
    monkeypatch.setattr(streams, "ROWS_PER_FILE", 400)
    got = streams.stream_message_rolling_quantity(spark, SF)
    assert _rows(got) == _rows(catalog.message_rolling_quantity(spark, SF))
    topic = spark.read.parquet(str(tmp_path / "work" / "positions")).select("_metadata.file_path").distinct().count()
    commits = [p for p in (tmp_path / "work" / "checkpoint" / "commits").iterdir() if p.name.isdigit()]
    assert topic > 10 and len(commits) < topic / 2


def test_arrivals_have_several_files_a_partition(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(streams, "work_dir", lambda spark, label: str(tmp_path / "work"))
    monkeypatch.setattr(streams, "ROWS_PER_FILE", 400)
    got = streams.stream_message_arrivals(spark, SF)
    assert _rows(got) == _rows(catalog.message_arrivals(spark, SF))
    rows = spark.read.parquet(str(tmp_path / "work" / "positions")).groupBy("_metadata.file_path").count()
    assert max(r["count"] for r in rows.collect()) < 100


def test_an_order_message_is_parsed_once(spark):
    orders = catalog.order_messages(spark, SF)
    plan = jobs.symbol_quantity_messages(orders.localCheckpoint())._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


def test_orders_without_allocations_give_no_positions(spark):
    orders = spark.createDataFrame(
        [(1, "C", "BUY", [("A", "S", 3), None, ("B", "S", 4)]), (2, "C", "SELL", []), (3, "C", "SELL", None)],
        "timestamp BIGINT, cusip STRING, buySell STRING, allocations ARRAY<STRUCT<account: STRING, subAccount: STRING, quantity: INT>>",
    )
    found = [(r.timestamp, r.account, r.quantity) for r in projection.split_orders(orders).collect()]
    assert found == [(1, "A", 3), (1, None, None), (1, "B", 4)]


def test_a_replay_has_no_empty_micro_batch_before_its_end(spark, tmp_path, monkeypatch):
    """Rows, the closing row, and what that closes: each micro-batch opens all of the state."""
    monkeypatch.setattr(replay, "work_dir", lambda spark, label: str(tmp_path))
    assert streams.stream_symbol_quantity_10s(spark, SF).count() == catalog.symbol_quantity_10s(spark, SF).count()
    assert len([f for f in (tmp_path / "checkpoint" / "commits").iterdir() if f.name.isdigit()]) == 3
    assert spark.conf.get("spark.sql.streaming.noDataMicroBatches.enabled") == "true"
    assert spark.conf.get("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", None) is None


def test_disorder_is_measured_partition_by_partition(spark, tmp_path):
    rows = spark.createDataFrame([(0, 100), (1, 5)], "partition INT, at BIGINT")
    dated = set()
    for p in (0, 1):
        rows.where(f"partition = {p}").coalesce(1).write.mode("append").parquet(str(tmp_path / "t"))
        for f in set((tmp_path / "t").glob("*.parquet")) - dated:
            os.utime(f, (1_700_000_000 + p, 1_700_000_000 + p))
            dated.add(f)
    given = spark.read.parquet(str(tmp_path / "t"))
    assert (replay.disorder(given, "at"), replay.disorder(given, "at", "partition")) == (95, 0)
