import json
from types import SimpleNamespace

import pytest

from quotelane import schemas
from quotelane.operators import codec
from quotelane.session import work_dir
from quotelane.sinks import writers
from quotelane.sources import files, kafka


def _run(writer):
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


@pytest.fixture
def keyed_lines(tmp_path):
    path = tmp_path / "lines"
    path.mkdir()
    order = {"timestamp": 1, "orderId": "7", "cusip": "X", "buySell": "BUY", "allocations": [{"account": "A:1", "subAccount": "S", "quantity": 2}]}
    (path / "a.json").write_text(f"7:{json.dumps(order)}\n\n{json.dumps(order)}\n:{json.dumps(order)}\n")
    return str(path)


def test_keyed_json_lines(spark, keyed_lines):
    messages = files.keyed_json_lines(spark, keyed_lines)
    assert sorted(None if r.key is None else bytes(r.key) for r in messages.collect() if r.key is not None) == [b"", b"7"]
    decoded = codec.decode_orders(messages).collect()
    assert [r.allocations[0].account for r in decoded] == ["A:1"] * 3


def test_keyed_json_stream(spark, keyed_lines, tmp_path):
    decoded = codec.decode_orders(files.keyed_json_stream(spark, keyed_lines))
    _run(writers.file_writer(decoded, str(tmp_path / "out"), str(tmp_path / "cp")))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_tbill_csv(spark, tmp_path):
    """In the rates, a month's last row holds the month's mean."""
    path = tmp_path / "rates.csv"
    path.write_text("2020-01-02,1.0E-05,0.0,0.0\n2020-01-03,3.0E-05,2.0E-05,0.5\n")
    rows = files.tbill_csv(spark, str(path)).orderBy("date").collect()
    assert str(rows[0].date) == "2020-01-02"
    assert rows[1].monthly == pytest.approx((rows[0].daily + rows[1].daily) / 2)


def test_rows_are_numbered_in_order(spark):
    df = files.from_rows(spark, [("C", 100), ("C", 200), ("C", 300)], "cusip STRING, quantity INT")
    assert [(r.ord, r.quantity) for r in df.orderBy("ord").collect()] == [(0, 100), (1, 200), (2, 300)]


def test_text_stream_words(spark, tmp_path):
    source = tmp_path / "text"
    source.mkdir()
    (source / "a.txt").write_text("to be\n\nor not\n")
    lines = files.text_stream(spark, str(source))
    _run(writers.collecting_writer(lines, "text_lines").option("checkpointLocation", str(tmp_path / "cp")))
    assert sorted(r.text for r in spark.table("text_lines").collect()) == ["", "or not", "to be"]


def test_log_sink(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([("C", 1)], "cusip STRING, quantity INT")
    frame = writers.log_frame(rows, "**** {}", "ERROR")
    assert frame.first().asDict() == {"marker": "**** {}", "level": "ERROR", "value": '{"cusip":"C","quantity":1}'}
    with pytest.raises(ValueError):
        writers.log_frame(rows, "m", "LOUD")
    path = str(tmp_path / "in")
    rows.write.parquet(path)
    stream = spark.readStream.schema(rows.schema).parquet(path)
    query = _run(writers.log_writer(stream, "priced {}", str(tmp_path / "log"), str(tmp_path / "cp"), "INFO"))
    assert query.exception() is None


def test_print_sink(spark, tmp_path):
    rows = spark.createDataFrame([(1,)], "n INT")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    assert _run(writers.print_writer(stream, str(tmp_path / "cp"))).exception() is None


def test_topic_as_files(spark, tmp_path):
    """An encoded frame through the file sink, back through the stream decoder."""
    position = spark.createDataFrame([(9, "A", "S", "C", 2, 1.5, 3.0, "o")], schemas.POSITION)
    position.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(position.schema).parquet(str(tmp_path / "in"))
    messages = codec.encode_positions(stream)
    _run(writers.file_writer(messages, str(tmp_path / "topic"), str(tmp_path / "cp1")))
    back = codec.decode_positions(spark.readStream.schema(messages.schema).parquet(str(tmp_path / "topic")))
    _run(writers.file_writer(back, str(tmp_path / "out"), str(tmp_path / "cp2")))
    assert spark.read.schema(position.schema).parquet(str(tmp_path / "out")).first() == position.first()


def test_topic_options():
    assert kafka.source_options("host:9092", "price") == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "price",
        "startingOffsets": "latest",
        "failOnDataLoss": "true",
    }
    options = kafka.source_options("h", "t", "g", "earliest", 100, 10)
    assert options["kafka.group.id"] == "g"
    assert options["startingOffsets"] == "earliest"
    assert options["maxOffsetsPerTrigger"] == "100"
    assert options["maxRecordsPerPartition"] == "10"
    for call in (lambda: kafka.source_options("", "t"), lambda: kafka.sink_options("")):
        with pytest.raises(ValueError):
            call()


def test_spread_only_touches_small_scans(spark, tmp_path):
    path = str(tmp_path / "one")
    spark.range(100).coalesce(1).write.parquet(path)
    few = spark.read.parquet(path)
    assert files.spread(few).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(100).repartition(50)
    assert files.spread(many) is many


def test_work_folder_lies_in_the_shared_folder():
    def session(master, shared=None):
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda key, default=None: shared or default),
            sparkContext=SimpleNamespace(master=master),
        )

    first, second = (work_dir(session("spark://host", "s3a://bucket/work/"), "x") for _ in range(2))
    assert first.startswith("s3a://bucket/work/quotelane-x-") and first != second
    with pytest.raises(RuntimeError):
        work_dir(session("spark://host"), "x")
    assert work_dir(session("local[2]"), "x")


def test_a_partition_is_read_by_itself():
    options = kafka.source_options("host:9092", "price", partition=3)
    assert options["assign"] == '{"price": [3]}' and "subscribe" not in options
    assert kafka.source_options("host:9092", "price")["subscribe"] == "price"
