"""Run a streaming plan over given tables to its end and return what it wrote."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quotelane import fixtures
from quotelane.session import small_disk, stream_settings, work_dir
from quotelane.sinks.writers import file_writer
from quotelane.streaming.legs import with_periodic_watermark

# A micro-batch takes about this much input, which bounds what a task holds of one key.
BYTES_PER_BATCH = 256 << 20
# Where a table is put in order first, its files have about this much.
BYTES_PER_FILE = 16 << 20
# How far past the last row the closing row lies, in row numbers.
CLOSING_GAP = 1_000_000


def disorder(rows: DataFrame, number: str, *apart: str) -> int:
    """How far the files, oldest first, go back in ``number``; files of one age may come in any order. Rows that differ
    in ``apart`` are looked at apart."""
    age = F.unix_millis("_metadata.file_modification_time")
    ranges = rows.groupBy(*apart, age.alias("at"), F.col("_metadata.file_path").alias("path")).agg(
        F.min(number).alias("lo"), F.max(number).alias("hi")
    )
    # one row per file
    older = F.max("hi").over(Window.partitionBy(*apart).orderBy("at").rangeBetween(Window.unboundedPreceding, -1))
    together = Window.partitionBy(*apart, "at")
    beside = F.when(F.count("*").over(together) > 1, F.max("hi").over(together))
    back = ranges.select((F.greatest(older, beside) - F.col("lo")).alias("back")).agg(F.max("back")).first()[0]
    return max(0, back or 0)


def _table_stream(spark: SparkSession, path: str, copied: bool = False) -> DataFrame:
    """Stream of a table's files in micro-batches of bounded size. Files that are copies go once they are through."""
    given = spark.read.parquet(path)
    # a brace pattern, since a stream does not take the plain path of a single file
    folder, name = path.rsplit("/", 1)
    reader = spark.readStream.schema(given.schema).option("maxBytesPerTrigger", BYTES_PER_BATCH)
    if copied:
        reader = reader.option("cleanSource", "delete")
    return reader.parquet(f"{folder}/{{{name}}}")


def _ranged(spark: SparkSession, path: str, number: str, to: str) -> str:
    """The table's rows in files by ranges of ``number``, or its own path if it is one such file. The files are written
    about in order, so they go back by as many as are written at a time, however the table's own files lie."""
    given = spark.read.parquet(path)
    sizes = given.select("_metadata.file_path", "_metadata.file_size").distinct().agg(F.sum("file_size"))
    files = -(-(sizes.first()[0] or 0) // BYTES_PER_FILE)
    if files < 2:
        return path
    with small_disk(spark):
        given.repartitionByRange(files, number).sortWithinPartitions(number).write.option("compression", "zstd").parquet(to)
    return to


def state_parts(spark: SparkSession, rows: DataFrame) -> int:
    """The session's number of shuffle partitions, or fewer: as many as there are cores on inputs of fewer splits, two a
    core on others, so that few large keys meet in one. A micro-batch opens and commits every partition, however
    little it brings."""
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cores = spark.sparkContext.defaultParallelism
    return min(wanted, cores if rows.rdd.getNumPartitions() < cores else 2 * cores)


def _finish(spark: SparkSession, out: DataFrame, work: str, parts: int, small: bool, ends: bool = True) -> None:
    """Run to the end of what is there. ``small``: on less disk, at some more time for compression."""
    writer = file_writer(out, f"{work}/out", f"{work}/checkpoint")
    if small:
        writer = writer.option("compression", "zstd")
    with stream_settings(spark, parts, ends), small_disk(spark) if small else nullcontext():
        query = writer.trigger(availableNow=True).start()
    query.awaitTermination()


def _closing_row(given: DataFrame, number: str, last: int | None, past: int) -> DataFrame:
    """One row numbered far past the last, its texts empty and all else null."""
    row = given.sparkSession.range(1).select((F.lit(last) + past).cast(given.schema[number].dataType).alias(number))
    rest = {
        f.name: F.lit("" if f.dataType.simpleString() == "string" else None).cast(f.dataType)
        for f in given.schema
        if f.name != number
    }
    return row.select(number, *[v.alias(n) for n, v in rest.items()]).select(*given.columns)


def replay(
    spark: SparkSession,
    sf_dir: str,
    table: str,
    number: str,
    plan: Callable[[DataFrame, int], DataFrame],
    label: str,
    in_order: bool = False,
) -> DataFrame:
    """Stream ``table`` through ``plan`` into files, close what is open, read the files.

    ``plan`` takes the stream and how far its files go back in ``number``, which the watermark must lag
    behind: no row is late then, in whatever order the files are. After the table is through, one row
    numbered far past the last is added on a second input; its own window stays open. ``in_order``: rows are
    put in ranges first, so that state holds the windows of a few files, not of all files that lie in no order. What is
    written on the way is compressed more then, and the ranges' files and the shuffles' go as soon as they are read.
    """
    work = work_dir(spark, label)
    path = f"{sf_dir}/{table}.parquet"
    read = _ranged(spark, path, number, f"{work}/{table}.parquet") if in_order else path
    given = spark.read.parquet(read)
    back = disorder(given, number)
    last = given.agg(F.max(number)).first()[0]
    closing = f"{work}/closing"
    given.limit(0).write.parquet(closing)
    rows = _table_stream(spark, read, copied=read != path).unionByName(spark.readStream.schema(given.schema).parquet(closing))
    out = plan(rows, back)
    parts = state_parts(spark, given)
    _finish(spark, out, work, parts, in_order, ends=False)
    _closing_row(given, number, last, back + CLOSING_GAP).write.mode("append").parquet(closing)
    _finish(spark, out, work, parts, in_order)
    return spark.read.schema(out.schema).parquet(f"{work}/out")


def timed_ticks(events: DataFrame, back: int = 0) -> DataFrame:
    """Ticks of the event stream, its watermark behind by ``back`` events; one more, as the watermark's own
    time counts as passed."""
    return with_periodic_watermark(fixtures.ticks_from(events), (back + 1) * fixtures.STEP_MS if back else 0)
