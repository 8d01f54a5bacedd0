"""File and in-memory sources."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelane import schemas


def spread(df: DataFrame) -> DataFrame:
    """Spread a scan of fewer splits than cores over all cores; leave any other as it is.

    For heavy row-wise work on few files. A large input has more splits than cores, so it is
    never shuffled by this.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def keyed_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """Message frame of ``key:{json}`` lines; the first colon parts key and value.

    Lines without a colon are messages without a key.
    """
    return keyed_json(spark.read.text(path))


def keyed_json_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    return keyed_json(text_stream(spark, path, files_per_batch).withColumnRenamed("text", "value"))


def keyed_json(lines: DataFrame) -> DataFrame:
    at = F.instr("value", ":")
    keyed = (at > 0) & ~F.col("value").startswith("{")
    return lines.where(F.trim("value") != "").select(
        F.when(keyed, F.substr("value", F.lit(1), at - 1)).cast("binary").alias("key"),
        F.when(keyed, F.substr(F.col("value"), at + 1)).otherwise(F.col("value")).cast("binary").alias("value"),
    )


def tbill_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header-less rates: a date and three numbers."""
    return spark.read.schema(schemas.TBILL).option("mode", "FAILFAST").csv(path)


def from_rows(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """A small in-memory collection; its order becomes ``ord``."""
    numbered = [(i, *row) for i, row in enumerate(rows)]
    return spark.createDataFrame(numbered, f"ord BIGINT, {schema}")


def text_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Lines of text files as they appear, with the time they were read as ``ts``.

    It stands in for a line socket, which cannot be replayed after a failure.
    """
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path).select(
        F.col("value").alias("text"), F.current_timestamp().alias("ts")
    )


def parquet_stream(
    spark: SparkSession, path: str, schema: str | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """Rows of parquet files as they appear; without a schema, that of the files present."""
    reader = spark.readStream.schema(schema or spark.read.parquet(path).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)
