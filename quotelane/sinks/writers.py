"""Stream sinks: message topics as files, log, console, memory."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

LEVELS = ("TRACE", "DEBUG", "INFO", "ERROR")


def file_writer(rows: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> DataStreamWriter:
    """Each row exactly once, in files."""
    return (
        rows.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint)
    )


def routed_writer(rows: DataFrame, route: str, path: str, checkpoint: str) -> DataStreamWriter:
    """Each row exactly once, in the folder under ``path`` that its ``route`` column names: one query, many sinks.

    Readers take ``path`` and ask for a route, which reads its folder alone.
    """
    return file_writer(rows, path, checkpoint).partitionBy(route)


def log_frame(rows: DataFrame, marker: str, level: str = "INFO") -> DataFrame:
    """Marker, level and the row as text."""
    if level not in LEVELS:
        raise ValueError(f"level must be one of {sorted(LEVELS)}")
    text = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})
    return rows.select(F.lit(marker).alias("marker"), F.lit(level).alias("level"), text.alias("value"))


def log_writer(
    rows: DataFrame, marker: str, path: str, checkpoint: str, level: str = "INFO"
) -> DataStreamWriter:
    """A log line for every row, exactly once, in text files under ``path``: level, then the marker.

    ``marker`` may hold ``{}`` where the row goes; otherwise the marker alone is logged. Lines are
    written by the tasks that hold the rows, whatever the level.
    """
    before, hole, after = marker.partition("{}")
    text = F.concat(F.lit(f"{level} {before}"), F.col("value") if hole else F.lit(""), F.lit(after))
    return file_writer(log_frame(rows, marker, level).select(text.alias("line")), path, checkpoint, "text")


def print_writer(rows: DataFrame, checkpoint: str, out=None) -> DataStreamWriter:
    """Print every row of each micro-batch, one line each, as JSON.

    The driver fetches a micro-batch partition by partition.
    """

    def show(batch: DataFrame, number: int) -> None:
        for row in batch.toJSON().toLocalIterator():
            print(row, file=out)

    return rows.writeStream.foreachBatch(show).option("checkpointLocation", checkpoint)


def collecting_writer(rows: DataFrame, name: str) -> DataStreamWriter:
    """Collect rows in a table of the driver's memory; for tests on small inputs."""
    return rows.writeStream.format("memory").queryName(name)
