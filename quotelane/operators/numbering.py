"""One dense arrival number for rows that are ordered by several columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotelane.session import work_dir


def numbered(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Number all rows from 0 along ``order`` without sorting them in one task.

    Rows are range-partitioned and written, numbered within their range and shifted by the number
    of rows in the ranges before. The driver sees one count per range.
    """
    spark = df.sparkSession
    path = work_dir(spark, "numbered")
    ranged = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    ranged.write.parquet(path)
    ranged = spark.read.schema(ranged.schema).parquet(path)
    shifts, before = [], 0
    for row in sorted(ranged.groupBy("_range").count().collect()):
        shifts.append((row["_range"], before))
        before += row["count"]
    shift = F.broadcast(spark.createDataFrame(shifts, "_range int, _shift bigint"))  # a row per range
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return (
        ranged.join(shift, "_range")
        .withColumn(name, (F.col("_shift") + within - 1).cast("bigint"))
        .drop("_range", "_shift")
    )
