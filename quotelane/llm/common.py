"""Helpers shared by the operators: tables, intermediate results, global order."""

from __future__ import annotations

import ctypes
import math
import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelane.session import work_dir

WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


ARROW_ROWS = 1000
_ARROW_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def written(df: DataFrame, label: str, light: bool = False, release: bool = False) -> DataFrame:
    """Write an intermediate result to the shared folder and read it back, which cuts its lineage.

    Rows that hold texts or packed lists go to Python a thousand at a time, which bounds a batch.
    ``light`` is for rows of a few numbers: they go to a few files per core of the cluster.
    ``release`` is for results of large shuffles: Spark removes shuffle files once the driver has
    collected the plans that made them, so it is asked to.
    """
    spark = df.sparkSession
    path = work_dir(spark, label)
    if light:
        df = df.coalesce(4 * spark.sparkContext.defaultParallelism)
    before = spark.conf.get(_ARROW_SETTING)
    spark.conf.set(_ARROW_SETTING, str(ARROW_ROWS))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_ARROW_SETTING, before)
    if release:
        spark.sparkContext._jvm.System.gc()
    found = spark.read.schema(df.schema).parquet(path)
    found._written_to = path
    return found


def discard(*frames: DataFrame) -> None:
    """Delete intermediate results once all that was made of them is written too.

    Nothing may need them again, not even after an executor is lost.
    """
    for df in frames:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._written_to)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def word_count(text: Column) -> Column:
    """Words of a text as a long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def positive(number: int | None) -> int:
    return max(1, int(number or 0))


def pieces(total: int | None, each: int) -> int:
    """How many pieces of about ``each`` a total makes; grows with the input, at least 1."""
    return max(1, math.ceil((total or 0) / each))


def worker_state(key: str, make: Callable[[], object]) -> object:
    """An object made once per Python worker and kept between its tasks."""
    home = sys.modules.setdefault("_quotelane_worker_state", types.ModuleType("_quotelane_worker_state"))
    if not hasattr(home, key):
        setattr(home, key, make())
    return getattr(home, key)


# Groups below so many bytes leave little behind.
LARGE_GROUP = 4 << 20


def _give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """The same over batches; at the end of a task, what it has freed goes back to the system.

    Python workers outlive their tasks, and what their allocators keep counts against the executor.
    """

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        _give_back()

    return tidied


def tidy_group(run: Callable[[pa.Table], pa.Table]):
    """The same for a group of rows."""

    def tidied(table: pa.Table) -> pa.Table:
        found, size = run(table), table.nbytes
        del table
        if size >= LARGE_GROUP:
            _give_back()
        return found

    return tidied
