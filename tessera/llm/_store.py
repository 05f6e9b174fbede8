"""Lineage cuts and sizing shared by the operators of this package."""

from __future__ import annotations

import ctypes
import functools
import gc
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import checkpoint_dir

READ_ROWS = 512


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder, read back:
    computed once, readable from every executor, and not lost with one."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tessera-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, size: int = 8 << 20) -> None:
    """Arrow batches of at most ``size`` bytes (or one row), so that the
    memory of Python workers does not follow the longest texts. Parquet scans
    hold ``READ_ROWS`` rows at once: the texts of Spark's 4096 are arrays of
    many MB, for which the executors' heap grows and does not shrink again."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(READ_ROWS))


def text_bytes(docs: DataFrame, col: str = "text") -> int:
    """UTF-8 bytes of all texts (one aggregate; sizes blocks and parts)."""
    return docs.agg(F.sum(F.octet_length(F.col(f"`{col}`")).cast("long"))).first()[0] or 0


def safely_named(*own: str):
    """Decorator of ``fn(docs, ...)`` returning the columns of ``docs``: the
    function sees columns that are not its own under names without dots and
    without clashes; the result has the user's names again."""
    def wrap(fn):
        @functools.wraps(fn)
        def run(docs: DataFrame, *args, **kwargs) -> DataFrame:
            names = docs.columns
            safe = docs.toDF(*[c if c in own else f"extra{i}" for i, c in enumerate(names)])
            return fn(safe, *args, **kwargs).toDF(*names)
        return run
    return wrap


def frugal(run):
    """Decorator of a task over Arrow batches: freed memory goes back to the
    system at its end, so that idle workers do not hold it."""
    @functools.wraps(run)
    def task(batches):
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):  # not glibc
            pass
    return task
