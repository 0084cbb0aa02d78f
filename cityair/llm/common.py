"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import sys
import time
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cityair.sources.sinks import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def landed(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    reclaim(spark)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.landed_at = path
    return out


def reclaim(spark: SparkSession, rounds: int = 1) -> None:
    """Let the driver's cleaner drop the shuffle files of finished steps (those
    that nothing refers to any more) before the next step writes its own. What
    the step before has just released takes a second round."""
    for i in range(rounds):
        if i:
            time.sleep(0.5)
        gc.collect()
        spark.sparkContext._jvm.System.gc()


def discard(*tables: DataFrame) -> None:
    """Delete landed tables that no later step reads."""
    for df in tables:
        spark = df.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df.landed_at)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1024):
    """Jobs started within send at most ``rows`` rows a batch to Python, which
    bounds a batch of long texts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def trim() -> None:
    """In a task: give memory that is free back to the system. Python workers
    live on from stage to stage and otherwise keep what a stage's largest chunk
    took, beside what the next stage takes."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def once(key, build):
    """``build()``, made once a process. Functions travel to tasks by value, with
    the module globals they use: a table kept in such a global would travel with
    them, and be a task's own. What is kept here stays in the process."""
    kept = sys.__dict__.setdefault("_cityair_kept", {})
    if key not in kept:
        kept[key] = build()
    return kept[key]


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def unused(columns, name: str) -> str:
    """A column name that does not clash with ``columns``."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def mix64(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """splitmix64 finaliser over a uint64 array."""
    with np.errstate(over="ignore"):
        x = x + U64((0x9E3779B97F4A7C15 * (2 * salt + 1)) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


def unit(x: np.ndarray, salt: int) -> np.ndarray:
    """Uniform numbers in (0, 1) drawn from hashed keys."""
    return ((mix64(x, salt) >> U64(11)).astype(np.float64) + 0.5) * 2.0 ** -53


__all__ = ["F", "WORD", "U64", "table", "landed", "discard", "reclaim", "once",
           "small_batches", "trim", "shuffle_partitions", "unused", "mix64", "unit"]
