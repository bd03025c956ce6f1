"""Helpers of the training-data operators: stored steps and columns by name."""

from __future__ import annotations

import ctypes
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Folders written by this session, newest last.
_STEPS: list[str] = []


#: Rows that Spark hands to Python at a time, and their bytes, about.
BATCH_ROWS, BATCH_BYTES = 2_000, 32 << 20


def small_batches(spark: SparkSession) -> SparkSession:
    """Keeps the batches that go to Python small, as texts may be long; returns the session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder that the driver and all executors see.

    The cluster names it in ``spark.checkpoint.dir``.  On a single machine, where that may be unset,
    a folder in the warehouse serves; elsewhere the warehouse may be local too, so that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return configured or f"{spark.conf.get('spark.sql.warehouse.dir')}/_steps"


def stored(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it again: cuts the lineage."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _STEPS.append(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._stored_at = path
    return back


def drop_step(df: DataFrame) -> None:
    """Remove a stored step that nothing reads any more."""
    path = getattr(df, "_stored_at", None)
    if path:
        _delete(df.sparkSession, path)


def drop_steps(spark: SparkSession) -> int:
    """Remove all steps this session stored; call it once the results are written."""
    paths = list(_STEPS)
    for path in paths:
        _delete(spark, path)
    return len(paths)


def _delete(spark: SparkSession, path: str) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(conf).delete(at, True)
    if path in _STEPS:
        _STEPS.remove(path)


def release(spark: SparkSession) -> None:
    """Let go of what finished steps hold in the driver, and of their shuffle files.

    Spark drops broadcast tables and shuffles when the driver's JVM collects their handles, and a heap
    that is left to itself grows to its limit first.  A loop of many jobs calls this once a round.
    """
    spark.sparkContext._jvm.System.gc()


def position(df: DataFrame, name: str) -> int:
    """Index of a column by exact name, else by name without case; the first one if it repeats."""
    names = df.columns
    for same in (lambda n: n == name, lambda n: n.lower() == name.lower()):
        at = [k for k, n in enumerate(names) if same(n)]
        if at:
            return at[0]
    raise ValueError(f"no column {name!r} among {names}")


def pick(df: DataFrame, **wanted: str) -> DataFrame:
    """Select columns as ``new=old``; works though the table has repeated or clashing names."""
    flat = df.toDF(*[f"__in{k}" for k in range(len(df.columns))])
    return flat.select(*[F.col(f"__in{position(df, old)}").alias(new) for new, old in wanted.items()])


def numbered(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """``df`` with positional column names that clash with nothing, and its own names."""
    names = df.columns
    return df.toDF(*[f"__in{k}" for k in range(len(names))]), names


def named(df: DataFrame, names: list[str]) -> DataFrame:
    """Undo ``numbered``: the original columns under their own names."""
    return df.select(*[F.col(f"__in{k}") for k in range(len(names))]).toDF(*names)


def row_key(doc_id: Column, text: Column) -> Column:
    """Key of a document that every scan computes alike: 64 bits of its id and text."""
    return F.xxhash64(doc_id.isNull(), doc_id, text.isNull(), text)


#: What this worker process has built for the operator it runs, by key.
_STATE: dict = {}


def worker_state(key, make):
    """``make()``, kept by the worker until another key is asked for: tables and caches of one
    operator at a time."""
    if key not in _STATE:
        _STATE.clear()
        _STATE[key] = make()
    return _STATE[key]


def give_back() -> None:
    """Hand memory that this process has freed back to the system, where its C library can."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def rows_of(batches: Iterator[pa.RecordBatch], most: int = 1024) -> Iterator[pa.RecordBatch]:
    """Batches cut into pieces, so that a task holds few rows at a time as Python objects.

    Workers live on after a task; what it has freed goes back to the system at its end.
    """
    pa.set_memory_pool(pa.system_memory_pool())
    for batch in batches:
        for k in range(0, batch.num_rows, most):
            yield batch.slice(k, most)
    give_back()
