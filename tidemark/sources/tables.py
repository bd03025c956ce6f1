"""Parquet tables in version folders: replaced as a whole, added to, or changed by partition.

A table is a folder of numbered versions; the newest complete one is the table.  A replacement
writes the next folder, so a query that reads the version before is not disturbed and a failed
write is ignored.  Appends and changed partitions go into the current folder by Spark's own append
and dynamic partition overwrite.  There is one writer at a time: commits between writers are the
business of a table format, which this is not.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Written into a version's folder when it is complete; holds its columns.
_SCHEMA = "_schema"


def _fs(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, folder: str) -> list[str]:
    path, fs = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []


def _exists(spark: SparkSession, name: str) -> bool:
    path, fs = _fs(spark, name)
    return fs.exists(path)


def remove(spark: SparkSession, name: str) -> None:
    path, fs = _fs(spark, name)
    fs.delete(path, True)


def versions(spark: SparkSession, root: str) -> list[str]:
    """Names of the version folders, oldest first, finished or not."""
    return [n for n in _names(spark, root) if n[:1] == "v" and n[1:].isdigit()]


def current(spark: SparkSession, root: str) -> str | None:
    """Name of the newest complete version."""
    return next((n for n in reversed(versions(spark, root)) if _exists(spark, f"{root}/{n}/{_SCHEMA}")), None)


def table_exists(spark: SparkSession, root: str) -> bool:
    return current(spark, root) is not None


def _schema(spark: SparkSession, folder: str) -> StructType:
    path, fs = _fs(spark, f"{folder}/{_SCHEMA}")
    stream = fs.open(path)
    try:
        return StructType.fromJson(json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
    finally:
        stream.close()


def load_table(spark: SparkSession, root: str, schema: StructType | str | None = None) -> DataFrame:
    """Current version of the table; an empty frame of ``schema`` if there is none."""
    version = current(spark, root)
    if version is None:
        if schema is None:
            raise FileNotFoundError(f"no complete version of {root}")
        return spark.createDataFrame([], schema)
    stored = _schema(spark, f"{root}/{version}")
    found = spark.read.schema(stored).parquet(f"{root}/{version}")
    wanted = spark.createDataFrame([], schema).columns if schema is not None else stored.names
    return found.select(*[f"`{c}`" for c in wanted])


def _spread(df: DataFrame, partition_by: tuple[str, ...]) -> DataFrame:
    """Few files for each partition, a large one split over tasks."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def save_table(df: DataFrame, root: str, mode: str = "replace", partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as the table's content and return the stored table.

    ``replace`` writes the next version, ``append`` adds files to the current one, ``partitions``
    replaces the partitions that ``df`` has rows of and leaves the files of the others, ``empty``
    replaces the content by no rows of the same schema.  ``df`` may read the table in every mode.
    """
    if mode not in ("replace", "append", "partitions", "empty"):
        raise ValueError(f"unknown mode {mode!r}")
    spark = df.sparkSession
    version = current(spark, root)
    if mode in ("append", "partitions") and version is not None:
        writer = _spread(df, partition_by).write.partitionBy(*partition_by)
        if mode == "append":
            writer.mode("append").parquet(f"{root}/{version}")
        else:
            writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(f"{root}/{version}")
        return load_table(spark, root, df.schema)
    taken = versions(spark, root)
    folder = f"{root}/v{int(taken[-1][1:]) + 1 if taken else 1:08d}"
    rows = df.limit(0) if mode == "empty" else _spread(df, partition_by)
    # a folder that another writer has begun is an error
    rows.write.partitionBy(*partition_by).parquet(folder)
    path, fs = _fs(spark, f"{folder}/{_SCHEMA}")
    stream = fs.create(path, True)
    stream.write(df.schema.json().encode())
    stream.close()
    return load_table(spark, root, df.schema)


def drop_partitions(spark: SparkSession, root: str, column: str, values: list) -> int:
    """Remove whole partitions of a table stored by ``column``; returns how many there were."""
    version = current(spark, root)
    wanted = {f"{column}={v if v is not None else '__HIVE_DEFAULT_PARTITION__'}" for v in values}
    found = [n for n in _names(spark, f"{root}/{version}") if n in wanted] if version else []
    for name in found:
        remove(spark, f"{root}/{version}/{name}")
    return len(found)


def touched(source: DataFrame, column: str) -> tuple[list, F.Column]:
    """Partitions that ``source`` has rows of, and the filter that reads these alone."""
    values = [r[0] for r in source.select(column).distinct().collect()]
    known = [v for v in values if v is not None]
    inside = F.col(column).isin(known)
    return values, inside | F.col(column).isNull() if len(known) < len(values) else inside


def drop_versions(spark: SparkSession, root: str, keep: int = 1) -> int:
    """Remove all but the newest ``keep`` complete versions, and what failed writes left before them.

    Call it when no query reads them any more; returns the number of folders removed.
    """
    found = versions(spark, root)
    complete = [n for n in found if _exists(spark, f"{root}/{n}/{_SCHEMA}")]
    old = [n for n in found if n < complete[-max(keep, 1) :][0]] if complete else []
    for name in old:
        remove(spark, f"{root}/{name}")
    return len(old)
