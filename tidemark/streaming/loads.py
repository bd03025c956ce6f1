"""Incoming files loaded once each: file streams as load history, for every feed.

A file stream remembers which files it has read, as a warehouse load history does, and
``availableNow`` makes it a batch that ends.  Each batch is a partition of the table it loads into,
named by the stream and the batch's number: a batch that is repeated, because the run stopped
between the write and the stream's own commit, overwrites what it wrote and adds nothing.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans import bidstream, pixel
from tidemark.sources import files as f
from tidemark.sources.warehouse import LOAD, SCHEMAS, Warehouse


def _same(batch: DataFrame) -> DataFrame:
    return batch


def _as_record(batch: DataFrame) -> DataFrame:
    return batch.select(F.struct(*batch.columns).alias("pixel_record"))


@dataclass(frozen=True)
class Feed:
    """Files of one table.

    A broken row stops the load, and its files stay unread; of a feed with ``whole`` files, those
    that hold one are left out.  ``full`` files replace the table instead of adding to it.
    """

    format: str
    schema: str
    options: dict[str, str] = field(default_factory=dict)
    shape: Callable[[DataFrame], DataFrame] = _same
    whole: bool = False
    full: bool = False


_CSV = {"header": "true"}
FEEDS: dict[str, Feed] = {
    "bid/log": Feed("parquet", SCHEMAS["bid/log"]),
    "pixel/raw": Feed("json", f.PIXEL_RECORD, shape=_as_record),
    "page/scrape_output": Feed("json", f.SCRAPE_RESULT, {"pathGlobFilter": "*.json"}),
    "page/title_output_cache": Feed("json", f.TITLE_OUTPUT),
    "page/topic_output_cache": Feed("json", f.TOPIC_OUTPUT),
    "email/clicks": Feed("csv", f.CLICKS, _CSV),
    "email/opens": Feed("csv", f.OPENS, _CSV),
    "lead/cache": Feed("csv", f.LEADS, whole=True),
    "vendor/ip_ranges_raw": Feed("csv", f.IP_RANGES, _CSV, full=True),
}


def load_new_files(files: DataFrame, checkpoint: str, apply: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Run ``apply`` on the rows of files not seen under this checkpoint, then stop."""
    return (
        files.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """Id that a stream keeps as long as its checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def load_feed(w: Warehouse, table: str, path: str, checkpoint: str | None = None) -> None:
    """Load the files of ``path`` that ``table`` has not loaded yet.

    The load history is kept in ``checkpoint``, by default below the warehouse's root.
    """
    feed, spark = FEEDS[table], w.spark
    checkpoint = checkpoint or w.path(f"_loads/{table}")
    if feed.whole:
        files = f.marked_rows(spark.readStream, path, feed.schema)
    else:
        reader = spark.readStream.format(feed.format).schema(feed.schema).options(**feed.options)
        files = (reader if feed.format == "parquet" else reader.option("mode", "FAILFAST")).load(path)
    if feed.full:
        files = files.withColumn("__time", F.col("_metadata.file_modification_time")).withColumn("__file", F.col("_metadata.file_path"))

    def apply(batch: DataFrame, batch_id: int) -> None:
        if feed.full:
            # the newest of the new files is the table
            newest = batch.agg(F.max(F.struct("__time", "__file"))).scalar()
            rows = batch.filter(F.struct("__time", "__file") == newest)
            if not rows.isEmpty():
                w.replace(table, rows.drop("__time", "__file"))
            return
        rows = feed.shape(f.whole_files(batch) if feed.whole else batch)
        w.append(table, rows, f"{_stream_id(spark, checkpoint)}-{batch_id}")

    load_new_files(files, checkpoint, apply).awaitTermination()


def stream_bid_log(
    spark: SparkSession, path: str, w: Warehouse, checkpoint: str, cut: dt.datetime, table: str = "bid/user_activity"
) -> StreamingQuery:
    """New bid-log files rolled up and merged into the user activity.

    The merge inserts what the table lacks, so a repeated batch inserts nothing.
    """
    files = spark.readStream.schema(SCHEMAS["bid/log"]).parquet(path)

    def apply(batch: DataFrame, batch_id: int) -> None:
        w.insert(table, bidstream.user_activity_merge, bidstream.user_activity_rollup(batch, cut))

    return load_new_files(files, checkpoint, apply)


def add_pixel_batch(w: Warehouse, raw: DataFrame, load: str) -> None:
    """Views of a batch of pixel records into the view counts; a repeated load changes nothing."""
    w.append("pixel/views", pixel.pixel_views(raw), load)
    fresh = w.loads("pixel/views").filter(F.col(LOAD) == load)
    fold_views(w, fresh)


def fold_views(w: Warehouse, fresh: DataFrame) -> DataFrame:
    """The pixel activity of the days that ``fresh`` has, made anew from all loads."""
    counted = pixel.views_of_loads(w.loads("pixel/views").filter(w.touching(fresh, "date")), LOAD)
    return w.merge("pixel/user_activity", lambda _, views: views, counted)


def stream_pixel(spark: SparkSession, path: str, w: Warehouse, checkpoint: str) -> StreamingQuery:
    """New pixel files added to the view counts."""
    files = spark.readStream.schema(f.PIXEL_RECORD).json(path)

    def apply(batch: DataFrame, batch_id: int) -> None:
        add_pixel_batch(w, _as_record(batch), f"{_stream_id(spark, checkpoint)}-{batch_id}")

    return load_new_files(files, checkpoint, apply)
