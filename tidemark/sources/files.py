"""Readers for the incoming files and the writer for model batches.

Schemas are declared; nothing is inferred at read time.  A broken record stops a load; only
lead files are left out whole instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.operators import ordered_limit

PIXEL_RECORD = "userId string, ip string, date string, userAgent string, thirdPartyId string"
SCRAPE_RESULT = (
    "url string, statuscode string, title string, body string, contenttype string, image string, lang string"
)
CLICKS = "cam_id string, domain string, time timestamp, link string"
OPENS = "cam_id string, domain string, time timestamp"
LEADS = (
    "file_date date, category string, domain string, company string, entity_trigger string, "
    "seniority string, entity_function string, trigger_type string, industry string, "
    "company_size string, city string, state string, country string, score int"
)
IP_RANGES = (
    "ip_range_start string, ip_range_end string, pulseplus_country string, pulseplus_region string, "
    "pulseplus_city string, pulseplus_metro_code bigint, pulseplus_postal_code string, "
    "pulseplus_country_conf bigint, pulseplus_region_conf bigint, pulseplus_city_conf bigint, "
    "pulseplus_postal_conf bigint, isp_name string, homebiz_type string, company_name string, "
    "domain_name string"
)
TITLE_OUTPUT = (
    "page_url string, page_title string, payload struct<url_type:string,activity_type:string,"
    "information_type:string,topics:string>"
)
TOPIC_OUTPUT = (
    "page_url string, content string, payload array<struct<parentCategory:string,category:string,"
    "topic:string,probability:string>>"
)


def pixel_load(spark: SparkSession, path: str) -> DataFrame:
    """Web-pixel JSON lines as one struct column."""
    raw = spark.read.schema(PIXEL_RECORD).option("mode", "FAILFAST").json(path)
    return raw.select(F.struct(*raw.columns).alias("pixel_record"))


def scrape_load(spark: SparkSession, path: str) -> DataFrame:
    """Scraper JSON records from the ``.json`` files of a directory."""
    return spark.read.schema(SCRAPE_RESULT).option("mode", "FAILFAST").option("pathGlobFilter", "*.json").json(path)


def model_output_load(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Result records of the title or topic model."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def email_load(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Campaign clicks or opens."""
    return spark.read.schema(schema).option("mode", "FAILFAST").option("header", "true").csv(path)


def marked_rows(reader, path: str, schema: str) -> DataFrame:
    """Rows of CSV files with their broken text, ``__bad``, and file; ``reader`` is a batch or stream reader."""
    declared = StructType.fromDDL(schema)
    rows = (
        reader.schema(StructType([*declared.fields, StructField("__bad", StringType())]))
        .option("header", "true")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "__bad")
        .csv(path)
    )
    # folders named like partitions add columns that the schema does not have
    return rows.select(*declared.names, "__bad", F.col("_metadata.file_path").alias("__file"))


def lead_load(spark: SparkSession, path: str, schema: str = LEADS) -> DataFrame:
    """Lead files, leaving out every file that holds a broken row."""
    return whole_files(marked_rows(spark.read, path, schema))


def whole_files(rows: DataFrame) -> DataFrame:
    """The rows of files without a broken one, of rows as ``marked_rows`` gives them.

    Broken rows are counted per file in one pass and the files removed by name,
    so nothing is collected and nothing cached.  The count touches every column:
    the reader only checks columns that a query uses.
    """
    names = [c for c in rows.columns if c not in ("__bad", "__file")]
    parsed = F.length(F.concat_ws("", *[F.col(c).cast("string") for c in names])) >= 0
    per_file = rows.groupBy("__file").agg(F.count(F.when(F.col("__bad").isNotNull() & parsed, 1)).alias("__n_bad"))
    broken = per_file.filter(F.col("__n_bad") > 0).select("__file")
    return rows.join(broken, "__file", "left_anti").select(*names)


def ip_range_load(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """The IP-range file.  A gzip file is read by one task, so spread the rows after it."""
    rows = spark.read.schema(IP_RANGES).option("mode", "FAILFAST").option("header", "true").csv(path)
    return rows.repartition(partitions) if partitions else rows


def model_batch(cache: DataFrame, columns: Sequence[str], limit: int, key: str = "page_url") -> DataFrame:
    """Oldest ``limit`` rows of a model's input cache, with the chosen columns."""
    return ordered_limit(cache, limit, "date_inserted", key, descending=False).select(*columns)


def by_bytes(rows: DataFrame, most: int) -> DataFrame:
    """``rows`` with the number of the file each one goes to, ``file``: none larger than ``most`` bytes.

    A row's size is that of its JSON line.  Sums run inside each partition, so nothing is ordered
    across them.  Rows up to half the limit fill files by half limits of their running sum, so the last
    one cannot pass the limit; each larger row is a file of its own, above the limit if it alone is.
    """
    sized = rows.select(
        "*", (F.octet_length(F.to_json(F.struct(*rows.columns))) + 1).cast("long").alias("__bytes"),
        F.spark_partition_id().alias("__part"), F.monotonically_increasing_id().alias("__at"),
    )
    half = max(most // 2, 1)
    large = F.col("__bytes") > half
    before = F.sum(F.when(large, 0).otherwise(F.col("__bytes"))).over(
        Window.partitionBy("__part").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    )
    small_file = F.concat_ws("-", "__part", F.expr(f"coalesce(__before, 0) div {half}"))
    named = sized.withColumn("__before", before)
    return named.select(
        *rows.columns, F.when(large, F.concat_ws("-", F.lit("row"), "__at")).otherwise(small_file).alias("file")
    )


def model_batch_export(
    cache: DataFrame, columns: Sequence[str], path: str, limit: int, max_records_per_file: int,
    max_bytes_per_file: int | None = None,
) -> bool:
    """Write a model batch; False when there was nothing to write.

    With ``max_bytes_per_file`` each file is in a folder ``file=…`` below ``path``, as ``by_bytes`` names it.
    """
    if cache.isEmpty():
        return False
    writer = model_batch(cache, columns, limit)
    if max_bytes_per_file is not None:
        writer = by_bytes(writer, max_bytes_per_file)
    out = writer.write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file)
    (out if max_bytes_per_file is None else out.partitionBy("file")).json(path)
    return True
