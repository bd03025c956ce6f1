"""The pipelines' tables: names, schemas, and where they are stored."""

from __future__ import annotations

import contextlib
import hashlib
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import apply_changes, delete_matching
from tidemark.sources.tables import _exists, _names, current, drop_partitions, load_table, remove, save_table, touched

_LOCATION = (
    "normalized_country_code string, normalized_region_code string, normalized_city_name string, normalized_zip string"
)
_TOPICS = "array<struct<parentCategory:string,category:string,topic:string,probability:string>>"
_USER_ACTIVITY = (
    "page_url string, publisher_domain_normalized string, user_id string, user_ip string, date date, "
    "bw_country_normalized string, bw_region_normalized string, bw_city_normalized string, bw_zip_normalized string, pageviews bigint"
)
_COMPANY_ACTIVITY = (
    f"page_url string, normalized_company_domain string, date date, {_LOCATION}, publisher_domain_normalized string, "
    "pageviews bigint, weighted_pageviews double, unique_devices bigint, unique_ips bigint"
)
_URLS = (
    "page_url string, page_url_hash bigint, publisher_domain_normalized string, first_seen date, last_seen date, frequency bigint"
)
_IP_LOCATION = f"ip string, date_updated date, {_LOCATION}"
_PRESCORING = (
    f"normalized_company_domain string, parent_category string, category string, topic string, {_LOCATION}, date date, "
    "pageviews bigint, weighted_pageviews double, avg_page_relevance double, activity_type_score double, "
    "information_type_score double, review_pageviews bigint, unique_pages bigint, unique_pubs bigint, unique_devices bigint, unique_ips bigint"
)
_RESULTS = (
    "page_url string, result string, title string, content string, last_scraped date, content_type string, image string, "
    "language string, cleaned_content string, cleaned_title string"
)
_LOOKUP = "user_ip string, last_response_code int, last_query_date date, api_response string"
_SCORES = (
    f"score_date date, normalized_company_domain string, parent_category string, category string, topic string, {_LOCATION}, "
    "volume double, recency double, variety double, context double, week_over_week_trend double, month_over_month_trend double, intent_score double"
)
_LEADS = (
    "file_date date, category string, domain string, company string, entity_trigger string, seniority string, entity_function string, "
    "trigger_type string, industry string, company_size string, city string, state string, country string, score int"
)
_EMAIL_TOPIC = "parent_category string, category string, topic string"

SCHEMAS: dict[str, str] = {
    # bid stream
    "bid/log": "page_url string, domain string, user_id string, ip_address string, bid_time timestamp, geo_country string, geo_region string, geo_zip string",
    "bid/user_activity_cache": _USER_ACTIVITY,
    "bid/user_activity": _USER_ACTIVITY,
    "bid/ip_location_cache": _IP_LOCATION,
    "bid/ip_location": _IP_LOCATION,
    "bid/device_ip_cache": "bitoid string, ip string, date date",
    "bid/ip_resolvable_domains": "normalized_company_domain string, date date",
    "bid/company_activity_cache": _COMPANY_ACTIVITY,
    "bid/company_activity": _COMPANY_ACTIVITY,
    "bid/prescoring_cache": _PRESCORING,
    "bid/prescoring": _PRESCORING,
    "bid/unique_urls_cache": _URLS,
    "bid/unique_urls": _URLS,
    # shared maps and lists
    "maps/ip_location": _IP_LOCATION,
    "maps/ip_domain_obs": "ip string, normalized_company_domain string, source string, source_confidence double, date date",
    "maps/ip_domain": "ip string, normalized_company_domain string, score double",
    "maps/ip_trio": "ip_trio string, normalized_company_domain string, score double",
    "maps/device_ip_obs": "bitoid string, ip string, source string, date date",
    "maps/device_domain_obs": "bitoid string, normalized_company_domain string, source string, source_confidence double, date date",
    "maps/device_domain": "bitoid string, normalized_company_domain string, score double",
    "maps/geos": _LOCATION,
    "maps/isp_domains": "domain string",
    "maps/shared_domains": "domain string",
    "maps/bad_publishers": "publisher_domain_normalized string",
    "maps/country_iso": "isocode_2 string, isocode_3 string",
    "maps/regions": "region_name string, region_isocode_2 string",
    # vendor files
    "vendor/ip_ranges_raw": (
        "ip_range_start string, ip_range_end string, pulseplus_country string, pulseplus_region string, pulseplus_city string, "
        "pulseplus_metro_code bigint, pulseplus_postal_code string, pulseplus_country_conf bigint, pulseplus_region_conf bigint, "
        "pulseplus_city_conf bigint, pulseplus_postal_conf bigint, isp_name string, homebiz_type string, company_name string, domain_name string"
    ),
    "vendor/ip_ranges": (
        f"date_updated date, ip_range_start string, ip_range_start_numeric bigint, ip_range_end string, ip_range_end_numeric bigint, {_LOCATION}, "
        "metro_code bigint, country_confidence bigint, region_confidence bigint, city_confidence bigint, postal_confidence bigint, "
        "isp_name string, homebiz_type string, company_name string, normalized_company_domain string"
    ),
    "vendor/ip_companies": "ip_address string, company_domain string, company_domain_array string, distribution_percentage double",
    "lead/cache": _LEADS,
    "lead/leads": _LEADS,
    "lead/topic_map": "leadsift_category string, ds_parent_category string, ds_category string, ds_topic string",
    "lead/prescoring": f"date date, {_EMAIL_TOPIC}, normalized_company_domain string, leadsift_score int",
    # pixel
    "pixel/raw": "pixel_record struct<userId:string,ip:string,date:string,userAgent:string,thirdPartyId:string>",
    # what each load added to the activity
    "pixel/views": "client_id string, user_ip string, date date, user_agent string, site_url string, pageviews bigint",
    "pixel/user_activity": "client_id string, user_ip string, date date, user_agent string, site_url string, pageviews bigint",
    "pixel/unique_urls": _URLS,
    "pixel/company_activity_cache": _COMPANY_ACTIVITY,
    "pixel/company_activity": _COMPANY_ACTIVITY,
    "pixel/prescoring_cache": _PRESCORING,
    "pixel/prescoring": _PRESCORING,
    # lookups
    "lookup/input": "user_ip string",
    "lookup/output_raw": _LOOKUP,
    "lookup/success": _LOOKUP,
    "lookup/output": _LOOKUP,
    "lookup/mappings": _LOOKUP,
    "lookup/locations": _IP_LOCATION,
    # e-mail
    "email/clicks": "cam_id string, domain string, time timestamp, link string",
    "email/opens": "cam_id string, domain string, time timestamp",
    "email/company_clicks": "cam_id string, normalized_company_domain string, date date, page_url string, frequency bigint",
    "email/company_opens": "cam_id string, normalized_company_domain string, date date, frequency bigint",
    "email/unique_urls": _URLS,
    "email/campaign_content": "cam_id string, page_url string",
    "email/campaign_topics": f"cam_id string, {_EMAIL_TOPIC}, proportion double",
    "email/prescoring": f"normalized_company_domain string, date date, {_EMAIL_TOPIC}, weighted_opens double, weighted_clicks double",
    # pages
    "page/queue": "page_url string, date_inserted date, date_pushed date",
    "page/scrape_output": "url string, statuscode string, title string, body string, contenttype string, image string, lang string",
    "page/results_cache": _RESULTS,
    "page/results": _RESULTS,
    "page/ngrams": "page_url string, ngrams array<string>",
    "page/topic_brands": "parent_category string, category string, original_topic string, brands array<string>, domains array<string>",
    "page/reference_topics": f"parent_category string, category string, original_topic string, brand string, domain string, brand_topics {_TOPICS}",
    "page/brand_list": "brand string, domain string",
    "page/brands": f"page_url string, ngrams array<string>, brand_topics {_TOPICS}, date_classified date",
    "page/title_input": "page_url string, page_title string, date_inserted date",
    "page/title_output_cache": (
        "page_url string, page_title string, payload struct<url_type:string,activity_type:string,information_type:string,topics:string>"
    ),
    "page/titles": "page_url string, page_title string, url_type string, activity_type string, information_type string, topics string, date_classified date",
    "page/topic_input": "page_url string, title_plus_content string, date_inserted date",
    "page/topic_output_cache": f"page_url string, content string, payload {_TOPICS}",
    "page/topics": f"page_url string, content string, intent_topics {_TOPICS}, date_classified date",
    "page/context": "page_url string, page_title string, context struct<`review/comparison`:int>, date_classified date",
    # scores
    "score/input": (
        f"normalized_company_domain string, parent_category string, category string, topic string, {_LOCATION}, date date, pageviews bigint, "
        "weighted_pageviews double, avg_page_relevance double, activity_type_score double, information_type_score double, "
        "review_pageviews bigint, unique_pages bigint, unique_pubs bigint, moving_avg_weighted_pageviews double, moving_stddev_weighted_pageviews double"
    ),
    "score/output": _SCORES,
    "score/history": _SCORES,
    "score/days": "score_date date",
}


#: Tables stored by day, and the day's column: a run reads and writes the days it touches.
BY_DAY = {
    "bid/user_activity_cache": "date",
    "bid/user_activity": "date",
    "bid/company_activity_cache": "date",
    "bid/company_activity": "date",
    "bid/prescoring_cache": "date",
    "bid/prescoring": "date",
    "maps/device_ip_obs": "date",
    "maps/device_domain_obs": "date",
    "pixel/views": "date",
    "pixel/user_activity": "date",
    "pixel/company_activity_cache": "date",
    "pixel/company_activity": "date",
    "pixel/prescoring_cache": "date",
    "pixel/prescoring": "date",
    "score/history": "score_date",
}

#: Cumulative tables without a day in their key, and that key: bucketed by it, and parted by its hash.
BY_KEY = {
    "bid/ip_location": "ip",
    "maps/ip_location": "ip",
    "maps/ip_domain_obs": "ip",
    "bid/unique_urls": "page_url",
    "pixel/unique_urls": "page_url",
    "lookup/output": "user_ip",
    "lookup/mappings": "user_ip",
    "page/results": "page_url",
    "page/titles": "page_url",
    "page/topics": "page_url",
    "page/context": "page_url",
}

#: Tables that loads add to: a load has a partition of its own, which its repetition overwrites.
BY_LOAD = (
    "bid/log", "bid/user_activity_cache", "pixel/raw", "pixel/views", "lead/cache", "email/clicks", "email/opens", "page/scrape_output",
    "page/title_output_cache", "page/topic_output_cache", "lookup/success", "lookup/locations", "vendor/ip_ranges_raw",
)
LOAD, SLOT = "__load", "__slot"


class Warehouse:
    """Tables under one root folder, each stored by day, by key, by load, or as a whole.

    ``slots`` partitions and ``buckets`` buckets are what a new table by key gets; one that exists
    keeps its own.  A merge reads and overwrites only the partitions that its source touches, and
    in tables by key joins the stored buckets as they are.  A frame read before a partition was
    overwritten may miss its files: read again after a merge.
    """

    def __init__(self, spark: SparkSession, root: str, *, slots: int = 32, buckets: int = 32):
        self.spark, self.root, self.slots, self.buckets = spark, root.rstrip("/"), slots, buckets

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def version(self, name: str) -> str:
        """Name of the current version, empty before the first write; not of a table by key."""
        return current(self.spark, self.path(name)) or ""

    def read(self, name: str) -> DataFrame:
        """Current content, empty before the first write."""
        if name in BY_KEY:
            return self._keyed(name).select(*self._columns(name))
        return load_table(self.spark, self.path(name), SCHEMAS[name])

    def shaped(self, name: str, df: DataFrame) -> DataFrame:
        """Columns in the declared order and types."""
        declared = self.spark.createDataFrame([], SCHEMAS[name])
        return df.select(*[df[c].cast(declared.schema[c].dataType).alias(c) for c in declared.columns])

    def _columns(self, name: str) -> list[str]:
        return self.spark.createDataFrame([], SCHEMAS[name]).columns

    # -- tables by day, by load, or as a whole ----------------------------------------------------

    def _by(self, name: str) -> tuple[str, ...]:
        load, day = (LOAD,) if name in BY_LOAD else (), (BY_DAY[name],) if name in BY_DAY else ()
        return load + day

    def _save(self, name: str, df: DataFrame, mode: str, load: str = "all") -> DataFrame:
        rows = self.shaped(name, df)
        if name in BY_LOAD:
            rows = rows.withColumn(LOAD, F.lit(load))
        return save_table(rows, self.path(name), mode, self._by(name)).select(*self._columns(name))

    def replace(self, name: str, df: DataFrame) -> DataFrame:
        """``df`` as the next version."""
        if name in BY_KEY:
            self._write_keyed(name, df, "replace")
            return self.read(name)
        return self._save(name, df, "replace")

    def append(self, name: str, df: DataFrame, load: str | None = None) -> DataFrame:
        """The table and ``df``.

        In tables by load, ``load`` names the partition: a repeated load overwrites what it wrote.
        """
        if name in BY_LOAD and load is not None:
            return self._save(name, df, "partitions", load)
        if name in BY_KEY:
            raise ValueError(f"{name} is stored by key: use insert or merge")
        return self._save(name, df, "append")

    def empty(self, *names: str) -> None:
        """No rows left."""
        for name in names:
            self.replace(name, self.spark.createDataFrame([], SCHEMAS[name]))

    # -- tables by key ----------------------------------------------------------------------------

    def _slot(self, key: Column, slots: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(slots)).cast("int")

    def _versions(self, name: str) -> list[tuple[int, int, int]]:
        """Number, partitions and buckets of the versions, which their folders name; oldest first."""
        found = [n[1:].replace(".", "x").split("x") for n in _names(self.spark, self.path(name)) if n[:1] == "v"]
        return sorted((int(n), int(slots), int(buckets)) for n, slots, buckets in found)

    def _folder(self, name: str, version: tuple[int, int, int]) -> str:
        return f"{self.path(name)}/v{version[0]:08d}.{version[1]}x{version[2]}"

    def _layout(self, name: str) -> tuple[int, int, int]:
        """The newest complete version, or the first one that would be written."""
        for version in reversed(self._versions(name)):
            if _exists(self.spark, f"{self._folder(name, version)}/_SUCCESS"):
                return version
        return 0, self.slots, self.buckets

    def _table(self, name: str, version: tuple[int, int, int] | None = None) -> str:
        """Name under which this session's catalog has the table; made known if it is not."""
        version = version or self._layout(name)
        folder, buckets = self._folder(name, version), version[2]
        table = f"tidemark_{hashlib.md5(folder.encode()).hexdigest()[:20]}"
        key = BY_KEY[name]
        # files are listed rather than kept by the catalog, so other sessions' partitions are seen
        with self._setting("spark.sql.hive.manageFilesourcePartitions", "false"):
            self.spark.sql(
                f"create table if not exists {table} ({SCHEMAS[name]}, {SLOT} int) using parquet partitioned by ({SLOT}) "
                f"clustered by ({key}) sorted by ({key}) into {buckets} buckets location '{folder}'"
            )
        return table

    @contextlib.contextmanager
    def _setting(self, key: str, value: str) -> Iterator[None]:
        before = self.spark.conf.get(key, None)
        self.spark.conf.set(key, value)
        try:
            yield
        finally:
            self.spark.conf.unset(key) if before is None else self.spark.conf.set(key, before)

    def _keyed(self, name: str) -> DataFrame:
        table = self._table(name)
        self.spark.catalog.refreshTable(table)
        return self.spark.table(table)

    def _write_keyed(self, name: str, df: DataFrame, mode: str) -> None:
        """``replace`` writes the next version, ``dynamic`` the slots that ``df`` has rows of, ``append`` adds."""
        key, version = BY_KEY[name], self._layout(name)
        # the first write makes the first version, whatever it is
        mode = mode if version[0] else "replace"
        if mode == "replace":
            taken = self._versions(name)
            version = (taken[-1][0] + 1 if taken else 1, *version[1:])
        _, slots, buckets = version
        # one task for each bucket, as in the stored table, so no task writes parts of many buckets
        rows = self.shaped(name, df).withColumn(SLOT, self._slot(F.col(key), slots)).repartition(buckets, key)
        # only a write of the whole folder leaves the mark of a complete version
        with self._setting("spark.sql.sources.partitionOverwriteMode", "static" if mode == "replace" else "dynamic"):
            rows.write.mode("append" if mode == "append" else "overwrite").insertInto(self._table(name, version))

    # -- changes of the partitions that a source touches -------------------------------------------

    def _part(self, name: str, source: DataFrame, column: str | None) -> tuple[DataFrame, str]:
        """``source`` with the partition of each row, and that column's name."""
        if name in BY_KEY:
            slots = self._layout(name)[1]
            return source.withColumn(SLOT, self._slot(F.col(column or BY_KEY[name]), slots)), SLOT
        if name in BY_LOAD or name not in BY_DAY:
            raise ValueError(f"{name} is not stored by day or key")
        day = BY_DAY[name]
        return (source.withColumn(day, F.col(column)) if column else source), day

    def touching(self, source: DataFrame, column: str) -> Column:
        """Filter for the values of ``column`` that ``source`` has."""
        return touched(source, column)[1]

    def part_of(self, name: str, source: DataFrame, column: str | None = None) -> DataFrame:
        """The table's rows of the partitions that ``source`` has rows of, read from their files only.

        ``column`` is the source's column with the table's key or day, if it has another name there.
        """
        marked, part = self._part(name, source, column)
        _, inside = touched(marked, part)
        whole = self._keyed(name) if name in BY_KEY else load_table(self.spark, self.path(name), SCHEMAS[name])
        return whole.filter(inside).select(*self._columns(name))

    def insert(self, name: str, merge: Callable[..., DataFrame], source: DataFrame, *more, column: str | None = None) -> DataFrame:
        """An insert-only merge: new rows are added, no stored file is written again.

        ``merge`` is called with the touched part of the table, ``source``, ``more`` and
        ``only_new=True``; a row of the source only ever matches rows of its own key or day.
        """
        fresh = merge(self.part_of(name, source, column), source, *more, only_new=True)
        if name in BY_KEY:
            self._write_keyed(name, fresh, "append")
        else:
            self._save(name, fresh, "append")
        return self.read(name)

    def merge(self, name: str, merge: Callable[..., DataFrame], source: DataFrame, *more, column: str | None = None, **options) -> DataFrame:
        """A merge with updates: the touched partitions are overwritten, the others stay as they are.

        ``merge`` returns the next content of the touched part and never moves a row to another.
        """
        changed = merge(self.part_of(name, source, column), source, *more, **options)
        if name in BY_KEY:
            self._write_keyed(name, changed, "dynamic")
        else:
            self._save(name, changed, "partitions")
        return self.read(name)

    def change(self, name: str, updates: DataFrame, inserts: DataFrame, keys: Sequence[str]) -> DataFrame:
        """Apply a ``change_set``: only partitions with a changed or new row are overwritten."""
        changed = updates.unionByName(inserts)
        if changed.isEmpty():
            return self.read(name)
        return self.merge(name, lambda part, _: apply_changes(part, updates, inserts, keys), changed)

    def delete(self, name: str, doomed: DataFrame, keys: Sequence[str], *, null_safe: Sequence[str] = ()) -> DataFrame:
        """Delete the rows whose keys occur in ``doomed``; partitions without such rows stay as they are."""
        if name in BY_LOAD:
            raise ValueError(f"{name} is stored by load")
        whole = self._keyed(name) if name in BY_KEY else load_table(self.spark, self.path(name), SCHEMAS[name])
        part = SLOT if name in BY_KEY else BY_DAY[name]
        on = [F.col(f"t.{k}").eqNullSafe(F.col(f"d.{k}")) if k in null_safe else F.col(f"t.{k}") == F.col(f"d.{k}") for k in keys]
        hit = whole.alias("t").join(doomed.select(*keys).alias("d"), on, "left_semi")
        values, inside = touched(hit, part)
        if not values:
            return self.read(name)
        rest = delete_matching(whole.filter(inside), doomed, keys, null_safe=null_safe)
        # a partition that loses all its rows is not in the result, so nothing would overwrite it
        left, _ = touched(rest, part)
        if name in BY_KEY:
            self._write_keyed(name, rest, "dynamic")
            for slot in set(values) - set(left):
                remove(self.spark, f"{self._folder(name, self._layout(name))}/{SLOT}={slot}")
        else:
            self._save(name, rest, "partitions")
            drop_partitions(self.spark, self.path(name), part, list(set(values) - set(left)))
        return self.read(name)

    def loads(self, name: str) -> DataFrame:
        """A table by load with the load of each row, as ``__load``."""
        if not self.version(name):
            return self.read(name).withColumn(LOAD, F.lit("all"))
        return load_table(self.spark, self.path(name)).select(*self._columns(name), LOAD)

    def drop_days(self, name: str, days: DataFrame) -> DataFrame:
        """Delete whole days of a table by day: their folders go, nothing is read or written."""
        values, _ = touched(days.withColumnRenamed(days.columns[0], BY_DAY[name]), BY_DAY[name])
        known = [v for v in values if v is not None]
        loads = _names(self.spark, f"{self.path(name)}/{self.version(name)}") if name in BY_LOAD else [""]
        for load in loads:
            if load == "" or load.startswith(f"{LOAD}="):
                for day in known:
                    remove(self.spark, "/".join(x for x in (self.path(name), self.version(name), load, f"{BY_DAY[name]}={day}") if x))
        return self.read(name)
