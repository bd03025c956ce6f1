"""Web-pixel records: user activity, URLs, company activity, prescoring."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import domain_normalizer, to_day, url_host
from tidemark.operators import anti, delete_matching, upsert
from tidemark.plans import bidstream
from tidemark.plans.bidstream import ACTIVITY_KEYS, LOCATION
from tidemark.plans.enrichment import enrich_activity, pixel_rollup, prescoring_merge

# Fixed values
SLICE_DAYS = 15

MEASURES = ["pageviews", "weighted_pageviews", "unique_devices", "unique_ips"]
MERGE_NULL_SAFE = ["normalized_region_code", "normalized_city_name", "normalized_zip"]


def _publisher(url: str) -> Column:
    """Publisher of a URL, empty where it has none: a missing one would fall out of ``NOT IN``."""
    return F.coalesce(domain_normalizer(url_host(F.col(url))), F.lit(""))


def pixel_views(pixel_raw: DataFrame) -> DataFrame:
    """Views per client, address, day, browser and page.

    A forwarded address list counts for its first and its last address (once if
    they are the same).  Different lists with a common end are added up, so each
    key occurs once and the merge is unambiguous.
    """
    r = "pixel_record"
    rows = pixel_raw.groupBy(
        F.col(f"{r}.userId").alias("client_id"),
        F.col(f"{r}.ip").alias("ip"),
        to_day(F.col(f"{r}.date")).alias("date"),
        F.col(f"{r}.userAgent").alias("user_agent"),
        F.col(f"{r}.thirdPartyId").alias("site_url"),
    ).agg(F.count(F.lit(1)).alias("pageviews"))
    ends = F.array_distinct(
        F.array(
            F.split_part(F.col("ip"), F.lit(","), F.lit(-1)), F.split_part(F.col("ip"), F.lit(","), F.lit(1))
        )
    )
    return (
        rows.withColumn("user_ip", F.explode(ends))
        .groupBy("client_id", "user_ip", "date", "user_agent", "site_url")
        .agg(F.sum("pageviews").alias("pageviews"))
    )


def pixel_user_activity(target: DataFrame, pixel_raw: DataFrame) -> DataFrame:
    """New views added to the cumulative counts."""
    return add_views(target, pixel_views(pixel_raw))


def views_of_loads(views: DataFrame, load: str) -> DataFrame:
    """The cumulative counts of some days from what each load added to them.

    The same rows as merging load by load: a key with a NULL never matches, so it stays a row for
    each load (column ``load``).
    """
    keys = ["client_id", "user_ip", "date", "user_agent", "site_url"]
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    apart = F.when(missing, F.col(load)).alias("__apart")
    return views.groupBy(*keys, apart).agg(F.sum("pageviews").alias("pageviews")).drop("__apart")


def add_views(target: DataFrame, views: DataFrame) -> DataFrame:
    """Counted views (``pixel_views``) added to the cumulative counts."""
    return upsert(
        target,
        views,
        ["user_ip", "date", "user_agent", "site_url", "client_id"],
        {"pageviews": F.col("s.pageviews") + F.col("t.pageviews")},
        unique_source=True,
    )


def pixel_unique_urls(target: DataFrame, user_activity: DataFrame, *, co_located: bool = False) -> DataFrame:
    """URL statistics; last day and frequency are replaced.

    ``user_activity`` holds all views of its pages, as their numbers are replaced.
    """
    pages = user_activity.filter(F.length("site_url") > 1).select(
        F.col("site_url").alias("page_url"), _publisher("site_url").alias("publisher_domain_normalized"), "date"
    )
    return upsert(
        target, bidstream.url_stats(pages), ["page_url"], ["last_seen", "frequency"], unique_source=True,
        co_located=co_located,
    )


def pixel_scrape_queue(
    queue: DataFrame, urls: DataFrame, results: DataFrame, bad_pubs: DataFrame, as_of: dt.date
) -> DataFrame:
    """Queue all never-scraped URLs of publishers that are not suppressed."""
    fresh = anti(bidstream.never_scraped(urls, results), bad_pubs, "publisher_domain_normalized")
    return bidstream.enqueue(queue, fresh.select("page_url").distinct(), as_of)


def pixel_ip_domain_obs(
    target: DataFrame, user_activity: DataFrame, ip_ranges: DataFrame, *, only_new: bool = False
) -> DataFrame:
    """New (address, company) observations from the range file; IPv6 is left out."""
    v4 = user_activity.filter(~F.col("user_ip").contains(":"))
    return bidstream.ip_domain_obs_from_ranges(target, v4, ip_ranges, only_new=only_new)


def pixel_company_rollup(activity: DataFrame, ip_domain: DataFrame, ip_location: DataFrame) -> DataFrame:
    """Page activity per company, day and location, for addresses with both maps."""
    rows = (
        activity.join(ip_domain, F.col("user_ip") == ip_domain["ip"])
        .drop("ip")
        .join(ip_location.select("ip", *LOCATION), F.col("user_ip") == F.col("ip"))
        .withColumn("page_url", F.col("site_url"))
    )
    rollup = rows.groupBy(*ACTIVITY_KEYS).agg(
        F.sum("pageviews").alias("pageviews"),
        F.sum(F.col("pageviews") * F.col("score")).alias("weighted_pageviews"),
        F.countDistinct("user_agent").alias("unique_devices"),
        F.countDistinct("user_ip").alias("unique_ips"),
    )
    return rollup.withColumn("publisher_domain_normalized", _publisher("page_url"))


def pixel_company_activity(
    target: DataFrame, activity: DataFrame, ip_domain: DataFrame, ip_location: DataFrame
) -> DataFrame:
    """Rollup of the slice merged into the cache; matched measures are overwritten."""
    rollup = pixel_company_rollup(activity, ip_domain, ip_location)
    return upsert(target, rollup, ACTIVITY_KEYS, MEASURES, null_safe=MERGE_NULL_SAFE, unique_source=True)


def pixel_company_activity_merge(target: DataFrame, cache: DataFrame) -> DataFrame:
    """Cache into the cumulative table."""
    return upsert(target, cache, ACTIVITY_KEYS, MEASURES, null_safe=MERGE_NULL_SAFE)


pixel_enrich = enrich_activity


def pixel_prescoring(target: DataFrame, enriched: DataFrame, key_mode: str = "reference") -> DataFrame:
    """Pixel features merged into the prescoring cache."""
    return prescoring_merge(target, pixel_rollup(enriched), key_mode, fixed_averages=True)


def pixel_consume(cache: DataFrame, enriched: DataFrame) -> DataFrame:
    """Cache without the rows that have been enriched."""
    return delete_matching(cache, enriched, ACTIVITY_KEYS, null_safe=LOCATION)
