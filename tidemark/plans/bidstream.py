"""Ad-bid logs: user activity, address/device/company maps, company activity, URL queue."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import (
    domain_normalizer,
    ip_to_number,
    ip_trio,
    is_integer,
    ratio,
    strict_greatest,
)
from tidemark.operators import (
    anti,
    delete_matching,
    insert_new,
    ip_range_join,
    ordered_limit,
    share_of_total,
    upsert,
)

# Fixed values
FIRST_DAY = dt.date(2022, 10, 13)
SLICE_DAYS = 180
RESOLVABLE_DAYS = 180
SOURCE_WEIGHTS = {"DIGITAL ELEMENT": 0.3, "IP FLOW": 0.5, "FIVE BY FIVE": 0.9, "LASTBOUNCE": 0.7}
OTHER_SOURCE_WEIGHT = 0.5
RANGE_SOURCE = "DIGITAL ELEMENT"
BID_SOURCE = "BEESWAX"
BID_VIA_IP_SOURCE = "BEESWAX-VIA-IP"
QUEUE_LIMIT = 2_000_000

LOCATION = ["normalized_country_code", "normalized_region_code", "normalized_city_name", "normalized_zip"]
ACTIVITY_KEYS = ["page_url", "normalized_company_domain", "date", *LOCATION]


def _known(domain: Column, shared: str) -> Column:
    """A usable company domain: longer than one character and not the shared-host marker."""
    return (F.length(domain) > 1) & (domain != shared)


def page_publisher(rows: DataFrame) -> DataFrame:
    """One publisher per page: the smallest among the given rows, the empty one last.

    The smallest text in a wide grouping would make Spark sort all its rows
    instead of hashing them; pages with their publishers are few, once distinct.
    """
    publisher = F.col("publisher_domain_normalized")
    pairs = rows.select("page_url", publisher).distinct()
    return pairs.groupBy("page_url").agg(
        F.coalesce(F.min(F.nullif(publisher, F.lit(""))), F.min(publisher)).alias("publisher_domain_normalized")
    )


# -- user activity ---------------------------------------------------------------


def consume_raw(bid_log: DataFrame, cut: dt.datetime) -> tuple[DataFrame, DataFrame]:
    """Rows up to the cut, and the rows that stay for the next run."""
    old = F.col("bid_time") <= F.lit(cut)
    return bid_log.filter(old), bid_log.filter(~old)


def user_activity_rollup(bid_log: DataFrame, cut: dt.datetime) -> DataFrame:
    """Page views per page, user, address, day and bid location.

    A page without a domain has an empty publisher, not a missing one: it is a key
    of later merges and of ``NOT IN`` lists.
    """
    done, _ = consume_raw(bid_log, cut)
    rows = done.select(
        F.trim("page_url").alias("page_url"),
        domain_normalizer(F.col("domain")).alias("publisher_domain_normalized"),
        F.trim("user_id").alias("user_id"),
        F.trim("ip_address").alias("user_ip"),
        F.to_date("bid_time").alias("date"),
        F.trim(F.upper("geo_country")).alias("bw_country_normalized"),
        F.trim(F.upper(F.split_part(F.col("geo_region"), F.lit("/"), F.lit(-1)))).alias(
            "bw_region_normalized"
        ),
        F.lit("").alias("bw_city_normalized"),
        F.col("geo_zip").alias("bw_zip_normalized"),
        F.length("page_url").alias("__raw_length"),
    )
    rows = rows.filter(
        (F.col("__raw_length") > 0)
        & (F.col("user_ip").isNotNull() | F.col("user_id").isNotNull())
        & F.col("date").isNotNull()
    )
    keys = [
        "page_url",
        "user_id",
        "user_ip",
        "date",
        "bw_country_normalized",
        "bw_region_normalized",
        "bw_city_normalized",
        "bw_zip_normalized",
    ]
    # the smallest text makes Spark sort the rows by the keys; a hash in front settles nearly every
    # comparison by its eight bytes, which addresses of pages, all alike at first, do not
    grouped = rows.withColumn("__hash", F.xxhash64("page_url")).groupBy("__hash", *keys).agg(
        F.coalesce(F.min("publisher_domain_normalized"), F.lit("")).alias("publisher_domain_normalized"),
        F.count(F.lit(1)).alias("pageviews"),
    )
    return grouped.drop("__hash")


def user_activity_merge(target: DataFrame, cache: DataFrame, *, only_new: bool = False) -> DataFrame:
    """Cache into the cumulative table; location is not part of the key."""
    keys = ["page_url", "date", "publisher_domain_normalized", "pageviews", "user_id", "user_ip"]
    return insert_new(target, cache, keys, null_safe=["user_id", "user_ip"], only_new=only_new)


def user_activity_consume(user_activity: DataFrame, company_activity: DataFrame) -> DataFrame:
    """Drop the days that company activity has been computed for."""
    return delete_matching(user_activity, company_activity.select("date").distinct(), ["date"])


# -- address to location ------------------------------------------------------------


def ip_location_latest(user_activity: DataFrame) -> DataFrame:
    """Latest bid location of each address.

    Newest day first; within the day an incomplete location ranks before the
    others, then the joined location text, largest first.  Each location's last
    day comes first, in a hashed grouping of all rows; the ``max`` over a struct,
    for which Spark sorts, then sees one row for each address and location.
    """
    location = ["bw_country_normalized", "bw_region_normalized", "bw_city_normalized", "bw_zip_normalized"]
    parts = [F.col(c) for c in location]
    key = F.concat(*parts)
    best = F.max(
        F.struct(
            F.col("date"),
            key.isNull().alias("incomplete"),
            key.alias("key"),
            *[p.alias(n) for p, n in zip(parts, LOCATION)],
        )
    )
    rows = user_activity.filter(F.length("user_ip") > 0).groupBy("user_ip", *location).agg(F.max("date").alias("date"))
    return (
        rows.groupBy(F.col("user_ip").alias("ip"))
        .agg(best.alias("b"))
        .select("ip", F.col("b.date").alias("date_updated"), *[f"b.{n}" for n in LOCATION])
    )


def ip_location_upsert(target: DataFrame, cache: DataFrame, *, co_located: bool = False) -> DataFrame:
    """Latest locations into the cumulative map (the cache has one row per address)."""
    return upsert(target, cache, ["ip"], ["date_updated", *LOCATION], unique_source=True, co_located=co_located)


def ip_location_best_source(
    target: DataFrame, bid_locations: DataFrame, ip_ranges: DataFrame, threshold: int = 0, *, co_located: bool = False
) -> DataFrame:
    """Range-file location where all its confidences reach the threshold, else the bid's.

    Only addresses inside a range are written.  Where ranges overlap, the
    narrowest one decides, then the lowest start, then the smallest row text.
    """
    ranges = ip_ranges.select(
        "ip_range_start_numeric",
        "ip_range_end_numeric",
        "country_confidence",
        "region_confidence",
        "city_confidence",
        F.struct("date_updated", *LOCATION).alias("range_loc"),
    )
    bids = bid_locations.select(
        "ip", ip_to_number(F.col("ip")).alias("ip_number"), F.struct("date_updated", *LOCATION).alias("bid_loc")
    )
    sure = (
        (F.col("country_confidence") >= threshold)
        & (F.col("region_confidence") >= threshold)
        & (F.col("city_confidence") >= threshold)
    )
    chosen = F.when(sure, F.col("range_loc")).otherwise(F.col("bid_loc"))
    width = F.col("ip_range_end_numeric") - F.col("ip_range_start_numeric")
    matches = ip_range_join(bids, "ip_number", ranges).select(
        "ip", F.struct(width.alias("w"), F.col("ip_range_start_numeric").alias("s"), chosen.alias("loc")).alias("m")
    )
    best = matches.groupBy("ip").agg(F.min("m").alias("m"))
    best = best.select("ip", "m.loc.date_updated", *[f"m.loc.{c}" for c in LOCATION])
    return upsert(target, best, ["ip"], ["date_updated", *LOCATION], unique_source=True, co_located=co_located)


# -- address to company ---------------------------------------------------------------


def ip_domain_obs_from_ranges(
    target: DataFrame, user_activity: DataFrame, ip_ranges: DataFrame, *, only_new: bool = False
) -> DataFrame:
    """New (address, company) observations from the range file; hosts marked as shared count for none."""
    ips = (
        user_activity.filter(F.length("user_ip") > 0)
        .select(F.col("user_ip").alias("ip"))
        .distinct()
        .withColumn("ip_number", ip_to_number(F.col("ip")))
    )
    ranges = ip_ranges.filter(F.length("normalized_company_domain") > 1).select(
        "ip_range_start_numeric",
        "ip_range_end_numeric",
        "normalized_company_domain",
        F.col("date_updated").alias("date"),
    )
    found = (
        ip_range_join(ips, "ip_number", ranges)
        .select("ip", "normalized_company_domain", "date")
        .distinct()
        .withColumn("source", F.lit(RANGE_SOURCE))
    )
    return insert_new(
        target,
        found,
        ["ip", "normalized_company_domain", "date"],
        target_filter=F.col("source") == RANGE_SOURCE,
        only_new=only_new,
    )


def ip_domain_scores(
    observations: DataFrame,
    as_of: dt.date,
    *,
    recency_floor: float | None = 0.01,
    floor: float = 0.1,
    guard_zero: bool = False,
    date_col: str = "date",
) -> DataFrame:
    """Company shares of each address from weighted, ageing observations.

    The variants differ in the recency floor and the zero-total guard.
    """
    weight = F.lit(OTHER_SOURCE_WEIGHT)
    for source, w in SOURCE_WEIGHTS.items():
        weight = F.when(F.col("source") == source, w).otherwise(weight)
    recency = F.lit(1.0) - F.lit(0.01) * F.datediff(F.lit(as_of), F.col(date_col))
    if recency_floor is not None:
        recency = strict_greatest(F.lit(recency_floor), recency)
    confidence = F.coalesce(F.col("source_confidence"), F.lit(1.0))
    scores = (
        observations.filter(_known(F.col("normalized_company_domain"), "Shared"))
        .select(
            "ip", "normalized_company_domain", "source", "source_confidence", recency.alias("recency_score")
        )
        .distinct()
        .withColumn("score", F.round(confidence * F.col("recency_score") * weight, 10))
    )
    summed = scores.groupBy("ip", "normalized_company_domain").agg(F.round(F.sum("score"), 8).alias("raw"))
    return share_of_total(summed, "ip", "raw", "score", floor=floor, guard_zero=guard_zero).drop("raw")


def ip_trio_scores(ip_domain: DataFrame, isp_domains: DataFrame, floor: float = 0.01) -> DataFrame:
    """Company shares of the first three octets, providers left out."""
    companies = anti(ip_domain, isp_domains, "normalized_company_domain", "domain")
    summed = companies.groupBy(ip_trio(F.col("ip")).alias("ip_trio"), "normalized_company_domain").agg(
        F.round(F.sum("score"), 8).alias("raw")
    )
    return share_of_total(summed, "ip_trio", "raw", "score", floor=floor, guard_zero=False).drop("raw")


# -- device to company ----------------------------------------------------------------


def device_ip_obs(target: DataFrame, user_activity: DataFrame) -> DataFrame:
    """New (device, address, day) sightings; network addresses ending in .0 are skipped."""
    seen = (
        user_activity.filter(
            (F.length("user_ip") > 1) & ~F.col("user_ip").endswith(".0") & (F.length("user_id") > 1)
        )
        .select(F.col("user_id").alias("bitoid"), F.col("user_ip").alias("ip"), "date")
        .distinct()
    )
    return insert_new(target, seen, ["ip", "bitoid", "date"])


def device_ip_obs_publish(
    target: DataFrame, cache: DataFrame, source: str = BID_SOURCE, *, only_new: bool = False
) -> DataFrame:
    """Cached sightings into the cumulative table under a source name."""
    return insert_new(
        target,
        cache.withColumn("source", F.lit(source)),
        ["ip", "bitoid", "date"],
        target_filter=F.col("source") == source,
        only_new=only_new,
    )


def device_domain_obs(
    target: DataFrame, device_ip: DataFrame, ip_domain: DataFrame, *, only_new: bool = False
) -> DataFrame:
    """Device sightings joined to the company map.

    Several addresses may lead a device to one company on one day; the largest
    score is kept.
    """
    found = (
        device_ip.join(ip_domain, "ip")
        .filter(F.length("normalized_company_domain") > 1)
        .groupBy("bitoid", "normalized_company_domain", "date")
        .agg(F.max("score").alias("source_confidence"))
        .withColumn("source", F.lit(BID_VIA_IP_SOURCE))
    )
    return insert_new(target, found, ["bitoid", "normalized_company_domain", "source", "date"], only_new=only_new)


def device_domain_best(observations: DataFrame, isp_domains: DataFrame) -> DataFrame:
    """Best company of each device: source score times share of sightings.

    A tie goes to the alphabetically last company.  The largest struct is an
    aggregate, so a device with very many companies is not sorted in one task.
    """
    kept = anti(observations, isp_domains, "normalized_company_domain", "domain")
    totals = kept.groupBy(F.col("bitoid").alias("__b")).agg(F.count(F.lit(1)).alias("total"))
    rolled = (
        kept.filter(F.col("normalized_company_domain") != "Shared")
        .groupBy("bitoid", "normalized_company_domain")
        .agg(
            F.countDistinct("source").alias("sources"),
            F.max("source_confidence").alias("confidence"),
            F.count(F.lit(1)).alias("frequency"),
        )
        .join(totals, F.col("bitoid") == F.col("__b"))
    )
    source_score = F.when(F.col("sources") > 1, F.lit(1.0)).otherwise(F.col("confidence"))
    score = F.round(source_score * ratio(F.col("frequency"), F.col("total")), 9)
    # an unknown score ranks first, as in the descending order it replaces
    best = F.max(
        F.struct(score.isNull().alias("n"), score.alias("score"), F.col("normalized_company_domain").alias("d"))
    )
    return (
        rolled.groupBy("bitoid")
        .agg(best.alias("b"))
        .select("bitoid", F.col("b.d").alias("normalized_company_domain"), F.col("b.score").alias("score"))
    )


# -- company activity -----------------------------------------------------------------


def ip_resolvable_domains(
    target: DataFrame, activity: DataFrame, ip_domain: DataFrame, isp_domains: DataFrame
) -> DataFrame:
    """Companies that a day's addresses lead to; ``activity`` is the slice to process."""
    usable = anti(
        ip_domain.filter(~F.col("ip").endswith(".0") & _known(F.col("normalized_company_domain"), "shared")),
        isp_domains,
        "normalized_company_domain",
        "domain",
    )
    days = activity.select(F.col("user_ip").alias("ip"), "date").distinct()
    found = days.join(usable, "ip").select("normalized_company_domain", "date").distinct()
    return insert_new(target, found, ["normalized_company_domain", "date"])


def resolve_company(
    activity: DataFrame,
    ip_domain: DataFrame,
    device_domain: DataFrame,
    ip_trio_map: DataFrame,
    resolvable: DataFrame,
    isp_domains: DataFrame,
    as_of: dt.date,
    *,
    exclusive_tiers: bool = False,
    resolvable_days: int = RESOLVABLE_DAYS,
) -> DataFrame:
    """Activity rows with company and score from the address, else device, else trio map.

    Device and trio tiers both start from the rows the address left open, so a
    row may get a company from each; ``exclusive_tiers`` keeps the trio tier for
    rows without a device match.  The trio tier leaves out companies that an address
    led to in the last ``resolvable_days``.  ``ip_domain`` holds one row per address
    and company.
    """
    company = F.col("normalized_company_domain")
    by_ip = anti(
        ip_domain.filter(~F.col("ip").endswith(".0") & _known(company, "shared")).select(
            "ip", "normalized_company_domain", "score"
        ),
        isp_domains,
        "normalized_company_domain",
        "domain",
    )
    resolved = activity.join(by_ip, F.col("user_ip") == F.col("ip")).drop("ip")
    open_rows = activity.join(by_ip.select("ip"), F.col("user_ip") == F.col("ip"), "left_anti")

    by_device = device_domain.filter(_known(company, "shared")).select(
        "bitoid", "normalized_company_domain", "score"
    )
    via_device = open_rows.join(by_device, F.col("user_id") == F.col("bitoid")).drop("bitoid")

    recent = resolvable.filter(
        F.col("date").between(F.lit(as_of - dt.timedelta(days=resolvable_days)), F.lit(as_of))
    )
    by_trio = anti(
        ip_trio_map.filter(_known(company, "shared")), recent, "normalized_company_domain"
    ).select(F.col("ip_trio").alias("__trio"), "normalized_company_domain", "score")
    for_trio = open_rows
    if exclusive_tiers:
        for_trio = open_rows.join(
            by_device.select(F.col("bitoid").alias("__b")), F.col("user_id") == F.col("__b"), "left_anti"
        )
    via_trio = for_trio.join(by_trio, ip_trio(F.col("user_ip")) == F.col("__trio")).drop("__trio")
    return resolved.unionByName(via_device).unionByName(via_trio)


def company_activity(
    activity: DataFrame,
    ip_domain: DataFrame,
    device_domain: DataFrame,
    ip_trio_map: DataFrame,
    resolvable: DataFrame,
    ip_location: DataFrame,
    geos: DataFrame,
    isp_domains: DataFrame,
    as_of: dt.date,
    *,
    exclusive_tiers: bool = False,
    resolvable_days: int = RESOLVABLE_DAYS,
) -> DataFrame:
    """Page activity per company, day and location; ``activity`` is the slice to process.

    The address's location is used when complete, else the bid's.  Four-digit US
    zips get their leading zero.  Rows without a full location are dropped.  A
    page has one publisher throughout the slice.
    """
    rows = resolve_company(
        activity, ip_domain, device_domain, ip_trio_map, resolvable, isp_domains, as_of,
        exclusive_tiers=exclusive_tiers, resolvable_days=resolvable_days,
    )
    by_ip = ip_location.select(F.col("ip").alias("__ip"), F.struct(*LOCATION).alias("ip_loc"))
    by_geo = geos.select(
        F.col("normalized_country_code").alias("__c"),
        F.col("normalized_region_code").alias("__r"),
        F.col("normalized_zip").alias("__z"),
        F.col("normalized_city_name").alias("geo_city"),
    )
    located = rows.join(by_ip, F.col("user_ip") == F.col("__ip"), "left").join(
        by_geo,
        (F.col("bw_country_normalized") == F.col("__c"))
        & (F.col("bw_region_normalized") == F.col("__r"))
        & (F.col("bw_zip_normalized") == F.col("__z")),
        "left",
    )
    complete = F.lit(True)
    for c in LOCATION:
        complete = complete & F.col(f"ip_loc.{c}").isNotNull()

    def pick(field: str, bid: str) -> Column:
        return F.when(complete, F.col(f"ip_loc.{field}")).otherwise(F.col(bid))

    located = located.withColumns(
        {
            "normalized_country_code": pick("normalized_country_code", "bw_country_normalized"),
            "normalized_region_code": pick("normalized_region_code", "bw_region_normalized"),
            "normalized_city_name": pick("normalized_city_name", "geo_city"),
            "__zip": pick("normalized_zip", "bw_zip_normalized"),
        }
    )
    short_us = (
        is_integer(F.col("__zip"))
        & (F.col("normalized_country_code") == "USA")
        & (F.length("__zip") == 4)
    )
    located = located.withColumn(
        "normalized_zip", F.when(short_us, F.concat(F.lit("0"), F.col("__zip"))).otherwise(F.col("__zip"))
    )
    rollup = (
        located.dropna(subset=LOCATION)
        .groupBy(*ACTIVITY_KEYS)
        .agg(
            F.sum("pageviews").alias("pageviews"),
            F.sum(F.col("score") * F.col("pageviews")).alias("weighted_pageviews"),
            F.countDistinct("user_id").alias("unique_devices"),
            F.countDistinct("user_ip").alias("unique_ips"),
        )
    )
    return rollup.join(page_publisher(activity), "page_url")


def company_activity_replace_slice(
    cache: DataFrame, fresh: DataFrame, mark: dt.date, days: int = SLICE_DAYS
) -> DataFrame:
    """Cache without the slice's days, plus the newly computed rows."""
    day = F.col("date")
    inside = (day > F.lit(mark)) & (day <= F.lit(mark + dt.timedelta(days=days)))
    return cache.filter(~inside | day.isNull()).unionByName(fresh)


def company_activity_merge(target: DataFrame, cache: DataFrame, *, only_new: bool = False) -> DataFrame:
    """Cache into the cumulative table, new keys only."""
    return insert_new(target, cache, ACTIVITY_KEYS, only_new=only_new)


def company_activity_consume(cache: DataFrame, enriched: DataFrame) -> DataFrame:
    """Cache without the rows that have been enriched."""
    return delete_matching(cache, enriched, ACTIVITY_KEYS, null_safe=LOCATION)


# -- URLs and the scrape queue -----------------------------------------------------------

def _url_merge(target: DataFrame, source: DataFrame, *, unique_source: bool, co_located: bool = False) -> DataFrame:
    same_day = F.col("s.last_seen") == F.col("t.last_seen")
    return upsert(
        target,
        source,
        ["page_url"],
        {
            "publisher_domain_normalized": F.col("s.publisher_domain_normalized"),
            "last_seen": F.col("s.last_seen"),
            "frequency": F.when(same_day, F.col("t.frequency")).otherwise(
                F.col("s.frequency") + F.col("t.frequency")
            ),
        },
        unique_source=unique_source,
        co_located=co_located,
    )


def url_stats(activity: DataFrame) -> DataFrame:
    """First and last day, row count and publisher of each page (a missing URL is a page too).

    All rows are hashed once, by page and publisher; the smallest publisher, as in
    ``page_publisher``, is chosen among these few.
    """
    publisher = F.col("publisher_domain_normalized")
    pairs = activity.groupBy("page_url", publisher).agg(
        F.min("date").alias("first_seen"), F.max("date").alias("last_seen"), F.count(F.lit(1)).alias("frequency")
    )
    stats = pairs.groupBy("page_url").agg(
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
        F.sum("frequency").alias("frequency"),
        F.coalesce(F.min(F.nullif(publisher, F.lit(""))), F.min(publisher)).alias("publisher_domain_normalized"),
    )
    return stats.select(
        "page_url",
        F.xxhash64("page_url").alias("page_url_hash"),
        "publisher_domain_normalized",
        "first_seen",
        "last_seen",
        "frequency",
    )


def unique_urls(target: DataFrame, activity: DataFrame) -> DataFrame:
    """URL statistics of the slice merged into the cache.

    The frequency grows unless the last day is unchanged.
    """
    return _url_merge(target, url_stats(activity), unique_source=True)


def unique_urls_merge(target: DataFrame, cache: DataFrame, *, co_located: bool = False) -> DataFrame:
    """URL cache into the cumulative table, same rule; co-located, the cache must have one row per page."""
    return _url_merge(target, cache, unique_source=co_located, co_located=co_located)


def never_scraped(urls: DataFrame, results: DataFrame) -> DataFrame:
    """URLs without a scrape date (a result row lacking the date does not count)."""
    scraped = results.filter(F.col("last_scraped").isNotNull()).select("page_url")
    return urls.join(scraped, "page_url", "left_anti")


def enqueue(queue: DataFrame, urls: DataFrame, as_of: dt.date) -> DataFrame:
    """Put URLs (one row each) on the scrape queue under the given day."""
    return upsert(
        queue,
        urls.select("page_url", F.lit(as_of).alias("date_inserted")),
        ["page_url"],
        ["date_inserted"],
        unique_source=True,
    )


def scrape_queue(
    queue: DataFrame,
    urls: DataFrame,
    results: DataFrame,
    bad_pubs: DataFrame,
    as_of: dt.date,
    limit: int = QUEUE_LIMIT,
) -> DataFrame:
    """Queue the newest never-scraped URLs of publishers that are not suppressed."""
    fresh = anti(never_scraped(urls, results), bad_pubs, "publisher_domain_normalized")
    fresh = fresh.groupBy("page_url").agg(F.max("last_seen").alias("last_seen"))
    return enqueue(queue, ordered_limit(fresh, limit, "last_seen", "page_url"), as_of)


def scrape_queue_prune(urls: DataFrame, queue: DataFrame, results: DataFrame) -> DataFrame:
    """URLs neither queued nor scraped."""
    known = queue.select("page_url").unionByName(results.select("page_url"))
    return delete_matching(urls, known, ["page_url"])
