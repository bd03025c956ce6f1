"""Pixel queries and their checking SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions import to_day
from tidemark.operators import incremental_slice
from tidemark.plans import bidstream, pixel
from tidemark.plans.enrichment import pixel_rollup, prescoring_merge
from tidemark.sources import pixel_load
from workload import sqltext as s
from workload.base import AS_OF, PIECES, piece, query
from workload.bid_queries import (
    ACT, COMPANY, ENRICHED, LOC, PRE, enqueue_sql, enriched_out, enriched_sql, merge_sql,
    obs_from_ranges_sql, prescoring_sql, queue, same_loc, url_merge_sql, url_out, url_stats_sql,
)

MARK = dt.date(2024, 1, 5)
EARLY, LATE = dt.date(2024, 1, 20), dt.date(2024, 1, 10)

piece(
    "o_pixel_raw",
    "select json_extract_string(pixel_record, '$.userId') as client_id, json_extract_string(pixel_record, '$.ip') as ip, "
    f"{s.day('''json_extract_string(pixel_record, '$.date')''')} as date, json_extract_string(pixel_record, '$.userAgent') as user_agent, "
    "json_extract_string(pixel_record, '$.thirdPartyId') as site_url from in_pixel_raw",
)


def views_sql(where: str) -> str:
    return f"""
select client_id, user_ip, date, user_agent, site_url, sum(pageviews)::bigint as pageviews from (
  select client_id, ip, split_part(ip, ',', -1) as user_ip, date, user_agent, site_url, count(*) as pageviews from o_pixel_raw where {where} group by all
  union
  select client_id, ip, split_part(ip, ',', 1) as user_ip, date, user_agent, site_url, count(*) as pageviews from o_pixel_raw where {where} group by all) u
group by 1, 2, 3, 4, 5"""


piece("o_pixel_views", views_sql("true"))
piece("o_pixel_early", views_sql(f"date <= date '{EARLY}'"))
piece("o_pixel_late", views_sql(f"date > date '{LATE}'"))


@query(
    "pixel_load",
    "select json_extract_string(pixel_record, '$.userId') as user_id, json_extract_string(pixel_record, '$.ip') as ip, "
    "json_extract_string(pixel_record, '$.date') as date, json_extract_string(pixel_record, '$.userAgent') as user_agent, "
    "json_extract_string(pixel_record, '$.thirdPartyId') as site_url from in_pixel_raw",
)
def _(i):
    path = f"{i.folder}/pixel_json"
    i.pixel_raw.write.text(path)
    r = "pixel_record"
    return pixel_load(i.spark, path).select(
        F.col(f"{r}.userId").alias("user_id"),
        F.col(f"{r}.ip").alias("ip"),
        F.col(f"{r}.date").alias("date"),
        F.col(f"{r}.userAgent").alias("user_agent"),
        F.col(f"{r}.thirdPartyId").alias("site_url"),
    )


@query(
    "pixel_user_activity",
    """
select coalesce(a.client_id, b.client_id) as client_id, coalesce(a.user_ip, b.user_ip) as user_ip, coalesce(a.date, b.date) as date,
  coalesce(a.user_agent, b.user_agent) as user_agent, coalesce(a.site_url, b.site_url) as site_url,
  coalesce(a.pageviews, 0) + coalesce(b.pageviews, 0) as pageviews
from o_pixel_early a full join o_pixel_late b
on a.client_id = b.client_id and a.user_ip = b.user_ip and a.date = b.date and a.user_agent = b.user_agent and a.site_url = b.site_url""",
)
def _(i):
    day = to_day(F.col("pixel_record.date"))
    target = pixel.pixel_views(i.pixel_records.filter(day <= F.lit(EARLY)))
    return pixel.pixel_user_activity(target, i.pixel_records.filter(day > F.lit(LATE)))


piece(
    "o_pixel_pages",
    f"select site_url as page_url, {s.domain(s.host('site_url'))} as publisher_domain_normalized, date, user_ip from o_pixel_views where length(site_url) > 1",
)
piece("o_pixel_urls", url_stats_sql("o_pixel_pages"))


@query(
    "pixel_unique_urls",
    """
select s.page_url, md5(s.page_url) as page_url_md5, coalesce(t.publisher_domain_normalized, s.publisher_domain_normalized) as publisher_domain_normalized,
  coalesce(t.first_seen, s.first_seen) as first_seen, s.last_seen, s.frequency
from o_pixel_urls s left join o_urls_early t on t.page_url = s.page_url
union all select page_url, md5(page_url), publisher_domain_normalized, first_seen, last_seen, frequency from o_urls_early where page_url not in (select page_url from o_pixel_urls)""",
)
def _(i):
    return url_out(pixel.pixel_unique_urls(bidstream.url_stats(i.activity_early), i.fresh("pixel_activity")))


piece(
    "o_pixel_fresh",
    "select distinct page_url from o_pixel_urls where page_url not in (select page_url from in_scrape_results where last_scraped is not null) "
    "and publisher_domain_normalized not in (select publisher_domain_normalized from in_bad_pubs)",
)


@query("pixel_scrape_queue", enqueue_sql("o_pixel_fresh"))
def _(i):
    none = i.empty(
        "page_url string, page_url_hash bigint, publisher_domain_normalized string, first_seen date, last_seen date, frequency bigint"
    )
    urls = pixel.pixel_unique_urls(none, i.fresh("pixel_activity"))
    return pixel.pixel_scrape_queue(queue(i), urls, i.scrape_results, i.bad_pubs, AS_OF)


@query("pixel_ip_domain_obs", obs_from_ranges_sql("o_pixel_views", "user_ip not like '%:%'"))
def _(i):
    return pixel.pixel_ip_domain_obs(i.ip_domain_obs, i.fresh("pixel_activity"), i.ranges)


piece(
    "o_pixel_company",
    f"""
select a.site_url as page_url, b.normalized_company_domain, a.date, {', '.join('c.' + c.strip() for c in LOC.split(','))},
  min({s.domain(s.host("a.site_url"))}) as publisher_domain_normalized, sum(pageviews)::bigint as pageviews, sum(pageviews * score) as weighted_pageviews,
  count(distinct user_agent) as unique_devices, count(distinct user_ip) as unique_ips
from o_pixel_views a join o_ip_domain b on a.user_ip = b.ip join in_ip_location c on a.user_ip = c.ip
where a.date >= date '{MARK}' and a.date <= date '{MARK}' + 15 group by 1, 2, 3, 4, 5, 6, 7""",
)
ON = (
    "t.page_url = s.page_url and t.date = s.date and t.normalized_company_domain = s.normalized_company_domain and "
    "t.normalized_country_code = s.normalized_country_code and t.normalized_region_code is not distinct from s.normalized_region_code and "
    "t.normalized_city_name is not distinct from s.normalized_city_name and t.normalized_zip is not distinct from s.normalized_zip"
)
piece("o_pc_old", "select * replace (pageviews + 100 as pageviews, weighted_pageviews + 100 as weighted_pageviews) from o_pixel_company where date <= date '2024-01-15'")
piece("o_pc_new", "select * from o_pixel_company where date > date '2024-01-10'")


def overwrite_sql(target: str, source: str) -> str:
    # every matched column the merge does not overwrite is equal on both sides here
    return (
        f"select {COMPANY} from {source} s union all select {COMPANY} from {target} t "
        f"where not exists (select 1 from {source} s where {ON})"
    )


def _old(i):
    old = i.pixel_company.filter(F.col("date") <= F.lit(dt.date(2024, 1, 15)))
    return old.withColumns({c: F.col(c) + 100 for c in ("pageviews", "weighted_pageviews")})


@query("pixel_company_activity", overwrite_sql("o_pc_old", "o_pixel_company"))
def _(i):
    rows = incremental_slice(i.pixel_activity, "date", MARK, pixel.SLICE_DAYS, inclusive=True)
    return pixel.pixel_company_activity(_old(i), rows, i.ip_domain, i.ip_location)


@query("pixel_company_activity_merge", overwrite_sql("o_pc_old", "o_pc_new"))
def _(i):
    cache = i.pixel_company.filter(F.col("date") > F.lit(dt.date(2024, 1, 10)))
    return pixel.pixel_company_activity_merge(_old(i), cache)


piece("o_pixel_enriched", enriched_sql("o_pixel_company"))


@query("pixel_enrich", ENRICHED + "o_pixel_enriched")
def _(i):
    return enriched_out(pixel.pixel_enrich(i.pixel_company, i.topics, i.brands, i.context, i.titles))


FIXED = (
    "1.0::double as avg_page_relevance, 100.0::double as activity_type_score, 100.0::double as information_type_score"
)
piece("o_pixel_pre", prescoring_sql("o_pixel_enriched", FIXED))
piece("o_pixel_pre_old", PIECES["o_pixel_pre"].replace("from o_pixel_enriched", "from (select * from o_pixel_enriched where date <= date '2024-01-15')"))


def _pre_old(i):
    return pixel_rollup(i.pixel_enriched.filter(F.col("date") <= F.lit(dt.date(2024, 1, 15))))


@query("pixel_prescoring", merge_sql("o_pixel_pre_old", "o_pixel_pre", aligned=False, fixed=True))
def _(i):
    return pixel.pixel_prescoring(_pre_old(i), i.pixel_enriched)


@query("pixel_prescoring_aligned", merge_sql("o_pixel_pre_old", "o_pixel_pre", aligned=True, fixed=True))
def _(i):
    return prescoring_merge(_pre_old(i), pixel_rollup(i.pixel_enriched), "aligned", fixed_averages=True)


@query(
    "pixel_consume",
    f"select {COMPANY} from o_pixel_company a where not exists (select 1 from o_pixel_enriched s where a.page_url = s.page_url and "
    f"a.normalized_company_domain = s.normalized_company_domain and a.date = s.date and {same_loc('a')})",
)
def _(i):
    return pixel.pixel_consume(i.pixel_company, i.pixel_enriched)
