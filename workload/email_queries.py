"""E-mail campaign queries and their checking SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans import email
from tidemark.sources import email_load
from tidemark.sources.files import CLICKS, OPENS
from workload import sqltext as s
from workload.base import AS_OF, piece, query
from workload.bid_queries import enqueue_sql, queue, url_out, url_stats_sql

PAGE = "split_part(link, '?email', 1)"


@query("email_load_clicks", "select cam_id, domain, time::date as day, link from in_clicks")
def _(i):
    path = f"{i.folder}/clicks_csv"
    i.clicks.write.option("header", "true").csv(path)
    return email_load(i.spark, path, CLICKS).select("cam_id", "domain", F.to_date("time").alias("day"), "link")


@query("email_load_opens", "select cam_id, domain, time::date as day from in_opens")
def _(i):
    path = f"{i.folder}/opens_csv"
    i.opens.write.option("header", "true").csv(path)
    return email_load(i.spark, path, OPENS).select("cam_id", "domain", F.to_date("time").alias("day"))


piece(
    "o_clicks",
    f"""
select cam_id, {s.domain("domain")} as normalized_company_domain, time::date as date, {PAGE} as page_url, count(*) as frequency
from (select distinct * from in_clicks) c
where cam_id is not null and {s.domain("domain")} is not null and time is not null and {PAGE} is not null group by 1, 2, 3, 4""",
)
piece(
    "o_opens",
    f"""
select cam_id, {s.domain("domain")} as normalized_company_domain, time::date as date, count(*) as frequency
from (select distinct * from in_opens) c where cam_id is not null and {s.domain("domain")} is not null and time is not null group by 1, 2, 3""",
)


@query("company_clicks", "select * from o_clicks")
def _(i):
    return i.fresh("click_rows")


@query("company_opens", "select * from o_opens")
def _(i):
    return i.fresh("open_rows")


piece(
    "o_click_pages",
    f"select {PAGE} as page_url, {s.domain(PAGE)} as publisher_domain_normalized, time::date as date from in_clicks",
)
piece("o_email_urls", url_stats_sql("o_click_pages"))


@query("email_unique_urls", "select *, md5(page_url) as page_url_md5 from o_email_urls")
def _(i):
    return url_out(email.email_unique_urls(i.clicks))


piece("o_content", f"select distinct cam_id, {PAGE} as page_url from in_clicks")


@query("campaign_content", "select * from o_content")
def _(i):
    return email.campaign_content(i.clicks)


piece(
    "o_topic_rows",
    f"select page_url, f.parentCategory as parent_category, f.category as category, f.topic as topic, f.probability::decimal(5,4) as probability "
    f"from (select page_url, unnest({s.topics('intent_topics')}) as f from in_topic_output) x",
)
piece(
    "o_brand_rows",
    f"select page_url, f.parentCategory as parent_category, f.category as category, f.topic as topic, f.probability::decimal(5,4) as probability "
    f"from (select page_url, unnest({s.topics('brand_topics')}) as f from in_brand_output) x",
)
piece(
    "o_shares",
    """
select cam_id, parent_category, category, topic, round(summed::double / total::double, 10) as proportion from (
  select *, sum(summed) over (partition by cam_id) as total from (
    select cam_id, parent_category, category, topic, sum(probability) as summed from o_content c join o_topic_rows t on c.page_url = t.page_url group by 1, 2, 3, 4) a) b
where cam_id is not null""",
)


@query(
    "campaign_topics",
    "select cam_id, parent_category, category, topic, round(proportion, 6) as proportion from o_shares",
)
def _(i):
    return i.fresh("topic_shares")


piece(
    "o_email_fresh",
    "select page_url from o_email_urls where page_url not in (select page_url from in_scrape_results where last_scraped is not null)",
)


@query("email_scrape_queue", enqueue_sql("o_email_fresh"))
def _(i):
    return email.email_scrape_queue(queue(i), email.email_unique_urls(i.clicks), i.scrape_results, AS_OF)


GROUP = "normalized_company_domain, date, parent_category, category, topic"


def half(rows: str) -> str:
    keys = ", ".join(f"coalesce(c.{k.strip()}, o.{k.strip()}) as {k.strip()}" for k in GROUP.split(","))
    on = " and ".join(f"c.{k.strip()} = o.{k.strip()}" for k in GROUP.split(","))
    return f"""
select {keys}, round(coalesce(weighted_opens, 0), 6) as weighted_opens, round(coalesce(weighted_clicks, 0), 6) as weighted_clicks
from (select {GROUP}, sum(frequency * probability)::double as weighted_clicks from o_clicks a join {rows} b on a.page_url = b.page_url group by all) c
full join o_weighted_opens o on {on}"""


piece(
    "o_weighted_opens",
    f"select {GROUP}, sum(frequency * proportion::decimal(12,10))::double as weighted_opens from o_opens a join o_shares b on a.cam_id = b.cam_id group by all",
)


@query("email_prescoring", half("o_brand_rows") + " union " + half("o_topic_rows"))
def _(i):
    return email.email_prescoring(i.click_rows, i.open_rows, i.topic_shares, i.topics, i.brands)
