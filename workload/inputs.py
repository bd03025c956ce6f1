"""Pipeline inputs derived from the test tables.

Each entry is one SELECT in the common subset of Spark SQL and DuckDB SQL, so
both engines see the same rows.  Every view runs over its whole base table:
suppliers play the companies, events the visits, pages the visited sites.
Semi-structured columns are JSON text.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def _ip(user: str, last: str) -> str:
    """Address of a user's /24 network as text."""
    return (
        f"cast(10 + cast(floor({user} / 65536) as bigint) % 200 as string) || '.' || "
        f"cast(cast(floor({user} / 256) as bigint) % 256 as string) || '.' || "
        f"cast({user} % 256 as string) || '.' || cast({last} as string)"
    )


HOST = "regexp_extract({url}, '^[a-z]+://([^/?#]+)', 1)"

VIEWS: dict[str, str] = {
    "in_visit": """
select e.event_id, e.ts, e.user_id, e.event_type, e.event_id % (select count(*) from pages) as page_id from events e
""",
    "in_bid_log": f"""
select case when v.event_id % 97 = 0 then '' else p.url end as page_url, {HOST.format(url="p.url")} as domain,
  case when v.event_id % 37 = 0 then null else 'u' || cast(v.user_id as string) end as user_id,
  case when v.event_id % 41 = 0 then null else {_ip("v.user_id", "v.event_id % 8")} end as ip_address,
  v.ts as bid_time,
  case v.user_id % 3 when 0 then ' usa' when 1 then 'can' else 'gbr' end as geo_country,
  'x/r' || cast(v.user_id % 5 as string) as geo_region,
  case when v.user_id % 11 = 0 then null else cast(1000 + v.user_id % 40 as string) end as geo_zip
from in_visit v join pages p on p.page_id = v.page_id
""",
    "in_ip_range": f"""
select case when s_suppkey = 5 then '10.0.0.0' else {_ip("s_suppkey", "(s_suppkey % 2) * 4")} end as ip_range_start,
  case when s_suppkey = 5 then '10.255.255.255' else {_ip("s_suppkey", "(s_suppkey % 2) * 4 + 3")} end as ip_range_end,
  case when s_suppkey % 9 = 8 then 'bra' else ' usa' end as pulseplus_country, 'r' || cast(s_suppkey % 5 as string) as pulseplus_region,
  'new  city ' || cast(s_suppkey % 7 as string) as pulseplus_city, s_suppkey % 200 as pulseplus_metro_code,
  cast(1000 + s_suppkey % 40 as string) as pulseplus_postal_code,
  s_suppkey % 100 as pulseplus_country_conf, s_suppkey % 90 as pulseplus_region_conf, s_suppkey % 80 as pulseplus_city_conf, s_suppkey % 70 as pulseplus_postal_conf,
  'isp' || cast(s_suppkey % 3 as string) as isp_name, 'business' as homebiz_type,
  case when s_suppkey % 17 = 3 then null else s_name end as company_name,
  case when s_suppkey % 13 = 12 then 'ip-10-0-0-1.net' when s_suppkey % 34 = 3 then null else 'www.Company' || cast(s_suppkey as string) || '.com' end as domain_name
from supplier
""",
    "in_ip_domain_obs": f"""
select {_ip("s_suppkey", "s_suppkey % 4 + k * 100")} as ip,
  case when s_suppkey % 17 = 16 then 'Shared' else 'company' || cast(s_suppkey + k as string) || '.com' end as normalized_company_domain,
  case s_suppkey % 5 when 0 then 'DIGITAL ELEMENT' when 1 then 'IP FLOW' when 2 then 'FIVE BY FIVE' when 3 then 'LASTBOUNCE' else 'OTHER' end as source,
  case when s_suppkey % 3 = 0 then null else cast(s_suppkey % 10 as double) / 10 end as source_confidence,
  case when s_suppkey % 2 = 0 then date '2024-01-15' else date '2023-09-01' end as date
from (select s_suppkey, 0 as k from supplier union all select s_suppkey, 1 as k from supplier) s
union all
select {_ip("s_suppkey", "s_suppkey % 4")}, 'partner' || cast(s_nationkey as string) || '.com', 'FIVE BY FIVE', 0.5, date '2024-01-20' from supplier
""",
    "in_isp_domains": "select 'company' || cast(s_suppkey as string) || '.com' as domain from supplier where s_acctbal < 500",
    "in_bad_pubs": f"""
select distinct {HOST.format(url="url")} as publisher_domain_normalized from pages where url like '%/de/%'
""",
    "in_geos": """
select distinct case c_custkey % 3 when 0 then 'USA' when 1 then 'CAN' else 'GBR' end as normalized_country_code, 'R' || cast(c_custkey % 5 as string) as normalized_region_code,
  cast(1000 + c_custkey % 40 as string) as normalized_zip, 'city ' || cast((c_custkey % 40) % 7 as string) as normalized_city_name
from customer
""",
    "in_ip_location": f"""
select distinct {_ip("user_id", "event_id % 8")} as ip, date '2024-01-20' as date_updated, 'USA' as normalized_country_code,
  'R' || cast(user_id % 4 as string) as normalized_region_code, case when user_id % 16 = 7 then null else 'city ' || cast(user_id % 16 as string) end as normalized_city_name, cast(2000 + user_id % 16 as string) as normalized_zip
from events where event_type = 'signup'
""",
    "in_topic_output": """
select p.url as page_url, 'content ' || cast(p.page_id as string) as content,
  case when p.page_id % 10 = 9 then '[]' else
  '[{"parentCategory":"p' || cast(p.page_id % 3 as string) || '","category":"c' || cast(p.page_id % 6 as string) || '","topic":"t' || cast(p.page_id % 12 as string) || '","probability":"0.' || cast(1 + p.page_id % 9 as string)
  || '"},{"parentCategory":"p0","category":"c0","topic":"t' || cast(p.page_id % 4 as string) || '","probability":"0.25"}]' end as intent_topics
from pages p
""",
    "in_brand_output": """
select p.url as page_url, case when p.page_id % 4 = 1 then '[{"parentCategory":"p1","category":"c1","topic":"t' || cast(p.page_id % 5 as string) || '","probability":"0.5"}]' else '[]' end as brand_topics
from pages p
""",
    "in_title_output": """
select p.url as page_url, case when p.page_id % 20 = 19 then 'Page not found' else 'title ' || cast(p.page_id as string) end as page_title, 'article' as url_type,
  case p.page_id % 6 when 0 then 'downloading' when 1 then 'reading' when 2 then 'visiting' when 3 then 'executing' when 4 then 'contacting' else 'other' end as activity_type,
  case p.page_id % 4 when 0 then 'informational' when 1 then 'transactional' when 2 then 'navigational' else 'other' end as information_type,
  case when p.page_id % 15 = 14 then '{"BUSINESS":0.9}' else '{"BUSINESS":0.' || cast(p.page_id % 10 as string) || ',"BUSINESS NEWS":0.3,"SCIENCE TECH NEWS":0.2}' end as topics
from pages p
""",
    "in_context_output": """
select url as page_url, '{"review/comparison":' || cast(case when page_id % 5 = 0 then 1 else 0 end as string) || '}' as context from pages
""",
    # the second part is an older capture of the same pages
    "in_scrape_output": """
select url, case when page_id % 12 = 11 then '404' else '200' end as statuscode,
  regexp_extract(html, '<title>([^<]*)</title>', 1) || case when page_id % 5 = 0 then ' Review' when page_id % 7 = 0 then ' A vs B' else '' end as title,
  html as body, 'text/html' as contenttype, cast(null as string) as image, regexp_extract(html, 'lang="([a-z]+)"', 1) as lang
from pages
union all
select url, '301', 'moved', url, 'text/plain', null, null from pages where url like 'http://%'
""",
    "in_scrape_results": """
select url as page_url, statuscode as result, title, body as content, date '2024-01-10' as last_scraped, contenttype as content_type, image, lang as language
from in_scrape_output where url like 'https://%'
""",
    "in_titles_done": """
select page_url, page_title, date '2024-01-10' as date_classified from in_title_output where page_url like '%.com/%'
""",
    "in_brand_ref": """
select 'p' || cast(page_id % 3 as string) as parent_category, 'c' || cast(page_id % 6 as string) as category, 't' || cast(page_id % 12 as string) as original_topic,
  regexp_extract(html, '<p>[^a-zA-Z]*([A-Za-z]{3,})', 1) as brand, 'brand' || cast(page_id as string) || '.com' as domain, 't' || cast(page_id % 5 as string) as brand_topic
from pages where regexp_extract(html, '<p>[^a-zA-Z]*([A-Za-z]{3,})', 1) <> ''
""",
    "in_pixel_raw": f"""
select '{{"userId":"c' || cast(v.user_id % 7 as string) || '","ip":"' || {_ip("v.user_id", "v.event_id % 8")}
  || case when v.event_id % 5 = 0 then ',10.0.' || cast(v.user_id % 3 as string) || '.' || cast(v.user_id % 9 as string) when v.event_id % 53 = 0 then ',fe80::1' else '' end || '","date":"' ||
  case when v.event_id % 10 = 3 then substr(cast(v.ts as string), 1, 10) else substr(cast(v.ts as string), 9, 2) || '-' || substr(cast(v.ts as string), 6, 2) || '-' || substr(cast(v.ts as string), 1, 4) end
  || '","userAgent":"ua' || cast(v.user_id % 6 as string) || '","thirdPartyId":"' || p.url || '"}}' as pixel_record
from in_visit v join pages p on p.page_id = v.page_id where v.event_type in ('view', 'click')
""",
    "in_lookup_output": f"""
select {_ip("user_id", "event_id % 8")} as user_ip,
  case event_id % 4 when 0 then 204 else 200 end as last_response_code, cast(ts as date) as last_query_date,
  '{{"website":"http://www.firm' || cast(user_id as string) || '.com","location":{{"countryCode":"' || case user_id % 3 when 0 then 'US' when 1 then 'CA' else 'GB' end
  || '","region":"Region ' || cast(user_id % 6 as string) || '","town":"Town ' || cast(user_id % 6 as string) || '","postalCode":"' || cast(10000 + user_id + event_id % 3 as string) || '"}}}}' as api_response
from events where event_type = 'signup'
""",
    "in_country_iso": "select 'US' as isocode_2, 'USA' as isocode_3 union all select 'CA', 'CAN' union all select 'GB', 'GBR'",
    "in_region_codes": "select 'Region ' || cast(r_regionkey as string) as region_name, 'R' || cast(r_regionkey as string) as region_isocode_2 from region",
    "in_vendor_ip": f"""
select {_ip("s_suppkey", "s_suppkey % 8")} as ip_address, 'www.company' || cast(s_suppkey as string) || '.com' as company_domain,
  'company' || cast(s_suppkey + 1 as string) || '.com,company' || cast(s_suppkey + 2 as string) || '.com' as company_domain_array, cast(s_suppkey % 10 as double) / 10 as distribution_percentage
from supplier
""",
    "in_clicks": """
select case when v.event_id % 50 = 0 then null else 'cam' || cast(v.user_id % 12 as string) end as cam_id, 'www.company' || cast(v.user_id % 20 as string) || '.com' as domain, v.ts as time, p.url || '?email=x' || cast(v.user_id as string) as link
from in_visit v join pages p on p.page_id = v.page_id where v.event_type = 'click'
""",
    "in_opens": """
select 'cam' || cast(user_id % 12 as string) as cam_id, 'www.company' || cast(user_id % 20 as string) || '.com' as domain, ts as time from events where event_type = 'view'
""",
    "in_lead_flat": """
select cast(o_orderdate as date) as file_date, o_orderpriority as category, case when o_custkey % 30 = 0 then null else 'www.company' || cast(o_custkey % 20 as string) || '.com' end as domain, c_name as company,
  'trigger ' || cast(o_custkey % 6 as string) as entity_trigger, case when o_custkey % 4 = 0 then null else 'senior' end as seniority, 'it' as entity_function, o_orderstatus as trigger_type, c_mktsegment as industry,
  cast(null as string) as company_size, 'city' as city, 'st' as state, 'USA' as country, case when o_orderkey % 9 = 0 then null else cast(o_orderkey % 100 as int) end as score
from orders join customer on c_custkey = o_custkey
""",
    "in_lead_topic_map": "select 'trigger ' || cast(r_regionkey as string) as leadsift_category, 'p' || cast(r_regionkey % 3 as string) as ds_parent_category, 'c' || cast(r_regionkey % 6 as string) as ds_category, 't' || cast(r_regionkey % 12 as string) as ds_topic from region",
    # topic names repeat across the three levels for some users, as in a real taxonomy
    "in_prescoring_bid": """
select 'company' || cast(user_id % 10 as string) || '.com' as normalized_company_domain, case when user_id % 7 = 0 then 'x' else 'p' || cast(user_id % 3 as string) end as parent_category,
  case when user_id % 7 = 0 then 'x' else 'c' || cast(user_id % 6 as string) end as category, case when user_id % 7 = 0 then 'x' else 't' || cast(user_id % 12 as string) end as topic,
  'USA' as normalized_country_code, 'R' || cast(user_id % 2 as string) as normalized_region_code, case when user_id % 10 = 9 then null else 'city ' || cast(user_id % 4 as string) end as normalized_city_name, '10000' as normalized_zip,
  cast(ts as date) as date, count(*) as pageviews, sum(cast(event_id % 10 as double)) as weighted_pageviews, avg(cast(event_id % 10 as double)) / 10 as avg_page_relevance, avg(cast(event_id % 100 as double)) as activity_type_score,
  avg(cast(event_id % 90 as double)) as information_type_score, cast(sum(case when event_id % 5 = 0 then 1 else 0 end) as bigint) as review_pageviews, count(distinct event_id % 20) as unique_pages, count(distinct event_id % 3) as unique_pubs, count(distinct user_id) as unique_devices, count(distinct event_id % 8) as unique_ips
from events where event_type <> 'purchase' group by 1, 2, 3, 4, 5, 6, 7, 8, 9
""",
    "in_prescoring_email": """
select 'company' || cast(user_id % 14 as string) || '.com' as normalized_company_domain, cast(ts as date) as date, 'p' || cast(user_id % 3 as string) as parent_category, 'c' || cast(user_id % 6 as string) as category, 't' || cast(user_id % 12 as string) as topic,
  cast(sum(case when event_type = 'view' then 1 else 0 end) as double) / 2 as weighted_opens, cast(sum(case when event_type = 'click' then 1 else 0 end) as double) / 2 as weighted_clicks
from events where event_type in ('view', 'click') group by 1, 2, 3, 4, 5
""",
    "in_prescoring_pixel": """
select 'company' || cast(user_id % 12 as string) || '.com' as normalized_company_domain, 'p' || cast(user_id % 3 as string) as parent_category, 'c' || cast(user_id % 6 as string) as category, 't' || cast(user_id % 12 as string) as topic,
  'USA' as normalized_country_code, 'R' || cast(user_id % 2 as string) as normalized_region_code, 'city ' || cast(user_id % 4 as string) as normalized_city_name, '10000' as normalized_zip,
  cast(ts as date) as date, count(*) as pageviews, sum(cast(event_id % 7 as double)) as weighted_pageviews, 0 as review_pageviews, count(distinct event_id % 20) as unique_pages, count(distinct event_id % 3) as unique_pubs
from events where event_type = 'view' group by 1, 2, 3, 4, 5, 6, 7, 8, 9
""",
    "in_prescoring_lead": """
select cast(ts as date) as date, 'p' || cast(user_id % 3 as string) as parent_category, 'c' || cast(user_id % 6 as string) as category, 't' || cast(user_id % 12 as string) as topic,
  'company' || cast(user_id % 16 as string) || '.com' as normalized_company_domain, max(case when event_id % 3 = 0 then 0 else event_id % 100 end) as leadsift_score
from events where event_type = 'error' group by 1, 2, 3, 4, 5
""",
}


def names_in(sql: str, known) -> list[str]:
    """Known relation names that a SQL text mentions, in order of ``known``."""
    words = set(re.findall(r"[A-Za-z_][A-Za-z0-9_]*", sql))
    return [k for k in known if k in words]


class Inputs:
    """The inputs of one data directory as Spark DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, str(sf_dir)
        self._made: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.dir}/{name}.parquet")
        # the files hold zone-less times; one cast at the edge gives UTC timestamps
        for f in df.schema.fields:
            if f.dataType.typeName() == "timestamp_ntz":
                df = df.withColumn(f.name, F.col(f.name).cast("timestamp"))
        return df

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._made:
            if name in TABLES:
                self._made[name] = self.table(name)
            else:
                sql = VIEWS[f"in_{name}"]
                for dep in names_in(sql, TABLES):
                    getattr(self, dep).createOrReplaceTempView(dep)
                for dep in names_in(sql, VIEWS):
                    getattr(self, dep[3:]).createOrReplaceTempView(dep)
                self._made[name] = self.spark.sql(sql)
        return self._made[name]
