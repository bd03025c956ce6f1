"""Bid-stream queries and their checking SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.plans import bidstream, enrichment
from workload import sqltext as s
from workload.base import AS_OF, piece, query

CUT = dt.datetime(2024, 1, 28, 12)
DAY = f"date '{AS_OF}'"

LOC = "normalized_country_code, normalized_region_code, normalized_city_name, normalized_zip"
ACT = "page_url, normalized_company_domain, date, " + LOC


def rollup_sql(where: str) -> str:
    return f"""
select page_url, user_id, user_ip, date, bw_country_normalized, bw_region_normalized, bw_city_normalized, bw_zip_normalized,
  min(pub) as publisher_domain_normalized, count(*) as pageviews
from (select trim(page_url) as page_url, length(page_url) as n, {s.domain("domain")} as pub, trim(user_id) as user_id, trim(ip_address) as user_ip,
   cast(bid_time as date) as date, trim(upper(geo_country)) as bw_country_normalized,
   trim(upper(split_part(geo_region, '/', -1))) as bw_region_normalized, '' as bw_city_normalized, geo_zip as bw_zip_normalized
  from in_bid_log where {where}) r
where n > 0 and (user_id is not null or user_ip is not null) and date is not null
group by 1, 2, 3, 4, 5, 6, 7, 8"""


piece("o_activity", rollup_sql("bid_time <= timestamp '2024-01-31 00:00:00'"))
piece("o_activity_early", rollup_sql("bid_time <= timestamp '2024-01-20 00:00:00'"))
piece(
    "o_activity_late",
    rollup_sql("bid_time > timestamp '2024-01-10 00:00:00' and bid_time <= timestamp '2024-01-31 00:00:00'"),
)
piece("o_slice", "select * from o_activity where date > date '2024-01-04' and date <= date '2024-07-02'")


@query("user_activity_rollup", rollup_sql(f"bid_time <= timestamp '{CUT}'"))
def _(i):
    return bidstream.user_activity_rollup(i.bid_log, CUT)


@query(
    "consume_raw",
    f"select cast(bid_time <= timestamp '{CUT}' as boolean) as done, count(*) as n, min(bid_time)::date as first_day, max(bid_time)::date as last_day "
    "from in_bid_log group by 1",
)
def _(i):
    done, rest = bidstream.consume_raw(i.bid_log, CUT)
    both = done.withColumn("done", F.lit(True)).unionByName(rest.withColumn("done", F.lit(False)))
    return both.groupBy("done").agg(
        F.count(F.lit(1)).alias("n"),
        F.to_date(F.min("bid_time")).alias("first_day"),
        F.to_date(F.max("bid_time")).alias("last_day"),
    )


@query(
    "user_activity_merge",
    """
select * from o_activity_early
union all
select a.* from o_activity_late a where not exists (
  select 1 from o_activity_early b where a.page_url = b.page_url and a.date = b.date
  and a.publisher_domain_normalized = b.publisher_domain_normalized and a.pageviews = b.pageviews
  and a.user_id is not distinct from b.user_id and a.user_ip is not distinct from b.user_ip)""",
)
def _(i):
    return bidstream.user_activity_merge(i.activity_early, i.activity_late)


# -- locations
LATEST = f"""
select ip, date as date_updated, c as normalized_country_code, r as normalized_region_code, t as normalized_city_name, z as normalized_zip from (
  select user_ip as ip, date, bw_country_normalized as c, bw_region_normalized as r, bw_city_normalized as t, bw_zip_normalized as z,
    row_number() over (partition by user_ip order by date desc, (c || r || t || z) is null desc, c || r || t || z desc,
      c desc nulls last, r desc nulls last, t desc nulls last, z desc nulls last) as k
  from o_activity where user_ip is not null and length(user_ip) > 0) x where k = 1"""
piece("o_latest", LATEST)


@query("ip_location_latest", LATEST)
def _(i):
    return bidstream.ip_location_latest(i.activity)


@query(
    "ip_location_upsert",
    f"select ip, date_updated, {LOC} from o_latest union all "
    f"select ip, date_updated, {LOC} from in_ip_location where ip not in (select ip from o_latest)",
)
def _(i):
    return bidstream.ip_location_upsert(i.ip_location, bidstream.ip_location_latest(i.activity))


piece(
    "o_ranges",
    f"""
select {DAY} as date_updated, ip_range_start, {s.ip_number("ip_range_start")} as ip_range_start_numeric, ip_range_end,
  {s.ip_number("ip_range_end")} as ip_range_end_numeric, trim(upper(pulseplus_country)) as normalized_country_code,
  trim(upper(pulseplus_region)) as normalized_region_code, {s.city("pulseplus_city")} as normalized_city_name,
  pulseplus_metro_code as metro_code, pulseplus_postal_code as normalized_zip, pulseplus_country_conf as country_confidence,
  pulseplus_region_conf as region_confidence, pulseplus_city_conf as city_confidence, pulseplus_postal_conf as postal_confidence,
  isp_name, homebiz_type, company_name, {s.domain("domain_name")} as normalized_company_domain
from in_ip_range
where not ((company_name is null or length(company_name) < 2) and (domain_name is null or length(domain_name) < 2))
  and trim(upper(pulseplus_country)) in ('USA', 'CAN', 'GBR', 'DEU', 'SWE', 'NLD', 'NOR', 'FRA', 'ESP')
  and not starts_with({s.domain("domain_name")}, 'ip-')""",
)
piece(
    "o_best_loc",
    f"""
select ip, date_updated, {LOC} from (
  select *, row_number() over (partition by ip order by w, lo, date_updated, normalized_country_code nulls first, normalized_region_code nulls first,
    normalized_city_name nulls first, normalized_zip nulls first) as k
  from (select b.ip, r.ip_range_end_numeric - r.ip_range_start_numeric as w, r.ip_range_start_numeric as lo,
      case when sure then r.date_updated else b.date_updated end as date_updated,
      case when sure then r.normalized_country_code else b.normalized_country_code end as normalized_country_code,
      case when sure then r.normalized_region_code else b.normalized_region_code end as normalized_region_code,
      case when sure then r.normalized_city_name else b.normalized_city_name end as normalized_city_name,
      case when sure then r.normalized_zip else b.normalized_zip end as normalized_zip
    from o_latest b join (select *, country_confidence >= 30 and region_confidence >= 30 and city_confidence >= 30 as sure from o_ranges) r
    on {s.ip_number("b.ip")} between r.ip_range_start_numeric and r.ip_range_end_numeric) m) x where k = 1""",
)


@query(
    "ip_location_best_source",
    f"select ip, date_updated, {LOC} from o_best_loc union all "
    f"select ip, date_updated, {LOC} from in_ip_location where ip not in (select ip from o_best_loc)",
)
def _(i):
    latest = bidstream.ip_location_latest(i.activity)
    return bidstream.ip_location_best_source(i.ip_location, latest, i.ranges, threshold=30)


# -- companies
def obs_from_ranges_sql(activity: str, extra: str = "true") -> str:
    return f"""
select ip, normalized_company_domain, source, source_confidence, date from in_ip_domain_obs
union all
select ip, normalized_company_domain, 'DIGITAL ELEMENT', null, date_updated from (
  select distinct a.user_ip as ip, r.normalized_company_domain, r.date_updated
  from (select distinct user_ip from {activity} where length(user_ip) > 0 and {extra}) a join o_ranges r
  on {s.ip_number("a.user_ip")} between r.ip_range_start_numeric and r.ip_range_end_numeric
  where length(r.normalized_company_domain) > 1) f
where not exists (select 1 from in_ip_domain_obs t where t.ip = f.ip and t.normalized_company_domain = f.normalized_company_domain
  and t.source = 'DIGITAL ELEMENT' and t.date = f.date_updated)"""


@query("ip_domain_obs_from_ranges", obs_from_ranges_sql("o_activity"))
def _(i):
    return bidstream.ip_domain_obs_from_ranges(i.ip_domain_obs, i.activity, i.ranges)


def scores_sql(recency: str, guard: bool) -> str:
    share = "round(raw / total, 10)"
    share = f"case when total = 0 then {'0.0' if guard else 'null'} else {share} end"
    return f"""
select ip, normalized_company_domain, case when share is null then null else greatest(0.1::double, share) end as score from (
  select ip, normalized_company_domain, {share} as share from (
    select ip, normalized_company_domain, raw, sum(raw) over (partition by ip) as total from (
      select ip, normalized_company_domain, round(sum(score), 8) as raw from (
        select distinct ip, normalized_company_domain, source, source_confidence, date,
          round(coalesce(source_confidence, 1.0::double) * ({recency}) *
            (case source when 'DIGITAL ELEMENT' then 0.3 when 'IP FLOW' then 0.5 when 'FIVE BY FIVE' then 0.9 when 'LASTBOUNCE' then 0.7 else 0.5 end)::double, 10) as score
        from in_ip_domain_obs where normalized_company_domain <> 'Shared' and length(normalized_company_domain) > 1) a
      group by 1, 2) b) c where ip is not null) d"""


AGE = f"(1.0::double - 0.01::double * ({DAY} - date))"
piece("o_ip_domain", scores_sql(f"greatest(0.01::double, {AGE})", guard=False))


@query("ip_domain_scores", "select ip, normalized_company_domain, round(score, 6) as score from o_ip_domain")
def _(i):
    return i.fresh("ip_domain")


piece("o_ip_domain_guarded", scores_sql(AGE, guard=True))


@query(
    "ip_domain_scores_guarded",
    "select ip, normalized_company_domain, round(score, 6) as score from o_ip_domain_guarded",
)
def _(i):
    return bidstream.ip_domain_scores(i.ip_domain_obs, AS_OF, recency_floor=None, guard_zero=True)


@query(
    "ip_domain_scores_by_query_date",
    "select ip, normalized_company_domain, round(score, 6) as score from o_ip_domain_guarded",
)
def _(i):
    obs = i.ip_domain_obs.withColumnRenamed("date", "last_query_date")
    return bidstream.ip_domain_scores(
        obs, AS_OF, recency_floor=None, guard_zero=True, date_col="last_query_date"
    )


piece(
    "o_trio",
    f"""
select ip_trio, normalized_company_domain, case when total = 0 or raw is null then null else greatest(0.01::double, round(raw / total, 10)) end as score from (
  select *, sum(raw) over (partition by ip_trio) as total from (
    select {s.trio("ip")} as ip_trio, normalized_company_domain, round(sum(score), 8) as raw
    from o_ip_domain where normalized_company_domain not in (select domain from in_isp_domains) group by 1, 2) a) b""",
)


@query("ip_trio_scores", "select ip_trio, normalized_company_domain, round(score, 6) as score from o_trio")
def _(i):
    return i.fresh("trio_map")


# -- devices
def sightings(activity: str) -> str:
    return (
        f"select distinct user_id as bitoid, user_ip as ip, date from {activity} "
        "where length(user_ip) > 1 and not ends_with(user_ip, '.0') and length(user_id) > 1"
    )


piece("o_device_ip", sightings("o_activity"))
piece("o_device_ip_early", sightings("o_activity_early"))


@query(
    "device_ip_obs",
    "select * from o_device_ip_early union all select * from "
    f"({sightings('o_activity_late')}) s where (bitoid, ip, date) not in (select (bitoid, ip, date) from o_device_ip_early)",
)
def _(i):
    empty = i.empty("bitoid string, ip string, date date")
    return bidstream.device_ip_obs(bidstream.device_ip_obs(empty, i.activity_early), i.activity_late)


piece(
    "o_published",
    "select bitoid, ip, case when date < date '2024-01-10' then 'OTHER' else 'BEESWAX' end as source, date from o_device_ip_early",
)


@query(
    "device_ip_obs_publish",
    """
select bitoid, ip, source, date from o_published
union all
select bitoid, ip, 'BEESWAX', date from o_device_ip where (bitoid, ip, date) not in (select (bitoid, ip, date) from o_published where source = 'BEESWAX')""",
)
def _(i):
    empty = i.empty("bitoid string, ip string, date date")
    early = F.col("date") < F.lit(dt.date(2024, 1, 10))
    target = bidstream.device_ip_obs(empty, i.activity_early).select(
        "bitoid", "ip", F.when(early, "OTHER").otherwise("BEESWAX").alias("source"), "date"
    )
    return bidstream.device_ip_obs_publish(target, i.device_ip)


piece(
    "o_device_known",
    "select 'u' || s_suppkey as bitoid, 'company' || (s_suppkey + s_nationkey % 3) || '.com' as normalized_company_domain, "
    "'PARTNER' as source, 0.4::double as source_confidence, date '2024-01-12' as date from supplier",
)
piece(
    "o_device_obs",
    """
select bitoid, normalized_company_domain, source, source_confidence, date from o_device_known
union all
select d.bitoid, m.normalized_company_domain, 'BEESWAX-VIA-IP', max(m.score), d.date
from o_device_ip d join o_ip_domain m on d.ip = m.ip where length(m.normalized_company_domain) > 1 group by 1, 2, 5""",
)


@query(
    "device_domain_obs",
    "select bitoid, normalized_company_domain, source, round(source_confidence, 6) as source_confidence, date from o_device_obs",
)
def _(i):
    return i.fresh("device_obs")


piece(
    "o_device_best",
    """
select bitoid, normalized_company_domain, score from (
  select *, row_number() over (partition by bitoid order by score desc nulls first, normalized_company_domain desc) as k from (
    select a.bitoid, normalized_company_domain,
      round((case when count(distinct source) > 1 then 1.0::double else max(source_confidence) end) * (count(*)::double / max(total)), 9) as score
    from (select * from o_device_obs where normalized_company_domain not in (select domain from in_isp_domains)) a
    join (select bitoid, count(*) as total from o_device_obs where normalized_company_domain not in (select domain from in_isp_domains) group by 1) t on a.bitoid = t.bitoid
    where normalized_company_domain <> 'Shared' group by 1, 2) r) x where k = 1""",
)


@query("device_domain_best", "select bitoid, normalized_company_domain, round(score, 6) as score from o_device_best")
def _(i):
    return i.fresh("device_best")


# -- company activity
piece(
    "o_resolvable",
    """
select distinct m.normalized_company_domain, a.date from o_slice a join o_ip_domain m on a.user_ip = m.ip
where not ends_with(m.ip, '.0') and m.normalized_company_domain not in (select domain from in_isp_domains)
and length(m.normalized_company_domain) > 1 and m.normalized_company_domain <> 'shared'""",
)


piece(
    "o_resolvable_known",
    "select distinct normalized_company_domain, date '2024-01-15' as date from in_ip_domain_obs",
)


@query(
    "ip_resolvable_domains",
    """
select * from o_resolvable_known union all
select * from o_resolvable r where not exists (select 1 from o_resolvable_known t where t.normalized_company_domain = r.normalized_company_domain and t.date = r.date)""",
)
def _(i):
    target = i.ip_domain_obs.select(
        "normalized_company_domain", F.lit(dt.date(2024, 1, 15)).alias("date")
    ).distinct()
    return bidstream.ip_resolvable_domains(target, i.activity_slice, i.ip_domain, i.isp_domains)


piece(
    "o_by_ip",
    """select a.*, m.normalized_company_domain, m.score from o_slice a left join (
  select ip, normalized_company_domain, score from o_ip_domain where not ends_with(ip, '.0') and length(normalized_company_domain) > 1
  and normalized_company_domain <> 'shared' and normalized_company_domain not in (select domain from in_isp_domains)) m on a.user_ip = m.ip""",
)
piece("o_open", "select * exclude (normalized_company_domain, score) from o_by_ip where normalized_company_domain is null")
piece(
    "o_by_device",
    """select a.*, d.normalized_company_domain, d.score from o_open a join o_device_best d on a.user_id = d.bitoid
where length(d.normalized_company_domain) > 1 and d.normalized_company_domain <> 'shared'""",
)


def by_trio_sql(open_rows: str) -> str:
    return f"""select a.*, t.normalized_company_domain, t.score from {open_rows} a join (
  select * from o_trio where length(normalized_company_domain) > 1 and normalized_company_domain <> 'shared'
  and normalized_company_domain not in (select normalized_company_domain from o_resolvable where date between {DAY} - 180 and {DAY})) t
on {s.trio("a.user_ip")} = t.ip_trio"""


piece("o_by_trio", by_trio_sql("o_open"))
piece(
    "o_by_trio_only",
    by_trio_sql(
        "(select * from o_open where user_id is null or user_id not in (select bitoid from o_device_best "
        "where length(normalized_company_domain) > 1 and normalized_company_domain <> 'shared'))"
    ),
)


def company_sql(trio: str) -> str:
    return f"""
select page_url, normalized_company_domain, date, c as normalized_country_code, r as normalized_region_code, t as normalized_city_name, z as normalized_zip,
  min(publisher_domain_normalized) as publisher_domain_normalized, sum(pageviews)::bigint as pageviews, sum(score * pageviews) as weighted_pageviews,
  count(distinct user_id) as unique_devices, count(distinct user_ip) as unique_ips
from (select *, case when regexp_matches(zip, '^[+-]?[0-9]+$') and c = 'USA' and length(zip) = 4 then '0' || zip else zip end as z from (
  select a.*, case when whole then lc else bw_country_normalized end as c, case when whole then lr else bw_region_normalized end as r,
    case when whole then lt else geo_city end as t, case when whole then lz else bw_zip_normalized end as zip
  from (select a.*, l.normalized_country_code as lc, l.normalized_region_code as lr, l.normalized_city_name as lt, l.normalized_zip as lz,
      l.normalized_country_code is not null and l.normalized_region_code is not null and l.normalized_city_name is not null and l.normalized_zip is not null as whole,
      g.normalized_city_name as geo_city
    from (select * from o_by_ip where normalized_company_domain is not null union all select * from o_by_device union all select * from {trio}) a
    left join in_ip_location l on a.user_ip = l.ip
    left join in_geos g on a.bw_country_normalized = g.normalized_country_code and a.bw_region_normalized = g.normalized_region_code and a.bw_zip_normalized = g.normalized_zip) a) b) x
where c is not null and r is not null and t is not null and z is not null
group by 1, 2, 3, 4, 5, 6, 7"""


piece("o_company", company_sql("o_by_trio"))
piece("o_company_exclusive", company_sql("o_by_trio_only"))
COMPANY = (
    f"{ACT}, publisher_domain_normalized, pageviews, round(weighted_pageviews, 6) as weighted_pageviews, "
    "unique_devices, unique_ips"
)


@query("company_activity", f"select {COMPANY} from o_company")
def _(i):
    return i.fresh("company_activity")


@query("company_activity_exclusive_tiers", f"select {COMPANY} from o_company_exclusive")
def _(i):
    return bidstream.company_activity(
        i.activity_slice, i.ip_domain, i.device_best, i.trio_map, i.resolvable, i.ip_location, i.geos,
        i.isp_domains, AS_OF, exclusive_tiers=True,
    )


MID = "date '2024-01-20'"


@query(
    "company_activity_replace_slice",
    f"select {COMPANY} from o_company where date <= {MID} union all "
    f"select {COMPANY.replace('pageviews, round', 'pageviews + 1 as pageviews, round', 1)} from o_company where date > {MID}",
)
def _(i):
    fresh = i.company_activity.filter(F.col("date") > F.lit(dt.date(2024, 1, 20)))
    return bidstream.company_activity_replace_slice(
        i.company_activity, fresh.withColumn("pageviews", F.col("pageviews") + 1), dt.date(2024, 1, 20)
    )


@query("company_activity_merge", f"select {COMPANY} from o_company")
def _(i):
    target = i.company_activity.filter(F.col("date") <= F.lit(dt.date(2024, 1, 20)))
    cache = i.company_activity.filter(F.col("date") > F.lit(dt.date(2024, 1, 10)))
    return bidstream.company_activity_merge(target, cache)


@query(
    "user_activity_consume",
    "select page_url, user_id, user_ip, date, pageviews from o_activity where date not in (select date from o_company)",
)
def _(i):
    rest = bidstream.user_activity_consume(i.activity, i.company_activity)
    return rest.select("page_url", "user_id", "user_ip", "date", "pageviews")


# -- enrichment and prescoring
piece(
    "o_topics_flat",
    f"""select distinct page_url, f.parentCategory as parent_category, f.category as category, f.topic as topic, f.probability as probability
from (select page_url, unnest({s.topics("intent_topics")}) as f from in_topic_output) x""",
)
piece(
    "o_brands_flat",
    f"""select distinct page_url, f.parentCategory as parent_category, f.category as category, f.topic as topic, f.probability as probability
from (select page_url, unnest({s.topics("brand_topics")}) as f from in_brand_output) x""",
)
LABELS = """
  json_extract(c.context, '$."review/comparison"')::bigint as review, json_extract(t.topics, '$."BUSINESS"')::double as b1,
  json_extract(t.topics, '$."BUSINESS NEWS"')::double as b2, json_extract(t.topics, '$."SCIENCE TECH NEWS"')::double as b3, t.url_type, t.activity_type, t.information_type"""


def enriched_sql(activity: str) -> str:
    half = (
        f"select a.*, f.parent_category, f.category, f.topic, f.probability, {LABELS} from {activity} a join {{flat}} f on a.page_url = f.page_url "
        "join in_context_output c on a.page_url = c.page_url join in_title_output t on a.page_url = t.page_url"
    )
    return half.format(flat="o_topics_flat") + " union " + half.format(flat="o_brands_flat")


piece("o_enriched", enriched_sql("o_company"))
ENRICHED = (
    f"select {COMPANY}, parent_category, category, topic, probability, review, round(b1, 6) as b1, round(b2, 6) as b2, "
    "round(b3, 6) as b3, url_type, activity_type, information_type from "
)


def enriched_out(df):
    return df.select(
        *[c for c in df.columns if c not in ("context_output", "title_output")],
        F.col("context_output.`review/comparison`").alias("review"),
        F.col("title_output.BUSINESS").alias("b1"),
        F.col("title_output.`BUSINESS NEWS`").alias("b2"),
        F.col("title_output.`SCIENCE TECH NEWS`").alias("b3"),
    )


@query("enrich_activity", ENRICHED + "o_enriched")
def _(i):
    return enriched_out(
        enrichment.enrich_activity(i.company_activity, i.topics, i.brands, i.context, i.titles)
    )


KEYS9 = "normalized_company_domain, parent_category, category, topic, " + LOC + ", date"


def prescoring_sql(enriched: str, averages: str) -> str:
    relevance = s.strict_greatest("b1", "b2", "b3")
    return f"""
select {KEYS9}, sum(pageviews)::bigint as pageviews, sum(probability::double * weighted_pageviews * ({relevance})) as weighted_pageviews, {averages.format(relevance=relevance)},
  sum(review)::bigint as review_pageviews, count(distinct page_url) as unique_pages, count(distinct publisher_domain_normalized) as unique_pubs,
  sum(unique_devices)::bigint as unique_devices, sum(unique_ips)::bigint as unique_ips
from {enriched} group by {KEYS9}"""


MEASURED = """avg({relevance}) as avg_page_relevance,
  avg((case activity_type when 'downloading' then 100 when 'reading' then 85 when 'visiting' then 50 when 'executing' then 10 when 'contacting' then 10 else 5 end)::double) as activity_type_score,
  avg((case information_type when 'informational' then 100 when 'transactional' then 75 when 'navigational' then 25 else 5 end)::double) as information_type_score"""
piece("o_prescoring", prescoring_sql("o_enriched", MEASURED))
PRE = f"{KEYS9}, pageviews, " + ", ".join(
    f"round({c}, 6) as {c}"
    for c in ("weighted_pageviews", "avg_page_relevance", "activity_type_score", "information_type_score")
) + ", review_pageviews, unique_pages, unique_pubs, unique_devices, unique_ips"


@query("prescoring_rollup", f"select {PRE} from o_prescoring")
def _(i):
    return enrichment.prescoring_rollup(i.fresh("enriched"))


def same_loc(a: str = "t", b: str = "s") -> str:
    return " and ".join(f"{a}.{c.strip()} is not distinct from {b}.{c.strip()}" for c in LOC.split(","))


def merge_sql(target: str, source: str, aligned: bool, fixed: bool = False) -> str:
    """Checking SQL of the prescoring merge: updated, untouched and new rows."""
    if aligned:
        on = "t.parent_category = s.parent_category and t.category = s.category and t.topic = s.topic"
    else:
        on = "t.parent_category = s.category and t.category = s.category and t.topic = s.category"
    on += f" and t.normalized_company_domain = s.normalized_company_domain and t.date = s.date and {same_loc()}"
    tkeys = ", ".join(f"t.{k.strip()}" for k in KEYS9.split(","))
    mean = lambda c: f"(s.{c} * s.pageviews + t.{c} * t.pageviews) / (s.pageviews + t.pageviews)"
    averages = {
        "avg_page_relevance": "1.0::double" if fixed else mean("avg_page_relevance"),
        "activity_type_score": "100.0::double" if fixed else mean("activity_type_score"),
        "information_type_score": "100.0::double" if fixed else mean("information_type_score"),
    }
    total = lambda c: f"s.{c} + t.{c} as {c}"
    cols = (
        f"{total('pageviews')}, {total('weighted_pageviews')}, "
        + ", ".join(f"{e} as {c}" for c, e in averages.items())
        + ", "
        + ", ".join(total(c) for c in ("review_pageviews", "unique_pages", "unique_pubs", "unique_devices", "unique_ips"))
    )
    names = f"{KEYS9}, pageviews, weighted_pageviews, avg_page_relevance, activity_type_score, information_type_score, review_pageviews, unique_pages, unique_pubs, unique_devices, unique_ips"
    return f"""select {PRE} from (
select {tkeys}, {cols} from {target} t join {source} s on {on}
union all select {names} from {target} t where not exists (select 1 from {source} s where {on})
union all select {names} from {source} s where not exists (select 1 from {target} t where {on})) m"""


# prescoring rows of early and late days as target and batch, overlapping for ten days
piece("o_pre_target", "select * from in_prescoring_bid where date <= date '2024-01-20'")
piece("o_pre_source", "select * from in_prescoring_bid where date > date '2024-01-10'")


def _halves(df):
    return (
        df.filter(F.col("date") <= F.lit(dt.date(2024, 1, 20))),
        df.filter(F.col("date") > F.lit(dt.date(2024, 1, 10))),
    )


@query("prescoring_merge", merge_sql("o_pre_target", "o_pre_source", aligned=False))
def _(i):
    return enrichment.prescoring_merge(*_halves(i.prescoring_bid))


@query("prescoring_merge_aligned", merge_sql("o_pre_target", "o_pre_source", aligned=True))
def _(i):
    return enrichment.prescoring_merge(*_halves(i.prescoring_bid), key_mode="aligned")


@query(
    "company_activity_consume",
    f"select {COMPANY} from o_company a where not exists (select 1 from o_enriched s where a.page_url = s.page_url and "
    f"a.normalized_company_domain = s.normalized_company_domain and a.date = s.date and {same_loc('a')})",
)
def _(i):
    return bidstream.company_activity_consume(i.company_activity, i.fresh("enriched"))


# -- URLs
def url_stats_sql(rows: str) -> str:
    return (
        "select page_url, min(publisher_domain_normalized) as publisher_domain_normalized, min(date) as first_seen, "
        f"max(date) as last_seen, count(*) as frequency from {rows} group by 1"
    )


def url_merge_sql(target: str, source: str) -> str:
    return f"""
select s.page_url, md5(s.page_url) as page_url_md5, s.publisher_domain_normalized, coalesce(t.first_seen, s.first_seen) as first_seen, s.last_seen,
  case when t.page_url is null then s.frequency when t.last_seen = s.last_seen then t.frequency else t.frequency + s.frequency end as frequency
from {source} s left join {target} t on t.page_url = s.page_url
union all
select page_url, md5(page_url), publisher_domain_normalized, first_seen, last_seen, frequency from {target} where page_url not in (select page_url from {source})"""


piece("o_urls_early", url_stats_sql("o_activity_early"))
piece("o_urls_slice", url_stats_sql("(select * from o_company where date > date '2024-01-12' and date <= date '2024-01-12' + 180)"))
piece("o_urls", url_stats_sql("o_activity"))


def url_out(df):
    return df.withColumn("page_url_md5", F.md5("page_url")).drop("page_url_hash")


@query("unique_urls", url_merge_sql("o_urls_early", "o_urls_slice"))
def _(i):
    from tidemark.operators import incremental_slice

    target = bidstream.url_stats(i.activity_early)
    rows = incremental_slice(i.company_activity, "date", dt.date(2024, 1, 12), bidstream.SLICE_DAYS)
    return url_out(bidstream.unique_urls(target, rows))


@query("unique_urls_merge", url_merge_sql("o_urls_early", "o_urls"))
def _(i):
    target = bidstream.url_stats(i.activity_early)
    return url_out(bidstream.unique_urls_merge(target, bidstream.url_stats(i.activity)))


# the queue holds the .com pages already, some of them pushed
piece(
    "o_queue",
    "select url as page_url, date '2024-01-02' + (page_id % 5)::int as date_inserted, "
    "case when page_id % 3 = 0 then date '2024-01-09' end as date_pushed from pages where url like '%.com/%'",
)


def queue(i):
    return i.pages.filter(F.col("url").contains(".com/")).select(
        F.col("url").alias("page_url"),
        F.date_add(F.lit(dt.date(2024, 1, 2)), (F.col("page_id") % 5).cast("int")).alias("date_inserted"),
        F.when(F.col("page_id") % 3 == 0, F.lit(dt.date(2024, 1, 9))).alias("date_pushed"),
    )


def enqueue_sql(fresh: str) -> str:
    return f"""
select page_url, case when page_url in (select page_url from {fresh}) then {DAY} else date_inserted end as date_inserted, date_pushed from o_queue
union all
select page_url, {DAY}, null from {fresh} where page_url not in (select page_url from o_queue)"""


piece(
    "o_scrape_fresh",
    """
select page_url from o_urls where page_url not in (select page_url from in_scrape_results where last_scraped is not null)
and publisher_domain_normalized not in (select publisher_domain_normalized from in_bad_pubs)
order by last_seen desc, md5(page_url), page_url limit 20""",
)


@query("scrape_queue", enqueue_sql("o_scrape_fresh"))
def _(i):
    urls = bidstream.url_stats(i.activity)
    return bidstream.scrape_queue(queue(i), urls, i.scrape_results, i.bad_pubs, AS_OF, limit=20)


@query(
    "scrape_queue_prune",
    "select page_url, md5(page_url) as page_url_md5, publisher_domain_normalized, first_seen, last_seen, frequency from o_urls "
    "where page_url not in (select page_url from o_queue) and page_url not in (select page_url from in_scrape_results)",
)
def _(i):
    urls = bidstream.url_stats(i.activity)
    return url_out(bidstream.scrape_queue_prune(urls, queue(i), i.scrape_results))
