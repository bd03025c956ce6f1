"""Lookup, vendor and lead queries and their checking SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.plans import lookup, vendors
from tidemark.sources import ip_range_load, lead_load
from workload import sqltext as s
from workload.base import AS_OF, piece, query
from workload.bid_queries import DAY, LOC

EARLY, LATE = dt.date(2024, 1, 20), dt.date(2024, 1, 10)


@query(
    "lookup_candidates",
    f"""
select user_ip from (
  select user_ip, count(page_url) as frequency from o_activity where user_ip is not null group by 1) f
where user_ip not in (select ip_address from in_vendor_ip) and user_ip not in (select user_ip from in_lookup_output where last_response_code = 200)
and not exists (select 1 from in_lookup_output b where b.user_ip = f.user_ip and b.last_query_date >= {DAY} - 30 and b.last_response_code = 204)
order by case when split_part(user_ip, '.', 4) = '0' then 1 else 0 end, frequency desc, user_ip limit 100""",
)
def _(i):
    return lookup.lookup_candidates(i.activity, i.vendor_ip, i.lookup_output, AS_OF, limit=100)


@query(
    "lookup_success",
    "select user_ip, last_response_code::bigint as last_response_code, last_query_date, api_response from in_lookup_output where last_response_code = 200",
)
def _(i):
    return lookup.lookup_success(i.lookup_output)


def answers_sql(where: str) -> str:
    return f"""
select user_ip, lowest::bigint as last_response_code, last_query_date, api_response from (
  select user_ip, api_response, last_query_date, min(last_response_code) over (partition by user_ip) as lowest,
    row_number() over (partition by user_ip order by last_query_date desc, last_response_code, api_response desc) as k
  from in_lookup_output where {where}) x where k = 1"""


def upsert_answers(target: str, source: str) -> str:
    return f"select * from {source} union all select * from {target} where user_ip not in (select user_ip from {source})"


for name, cond in {"answers": "true", "found": "last_response_code = 200"}.items():
    piece(f"o_{name}", answers_sql(cond))
    piece(f"o_{name}_early", answers_sql(f"{cond} and last_query_date <= date '{EARLY}'"))
    piece(f"o_{name}_late", answers_sql(f"{cond} and last_query_date > date '{LATE}'"))


def _halves(rows):
    day = F.col("last_query_date")
    return rows.filter(day <= F.lit(EARLY)), rows.filter(day > F.lit(LATE))


@query("lookup_latest", upsert_answers("o_answers_early", "o_answers_late"))
def _(i):
    early, late = _halves(i.lookup_output)
    return lookup.lookup_latest(lookup.one_answer_per_ip(early), late)


@query("lookup_mappings", upsert_answers("o_found_early", "o_found_late"))
def _(i):
    early, late = _halves(lookup.lookup_success(i.lookup_output))
    return lookup.lookup_mappings(lookup.one_answer_per_ip(early), late)


@query(
    "lookup_latest_incremental",
    upsert_answers("o_answers_early", "(select * from o_answers_late where user_ip is not null)"),
)
def _(i):
    early, late = _halves(i.lookup_output)
    return lookup.lookup_latest(lookup.one_answer_per_ip(early), late, drop_null_keys=True)


piece(
    "o_site",
    "select user_ip as ip, split_part(json_extract_string(api_response, '$.website'), '.', 2) || '.' || "
    "split_part(json_extract_string(api_response, '$.website'), '.', 3) as normalized_company_domain, last_query_date as date from o_found",
)


@query(
    "lookup_domain_obs",
    """
select ip, normalized_company_domain, 'IP FLOW' as source, null::double as source_confidence, date from o_site
union all
select ip, normalized_company_domain, source, source_confidence, date from in_ip_domain_obs t
where not (source = 'IP FLOW' and ip in (select ip from o_site))
union all
select s.ip, s.normalized_company_domain, 'IP FLOW', null, s.date from o_site s
join (select ip, count(*) as n from in_ip_domain_obs where source = 'IP FLOW' group by 1) t on t.ip = s.ip, range(t.n - 1) r""",
)
def _(i):
    return lookup.lookup_domain_obs(i.ip_domain_obs, lookup.lookup_success(i.lookup_output))


piece(
    "o_normal_loc",
    """
select distinct user_ip as ip, last_query_date as date_updated, isocode_3 as normalized_country_code, region_isocode_2 as normalized_region_code,
  json_extract_string(api_response, '$.location.town') as normalized_city_name,
  case when json_extract_string(api_response, '$.location.countryCode') = 'US' then json_extract_string(api_response, '$.location.postalCode') end as normalized_zip
from in_lookup_output left join in_country_iso on json_extract_string(api_response, '$.location.countryCode') = isocode_2
left join in_region_codes on json_extract_string(api_response, '$.location.region') = region_name where last_response_code = 200""",
)


@query("normalize_location", "select * from o_normal_loc")
def _(i):
    return lookup.normalize_location(lookup.lookup_success(i.lookup_output), i.country_iso, i.region_codes)


piece(
    "o_one_loc",
    f"""
select ip, date_updated, {LOC} from (
  select *, row_number() over (partition by ip order by date_updated desc, coalesce(normalized_country_code, '') || '|' || coalesce(normalized_region_code, '') || '|' ||
    coalesce(normalized_city_name, '') || '|' || coalesce(normalized_zip, '') desc) as k from o_normal_loc) x where k = 1""",
)


@query(
    "lookup_location_upsert",
    f"select ip, date_updated, {LOC} from o_one_loc union all select ip, date_updated, {LOC} from in_ip_location where ip not in (select ip from o_one_loc)",
)
def _(i):
    found = lookup.normalize_location(lookup.lookup_success(i.lookup_output), i.country_iso, i.region_codes)
    return lookup.lookup_location_upsert(i.ip_location, found)


# -- vendor files
@query("ip_range_clean", "select * from o_ranges")
def _(i):
    return vendors.ip_range_clean(i.ip_range, AS_OF)


@query("ip_range_load", "select * from in_ip_range")
def _(i):
    path = f"{i.folder}/ranges_csv"
    writer = i.ip_range.write.option("header", "true").option("compression", "gzip")
    writer.option("ignoreLeadingWhiteSpace", "false").csv(path)
    return ip_range_load(i.spark, path, partitions=8)


@query(
    "vendor_ip_domain_obs",
    f"""
select ip, normalized_company_domain, source, source_confidence, date from in_ip_domain_obs
union all
select distinct ip_address, d, 'FIVE BY FIVE', distribution_percentage, {DAY} from (
  select ip_address, {s.domain("company_domain")} as d, distribution_percentage from in_vendor_ip
  union all select ip_address, {s.domain("other")}, distribution_percentage from (select *, unnest(string_split(company_domain_array, ',')) as other from in_vendor_ip) u) v
where d <> 'Shared' and length(d) > 1
and not exists (select 1 from in_ip_domain_obs t where t.ip = v.ip_address and t.normalized_company_domain = v.d and t.source = 'FIVE BY FIVE' and t.date = {DAY})""",
)
def _(i):
    return vendors.vendor_ip_domain_obs(i.ip_domain_obs, i.vendor_ip, AS_OF)


# -- leads
LEAD = "file_date, category, domain, company, entity_trigger, seniority, entity_function, trigger_type, industry, company_size, city, state, country"
TEXTS = [c.strip() for c in LEAD.split(",")][1:]
MARKED = "file_date, " + ", ".join(f"coalesce({c}, 'NULL VALUE') as {c}" for c in TEXTS)


@query("lead_load", f"select {LEAD}, score::bigint as score from in_lead_flat")
def _(i):
    good, bad = f"{i.folder}/leads/part=good", f"{i.folder}/leads/part=bad"
    rows = i.lead_flat.withColumn("file_date", F.col("file_date").cast("string"))
    rows.write.option("header", "true").csv(good)
    # the same rows with an unreadable score: none of these files may be loaded
    broken = rows.withColumn("score", F.lit("not a number"))
    broken.write.option("header", "true").csv(bad)
    return lead_load(i.spark, f"{i.folder}/leads")


piece("o_leads_old", "select * from in_lead_flat where file_date < date '1998-01-01'")
piece("o_leads_marked", f"select {MARKED}, coalesce(score, 0) as score from o_leads_old")
piece(
    "o_leads_new",
    f"select {LEAD}, max(coalesce(score, 0)) as score from (select {MARKED}, score from in_lead_flat where file_date >= date '1997-07-01') x group by {LEAD}",
)


@query(
    "lead_dedupe_merge",
    f"select {LEAD}, score::bigint as score from o_leads_old union all "
    f"select {LEAD}, score::bigint from o_leads_new where ({LEAD}, score) not in (select ({LEAD}, score) from o_leads_marked)",
)
def _(i):
    day = F.col("file_date")
    target = i.lead_flat.filter(day < F.lit(dt.date(1998, 1, 1)))
    return vendors.lead_dedupe_merge(target, i.lead_flat.filter(day >= F.lit(dt.date(1997, 7, 1))))


@query(
    "lead_prescoring",
    f"""
select file_date as date, ds_parent_category as parent_category, ds_category as category, ds_topic as topic, {s.domain("domain")} as normalized_company_domain, max(score)::bigint as leadsift_score
from in_lead_flat join in_lead_topic_map on entity_trigger = leadsift_category group by 1, 2, 3, 4, 5""",
)
def _(i):
    return vendors.lead_prescoring(i.lead_flat, i.lead_topic_map)
