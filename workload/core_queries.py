"""Building blocks and column functions over whole test tables, with checking SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark import functions as fn
from tidemark import operators as op
from tidemark.sources import load_table, save_table
from workload import sqltext as s
from workload.base import piece, query

# -- table state: customers' order totals before 1998, updated by those from mid 1997 on
piece(
    "o_tot_old",
    "select case when o_custkey % 50 = 0 then null else o_custkey end as custkey, o_orderpriority as priority, count(*) as n, max(o_orderdate)::date as last_day from orders where o_orderdate < timestamp '1998-01-01' group by 1, 2",
)
piece(
    "o_tot_new",
    "select case when o_custkey % 50 = 0 then null else o_custkey end as custkey, o_orderpriority as priority, count(*) as n, max(o_orderdate)::date as last_day from orders where o_orderdate >= timestamp '1997-07-01' group by 1, 2",
)


def _totals(i):
    rows = i.orders.withColumn("custkey", F.when(F.col("o_custkey") % 50 != 0, F.col("o_custkey")))
    day = F.col("o_orderdate")

    def grouped(cond):
        return (
            rows.filter(cond)
            .groupBy("custkey", F.col("o_orderpriority").alias("priority"))
            .agg(F.count(F.lit(1)).alias("n"), F.to_date(F.max(day)).alias("last_day"))
        )

    old = day < F.lit(dt.datetime(1998, 1, 1))
    return grouped(old), grouped(day >= F.lit(dt.datetime(1997, 7, 1)))


def upsert_sql(equal: str) -> str:
    on = f"t.custkey {equal} s.custkey and t.priority = s.priority"
    return f"""
select t.custkey, t.priority, t.n + s.n as n, s.last_day from o_tot_old t join o_tot_new s on {on}
union all select t.custkey, t.priority, t.n, t.last_day from o_tot_old t where not exists (select 1 from o_tot_new s where {on})
union all select s.custkey, s.priority, s.n, s.last_day from o_tot_new s where not exists (select 1 from o_tot_old t where {on})"""


def _update():
    return {"n": F.col("t.n") + F.col("s.n"), "last_day": F.col("s.last_day")}


@query("upsert", upsert_sql("="))
def _(i):
    old, new = _totals(i)
    return op.upsert(old, new, ["custkey", "priority"], _update())


@query("upsert_null_safe", upsert_sql("is not distinct from"))
def _(i):
    old, new = _totals(i)
    return op.upsert(old, new, ["custkey", "priority"], _update(), null_safe=["custkey"])


def insert_sql(equal: str, extra: str = "") -> str:
    return (
        "select * from o_tot_old union all select * from o_tot_new s where not exists "
        f"(select 1 from o_tot_old t where t.custkey {equal} s.custkey and t.priority = s.priority{extra})"
    )


@query("insert_new", insert_sql("=", " and t.n > 2"))
def _(i):
    old, new = _totals(i)
    return op.insert_new(old, new, ["custkey", "priority"], target_filter=F.col("n") > 2)


@query("insert_new_null_safe", insert_sql("is not distinct from"))
def _(i):
    old, new = _totals(i)
    return op.insert_new(old, new, ["custkey", "priority"], null_safe=["custkey"])


@query(
    "delete_matching",
    "select * from o_tot_old t where not exists (select 1 from o_tot_new s where t.custkey = s.custkey and t.priority = s.priority)",
)
def _(i):
    return op.delete_matching(*_totals(i), ["custkey", "priority"])


@query(
    "delete_matching_null_safe",
    "select * from o_tot_old t where not exists (select 1 from o_tot_new s where t.custkey is not distinct from s.custkey and t.priority = s.priority)",
)
def _(i):
    return op.delete_matching(*_totals(i), ["custkey", "priority"], null_safe=["custkey"])


# -- relational blocks
piece(
    "o_addresses",
    f"select distinct ip_address as ip, {s.ip_number('ip_address')} as ip_number from in_bid_log where ip_address is not null",
)


@query(
    "ip_range_join",
    "select a.ip, r.ip_range_start, r.ip_range_end, r.company_name from o_addresses a join o_ranges r "
    "on a.ip_number between r.ip_range_start_numeric and r.ip_range_end_numeric",
)
def _(i):
    ips = i.bid_log.select(F.col("ip_address").alias("ip")).distinct()
    ips = ips.withColumn("ip_number", fn.ip_to_number(F.col("ip")))
    found = op.ip_range_join(ips, "ip_number", i.ranges)
    return found.select("ip", "ip_range_start", "ip_range_end", "company_name")


@query(
    "not_in_null_aware",
    "select ip, normalized_company_domain from in_ip_domain_obs where normalized_company_domain not in (select domain from in_isp_domains)",
)
def _(i):
    kept = op.anti(i.ip_domain_obs, i.isp_domains, "normalized_company_domain", "domain")
    return kept.select("ip", "normalized_company_domain")


@query(
    "not_in_null_in_list",
    "select o_orderkey, o_custkey from orders where o_custkey not in (select custkey from o_tot_new)",
)
def _(i):
    return op.anti(i.orders, _totals(i)[1], "o_custkey", "custkey").select("o_orderkey", "o_custkey")


@query(
    "not_exists",
    "select o_orderkey, o_custkey from orders where not exists (select 1 from o_tot_new where custkey = o_custkey)",
)
def _(i):
    kept = op.anti(i.orders, _totals(i)[1], "o_custkey", "custkey", null_aware=False)
    return kept.select("o_orderkey", "o_custkey")


@query(
    "semi_join",
    "select ip, normalized_company_domain from in_ip_domain_obs where normalized_company_domain in (select domain from in_isp_domains)",
)
def _(i):
    kept = op.semi(i.ip_domain_obs, i.isp_domains, "normalized_company_domain", "domain")
    return kept.select("ip", "normalized_company_domain")


@query(
    "mark_shared",
    "select ip, case when normalized_company_domain in (select domain from in_isp_domains) then 'Shared' else normalized_company_domain end as normalized_company_domain from in_ip_domain_obs",
)
def _(i):
    marked = op.mark_shared(i.ip_domain_obs, "normalized_company_domain", i.isp_domains)
    return marked.select("ip", "normalized_company_domain")


@query("flatten_topics", "select * from o_topics_flat")
def _(i):
    return op.flatten_topics(i.topics, "intent_topics")


@query("flatten_brand_topics", "select * from o_brands_flat")
def _(i):
    return op.flatten_topics(i.brands, "brand_topics", one_row_per_key=True)


def share_sql(floor: str) -> str:
    return f"""
select l_partkey, l_suppkey, round({floor.format(share='round(q / sum(q) over (partition by l_partkey), 10)')}, 6) as share
from (select l_partkey, l_suppkey, sum(l_quantity) as q from lineitem group by 1, 2) x"""


def _quantities(i):
    return i.lineitem.groupBy("l_partkey", "l_suppkey").agg(F.sum("l_quantity").alias("q"))


@query("share_of_total", share_sql("{share}"))
def _(i):
    return op.share_of_total(_quantities(i), "l_partkey", "q", "share").drop("q")


@query("share_of_total_floor", share_sql("greatest(0.1::double, {share})"))
def _(i):
    return op.share_of_total(_quantities(i), "l_partkey", "q", "share", floor=0.1).drop("q")


@query(
    "incremental_slice",
    "select event_id, event_type from events where ts::date > (select max(ts)::date from events where event_type = 'view') - 10 "
    "and ts::date <= (select max(ts)::date from events where event_type = 'view') - 10 + 5",
)
def _(i):
    rows = i.events.withColumn("date", F.to_date("ts"))
    seen = rows.filter(F.col("event_type") == "view").withColumn("date", F.date_sub("date", 10))
    mark = op.high_water_mark(seen, "date", dt.date(2022, 10, 13))
    return op.incremental_slice(rows, "date", mark, 5).select("event_id", "event_type")


@query(
    "incremental_slice_inclusive",
    "select event_id, event_type from events where ts::date >= date '2024-01-10' and ts::date <= date '2024-01-25'",
)
def _(i):
    rows = i.events.withColumn("date", F.to_date("ts"))
    mark = op.high_water_mark(rows.filter(F.col("event_type") == "none"), "date", dt.date(2024, 1, 10))
    return op.incremental_slice(rows, "date", mark, 15, inclusive=True).select("event_id", "event_type")


@query(
    "quality_check",
    """
select 'unique' as "check", 'user_ip' as column_name, count(*) as failures from (select user_ip from o_activity where user_ip is not null group by 1 having count(*) > 1) a
union all select 'not_null', 'user_ip', count(*) from o_activity where user_ip is null
union all select 'not_null', 'page_url', count(*) from o_activity where page_url is null""",
)
def _(i):
    return op.quality_check(i.activity, unique=["user_ip"], not_null=["user_ip", "page_url"])


@query(
    "save_table",
    "select o_custkey, count(*) as n from orders group by 1 union all select o_custkey, count(*) from orders group by 1",
)
def _(i):
    root = f"{i.folder}/order_counts"
    counts = i.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    save_table(counts.limit(0), root)
    stored = save_table(counts, root)
    # the table is replaced by a result of reading it
    save_table(stored.filter(F.col("n") > 0), root)
    return save_table(counts, root, "append")


@query("empty_table", "select o_custkey, count(*) as n from orders where o_custkey is null group by 1")
def _(i):
    root = f"{i.folder}/order_counts"
    save_table(i.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")), root)
    save_table(load_table(i.spark, root), root, "empty")
    return load_table(i.spark, root)


@query(
    "ordered_limit",
    "select o_orderkey from (select o_orderkey, o_orderdate from orders order by o_orderdate desc, md5(o_orderkey::varchar), o_orderkey::varchar limit 500) x",
)
def _(i):
    rows = i.orders.withColumn("key", F.col("o_orderkey").cast("string"))
    return op.ordered_limit(rows, 500, "o_orderdate", "key").select("o_orderkey")


TIES = ["event_id"]


@query(
    "running_mean_stddev",
    """
select user_id, event_id, round(avg(value) over w, 6) as mean, round(coalesce(stddev_samp(value) over w, 0), 6) as deviation
from (select user_id, event_id, ts::date as day, value from events) e
window w as (partition by user_id order by day, substr(md5(event_id::varchar), 1, 2), event_id rows between unbounded preceding and current row)""",
)
def _(i):
    rows = i.events.select("user_id", "event_id", F.to_date("ts").alias("day"), "value")
    out = op.running_mean_stddev(rows, ["user_id"], "day", "value", TIES, "mean", "deviation")
    return out.select("user_id", "event_id", "mean", "deviation")


# -- column functions
@query("domain_normalizer", f"select page_id, {s.domain('url')} as domain from pages")
def _(i):
    return i.pages.select("page_id", fn.domain_normalizer(F.col("url")).alias("domain"))


@query("url_host", f"select page_id, {s.host('url')} as host from pages")
def _(i):
    return i.pages.select("page_id", fn.url_host(F.col("url")).alias("host"))


piece(
    "o_ip_texts",
    "select ip_address as ip from in_bid_log union all select json_extract_string(pixel_record, '$.ip') from in_pixel_raw union all select ip_range_end from in_ip_range",
)


@query("ip_to_number", f"select ip, {s.ip_number('ip')} as n from o_ip_texts")
def _(i):
    texts = i.bid_log.select(F.col("ip_address").alias("ip")).unionAll(
        i.pixel_records.select(F.col("pixel_record.ip"))
    )
    texts = texts.unionAll(i.ip_range.select("ip_range_end"))
    return texts.select("ip", fn.ip_to_number(F.col("ip")).alias("n"))


piece("o_day_texts", "select json_extract_string(pixel_record, '$.date') as t from in_pixel_raw union all select o_orderpriority from orders")


@query("date_normalizer", f"select t, strftime({s.day('t')}, '%d-%m-%Y') as day from o_day_texts")
def _(i):
    texts = i.pixel_records.select(F.col("pixel_record.date").alias("t")).unionAll(
        i.orders.select("o_orderpriority")
    )
    return texts.select("t", fn.date_normalizer(F.col("t")).alias("day"))


@query("normalize_city", f"select p_partkey, {s.city('name')} as city from (select p_partkey, ' ' || p_name || '  ' || p_type as name from part) x")
def _(i):
    name = F.concat(F.lit(" "), F.col("p_name"), F.lit("  "), F.col("p_type"))
    return i.part.select("p_partkey", fn.normalize_city(name).alias("city"))


@query("clean_string", f"select page_id, {s.clean('html', 1100)} as cleaned from pages")
def _(i):
    return i.pages.select("page_id", fn.clean_string(F.col("html"), 1100).alias("cleaned"))


@query("first_n_words", f"select doc_id, {s.first_words('text', 25)} as head from documents")
def _(i):
    return i.documents.select("doc_id", fn.first_n_words(F.col("text"), 25).alias("head"))


@query("first_n_words_filtered", f"select doc_id, {s.filtered('text', 1000)} as head from documents")
def _(i):
    return i.documents.select("doc_id", fn.first_n_words_filtered(F.col("text"), 1000).alias("head"))


piece("o_turn_words", f"select conv_id, turn, {s.words('text')} as ws from conversations")


@query(
    "unique_ngrams",
    f"select conv_id, turn, array_to_string(list_sort({s.ngrams('ws')}), '|') as ngrams from o_turn_words",
)
def _(i):
    return i.conversations.select("conv_id", "turn", fn.unique_ngrams(F.col("text")).alias("ngrams"))


piece(
    "o_word_pairs",
    f"select d.doc_id, {s.words('d.text')} as a, {s.words('b.text')} as b from documents d join benchmark b on b.item_id = d.doc_id % (select count(*) from benchmark)",
)


def _word_pairs(i):
    n = i.benchmark.agg(F.count(F.lit(1))).scalar()
    docs = i.documents.select("doc_id", F.col("text").alias("ta"), (F.col("doc_id") % n).alias("item_id"))
    rows = docs.join(i.benchmark.select("item_id", F.col("text").alias("tb")), "item_id")
    words = lambda c: F.split(F.trim(F.regexp_replace(c, r"[\x00-\x20\x7f]+", " ")), " ")
    return rows.select("doc_id", words("ta").alias("a"), words("tb").alias("b"))


@query(
    "arrays_intersect",
    "select doc_id, array_to_string(list_sort(list_distinct(list_intersect(a, b))), '|') as common from o_word_pairs",
)
def _(i):
    return _word_pairs(i).select("doc_id", fn.arrays_intersect(F.col("a"), F.col("b")).alias("common"))


@query(
    "arrays_intersect_case_insensitive",
    "select doc_id, array_to_string(list_sort(list_distinct(list_intersect([lower(x) for x in a], [lower(x) for x in b]))), '|') as common from o_word_pairs",
)
def _(i):
    both = fn.arrays_intersect_case_insensitive(F.col("a"), F.col("b"))
    return _word_pairs(i).select("doc_id", both.alias("common"))


@query("is_integer", "select ip, regexp_matches(ip, '^[+-]?[0-9]+$') as whole from (select geo_zip as ip from in_bid_log union all select ip_address from in_bid_log) x")
def _(i):
    texts = i.bid_log.select(F.col("geo_zip").alias("ip")).unionAll(i.bid_log.select("ip_address"))
    return texts.select("ip", fn.is_integer(F.col("ip")).alias("whole"))


@query(
    "strict_greatest_least",
    "select event_id, case when a is null or b is null then null else greatest(a, b) end as hi, case when a is null or b is null then null else least(a, b) end as lo "
    "from (select event_id, case when event_type = 'error' then null else value end as a, user_id::double as b from events) x",
)
def _(i):
    a = F.when(F.col("event_type") != "error", F.col("value"))
    b = F.col("user_id").cast("double")
    return i.events.select("event_id", fn.strict_greatest(a, b).alias("hi"), fn.strict_least(a, b).alias("lo"))
