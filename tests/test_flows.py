"""The scheduled runs end to end on stored tables, twice where state matters."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import DATA
from tidemark.plans import flows, scoring
from tidemark.sources import Warehouse, model_batch_export
from tidemark.sources.warehouse import SCHEMAS
from workload.steps import Steps

AS_OF = dt.date(2024, 1, 31)
START = dt.date(2023, 12, 31)
FIRST_CUT, LAST_CUT = dt.datetime(2024, 1, 15), dt.datetime(2024, 1, 31)


@pytest.fixture(scope="module")
def w(spark, tmp_path_factory):
    i = Steps(spark, DATA)
    wh = Warehouse(spark, str(tmp_path_factory.mktemp("warehouse")), slots=4, buckets=4)
    wh.replace("bid/log", i.bid_log)
    wh.replace("maps/geos", i.geos)
    wh.replace("maps/isp_domains", i.isp_domains)
    wh.replace("maps/bad_publishers", i.bad_pubs)
    wh.replace("maps/country_iso", i.country_iso)
    wh.replace("maps/regions", i.region_codes)
    wh.replace("maps/ip_domain_obs", i.ip_domain_obs)
    wh.replace("vendor/ip_companies", i.vendor_ip)
    wh.replace("lead/cache", i.lead_flat)
    wh.replace("lead/topic_map", i.lead_topic_map)
    wh.replace("pixel/raw", i.pixel_records)
    wh.replace("email/clicks", i.clicks)
    wh.replace("email/opens", i.opens)
    wh.replace("page/scrape_output", i.scrape_output)
    wh.replace("page/title_output_cache", i.title_output.select(
        "page_url", "page_title", F.struct("url_type", "activity_type", "information_type", "topics").alias("payload")))
    wh.replace("page/topic_output_cache", i.topics.withColumnRenamed("intent_topics", "payload"))
    wh.replace("page/topic_brands", i.topic_brands)
    wh.replace("page/reference_topics", i.reference_topics)
    wh.replace("page/brand_list", i.brand_ref)
    return wh


def test_all_runs(spark, w, tmp_path):
    flows.ip_ranges(w, Steps(spark, DATA).ip_range, AS_OF)
    flows.vendor_companies(w, AS_OF)
    flows.leads(w)
    assert w.read("lead/cache").isEmpty() and not w.read("lead/prescoring").isEmpty()

    flows.page_content(w, AS_OF, str(tmp_path / "batches"))
    pages = w.spark.read.parquet(f"{DATA}/pages.parquet").count()
    assert w.read("page/results").count() == pages
    assert w.read("page/results_cache").isEmpty() and w.read("page/scrape_output").isEmpty()
    assert not w.read("page/brands").isEmpty()

    # two daily runs: the second only sees the rest of the log
    views = w.read("bid/log").filter(F.length("page_url") > 0).filter("ip_address is not null or user_id is not null").count()
    flows.bid_stream(w, FIRST_CUT, AS_OF, first_day=START)
    first_days = w.read("bid/company_activity").agg(F.max("date")).first()[0]
    assert first_days <= FIRST_CUT.date()
    assert w.read("bid/log").filter(F.col("bid_time") <= F.lit(FIRST_CUT)).isEmpty()
    flows.bid_stream(w, LAST_CUT, AS_OF, first_day=START)
    assert w.read("bid/log").isEmpty()
    stored = w.read("bid/user_activity").agg(F.sum("pageviews")).first()[0]
    assert stored == views
    company = w.read("bid/company_activity")
    assert company.agg(F.max("date")).first()[0] > first_days
    keys = ["page_url", "normalized_company_domain", "date", "normalized_country_code", "normalized_region_code",
            "normalized_city_name", "normalized_zip"]
    assert company.count() == company.select(*keys).distinct().count()
    assert not w.read("bid/prescoring_cache").isEmpty()
    open_rows = w.read("bid/company_activity_cache")
    assert open_rows.count() == open_rows.select(*keys).distinct().count()
    # every labelled page has left the cache
    labelled = w.read("page/topics").filter(F.size("intent_topics") > 0).select("page_url")
    labelled = labelled.join(w.read("page/titles"), "page_url").join(w.read("page/context"), "page_url")
    assert w.read("bid/company_activity_cache").join(labelled, "page_url", "left_semi").isEmpty()

    flows.pixel_records(w, AS_OF, first_day=START)
    assert w.read("pixel/raw").isEmpty()

    wanted = flows.lookup_requests(w, AS_OF, limit=20)
    answers = Steps(spark, DATA).lookup_output
    w.replace("lookup/output_raw", answers)
    flows.lookup_answers(w, AS_OF)
    assert w.read("lookup/success").isEmpty() and wanted.columns == ["user_ip"]
    assert w.read("lookup/mappings").count() == answers.filter("last_response_code = 200").select("user_ip").distinct().count()

    flows.email_campaigns(w, AS_OF)
    assert not w.read("email/prescoring").isEmpty()

    flows.weekly_scores(w, AS_OF)
    history = w.read("score/history")
    bounds = history.agg(F.min("intent_score"), F.max("intent_score"), F.count("*")).first()
    assert bounds[2] > 0 and 0 <= bounds[0] and bounds[1] <= 100
    assert w.read("score/output").isEmpty() and w.read("bid/prescoring_cache").isEmpty()
    # with the caches empty a second run changes nothing but rows with a NULL key
    known = history.dropna().count()
    flows.weekly_scores(w, AS_OF)
    assert w.read("score/history").dropna().count() == known


def test_lookup_gate_stops_on_repeats(spark, tmp_path, monkeypatch):
    wh = Warehouse(spark, str(tmp_path))
    twice = spark.createDataFrame([("1.1.1.1",), ("1.1.1.1",)], "user_ip string")
    monkeypatch.setattr(flows.lookup, "lookup_candidates", lambda *a, **k: twice)
    with pytest.raises(ValueError):
        flows.lookup_requests(wh, AS_OF)


def test_schemas_parse(spark):
    for ddl in SCHEMAS.values():
        spark.createDataFrame([], ddl)


SERIES = ["co", "p", "c", "t", "USA", "R1", "city", "1"]


def _input(spark, entries):
    ddl = (
        "normalized_company_domain string, parent_category string, category string, topic string, normalized_country_code string, "
        "normalized_region_code string, normalized_city_name string, normalized_zip string, date date, pageviews bigint, "
        "weighted_pageviews double, avg_page_relevance double, activity_type_score double, information_type_score double, "
        "review_pageviews bigint, unique_pages bigint, unique_pubs bigint"
    )
    data = [(*(series or SERIES), AS_OF - dt.timedelta(age), 1, w, 1.0, 100.0, 100.0, rev, 1, 1) for series, age, w, rev in entries]
    return scoring.rolling_stats(spark.createDataFrame(data, ddl))


def _score(spark, entries):
    return scoring.score_backfill(_input(spark, entries), [AS_OF]).first()


def test_trend_windows(spark):
    """Day 0 is outside; week 0 is days 1-6, week 1 days 7-13."""
    r = _score(spark, [(None, 6, 30.0, 0), (None, 7, 10.0, 0), (None, 0, 999.0, 0)])
    assert r["week_over_week_trend"] == 2.0 and r["month_over_month_trend"] == 1.0
    assert _score(spark, [(None, 91, 1.0, 0)])["recency"] == 0.0
    assert _score(spark, [(None, 92, 1.0, 0)]) is None


def test_null_location_has_no_trend(spark):
    s = [*SERIES[:6], None, "1"]
    r = _score(spark, [(s, 2, 30.0, 0), (s, 8, 10.0, 0)])
    assert r["week_over_week_trend"] == 0.0 and r["month_over_month_trend"] == 0.0


@pytest.mark.parametrize("reviews, score", [(0, 0), (3, 30), (9, 90), (10, 100), (55, 100)])
def test_review_points(spark, reviews, score):
    r = _score(spark, [(None, 2, 30.0, reviews)])
    assert abs(r["context"] - (0.3 * score + 50 + 20)) < 1e-9


def test_backfill_equals_single_days(spark):
    rows = _input(spark, [(None, a, float(a % 5 + 1), a % 3) for a in range(1, 60)])
    days = [AS_OF, AS_OF - dt.timedelta(10), AS_OF - dt.timedelta(30)]
    many = {r["score_date"]: r for r in scoring.score_backfill(rows, days).collect()}
    for d in days:
        single = scoring.score_backfill(rows, [d]).first()
        assert all(abs(single[c] - many[d][c]) < 1e-9 for c in scoring.SCORES)


def test_days_equal_single_days(spark):
    rows = _input(spark, [(None, a, float(a % 5 + 1), a % 3) for a in range(1, 60)])
    days = [AS_OF, AS_OF - dt.timedelta(10), AS_OF - dt.timedelta(30), dt.date(2020, 1, 1)]
    frame = spark.createDataFrame([(d,) for d in [*days, AS_OF]], "score_date date")
    many = sorted(map(tuple, scoring.score_days(rows, frame).collect()))
    assert many == sorted(map(tuple, scoring.score_backfill(rows, days).collect())) and len(many) == 3
    assert scoring.score_days(rows, frame.limit(0)).count() == 0


def test_backfill_days(spark):
    cache = spark.createDataFrame([(dt.date(2024, 1, 5),), (None,), (dt.date(2024, 1, 9),)], "date date")

    def days(df, first):
        return [r[0].day for r in scoring.backfill_days(df, first, dt.date(2024, 1, 8)).orderBy("score_date").collect()]

    assert days(cache, dt.date(2023, 1, 1)) == [6, 7, 8]
    assert days(cache, dt.date(2024, 1, 7)) == [8] and days(cache, dt.date(2024, 2, 7)) == []
    assert days(cache.limit(0), dt.date(2024, 1, 6)) == [7, 8]


def test_flow_of_several_days(spark, tmp_path):
    """All days in one run give the history that single runs give."""
    i = Steps(spark, DATA)
    histories = []
    first = AS_OF - dt.timedelta(4)
    for mode in ("one", "many"):
        wh = Warehouse(spark, str(tmp_path / mode), slots=2, buckets=2)
        wh.replace("bid/prescoring_cache", i.prescoring_bid)
        wh.replace("email/prescoring", i.prescoring_email)
        if mode == "many":
            flows.backfill_scores(wh, AS_OF, first)
        else:
            for k in range(3, -1, -1):
                day = AS_OF - dt.timedelta(k)
                flows.weekly_scores(wh, AS_OF, days=spark.createDataFrame([(day,)], "score_date date"))
        history = wh.read("score/history")
        histories.append(sorted(str([round(v, 9) if isinstance(v, float) else v for v in r]) for r in history.collect()))
        assert history.select("score_date").distinct().count() == 4
    assert histories[0] == histories[1] and histories[0]


def test_shared_hosts_are_no_companies(spark, tmp_path):
    i = Steps(spark, DATA)
    wh = Warehouse(spark, str(tmp_path), slots=2, buckets=2)
    cut = dt.datetime(2024, 1, 31)
    clean = flows.vendors.ip_range_clean(i.ip_range, AS_OF)
    host = clean.filter("length(normalized_company_domain) > 1").groupBy("normalized_company_domain").count().orderBy(F.desc("count")).first()[0]
    vendor = spark.createDataFrame([("7.7.7.7", host, f"x.org,{host}", 1.0)], "ip_address string, company_domain string, company_domain_array string, distribution_percentage double")
    wh.replace("maps/shared_domains", spark.createDataFrame([(host,)], "domain string"))
    wh.replace("vendor/ip_companies", vendor)
    wh.replace("bid/log", i.bid_log)
    wh.replace("maps/geos", i.geos)
    flows.ip_ranges(wh, i.ip_range, AS_OF)
    assert wh.read("vendor/ip_ranges").filter("normalized_company_domain = 'Shared'").count() == clean.filter(F.col("normalized_company_domain") == host).count()
    flows.vendor_companies(wh, AS_OF)
    flows.bid_stream(wh, cut, AS_OF, first_day=START)
    named = F.col("normalized_company_domain").isin(host, "Shared")
    for table in ("maps/ip_domain", "maps/device_domain", "bid/company_activity"):
        assert wh.read(table).filter(named).isEmpty() and not wh.read(table).isEmpty(), table


def test_incremental_model_equals_rebuild(spark, tmp_path):
    """Answers in three parts, one of them twice, give the tables of one full run; a repetition writes nothing."""
    answers = Steps(spark, DATA).lookup_output.dropna(subset=["user_ip"]).withColumn("part", F.pmod(F.xxhash64("user_ip", "last_query_date"), F.lit(3)))
    whole, parts = (Warehouse(spark, str(tmp_path / n), slots=4, buckets=2) for n in ("whole", "parts"))
    whole.replace("lookup/output", Steps(spark, DATA).empty(SCHEMAS["lookup/output"]))
    for wh, batches in ((whole, [F.lit(True)]), (parts, [F.col("part") == k for k in (0, 1, 2, 2)])):
        for batch in batches:
            wh.replace("lookup/output_raw", answers.filter(batch).drop("part"))
            before = _files(wh.path("lookup/mappings"))
            flows.lookup_answers(wh, AS_OF, incremental=True)
    assert before == _files(parts.path("lookup/mappings"))
    # the latest run's answer counts, so rows are compared by address
    for name in ("lookup/output", "lookup/mappings"):
        found = [wh.read(name) for wh in (whole, parts)]
        assert [r.count() for r in found] == [r.select("user_ip").distinct().count() for r in found]
        assert sorted(r[0] for r in found[0].select("user_ip").collect()) == sorted(r[0] for r in found[1].select("user_ip").collect())


def _files(root):
    return {(at, n) for at, _, names in os.walk(root) for n in names if n.endswith(".parquet")}


def test_export_limited_in_bytes(spark, tmp_path):
    rows = [(f"u{k}", "x" * (k % 90), AS_OF) for k in range(500)] + [("big", "y" * 900, AS_OF), ("none", None, AS_OF)]
    cache = spark.createDataFrame(rows, "page_url string, page_title string, date_inserted date").repartition(3)
    path = tmp_path / "out"
    assert model_batch_export(cache, ["page_url", "page_title"], str(path), 1000, 1000, 600)
    sizes = sorted(f.stat().st_size for f in path.rglob("part-*.json"))
    # only the one larger row is a file above the limit, and files are not much smaller than need be
    assert sizes[-2] <= 600 < sizes[-1] and len(sizes) < 2.5 * sum(sizes) / 600 + 6
    back = spark.read.schema("page_url string, page_title string").json(str(path))
    assert sorted(r[0] for r in back.collect()) == sorted(r[0] for r in rows)
    assert not model_batch_export(cache.limit(0), ["page_url"], str(path), 10, 10, 600)


def test_sources_only_meet_the_bid_rows(spark):
    """A lead and an e-mail row of one key stay apart unless a bid row brings them together."""
    day = dt.date(2024, 1, 20)
    i = Steps(spark, DATA)
    bid, pixel_rows = i.prescoring_bid.limit(0), i.prescoring_pixel.limit(0)
    email_rows = spark.createDataFrame([("co", day, "p", "c", "t", 1.0, 1.0)], i.prescoring_email.schema)
    lead_rows = spark.createDataFrame([(day, "p", "c", "t", "co", 0)], i.prescoring_lead.schema)
    out = scoring.combine_sources(bid, pixel_rows, email_rows, lead_rows, dt.date(2024, 1, 1), AS_OF)
    assert sorted(r["weighted_pageviews"] for r in out.collect()) == [500.0, 15000.0]


def test_key_modes(spark):
    from tidemark.plans.enrichment import prescoring_merge

    i = Steps(spark, DATA)
    batch = i.prescoring_bid
    assert prescoring_merge(batch, batch, "aligned").count() == batch.count()
    same = batch.filter("parent_category = category and category = topic").count()
    assert prescoring_merge(batch, batch).count() == 2 * batch.count() - same
    with pytest.raises(ValueError):
        prescoring_merge(batch, batch, "other")
