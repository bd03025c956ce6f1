"""Shapes of the large plans: no nested loops, filters at the scan, few columns read."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import plan
from tidemark.plans import bidstream, content, lookup, scoring
from tidemark.sources import Warehouse

AS_OF = dt.date(2024, 1, 31)
TABLES = """bid/log bid/user_activity bid/ip_resolvable_domains bid/prescoring pixel/prescoring email/prescoring lead/prescoring
maps/ip_domain maps/device_domain maps/ip_trio maps/ip_location maps/geos maps/isp_domains vendor/ip_ranges
page/brands page/ngrams page/topics page/topic_brands page/reference_topics score/input""".split()


@pytest.fixture(scope="module")
def w(spark, tmp_path_factory):
    wh = Warehouse(spark, str(tmp_path_factory.mktemp("plans")))
    for name in TABLES:
        wh.replace(name, wh.read(name))
    # as for tables beyond the broadcast threshold
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield wh
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def check(df):
    text = plan(df)
    for bad in ("NestedLoop", "Cartesian", "BroadcastExchange"):
        assert bad not in text, bad
    return text


def test_company_activity(w):
    r = w.read
    text = check(
        bidstream.company_activity(
            r("bid/user_activity"), r("maps/ip_domain"), r("maps/device_domain"), r("maps/ip_trio"),
            r("bid/ip_resolvable_domains"), r("maps/ip_location"), r("maps/geos"), r("maps/isp_domains"), AS_OF,
        )
    )
    assert "bw_city_normalized" not in text.split("ReadSchema", 1)[1]


def test_ranges(w):
    obs = bidstream.ip_location_latest(w.read("bid/user_activity"))
    check(bidstream.ip_location_best_source(w.read("maps/ip_location"), obs, w.read("vendor/ip_ranges")))


def test_rollup_filters_at_the_scan(w):
    text = check(bidstream.user_activity_rollup(w.read("bid/log"), dt.datetime(2024, 1, 1)))
    assert "LessThanOrEqual(bid_time" in text and text.count("Exchange hashpartitioning") == 1


def test_rollup_compares_hashes_before_texts(w):
    text = plan(bidstream.user_activity_rollup(w.read("bid/log"), dt.datetime(2024, 1, 1)))
    sorts = [line.split("Sort [", 1)[1] for line in text.splitlines() if " Sort [" in line]
    assert sorts and all(keys.startswith("__hash") for keys in sorts)


def test_scoring(w):
    r = w.read
    check(
        scoring.combine_sources(
            r("bid/prescoring"), r("pixel/prescoring"), r("email/prescoring"), r("lead/prescoring"),
            dt.date(2023, 10, 3), AS_OF,
        )
    )
    text = check(scoring.score_backfill(r("score/input"), [AS_OF]))
    assert text.count("Exchange hashpartitioning") == 1 and "GreaterThanOrEqual(date" in text


def test_brand_tags(w):
    r = w.read
    args = (r("page/brands"), r("page/ngrams"), r("page/topics"), r("page/topic_brands"), r("page/reference_topics"))
    check(content.tag_brands(*args, AS_OF))


def test_candidates_are_a_top_k(w):
    schema = "user_ip string, last_response_code int, last_query_date date, api_response string"
    spark = w.spark
    answers = spark.createDataFrame([("1.1.1.1", 200, AS_OF, "")], schema)
    vendor = spark.createDataFrame([("1.1.1.2",)], "ip_address string")
    text = check(lookup.lookup_candidates(w.read("bid/user_activity"), vendor, answers, AS_OF))
    assert "TakeOrderedAndProject" in text


def test_unused_columns_are_not_read(w):
    df = bidstream.ip_location_latest(w.read("bid/user_activity")).select("ip", F.col("date_updated"))
    assert "page_url" not in plan(df)


def raw_side(df) -> str:
    """The part of the plan below the lowest shuffle, where all rows still are."""
    return plan(df).rsplit("Exchange", 1)[1]


def test_texts_are_picked_from_grouped_rows(w):
    """The smallest or latest text makes Spark sort; raw rows are hashed before."""
    activity = w.read("bid/user_activity")
    for df in (bidstream.ip_location_latest(activity), bidstream.url_stats(activity)):
        text = check(df)
        assert "SortAggregate" not in raw_side(df) and "HashAggregate" in raw_side(df)
        assert text.count("Exchange hashpartitioning") == 2 and "Join" not in text


def test_history_is_not_shuffled_to_find_new_pages(w):
    """Scraped and classified pages are read in their buckets, by key column only."""
    results, topics = w.read("page/results"), w.read("page/topics")
    urls = w.read("bid/unique_urls").withColumn("page_url", F.concat("page_url", F.lit("")))
    fresh = check(bidstream.never_scraped(urls, results))
    right = fresh.split("SortMergeJoin", 1)[1]
    history = right[right.rindex("FileScan") :]
    assert "Bucketed: true" in history and "content" not in history.split("ReadSchema")[1]
    assert fresh.count("Exchange hashpartitioning") == 1
    scraped = w.read("page/scrape_output")
    assert check(content.topic_input(w.read("page/topic_input"), scraped, topics, AS_OF)).count("Bucketed: true") == 1


def test_brand_tags_shuffle_ngrams_once(spark):
    """N-grams are made after the merge's shuffle, and shuffled once on their way to the tagged pages."""
    results = spark.createDataFrame([("u", "200", "a", "b c")], "page_url string, result string, cleaned_title string, cleaned_content string")
    brands = spark.createDataFrame(
        [("p", "c", "t", "b", ["b"], [("p1", "c1", "t1", "0.5")])],
        "parent_category string, category string, original_topic string, brand string, brands array<string>,"
        " brand_topics array<struct<parentCategory:string,category:string,topic:string,probability:string>>",
    )
    topics = spark.createDataFrame(
        [("u", [("p", "c", "t", "1")])],
        "page_url string, intent_topics array<struct<parentCategory:string,category:string,topic:string,probability:string>>",
    )
    old = spark.createDataFrame(
        [("u", ["old"], [], AS_OF), (None, ["none"], [], AS_OF), (None, ["none"], [], AS_OF)],
        "page_url string, ngrams array<string>, brand_topics array<struct<parentCategory:string,category:string,topic:string,probability:string>>, date_classified date",
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        made = content.page_ngrams(old.select("page_url", "ngrams").filter("ngrams[0] <> 'old'"), results)
        text = plan(made)
        assert text.index("array_distinct") < text.index("Join")
        got = content.tag_brands(old, made, topics, brands, brands, AS_OF)
        for df in (got, content.tag_brands_any_topic(old, made, brands, brands, AS_OF, min_len=1)):
            # the only merges that scatter rows by key and spread are those of ``made``, which both sides read
            assert plan(df).count("hashpartitioning(__spread") == 2 * text.count("hashpartitioning(__spread")
            seen = sorted((r.page_url or "", sorted(r.ngrams), [t.topic for t in r.brand_topics]) for r in df.collect())
            assert seen == [("", ["none"], []), ("", ["none"], []), ("u", sorted(["a", "b", "c", "a b", "b c", "a b c"]), ["t1"])]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
