"""Operators against brute force on small, skewed and tied data."""

import datetime as dt
import hashlib
import random
import statistics

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from tidemark import functions as fn
from tidemark.operators import (
    anti, flatten_topics, high_water_mark, incremental_slice, ip_range_join, ordered_limit,
    quality_check, running_mean_stddev, semi, share_of_total, slice_start,
)

DAY = dt.date(2024, 1, 1)


@pytest.mark.parametrize("seed", [1, 2])
def test_ip_range_join_equals_brute_force(spark, seed):
    rnd = random.Random(seed)
    ranges = [(0, 2**32 - 1), (5, 5), (7, 6), (2**24, 2**25 - 1), (255, 256)]
    for _ in range(150):
        lo = rnd.randrange(2**32)
        ranges.append((lo, min(2**32 - 1, lo + rnd.choice([0, 1, 15, 16, 17, 255, 65535, 10**6, 10**9]))))
    ranges += ranges[10:40]  # copies are all kept
    ips = [0, 5, 6, 255, 256, 2**32 - 1] + [rnd.randrange(2**32) for _ in range(150)]
    ips += [lo for lo, _ in ranges] + [hi for _, hi in ranges]
    a = spark.createDataFrame([(x,) for x in ips] + [(None,)], "ip bigint")
    b = spark.createDataFrame([(lo, hi, n) for n, (lo, hi) in enumerate(ranges)], "lo bigint, hi bigint, n int")
    got = ip_range_join(a, "ip", b, "lo", "hi")
    assert "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)
    want = sorted((str(x), str(n)) for x in ips for n, (lo, hi) in enumerate(ranges) if lo <= x <= hi)
    assert sorted((str(r["ip"]), str(r["n"])) for r in got.collect()) == want


def test_ip_range_join_has_few_candidates(spark):
    """Adjacent narrow ranges inside one /16: an address meets a bounded number of them."""
    b = spark.range(0, 65536, 4).select(F.col("id").alias("lo"), (F.col("id") + 3).alias("hi"))
    a = spark.range(0, 65536, 7).select(F.col("id").alias("ip"))
    filed = ip_range_join(a, "ip", b, "lo", "hi")
    assert filed.count() == a.count()


def _running_brute(data):
    def place(r):
        key, day, v, a, b = r
        digest = hashlib.md5(f"{a}|{b}".encode()).hexdigest()[:2]
        return (day, digest, a, b, v)

    out = []
    for key in {r[0] for r in data}:
        seen = []
        for r in sorted((r for r in data if r[0] == key), key=place):
            seen.append(r[2])
            out.append((*r, round(sum(seen) / len(seen), 6), round(statistics.stdev(seen), 6) if len(seen) > 1 else 0.0))
    return sorted(out, key=str)


def test_running_mean_stddev_with_hot_series_and_copies(spark):
    rnd = random.Random(3)
    data = [("hot", DAY + dt.timedelta(rnd.randrange(3)), float(rnd.randrange(50)), rnd.randrange(4), 1) for _ in range(400)]
    data += [("hot", DAY, 3.0, 1, 1)] * 200 + [("flat", DAY, 0.1, 2, 2)] * 7
    data += [(f"s{i}", DAY, 5.0, 1, 1) for i in range(5)]
    df = spark.createDataFrame(data, "k string, d date, v double, a int, b int")
    out = running_mean_stddev(df, ["k"], "d", "v", ["a", "b"], "m", "s")
    got = sorted(((*r[:5], round(r["m"], 6), round(r["s"], 6)) for r in out.collect()), key=str)
    assert got == _running_brute(data)


def test_running_series_may_have_null_keys(spark):
    df = spark.createDataFrame([(None, DAY, 1.0, 1), (None, DAY, 3.0, 2)], "k string, d date, v double, a int")
    out = running_mean_stddev(df, ["k"], "d", "v", ["a"], "m", "s")
    assert sorted(r["m"] for r in out.collect())[-1] in (2.0, 3.0) and out.count() == 2


@pytest.mark.parametrize("n", [0, 1, 7, 50, 99, 100, 1000])
@pytest.mark.parametrize("descending", [True, False])
def test_ordered_limit_equals_sort(spark, n, descending):
    rnd = random.Random(n)
    data = [(f"key{i}", None if i % 17 == 0 else DAY + dt.timedelta(0 if i % 3 else rnd.randrange(9))) for i in range(100)]
    df = spark.createDataFrame(data, "k string, d date")
    got = ordered_limit(df, n, "d", "k", descending=descending)
    sign = -1 if descending else 1
    order = lambda r: (r[1] is None, sign * (r[1].toordinal() if r[1] else 0), hashlib.md5(r[0].encode()).hexdigest())
    assert sorted(r["k"] for r in got.collect()) == sorted(r[0] for r in sorted(data, key=order)[:n])


def test_not_in_rules(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "x string")
    with_null = spark.createDataFrame([("a",), (None,)], "y string")
    plain = spark.createDataFrame([("a",)], "y string")
    empty = spark.createDataFrame([], "y string")
    assert rows(anti(df, with_null, "x", "y")) == []
    assert rows(anti(df, plain, "x", "y")) == [("b",)]
    assert rows(anti(df, empty, "x", "y")) == [(None,), ("a",), ("b",)]
    assert rows(anti(df, with_null, "x", "y", null_aware=False)) == [(None,), ("b",)]
    assert rows(semi(df, with_null, "x", "y")) == [("a",)]


def test_share_of_total(spark):
    df = spark.createDataFrame([("g", "a", 1.0), ("g", "b", 3.0), ("z", "c", 0.0), (None, "d", 1.0)], "g string, n string, v double")
    plain = {r["n"]: r["s"] for r in share_of_total(df, "g", "v", "s").collect()}
    assert plain == {"a": 0.25, "b": 0.75, "c": 0.0}
    bare = {r["n"]: r["s"] for r in share_of_total(df, "g", "v", "s", floor=0.3, guard_zero=False).collect()}
    assert bare == {"a": 0.3, "b": 0.75, "c": None}


def test_shares_sum_to_one(spark):
    df = spark.range(1000).select((F.col("id") % 7).cast("string").alias("g"), F.rand(1).alias("v"))
    total = share_of_total(df, "g", "v", "s").groupBy("g").agg(F.sum("s").alias("t"))
    assert all(abs(r["t"] - 1) < 1e-6 for r in total.collect())


def test_flatten_topics_removes_repeats(spark):
    t = ("p", "c", "t", "0.5")
    ddl = "page_url string, a array<struct<parentCategory:string,category:string,topic:string,probability:string>>"
    df = spark.createDataFrame([("u", [t, t]), ("v", []), ("u", [t])], ddl)
    assert len(flatten_topics(df, "a").collect()) == 1
    assert len(flatten_topics(df.filter("page_url = 'u'").limit(1), "a", one_row_per_key=True).collect()) == 1


def test_slice_and_mark(spark):
    days = spark.createDataFrame([(DAY + dt.timedelta(i),) for i in range(10)], "d date")
    assert high_water_mark(days.limit(0), "d", DAY) == DAY
    mark = high_water_mark(days.filter(F.col("d") <= F.lit(DAY + dt.timedelta(3))), "d", DAY)
    assert incremental_slice(days, "d", mark, 2).count() == 2
    assert incremental_slice(days, "d", mark, 2, inclusive=True).count() == 3


def test_slice_start_passes_a_gap(spark):
    days = spark.createDataFrame([(DAY + dt.timedelta(i),) for i in (0, 300, 301)], "d date")
    assert slice_start(days, "d", DAY, 180) == DAY + dt.timedelta(299)
    assert slice_start(days, "d", DAY, 180, inclusive=True) == DAY
    assert slice_start(days, "d", DAY, 300) == DAY
    assert slice_start(days, "d", DAY + dt.timedelta(301), 180) == DAY + dt.timedelta(301)
    assert slice_start(days.limit(0), "d", DAY, 180) == DAY
    assert incremental_slice(days, "d", slice_start(days, "d", DAY, 180), 180).count() == 2


def test_quality_check(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "x string")
    assert rows(quality_check(df, ["x"], ["x"])) == [("not_null", "x", 2), ("unique", "x", 1)]
    two = df.withColumn("y", F.lit(1))
    assert rows(quality_check(two, not_null=["x", "y"])) == [("not_null", "x", 2), ("not_null", "y", 0)]
    assert plan(quality_check(two, not_null=["x", "y"])).count("Scan") <= 1


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "text, want",
    [("HTTP://www.Foo.com:80/a?b", "foo.com"), ("  ", None), (None, None), ("www.x.org", "x.org"), ("a.b.c/d", "a.b.c")],
)
def test_domain_normalizer(spark, text, want):
    assert one(spark, fn.domain_normalizer(F.lit(text).cast("string"))) == want


def test_bare_names_are_as_the_pattern_has_them(spark):
    from tidemark.functions.web import HOST_NAME

    names = ["", "www.", "WWW.www.a.b", "wwwx.org", "Ab.c", "a.b\n", "a\nb", "a.b\r\n", "a\u2028", "a\u0085", "a:", "a:80", "a:80b",
             "\u00fc.de", "a b", " x.y ", "a?b", "a#", "/a", "http://", "ab+c", "a\tb", None]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    whole = F.nullif(F.regexp_extract(F.lower(F.trim("name")), HOST_NAME, 1), F.lit(""))
    got = df.select("name", fn.domain_normalizer(F.col("name")).alias("got"), whole.alias("want")).collect()
    assert [(r["name"], r["got"]) for r in got] == [(r["name"], r["want"]) for r in got]


@pytest.mark.parametrize(
    "text, want",
    [("0.0.0.1", 1), ("1.2.3.4", 16909060), ("255.255.255.255", 2**32 - 1), ("256.1.1.1", None), ("1.2.3", None),
     ("fe80::1", None), ("a.b.c.d", None), ("01.2.3.4", None), (None, None)],
)
def test_ip_to_number(spark, text, want):
    assert one(spark, fn.ip_to_number(F.lit(text).cast("string"))) == want


def test_days(spark):
    for text in ("05-03-2023", "2023-03-05", "05/03/2023", "20230305"):
        assert one(spark, fn.to_day(F.lit(text))) == dt.date(2023, 3, 5)
    assert one(spark, fn.to_day(F.lit("soon"))) is None
    assert one(spark, fn.date_normalizer(F.lit("2023-03-05"))) == "05-03-2023"


def test_null_wins(spark):
    null = F.lit(None).cast("double")
    assert one(spark, fn.strict_greatest(F.lit(1.0), null)) is None
    assert one(spark, fn.strict_least(F.lit(1.0), F.lit(2.0))) == 1.0
    assert one(spark, fn.ratio(F.lit(1), F.lit(0))) is None


def test_text_functions(spark):
    assert one(spark, fn.clean_string(F.lit("<b>Hi</b>\n\tyou  there"), 2)) == "Hi you"
    assert one(spark, fn.clean_string(F.lit(""), 5)) == ""
    assert one(spark, fn.first_n_words(F.lit(" a  b c"), 2)) == "a b"
    assert one(spark, fn.first_n_words(F.lit(" a  b c"), None)) == "a b c"
    assert one(spark, fn.clean_string(F.lit("<i>a</i>  b"), None)) == "a b"
    assert one(spark, fn.first_n_words_filtered(F.lit("big-cat! 7 xx"), None)) == "big cat xx"
    assert one(spark, fn.first_n_words_filtered(F.lit("a, big-cat! 7 xx"), 2)) == "big cat"
    assert sorted(one(spark, fn.unique_ngrams(F.lit("a b a b")))) == ["a", "a b", "a b a", "b", "b a", "b a b"]
    assert one(spark, fn.unique_ngrams(F.lit(""))) == []
    assert one(spark, fn.unique_ngrams(F.lit("one"))) == ["one"]
    a, b = F.array(F.lit("A"), F.lit("b")), F.array(F.lit("a"), F.lit("b"))
    assert one(spark, fn.arrays_intersect(a, b)) == ["b"]
    assert one(spark, fn.arrays_intersect_case_insensitive(a, b)) == ["a", "b"]
    assert one(spark, fn.is_integer(F.lit("012"))) and not one(spark, fn.is_integer(F.lit("1a")))


def test_running_deviation_far_from_zero(spark):
    for centre in (0.0, 1e6, 1e9):
        data = [("s", k, centre + 10 * (k % 3)) for k in range(9)]
        df = spark.createDataFrame(data, "series string, day int, value double")
        from tidemark.operators.running import running_mean_stddev

        out = running_mean_stddev(df, ["series"], "day", "value", ["day"], "m", "sd").orderBy("day").collect()
        for k, row in enumerate(out):
            seen = [v for _, _, v in data[: k + 1]]
            mean = sum(seen) / len(seen)
            want = (sum((v - mean) ** 2 for v in seen) / k) ** 0.5 if k else 0.0
            assert abs(row.sd - want) < 1e-6 and abs(row.m - mean) < 1e-6 * max(1, abs(mean))


def test_ordered_limit_keeps_null_keys(spark):
    from tidemark.operators import ordered_limit

    df = spark.createDataFrame([(1, None), (1, "a"), (2, None)], "day int, key string")
    assert ordered_limit(df, 3, "day", "key").count() == 3
    assert ordered_limit(df, 2, "day", "key").count() == 2


def test_pages_without_a_domain_are_merged_once_and_queued(spark):
    from tidemark.plans import bidstream

    log = spark.createDataFrame(
        [("u/1", None, "d", "1.1.1.1"), ("u/1", "", "d", "1.1.1.1"), ("u/2", "a.com", "d", "1.1.1.1"), ("u/2", "", "d", "1.1.1.1")],
        "page_url string, domain string, user_id string, ip_address string",
    ).selectExpr("*", "timestamp'2024-01-01 10:00:00' as bid_time", "'DE' as geo_country", "'DE/BE' as geo_region", "'1' as geo_zip")
    cache = bidstream.user_activity_rollup(log, dt.datetime(2024, 1, 2))
    assert rows(cache.select("page_url", "publisher_domain_normalized", "pageviews")) == [("u/1", "", 2), ("u/2", "a.com", 2)]
    once = bidstream.user_activity_merge(cache.limit(0), cache)
    assert bidstream.user_activity_merge(once, cache).count() == 2
    urls = bidstream.url_stats(cache)
    queue = spark.createDataFrame([], "page_url string, date_inserted date, date_pushed date")
    results = spark.createDataFrame([], "page_url string, last_scraped date")
    bad = spark.createDataFrame([("b.com",)], "publisher_domain_normalized string")
    queued = bidstream.scrape_queue(queue, urls, results, bad, DAY)
    assert [r[0] for r in rows(queued.select("page_url"))] == ["u/1", "u/2"]
