"""Stored tables: versions, partitions, merges that leave the rest alone; cells of the range join."""

import datetime as dt
import os
from collections import namedtuple
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from tidemark.operators.ranges import LEVELS, ip_range_join
from tidemark.plans import bidstream, enrichment, lookup, scoring
from tidemark.sources import Warehouse, drop_partitions, drop_versions, lead_load, load_table, save_table
from tidemark.sources.warehouse import BY_DAY, BY_KEY, BY_LOAD, SCHEMAS
from workload.base import shared_folder

LOCATION = "normalized_country_code string, normalized_region_code string, normalized_city_name string, normalized_zip string"


def frame(spark, *data):
    return spark.createDataFrame(list(data), "k string, d string, v int").selectExpr("k", "cast(d as date) date", "v")


def files(root):
    return {
        (path, os.stat(path).st_mtime_ns)
        for at, _, names in os.walk(root) for n in names if n.endswith(".parquet") for path in [os.path.join(at, n)]
    }


@pytest.fixture
def w(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "w"), slots=8, buckets=4)


def test_versions(spark, tmp_path):
    root = str(tmp_path / "t")
    one = save_table(frame(spark, ("a", "2024-01-01", 1)), root)
    two = save_table(one.withColumn("v", F.col("v") + 1), root)
    assert rows(one.select("v")) == [(1,)] and rows(two.select("v")) == [(2,)]
    # a folder that another writer has begun is passed over, and stays
    os.makedirs(f"{root}/v00000003")
    assert rows(load_table(spark, root).select("v")) == [(2,)]
    save_table(two, root)
    assert sorted(os.listdir(root)) == ["v00000001", "v00000002", "v00000003", "v00000004"]
    assert load_table(spark, root).columns == ["k", "date", "v"]
    assert drop_versions(spark, root) == 3 and rows(load_table(spark, root).select("v")) == [(2,)]


def test_partitions(spark, tmp_path):
    root = str(tmp_path / "t")
    first = [("a", "2024-01-01", 1), ("b", "2024-01-02", 2), ("c", None, 3)]
    save_table(frame(spark, *first), root, "partitions", ("date",))
    before = files(root)
    out = save_table(frame(spark, ("d", "2024-01-02", 4)), root, "partitions", ("date",))
    assert rows(out.select("k", "v")) == [("a", 1), ("c", 3), ("d", 4)]
    assert out.columns == ["k", "date", "v"]
    assert {f for f in before if "date=2024-01-02" not in f[0]} < files(root)
    out = save_table(frame(spark, ("e", "2024-01-01", 5)), root, "append", ("date",))
    day = out.filter(F.col("date") == "2024-01-01")
    assert rows(day.select("k")) == [("a",), ("e",)]
    assert "PartitionFilters: [isnotnull(date" in plan(day)
    assert drop_partitions(spark, root, "date", [dt.date(2024, 1, 1), None, dt.date(2020, 1, 1)]) == 2
    assert rows(load_table(spark, root).select("k")) == [("d",)]
    assert save_table(out, root, "empty").count() == 0 and load_table(spark, root).columns == ["k", "date", "v"]


def test_layouts_name_columns(spark):
    for name, column in (BY_DAY | BY_KEY).items():
        assert column in spark.createDataFrame([], SCHEMAS[name]).columns
    assert not set(BY_DAY) & set(BY_KEY) and not set(BY_LOAD) & set(BY_KEY) and set(BY_LOAD) <= set(SCHEMAS)


def ip_rows(spark, *data):
    return spark.createDataFrame(list(data), f"ip string, d string, {LOCATION}").selectExpr(
        "ip", "cast(d as date) date_updated", "normalized_country_code", "normalized_region_code", "normalized_city_name", "normalized_zip"
    )


def test_merge_by_key_leaves_other_slots(spark, w):
    place = ("USA", "R", "C", "1")
    old = ip_rows(spark, *[(f"1.1.1.{k}", "2024-01-01", *place) for k in range(60)], (None, "2024-01-01", *place))
    w.replace("maps/ip_location", old)
    before = files(w.path("maps/ip_location"))
    new = ip_rows(spark, ("1.1.1.7", "2024-02-01", "DEU", "X", "Y", "2"), ("9.9.9.9", "2024-02-01", *place))
    want = rows(bidstream.ip_location_upsert(old, new))
    assert rows(w.merge("maps/ip_location", bidstream.ip_location_upsert, new, co_located=True)) == want
    slots = {f"__slot={r[0]}/" for r in new.select(w._slot(F.col("ip"), 8)).collect()}
    untouched = {f for f in before if not any(s in f[0] for s in slots)}
    assert untouched and untouched < files(w.path("maps/ip_location"))
    assert all(any(s in f[0] for s in slots) for f in files(w.path("maps/ip_location")) - before)
    # another session's warehouse, opened with other numbers, keeps the layout of the stored table
    other = Warehouse(spark, w.root, slots=3, buckets=2)
    assert rows(other.read("maps/ip_location")) == want
    # looked-up places go the same way
    places = ip_rows(spark, ("1.1.1.8", "2024-03-01", "FRA", None, "P", None), ("1.1.1.8", "2024-02-01", *place))
    want = rows(lookup.lookup_location_upsert(w.read("maps/ip_location"), places))
    assert rows(w.merge("maps/ip_location", lookup.lookup_location_upsert, places, co_located=True)) == want


@pytest.mark.parametrize("partitions", [2, 16])
def test_merge_by_key_shuffles_its_source_only(spark, w, partitions):
    w.replace("bid/ip_location", ip_rows(spark, *[(f"1.1.1.{k}", "2024-01-01", "USA", "R", "C", "1") for k in range(40)]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        new = ip_rows(spark, ("1.1.1.7", "2024-02-01", "DEU", "X", "Y", "2"))
        part = w.part_of("bid/ip_location", new)
        text = plan(bidstream.ip_location_upsert(part, new, co_located=True))
        assert text.count("Exchange") == 1 and "Bucketed: true" in text and "PartitionFilters: [isnotnull(__slot" in text
        scan = text.index("FileScan parquet")
        assert "Exchange" not in text[:scan].split("SortMergeJoin")[1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", 4)


def url_rows(spark, *data):
    return spark.createDataFrame(list(data), "page_url string, first string, last string, n bigint").selectExpr(
        "page_url", "xxhash64(page_url) page_url_hash", "'p' publisher_domain_normalized", "cast(first as date) first_seen",
        "cast(last as date) last_seen", "n frequency",
    )


def test_urls_and_insert_by_key(spark, w):
    old = url_rows(spark, *[(f"u{k}", "2024-01-01", "2024-01-02", 2) for k in range(50)])
    w.replace("bid/unique_urls", old)
    before = files(w.path("bid/unique_urls"))
    new = url_rows(spark, ("u3", "2024-01-03", "2024-01-03", 5), ("u4", "2024-01-02", "2024-01-02", 7), ("x", "2024-01-03", "2024-01-03", 1))
    want = rows(bidstream.unique_urls_merge(old, new))
    assert rows(w.merge("bid/unique_urls", bidstream.unique_urls_merge, new, co_located=True)) == want
    assert len(before & files(w.path("bid/unique_urls"))) >= len(before) / 2
    # an insert writes no stored file again
    obs = spark.createDataFrame([("1.1.1.1", "a.com", 1.0), ("2.2.2.2", "b.com", 0.5)], "ip string, c string, s double").selectExpr(
        "ip", "c normalized_company_domain", "'x' source", "s source_confidence", "date'2024-01-01' date"
    )
    w.replace("maps/ip_domain_obs", obs)
    before = files(w.path("maps/ip_domain_obs"))
    from tidemark.plans.vendors import vendor_ip_domain_obs

    vendor = spark.createDataFrame([("1.1.1.1", "a.com", "c.com", 0.7), ("3.3.3.3", "cdn.com", None, 0.2)],
                                   "ip_address string, company_domain string, company_domain_array string, distribution_percentage double")
    shared = spark.createDataFrame([("cdn.com",)], "domain string")
    day = dt.date(2024, 1, 5)
    for _ in range(2):
        out = w.insert("maps/ip_domain_obs", vendor_ip_domain_obs, vendor, day, shared, column="ip_address")
        assert rows(out) == rows(vendor_ip_domain_obs(obs, vendor, day, shared))
    assert before < files(w.path("maps/ip_domain_obs")) and not out.filter("normalized_company_domain in ('cdn.com', 'Shared')").count()


def pre_rows(spark, day, *companies):
    names = [f.split()[0] for f in SCHEMAS["bid/prescoring"].split(", ")]
    df = spark.createDataFrame([(c,) for c in companies], "normalized_company_domain string")
    given = {"date": F.lit(day), "parent_category": F.lit("c"), "category": F.lit("c"), "topic": F.lit("c")}
    for n in names[1:]:
        df = df.withColumn(n, given.get(n, F.lit("L") if n.startswith("normalized") else F.lit(2)))
    return df.select(*names)


def test_merge_by_day_leaves_other_days(spark, w):
    days = [dt.date(2024, 1, k) for k in range(1, 6)]
    for day in days:
        w.merge("bid/prescoring", scoring.prescoring_to_cumulative, w.shaped("bid/prescoring", pre_rows(spark, day, "a", "b")))
    before, old = files(w.path("bid/prescoring")), w.read("bid/prescoring").collect()
    batch = w.shaped("bid/prescoring", pre_rows(spark, days[2], "b", "z"))
    want = rows(enrichment.prescoring_merge(spark.createDataFrame(old, w.read("bid/prescoring").schema), batch))
    assert rows(w.merge("bid/prescoring", enrichment.prescoring_merge, batch)) == want
    assert {f for f in before if "date=2024-01-03" not in f[0]} < files(w.path("bid/prescoring"))
    part = w.part_of("bid/prescoring", batch)
    assert "PartitionFilters: [isnotnull(date" in plan(part)


def test_score_history_by_day(spark, w):
    def scores(day, value):
        names = [f.split()[0] for f in SCHEMAS["score/history"].split(", ")]
        out = spark.range(3).select(*[
            F.lit(day).alias(n) if n == "score_date" else F.concat(F.lit("s"), "id").alias(n) if k < 9 else F.lit(value).cast("double").alias(n)
            for k, n in enumerate(names)
        ])
        return out

    for day in (1, 2, 3):
        w.merge("score/history", scoring.scores_history_merge, scores(dt.date(2024, 1, day), day))
    before = files(w.path("score/history"))
    out = w.merge("score/history", scoring.scores_history_merge, scores(dt.date(2024, 1, 2), 50))
    assert {f for f in before if "score_date=2024-01-02" not in f[0]} < files(w.path("score/history"))
    assert rows(out.groupBy("score_date").agg(F.max("intent_score")))[1] == (dt.date(2024, 1, 2), 50.0) and out.count() == 9


def test_delete_rewrites_hit_partitions_only(spark, w):
    data = [(f"u{k}", d) for d in ("2024-01-01", "2024-01-02", "2024-01-03") for k in range(3)]
    activity = w.shaped("bid/company_activity_cache", spark.createDataFrame(data, "page_url string, d string").select(
        *[F.col("page_url") if c.startswith("page_url") else F.col("d").cast("date").alias("date") if c.startswith("date ") else
          F.lit(None).alias(c.split()[0]) for c in SCHEMAS["bid/company_activity_cache"].split(", ")]))
    w.replace("bid/company_activity_cache", activity.filter("not (page_url <> 'u1' and date = '2024-01-02') and not (page_url = 'u1' and date = '2024-01-03')"))
    before = files(w.path("bid/company_activity_cache"))
    doomed = spark.createDataFrame([("u1",), ("none",)], "page_url string")
    out = w.delete("bid/company_activity_cache", doomed, ["page_url"])
    assert rows(out.select("page_url", F.col("date").cast("string"))) == [("u0", "2024-01-01"), ("u0", "2024-01-03"), ("u2", "2024-01-01"), ("u2", "2024-01-03")]
    # the third day had no such row, the second one has none left
    assert {f for f in before if "date=2024-01-03" in f[0]} < files(w.path("bid/company_activity_cache"))
    assert not any("date=2024-01-02" in f[0] for f in files(w.path("bid/company_activity_cache")))
    w.replace("maps/ip_location", ip_rows(spark, *[(f"1.1.1.{k}", "2024-01-01", None, None, None, None) for k in range(40)]))
    before = files(w.path("maps/ip_location"))
    gone = spark.createDataFrame([("1.1.1.3",)], "ip string")
    assert w.delete("maps/ip_location", gone, ["ip"]).count() == 39
    assert len(before & files(w.path("maps/ip_location"))) >= len(before) / 2
    assert w.delete("maps/ip_location", w.read("maps/ip_location"), ["ip"]).count() == 0


def test_repeated_load_changes_nothing(spark, w):
    ips = [spark.createDataFrame([(ip,)], "user_ip string") for ip in ("1.1.1.1", "2.2.2.2")]
    bids = [ip.selectExpr("'p' page_url", "'d' domain", "'u' user_id", "user_ip ip_address", "timestamp'2024-01-01' bid_time", "'a' geo_country", "'b' geo_region", "'c' geo_zip") for ip in ips]
    for load, bid in (("a", bids[0]), ("a", bids[0]), ("b", bids[1]), ("b", bids[1])):
        w.append("bid/log", bid, load)
    assert rows(w.read("bid/log").select("ip_address")) == [("1.1.1.1",), ("2.2.2.2",)]
    assert w.read("bid/log").columns == spark.createDataFrame([], SCHEMAS["bid/log"]).columns
    w.empty("bid/log")
    assert w.read("bid/log").count() == 0
    with pytest.raises(ValueError):
        w.append("maps/ip_location", w.read("maps/ip_location"))
    with pytest.raises(ValueError):
        w.merge("bid/log", lambda a, b: b, bids[0])


def test_insert_writes_new_rows_only(spark, w):
    seen = frame(spark, ("a", "2024-01-01", 1), ("b", "2024-01-02", 1)).selectExpr("k bitoid", "k ip", "date")
    w.insert("maps/device_ip_obs", bidstream.device_ip_obs_publish, seen)
    before = files(w.path("maps/device_ip_obs"))
    more = seen.union(frame(spark, ("c", "2024-01-02", 1)).selectExpr("k bitoid", "k ip", "date"))
    out = w.insert("maps/device_ip_obs", bidstream.device_ip_obs_publish, more)
    assert rows(out.select("ip")) == [("a",), ("b",), ("c",)]
    added = files(w.path("maps/device_ip_obs")) - before
    assert added and all("date=2024-01-02" in f[0] for f in added) and before < files(w.path("maps/device_ip_obs"))


def test_range_cells(spark):
    """Nested ranges of every width; no cell has more addresses than the largest level allows."""
    spans = [(0, 2**32 - 1), (2**31, 2**31 + 2**24 - 1), (65_535, 65_536), (7, 7), (100_000, 3_000_000_000)]
    ranges = spark.createDataFrame(spans, "ip_range_start_numeric bigint, ip_range_end_numeric bigint")
    ips = [0, 7, 8, 65_535, 65_536, 2**31, 2**31 + 2**24, 3_000_000_000, 3_000_000_001, 2**32 - 1]
    got = ip_range_join(spark.createDataFrame([(n,) for n in ips], "n bigint"), "n", ranges)
    want = sorted((n, lo, hi) for n in ips for lo, hi in spans if lo <= n <= hi)
    assert sorted(map(tuple, got.select("n", "ip_range_start_numeric", "ip_range_end_numeric").collect())) == want
    assert 2 ** max(LEVELS) <= 65_536


def test_shared_folder_is_named_on_a_cluster():
    def of(master, **conf):
        conf = {"spark.sql.warehouse.dir": "/warehouse", **{k.replace("_", "."): v for k, v in conf.items()}}
        return FakeSession(SimpleNamespace(get=lambda key, default=None: conf.get(key, default)), SimpleNamespace(master=master))

    FakeSession = namedtuple("FakeSession", "conf sparkContext")
    assert shared_folder(of("spark://host:7077", spark_checkpoint_dir="s3a://shared/steps")) == "s3a://shared/steps"
    assert shared_folder(of("local[8]")) == "/warehouse/_steps"
    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,1024]"):
        with pytest.raises(ValueError, match="checkpoint"):
            shared_folder(of(master))


def test_lead_load_takes_only_the_columns_of_its_schema(spark, tmp_path):
    """Folders named like partitions add no column."""
    rows_ = spark.createDataFrame([("a", 1)], "company string, score int")
    rows_.write.option("header", "true").csv(str(tmp_path / "leads/part=good"))
    got = lead_load(spark, str(tmp_path / "leads"), "company string, score int")
    assert got.columns == ["company", "score"] and [tuple(r) for r in got.collect()] == [("a", 1)]
