"""File streams: each file counts once, repeated batches change nothing."""

import datetime as dt

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from conftest import DATA, rows
from tidemark.plans import bidstream, flows, pixel
from tidemark.sources import Warehouse
from tidemark.sources.warehouse import SCHEMAS
from tidemark.streaming import loads
from workload.steps import Steps


def test_pixel_stream_equals_batch(spark, tmp_path):
    i = Steps(spark, DATA)
    incoming, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")
    w = Warehouse(spark, str(tmp_path / "w"))
    half = F.col("pixel_record").contains('"c1"') | F.col("pixel_record").contains('"c2"')
    i.pixel_raw.filter(half).write.text(incoming)
    loads.stream_pixel(spark, incoming, w, checkpoint).awaitTermination()
    i.pixel_raw.filter(~half).write.mode("append").text(incoming)
    for _ in range(2):  # the last run finds no new file
        loads.stream_pixel(spark, incoming, w, checkpoint).awaitTermination()
    want = pixel.pixel_views(i.pixel_records)
    got = w.read("pixel/user_activity")
    assert rows(got.select(*want.columns)) == rows(want)


def test_repeated_batch_changes_nothing(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "w"))
    raw = Steps(spark, DATA).pixel_records
    want = rows(pixel.pixel_views(raw))
    for _ in range(2):
        loads.add_pixel_batch(w, raw, "s-0")
        assert rows(w.read("pixel/user_activity")) == want
    # the same records as another batch count again, like a merge of both
    loads.add_pixel_batch(w, raw, "s-1")
    assert rows(w.read("pixel/user_activity")) == rows(pixel.add_views(pixel.pixel_views(raw), pixel.pixel_views(raw)))


def csv(path, name, header, *lines):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join([header, *lines]) + "\n")


def test_feeds_load_files_once(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "w"))
    clicks = tmp_path / "clicks"
    header = "cam_id,domain,time,link"
    csv(clicks, "a.csv", header, "c1,x.com,2024-01-01 00:00:00,l1", "c2,y.com,2024-01-02 00:00:00,l2")
    for _ in range(2):
        loads.load_feed(w, "email/clicks", str(clicks))
        assert w.read("email/clicks").count() == 2
    csv(clicks, "b.csv", header, "c3,z.com,2024-01-03 00:00:00,l3")
    loads.load_feed(w, "email/clicks", str(clicks))
    assert rows(w.read("email/clicks").select("cam_id")) == [("c1",), ("c2",), ("c3",)]
    # a broken line stops the load, and the file stays to be loaded when it is mended
    csv(clicks, "c.csv", header, "c4,z.com,no time,l3")
    for _ in range(2):
        with pytest.raises(StreamingQueryException):
            loads.load_feed(w, "email/clicks", str(clicks))
    assert w.read("email/clicks").count() == 3


def test_lead_feed_leaves_out_broken_files(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "w"))
    leads = tmp_path / "leads"
    header = ",".join(f.split()[0] for f in SCHEMAS["lead/cache"].split(", "))
    good = "2024-01-01,c,d.com,co,t,s,f,tt,i,cs,ci,st,co,"
    csv(leads, "good.csv", header, good + "5", good + "6")
    csv(leads, "bad.csv", header, good + "7", good + "no number")
    for _ in range(2):
        loads.load_feed(w, "lead/cache", str(leads))
        assert rows(w.read("lead/cache").select("score")) == [(5,), (6,)]


def test_full_feed_replaces_the_table(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "w"))
    ranges = tmp_path / "ranges"
    names = [f.split()[0] for f in SCHEMAS["vendor/ip_ranges_raw"].split(", ")]

    def line(ip):
        return ",".join({"ip_range_start": ip, "ip_range_end": ip, "domain_name": "a.com", "pulseplus_country": "usa"}.get(n, "") for n in names)

    csv(ranges, "one.csv", ",".join(names), line("1.1.1.1"), line("2.2.2.2"))
    flows.ip_ranges(w, None, dt.date(2024, 1, 1), str(ranges))
    assert w.read("vendor/ip_ranges_raw").count() == 2 and w.read("vendor/ip_ranges").count() == 2
    csv(ranges, "two.csv", ",".join(names), line("3.3.3.3"))
    for _ in range(2):
        flows.ip_ranges(w, None, dt.date(2024, 1, 2), str(ranges))
        assert rows(w.read("vendor/ip_ranges").select("ip_range_start")) == [("3.3.3.3",)]


def test_flow_from_files(spark, tmp_path):
    """Pixel files and leads through their flows: a second run adds nothing."""
    i = Steps(spark, DATA)
    w = Warehouse(spark, str(tmp_path / "w"), slots=4, buckets=2)
    i.pixel_raw.write.text(str(tmp_path / "pixel"))
    w.replace("maps/geos", i.geos)
    for _ in range(2):
        flows.pixel_records(w, dt.date(2024, 1, 31), first_day=dt.date(2023, 12, 31), incoming=str(tmp_path / "pixel"))
        want = pixel.pixel_views(i.pixel_records)
        assert rows(w.read("pixel/user_activity").select(*want.columns)) == rows(want)
        assert w.read("pixel/raw").isEmpty()
    leads = tmp_path / "leads"
    w.shaped("lead/cache", i.lead_flat).write.option("header", "true").csv(str(leads))
    w.replace("lead/topic_map", i.lead_topic_map)
    counts = []
    for _ in range(2):
        flows.leads(w, str(leads))
        counts.append(w.read("lead/leads").count())
    assert counts[0] == counts[1] > 0


def test_bid_stream_load(spark, tmp_path):
    i = Steps(spark, DATA)
    incoming = str(tmp_path / "in")
    w = Warehouse(spark, str(tmp_path / "w"))
    w.shaped("bid/log", i.bid_log).write.parquet(incoming)
    cut = dt.datetime(2024, 1, 31)
    loads.stream_bid_log(spark, incoming, w, str(tmp_path / "cp"), cut).awaitTermination()
    want = bidstream.user_activity_rollup(i.bid_log, cut)
    assert rows(w.read("bid/user_activity").select(*want.columns)) == rows(want)
