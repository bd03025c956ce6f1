"""Intermediate tables of the pipelines, built from the inputs by the library's operators."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import incremental_slice, topics_from_json
from tidemark.plans import bidstream, content, email, enrichment, pixel, scoring, vendors
from tidemark.sources import save_table
from workload.base import AS_OF, shared_folder
from workload.inputs import Inputs

EARLY_END = dt.datetime(2024, 1, 20)
LATE_START = dt.datetime(2024, 1, 10)
ALL = dt.datetime(2024, 1, 31)
MARK = dt.date(2024, 1, 4)
PIXEL_SCHEMA = "struct<userId:string,ip:string,date:string,userAgent:string,thirdPartyId:string>"


class stored:
    """A step kept as a written table, as the pipelines keep it between their steps.

    Several later steps read it, so writing it once keeps plans short and a lost
    executor from repeating the whole history.
    """

    def __init__(self, fn):
        self.fn, self.name = fn, fn.__name__

    def __get__(self, steps: Steps, owner) -> DataFrame:
        if steps is None:
            return self
        if self.name not in steps._tables:
            steps._tables[self.name] = save_table(self.fn(steps), f"{steps.folder}/{self.name}")
        return steps._tables[self.name]


class Steps(Inputs):
    def __init__(self, spark, sf_dir):
        super().__init__(spark, sf_dir)
        self._tables: dict[str, DataFrame] = {}

    @cached_property
    def folder(self) -> str:
        return f"{shared_folder(self.spark)}/steps-{uuid.uuid4().hex}"

    def fresh(self, name: str) -> DataFrame:
        """A stored step as a plan, computed by whoever asks for it."""
        return getattr(type(self), name).fn(self)

    def empty(self, ddl: str) -> DataFrame:
        return self.spark.createDataFrame([], ddl)

    # bid stream
    @stored
    def activity(self):
        return bidstream.user_activity_rollup(self.bid_log, ALL)

    @cached_property
    def activity_early(self):
        return bidstream.user_activity_rollup(self.bid_log, EARLY_END)

    @cached_property
    def activity_late(self):
        late = self.bid_log.filter(F.col("bid_time") > F.lit(LATE_START))
        return bidstream.user_activity_rollup(late, ALL)

    @cached_property
    def activity_slice(self):
        return incremental_slice(self.activity, "date", MARK, bidstream.SLICE_DAYS)

    @cached_property
    def ranges(self):
        return vendors.ip_range_clean(self.ip_range, AS_OF)

    @stored
    def ip_domain(self):
        return bidstream.ip_domain_scores(self.ip_domain_obs, AS_OF)

    @stored
    def trio_map(self):
        return bidstream.ip_trio_scores(self.ip_domain, self.isp_domains)

    @cached_property
    def device_ip(self):
        return bidstream.device_ip_obs(self.empty("bitoid string, ip string, date date"), self.activity)

    @cached_property
    def device_obs_known(self):
        return self.supplier.select(
            F.concat(F.lit("u"), F.col("s_suppkey")).alias("bitoid"),
            F.concat(F.lit("company"), F.col("s_suppkey") + F.col("s_nationkey") % 3, F.lit(".com")).alias(
                "normalized_company_domain"
            ),
            F.lit("PARTNER").alias("source"),
            F.lit(0.4).alias("source_confidence"),
            F.lit(dt.date(2024, 1, 12)).alias("date"),
        )

    @stored
    def device_obs(self):
        return bidstream.device_domain_obs(self.device_obs_known, self.device_ip, self.ip_domain)

    @stored
    def device_best(self):
        return bidstream.device_domain_best(self.device_obs, self.isp_domains)

    @stored
    def resolvable(self):
        empty = self.empty("normalized_company_domain string, date date")
        return bidstream.ip_resolvable_domains(empty, self.activity_slice, self.ip_domain, self.isp_domains)

    @stored
    def company_activity(self):
        return bidstream.company_activity(
            self.activity_slice,
            self.ip_domain,
            self.device_best,
            self.trio_map,
            self.resolvable,
            self.ip_location,
            self.geos,
            self.isp_domains,
            AS_OF,
        )

    # page labels
    @cached_property
    def topics(self):
        return self.topic_output.withColumn("intent_topics", topics_from_json(F.col("intent_topics")))

    @cached_property
    def brands(self):
        return self.brand_output.withColumn("brand_topics", topics_from_json(F.col("brand_topics")))

    @cached_property
    def context(self):
        return self.context_output.withColumn("context", enrichment.context_from_json(F.col("context")))

    @cached_property
    def titles(self):
        return self.title_output.withColumn("topics", enrichment.title_topics_from_json(F.col("topics")))

    @stored
    def enriched(self):
        return enrichment.enrich_activity(
            self.company_activity, self.topics, self.brands, self.context, self.titles, activity_distinct=True
        )

    # pixel
    @cached_property
    def pixel_records(self):
        return self.pixel_raw.select(F.from_json("pixel_record", PIXEL_SCHEMA).alias("pixel_record"))

    @stored
    def pixel_activity(self):
        return pixel.pixel_views(self.pixel_records)

    @stored
    def pixel_company(self):
        rows = incremental_slice(
            self.pixel_activity, "date", dt.date(2024, 1, 5), pixel.SLICE_DAYS, inclusive=True
        )
        return pixel.pixel_company_rollup(rows, self.ip_domain, self.ip_location)

    @stored
    def pixel_enriched(self):
        return enrichment.enrich_activity(
            self.pixel_company, self.topics, self.brands, self.context, self.titles, activity_distinct=True
        )

    # e-mail
    @stored
    def click_rows(self):
        return email.company_clicks(self.clicks)

    @stored
    def open_rows(self):
        return email.company_opens(self.opens)

    @stored
    def topic_shares(self):
        return email.campaign_topics(email.campaign_content(self.clicks), self.topics)

    # scraped pages
    @stored
    def page_results(self):
        none = self.empty(
            "page_url string, result string, title string, content string, last_scraped date, "
            "content_type string, image string, language string, cleaned_content string, cleaned_title string"
        )
        return content.scrape_results(none, self.scrape_output, AS_OF)

    @stored
    def ngrams(self):
        return content.page_ngrams(self.empty("page_url string, ngrams array<string>"), self.page_results)

    @cached_property
    def topic_brands(self):
        return self.brand_ref.groupBy("parent_category", "category", "original_topic").agg(
            F.collect_set("brand").alias("brands"), F.collect_set("domain").alias("domains")
        )

    @cached_property
    def reference_topics(self):
        topic = F.struct(
            F.lit("p1").alias("parentCategory"),
            F.lit("c1").alias("category"),
            F.col("brand_topic").alias("topic"),
            F.lit("0.5").alias("probability"),
        )
        return self.brand_ref.withColumn("brand_topics", F.array(topic)).drop("brand_topic")

    # scoring
    @stored
    def combined(self):
        return scoring.combine_sources(
            self.prescoring_bid,
            self.prescoring_pixel,
            self.prescoring_email,
            self.prescoring_lead,
            dt.date(2024, 1, 3),
            AS_OF,
        )

    @stored
    def scoring_input(self):
        return scoring.rolling_stats(self.combined)
