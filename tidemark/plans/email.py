"""E-mail campaigns: clicks, opens, campaign topics, prescoring."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import domain_normalizer
from tidemark.operators import share_of_total
from tidemark.plans.bidstream import enqueue, never_scraped, url_stats

# Fixed values
LINK_CUT = "?email"
PROBABILITY = "decimal(5,4)"
# digits kept of a campaign's topic proportion, so that later sums are exact
PROPORTION = "decimal(12,10)"

TOPIC = ["parent_category", "category", "topic"]
GROUP = ["normalized_company_domain", "date", *TOPIC]


def landing_page(link: Column) -> Column:
    """Link without the recipient part."""
    return F.split_part(link, F.lit(LINK_CUT), F.lit(1))


def company_clicks(clicks: DataFrame) -> DataFrame:
    """Distinct clicks per campaign, company, day and landing page."""
    return (
        clicks.distinct()
        .select(
            "cam_id",
            domain_normalizer(F.col("domain")).alias("normalized_company_domain"),
            F.to_date("time").alias("date"),
            landing_page(F.col("link")).alias("page_url"),
        )
        .dropna()
        .groupBy("cam_id", "normalized_company_domain", "date", "page_url")
        .agg(F.count(F.lit(1)).alias("frequency"))
    )


def company_opens(opens: DataFrame) -> DataFrame:
    """Distinct opens per campaign, company and day."""
    return (
        opens.distinct()
        .select(
            "cam_id",
            domain_normalizer(F.col("domain")).alias("normalized_company_domain"),
            F.to_date("time").alias("date"),
        )
        .dropna()
        .groupBy("cam_id", "normalized_company_domain", "date")
        .agg(F.count(F.lit(1)).alias("frequency"))
    )


def email_unique_urls(clicks: DataFrame) -> DataFrame:
    """URL statistics over all clicks, repeated ones included."""
    pages = clicks.select(landing_page(F.col("link")).alias("page_url"), F.to_date("time").alias("date"))
    return url_stats(
        pages.withColumn("publisher_domain_normalized", domain_normalizer(F.col("page_url")))
    )


def campaign_content(clicks: DataFrame) -> DataFrame:
    """Landing pages of each campaign."""
    return clicks.select("cam_id", landing_page(F.col("link")).alias("page_url")).distinct()


def _topic_rows(df: DataFrame, array_col: str, keep: list[str]) -> DataFrame:
    """Every topic object of every row (repeats included), probability as a decimal."""
    return df.select(*keep, F.explode(array_col).alias("t")).select(
        *keep,
        F.col("t.parentCategory").alias("parent_category"),
        F.col("t.category").alias("category"),
        F.col("t.topic").alias("topic"),
        F.col("t.probability").cast(PROBABILITY).alias("probability"),
    )


def campaign_topics(content: DataFrame, topics: DataFrame) -> DataFrame:
    """Topic shares of each campaign's pages, no floor."""
    rows = content.join(topics.select("page_url", "intent_topics"), "page_url")
    summed = (
        _topic_rows(rows, "intent_topics", ["cam_id"])
        .groupBy("cam_id", *TOPIC)
        .agg(F.sum("probability").alias("summed"))
    )
    return share_of_total(summed, "cam_id", "summed", "proportion", guard_zero=False).drop("summed")


def email_scrape_queue(queue: DataFrame, urls: DataFrame, results: DataFrame, as_of: dt.date) -> DataFrame:
    """Queue never-scraped landing pages."""
    return enqueue(queue, never_scraped(urls, results).select("page_url").distinct(), as_of)


def _weighted_clicks(clicks: DataFrame, pages: DataFrame, array_col: str) -> DataFrame:
    rows = clicks.join(pages.select("page_url", array_col), "page_url")
    return (
        _topic_rows(rows, array_col, ["normalized_company_domain", "date", "frequency"])
        .groupBy(*GROUP)
        .agg(F.sum(F.col("frequency") * F.col("probability")).cast("double").alias("weighted_clicks"))
    )


def email_prescoring(
    clicks: DataFrame, opens: DataFrame, topic_shares: DataFrame, topics: DataFrame, brands: DataFrame
) -> DataFrame:
    """Weighted clicks (by brand topics, and by page topics) beside weighted opens.

    Opens stand in both halves; equal rows collapse.  Sums are decimal, so the
    two halves agree to the last digit.
    """
    weighted_opens = (
        opens.join(topic_shares, "cam_id")
        .groupBy(*GROUP)
        .agg(
            F.sum(F.col("frequency") * F.col("proportion").cast(PROPORTION))
            .cast("double")
            .alias("weighted_opens")
        )
    )
    halves = [
        _weighted_clicks(clicks, brands, "brand_topics").join(weighted_opens, GROUP, "full"),
        _weighted_clicks(clicks, topics, "intent_topics").join(weighted_opens, GROUP, "full"),
    ]
    halves = [h.fillna(0.0, subset=["weighted_opens", "weighted_clicks"]) for h in halves]
    return halves[0].unionByName(halves[1]).distinct()
