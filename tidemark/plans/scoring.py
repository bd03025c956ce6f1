"""Intent scoring: one series per company, topic and location out of four sources."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import ratio, strict_greatest, strict_least
from tidemark.operators import running_mean_stddev, upsert
from tidemark.plans.bidstream import LOCATION
from tidemark.plans.enrichment import TOPIC, prescoring_merge

# Fixed values
INPUT_LOOKBACK_DAYS = 120
SCORE_LOOKBACK_DAYS = 91
WEEK, MONTH = 7, 30
NO_LEAD_SCORE = 50
SCALE, PIXEL_WEIGHT, CLICK_WEIGHT, OPEN_WEIGHT = 1000, 10, 10, 5
DEFAULT_RELEVANCE, DEFAULT_TYPE_SCORE = 1.0, 100.0
BUSY_POINTS, QUIET_POINTS = 30, 10
REVIEW_POINTS, REVIEW_MAX = 10, 100
CONTEXT_WEIGHTS = {"review_score": 0.3, "activity_score": 0.5, "information_score": 0.2}
FACTOR_WEIGHTS = {"volume": 0.25, "recency": 0.2, "context": 0.5, "variety": 0.05}
WEEK_TREND, WEEK_RANGE = 10, (0, 10)
MONTH_TREND, MONTH_RANGE = 20, (-10, 20)

SERIES = ["normalized_company_domain", *TOPIC, *LOCATION]
SCORE_KEYS = ["score_date", *SERIES]
SCORES = ["volume", "recency", "variety", "context", "week_over_week_trend", "month_over_month_trend", "intent_score"]
_INTEGERS = ["pageviews", "review_pageviews", "unique_pages", "unique_pubs"]


def prescoring_to_cumulative(
    target: DataFrame, cache: DataFrame, key_mode: str = "reference", *, fixed_averages: bool = False
) -> DataFrame:
    """Prescoring cache into the cumulative table (``fixed_averages`` for pixel data)."""
    return prescoring_merge(target, cache, key_mode, fixed_averages=fixed_averages)


def combine_sources(
    bid: DataFrame,
    pixel: DataFrame,
    email: DataFrame,
    lead: DataFrame,
    lookback_date: dt.date,
    as_of: dt.date,
) -> DataFrame:
    """Blend the four prescoring tables from the look-back day up to, not including, ``as_of``.

    All full outer joins of the blend compare with the bid row's keys, so a row
    of another source either extends bid rows or stands alone.  That is a chain
    of left joins from the bid table plus each source's unmatched rows: no join
    ever sees a column of NULL keys, and a key with very many bid rows can be
    split.
    """
    day = F.col("date")
    window = (day >= F.lit(lookback_date)) & (day < F.lit(as_of))
    b = bid.filter(window).drop("unique_devices", "unique_ips")
    keys = ["normalized_company_domain", *TOPIC, "date"]
    sources = {
        "e": (email.filter(window), keys, ["weighted_clicks", "weighted_opens"]),
        "l": (lead.filter(window), keys, ["leadsift_score"]),
        "p": (pixel.filter(window), [*SERIES, "date"], ["pageviews", "weighted_pageviews", "unique_pages", "unique_pubs"]),
    }
    measures = [c for c in b.columns if c not in [*SERIES, "date"]]
    rows = b.withColumnsRenamed({c: f"b_{c}" for c in measures})
    alone = []
    for name, (source, on, values) in sources.items():
        side = source.select(*on, *[F.col(c).alias(f"{name}_{c}") for c in values])
        rows = rows.join(side, on, "left")
        alone.append(side.join(b.select(*on), on, "left_anti"))
    for rest in alone:
        rows = rows.unionByName(rest, allowMissingColumns=True)

    def n(column: str) -> Column:
        return F.coalesce(F.col(column), F.lit(0))

    lead_score = F.when(F.col("l_leadsift_score") == 0, F.lit(NO_LEAD_SCORE)).otherwise(F.col("l_leadsift_score"))
    lead_share = lead_score / F.lit(100)
    whole = (
        F.coalesce(F.ceil(lead_share), F.lit(0))
        + F.coalesce(F.ceil("e_weighted_clicks"), F.lit(0))
        + F.coalesce(F.ceil("e_weighted_opens"), F.lit(0))
    )
    blended = F.lit(SCALE) * (
        n("b_weighted_pageviews")
        + F.lit(PIXEL_WEIGHT) * n("p_weighted_pageviews")
        + F.coalesce(lead_share, F.lit(0.0))
        + n("e_weighted_clicks") * F.lit(CLICK_WEIGHT)
        + F.lit(OPEN_WEIGHT) * n("e_weighted_opens")
    )
    return rows.select(
        *SERIES,
        "date",
        (n("b_pageviews") + n("p_pageviews") + whole).cast("bigint").alias("pageviews"),
        F.round(blended, 6).alias("weighted_pageviews"),
        F.coalesce("b_avg_page_relevance", F.lit(DEFAULT_RELEVANCE)).alias("avg_page_relevance"),
        F.coalesce("b_activity_type_score", F.lit(DEFAULT_TYPE_SCORE)).alias("activity_type_score"),
        F.coalesce("b_information_type_score", F.lit(DEFAULT_TYPE_SCORE)).alias("information_type_score"),
        n("b_review_pageviews").cast("bigint").alias("review_pageviews"),
        (n("b_unique_pages") + n("p_unique_pages") + whole).cast("bigint").alias("unique_pages"),
        (n("b_unique_pubs") + n("p_unique_pubs") + whole).cast("bigint").alias("unique_pubs"),
    )


def rolling_stats(combined: DataFrame) -> DataFrame:
    """Running mean and deviation of weighted page views per series (positive rows only)."""
    return running_mean_stddev(
        combined.filter(F.col("weighted_pageviews") > 0),
        SERIES,
        "date",
        "weighted_pageviews",
        _INTEGERS,
        "moving_avg_weighted_pageviews",
        "moving_stddev_weighted_pageviews",
    )


def _clamp(value: Column, low: float, high: float) -> Column:
    return strict_least(F.lit(float(high)), strict_greatest(F.lit(float(low)), value))


def _trend(now: str, before: str) -> Column:
    a, b = F.col(now), F.col(before)
    return (
        F.when((a == 0) & (b == 0), 0.0)
        .when((a > 0) & (b == 0), 1.0)
        .otherwise(ratio(a - b, b))
    )


def _score(rows: DataFrame) -> DataFrame:
    """Scores of rows that carry their ``score_date``.

    Weekly and monthly volumes are conditional sums of the same grouping, not
    joins.  As those joins would not match NULL keys, a series with a NULL key
    part has no trend.
    """
    age = F.datediff("score_date", "date")
    w, relevance = F.col("weighted_pageviews"), F.col("avg_page_relevance")
    usual = F.col("moving_avg_weighted_pageviews") + F.col("moving_stddev_weighted_pageviews")
    complete = F.lit(True)
    for k in SERIES:
        complete = complete & F.col(k).isNotNull()

    def volume_of(period: int, number: int) -> Column:
        return F.coalesce(F.sum(F.when(complete & (F.floor(age / period) == number), w)), F.lit(0.0))

    sums = rows.groupBy(*SCORE_KEYS).agg(
        F.sum(F.when(w > usual, BUSY_POINTS * relevance).otherwise(QUIET_POINTS * relevance)).alias("points"),
        F.sum(w * (SCORE_LOOKBACK_DAYS - age)).alias("fresh"),
        F.sum(w).alias("total"),
        F.sum("unique_pages").alias("pages"),
        F.sum("unique_pubs").alias("pubs"),
        F.sum("pageviews").alias("views"),
        F.sum("review_pageviews").alias("reviews"),
        F.avg(F.col("activity_type_score") * relevance).alias("activity_score"),
        F.avg(F.col("information_type_score") * relevance).alias("information_score"),
        volume_of(WEEK, 0).alias("this_week"),
        volume_of(WEEK, 1).alias("last_week"),
        volume_of(MONTH, 0).alias("this_month"),
        volume_of(MONTH, 1).alias("last_month"),
    )
    reviews = F.col("reviews")
    # 0 to 9 reviews earn ten points each, anything else the full hundred
    few = reviews.between(0, REVIEW_MAX // REVIEW_POINTS - 1)
    scored = sums.withColumns(
        {
            "volume": strict_least(F.lit(100.0), F.col("points")),
            "recency": ratio(F.col("fresh"), (SCORE_LOOKBACK_DAYS - 1) * F.col("total")) * 100,
            "variety": 50 * ratio(F.col("pages"), F.col("views")) + 50 * ratio(F.col("pubs"), F.col("pages")),
            "review_score": F.when(few, reviews * REVIEW_POINTS).otherwise(REVIEW_MAX),
            "week_over_week_trend": _trend("this_week", "last_week"),
            "month_over_month_trend": _trend("this_month", "last_month"),
        }
    )
    scored = scored.withColumn("context", sum(F.col(c) * wt for c, wt in CONTEXT_WEIGHTS.items()))
    factors = sum(F.col(c) * wt for c, wt in FACTOR_WEIGHTS.items())
    trend = _clamp(WEEK_TREND * F.col("week_over_week_trend"), *WEEK_RANGE) + _clamp(
        MONTH_TREND * F.col("month_over_month_trend"), *MONTH_RANGE
    )
    scored = scored.withColumn("intent_score", _clamp(factors + trend, 0, 100))
    return scored.select(*SCORE_KEYS, *SCORES)


def _inside_lookback(age: Column) -> Column:
    return (age > 0) & (age <= SCORE_LOOKBACK_DAYS)


def score_days(scoring_input: DataFrame, days: DataFrame) -> DataFrame:
    """Scores of all days in ``days`` (column ``score_date``) in one job.

    A row counts for the days that look back on it: those of the ``SCORE_LOOKBACK_DAYS`` after its
    own that ``days`` has.  The range of days is a one-row summary, so no row is multiplied beyond it.
    """
    wanted = days.select("score_date").filter(F.col("score_date").isNotNull()).distinct()
    first, last = wanted.agg(F.min("score_date")).scalar(), wanted.agg(F.max("score_date")).scalar()
    start = F.greatest(F.date_add("date", 1), first)
    end = F.least(F.date_add("date", SCORE_LOOKBACK_DAYS), last)
    rows = scoring_input.filter(F.col("date").isNotNull()).withColumns({"__start": start, "__end": end})
    rows = rows.filter(F.col("__start") <= F.col("__end"))
    rows = rows.withColumn("score_date", F.explode(F.sequence("__start", "__end"))).drop("__start", "__end")
    return _score(rows.join(wanted, "score_date"))


def score_backfill(scoring_input: DataFrame, score_dates: Sequence[dt.date]) -> DataFrame:
    """Scores for a list of days in one job.

    Each row is handed to the score days that look back on it; the grouping
    combines them map-side.
    """
    dates = sorted(set(score_dates))
    first, last = dates[0] - dt.timedelta(days=SCORE_LOOKBACK_DAYS), dates[-1]
    rows = scoring_input.filter((F.col("date") >= F.lit(first)) & (F.col("date") < F.lit(last)))
    if len(dates) == 1:
        return _score(rows.withColumn("score_date", F.lit(dates[0])))
    wanted = F.filter(
        F.array(*[F.lit(d) for d in dates]), lambda d: _inside_lookback(F.datediff(d, F.col("date")))
    )
    return _score(rows.withColumn("score_date", F.explode(wanted)))


def intent_score(target: DataFrame, scoring_input: DataFrame, score_date: dt.date) -> DataFrame:
    """Scores of one day merged into the output; series with a NULL key are added anew."""
    return upsert(target, score_backfill(scoring_input, [score_date]), SCORE_KEYS, SCORES, unique_source=True)


def scores_history_merge(history: DataFrame, scores: DataFrame) -> DataFrame:
    """Scores into the history."""
    return upsert(history, scores, SCORE_KEYS, SCORES)


def backfill_days(prescoring_cache: DataFrame, global_min: dt.date, today: dt.date) -> DataFrame:
    """Days to score again, as ``score_date``: after the earliest cached day up to today.

    None is before the day after ``global_min``; without cached rows that day is the first.
    """
    # greatest skips the NULL of an empty cache
    after = F.greatest(F.lit(global_min), F.min("date").cast("date"))
    bounds = prescoring_cache.agg(F.date_add(after, 1).alias("first"))
    days = bounds.filter(F.col("first") <= F.lit(today)).select(
        F.explode(F.sequence("first", F.lit(today))).alias("score_date")
    )
    return days


def scores_of_days(target: DataFrame, scoring_input: DataFrame, days: DataFrame) -> DataFrame:
    """Scores of all ``days`` merged into the output; series with a NULL key are added anew."""
    return upsert(target, score_days(scoring_input, days), SCORE_KEYS, SCORES, unique_source=True)


def lookback_date(min_score_date: dt.date) -> dt.date:
    """First day of scoring input needed for a score day."""
    return min_score_date - dt.timedelta(days=INPUT_LOOKBACK_DAYS)
