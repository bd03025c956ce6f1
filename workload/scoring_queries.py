"""Scoring queries and their checking SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.plans import scoring
from tidemark.plans.enrichment import PRESCORING_COLUMNS
from workload.base import AS_OF, piece, query
from workload.bid_queries import DAY, merge_sql

LOOKBACK = dt.date(2024, 1, 3)
SERIES = (
    "normalized_company_domain, parent_category, category, topic, normalized_country_code, "
    "normalized_region_code, normalized_city_name, normalized_zip"
)
S = [c.strip() for c in SERIES.split(",")]
WINDOW = f"date >= date '{LOOKBACK}' and date < {DAY}"

for name in ("bid", "pixel", "email", "lead"):
    piece(f"o_{name}_in", f"select * from in_prescoring_{name} where {WINDOW}")

FIVE = ["normalized_company_domain", "parent_category", "category", "topic", "date"]
TEXT = "ceil((case when l.leadsift_score = 0 then 50 else l.leadsift_score end) / 100.0)"
WHOLE = f"coalesce({TEXT}, 0) + coalesce(ceil(e.weighted_clicks), 0) + coalesce(ceil(e.weighted_opens), 0)"
piece(
    "o_combined",
    "select "
    + ", ".join(f"coalesce(b.{c}, p.{c}, l.{c}, e.{c}) as {c}" for c in FIVE)
    + ", "
    + ", ".join(f"coalesce(b.{c}, p.{c}) as {c}" for c in S[4:])
    + f""",
  (coalesce(b.pageviews, 0) + coalesce(p.pageviews, 0) + {WHOLE})::bigint as pageviews,
  round(1000 * (coalesce(b.weighted_pageviews, 0) + 10 * coalesce(p.weighted_pageviews, 0) + coalesce((case when l.leadsift_score = 0 then 50 else l.leadsift_score end)::double / 100, 0)
    + coalesce(e.weighted_clicks, 0) * 10 + 5 * coalesce(e.weighted_opens, 0)), 6) as weighted_pageviews,
  coalesce(b.avg_page_relevance, 1.0::double) as avg_page_relevance, coalesce(b.activity_type_score, 100.0::double) as activity_type_score,
  coalesce(b.information_type_score, 100.0::double) as information_type_score, coalesce(b.review_pageviews, 0)::bigint as review_pageviews,
  (coalesce(b.unique_pages, 0) + coalesce(p.unique_pages, 0) + {WHOLE})::bigint as unique_pages,
  (coalesce(b.unique_pubs, 0) + coalesce(p.unique_pubs, 0) + {WHOLE})::bigint as unique_pubs
from o_bid_in b
full join o_email_in e on {" and ".join(f"b.{c} = e.{c}" for c in FIVE)}
full join o_lead_in l on {" and ".join(f"b.{c} = l.{c}" for c in FIVE)}
full join o_pixel_in p on {" and ".join(f"b.{c} = p.{c}" for c in [*S, "date"])}""",
)


def rounded(*cols: str) -> str:
    return ", ".join(f"round({c}, 6) as {c}" for c in cols)


COMBINED = (
    f"{SERIES}, date, pageviews, weighted_pageviews, "
    + rounded("avg_page_relevance", "activity_type_score", "information_type_score")
    + ", review_pageviews, unique_pages, unique_pubs"
)


@query("combine_sources", f"select {COMBINED} from o_combined")
def _(i):
    return i.fresh("combined")


TIES = ["pageviews", "review_pageviews", "unique_pages", "unique_pubs"]
ORDER = (
    "date, substr(md5(" + " || '|' || ".join(f"{c}::varchar" for c in TIES) + "), 1, 2), " + ", ".join(TIES)
    + ", weighted_pageviews, avg_page_relevance, activity_type_score, information_type_score"
)
piece(
    "o_scoring_input",
    f"""
select *, avg(weighted_pageviews) over w as moving_avg_weighted_pageviews, coalesce(stddev_samp(weighted_pageviews) over w, 0) as moving_stddev_weighted_pageviews
from o_combined where weighted_pageviews > 0
window w as (partition by {SERIES} order by {ORDER} rows between unbounded preceding and current row)""",
)


@query(
    "rolling_stats",
    f"select {COMBINED}, {rounded('moving_avg_weighted_pageviews', 'moving_stddev_weighted_pageviews')} from o_scoring_input",
)
def _(i):
    return scoring.rolling_stats(i.fresh("combined"))


def score_sql(day: str) -> str:
    """Checking SQL of the scores of one day, trends by joins as in the definition."""
    same = lambda t: " and ".join(f"a.{c} = {t}.{c}" for c in S)
    rows = f"(select * from o_scoring_input where date >= {day} - 91 and date < {day})"

    def volume(name: str, period: int, number: int) -> str:
        return (
            f"left join (select {SERIES}, sum(weighted_pageviews) as v from {rows} where ({day} - date) // {period} = {number} "
            f"group by {SERIES}) {name} on {same(name)}"
        )

    return f"""
select score_date, {SERIES}, volume, recency, variety, context, wow as week_over_week_trend, mom as month_over_month_trend,
  least(100, greatest(0, 0.25 * volume + 0.2 * recency + 0.5 * context + 0.05 * variety + least(10, greatest(0, 10 * wow)) + least(20, greatest(-10, 20 * mom)))) as intent_score
from (select *, 0.3 * review + 0.5 * act + 0.2 * inf as context,
    case when tw = 0 and lw = 0 then 0 when tw > 0 and lw = 0 then 1 else (tw - lw) / lw end as wow,
    case when tm = 0 and lm = 0 then 0 when tm > 0 and lm = 0 then 1 else (tm - lm) / lm end as mom
  from (select {day} as score_date, {", ".join("a." + c for c in S)},
      least(100, sum(case when weighted_pageviews > moving_avg_weighted_pageviews + moving_stddev_weighted_pageviews then 30 * avg_page_relevance else 10 * avg_page_relevance end)) as volume,
      sum(weighted_pageviews * (91 - ({day} - date))) / (90 * sum(weighted_pageviews)) * 100 as recency,
      50 * (sum(unique_pages)::double / sum(pageviews)) + 50 * (sum(unique_pubs)::double / sum(unique_pages)) as variety,
      case when sum(review_pageviews) between 0 and 9 then 10 * sum(review_pageviews)::double else 100 end as review,
      avg(activity_type_score * avg_page_relevance) as act, avg(information_type_score * avg_page_relevance) as inf,
      any_value(coalesce(tw.v, 0)) as tw, any_value(coalesce(lw.v, 0)) as lw, any_value(coalesce(tm.v, 0)) as tm, any_value(coalesce(lm.v, 0)) as lm
    from {rows} a {volume("tw", 7, 0)} {volume("lw", 7, 1)} {volume("tm", 30, 0)} {volume("lm", 30, 1)}
    group by {", ".join("a." + c for c in S)}) x) y"""


piece("o_scores", score_sql(DAY))
SCORES = ["volume", "recency", "variety", "context", "week_over_week_trend", "month_over_month_trend", "intent_score"]
OUT = f"score_date, {SERIES}, " + rounded(*SCORES)
piece("o_scores_mid", score_sql("date '2024-01-20'"))
piece("o_scores_early", score_sql("date '2024-01-12'"))
MATCH = " and ".join(f"t.{c} = s.{c}" for c in ["score_date", *S])


def overwrite_sql(target: str, source: str) -> str:
    return f"select {OUT} from {source} s union all select {OUT} from {target} t where not exists (select 1 from {source} s where {MATCH})"


piece("o_scores_old", "select * replace (intent_score / 2 as intent_score) from o_scores where topic in ('t1', 't2', 'x') union all select * from o_scores_mid")


def _old(i):
    now = scoring.score_backfill(i.scoring_input, [AS_OF]).filter(F.col("topic").isin("t1", "t2", "x"))
    mid = scoring.score_backfill(i.scoring_input, [dt.date(2024, 1, 20)])
    return now.withColumn("intent_score", F.col("intent_score") / 2).unionByName(mid)


@query("intent_score", overwrite_sql("o_scores_old", "o_scores"))
def _(i):
    return scoring.intent_score(_old(i), i.scoring_input, AS_OF)


@query("scores_history_merge", overwrite_sql("o_scores_old", "o_scores"))
def _(i):
    return scoring.scores_history_merge(_old(i), scoring.score_backfill(i.scoring_input, [AS_OF]))


@query(
    "score_backfill",
    " union all ".join(f"select {OUT} from {p}" for p in ("o_scores", "o_scores_mid", "o_scores_early")),
)
def _(i):
    return scoring.score_backfill(i.scoring_input, [AS_OF, dt.date(2024, 1, 20), dt.date(2024, 1, 12)])


@query(
    "score_backfill_dates",
    f"select ({DAY} - r.range::int)::date as score_date from (select greatest(date '2024-01-04', min(date)) as lo from in_prescoring_bid) m, range(0, 30) r where r.range < {DAY} - m.lo",
)
def _(i):
    return scoring.backfill_days(i.prescoring_bid, dt.date(2024, 1, 4), AS_OF)


@query(
    "score_days",
    " union all ".join(f"select {OUT} from {p}" for p in ("o_scores", "o_scores_mid", "o_scores_early")),
)
def _(i):
    days = scoring.backfill_days(i.prescoring_bid, dt.date(2024, 1, 4), AS_OF)
    some = days.filter(F.col("score_date").isin(AS_OF, dt.date(2024, 1, 20), dt.date(2024, 1, 12)))
    return scoring.score_days(i.scoring_input, some)


# -- caches into the cumulative tables
@query("prescoring_to_cumulative", merge_sql("o_pre_target", "o_pre_source", aligned=False))
def _(i):
    day = F.col("date")
    early, late = day <= F.lit(dt.date(2024, 1, 20)), day > F.lit(dt.date(2024, 1, 10))
    return scoring.prescoring_to_cumulative(i.prescoring_bid.filter(early), i.prescoring_bid.filter(late))


@query("pixel_prescoring_to_cumulative", merge_sql("o_pre_target", "o_pre_source", aligned=False, fixed=True))
def _(i):
    day = F.col("date")
    early, late = day <= F.lit(dt.date(2024, 1, 20)), day > F.lit(dt.date(2024, 1, 10))
    rows = i.prescoring_bid.select(*PRESCORING_COLUMNS)
    return scoring.prescoring_to_cumulative(rows.filter(early), rows.filter(late), fixed_averages=True)
