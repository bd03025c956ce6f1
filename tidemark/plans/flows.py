"""The scheduled runs: each reads stored tables, applies the operators and stores the results.

Steps that only pass data on are one plan; a table is written where a later
run, or more than one later step, reads it.  Cumulative tables are merged into by
partition: a run reads and writes the days and key slots that its rows touch.

Flows that start from files take ``incoming``, the folder the files arrive in: files that an
earlier run has loaded are not loaded again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import high_water_mark, incremental_slice, quality_check, slice_start
from tidemark.plans import bidstream, content, email, enrichment, lookup, pixel, scoring, vendors
from tidemark.sources.files import model_batch_export
from tidemark.sources.warehouse import LOAD, Warehouse
from tidemark.streaming.loads import add_pixel_batch, load_feed


def _labels(w: Warehouse) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    titles = w.read("page/titles").withColumn("topics", enrichment.title_topics_from_json(F.col("topics")))
    return w.read("page/topics"), w.read("page/brands"), w.read("page/context"), titles


#: Keys of the tables whose rows the model declares unique and complete, tested as they are stored.
TESTED = {"lookup/input": ["user_ip"]}


def check_stored(name: str, stored: DataFrame) -> DataFrame:
    """The stored table, if its declared column tests hold."""
    keys = TESTED[name]
    failed = quality_check(stored, unique=keys, not_null=keys).filter("failures > 0")
    if not failed.isEmpty():
        raise ValueError(f"{name} has repeated or missing values of {', '.join(keys)}")
    return stored


def ip_ranges(w: Warehouse, raw: DataFrame | None, as_of: dt.date, incoming: str | None = None) -> None:
    """Full reload of the range file; hosts on ``maps/shared_domains`` are marked as shared.

    Without ``raw`` the newest file of ``incoming`` is loaded, if it is a new one.
    """
    if incoming is not None:
        load_feed(w, "vendor/ip_ranges_raw", incoming)
        raw = w.read("vendor/ip_ranges_raw")
    else:
        raw = w.replace("vendor/ip_ranges_raw", raw)
    w.replace("vendor/ip_ranges", vendors.ip_range_clean(raw, as_of, shared=w.read("maps/shared_domains")))


def vendor_companies(w: Warehouse, as_of: dt.date) -> None:
    """Vendor companies as observations, then new company shares."""
    stored = w.insert(
        "maps/ip_domain_obs", vendors.vendor_ip_domain_obs, w.read("vendor/ip_companies"), as_of, w.read("maps/shared_domains"),
        column="ip_address",
    )
    w.replace("maps/ip_domain", bidstream.ip_domain_scores(stored, as_of, recency_floor=None, guard_zero=True))


def leads(w: Warehouse, incoming: str | None = None) -> None:
    """Loaded leads into the cumulative table, then lead prescoring."""
    if incoming is not None:
        load_feed(w, "lead/cache", incoming)
    stored = w.replace("lead/leads", vendors.lead_dedupe_merge(w.read("lead/leads"), w.read("lead/cache")))
    w.empty("lead/cache")
    w.replace("lead/prescoring", vendors.lead_prescoring(stored, w.read("lead/topic_map")))


def bid_stream(
    w: Warehouse,
    cut: dt.datetime,
    as_of: dt.date,
    *,
    confidence: int = 0,
    queue_limit: int = bidstream.QUEUE_LIMIT,
    key_mode: str = "reference",
    first_day: dt.date = bidstream.FIRST_DAY,
    slice_days: int = bidstream.SLICE_DAYS,
    resolvable_days: int = bidstream.RESOLVABLE_DAYS,
) -> None:
    """Bid log to prescoring cache and scrape queue.

    ``first_day`` is the high-water mark of empty tables; a slice ends ``slice_days``
    past the mark.  Where no row lies that near, the mark moves to the next row.
    """
    done, rest = bidstream.consume_raw(w.read("bid/log"), cut)
    # a run that stopped before the log was replaced is repeated into the same partition
    run = f"{w.version('bid/log')}-{cut:%Y%m%d%H%M%S}"
    cache = w.append("bid/user_activity_cache", bidstream.user_activity_rollup(done, cut), run)
    w.replace("bid/log", rest)
    w.insert("bid/user_activity", bidstream.user_activity_merge, cache)

    ranges = w.read("vendor/ip_ranges")
    latest = w.replace("bid/ip_location_cache", bidstream.ip_location_latest(cache))
    w.merge("bid/ip_location", bidstream.ip_location_upsert, latest, co_located=True)
    locations = w.merge("maps/ip_location", bidstream.ip_location_best_source, latest, ranges, confidence, co_located=True)
    obs = w.insert("maps/ip_domain_obs", bidstream.ip_domain_obs_from_ranges, cache, ranges, column="user_ip")
    isps = w.read("maps/isp_domains")
    ip_domain = w.replace("maps/ip_domain", bidstream.ip_domain_scores(obs, as_of))
    trio = w.replace("maps/ip_trio", bidstream.ip_trio_scores(ip_domain, isps))

    seen = w.replace("bid/device_ip_cache", bidstream.device_ip_obs(w.read("bid/device_ip_cache"), cache))
    w.insert("maps/device_ip_obs", bidstream.device_ip_obs_publish, seen)
    device_obs = w.insert("maps/device_domain_obs", bidstream.device_domain_obs, seen, ip_domain)
    devices = w.replace("maps/device_domain", bidstream.device_domain_best(device_obs, isps))
    w.empty("bid/device_ip_cache")

    mark = high_water_mark(w.read("bid/company_activity"), "date", first_day)
    mark = slice_start(cache, "date", mark, slice_days)
    days = incremental_slice(cache, "date", mark, slice_days)
    resolvable = w.replace(
        "bid/ip_resolvable_domains",
        bidstream.ip_resolvable_domains(w.read("bid/ip_resolvable_domains"), days, ip_domain, isps),
    )
    fresh = bidstream.company_activity(
        days, ip_domain, devices, trio, resolvable, locations, w.read("maps/geos"), isps, as_of,
        resolvable_days=resolvable_days,
    )
    company = w.replace(
        "bid/company_activity_cache",
        bidstream.company_activity_replace_slice(w.read("bid/company_activity_cache"), fresh, mark, slice_days),
    )
    w.insert("bid/company_activity", bidstream.company_activity_merge, company)
    # the days that company activity has been computed for
    w.drop_days("bid/user_activity_cache", company.select("date").distinct())

    url_mark = high_water_mark(w.read("bid/unique_urls"), "last_seen", first_day)
    url_mark = slice_start(company, "date", url_mark, slice_days)
    url_days = incremental_slice(company, "date", url_mark, slice_days)
    urls = w.replace("bid/unique_urls_cache", bidstream.unique_urls(w.read("bid/unique_urls_cache"), url_days))
    w.merge("bid/unique_urls", bidstream.unique_urls_merge, urls, co_located=True)
    results = w.read("page/results")
    queue = w.replace(
        "page/queue",
        bidstream.scrape_queue(
            w.read("page/queue"), urls, results, w.read("maps/bad_publishers"), as_of, queue_limit
        ),
    )
    w.replace("bid/unique_urls_cache", bidstream.scrape_queue_prune(urls, queue, results))

    # the slice comes from a grouping and replaces its days, so the cache repeats no row
    enriched = enrichment.enrich_activity(company, *_labels(w), activity_distinct=True)
    rollup = enrichment.prescoring_rollup(enriched)
    w.merge("bid/prescoring_cache", enrichment.prescoring_merge, rollup, key_mode)
    # a row is enriched exactly when its page has labels
    labelled = enrichment.page_labels(*_labels(w)).select("page_url")
    w.delete("bid/company_activity_cache", labelled, ["page_url"])


def pixel_records(
    w: Warehouse,
    as_of: dt.date,
    *,
    key_mode: str = "reference",
    first_day: dt.date = bidstream.FIRST_DAY,
    slice_days: int = pixel.SLICE_DAYS,
    incoming: str | None = None,
) -> None:
    """Pixel records to prescoring cache and scrape queue; slices as in ``bid_stream``."""
    if incoming is not None:
        load_feed(w, "pixel/raw", incoming)
    # a run that stopped before the records were removed is repeated into the same partition
    load = f"raw-{w.version('pixel/raw')}"
    add_pixel_batch(w, w.read("pixel/raw"), load)
    fresh, activity = w.loads("pixel/views").filter(F.col(LOAD) == load), w.read("pixel/user_activity")
    w.empty("pixel/raw")
    # all views of the pages that have new ones
    pages = activity.join(fresh.select("site_url").distinct(), "site_url", "left_semi")
    urls = w.merge("pixel/unique_urls", pixel.pixel_unique_urls, pages, column="site_url", co_located=True)
    queue = pixel.pixel_scrape_queue(
        w.read("page/queue"), urls, w.read("page/results"), w.read("maps/bad_publishers"), as_of
    )
    w.replace("page/queue", queue)
    w.insert("maps/ip_domain_obs", pixel.pixel_ip_domain_obs, activity, w.read("vendor/ip_ranges"), column="user_ip")

    mark = high_water_mark(w.read("pixel/company_activity"), "date", first_day)
    mark = slice_start(activity, "date", mark, slice_days, inclusive=True)
    days = incremental_slice(activity, "date", mark, slice_days, inclusive=True)
    company = w.replace(
        "pixel/company_activity_cache",
        pixel.pixel_company_activity(
            w.read("pixel/company_activity_cache"), days, w.read("maps/ip_domain"), w.read("maps/ip_location")
        ),
    )
    w.merge("pixel/company_activity", pixel.pixel_company_activity_merge, company)
    enriched = pixel.pixel_enrich(company, *_labels(w))
    w.merge("pixel/prescoring_cache", pixel.pixel_prescoring, enriched, key_mode)
    labelled = enrichment.page_labels(*_labels(w)).select("page_url")
    w.delete("pixel/company_activity_cache", labelled, ["page_url"])


def lookup_requests(w: Warehouse, as_of: dt.date, limit: int = lookup.CANDIDATE_LIMIT) -> DataFrame:
    """Store the addresses to look up; duplicates or NULLs among them stop the run."""
    wanted = lookup.lookup_candidates(
        w.read("bid/user_activity"), w.read("vendor/ip_companies"), w.read("lookup/output"), as_of, limit
    )
    return check_stored("lookup/input", w.replace("lookup/input", wanted))


def lookup_answers(w: Warehouse, as_of: dt.date, *, incremental: bool = False) -> None:
    """Use the answers that arrived in ``lookup/output_raw``.

    ``incremental`` is the model edition: rows without an address are lost, and of the staging and
    mapping tables only partitions with a changed or new answer are written.
    """
    answers = w.read("lookup/output_raw")
    success = w.append("lookup/success", lookup.lookup_success(answers))
    if incremental:
        for name, source in (("lookup/output", answers), ("lookup/mappings", success)):
            updates, inserts = lookup.answer_changes(w.part_of(name, source), source)
            mappings = w.change(name, updates, inserts, ["user_ip"])
    else:
        w.merge("lookup/output", lookup.lookup_latest, answers, co_located=True)
        mappings = w.merge("lookup/mappings", lookup.lookup_mappings, success, co_located=True)
    lost = {"drop_null_keys": incremental}
    obs = w.merge("maps/ip_domain_obs", lookup.lookup_domain_obs, success, column="user_ip", **lost)
    w.replace("maps/ip_domain", bidstream.ip_domain_scores(obs, as_of, recency_floor=None, guard_zero=True))
    places = w.append(
        "lookup/locations",
        lookup.normalize_location(mappings, w.read("maps/country_iso"), w.read("maps/regions")),
    )
    w.merge("maps/ip_location", lookup.lookup_location_upsert, places, co_located=True, **lost)
    w.empty("lookup/input", "lookup/output_raw", "lookup/success", "lookup/locations")


def email_campaigns(w: Warehouse, as_of: dt.date, incoming: dict[str, str] | None = None) -> None:
    """Clicks and opens to e-mail prescoring and the scrape queue.

    ``incoming`` names the folders of files by table, ``email/clicks`` and ``email/opens``.
    """
    for table, folder in (incoming or {}).items():
        load_feed(w, table, folder)
    raw = w.read("email/clicks")
    clicks = w.replace("email/company_clicks", email.company_clicks(raw))
    opens = w.replace("email/company_opens", email.company_opens(w.read("email/opens")))
    urls = w.replace("email/unique_urls", email.email_unique_urls(raw))
    pages = w.replace("email/campaign_content", email.campaign_content(raw))
    topics, brands = w.read("page/topics"), w.read("page/brands")
    shares = w.replace("email/campaign_topics", email.campaign_topics(pages, topics))
    w.replace(
        "page/queue", email.email_scrape_queue(w.read("page/queue"), urls, w.read("page/results"), as_of)
    )
    w.replace("email/prescoring", email.email_prescoring(clicks, opens, shares, topics, brands))


def page_content(
    w: Warehouse,
    as_of: dt.date,
    batch_path: str,
    *,
    push_limit: int = content.PUSH_LIMIT,
    model_limit: int = content.PUSH_LIMIT,
    model_file_rows: int = 100_000,
    model_file_bytes: int | None = None,
    incoming: dict[str, str] | None = None,
) -> None:
    """Scraper and model outputs to results, labels, model batches and the next scrape batch.

    ``incoming`` names the folders of files by table: ``page/scrape_output`` and the two model outputs.
    """
    for table, folder in (incoming or {}).items():
        load_feed(w, table, folder)
    scraped = w.read("page/scrape_output")
    queue = w.replace("page/queue", content.scrape_input_prune(w.read("page/queue"), scraped))
    w.replace("page/queue", content.scrape_increment(queue, f"{batch_path}/scrape", as_of, push_limit))

    cache = w.replace("page/results_cache", content.scrape_results(w.read("page/results_cache"), scraped, as_of))
    results = w.merge("page/results", content.scrape_results_merge, cache, co_located=True)

    title_answers, topic_answers = w.read("page/title_output_cache"), w.read("page/topic_output_cache")
    for kind, answers, make in (
        ("title", title_answers, content.title_input),
        ("topic", topic_answers, content.topic_input),
    ):
        wanted = make(w.read(f"page/{kind}_input"), scraped, w.read(f"page/{kind}s"), as_of)
        stored = w.replace(f"page/{kind}_input", content.model_input_prune(wanted, answers))
        columns = [c for c in stored.columns if c != "date_inserted"]
        model_batch_export(stored, columns, f"{batch_path}/{kind}", model_limit, model_file_rows, model_file_bytes)
    w.merge("page/titles", content.title_results, title_answers, as_of, co_located=True)
    topics = w.merge("page/topics", content.topic_results, topic_answers, as_of, co_located=True)
    w.merge("page/context", content.label_context, scraped, as_of, column="url", co_located=True)

    ngrams = w.replace("page/ngrams", content.page_ngrams(w.read("page/ngrams"), cache))
    reference = w.read("page/reference_topics")
    tagged = w.replace(
        "page/brands",
        content.tag_brands(w.read("page/brands"), ngrams, topics, w.read("page/topic_brands"), reference, as_of),
    )
    w.replace(
        "page/brands",
        content.tag_brands_any_topic(tagged, ngrams, w.read("page/brand_list"), reference, as_of),
    )
    w.replace("page/ngrams", content.brand_cleanup(ngrams, topics))
    w.replace("page/results_cache", content.scrape_results_consume(cache, results))
    w.empty("page/scrape_output", "page/title_output_cache", "page/topic_output_cache")


def weekly_scores(
    w: Warehouse, today: dt.date, *, key_mode: str = "reference", days: DataFrame | None = None
) -> None:
    """Prescoring caches to cumulative tables, then the scores of the day, or of ``days``, into the history.

    ``days`` has a column ``score_date``; all its days are one job.
    """
    if days is None:
        days = w.spark.range(1).select(F.lit(today).alias("score_date"))
    first = days.agg(F.min("score_date")).first()[0]
    bid = w.merge("bid/prescoring", scoring.prescoring_to_cumulative, w.read("bid/prescoring_cache"), key_mode)
    own = w.merge(
        "pixel/prescoring", scoring.prescoring_to_cumulative, w.read("pixel/prescoring_cache"), key_mode, fixed_averages=True
    )
    combined = scoring.combine_sources(
        bid, own, w.read("email/prescoring"), w.read("lead/prescoring"), scoring.lookback_date(first or today), today
    )
    series = w.replace("score/input", scoring.rolling_stats(combined))
    scores = w.replace("score/output", scoring.scores_of_days(w.read("score/output"), series, days))
    w.merge("score/history", scoring.scores_history_merge, scores)
    w.empty("bid/prescoring_cache", "pixel/prescoring_cache", "score/output")


def backfill_scores(w: Warehouse, today: dt.date, first_day: dt.date, *, key_mode: str = "reference") -> None:
    """Scores of all days after the earliest cached one (not before ``first_day``) up to ``today``."""
    days = w.replace("score/days", scoring.backfill_days(w.read("bid/prescoring_cache"), first_day, today))
    weekly_scores(w, today, key_mode=key_mode, days=days)
