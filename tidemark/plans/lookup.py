"""Address lookups: candidates for the lookup service and use of its answers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import change_set, upsert
from tidemark.plans.bidstream import LOCATION

# Fixed values
CANDIDATE_LIMIT = 3700
RETRY_DAYS = 30
FOUND, NO_CONTENT = 200, 204
LOOKUP_SOURCE = "IP FLOW"
ZIP_COUNTRY = "US"

ANSWER = ["last_response_code", "last_query_date", "api_response"]


def candidate_order(df: DataFrame) -> list[Column]:
    """Network addresses (.0) last, then the most frequent, then by address."""
    last_octet = F.split_part(F.col("user_ip"), F.lit("."), F.lit(4))
    return [(last_octet == "0").asc(), F.col("frequency").desc(), F.col("user_ip").asc()]


def lookup_candidates(
    user_activity: DataFrame,
    vendor_ip: DataFrame,
    lookup_output: DataFrame,
    as_of: dt.date,
    limit: int = CANDIDATE_LIMIT,
    retry_days: int = RETRY_DAYS,
) -> DataFrame:
    """Addresses to look up: unmapped, not lately answered "no content", most frequent first.

    The vendor file, answered addresses and recent misses are all exclusion
    lists, so one anti join serves for the three.  The list is short (top-k).
    """
    recent = F.col("last_query_date") >= F.lit(as_of - dt.timedelta(days=retry_days))
    answered = lookup_output.filter(
        (F.col("last_response_code") == FOUND) | (recent & (F.col("last_response_code") == NO_CONTENT))
    )
    known = vendor_ip.select(F.col("ip_address").alias("user_ip")).unionByName(answered.select("user_ip"))
    seen = user_activity.groupBy("user_ip").agg(F.count("page_url").alias("frequency"))
    open_ips = seen.filter(F.col("user_ip").isNotNull()).join(known, "user_ip", "left_anti")
    return open_ips.orderBy(*candidate_order(open_ips)).limit(limit).select("user_ip")


def lookup_success(lookup_output: DataFrame) -> DataFrame:
    """Answers that found something."""
    return lookup_output.filter(F.col("last_response_code") == FOUND)


def one_answer_per_ip(answers: DataFrame) -> DataFrame:
    """Smallest code and latest day per address, with the response of the latest row.

    Rows of one day are ranked by code (smaller first), then by response text.
    """
    latest = F.max(
        F.struct(
            F.col("last_query_date").alias("d"),
            (-F.col("last_response_code")).alias("c"),
            F.col("api_response").alias("r"),
        )
    )
    return (
        answers.groupBy("user_ip")
        .agg(
            F.min("last_response_code").alias("last_response_code"),
            F.max("last_query_date").alias("last_query_date"),
            latest.alias("__l"),
        )
        .select("user_ip", "last_response_code", "last_query_date", F.col("__l.r").alias("api_response"))
    )


def lookup_latest(
    target: DataFrame, lookup_output: DataFrame, *, drop_null_keys: bool = False, co_located: bool = False
) -> DataFrame:
    """All answers, one row per address, merged into the staging table.

    ``drop_null_keys`` is the incremental-model edition, which loses rows
    without an address.
    """
    source = one_answer_per_ip(lookup_output)
    if drop_null_keys:
        source = source.dropna(subset=["user_ip"])
    return upsert(target, source, ["user_ip"], ANSWER, unique_source=True, co_located=co_located)


def answer_changes(
    target: DataFrame, lookup_output: DataFrame, *, drop_null_keys: bool = True
) -> tuple[DataFrame, DataFrame]:
    """What the answers change in a staging table, as the incremental model does it: rows without an address are lost."""
    return change_set(target, one_answer_per_ip(lookup_output), ["user_ip"], ANSWER, drop_null_keys=drop_null_keys)


def lookup_mappings(
    target: DataFrame, success: DataFrame, *, drop_null_keys: bool = False, co_located: bool = False
) -> DataFrame:
    """Successful answers, one row per address, merged into the mapping table."""
    return lookup_latest(target, success, drop_null_keys=drop_null_keys, co_located=co_located)


def website_domain(response: Column) -> Column:
    """Second and third dot-separated label of the answer's website."""
    site = F.get_json_object(response, "$.website")
    return F.concat(
        F.split_part(site, F.lit("."), F.lit(2)), F.lit("."), F.split_part(site, F.lit("."), F.lit(3))
    )


def lookup_domain_obs(target: DataFrame, success: DataFrame, *, drop_null_keys: bool = False) -> DataFrame:
    """One company observation per address from the lookup service, merged by source."""
    if drop_null_keys:
        success = success.dropna(subset=["user_ip"])
    found = one_answer_per_ip(success).select(
        F.col("user_ip").alias("ip"),
        website_domain(F.col("api_response")).alias("normalized_company_domain"),
        F.lit(LOOKUP_SOURCE).alias("source"),
        F.lit(None).cast("double").alias("source_confidence"),
        F.col("last_query_date").alias("date"),
    )
    return upsert(
        target,
        found,
        ["ip", "source"],
        ["date", "normalized_company_domain", "source_confidence"],
        unique_source=True,
    )


def normalize_location(mappings: DataFrame, country_iso: DataFrame, region: DataFrame) -> DataFrame:
    """Answer locations as 3-letter country, region code, town and US zip."""
    at = lambda path: F.get_json_object("api_response", f"$.location.{path}")
    rows = mappings.select(
        F.col("user_ip").alias("ip"),
        F.col("last_query_date").alias("date_updated"),
        at("countryCode").alias("isocode_2"),
        at("region").alias("region_name"),
        at("town").alias("normalized_city_name"),
        F.when(at("countryCode") == ZIP_COUNTRY, at("postalCode")).alias("normalized_zip"),
    )
    return (
        rows.join(country_iso.select("isocode_2", "isocode_3"), "isocode_2", "left")
        .join(region.select("region_name", "region_isocode_2"), "region_name", "left")
        .select(
            "ip",
            "date_updated",
            F.col("isocode_3").alias("normalized_country_code"),
            F.col("region_isocode_2").alias("normalized_region_code"),
            "normalized_city_name",
            "normalized_zip",
        )
        .distinct()
    )


def one_location_per_ip(locations: DataFrame, fields: Sequence[str] = LOCATION) -> DataFrame:
    """Latest day per address with the location of that day (largest text on ties)."""
    latest = F.max_by(
        F.struct(*fields),
        F.struct(F.col("date_updated"), F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("")) for c in fields])),
    )
    return (
        locations.groupBy("ip")
        .agg(F.max("date_updated").alias("date_updated"), latest.alias("__l"))
        .select("ip", "date_updated", *[f"__l.{c}" for c in fields])
    )


def lookup_location_upsert(
    target: DataFrame, locations: DataFrame, *, drop_null_keys: bool = False, co_located: bool = False
) -> DataFrame:
    """Looked-up locations into the cumulative map."""
    if drop_null_keys:
        locations = locations.dropna(subset=["ip"])
    return upsert(
        target, one_location_per_ip(locations), ["ip"], ["date_updated", *LOCATION], unique_source=True,
        co_located=co_located,
    )
