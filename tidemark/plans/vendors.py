"""Vendor files: address ranges, address-to-company lists, leads."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import domain_normalizer, ip_to_number, normalize_city
from tidemark.operators import insert_new, mark_shared

# Fixed values
COUNTRIES = ("USA", "CAN", "GBR", "DEU", "SWE", "NLD", "NOR", "FRA", "ESP")
GENERIC_NAME_PREFIX = "ip-"
VENDOR_SOURCE = "FIVE BY FIVE"
MISSING = "NULL VALUE"
LEAD_TEXT = [
    "category", "domain", "company", "entity_trigger", "seniority", "entity_function",
    "trigger_type", "industry", "company_size", "city", "state", "country",
]


def ip_range_clean(
    raw: DataFrame, as_of: dt.date, countries: Sequence[str] = COUNTRIES, shared: DataFrame | None = None
) -> DataFrame:
    """Ranges with numeric bounds and normal forms, for the countries served.

    Domains on the list ``shared`` (column ``domain``) become the marker that the maps leave out.

    Rows with neither company nor domain are dropped, and so are generic host
    names; a row without a domain does not pass the host-name test either.
    """
    rows = raw.filter((F.length("company_name") >= 2) | (F.length("domain_name") >= 2)).select(
        F.lit(as_of).alias("date_updated"),
        "ip_range_start",
        ip_to_number(F.col("ip_range_start")).alias("ip_range_start_numeric"),
        "ip_range_end",
        ip_to_number(F.col("ip_range_end")).alias("ip_range_end_numeric"),
        F.trim(F.upper("pulseplus_country")).alias("normalized_country_code"),
        F.trim(F.upper("pulseplus_region")).alias("normalized_region_code"),
        normalize_city(F.col("pulseplus_city")).alias("normalized_city_name"),
        F.col("pulseplus_metro_code").alias("metro_code"),
        F.col("pulseplus_postal_code").alias("normalized_zip"),
        F.col("pulseplus_country_conf").alias("country_confidence"),
        F.col("pulseplus_region_conf").alias("region_confidence"),
        F.col("pulseplus_city_conf").alias("city_confidence"),
        F.col("pulseplus_postal_conf").alias("postal_confidence"),
        "isp_name",
        "homebiz_type",
        "company_name",
        domain_normalizer(F.col("domain_name")).alias("normalized_company_domain"),
    )
    if shared is not None:
        rows = mark_shared(rows, "normalized_company_domain", shared)
    return rows.filter(
        F.col("normalized_country_code").isin(*countries)
        & ~F.col("normalized_company_domain").startswith(GENERIC_NAME_PREFIX)
    )


def vendor_ip_domain_obs(
    target: DataFrame, vendor_ip: DataFrame, as_of: dt.date, shared: DataFrame | None = None, *, only_new: bool = False
) -> DataFrame:
    """Main and other companies of each vendor address, observed once a day.

    Domains on the list ``shared`` (column ``domain``) belong to no company and are left out.
    """
    names = F.concat(
        F.array("company_domain"),
        F.coalesce(F.split("company_domain_array", ","), F.array().cast("array<string>")),
    )
    domain = F.col("normalized_company_domain")
    named = (
        vendor_ip.select(
            F.col("ip_address").alias("ip"),
            F.explode(names).alias("name"),
            F.col("distribution_percentage").alias("source_confidence"),
        )
        .select("ip", domain_normalizer(F.col("name")).alias("normalized_company_domain"), "source_confidence")
    )
    if shared is not None:
        named = mark_shared(named, "normalized_company_domain", shared)
    found = (
        named.filter((domain != "Shared") & (F.length(domain) > 1))
        .distinct()
        .withColumns({"source": F.lit(VENDOR_SOURCE), "date": F.lit(as_of)})
    )
    today = (F.col("source") == VENDOR_SOURCE) & (F.col("date") == F.lit(as_of))
    return insert_new(target, found, ["ip", "normalized_company_domain"], target_filter=today, only_new=only_new)


def lead_rows(cache: DataFrame) -> DataFrame:
    """Leads with missing texts marked, best score per distinct lead."""
    filled = cache.withColumns({c: F.coalesce(F.col(c), F.lit(MISSING)) for c in LEAD_TEXT})
    return filled.groupBy("file_date", *LEAD_TEXT).agg(F.max(F.coalesce("score", F.lit(0))).alias("score"))


def lead_dedupe_merge(target: DataFrame, cache: DataFrame) -> DataFrame:
    """New leads into the cumulative table; missing target texts and scores count as marked."""
    keys = ["file_date", *LEAD_TEXT, "score"]
    marked = target.withColumns(
        {**{c: F.coalesce(F.col(c), F.lit(MISSING)) for c in LEAD_TEXT}, "score": F.coalesce("score", F.lit(0))}
    )
    # only the comparison sees the marks; stored target rows stay as they are
    fresh = lead_rows(cache).join(marked.select(*keys), keys, "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def lead_prescoring(leads: DataFrame, topic_map: DataFrame) -> DataFrame:
    """Best lead score per day, topic and company."""
    return (
        leads.join(topic_map, F.col("entity_trigger") == F.col("leadsift_category"))
        .groupBy(
            F.col("file_date").alias("date"),
            F.col("ds_parent_category").alias("parent_category"),
            F.col("ds_category").alias("category"),
            F.col("ds_topic").alias("topic"),
            domain_normalizer(F.col("domain")).alias("normalized_company_domain"),
        )
        .agg(F.max("score").alias("leadsift_score"))
    )
